"""One query per operator over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm import (
    bloom_lm, bpe, collocations, html_text, jaccard, language, mixing, pii, quality, simhash, spelling,
    text_oracles, token_files, word_bpe,
)
from caselake.llm.common import table


def op1_pii_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(kind) for kind in pii.KINDS],
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("bigint").alias("n_added"),
    )


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.folder(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    token_files.write_ids(docs, public_tokenizers.path("word_bpe_49k.json"), path)
    return token_files.read_ids(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language.fit_text_model(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    return language.identify(table(spark, sf_dir, "pages").select("page_id", "url", "html"), model)


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).withColumn("n_chars", F.length("text").cast("bigint"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = simhash.described(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return simhash.search(marks, F.col("doc_id") % 50 == 0).select(
        "doc_id", "n_chars", "edited_sha256", simhash.hexed(F.col("fingerprint")).alias("fingerprint"),
        simhash.hexed(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        simhash.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        simhash.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"), "n_near",
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.assess(docs, table(spark, sf_dir, "labels")).select(
        "doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "score",
    )


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bloom_lm.score(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2)


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.link_groups(docs, jaccard.JaccardSpec(words=3, num=90, den=100))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variant_groups(docs, spelling.SpellingSpec(drop_every=97))


def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return word_bpe.digests(docs, public_tokenizers.path("word_bpe_49k.json"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii_sanitisation": op1_pii_sanitisation,
    "op2_token_files": op2_token_files,
    "op3_entropy_mixing": op3_entropy_mixing,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_language_id": op5_language_id,
    "op6_html_extraction": op6_html_extraction,
    "op7_simhash": op7_simhash,
    "op8_quality_rules": op8_quality_rules,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_word_bpe": op12_word_bpe,
    "op13_collocations": op13_collocations,
}

#: Queries with a SQL counterpart.
ORACLES: dict[str, str] = {
    "op11_spelling_variants": text_oracles.SPELLING,
    "op13_collocations": text_oracles.PHRASES,
}
