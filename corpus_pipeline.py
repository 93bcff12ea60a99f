"""The text pipeline: rules, one document per group, personal data, mixing, token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm import bpe, jaccard, mixing, pii, quality
from caselake.llm.common import table
from caselake.session import written

TOKENIZER = "byte_bpe_50k.tiktoken"


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the quality rules."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-equal texts.

    Documents without an id are in no group and stay. Of rows that share the smallest
    id, one stays: the first by text hash.
    """
    groups = jaccard.link_groups(docs.select("doc_id", "text"))
    heads = groups.filter(F.col("component_id") == F.col("doc_id")).select("doc_id").distinct()
    kept = docs.join(heads, "doc_id", "left_semi")
    names = docs.columns
    row = F.struct(F.xxhash64("text").alias("_h"), F.struct(*[docs[f"`{c}`"] for c in names]).alias("_row"))
    repeated = groups.filter(F.col("component_id") == F.col("doc_id")).groupBy("doc_id").count().filter("count > 1")
    several = kept.join(repeated.select("doc_id"), "doc_id", "left_semi").select(*names)
    first = several.groupBy("doc_id").agg(F.min(row).alias("_first")).select("_first._row.*")
    single = kept.join(repeated.select("doc_id"), "doc_id", "left_anti").select(*names)
    return single.unionByName(first).unionByName(docs.filter(F.col("doc_id").isNull()))


def sanitised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced in the texts."""
    return pii.sanitise(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that the sources meet their targets."""
    return mixing.repeat_rows(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, ids, n_tokens, exact): the training rows, and whether the ids
    decode to the text again."""
    return bpe.token_rows(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality rules", good_documents),
    ("n-gram Jaccard join", one_of_each_group),
    ("personal data", sanitised),
    ("mixing", mixed),
    ("byte-level BPE", token_ids),
]

#: The stages hash, iterate and merge bytes, which SQL cannot say; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
