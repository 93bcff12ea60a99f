"""Language of web pages by fusing evidence.

Four kinds of evidence are put together by Bayes' rule: the likelihood of the visible
text under character trigrams of each language, the language declared in the markup,
the address suffix, and a prior of the host. How far a declaration or a suffix can be
trusted is not assumed but counted: grouped sums over all pages, of the languages
their texts alone point to. A host's prior is its own count drawn towards its domain's,
and that towards all pages', by a fixed number of pseudo pages, so a host seen once
says little; a page's own vote is taken out first.

The text model is fitted on labelled documents, at most ``sample_rows`` per language,
chosen by hash; everything else covers all pages.

Defined results: a page without text is judged by the other evidence; null html, url or
ids are evidence of nothing; repeated rows are judged alike; without labelled documents
the language is null; an empty table gives an empty result. Only ``page_id``, ``url``
and ``html`` are read, so other columns never clash.
"""

from __future__ import annotations

import html
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.operators.selection import first_per_group
from caselake.session import written

# Parts of a page that hold no text, and a mark-up tag.
SILENT = r"(?is)<!--.*?-->|<(script|style|head|noscript|template)\b.*?</\1\s*>"
TAG = r"(?s)<[^>]*>"
DECLARED = r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b"


@dataclass(frozen=True)
class LanguageSpec:
    """``text_weight`` tempers the text: trigrams of one text are far from independent."""

    sample_rows: int = 500
    buckets: int = 1 << 15
    text_weight: float = 0.15
    host_pages: float = 5.0
    domain_pages: float = 20.0
    salts: int = 16


def visible_text(page: Column) -> Column:
    """The text between the tags, its character references not decoded yet."""
    return F.regexp_replace(F.regexp_replace(page, SILENT, " "), TAG, " ")


def decoded(text: str) -> str:
    """``text`` with all character references decoded and white space as single blanks."""
    return " ".join(html.unescape(text).split())


def trigram_slots(text: str, buckets: int) -> np.ndarray:
    """Slots of the trigrams of a text in lower case, without digits and signs."""
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    codes = np.frombuffer(" ".join(f" {letters} ".split(" ")).encode("utf-32-le"), "<u4").astype(np.uint64)
    if len(codes) < 3:
        return np.empty(0, np.int64)
    mixed = (codes[:-2] * np.uint64(1_000_003) + codes[1:-1]) * np.uint64(1_000_003) + codes[2:]
    used = (codes[:-2] != 32) | (codes[1:-1] != 32)
    return (((mixed ^ (mixed >> np.uint64(17))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64)[used] % buckets


@dataclass(frozen=True)
class TextModel:
    """Log probability of every slot (rows) under every language (columns)."""

    languages: tuple[str, ...]
    logs: np.ndarray
    buckets: int

    def likelihoods(self, text: str) -> np.ndarray:
        return self.logs[trigram_slots(text, self.buckets)].sum(axis=0)


def fit_text_model(docs: DataFrame, spec: LanguageSpec = LanguageSpec()) -> TextModel:
    """Trigram counts per language of a bounded sample of labelled documents.

    The cut of each language is found from histograms of the hashes, so no language's
    rows are sorted or meet in one task.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    chosen = first_per_group(labelled, "lang", [F.xxhash64("doc_id", "text")], spec.sample_rows)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                own = counts.setdefault(lang, np.zeros(spec.buckets, np.int64))
                own += np.bincount(trigram_slots(text, spec.buckets), minlength=spec.buckets)
        for lang, own in counts.items():
            seen = np.nonzero(own)[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(seen), pa.string()), pa.array(seen), pa.array(own[seen])], ["lang", "slot", "n"])

    counted = chosen.select("lang", "text").mapInArrow(rows, "lang string, slot bigint, n bigint")
    sums = counted.groupBy("lang", "slot").agg(F.sum("n").alias("n")).collect()  # languages times buckets at most
    languages = tuple(sorted({r["lang"] for r in sums}))
    table = np.full((spec.buckets, len(languages)), 0.5)
    for lang, slot, n in sums:
        table[slot, languages.index(lang)] += n
    return TextModel(languages, np.log(table / table.sum(axis=0)), spec.buckets)


def described(pages: DataFrame, model: TextModel, spec: LanguageSpec) -> DataFrame:
    """One row per page, without its html: address parts, declaration, text likelihoods
    and the language of the text alone (null without text)."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    rows = pages.select(
        "page_id", "url", F.nullif(host, F.lit("")).alias("host"),
        F.nullif(F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), DECLARED, 1)), F.lit("")).alias("declared"),
        visible_text(F.coalesce("html", F.lit(""))).alias("visible"),
    )

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs = [model.likelihoods(decoded(t)) for t in batch.column("visible").to_pylist()]
            best = [int(np.argmax(x)) if len(x) and x.any() else None for x in logs]
            ends = np.arange(len(logs) + 1, dtype=np.int32) * len(model.languages)
            flat = np.concatenate([np.empty(0), *logs]) * spec.text_weight
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("page_id", "url", "host", "declared")]
                + [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(best, pa.int32())],
                ["page_id", "url", "host", "declared", "text_logs", "own"])

    done = rows.mapInArrow(
        scored, "page_id bigint, url string, host string, declared string, text_logs array<double>, own int")
    parts = F.split("host", r"\.")
    return done.withColumn("suffix", F.element_at(parts, -1)).withColumn(
        "domain", F.array_join(F.slice(parts, -F.least(F.size(parts), F.lit(2)), 2), "."))


def _votes(pages: DataFrame, key: str, n: int) -> DataFrame:
    """(key, votes): pages per language their text points to, as an array."""
    voting = pages.filter(F.col(key).isNotNull() & F.col("own").isNotNull())
    return voting.groupBy(key).agg(F.array(*[
        F.sum((F.col("own") == i).cast("double")) for i in range(n)]).alias(f"{key}_votes"))


def _look_up(pages: DataFrame, found: DataFrame, key: str, salts: int) -> DataFrame:
    """Join per-key facts to pages; a key may hold most pages, so each key's row goes to
    ``salts`` places and its pages are dealt over them."""
    spread = found.withColumnRenamed(key, "_key").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = pages.withColumn("_deal", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int"))
    return dealt.join(spread, (dealt[key] == spread["_key"]) & (dealt["_deal"] == spread["_salt"]), "left").drop(
        "_key", "_salt", "_deal")


def _total(votes: Column) -> Column:
    return F.aggregate(votes, F.lit(0.0), lambda a, x: a + x)


def identify(pages: DataFrame, model: TextModel, spec: LanguageSpec = LanguageSpec()) -> DataFrame:
    """(page_id, url, host, declared, text_lang, lang, confidence) for every page."""
    names = F.array(*[F.lit(x) for x in model.languages]).cast("array<string>")
    n = len(model.languages)
    rows = written(described(pages, model, spec), "pages")
    if not n:
        blank = F.lit(None).cast("string")
        return rows.select("page_id", "url", "host", "declared", blank.alias("text_lang"), blank.alias("lang"),
                           F.lit(0.0).alias("confidence"))
    sums = rows.filter(F.col("own").isNotNull()).groupBy("own").agg(F.count(F.lit(1)).alias("n")).collect()
    votes = np.ones(n)
    for own, count in sums:
        votes[own] += count
    everywhere = F.array(*[F.lit(float(v)) for v in votes / votes.sum()])
    of_language = F.array(*[F.lit(float(v)) for v in votes])

    # Host tables: the domain's votes drawn to all pages', joined to its hosts.
    domains = _votes(rows, "domain", n)
    hosts = _votes(rows, "host", n).withColumn("domain", F.array_join(F.slice(
        F.split("host", r"\."), -F.least(F.size(F.split("host", r"\.")), F.lit(2)), 2), "."))
    hosts = hosts.join(domains, "domain", "left").select("host", "host_votes", "domain_votes")
    known = _look_up(rows, hosts, "host", spec.salts)
    known = _look_up(known, _votes(rows, "declared", n), "declared", spec.salts)
    known = _look_up(known, _votes(rows, "suffix", n), "suffix", spec.salts)

    none = F.array_repeat(F.lit(0.0), n)

    def others(column: str) -> Column:
        """Votes of the other pages."""
        return F.transform(F.coalesce(column, none), lambda v, i: F.greatest(
            v - F.when(F.col("own") == i, 1.0).otherwise(0.0), F.lit(0.0)))

    def drawn(own: Column, parent: Column, weight: float) -> Column:
        size = _total(own) + weight
        return F.zip_with(own, parent, lambda v, p: (v + p * weight) / size)

    known = known.withColumn("_domain", drawn(others("domain_votes"), everywhere, spec.domain_pages))
    known = known.withColumn("_prior", drawn(others("host_votes"), F.col("_domain"), spec.host_pages))

    def evidence(column: str) -> Column:
        """log p(value | language), smoothed; nothing where the value is missing."""
        logs = F.zip_with(others(column), of_language, lambda v, all_: F.log((v + 0.5) / (all_ + 1.0)))
        return F.when(F.col(column).isNotNull(), logs).otherwise(none)

    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    logs = add(add(F.col("text_logs"), F.transform("_prior", lambda p: F.log(p))),
               add(evidence("declared_votes"), evidence("suffix_votes")))
    fused = known.withColumn("_logs", logs).withColumn("_top", F.array_max("_logs"))
    mass = _total(F.transform("_logs", lambda x: F.exp(x - F.col("_top"))))
    return fused.select(
        "page_id", "url", "host", "declared", F.get(names, F.col("own")).alias("text_lang"),
        F.get(names, (F.array_position("_logs", F.col("_top")) - 1).cast("int")).alias("lang"),
        (1 / mass).alias("confidence"),
    )
