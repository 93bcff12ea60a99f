"""SimHash fingerprints and the search for fingerprints within a Hamming radius.

Every run of five words is a term; its weight is how often it occurs. The bits of its
hash vote for or against the bits of the fingerprint. For the search a fingerprint is
cut into pieces; within radius r at least (pieces - r) of them are equal, so a table
per choice of that many pieces, keyed by their bits, holds every match. Only
DataFrame functions are used.

Defined results: a text of fewer than five words is one term; a null or empty text, or
one without words, has no term and the fingerprint 0; null ids come first in order; of
rows with one id the smaller text hash comes first; repeated rows have equal
fingerprints. Only ``doc_id`` and ``text`` are read, so other columns never clash.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.llm.common import paired, whole_text, words_of
from caselake.session import written

BITS = 64
TERM_WORDS = 5
RADIUS = 3
PIECES = 6


def with_fingerprint(rows: DataFrame, body: str, name: str) -> DataFrame:
    """Add ``name``, the fingerprint of the text ``body`` as a bigint."""
    kept = rows.columns
    hashed = rows.withColumn("_words", words_of(F.col(body))).withColumn(
        "_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    n = F.size("_hashes")
    twos = paired(F.col("_hashes"), F.col("_hashes"), 1, n - 1)
    fours = hashed.withColumn("_twos", twos).withColumn("_fours", paired(F.col("_twos"), F.col("_twos"), 2, n - 3))
    terms = F.when(n >= TERM_WORDS, paired(F.col("_fours"), F.col("_hashes"), 4, n - 4)).when(
        n > 0, F.array(F.xxhash64("_words"))).otherwise(F.array().cast("array<bigint>"))
    return (
        fours.withColumn("_terms", terms).withColumn("_votes", _votes(F.col("_terms")))
        .withColumn(name, _signs(F.col("_votes"), F.size("_terms"))).select(*kept, name)
    )


def _votes(terms: Column) -> Column:
    """32 sums; sum k counts the terms with bit k in its low half, bit k + 32 in its high
    half. A text holds fewer than 2**31 terms, so the halves never meet."""
    lanes = F.lit((1 << 32) | 1)
    zero = F.struct(*[F.lit(0).cast("bigint").alias(f"v{k}") for k in range(32)])
    return F.aggregate(terms, zero, lambda a, h: F.struct(*[
        (a[f"v{k}"] + F.shiftrightunsigned(h, k).bitwiseAND(lanes)).alias(f"v{k}") for k in range(32)]))


def _signs(votes: Column, total: Column) -> Column:
    out = F.lit(0).cast("bigint")
    for k in range(32):
        both = votes[f"v{k}"]
        for bit, ones in ((k, both.bitwiseAND(F.lit((1 << 32) - 1))), (k + 32, F.shiftrightunsigned(both, 32))):
            value = 1 << bit if bit < 63 else -(1 << 63)
            out = out.bitwiseOR(F.when(ones * 2 > total, F.lit(value)).otherwise(F.lit(0).cast("bigint")))
    return out


def hexed(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def likeness(one: Column, other: Column) -> Column:
    return 1 - F.bit_count(one.bitwiseXOR(other)) / F.lit(float(BITS))


def with_next(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``next_<column>`` from the next row in ascending doc_id order, the first row
    following the last.

    Rows go to blocks by id ranges of about equal size, found by one sketch of the ids.
    The first rows of a block also go to the block before it, so each block is complete
    in itself and rows are shuffled once. ``rows`` needs ``doc_id`` and ``text_hash``.
    """
    spark = rows.sparkSession
    blocks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.select("doc_id").agg(F.percentile_approx(
        "doc_id", [(i + 1) / blocks for i in range(blocks - 1)], 100 * blocks).alias("c")).first()["c"]
    edges = F.array(*[F.lit(c) for c in sorted(set(cuts or []))]).cast("array<bigint>")
    block = F.coalesce(F.size(F.filter(edges, lambda c: c < F.col("doc_id"))), F.lit(0))
    dealt = rows.withColumn("_block", block)
    firsts = sorted(
        (r["_block"], r["f"]["doc_id"]) for r in
        dealt.groupBy("_block").agg(F.min(F.struct("doc_id")).alias("f")).collect())  # a row per block
    own = [b for b, _ in firsts]
    at = F.col("_block")
    size = (max(own) + 1) if own else 1
    head, previous = [None] * size, [0] * size
    for i, (b, first) in enumerate(firsts):
        head[b], previous[b] = first, own[i - 1]
    is_head = F.get(F.array(*[F.lit(h).cast("bigint") for h in head]), at).eqNullSafe(F.col("doc_id"))
    before = F.get(F.array(*[F.lit(p) for p in previous]), at)
    lap = lambda where, n: F.struct(where.alias("_at"), F.lit(n).alias("_lap"))
    places = F.when(is_head, F.array(lap(at, 0), lap(before, 1))).otherwise(F.array(lap(at, 0)))
    spread = dealt.select("*", F.inline(places)).drop("_block")
    order = Window.partitionBy("_at").orderBy("_lap", F.asc_nulls_first("doc_id"), "text_hash")
    following = spread.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
    return following.filter(F.col("_lap") == 0).drop("_at", "_lap")


def edited(body: Column, following: Column) -> Column:
    """The text with its last half replaced by as much of the next text's beginning."""
    half = F.floor(F.length(body) / 2).cast("int")
    return F.concat(F.substring(body, 1, F.length(body) - half), F.substring(following, 1, half))


def piece_masks(pieces: int = PIECES) -> list[int]:
    edges = [BITS * i // pieces for i in range(pieces + 1)]
    return [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def within_radius(queries: DataFrame, index: DataFrame, radius: int = RADIUS, pieces: int = PIECES) -> DataFrame:
    """(query, found): the different fingerprints of ``index`` within ``radius`` of each
    different one of ``queries``, itself included; both have the column ``fingerprint``.

    A pair meets in every table whose pieces are all equal; it counts in the first of
    them only. That and the distance are part of the join, so what meets by chance is
    never a row.
    """
    masks = piece_masks(pieces)
    tables = list(combinations(range(pieces), pieces - radius))
    equal = F.array(*[F.lit(_signed(sum(masks[i] for i in t))) for t in tables])
    # Pieces that come before a table's last one and are not its own: all must differ.
    others = F.array(*[
        F.array(*[F.lit(_signed(masks[i])) for i in range(t[-1]) if i not in t]).cast("array<bigint>") for t in tables])

    def keyed(df: DataFrame, name: str) -> DataFrame:
        one = df.select("fingerprint").distinct()
        return one.select(F.col("fingerprint").alias(name), F.posexplode(equal).alias("table", "mask")).select(
            name, "table", F.col(name).bitwiseAND(F.col("mask")).alias("bits"))

    apart = F.col("query").bitwiseXOR(F.col("found"))
    first = F.forall(F.get(others, F.col("table")), lambda m: apart.bitwiseAND(m) != 0)
    return (
        keyed(queries, "query").join(keyed(index, "found"), ["table", "bits"])
        .filter((F.bit_count(apart) <= radius) & first).select("query", "found")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, next_fingerprint)."""
    rows = docs.select("doc_id", whole_text().alias("body")).withColumn("text_hash", F.xxhash64("body"))
    followed = with_next(with_fingerprint(rows, "body", "fingerprint"), ["body", "fingerprint"])
    both = with_fingerprint(
        followed.withColumn("edited", edited(F.col("body"), F.col("next_body"))).drop("next_body"),
        "edited", "edited_fingerprint")
    return both.select("doc_id", F.length("body").cast("bigint").alias("n_chars"),
                       F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       "fingerprint", "edited_fingerprint", "next_fingerprint")


def search(docs: DataFrame, is_query: Column, radius: int = RADIUS) -> DataFrame:
    """``docs`` (with ``fingerprint``) plus ``n_near``: for query rows the number of other
    rows within ``radius``, for the rest null."""
    index = docs.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n_docs"))
    found = within_radius(docs.filter(is_query), index, radius)
    near = (
        found.join(index.withColumnRenamed("fingerprint", "found"), "found")
        .groupBy(F.col("query").alias("fingerprint")).agg((F.sum("n_docs") - 1).alias("n_near"))
    )
    asked = docs.filter(is_query).join(near, "fingerprint").select(*docs.columns, "n_near")
    rest = docs.filter(~F.coalesce(is_query, F.lit(False))).withColumn("n_near", F.lit(None).cast("bigint"))
    return asked.unionByName(rest)


def described(docs: DataFrame) -> DataFrame:
    """Fingerprints of the whole table, written once."""
    return written(fingerprints(docs), "fingerprints")
