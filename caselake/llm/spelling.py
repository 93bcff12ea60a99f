"""Spelling variants: words that are one edit apart, found by FM-index search schemes.

Words are counted by Spark. Two words one edit apart agree in the first or in the second
half of the searched one, so each word is searched twice: its first half exactly, then
across the second with one error, and the same for words and index read backwards.
``fm_index`` does that on suffix-rank intervals of a delimited vocabulary.

The vocabulary is dealt over cells by (side, exact half): a word is put where searches of
like length look for it, under its own first (last) characters of the two half lengths that
a word one shorter, alike or one longer has. A cell holds about ``cell_chars`` characters
whatever the size of the vocabulary. A half that more words share is dealt over a grid,
parts of the words against parts of the searches, so it neither fills a task nor loses a
pair. A pair that both sides find is counted on the first.

A word's form is its near word of largest count, if that is at least ``ratio`` times its
own; so forms' counts rise and the chain to the root is short. It is followed by pointer
doubling, each round written to the shared folder. One word can be the form of no more
words than it has neighbours, which its length bounds.

Defined results: null and empty texts have no words; a null id is written as the empty
string before the colon; repeated rows count repeatedly; an empty table gives an empty
result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.llm.common import whole_text
from caselake.llm.fm_index import WordIndex
from caselake.session import written

# The letters of a word, and those that are lower-cased.
LETTERS = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class SpellingSpec:
    """Words of at least ``min_chars`` code points (2 or more) and ``min_count`` occurrences;
    a form has at least ``ratio`` times the count. ``drop_every``: where it divides the crc32
    of id and run, the run loses one letter first; None for none."""

    min_chars: int = 5
    min_count: int = 3
    ratio: int = 2
    drop_every: int | None = None
    cell_chars: int = 200_000


def word_counts(docs: DataFrame, spec: SpellingSpec) -> DataFrame:
    """(word, n) of all words that are long and frequent enough."""
    lowered = F.translate(whole_text(), UPPER, LOWER)
    runs = docs.select(F.col("doc_id"), F.explode(F.regexp_extract_all(lowered, F.lit(LETTERS), F.lit(0))).alias("run"))
    word = F.col("run")
    if spec.drop_every is not None:
        named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
        runs = runs.withColumn("h", F.crc32(named.cast("binary")))
        at = (F.col("h") % F.length("run")).cast("int")
        shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        word = F.when(F.col("h") % spec.drop_every == 0, shorter).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).filter(F.length("word") >= spec.min_chars)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= spec.min_count)


def _half(chars: Column | int, side: Column) -> Column:
    """Length of the exact half of a text of so many characters, by side."""
    return F.floor((chars + side) / F.lit(2)).cast("int")


def _cells(words: DataFrame, spec: SpellingSpec) -> DataFrame:
    """(cell, side, text, n, half, islot, slots, deal): rows to search with (``half`` not
    null) and rows to find, the text read backwards on side 1."""
    sides = words.select(
        "n", F.posexplode(F.array("word", F.reverse("word"))).alias("side", "text"),
    ).withColumn("chars", F.length("text")).withColumn("deal", F.xxhash64("text"))
    halves = F.array_distinct(F.array(*[_half(F.col("chars") + more, F.col("side")) for more in (-1, 0, 1)]))
    found = sides.withColumn("half", F.explode(halves)).withColumn("key", F.substring("text", F.lit(1), F.col("half")))
    total = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    cells = max(1, -(-4 * total // spec.cell_chars))
    crowded = found.groupBy("side", "key").agg(
        F.ceil(F.sum(F.col("chars") + 1) / F.lit(spec.cell_chars)).cast("int").alias("slots")).filter("slots > 1")
    crowded = written(crowded, "crowded-halves")
    searched = sides.withColumn("half", _half(F.col("chars"), F.col("side"))) \
        .withColumn("key", F.substring("text", F.lit(1), F.col("half")))

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        rows = rows.join(crowded, ["side", "key"], "left").withColumn("slots", F.coalesce("slots", F.lit(1)))
        rows = rows.withColumn(own, F.pmod("deal", "slots").cast("int"))
        return rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))

    both = dealt(found, "islot", "qslot").withColumn("half", F.lit(None).cast("int")).unionByName(
        dealt(searched, "qslot", "islot"))
    cell = F.pmod(F.xxhash64("side", "key", "islot", "qslot"), F.lit(cells)).cast("int")
    return both.select(cell.alias("cell"), "side", "text", "n", "half", "islot", "slots", "deal")


def _search(cell: pa.Table) -> pa.Table:
    """Per row to search with: how many words of its part are near, and the best of them."""
    side = cell.column("side").to_numpy()
    searching = cell.column("half").is_valid().to_numpy()
    out: list[tuple[str, int, int, int | None, str | None]] = []
    for at in (0, 1):
        rows = cell.filter(pa.array((side == at) & searching))
        queries = rows.column("text").to_pylist()
        if not queries:
            continue
        held = cell.filter(pa.array((side == at) & ~searching))
        texts = held.column("text").to_pylist()
        columns = zip(texts, held.column("n").to_pylist(), held.column("deal").to_pylist())
        words = sorted({text: (text, n, deal) for text, n, deal in columns}.values())
        half = rows.column("half").to_numpy()
        near: list[list[tuple[int, str]]] = [[] for _ in queries]
        if words:
            slots, islot = rows.column("slots").to_pylist(), rows.column("islot").to_pylist()
            index = WordIndex([text for text, _, _ in words])
            for q, w in zip(*map(np.ndarray.tolist, index.one_edit(queries, half.astype(np.int64)))):
                text, n, deal = words[w]
                if deal % slots[q] != islot[q]:
                    continue  # another part of the grid counts it
                if at:
                    query, text = queries[q][::-1], text[::-1]
                    if text.startswith(query[:len(query) // 2]):
                        continue  # found on the first side
                near[q].append((-n, text))
        for text, n, hits in zip(queries, rows.column("n").to_pylist(), near):
            best = min(hits, default=(None, None))
            out.append((text[::-1] if at else text, n, len(hits), best[0], best[1]))
    return pa.Table.from_pylist(
        [dict(zip(("word", "n", "n_near", "less", "best"), row)) for row in out],
        pa.schema([("word", pa.string()), ("n", pa.int64()), ("n_near", pa.int64()), ("less", pa.int64()),
                   ("best", pa.string())]))


def near_words(words: DataFrame, spec: SpellingSpec = SpellingSpec()) -> DataFrame:
    """(word, n, n_near, best, best_n) for every row of (word, n); words must differ."""
    searched = _cells(words, spec).groupBy("cell").applyInArrow(
        _search, "word string, n bigint, n_near bigint, less bigint, best string")
    best = F.min(F.when(F.col("best").isNotNull(), F.struct("less", "best"))).alias("top")
    return searched.groupBy("word").agg(F.first("n").alias("n"), F.sum("n_near").alias("n_near"), best).select(
        "word", "n", "n_near", F.col("top.best").alias("best"), (-F.col("top.less")).alias("best_n"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root): the last word of the chain that starts with each row of (word, form)."""
    links = written(links.select("word", F.col("form").alias("root")), "spelling-roots")
    moving = not links.isEmpty()
    while moving:
        following = links.select(F.col("word").alias("root"), F.col("root").alias("farther"))
        moved = written(links.join(following, "root", "left").select(
            "word", F.coalesce("farther", "root").alias("root"), F.col("farther").isNotNull().alias("moved")), "spelling-roots")
        moving = not moved.filter("moved").isEmpty()
        links = moved.select("word", "root")
    return links


def variant_groups(docs: DataFrame, spec: SpellingSpec = SpellingSpec()) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs``."""
    words = written(word_counts(docs, spec), "spelling-words")
    form = F.col("best_n") >= spec.ratio * F.col("n")
    formed = written(near_words(words, spec).select(
        "word", "n", "n_near", F.when(form, F.col("best")).alias("form"),
        F.when(form, F.col("best_n")).alias("form_n")), "spelling-forms")
    ends = roots(formed.filter("form is not null"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
