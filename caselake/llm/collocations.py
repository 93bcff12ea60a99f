"""Phrases whose words stand together more often than their parts' counts suggest.

Each task counts the phrases of its texts, a bounded number of words at a time, and builds
from the sorted phrases one count automaton per language and range of phrases
(``count_automata``). Automata of a range meet in one task, which adds them up and keeps the
phrases that are frequent enough. Candidates then ask for the counts of their parts: those
of first parts are on their own path, those of the rest lie in other ranges, where the
sorted requests are composed with the range's automaton.

Ranges are cut at phrases taken from a bounded sample of documents (``sample_docs``, of
each ``sample_keys`` places); the sample only balances the ranges. A range is bounded by
whole phrases, so a very common first word, or pair, is spread over many ranges; a range
that more than ``requests`` requests ask is read by as many tasks as these fill. The list of
bounds reaches every task: one phrase per ``range_bytes`` of text, 4,000 at 30 GB. Beyond
some ten TB, raise ``range_bytes`` and ``chunk_words`` with the memory of a task.

Arithmetic is exact: products of counts below 10^13 are decimals of up to 38 digits, and
a larger count is an error.

Defined results: a null text is empty, a null language is ``und``; null ids and repeated
rows count like others; an empty table gives an empty result. Only the text and the
language are read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caselake.llm.common import whole_text
from caselake.llm.count_automata import CountAutomaton, count_levels, split, summed
from caselake.session import written

# Bytes that end a piece. Words are what stands between blanks and tabs.
ENDS = b".,;:!?\n\x0b\x0c\r"
_END = b"\xff"  # in no UTF-8 text
_PLAIN = bytes.maketrans(ENDS + b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", _END * len(ENDS) + b"abcdefghijklmnopqrstuvwxyz")
SLICE_BYTES = 1 << 20


@dataclass(frozen=True)
class PhraseSpec:
    """Phrases of 2 to ``max_words`` words met at least ``min_count`` times; the ``top`` best
    of each language. A candidate goes where a longer one that holds it has at least
    ``covered`` percent of its count."""

    max_words: int = 3
    min_count: int = 10
    top: int = 2000
    covered: int = 50
    chunk_words: int = 1_500_000
    range_bytes: int = 8_000_000
    requests: int = 400_000
    sample_docs: int = 2_000
    sample_keys: int = 32


def words_of(bodies: list[bytes]) -> list[bytes]:
    """Words of all texts in order, ``_END`` behind each piece."""
    return (_END.join(bodies) + _END).translate(_PLAIN).replace(_END, b" " + _END + b" ").split()


class Chunk:
    """Words of some texts by language, as numbers."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {_END: 0}
        self.texts: dict[str, list[np.ndarray]] = {}
        self.size = 0

    def add(self, lang: str, bodies: list[bytes]) -> None:
        words = words_of(bodies)
        for word in set(words) - self.number.keys():
            self.number[word] = len(self.number)
        self.texts.setdefault(lang, []).append(np.fromiter(map(self.number.__getitem__, words), np.int64, len(words)))
        self.size += len(words)

    def automata(self, bounds: dict[str, list[tuple[bytes, ...]]], depth: int) -> Iterator[tuple[str, int, bytes]]:
        """(language, range, packed automaton)."""
        words = list(self.number)
        for lang, parts in self.texts.items():
            ids = np.concatenate(parts)
            used = sorted(words[i] for i in np.unique(ids).tolist() if i)
            label = np.full(len(words), -1, np.int64)
            label[[self.number[word] for word in used]] = np.arange(len(used))
            levels = count_levels(label[ids], len(used), depth)
            for number, cut in split(used, levels, bounds.get(lang, [])):
                yield lang, number, CountAutomaton.of(used, cut).packed()


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list[str], list[bytes]]]:
    """Languages and bodies of runs of rows, cut after ``SLICE_BYTES`` of text."""
    upto = np.cumsum(pc.binary_length(batch.column("body")).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = upto[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(upto, before + SLICE_BYTES, "right")))
        part = batch.slice(start, stop - start)
        yield part.column("lang").to_pylist(), part.column("body").to_pylist()
        start = stop


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), whole_text().cast("binary").alias("body"))


def range_bounds(docs: DataFrame, spec: PhraseSpec) -> dict[str, list[tuple[bytes, ...]]]:
    """Per language the sorted phrases at which a range begins, from a sample of documents."""
    texts = _texts(docs)
    n, size = texts.agg(F.count(F.lit(1)), F.sum(F.octet_length("body"))).first()
    wanted = (size or 0) // spec.range_bytes
    if not wanted:
        return {}
    every = max(1, n // spec.sample_docs)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for langs, bodies in _slices(batch):
                for lang, body in zip(langs, bodies):
                    words = words_of([body])
                    step = max(1, -(-len(words) // spec.sample_keys))
                    keys = []
                    for at in range(0, len(words), step):
                        phrase = words[at:at + spec.max_words]
                        phrase = phrase[:phrase.index(_END)] if _END in phrase else phrase
                        if phrase:
                            keys.append(b" ".join(phrase))
                    # A key stands for the words between two of them.
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(keys), pa.string()), pa.array(keys, pa.binary()),
                         pa.array([step] * len(keys), pa.int64())], ["lang", "key", "weight"])

    chosen = texts.filter(F.pmod(F.xxhash64("body"), F.lit(every)) == 0)
    sample = chosen.mapInArrow(rows, "lang string, key binary, weight bigint")
    keys = sorted((r["lang"], tuple(bytes(r["key"]).split(b" ")), r["weight"]) for r in sample.collect())
    share = sum(weight for *_, weight in keys) / (wanted + 1)
    bounds: dict[str, set[tuple[bytes, ...]]] = {}
    passed = 0
    for lang, key, weight in keys:
        if (passed + weight) // share > passed // share:
            bounds.setdefault(lang, set()).add(key)
        passed += weight
    return {lang: sorted(found) for lang, found in bounds.items()}


def shard_automata(docs: DataFrame, bounds: dict, spec: PhraseSpec) -> DataFrame:
    """(lang, range, automaton): counts of the phrases of a chunk of texts in a range."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed(chunk: Chunk) -> Iterator[pa.RecordBatch]:
            for row in chunk.automata(bounds, spec.max_words):
                yield pa.RecordBatch.from_pylist([dict(zip(("lang", "range", "automaton"), row))], schema)

        schema = pa.schema([("lang", pa.string()), ("range", pa.int32()), ("automaton", pa.binary())])
        chunk = Chunk()
        for batch in batches:
            for langs, bodies in _slices(batch):
                for lang in dict.fromkeys(langs):
                    chunk.add(lang, [body for own, body in zip(langs, bodies) if own == lang])
                if chunk.size >= spec.chunk_words:
                    yield from closed(chunk)
                    chunk = Chunk()
        yield from closed(chunk)

    return _texts(docs).mapInArrow(rows, "lang string, range int, automaton binary")


def range_automata(shards: DataFrame, bounds: dict, spec: PhraseSpec) -> DataFrame:
    """(lang, range, n, automaton): all word occurrences whose word is in the range, and the
    frequent phrases of the range with what they begin with."""
    schema = pa.schema([("lang", pa.string()), ("range", pa.int32()), ("n", pa.int64()), ("automaton", pa.binary())])

    def union(group: pa.Table) -> pa.Table:
        lang, number = group.column("lang")[0].as_py(), group.column("range")[0].as_py()
        words, levels = [], []
        for start in range(0, group.num_rows, 64):
            packed = group.column("automaton").slice(start, 64).to_pylist()
            opened = [(a.words, a.levels()) for a in map(CountAutomaton.unpacked, packed)]
            words, levels = summed([(words, levels), *opened] if levels else opened)
        n = int(levels[0][2].sum()) if levels else 0
        lower = bounds[lang][number - 1] if number else ()
        if len(lower) > 1 and levels and words[levels[0][1][0]] == lower[0]:
            n -= int(levels[0][2][0])  # only the way to the range's phrases
        kept, above = [], np.zeros(1, np.int64)
        for parent, label, count in levels:  # a phrase is as frequent as what it begins with or less
            frequent = count >= spec.min_count
            kept.append((above[parent[frequent]], label[frequent], count[frequent]))
            above = np.cumsum(frequent) - 1
        automaton = CountAutomaton.of(words, kept).packed()
        return pa.Table.from_pylist([{"lang": lang, "range": number, "n": n, "automaton": automaton}], schema)

    return shards.groupBy("lang", "range").applyInArrow(union, "lang string, range int, n bigint, automaton binary")


def part_requests(ranges: DataFrame, bounds: dict) -> DataFrame:
    """(lang, range, rest, phrase, a, k, l): for every cut of every candidate, after its
    first ``k`` words, the rest and the range to ask for its count."""
    names = ("lang", "range", "rest", "phrase", "a", "k", "l")
    schema = pa.schema(list(zip(names, (pa.string(), pa.int32(), pa.string(), pa.string(), *[pa.int64()] * 3))))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from asked(row["lang"], row["range"], CountAutomaton.unpacked(row["automaton"]))

    def asked(lang: str, number: int, automaton: CountAutomaton) -> Iterator[pa.RecordBatch]:
        own = bounds.get(lang, [])
        lower = own[number - 1] if number else ()
        out: list[tuple] = []
        above: list[tuple[tuple[bytes, ...], tuple[int, ...]]] = [((), ())]
        for parent, label, count in automaton.levels():
            here = []
            for p, w, a in zip(parent.tolist(), label.tolist(), count.tolist()):
                phrase, counts = above[p][0] + (automaton.words[w],), above[p][1] + (a,)
                here.append((phrase, counts))
                if len(phrase) > 1 and phrase >= lower:
                    text = b" ".join(phrase).decode()
                    for k in range(1, len(phrase)):
                        rest = phrase[k:]
                        out.append((lang, bisect_right(own, rest), b" ".join(rest).decode(), text, a, k, counts[k - 1]))
            above = here
        for start in range(0, len(out), 20_000):
            part = out[start:start + 20_000]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), schema.types)], schema=schema)

    return ranges.mapInArrow(rows, "lang string, range int, rest string, phrase string, a bigint, k bigint, l bigint")


def answered(ranges: DataFrame, requests: DataFrame, spec: PhraseSpec) -> DataFrame:
    """The requests with ``r``, the count of the rest: (lang, phrase, a, k, l, r)."""
    crowded = written(
        requests.groupBy("lang", "range").count().filter(F.col("count") > spec.requests)
        .select("lang", "range", F.ceil(F.col("count") / F.lit(spec.requests)).cast("int").alias("tasks")), "crowded-ranges")
    tasks = F.coalesce("tasks", F.lit(1))
    asking = requests.join(crowded, ["lang", "range"], "left").withColumn("task", F.pmod(F.xxhash64("phrase", "k"), tasks).cast("int"))
    asked = ranges.join(crowded, ["lang", "range"], "left").withColumn("task", F.explode(F.sequence(F.lit(0), tasks - 1)))

    def compose(automata: pa.Table, group: pa.Table) -> pa.Table:
        rests = [rest.encode().split(b" ") for rest in group.column("rest").to_pylist()]
        if not rests:
            found = np.zeros(0, np.int64)
        else:
            found = CountAutomaton.unpacked(automata.column("automaton")[0].as_py()).count_of(rests)
        return group.select(["lang", "phrase", "a", "k", "l"]).append_column("r", pa.array(found, pa.int64()))

    key = ["lang", "range", "task"]
    return asked.select(*key, "automaton").groupBy(*key).cogroup(
        asking.select(*key, "rest", "phrase", "a", "k", "l").groupBy(*key)
    ).applyInArrow(compose, "lang string, phrase string, a bigint, k bigint, l bigint, r bigint")


def candidates(cuts: DataFrame, spec: PhraseSpec) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates that no longer one covers, each by
    its lowest-scoring cut."""
    wide = [F.col(c).cast("decimal(13,0)") for c in "alr"]
    million = F.lit(1_000_000).cast("decimal(7,0)")
    parts = cuts.withColumn("up", million * wide[0] * wide[0]).withColumn("down", wide[1] * wide[2])
    scored = parts.withColumn("score", F.expr("up div down")).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r", "a")).alias("cut"))
    scored = written(scored.select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.score"), "phrases")
    if spec.max_words < 3:
        return scored
    split_ = scored.select("lang", "a", F.split("phrase", " ").alias("words")).filter(F.size("words") > 2)
    sizes = F.sequence(F.lit(2), F.size("words") - 1)
    inside = split_.withColumn("size", F.explode(sizes)).withColumn(
        "at", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)))
    inside = inside.select("lang", F.array_join(F.slice("words", F.col("at"), F.col("size")), " ").alias("phrase"), "a")
    most = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = F.col("longer").isNull() | (100 * F.col("longer") < spec.covered * F.col("a"))
    return scored.join(most, ["lang", "phrase"], "left").filter(kept).drop("longer")


def best(scored: DataFrame, top: int) -> DataFrame:
    """``scored`` with ``rank``: the first ``top`` of each language by score descending, count
    descending and phrase.

    Histograms of the scores, then of the counts within the last score, say which rows can be
    among them, so a language's candidates are not sorted in one task. A score is at most
    10^6. Of rows equal in both, parts keep their first by phrase before they meet.
    """
    scored = written(scored, "scored-phrases")

    def narrowed(rows: DataFrame, above: list[str], by: str) -> DataFrame:
        steps = rows.groupBy("lang", *above, "before", by).agg(F.count(F.lit(1)).alias("equal"))
        running = Window.partitionBy("lang", *above).orderBy(F.col(by).desc())
        here = steps.withColumn("ahead", F.col("before") + F.sum("equal").over(running) - F.col("equal"))
        here = here.filter(F.col("ahead") < top).select("lang", *above, by, "ahead", "equal")
        return rows.drop("before", "equal").join(here, ["lang", *above, by]).withColumnRenamed("ahead", "before")

    rows = narrowed(scored.withColumn("before", F.lit(0).cast("bigint")), [], "score")
    rows = narrowed(rows, ["score"], "a")
    parts = F.ceil(F.col("equal") / F.lit(50_000))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), parts))
    within = Window.partitionBy("lang", "score", "a", "part").orderBy("phrase")
    rows = rows.withColumn("place", F.row_number().over(within)).filter(F.col("before") + F.col("place") <= top)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= top)
    return ranked.drop("before", "equal", "part", "place")


def collocations(docs: DataFrame, spec: PhraseSpec = PhraseSpec()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language."""
    bounds = range_bounds(docs, spec)
    ranges = written(range_automata(shard_automata(docs, bounds, spec), bounds, spec), "phrase-ranges")
    requests = written(part_requests(ranges.select("lang", "range", "automaton"), bounds), "part-requests")
    cuts = answered(ranges.select("lang", "range", "automaton"), requests, spec)
    words = ranges.groupBy("lang").agg(F.sum("n").alias("n"))
    return best(candidates(cuts, spec), spec.top).join(words, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
