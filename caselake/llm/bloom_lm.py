"""Language-model scores from a log-frequency Bloom filter.

A count is quantised to a level of a growing scale; an n-gram of level L enters the
filter once per level up to L, and its level is read back by probing level after level
until one is missing. The filter holds words and word pairs (pairs met ``min_pair`` times
or more) and is built in segments by key hash. Up to ``max_bytes`` it is broadcast; a larger
one stays a table of segments, and the different n-grams of the texts are sent to their
segment and probed there. Both ways give the same levels. A token after the word h has the
probability

    (pair + prior * word) / (count of h + prior),   word = (c + 1) / total

where pair counts are rounded down, counts of h up, and ``total`` is the sum over the
quantised vocabulary, so probabilities never add up to more than 1 but for false hits.

The plain add-one score beside it needs exact counts. Those of the most frequent words,
a fixed number, are broadcast; the rest of a text's words joins the counts by key.

Bounds. The filter takes about 11.5 bits per entry and grows with the corpus, without a
limit; a segment holds about ``segment_entries``. Of each kind at most ``frequent`` n-grams
are known to every task, so what remains to be joined by key has no hot key.

Defined results: a null or empty text is the end token alone; a null id is trained on;
repeated rows count and are scored as often as they occur; without training rows every
token has count 0 and total 1. Words are told apart by 64-bit hashes. Only ``doc_id``
and ``text`` are read, so other columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from math import ceil, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.llm.common import slices, whole_text
from caselake.session import written

U = np.uint64
STEP = U(0x9E3779B97F4A7C15)
END = xxhash.xxh64_intdigest(b"\n")  # no word holds white space
BLOCK = 512  # bits, a cache line
START = xxhash.xxh64_intdigest(b"\n\n")


def scattered(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of unsigned 64-bit numbers; overflow is meant."""
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


@dataclass(frozen=True)
class FilterSpec:
    base: float = 1.5
    hashes: int = 8
    min_pair: int = 2
    prior: float = 1000.0
    max_bytes: int = 64 << 20
    segment_entries: int = 1 << 20
    frequent: int = 1 << 19

    def scale(self) -> np.ndarray:
        """Smallest count of every level, from level 1 on."""
        steps = [ceil(self.base ** i) for i in range(int(log(2.0 ** 62) / log(self.base)))]
        return np.array(sorted(set(steps)), np.int64)

    def level(self, counts: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.scale(), counts, side="right")


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return scattered(before * STEP + scattered(word ^ STEP))


def token_keys(text: bytes) -> np.ndarray:
    """Keys of the words, lower-cased in ASCII only, and of the end."""
    words = text.lower().split()
    words.append(b"\n")
    return np.fromiter(map(xxhash.xxh64_intdigest, words), U, len(words))


def _in_a_row(each: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, keys before, tokens per text) of the keys of several texts."""
    sizes = np.array([len(e) for e in each], np.int64)
    keys = np.concatenate(each)
    before = np.concatenate([np.array([START], U), keys[:-1]])
    before[np.cumsum(sizes)[:-1]] = START
    return keys, before, sizes


def _tokens(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _in_a_row([token_keys(b) for b in bodies])


def count_ngrams(bodies: DataFrame, buffered: int = 1 << 21) -> DataFrame:
    """(key, kind, n): words (kind 1) and pairs (kind 2); a task adds up runs of about
    ``buffered`` tokens before they are shuffled."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            keys, before = (np.concatenate(x) for x in zip(*held))
            for kind, found in ((1, keys), (2, pair_keys(before, keys))):
                different, n = np.unique(found, return_counts=True)
                for at in range(0, len(different), 1 << 16):
                    part = slice(at, at + (1 << 16))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(different[part].view(np.int64)),
                        pa.array(np.full(len(different[part]), kind, np.int8)), pa.array(n[part]),
                    ], ["key", "kind", "n"])

        for batch in batches:
            for part in slices(batch, "body", 1 << 21):
                keys, before, _ = _tokens(part.column("body").to_pylist())
                held.append((keys, before))
                size += len(keys)
                if size >= buffered:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    listed = bodies.mapInArrow(rows, "key bigint, kind tinyint, n bigint")
    return listed.groupBy("key", "kind").agg(F.sum("n").alias("n"))


@dataclass
class LogBloom:
    """The filter: ``bits`` per segment, a segment per range of keys."""

    spec: FilterSpec
    segments: int
    bits: int
    data: np.ndarray = field(repr=False)

    def place(self, keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first bit of the key's block, first place in it, step from place to place).

        All bits of a key and level lie in one block, so a look-up touches one cache line."""
        mixed = scattered(keys + U(level * 0xA24BAED4963EE407 & (1 << 64) - 1))
        block = ((mixed >> U(32)) * U(self.bits // BLOCK) >> U(32)).astype(np.int64)
        if self.segments > 1:
            block += (keys >> U(65 - self.segments.bit_length())).astype(np.int64) * (self.bits // BLOCK)
        low = (mixed & U(0xFFFFFFFF)).astype(np.int64)
        return block * BLOCK, low, low >> 9 | 1

    def has(self, keys: np.ndarray, level: int) -> np.ndarray:
        """Is the level of each key set? Bits are probed while all before were set."""
        out = np.zeros(len(keys), bool)
        left, (base, at, step) = np.arange(len(keys)), self.place(keys, level)
        for _ in range(self.spec.hashes):
            bit = base + (at & BLOCK - 1)
            hit = np.flatnonzero((self.data[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
            left, base, step = left[hit], base[hit], step[hit]
            at = at[hit] + step
            if not len(left):
                return out
        out[left] = True
        return out

    def levels(self, keys: np.ndarray, first: int = 1) -> np.ndarray:
        """Highest level set in a row from ``first`` on, 0 if none."""
        found, left, level = np.zeros(len(keys), np.int64), np.arange(len(keys)), first
        while len(left):
            left = left[self.has(keys[left], level)]
            found[left] = level
            level += 1
        return found


def _segment_rows(spec: FilterSpec, bits: int, first_pair: int):
    """Function from one segment's (segment, key, kind, n) to its filter bytes."""

    def build(rows: pa.Table) -> pa.Table:
        keys = rows.column("key").to_numpy().view(U)
        kind, n = rows.column("kind").to_numpy(), rows.column("n").to_numpy()
        level = spec.level(n)
        lowest = np.where(kind == 1, 1, first_pair)
        own = LogBloom(spec, 1, bits, np.empty(0, np.uint8))
        marks = np.zeros(bits, bool)
        for at in range(1, int(level.max()) + 1):
            now = keys[(level >= at) & (lowest <= at)]
            base, place, step = own.place(now, at)
            for i in range(spec.hashes):
                marks[base + (place + i * step & BLOCK - 1)] = True
        return pa.table({"segment": pa.array([rows.column("segment")[0].as_py()], pa.int64()),
                         "data": pa.array([np.packbits(marks, bitorder="little").tobytes()], pa.binary())})

    return build


@dataclass
class Model:
    """``hot_pairs`` and their levels are there only where the filter is a table."""

    spec: FilterSpec
    bloom: LogBloom
    first_pair: int
    tokens: int
    vocabulary: int
    total: float
    texts: int
    frequent_keys: np.ndarray
    frequent_counts: np.ndarray
    frequent_levels: np.ndarray | None = None
    hot_pairs: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    hot_pair_levels: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))


def segment_of(key: str, segments: int) -> Column:
    """Segment of a key: its highest bits, ``segments`` being a power of two."""
    return F.shiftrightunsigned(key, 65 - segments.bit_length()) if segments > 1 else F.lit(0).cast("bigint")


def train(bodies: DataFrame, spec: FilterSpec = FilterSpec()) -> tuple[Model, DataFrame, DataFrame | None]:
    """The model, the exact word counts (key, n), from all rows of ``bodies``, and the
    segments of the filter where it is too large for the driver, else None.

    Per level one row comes to the driver, and a filter of at most ``max_bytes``.
    """
    counts = written(count_ngrams(bodies).filter((F.col("kind") == 1) | (F.col("n") >= spec.min_pair)), "ngrams")
    words = counts.filter(F.col("kind") == 1).select("key", "n")
    scale = spec.scale()
    thresholds = F.array(*[F.lit(int(t)) for t in scale])
    level = F.size(F.filter(thresholds, lambda t: t <= F.col("n")))
    by_level = {(r["kind"], r["level"]): (r["grams"], r["mass"]) for r in counts.groupBy("kind", level.alias("level")).agg(
        F.count(F.lit(1)).alias("grams"), F.sum("n").alias("mass")).collect()}
    vocabulary = sum(g for (kind, _), (g, _) in by_level.items() if kind == 1)
    tokens = sum(m for (kind, _), (_, m) in by_level.items() if kind == 1)
    first_pair = int(spec.level(np.array([spec.min_pair]))[0])
    total = sum(g * (_middle(scale, lv) + 1) for (kind, lv), (g, _) in by_level.items() if kind == 1) + 1
    entries = sum(g * (lv if kind == 1 else lv - first_pair + 1) for (kind, lv), (g, _) in by_level.items())
    segments = 1 << max(0, ceil(entries / spec.segment_entries) - 1).bit_length()
    bits = max(1024, ceil(entries * spec.hashes / log(2) / segments / BLOCK) * BLOCK)
    built = counts.withColumn("segment", segment_of("key", segments)).groupBy("segment").applyInArrow(
        _segment_rows(spec, bits, first_pair), "segment bigint, data binary")

    def most_frequent(kind: int):
        """The n-grams from the lowest level on that leaves ``frequent`` at most: no sort."""
        kept, first = 0, len(scale)
        for lv in range(len(scale), 0, -1):
            kept += by_level.get((kind, lv), (0, 0))[0]
            if kept > spec.frequent:
                break
            first = lv
        return counts.filter((F.col("kind") == kind) & (F.col("n") >= int(scale[first - 1]))).select("key", "n")

    top = most_frequent(1).toPandas().sort_values("key")
    texts = sum(r["n"] for r in words.filter(F.col("key") == int(np.array([END], U).view(np.int64)[0])).collect())
    model = Model(spec, LogBloom(spec, segments, bits, np.empty(0, np.uint8)), first_pair, tokens, vocabulary, total,
                  texts, top["key"].to_numpy(np.int64), top["n"].to_numpy(np.int64))
    if segments * bits // 8 <= spec.max_bytes:
        model.bloom.data = data = np.zeros(segments * bits // 8, np.uint8)
        for row in built.collect():
            start = row["segment"] * (bits // 8)
            data[start:start + bits // 8] = np.frombuffer(row["data"], np.uint8)
        return model, words, None
    stored = written(built, "segments")

    def levels_of(hot: DataFrame, kind: int) -> tuple[np.ndarray, np.ndarray]:
        asked = hot.select("key", F.lit(kind).cast("tinyint").alias("kind"))
        found = probed(asked, stored, model).toPandas().sort_values("key")  # at most ``frequent`` rows
        return found["key"].to_numpy(np.int64), found["level"].to_numpy(np.int64)

    model.frequent_levels = levels_of(most_frequent(1), 1)[1]
    model.hot_pairs, model.hot_pair_levels = levels_of(most_frequent(2), 2)
    return model, words, stored


def probed(asked: DataFrame, stored: DataFrame, model: Model) -> DataFrame:
    """(key, kind, level) of the different n-grams ``asked`` (key, kind) that the filter
    knows; a task holds one segment and the keys asked of it, which are spread by hash."""
    bloom, first_pair = model.bloom, model.first_pair
    segment = segment_of("key", bloom.segments)

    def probe(asks: pa.Table, segments: pa.Table) -> pa.Table:
        if not segments.num_rows or not asks.num_rows:
            return asks.select(["key", "kind"]).slice(0, 0).append_column("level", pa.array([], pa.int32()))
        own = LogBloom(bloom.spec, 1, bloom.bits, np.frombuffer(segments.column("data")[0].as_py(), np.uint8))
        keys, pair = asks.column("key").to_numpy().view(U), asks.column("kind").to_numpy() == 2
        level = np.zeros(len(keys), np.int32)
        level[~pair], level[pair] = own.levels(keys[~pair]), own.levels(keys[pair], first_pair)
        return asks.select(["key", "kind"]).append_column("level", pa.array(level)).filter(pa.array(level > 0))

    return asked.withColumn("segment", segment).groupBy("segment").cogroup(stored.groupBy("segment")).applyInArrow(
        probe, "key bigint, kind tinyint, level int")


def _middle(scale: np.ndarray, level: int) -> float:
    return (float(scale[level - 1]) + float(scale[level]) - 1) / 2


def _places(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place among the sorted keys, whether the key is one)."""
    signed = keys.view(np.int64)
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, signed), len(sorted_keys) - 1)
    return at, sorted_keys[at] == signed


class Scorer:
    """Log10 probabilities of texts under a model, from levels of n-grams alone."""

    def __init__(self, model: Model):
        self.m, self.scale = model, model.spec.scale().astype(np.float64)
        if model.frequent_levels is None:  # looked up once per worker, which keeps the model
            model.frequent_levels = model.bloom.levels(model.frequent_keys.view(U))

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _places(self.m.frequent_keys, keys)

    def rest(self, keys: np.ndarray, kind: int) -> np.ndarray:
        """Levels of n-grams that are not known by themselves."""
        return self.m.bloom.levels(keys, 1 if kind == 1 else self.m.first_pair)

    def levels(self, keys: np.ndarray, kind: int) -> np.ndarray:
        m = self.m
        known, level = (m.frequent_keys, m.frequent_levels) if kind == 1 else (m.hot_pairs, m.hot_pair_levels)
        at, hit = _places(known, keys)
        out = np.zeros(len(keys), np.int64)
        out[hit] = level[at[hit]]
        out[~hit] = self.rest(keys[~hit], kind)
        return out

    def score(self, keys: np.ndarray, before: np.ndarray) -> np.ndarray:
        m = self.m
        known, back = np.unique(np.concatenate([keys, before]), return_inverse=True)
        level = self.levels(known, 1)
        low, next_low = np.append(0.0, self.scale)[level], self.scale[level]
        middle = np.where(level > 0, (low + next_low - 1) / 2, 0.0)
        upper = np.where(level > 0, next_low - 1, 0.0)
        own, past = back[:len(keys)], back[len(keys):]
        word = (middle[own] + 1) / m.total
        context = np.where(before == U(START), float(m.texts), upper[past])
        pairs, at = np.unique(pair_keys(before, keys), return_inverse=True)
        both = np.append(0.0, self.scale)[self.levels(pairs, 2)][at]
        both = np.minimum(both, np.minimum(context, upper[own]))  # a pair is no more frequent than its parts
        return np.log10((both + m.spec.prior * word) / (context + m.spec.prior))


class ToldScorer(Scorer):
    """A scorer that was told the levels of the rest: sorted keys and levels by kind."""

    told: dict[int, tuple[np.ndarray, np.ndarray]]

    def rest(self, keys: np.ndarray, kind: int) -> np.ndarray:
        at, hit = _places(self.told[kind][0], keys)
        return np.where(hit, self.told[kind][1][at], 0) if hit.any() else np.zeros(len(keys), np.int64)


def _judged(part: pa.RecordBatch, scorer: Scorer, keys: np.ndarray, before: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
    """Score, and base score as far as the most frequent words go, of every text."""
    unit = float(scorer.m.tokens + scorer.m.vocabulary + 1)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    logs = scorer.score(keys, before)
    signed, (at, hit) = keys.view(np.int64), scorer.places(keys)
    base = np.zeros(len(keys))
    base[hit] = np.log10((scorer.m.frequent_counts[at[hit]] + 1) / unit)
    rare = [signed[a:b][~hit[a:b]] for a, b in zip(edges, edges[1:])]
    ends = np.cumsum([0, *map(len, rare)], dtype=np.int32)
    return pa.RecordBatch.from_arrays([
        part.column("doc_id"), part.column("train"), pa.array(sizes),
        pa.array(np.add.reduceat(hit.astype(np.int64), edges[:-1])),
        pa.array(np.add.reduceat(base, edges[:-1])), pa.array(np.add.reduceat(logs, edges[:-1])),
        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rare))),
    ], ["doc_id", "train", "n_tokens", "hits", "hit_score", "score", "rare"])


JUDGED = ("doc_id bigint, train boolean, n_tokens bigint, hits bigint, hit_score double, score double, "
          "rare array<bigint>")


def _judged_by_table(rows: DataFrame, sent, stored: DataFrame) -> DataFrame:
    """The rows judged with levels from the table of segments.

    Per text its keys and its different n-grams to ask for are written; levels are found
    in the segments and come back to the text by its row number.
    """
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            for part in slices(batch, "body", 1 << 21):
                each, asked = [token_keys(b) for b in part.column("body").to_pylist()], []
                for own in each:
                    keys, before, _ = _in_a_row([own])
                    for kind, hot, all_ in ((1, m.frequent_keys, np.append(keys, before[0])), (2, m.hot_pairs, pair_keys(before, keys))):
                        grams = np.unique(all_)
                        grams = grams[~_places(hot, grams)[1]].view(np.int64)
                        asked.append((grams, np.full(len(grams), kind, np.int8)))
                ends = np.cumsum([0, *[len(a[0]) + len(b[0]) for a, b in zip(asked[::2], asked[1::2])]], dtype=np.int32)
                grams = pa.StructArray.from_arrays(
                    [pa.array(np.concatenate([a for a, _ in asked])), pa.array(np.concatenate([k for _, k in asked]))], ["key", "kind"])
                flat = pa.array(np.concatenate(each).view(np.int64))
                starts = np.cumsum([0, *map(len, each)], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("train"), pa.ListArray.from_arrays(pa.array(starts), flat),
                     pa.ListArray.from_arrays(pa.array(ends), grams)], ["doc_id", "train", "keys", "asked"])

    schema = "doc_id bigint, train boolean, keys array<bigint>, asked array<struct<key:bigint,kind:tinyint>>"
    texts = written(rows.mapInArrow(keyed, schema).withColumn("row", F.monotonically_increasing_id()), "keyed")
    asked = texts.select("row", F.inline("asked"))
    found = written(probed(asked.select("key", "kind").distinct(), stored, sent.value), "levels")
    told = asked.join(found, ["key", "kind"]).groupBy("row").agg(
        F.collect_list(F.struct("kind", "key", "level")).alias("told"))  # of one text

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = ToldScorer(sent.value)
        for batch in batches:
            for row in range(batch.num_rows):
                part = batch.slice(row, 1)
                each = part.column("told").flatten()
                kind, key, level = (each.field(c).to_numpy(zero_copy_only=False) for c in ("kind", "key", "level"))
                scorer.told = {}
                for k in (1, 2):
                    own = np.flatnonzero(kind == k)
                    own = own[np.argsort(key[own])]
                    scorer.told[k] = key[own], level[own].astype(np.int64)
                own = part.column("keys").flatten().to_numpy(zero_copy_only=False).view(U)
                yield _judged(part, scorer, *_in_a_row([own]))

    return texts.drop("asked").join(told, "row", "left").mapInArrow(judged, JUDGED)


def score(docs: DataFrame, train_on: Column, spec: FilterSpec = FilterSpec()) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): held_out, n_tokens, n_known, train_tokens,
    base_score and score; ``train_on`` tells the rows to learn from."""
    rows = docs.select("doc_id", whole_text().cast("binary").alias("body"), F.coalesce(train_on, F.lit(True)).alias("train"))
    model, words, stored = train(rows.filter("train").select("body"), spec)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # the filter in it: at most ``max_bytes``
    unit = float(model.tokens + model.vocabulary + 1)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            for part in slices(batch, "body", 1 << 21):
                yield _judged(part, scorer, *_tokens(part.column("body").to_pylist()))

    scored = rows.mapInArrow(judged, JUDGED) if stored is None else _judged_by_table(rows, sent, stored)
    # The row number tells equal rows apart; it is written, so that it stays the same.
    done = written(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    open_words = done.select("row", F.explode("rare").alias("key")).groupBy("row", "key").agg(
        F.count(F.lit(1)).alias("times"))
    c = F.coalesce("n", F.lit(0))
    rest = open_words.join(words, "key", "left").groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more"),
        F.sum(F.col("times") * F.log10((c + 1) / F.lit(unit))).alias("rest_score"))
    return done.drop("rare").join(rest, "row", "left").select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens",
        (F.col("hits") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("hit_score") + F.coalesce("rest_score", F.lit(0.0))).alias("base_score"), "score",
    )
