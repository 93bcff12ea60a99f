"""N-gram Jaccard join: groups of documents linked by near-equal shingle sets.

Method. The universe of shingle hashes is cut into segments. Two sets that reach the
similarity differ in at most H shingles, so when segment thresholds e (0: equal
subsets, 1: at most one shingle more on one side) satisfy sum(e + 1) > H, some segment
agrees within its threshold (pigeonhole). Every set puts one key per segment into an
index, plus its one-deletion neighbourhood where e is 1. H depends on the size, so
sets are dealt to size bands; a set also joins the band below when a partner may be
there. How many segments take e = 1, or how many are added beyond those needed, is
chosen per band from the corpus' own band counts: more keys, or more chance meetings.
What meets is verified exactly on words.

Frequent keys. With segments to spare, linked sets share more keys than one. A set that
shares more than k keys with any set it is linked with gives up the k keys that most sets
have, in one order for all sets (prefix filter): the rarest key that two linked sets share
is then kept by both. That rids nearly all sets of the keys of empty segments, which a
fixed part of all sets shares, and of those of common passages.

Exactness without all pairs. Equal sets are one node. First every node is verified
against the node it shares most keys with (the smallest of a bucket), which joins
nearly all groups. Then, in buckets that still hold several components, all pairs of
different components are verified, except those that a parity sketch proves too far
apart. A link that is never tested lies inside a component already.

Defined results: a null or empty text, or one without words, has an empty set and is
linked with nothing. Rows with a null id are linked with nothing and have a null
component. Rows with one id are one node, linked by the text of any of them. Repeated
rows give repeated result rows. Only ``doc_id`` and ``text`` are read, so other
columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.llm.common import whole_text
from caselake.session import written

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class JaccardSpec:
    """Shingles of ``words`` words; linked when ``den`` * common >= ``num`` * union.

    ``meeting_cost`` is what one chance meeting costs against one index row.
    """

    words: int = 5
    num: int = 80
    den: int = 100
    meeting_cost: float = 1 / 150

    def max_difference(self, total: int) -> int:
        """Most shingles in one of two linked sets only, whose sizes add up to ``total``."""
        return total * (self.den - self.num) // (self.den + self.num)

    @property
    def band_ratio(self) -> float:
        return (self.den / self.num) ** 2


def mixed(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of unsigned 64-bit numbers; overflow is meant."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_words(text: bytes, n: int) -> set[tuple[bytes, ...]]:
    """The shingles themselves; bytes.lower and bytes.split know ASCII only, as wanted."""
    words = text.lower().split()
    if len(words) < n:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(n)]))


def shingle_hashes(text: bytes, n: int) -> np.ndarray:
    """Sorted different hashes of the shingles of a text."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(n, len(words))
    out = np.full(len(words) - width + 1, np.uint64(width))
    for i in range(width):
        out = mixed(out * GOLDEN + hashes[i:len(hashes) - width + 1 + i])
    return np.unique(out)


def parity_sketch(tokens: np.ndarray, spec: JaccardSpec) -> np.ndarray:
    """Bit vector in which every token flips one bit: sketches of two sets differ in at
    most as many bits as the sets differ in tokens. Its length, a power of two of 64-bit
    words, follows the size; a longer one folds to a shorter one by halves."""
    words = max(4, -(-3 * spec.max_difference(2 * len(tokens)) // 64))
    length = 64 << (words - 1).bit_length()
    at = (mixed(tokens ^ GOLDEN) >> np.uint64(20)).astype(np.int64) & (length - 1)
    return np.packbits((np.bincount(at, minlength=length) & 1).astype(np.uint8)).view(np.int64)


def describe(docs: DataFrame, spec: JaccardSpec) -> DataFrame:
    """(doc_id, n_shingles, digest, sketch): the digest is the same for equal sets only."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(t, spec.words) for t in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary()),
                _lists([parity_sketch(s, spec) for s in sets]),
            ], ["doc_id", "n_shingles", "digest", "sketch"])

    return docs.mapInArrow(rows, "doc_id bigint, n_shingles bigint, digest binary, sketch array<bigint>")


def _lists(arrays: Sequence[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *arrays])))


@dataclass(frozen=True)
class Band:
    """One size band with its index layout; ``upper``: sizes up to it join from above."""

    low: int
    high: int
    upper: int
    segments: int
    one_deletion: int

    def spare(self, size: int, spec: JaccardSpec) -> int:
        """Keys a set of this size shares with every set of the band it is linked with,
        less one. Segments that do not agree differ in one shingle at least, in two
        where one deletion is allowed."""
        partner = size * spec.den // spec.num if size <= self.high else self.high
        most, exact = spec.max_difference(size + partner), self.segments - self.one_deletion
        return max(0, self.segments - 1 - min(most, exact) - max(0, most - exact) // 2)


def beyond(mean: float, spare: int) -> float:
    """Expected excess over ``spare`` of a Poisson number."""
    return mean - spare + sum((spare - k) * exp(k * log(mean) - mean - lgamma(k + 1)) for k in range(spare))


def bands(spec: JaccardSpec, sizes: list[tuple[int, int]]) -> list[Band]:
    """Bands over the sizes found, with the cheapest layout for the sets in each.

    ``sizes``: (log-scale class, sets); one row per class, so a few hundred at most.
    """
    ratio, out, low = spec.band_ratio, [], 1
    top = max((int(2 ** ((c + 1) / 4)) + 1 for c, _ in sizes), default=0)
    while low <= top:
        high = max(low, int(low * ratio))
        upper = high * spec.den // spec.num
        here = sum(n for c, n in sizes if low <= 2 ** (c / 4) * 1.09 <= upper)
        most = spec.max_difference(high + upper)
        middle = (low + high) / 2

        def cost(ones: int, spare: int, most: int = most, middle: float = middle, here: int = here) -> float:
            segments = most + 1 - ones + spare
            load = middle / segments
            # Empty segments, whose keys meet by chance, beyond those a set gives up.
            left = max(0.0, beyond(segments * exp(-load), spare)) / segments
            meetings = here * left * left * (segments - ones + ones * (1 + 2 * load))
            return segments + ones * load + spec.meeting_cost * meetings

        choices = range(0, most // 2 + 1, max(1, most // 64))
        ones, spare = min([(n, 0) for n in choices] + [(0, n) for n in choices], key=lambda c: cost(*c))
        out.append(Band(low, high, upper, most + 1 - ones + spare, ones))
        low = high + 1
    return out


def segment_keys(tokens: np.ndarray, band: Band, at: int) -> np.ndarray:
    """Index keys of a set in band number ``at``: one per segment, then deletions.

    The tokens are sorted, so a segment is a run of them, and its key is a sum of
    their hashes, from which one is taken away for each deletion.
    """
    m = np.uint64(band.segments)
    place = ((tokens >> np.uint64(32)) * m) >> np.uint64(32)
    edges = np.searchsorted(place, np.arange(band.segments + 1, dtype=np.uint64))
    scattered = mixed(tokens + GOLDEN)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(scattered, dtype=np.uint64)])
    whole = sums[edges[1:]] - sums[edges[:-1]]
    salt = mixed(np.arange(band.segments, dtype=np.uint64) + np.uint64(at << 32) + GOLDEN)
    keys = [mixed(whole ^ salt)]
    if band.one_deletion:
        cut = edges[band.one_deletion]
        own = place[:cut].astype(np.int64)
        keys.append(mixed((whole[own] - scattered[:cut]) ^ salt[own]))
    return np.unique(np.concatenate(keys))


def places(size: int, layout: list[Band]) -> list[int]:
    """Numbers of the bands a set of this size is indexed in."""
    return [i for i, b in enumerate(layout) if b.low <= size <= b.upper]


def index_rows(docs: DataFrame, layout: list[Band], spec: JaccardSpec) -> DataFrame:
    """(doc_id, digest, band, spare, keys): a row per document and band."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part, out = batch.slice(start, 500), []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("body").to_pylist()):
                    tokens = shingle_hashes(text, spec.words)
                    digest = xxhash.xxh128_digest(tokens.tobytes())
                    for at in places(len(tokens), layout):
                        out.append((doc_id, digest, at, layout[at].spare(len(tokens), spec),
                                    segment_keys(tokens, layout[at], at).view(np.int64)))
                columns = list(zip(*out)) or [()] * 5
                yield pa.RecordBatch.from_arrays([
                    pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()),
                    pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int32()), _lists(columns[4]),
                ], ["doc_id", "digest", "band", "spare", "keys"])

    return docs.mapInArrow(rows, "doc_id bigint, digest binary, band int, spare int, keys array<bigint>")


def meeting_rows(keyed: DataFrame) -> DataFrame:
    """(key, node) of the index rows that can meet, without the keys that sets give up."""
    # Copies of a set would only repeat its keys: one row per set and band goes on.
    firsts = keyed.groupBy("digest", "band").agg(F.min(F.struct("doc_id", "spare", "keys")).alias("first"))
    entries = firsts.select(
        F.explode("first.keys").alias("key"), F.col("first.doc_id").alias("node"),
        F.xxhash64("digest", "band").alias("set"), F.col("first.spare").alias("spare"))
    bucket = Window.partitionBy("key")
    shared = entries.withColumn("sets", F.count(F.lit(1)).over(bucket)).filter(F.col("sets") > 1)
    # The order must be the same for all sets, so equal counts go by key.
    frequent = Window.partitionBy("node", "set").orderBy(F.desc("sets"), "key")
    return shared.withColumn("place", F.row_number().over(frequent)).filter(
        F.col("place") > F.col("spare")).select("key", "node")


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Join both texts to pairs (a, b). ``b`` may be the partner of very many: such a
    hub's text goes to 32 salted places, and its pairs are dealt over them."""
    salts, heavy = 32, 500
    hubs = (
        pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > heavy)
        .select("b", F.lit(salts).alias("salts"))
    )
    salted = pairs.join(hubs, "b", "left").select(
        "a", "b", F.pmod(F.xxhash64("a"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt"))
    ends = pairs.select("b").distinct().join(hubs, "b", "left").select(
        "b", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"))
    text_of = lambda name: texts.select(F.col("doc_id").alias(name), F.col("body").alias(f"text_{name}"))
    return (
        salted.join(text_of("a"), "a")
        .join(ends.join(text_of("b"), "b"), ["b", "salt"])
        .select("a", "b", "text_a", "text_b")
    )


def verified(pairs: DataFrame, texts: DataFrame, spec: JaccardSpec) -> DataFrame:
    """The pairs whose shingle sets, compared word by word, reach the similarity."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
                one, other = shingle_words(x, spec.words), shingle_words(y, spec.words)
                common = len(one & other)
                keep.append(common > 0 and spec.den * common >= spec.num * (len(one) + len(other) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _with_texts(pairs, texts).mapInArrow(rows, "a bigint, b bigint")


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable over ``edges`` (a, b), for every node.

    Labels move along edges and then jump to the label's own label, so that long
    chains take few rounds. Every round is written to the shared folder, which cuts
    the lineage; only a count of changes reaches the driver.
    """
    both = written(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "links")
    touched = both.select(F.col("a").alias("node")).distinct()
    labels = written(touched.withColumn("comp", F.col("node")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("comp").alias("near"))
        moved = labels.join(near, "node").select("node", F.col("comp").alias("old"),
                                                 F.least("comp", "near").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("comp").alias("far"))
        after = written(
            moved.join(jump, "to").select("node", "old", F.least("to", "far").alias("comp")), "labels")
        labels = after.select("node", "comp")
        if after.filter(F.col("old") != F.col("comp")).isEmpty():
            break
    return nodes.join(labels, "node", "left").select("node", F.coalesce("comp", "node").alias("comp"))


def link_groups(docs: DataFrame, spec: JaccardSpec = JaccardSpec()) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text)."""
    bodies = docs.select("doc_id", whole_text().cast("binary").alias("body"))
    sets = written(describe(bodies, spec), "shingle-sets")
    real = sets.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    # Nodes: the smallest id of each different set.
    classes = written(real.groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.max("n_shingles").alias("n"), F.any_value("sketch").alias("sketch"),
    ), "set-classes")
    size_class = F.floor(F.log2("n") * 4).cast("int")
    sizes = [(r["c"], r["count"]) for r in classes.groupBy(size_class.alias("c")).count().collect()]
    layout = bands(spec, sizes)  # classes are logarithmic: a few hundred rows at most

    keyed = index_rows(bodies.filter(F.col("doc_id").isNotNull()), layout, spec)
    bucket = Window.partitionBy("key")
    members = written(
        meeting_rows(keyed).withColumn("first", F.min("node").over(bucket)).withColumn("last", F.max("node").over(bucket))
        .filter(F.col("first") < F.col("last")).select("key", "node", "first"), "buckets")

    # Round one: each node with the bucket head it meets most often, if more than once.
    meets = members.filter(F.col("node") != F.col("first")).groupBy("node", "first").agg(
        F.count(F.lit(1)).alias("times"))
    heads = (
        meets.filter(F.col("times") > 1).groupBy(F.col("node").alias("a"))
        .agg(F.min(F.struct((-F.col("times")).alias("t"), F.col("first").alias("b"))).alias("best"))
        .select("a", "best.b")
    )
    nodes = classes.select("node").distinct()
    texts = bodies.join(nodes.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi")
    # An id with several texts ties their sets together.
    tied = real.join(classes, "digest").groupBy("doc_id").agg(F.collect_set("node").alias("own")).filter(
        F.size("own") > 1).select(F.explode("own").alias("a"), F.array_min("own").alias("b"))
    stars = written(verified(heads, texts, spec).unionByName(tied), "stars")
    early = written(components(stars, nodes), "components")

    # Round two: pairs of different components in one bucket, unless proven far apart.
    rest = written(_open_pairs(members, early, classes, spec), "open-pairs")
    final = early
    if not rest.isEmpty():
        final = components(stars.unionByName(verified(rest, texts, spec)), nodes)
    ids = classes.join(final, "node").select("digest", "comp")
    return sets.join(ids, "digest", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id")).alias("component_id"))


def _differing_bits(one: Column, other: Column) -> Column:
    """Bits in which two sketches differ, the longer one folded to the shorter one."""

    def folded(sketch: Column, to: Column) -> Column:
        half = F.shiftright(F.size(sketch), 1)
        halves = F.zip_with(F.slice(sketch, F.lit(1), half), F.slice(sketch, half + 1, half),
                            lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(sketch) > F.size(to), halves).otherwise(sketch)

    both = F.zip_with(folded(one, other), folded(other, one), lambda x, y: x.bitwiseXOR(y))
    return F.aggregate(both, F.lit(0), lambda total, x: total + F.bit_count(x))


def _open_pairs(members: DataFrame, comps: DataFrame, classes: DataFrame, spec: JaccardSpec) -> DataFrame:
    """Different pairs (a, b) that meet in a bucket, lie in different components, and
    whose sizes and sketches do not rule out a link. The tests are part of the join, so
    what they rule out is never a row."""
    known = members.join(comps, "node")
    undecided = known.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter(
        F.col("lo") < F.col("hi")).select("key")
    facts = classes.groupBy("node").agg(F.collect_list(F.struct("n", "sketch")).alias("sets"))
    rows = known.join(undecided, "key").select("key", "node", "comp").join(facts, "node").select(
        "key", "node", "comp", F.inline("sets"))

    def side(name: str) -> DataFrame:
        return rows.select("key", *[F.col(c).alias(f"{c}_{name}") for c in ("node", "comp", "n", "sketch")])

    total = F.col("n_a") + F.col("n_b")
    most = F.floor(total * (spec.den - spec.num) / F.lit(spec.den + spec.num))
    return (
        side("a").join(side("b"), "key")
        .filter((F.col("node_a") > F.col("node_b")) & (F.col("comp_a") != F.col("comp_b"))
                & (F.least("n_a", "n_b") * spec.den >= F.greatest("n_a", "n_b") * spec.num)
                & (_differing_bits(F.col("sketch_a"), F.col("sketch_b")) <= most))
        .select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
    )
