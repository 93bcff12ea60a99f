"""Token ids as files: canonical length-limited Huffman codes from global counts.

Texts meet the tokenizer once; their ids are written to the shared folder. One pass
over them counts every id; the driver makes the code from these counts (one per id of
the vocabulary). The next sorts documents by id range, encodes each to whole 32-bit
words and packs neighbours into shards. A shard is a row of a Parquet file whose column ``data`` has the format

    magic "HUF1" | limit u2 | block u2 | documents u4 | tokens u8 | before u8 | words u4
    tokens per document u4[] | words per document u4[] | checkpoints u4[] | code words u4[] | crc32 u4

all little-endian but the code words, whose bits run from the highest down. ``before``
is the number of ids in the same part ahead of the shard. Every ``block`` ids of a
document a checkpoint holds the bit offset from the document's first word, so blocks
are decoded independently: all of a shard step by step together, one table look-up per
id. Parquet files come from Spark's own writer, so lost executors leave no half files.

Defined results: a null or empty text has only the end id; documents are in ascending
order of id, nulls first, then of text hash; repeated rows are written repeatedly; an
empty table gives no shards. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, compress, repeat
from operator import is_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from caselake.llm.common import WORD, row_key, slices, whole_text
from caselake.session import new_path, written

HEADER = struct.Struct("<4sHHIQQI")
MAGIC = b"HUF1"
CACHE = 600_000

# Text of these characters is lower-cased and cut alike by every Unicode version.
PLAIN = re.compile("[\\t-\\r -~\u00a1-\u00ac\u00ae-\u012f\u0131-\u017e]*")
RUN = re.compile(WORD)


@dataclass(frozen=True)
class FileSpec:
    """``limit``: longest code in bits; ``block``: ids between checkpoints;
    ``shard``: ids after which a shard is closed."""

    end_id: int = 2
    limit: int = 20
    block: int = 256
    shard: int = 1 << 19


def word_rule(content: str) -> tuple[re.Pattern, np.ndarray, bool] | None:
    """(pattern that cuts plain lower-case text into words, ids that end a word, whether a
    run of letters is one word), from the tokenizer's file; None where it does not work by
    separate words with a marked end."""
    spec = json.loads(content)
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    mark = spec["model"].get("end_of_word_suffix")
    if [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"] or [c["type"] for c in cuts] != ["Split", "ByteLevel"]:
        return None
    cut, as_bytes = cuts
    if not mark or cut["behavior"] != "Removed" or not cut["invert"] or as_bytes["use_regex"] or as_bytes["add_prefix_space"]:
        return None
    pattern = cut["pattern"]["Regex"]
    branches = pattern.split("|")
    letters = r"[\p{L}]+"
    one_word = letters in branches and all(b.startswith("'") for b in branches[:branches.index(letters)])
    for kind in "LN":  # spelled out for plain characters: this takes less than half the time
        members = "".join(c for c in map(chr, range(0x180)) if PLAIN.fullmatch(c) and unicodedata.category(c)[0] == kind)
        pattern = pattern.replace(rf"\p{{{kind}}}", members)
    if r"\p" in pattern:
        return None
    vocabulary = spec["model"]["vocab"]
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[i for token, i in vocabulary.items() if token.endswith(mark)]] = True
    return re.compile(pattern), ends, one_word


def word_tokenizer(content: str) -> Tokenizer:
    """The tokenizer for plain lower-case words with a blank between: as ``word_rule`` has
    cut them already, its model and byte step alone."""
    spec = json.loads(content)
    as_bytes = spec["pre_tokenizer"]["pretokenizers"][-1]
    spec |= {"normalizer": None, "added_tokens": [],
             "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, as_bytes]}}
    return Tokenizer.from_str(json.dumps(spec))


def id_kind(tokenizer: Tokenizer) -> np.dtype:
    """The smaller of two and four bytes that holds every id."""
    return np.dtype("<u2" if max(tokenizer.get_vocab().values()) < 1 << 16 else "<u4")


class Chunks:
    """Ids (bytes of ``kind``) per piece of text that the tokenizer treats by itself.

    It drops white space and nothing in it looks across, so a text's ids are those of
    its runs between white space in order. A new plain run is cut into words as the
    tokenizer cuts it, and new words go to it many at a time, past the steps that are
    done then; any other run goes to the tokenizer whole. A run that holds the text of an
    added token goes whole to the tokenizer as the library sets it up, which gives such a
    text its own id; its piece begins with a blank, since an equal run of other text (made
    so by lower case) is ordinary text. Runs and words are kept, each store being emptied
    when it holds ``CACHE`` of them.
    """

    def __init__(self, content: str):
        self.runs: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.encode_special_tokens = True  # for pieces that hold none
        self.default = Tokenizer.from_str(content)
        self.rule, self.kind = word_rule(content), id_kind(self.tokenizer)
        self.by_word = word_tokenizer(content) if self.rule else None
        tokens = json.loads(content).get("added_tokens", [])
        self.added = [t["content"] for t in tokens]
        # Found in the raw text and inside runs; otherwise no text can be cut.
        self.cuts = not any(t["normalized"] or not RUN.fullmatch(t["content"]) for t in tokens)

    def whole(self, texts: list[str], tokenizer: Tokenizer | None = None) -> Iterator[np.ndarray]:
        for start in range(0, len(texts), 4096):
            for found in (tokenizer or self.tokenizer).encode_batch_fast(texts[start:start + 4096], add_special_tokens=False):
                yield np.array(found.ids, self.kind)

    def learn_words(self, new: list[str]) -> None:
        """Many words per call, told apart by the ids that end a word."""
        groups = [new[start:start + 256] for start in range(0, len(new), 256)]
        for group, ids in zip(groups, self.whole([" ".join(group) for group in groups], self.by_word)):
            stops = np.flatnonzero(self.rule[1][ids]) + 1
            if len(stops) == len(group) and stops[-1] == len(ids):
                data, first = ids.tobytes(), 0
                for word, stop in zip(group, (self.kind.itemsize * stops).tolist()):
                    self.words[word] = data[first:stop]
                    first = stop
            else:
                self.words.update((word, own.tobytes()) for word, own in zip(group, self.whole(group)))

    def learn_plain(self, runs: set[str]) -> None:
        """New runs of plain text; one of letters alone may be a word as it stands."""
        single = set(filter(str.isalpha, runs)) if self.rule[2] else set()
        mixed = list(runs - single)
        cut = list(map(self.rule[0].findall, mixed))
        wanted = single.union(*cut)
        new = wanted.difference(self.words)
        if len(self.words) + len(new) > CACHE:
            self.words.clear()
            new = wanted
        self.learn_words(list(new))
        get = self.words.__getitem__
        self.runs.update((word, get(word)) for word in single)
        self.runs.update((run, b"".join(map(get, words))) for run, words in zip(mixed, cut))

    def holds_added(self, text: str) -> bool:
        return any(token in text for token in self.added)

    def is_plain(self, text: str) -> bool:
        return bool(self.rule and self.cuts and PLAIN.fullmatch(text) and not self.holds_added(text))

    def pieces(self, text: str) -> list[str]:
        """Pieces of a text that is not plain."""
        if not self.cuts:
            return [f" {text}"]
        out, held = [], self.holds_added(text)
        for run in RUN.findall(text):
            if held and self.holds_added(run):
                out.append(f" {run}")
            else:
                out.append(run.lower() if self.rule and PLAIN.fullmatch(run) else run)
        return out

    def learn(self, plain: set[str], unsorted: set[str]) -> None:
        if len(self.runs) + len(plain) + len(unsorted) > CACHE:
            self.runs.clear()
        held = [piece for piece in unsorted if piece.startswith(" ")]
        more = {piece for piece in unsorted.difference(held) if self.rule and PLAIN.fullmatch(piece)}
        others = list(unsorted.difference(held, more))
        if self.rule:
            self.learn_plain(plain | more)
        self.runs.update((run, own.tobytes()) for run, own in zip(held, self.whole([h[1:] for h in held], self.default)))
        self.runs.update((run, own.tobytes()) for run, own in zip(others, self.whole(others)))

    def encode(self, bodies: list[bytes], end: bytes) -> list[bytes]:
        """Ids of each text as bytes, ``end`` after them. Different pieces are looked up once;
        new ones are learnt together. Plain texts are lower-cased and cut by Arrow."""
        texts = [body.decode() for body in bodies]
        plain = list(map(self.is_plain, texts))
        lists = pc.ascii_split_whitespace(pc.utf8_lower(pa.array(compress(texts, plain), pa.large_string())))
        cut = [self.pieces(text) for text, known in zip(texts, plain) if not known]
        flat = [(lists.values, np.diff(lists.offsets.to_numpy())),
                (pa.array(chain.from_iterable(cut), pa.large_string()), np.array(list(map(len, cut)), np.int64))]
        coded = [values.dictionary_encode() for values, _ in flat]
        names = [c.dictionary.to_numpy(zero_copy_only=False).tolist() for c in coded]
        found = [list(map(self.runs.get, own)) for own in names]
        new = [set(compress(own, map(is_, ids, repeat(None)))) for own, ids in zip(names, found)]
        if any(new):
            self.learn(*new)
            get = self.runs.__getitem__
            found = [[get(piece) if own is None else own for piece, own in zip(*both)] for both in zip(names, found)]
        done = [iter(self.texts(ids, c.indices.to_numpy(), sizes, end)) for ids, c, (_, sizes) in zip(found, coded, flat)]
        return [next(done[0] if known else done[1]) for known in plain]

    def texts(self, ids: list[bytes], order: np.ndarray, sizes: np.ndarray, end: bytes) -> Iterator[bytes]:
        """Ids of each text of ``sizes`` pieces, its pieces being ``ids`` taken in ``order``."""
        store, width = np.frombuffer(b"".join(ids), self.kind), np.array(list(map(len, ids)), np.int64) // self.kind.itemsize
        first, n = (np.cumsum(width) - width)[order], width[order]
        ends = np.concatenate([[0], np.cumsum(n)])
        out = store[np.repeat(first - ends[:-1], n) + np.arange(ends[-1])]
        edges = ends[np.concatenate([[0], np.cumsum(sizes)])]
        for start, stop in zip(edges.tolist(), edges[1:].tolist()):
            yield out[start:stop].tobytes() + end


@lru_cache(maxsize=1)
def worker_chunks(content: str) -> Chunks:
    """One store per Python worker: its later tasks go on with what it knows."""
    return Chunks(content)


def _batches(batch: pa.RecordBatch, rows: int = 128) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def encoded(docs: DataFrame, content: str, spec: FileSpec) -> DataFrame:
    """(doc_id, text_hash, ids): the ids of every text with the end id, as bytes."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = worker_chunks(content)
        end = np.array([spec.end_id], chunks.kind).tobytes()
        for batch in batches:
            for part in slices(batch, "body", 1 << 22):
                ids = chunks.encode(part.column("body").to_pylist(), end)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array(ids, pa.binary())],
                    ["doc_id", "text_hash", "ids"])

    bodies = docs.select(*row_key(), whole_text().cast("binary").alias("body"))
    return bodies.mapInArrow(rows, "doc_id bigint, text_hash bigint, ids binary")


def id_counts(ids: DataFrame, kind: np.dtype) -> dict[int, int]:
    """How often every id occurs over all documents: at most one row per id is collected."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            for part in _batches(batch):
                here = np.bincount(np.frombuffer(b"".join(part.column("ids").to_pylist()), kind), minlength=len(counts))
                here[:len(counts)] += counts
                counts = here
        seen = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["id", "n"])

    counted = ids.select("ids").mapInArrow(rows, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    return {r["id"]: r["n"] for r in counted.collect()}


def code_lengths(counts: dict[int, int], limit: int) -> dict[int, int]:
    """Best code lengths of at most ``limit`` bits, by merging packages.

    Per level the counts are merged in order with the pairs of the level below. Of the
    last level the 2(n - 1) cheapest are taken; going back, taken counts get one bit
    more and taken pairs take two of the level below.
    """
    ids = sorted(counts, key=lambda i: (counts[i], i))
    if len(ids) < 2:
        return dict.fromkeys(ids, 1)
    if len(ids) > 1 << limit:
        raise ValueError(f"{len(ids)} ids need more than {limit} bits")
    weights = np.array([counts[i] for i in ids], np.int64)
    row, leaves = weights, []
    for _ in range(limit):
        both = np.concatenate([weights, row[:len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)]) if leaves else weights
        order = np.argsort(both, kind="stable")
        leaves.append(order < len(weights))
        row = both[order]
    lengths = np.zeros(len(ids), np.int64)
    take = 2 * (len(ids) - 1)
    for leaf in reversed(leaves):
        own = int(leaf[:take].sum())
        lengths[:own] += 1
        take = 2 * (min(take, len(leaf)) - own)
    return dict(zip(ids, lengths.tolist()))


@dataclass(frozen=True)
class Codebook:
    """Canonical code: codes run upwards by (length, id)."""

    ids: np.ndarray
    lengths: np.ndarray
    limit: int

    @classmethod
    def of(cls, lengths: dict[int, int], limit: int) -> Codebook:
        ordered = sorted(lengths.items(), key=lambda x: (x[1], x[0]))
        return cls(np.array([i for i, _ in ordered], np.int64), np.array([n for _, n in ordered], np.int64), limit)

    def first_slots(self) -> np.ndarray:
        """Place of every code in a table of all ``limit``-bit words."""
        return np.concatenate([[0], np.cumsum(1 << (self.limit - self.lengths))])

    def for_encoding(self) -> tuple[np.ndarray, np.ndarray]:
        size = int(self.ids.max()) + 1 if len(self.ids) else 1
        code, length = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        code[self.ids] = self.first_slots()[:-1] >> (self.limit - self.lengths)
        length[self.ids] = self.lengths
        return code, length

    def for_decoding(self) -> tuple[np.ndarray, np.ndarray]:
        spans = 1 << (self.limit - self.lengths)
        ids, lengths = np.zeros(1 << self.limit, "<u4"), np.ones(1 << self.limit, np.uint8)
        filled = int(spans.sum())
        ids[:filled], lengths[:filled] = np.repeat(self.ids, spans), np.repeat(self.lengths, spans)
        return ids, lengths


def pack(texts: list[np.ndarray], code: np.ndarray, length: np.ndarray, block: int) -> list[tuple[bytes, bytes]]:
    """(code words, checkpoints) per document; every document starts at a word."""
    if not texts:
        return []
    ids, sizes = np.concatenate(texts), np.array([len(t) for t in texts])
    first = np.concatenate([[0], np.cumsum(sizes)])
    bits = length[ids]
    ends = np.concatenate([[0], np.cumsum(bits)])
    words = -(-(ends[first[1:]] - ends[first[:-1]]) // 32)
    base = np.concatenate([[0], np.cumsum(words)])
    at = ends[:-1] + np.repeat(base[:-1] * 32 - ends[first[:-1]], sizes)
    # A code lies in one 64-bit window of two words; bits never meet, so sums are unions.
    window = code[ids] << (64 - bits - (at & 31)).astype(np.uint64)
    place, n = at >> 5, int(base[-1]) + 1
    high = np.bincount(place, (window >> np.uint64(32)).astype(np.float64), n)
    low = np.bincount(place + 1, (window & np.uint64(0xFFFFFFFF)).astype(np.float64), n + 1)
    stream = (high + low[:n]).astype(np.uint64).astype(">u4")
    return [
        (stream[base[i]:base[i + 1]].tobytes(),
         (at[first[i]:first[i + 1]:block] - base[i] * 32).astype("<u4").tobytes()) for i in range(len(texts))
    ]


def shard_bytes(docs: list[tuple[int, bytes, bytes]], before: int, spec: FileSpec) -> bytes:
    """One shard of (ids, code words, checkpoints) per document."""
    sizes = np.array([n for n, _, _ in docs], "<u4")
    words = np.array([len(w) // 4 for _, w, _ in docs], "<u4")
    body = b"".join([
        HEADER.pack(MAGIC, spec.limit, spec.block, len(docs), int(sizes.sum()), before, int(words.sum())),
        sizes.tobytes(), words.tobytes(), *[c for _, _, c in docs], *[w for _, w, _ in docs]])
    return body + struct.pack("<I", zlib.crc32(body))


def unpack(data: bytes, ids_of: np.ndarray, bits_of: np.ndarray) -> tuple[int, list[np.ndarray]]:
    """(ids before the shard in its part, ids per document)."""
    if zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
        raise ValueError("shard is damaged")
    magic, limit, block, n_docs, n_tokens, before, n_words = HEADER.unpack_from(data)
    if magic != MAGIC:
        raise ValueError(f"not a shard: {magic!r}")
    sizes = np.frombuffer(data, "<u4", n_docs, HEADER.size).astype(np.int64)
    words = np.frombuffer(data, "<u4", n_docs, HEADER.size + 4 * n_docs).astype(np.int64)
    blocks = -(-sizes // block)
    at = HEADER.size + 8 * n_docs
    checkpoints = np.frombuffer(data, "<u4", int(blocks.sum()), at).astype(np.int64)
    stream = np.frombuffer(data, ">u4", n_words, at + 4 * len(checkpoints)).astype(np.uint64)
    stream = np.concatenate([stream, np.zeros(2, np.uint64)])
    pairs = stream[:-1] << np.uint64(32) | stream[1:]
    # One lane per block: its bit position, where its ids go, how many there are.
    base, first = np.cumsum(words) - words, np.cumsum(sizes) - sizes
    number = np.arange(len(checkpoints)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    bit = checkpoints + np.repeat(base * 32, blocks)
    to = np.repeat(first, blocks) + number * block
    count = np.minimum(block, np.repeat(sizes, blocks) - number * block)
    longest_first = np.argsort(-count, kind="stable")
    bit, to, count = bit[longest_first], to[longest_first], count[longest_first]
    live = np.searchsorted(-count, -np.arange(block), side="left")  # lanes with more than i ids
    out, mask = np.empty(n_tokens, "<u4"), np.uint64((1 << limit) - 1)
    for i in range(int(count[0]) if len(count) else 0):
        n = int(live[i])
        here = bit[:n]
        window = (pairs[here >> 5] >> (64 - limit - (here & 31)).astype(np.uint64)) & mask
        out[to[:n] + i] = ids_of[window]
        bit[:n] += bits_of[window]
    return before, np.split(out, np.cumsum(sizes)[:-1]) if n_docs else []


def write_ids(docs: DataFrame, tokenizer: str, path: str, spec: FileSpec = FileSpec()) -> None:
    """Write the ids of ``docs`` (doc_id, text), each document ended by ``end_id``, as
    ``path``/codes and ``path``/shards."""
    with open(tokenizer, encoding="utf-8") as file:
        content = file.read()  # the tokenizer's file, under two megabytes, sent with the tasks
    spark = docs.sparkSession
    ids = written(encoded(docs, content, spec), "ids")
    kind = id_kind(Tokenizer.from_str(content))
    lengths = code_lengths(id_counts(ids, kind), spec.limit)
    spark.createDataFrame(list(lengths.items()), "id bigint, bits bigint").coalesce(1).write.parquet(f"{path}/codes")
    code, bits = Codebook.of(lengths, spec.limit).for_encoding()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number_of_task, before, open_ids, doc_ids, rows, number = TaskContext.get().partitionId(), 0, 0, [], [], 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([number_of_task], pa.int32()), pa.array([number], pa.int32()), pa.array([open_ids], pa.int64()),
                pa.array([doc_ids], pa.list_(pa.int64())), pa.array([shard_bytes(rows, before, spec)], pa.binary()),
            ], ["part", "number", "tokens", "doc_ids", "data"])

        for batch in batches:
            for part in _batches(batch):
                texts = [np.frombuffer(own, kind) for own in part.column("ids").to_pylist()]
                for doc_id, own, out in zip(part.column("doc_id").to_pylist(), texts, pack(texts, code, bits, spec.block)):
                    doc_ids.append(doc_id)
                    rows.append((len(own), *out))
                    open_ids += len(own)
                    if open_ids >= spec.shard:
                        yield close()
                        before, number, open_ids, doc_ids, rows = before + open_ids, number + 1, 0, [], []
        if rows:
            yield close()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = ids.repartitionByRange(parts, "doc_id", "text_hash").sortWithinPartitions("doc_id", "text_hash")
    (
        ordered.mapInArrow(shards, "part int, number int, tokens bigint, doc_ids array<bigint>, data binary")
        .write.option("compression", "none").parquet(f"{path}/shards")
    )


def read_ids(spark: SparkSession, path: str, spec: FileSpec = FileSpec()) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ``ids`` as little-endian u4 bytes, ``start`` the
    number of ids of all documents before."""
    lengths = {r["id"]: r["bits"] for r in spark.read.parquet(f"{path}/codes").collect()}  # one row per id
    book = Codebook.of(lengths, spec.limit)
    shards = spark.read.parquet(f"{path}/shards")
    totals = shards.groupBy("part").agg(F.sum("tokens").alias("n")).collect()  # one row per part
    offsets, total = {}, 0
    for part, n in sorted(map(tuple, totals)):
        offsets[part] = total
        total += n
    return shards.select("part", "doc_ids", "data").mapInArrow(
        _reader(book, offsets), "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def _reader(book: Codebook, offsets: dict[int, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, bits_of = book.for_decoding()
        for batch in batches:
            for row in range(batch.num_rows):  # one shard at a time
                part, doc_ids, data = (batch.column(c)[row].as_py() for c in ("part", "doc_ids", "data"))
                before, texts = unpack(data, ids_of, bits_of)
                sizes = np.array([len(t) for t in texts], np.int64)
                starts = np.cumsum(sizes) - sizes + before + offsets[part]
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(sizes),
                    pa.array([t.tobytes() for t in texts], pa.binary()),
                ], ["doc_id", "start", "n_tokens", "ids"])

    return rows


def folder(spark: SparkSession) -> str:
    """A new folder for files in the shared place of the cluster."""
    return new_path(spark, "token-files")
