"""Byte-level BPE encoding and decoding with the ranks of a public tokenizer.

A text is cut by the tokenizer's pattern, and each piece is merged by itself. A
segment tree over the piece's byte positions holds, per node, the smallest
(rank, position) of the pairs that start below it; its root is the next merge. A merge
changes two live pairs, each a path to the root, so a piece of n bytes takes
O(n log n) even if it is one very long run. Pieces of up to ``SHORT`` bytes have their
trees side by side in one numpy array and are merged many at a time, a longer one by
itself. Words repeat, so workers keep the ids of those seen lately, from task to task;
they are forgotten once they make up ``KEPT_CHARS`` characters.

Defined results: a null or empty text has no ids and decodes to no bytes; null ids and
repeated rows are encoded like any other row; an empty table gives an empty result.
``encode`` keeps all columns of its input, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselake.llm.common import whole_text

KEPT_CHARS = 3_000_000
SLICE_BYTES = 1 << 20  # texts that are encoded together
SHORT, SHORT_BITS = 64, 6
CELLS = 1 << 18  # leaves of the trees that are merged together
NONE = 1 << 62  # above every (rank, position)
NO_PAIR = np.int32(2**31 - 1)  # the same, for trees of short pieces


def load_ranks(content: bytes) -> dict[bytes, int]:
    """Rank file: a base64 token and its rank per line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) if token}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: always the leftmost pair of the smallest rank is merged next."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    width = 1 << (n - 1).bit_length()
    shift = width.bit_length()  # positions take the low bits of a tree value
    tree = [NONE] * (2 * width)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    end = list(range(1, n + 1))
    rank_of = ranks.get
    for i in range(n - 1):
        rank = rank_of(piece[i:i + 2])
        if rank is not None:
            tree[width + i] = rank << shift | i
    for node in range(width - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right

    def put(i: int, value: int) -> None:
        node = width + i
        tree[node] = value
        node >>= 1
        while node:
            left, right = tree[2 * node], tree[2 * node + 1]
            least = left if left < right else right
            if tree[node] == least:
                break
            tree[node] = least
            node >>= 1

    def pair(i: int) -> int:
        following = after[i]
        if following >= n:
            return NONE
        rank = rank_of(piece[i:end[following]])
        return NONE if rank is None else rank << shift | i

    low = (1 << shift) - 1
    while tree[1] < NONE:
        i = tree[1] & low
        gone = after[i]
        end[i], after[i] = end[gone], after[gone]
        if after[i] < n:
            before[after[i]] = i
        put(gone, NONE)
        put(i, pair(i))
        if before[i] >= 0:
            put(before[i], pair(before[i]))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = after[i]
    return out


class Pairs:
    """Rank of the token that two tokens make, for arrays of tokens given by rank."""

    def __init__(self, ranks: dict[bytes, int]):
        if max(ranks.values()) >= 1 << (31 - SHORT_BITS):
            raise ValueError("ranks take too many bits")
        made = sorted(
            (left << 32 | right, rank)
            for token, rank in ranks.items() for at in range(1, len(token))
            if (left := ranks.get(token[:at])) is not None and (right := ranks.get(token[at:])) is not None
        )
        self.keys = np.array([key for key, _ in made] + [2**63 - 1], np.int64)
        self.found = np.array([rank for _, rank in made] + [-1], np.int64)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        first, second = np.divmod(np.arange(1 << 16), 256)
        self.of_bytes = self(self.byte[first], self.byte[second])

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank, -1 where the two make no token."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.found[at], -1)


def _leaf(rank: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.where(rank < 0, NO_PAIR, rank << SHORT_BITS | at).astype(np.int32)


def merge_short(pieces: list[bytes], width: int, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces one after another, and how many each has.

    As ``merge``, for pieces of 2 to ``width`` bytes, a power of two; each round does the
    next merge of every piece that still has one. Row r of every array is byte position
    or tree node r, a column is a piece.
    """
    count = len(pieces)
    size = np.array([len(piece) for piece in pieces])
    raw = np.frombuffer(b"".join(piece.ljust(width, b"\0") for piece in pieces), np.uint8)
    raw = raw.reshape(count, width).T.astype(np.int64)
    place = np.arange(width)[:, None]
    token, live = pairs.byte[raw], place < size
    tree = np.full((2 * width, count), NO_PAIR, np.int32)
    opening = _leaf(pairs.of_bytes[raw[:-1] << 8 | raw[1:]], place[:-1])
    tree[width:-1] = np.where(live[1:], opening, NO_PAIR)
    for node in range(width - 1, 0, -1):
        np.minimum(tree[2 * node], tree[2 * node + 1], out=tree[node])
    after = np.repeat(np.arange(1, width + 2), count).reshape(width + 1, count)
    before = np.repeat(np.arange(-1, width), count).reshape(width + 1, count)
    column = np.flatnonzero(tree[1] != NO_PAIR)
    while len(column):
        root = tree[1, column].astype(np.int64)
        i, made = root & (SHORT - 1), root >> SHORT_BITS
        gone = after[i, column]
        following = after[gone, column]
        token[i, column], live[gone, column] = made, False
        after[i, column], before[following, column] = following, i
        tree[width + gone, column] = NO_PAIR
        tree[width + i, column] = NO_PAIR
        more = following < size[column]
        at, col = i[more], column[more]
        tree[width + at, col] = _leaf(pairs(made[more], token[following[more], col]), at)
        previous = before[i, column]
        more = previous >= 0
        at, col = previous[more], column[more]
        tree[width + at, col] = _leaf(pairs(token[at, col], made[more]), at)
        node = width + np.concatenate([gone, i, at])
        col = np.concatenate([column, column, col])
        for _ in range(width.bit_length() - 1):
            node >>= 1
            tree[node, col] = np.minimum(tree[2 * node, col], tree[2 * node + 1, col])
        column = column[tree[1, column] != NO_PAIR]
    return token.T[live.T], live.sum(0)


class Store:
    """Lists of ids one after another, taken by number."""

    def __init__(self) -> None:
        self.ids = self.starts = self.sizes = np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, ids])

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these lists one after another, and how many each has."""
        sizes = self.sizes[numbers]
        shift = self.starts[numbers] - (np.cumsum(sizes) - sizes)
        return self.ids[np.arange(sizes.sum()) + np.repeat(shift, sizes)], sizes


class Encoder:
    """Ids of texts, by words kept from earlier texts.

    The public pattern never joins a blank to what stands before it when no white space
    follows, and cuts what lies between two such blanks alike wherever it stands. So a
    text is split at its blanks, and a word with the blank before it is cut once. A text
    with white space after a blank, and any text under another pattern, is cut whole.

    Keys of ``place``: a word, which stands for the pieces of a blank and itself, or a
    blank and one piece, which stands for the piece.
    """

    def __init__(self, content: bytes, pattern: str):
        self.ranks = load_ranks(content)
        self.pairs = Pairs(self.ranks)
        self.cut = regex.compile(pattern).findall
        self.by_blanks = pattern == public_tokenizers.PATTERN
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.store, self.chars = Store(), 0

    def __call__(self, text: str) -> list[int]:
        return self.together([text])[0].tolist()

    def together(self, texts: list[str]) -> list[np.ndarray]:
        if self.chars > KEPT_CHARS:
            self.forget()
        keys = [self._keys(text) for text in texts]
        new = list(dict.fromkeys(key for one in keys for key in one if key not in self.place))
        if new:
            self._learn(new)
        numbers = [np.fromiter(map(self.place.__getitem__, one), np.int64, len(one)) for one in keys]
        return [self.store.take(one)[0] for one in numbers]

    def _keys(self, text: str) -> list[str]:
        if self.by_blanks:
            first, *words = text.split(" ")
            if not any(not word or word[0].isspace() for word in words if word not in self.place):
                return [" " + piece for piece in self.cut(first)] + words
        return [" " + piece for piece in self.cut(text)]

    def _learn(self, keys: list[str]) -> None:
        number: dict[str, int] = {}
        flat, counts = [], []
        for key in keys:
            cut = [key[1:]] if key[0] == " " else self.cut(" " + key)
            flat += [number.setdefault(piece, len(number)) for piece in cut]
            counts.append(len(cut))
        ids, sizes = self._merged(number).take(np.array(flat, np.int64))
        ends = np.cumsum(counts)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        self.store.add(ids, upto[ends] - upto[ends - counts])
        self.place.update(zip(keys, range(len(self.place), len(self.place) + len(keys))))
        self.chars += sum(map(len, keys))

    def _merged(self, pieces: Iterable[str]) -> Store:
        """Ids of every piece, in the order of the pieces."""
        groups: dict[int, list[tuple[int, bytes]]] = {}
        for at, piece in enumerate(pieces):
            raw = piece.encode("utf-8")
            width = 1 if raw in self.ranks or not raw else 1 << (len(raw) - 1).bit_length()
            groups.setdefault(min(width, 2 * SHORT), []).append((at, raw))
        out, order = Store(), []
        for width, group in groups.items():
            for start in range(0, len(group), CELLS // width):
                numbers, raws = zip(*group[start:start + CELLS // width])
                order += numbers
                if 1 < width <= SHORT:
                    out.add(*merge_short(raws, width, self.pairs))
                else:
                    found = [merge(raw, self.ranks) if raw else [] for raw in raws]
                    out.add(np.array([i for ids in found for i in ids], np.int64), np.array([*map(len, found)]))
        back = np.argsort(np.array(order, np.int64))
        out.starts, out.sizes = out.starts[back], out.sizes[back]
        return out


@lru_cache(maxsize=1)
def encoder(content: bytes, pattern: str = public_tokenizers.PATTERN) -> Encoder:
    """The worker's encoder for this file, the same one in later tasks."""
    return Encoder(content, pattern)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Runs of rows with their bodies, cut after ``SLICE_BYTES`` of text."""
    sizes = pc.binary_length(batch.column("body")).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for at, size in enumerate(sizes.tolist(), 1):
        total += size
        if total >= SLICE_BYTES or at == batch.num_rows:
            part = batch.slice(start, at - start)
            yield part, part.column("body").to_pylist()
            start, total = at, 0


def _id_lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32)))


@lru_cache(maxsize=1)
def decoder(content: bytes) -> Callable[[list[int]], bytes]:
    token = {rank: token for token, rank in load_ranks(content).items()}.__getitem__
    return lambda ids: b"".join(map(token, ids))


def _rank_file(path: str) -> bytes:
    """The tokenizer's file, part of the installation; under a megabyte, sent with the task."""
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``docs`` with ``ids``, an array of int; a column of that name is replaced."""
    content = _rank_file(path)
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns if c != "ids"]).alias("doc"),
                         whole_text().alias("body"))
    kind = packed.schema["doc"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = encoder(content, pattern)
        for batch in batches:
            for part, bodies in _slices(batch):
                ids = run.together(bodies)
                yield pa.RecordBatch.from_arrays([part.column("doc"), _id_lists(ids)], ["doc", "ids"])

    return packed.mapInArrow(rows, f"doc {kind}, ids array<int>").select("doc.*", "ids")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with ``bytes``, what its ``ids`` stand for; null ids give no bytes."""
    content = _rank_file(path)
    packed = encoded.select(F.struct(*[encoded[f"`{c}`"] for c in encoded.columns if c != "bytes"]).alias("doc"),
                            F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    kind = packed.schema["doc"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = decoder(content)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                out = [run(ids) for ids in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(out, pa.binary())], ["doc", "bytes"])

    return packed.mapInArrow(rows, f"doc {kind}, bytes binary").select("doc.*", "bytes")


def token_rows(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, source, ids, n_tokens, exact): ids, and whether they decode to the text.

    One pass in one worker per task; texts do not travel back.
    """
    content = _rank_file(path)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids, to_bytes = encoder(content), decoder(content)
        for batch in batches:
            for part, bodies in _slices(batch):
                ids = to_ids.together(bodies)
                exact = [to_bytes(found.tolist()) == text.encode("utf-8") for found, text in zip(ids, bodies)]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("source"), _id_lists(ids),
                    pa.array(map(len, ids), pa.int64()), pa.array(exact, pa.bool_()),
                ], ["doc_id", "source", "ids", "n_tokens", "exact"])

    bodies = docs.select("doc_id", "source", whole_text().alias("body"))
    return bodies.mapInArrow(rows, "doc_id bigint, source string, ids array<int>, n_tokens bigint, exact boolean")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): ids and the bytes they decode to."""
    content = _rank_file(path)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids, to_bytes = encoder(content), decoder(content)
        decimal = [str(i) for i in range(max(to_ids.ranks.values()) + 1)].__getitem__
        for batch in batches:
            for part, bodies in _slices(batch):
                out = []
                for ids in map(np.ndarray.tolist, to_ids.together(bodies)):
                    out.append((len(ids), hashlib.sha256(" ".join(map(decimal, ids)).encode()).hexdigest(),
                                hashlib.sha256(to_bytes(ids)).hexdigest()))
                n, ids_sha, bytes_sha = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                     pa.array(bytes_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    bodies = docs.select("doc_id", whole_text().alias("body"))
    return bodies.mapInArrow(rows, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
