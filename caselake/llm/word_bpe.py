"""Word BPE encoding and decoding with the merges of a public tokenizer's file.

Texts are normalised and cut into words as the file says, and each word is merged by
itself over a contiguous rank array: one row per word holds its parts in order, a second
one the rank of each part with the next. Each round takes the row's smallest rank,
leftmost first, deletes the boundary there by moving what follows one place down, and
looks the two ranks beside it up again. Rows of like length lie in one numpy array and
take their rounds together. A word of more than ``SHORT`` bytes has an array of its own,
and one scan merges all places of the smallest rank, so that long runs cost a scan per
different merge and not per place.

Words repeat, so workers keep the ids of those seen lately, from task to task; the store
is emptied when it holds ``KEPT`` words. Plain text is cut by the file's own pattern; any
other run between ASCII white space is normalised and cut by the public library, whose
character tables count, and merged here like every other word. An added token's text gets
its own id where it stands, as the library finds it: in the text before normalisation.

Defined results: a null or empty text has no ids and decodes to the empty text; null ids
and repeated rows are encoded like any other row; an empty table gives an empty result.
``encode`` and ``decode`` keep all columns of their input, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from caselake.llm.common import WORD, whole_text
from caselake.llm.token_files import PLAIN, word_rule

KEPT = 500_000
SLICE_BYTES = 1 << 20  # texts that are encoded together
SHORT = 32
CELLS = 1 << 20  # cells of the arrays that are merged together
NO_RANK = np.int32(2**31 - 1)
ID = np.dtype("<u4")

RUN = re.compile(WORD)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return [chr(b if b in printable else 0x100 + others.index(b)) for b in range(256)]


class Merges:
    """Ranks of pairs of parts and the parts they make, for arrays of part ids.

    ``opening`` has the part of each byte, in its second row of each byte that ends a word.
    """

    def __init__(self, spec: dict):
        model = spec["model"]
        vocabulary, self.mark = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        self.opening = np.array([[vocabulary[c] for c in letters], [vocabulary[c + self.mark] for c in letters]])
        made = [(vocabulary[a] << 32 | vocabulary[b], rank, vocabulary[a + b])
                for rank, (a, b) in enumerate(map(_two, model["merges"]))]
        keys, ranks, parts = (np.array(column, np.int64) for column in zip(*made))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], 2**63 - 1)
        self.ranks = np.append(ranks[order], NO_RANK).astype(np.int32)
        self.part_of_rank = parts
        first = {part: rank for _, rank, part in reversed(made)}
        # A part exists before it is merged further, so ranks never fall while a word is merged.
        self.rising = all(max(first.get(key >> 32, -1), first.get(key & 0xFFFFFFFF, -1)) < rank for key, rank, _ in made)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def parts(self, word: bytes) -> np.ndarray:
        out = self.opening[0][np.frombuffer(word, np.uint8)]
        out[-1] = self.opening[1][word[-1]]
        return out

    def one(self, word: bytes) -> np.ndarray:
        """Ids of a word of any length."""
        parts = self.parts(word)
        ranks = self.rank(parts[:-1], parts[1:])
        while len(ranks) and (least := ranks.min()) != NO_RANK:
            at = np.flatnonzero(ranks == least)
            if not self.rising:
                at = at[:1]
            elif len(at) > 1:  # of overlapping places every second one, from the left
                run = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - run) % 2 == 0]
            parts[at] = self.part_of_rank[least]
            parts = np.delete(parts, at + 1)
            ranks = np.delete(ranks, np.minimum(at + 1, len(ranks) - 1) if at[-1] + 1 < len(ranks) else
                              np.append(at[:-1] + 1, at[-1]))
            place = at - np.arange(len(at))
            near = np.unique(np.concatenate([place - 1, place]))
            near = near[(near >= 0) & (near < len(parts) - 1)]
            ranks[near] = self.rank(parts[near], parts[near + 1])
        return parts

    def together(self, words: list[bytes], width: int) -> list[bytes]:
        """Ids (bytes of ``ID``) of each of many words of up to ``width`` bytes."""
        sizes = np.array([len(word) for word in words])
        raw = np.frombuffer(b"".join(word.ljust(width, b"\0") for word in words), np.uint8).reshape(-1, width)
        parts = self.opening[0][raw]
        each = np.arange(len(words))
        parts[each, sizes - 1] = self.opening[1][raw[each, sizes - 1]]
        ranks = np.full(parts.shape, NO_RANK, np.int32)
        ranks[:, :-1] = np.where(np.arange(1, width) < sizes[:, None], self.rank(parts[:, :-1], parts[:, 1:]), NO_RANK)
        column, live = np.arange(width), each
        while len(live):
            here = ranks[live]
            at = here.argmin(1)
            least = here[np.arange(len(live)), at]
            going = least != NO_RANK
            live, at, least = live[going], at[going], least[going]
            if not len(live):
                break
            rows = np.arange(len(live))
            # Delete boundary at + 1: what stands behind it moves one place down.
            source = np.minimum(column + (column > at[:, None]), width - 1)
            held = np.take_along_axis(parts[live], source, 1)
            here = np.take_along_axis(here[going], np.minimum(column + (column >= at[:, None]), width - 1), 1)
            here[:, -1] = NO_RANK
            held[rows, at] = self.part_of_rank[least]
            sizes[live] -= 1
            n = sizes[live]
            ranks_at = np.where(at + 1 < n, self.rank(held[rows, at], held[rows, np.minimum(at + 1, width - 1)]), NO_RANK)
            here[rows, at] = ranks_at
            back = at > 0
            here[rows[back], at[back] - 1] = self.rank(held[rows[back], at[back] - 1], held[rows[back], at[back]])
            parts[live], ranks[live] = held, here
        data = parts[column < sizes[:, None]].astype(ID).tobytes()
        ends = (ID.itemsize * np.cumsum(sizes)).tolist()
        return [data[start:end] for start, end in zip([0, *ends], ends)]


def _two(merge: str | list[str]) -> list[str]:
    return merge.split(" ") if isinstance(merge, str) else merge


class Encoder(dict):
    """Ids (bytes of ``ID``) per piece: a word of plain text, or any other run whole.

    A piece that holds an added token's text begins with a blank, since an equal run made
    by lower-casing is ordinary text.
    """

    def __init__(self, content: str):
        super().__init__()
        spec = json.loads(content)
        self.rule = word_rule(content)
        if self.rule is None or spec.get("post_processor") or spec.get("decoder"):
            raise ValueError("not a tokenizer of separate words with a marked end")
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] or not RUN.fullmatch(t["content"])
               for t in spec["added_tokens"]):
            raise ValueError("added tokens are found in the text as it stands")
        self.added = {t["content"]: np.array([t["id"]], ID).tobytes() for t in spec["added_tokens"]}
        self.at_added = re.compile("|".join(f"({re.escape(t)})" for t in sorted(self.added, key=len, reverse=True)) or r"(?!)")
        library = Tokenizer.from_str(content)
        self.normalise, self.cut_other = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        self.cut, self.merges = self.rule[0].findall, Merges(spec)
        tokens = {i: token for token, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.token = [tokens.get(i) for i in range(max(tokens) + 1)]

    def pieces(self, text: str) -> list[str]:
        held = any(token in text for token in self.added)
        if not held and PLAIN.fullmatch(text):
            return self.cut(text.lower())
        out = []
        for run in RUN.findall(text):
            if held and any(token in run for token in self.added):
                out.append(f" {run}")
            else:
                out += self.cut(run.lower()) if PLAIN.fullmatch(run) else [run]
        return out

    def words(self, run: str) -> list[bytes]:
        """The words of a run without added tokens."""
        if PLAIN.fullmatch(run):
            return [word.encode() for word in self.cut(run.lower())]
        letters = (piece for piece, _ in self.cut_other(self.normalise(run)))
        return [bytes(map(self.byte_of.__getitem__, piece)) for piece in letters]

    def merged(self, words: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(words)
        groups: dict[int, list[int]] = {}
        for at, word in enumerate(words):
            n = len(word)
            groups.setdefault(8 if n <= 8 else 16 if n <= 16 else SHORT if n <= SHORT else 0, []).append(at)
        for width, places in groups.items():
            step = max(1, CELLS // width) if width else len(places)
            for start in range(0, len(places), step):
                part = places[start:start + step]
                chosen = [words[at] for at in part]
                ids = self.merges.together(chosen, width) if width else [
                    self.merges.one(word).astype(ID).tobytes() for word in chosen]
                for at, found in zip(part, ids):
                    out[at] = found
        return out

    def learn(self, new: list[str]) -> None:
        """Ids of new pieces, the words of all of them merged together."""
        jobs: list[list[bytes | int]] = []  # per piece: ids, or the number of a word
        words: dict[bytes, int] = {}
        for piece in new:
            if not piece.startswith(" "):
                found = [piece.encode()] if piece.isascii() and piece.isalpha() and piece.islower() else self.words(piece)
                jobs.append([words.setdefault(word, len(words)) for word in found])
                continue
            job: list[bytes | int] = []
            for part in filter(None, self.at_added.split(piece[1:])):
                job += [self.added[part]] if part in self.added else [
                    words.setdefault(word, len(words)) for word in self.words(part)]
            jobs.append(job)
        ids = self.merged(list(words))
        for piece, job in zip(new, jobs):
            self[piece] = b"".join(j if isinstance(j, bytes) else ids[j] for j in job)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as bytes of ``ID``."""
        cut = [self.pieces(text) for text in texts]
        wanted = set().union(*cut)
        new = wanted - self.keys()
        if len(self) + len(new) > KEPT:
            self.clear()
            new = wanted
        self.learn(list(new))
        get = self.__getitem__
        return [b"".join(map(get, pieces)) for pieces in cut]

    def decode(self, ids: list[int]) -> str:
        """Tokens with a blank between them, as the library does for a file without a decoder;
        ids outside the vocabulary are left out."""
        token, most = self.token, len(self.token)
        return " ".join([token[i] for i in ids if 0 <= i < most and token[i] is not None])


@lru_cache(maxsize=1)
def worker_encoder(content: str) -> Encoder:
    """One per Python worker: its later tasks go on with what it knows."""
    return Encoder(content)


def _content(path: str) -> str:
    """The tokenizer's file, part of the installation; a few megabytes, sent with the task."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Runs of rows with their texts, cut after ``SLICE_BYTES`` of text."""
    upto = np.cumsum(pc.binary_length(batch.column("body")).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = upto[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(upto, before + SLICE_BYTES, "right")))
        part = batch.slice(start, stop - start)
        yield part, part.column("body").to_pylist()
        start = stop


def _packed(docs: DataFrame, replaced: str, read: Column) -> tuple[DataFrame, str]:
    """All columns but ``replaced`` as one struct, so that no name can clash, with the
    column to be read; the struct's type."""
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns if c != replaced]).alias("doc"), read)
    return packed, packed.schema["doc"].dataType.simpleString()


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``ids``, an array of int; a column of that name is replaced."""
    content = _content(path)
    packed, kind = _packed(docs, "ids", whole_text().alias("body"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = worker_encoder(content)
        for batch in batches:
            for part, texts in _slices(batch):
                ids = run.encode(texts)
                ends = np.cumsum([0, *map(len, ids)]) // ID.itemsize
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)),
                                                 pa.array(np.frombuffer(b"".join(ids), ID).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("doc"), lists], ["doc", "ids"])

    return packed.mapInArrow(rows, f"doc {kind}, ids array<int>").select("doc.*", "ids")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ``ids``; null ids give the empty text."""
    content = _content(path)
    own = F.coalesce("ids", F.array().cast("array<int>")).alias("own")
    packed, kind = _packed(encoded, "decoded", own)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = worker_encoder(content)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [run.decode(ids) for ids in part.column("own").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(texts, pa.string())], ["doc", "decoded"])

    return packed.mapInArrow(rows, f"doc {kind}, decoded string").select("doc.*", "decoded")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): ids as little-endian unsigned 32-bit
    integers, and the text that they decode to."""
    content = _content(path)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = worker_encoder(content)
        for batch in batches:
            for part, texts in _slices(batch):
                ids = run.encode(texts)
                decoded = [run.decode(np.frombuffer(one, ID).tolist()) for one in ids]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(one) // ID.itemsize for one in ids], pa.int64()),
                    pa.array([hashlib.sha256(one).hexdigest() for one in ids], pa.string()),
                    pa.array([hashlib.sha256(text.encode()).hexdigest() for text in decoded], pa.string()),
                ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    bodies = docs.select("doc_id", whole_text().alias("body"))
    return bodies.mapInArrow(rows, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
