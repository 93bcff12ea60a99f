"""Weighted acyclic automata that map phrases to counts.

A phrase is a path of words from the root; the arc that reads its last word carries its
count. Counts of phrases are closed under prefixes (a phrase's beginning occurs where the
phrase does), so every state is final and needs no weight of its own. States with the same
arcs, counts and targets are one. Words are labelled by their place in a sorted list, so
the order of paths is the order of phrases, shorter ones before what they begin.

Between automata stand *levels*: per phrase length the arrays (parent, label, count) in
path order, where ``parent`` is the place of the beginning one level up.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

Level = tuple[np.ndarray, np.ndarray, np.ndarray]


def count_levels(ids: np.ndarray, words: int, depth: int) -> list[Level]:
    """Levels of all phrases of up to ``depth`` words in a text of labels, where -1 ends a piece."""
    at = np.flatnonzero(ids >= 0)
    held = np.zeros(len(ids), np.int64)  # place of the phrase that starts here, one level up
    levels: list[Level] = []
    for length in range(depth):
        last = at + length
        at = at[last < len(ids)]
        at = at[ids[at + length] >= 0]
        key = held[at] * words + ids[at + length]
        found, place, counts = np.unique(key, return_inverse=True, return_counts=True)
        held[at] = place
        levels.append((found // max(words, 1), found % max(words, 1), counts.astype(np.int64)))
    return levels


def summed(parts: Sequence[tuple[Sequence[bytes], list[Level]]]) -> tuple[list[bytes], list[Level]]:
    """Union of levels over unlike word lists; counts of the same phrase are added."""
    words = sorted(set().union(*(own for own, _ in parts)))
    place = {word: i for i, word in enumerate(words)}
    maps = [np.fromiter(map(place.__getitem__, own), np.int64, len(own)) for own, _ in parts]
    above = [np.zeros(1, np.int64) for _ in parts]
    nothing = (np.zeros(0, np.int64),) * 3
    out: list[Level] = []
    for depth in range(max((len(levels) for _, levels in parts), default=0)):
        here = [levels[depth] if depth < len(levels) else nothing for _, levels in parts]
        key = np.concatenate([up[parent] * len(words) + to[label] for up, to, (parent, label, _) in zip(above, maps, here)])
        found, inverse = np.unique(key, return_inverse=True)
        counts = np.zeros(len(found), np.int64)
        np.add.at(counts, inverse, np.concatenate([count for _, _, count in here]))
        above = np.split(inverse, np.cumsum([len(label) for _, label, _ in here])[:-1])
        out.append((found // max(len(words), 1), found % max(len(words), 1), counts))
    return words, out


def places_before(words: Sequence[bytes], levels: list[Level], key: Sequence[bytes]) -> list[tuple[int, int]]:
    """Per level (first place not before ``key``'s beginning of that length, first place not
    before ``key``): they differ by one where that beginning itself is there."""
    out: list[tuple[int, int]] = []
    on_path, at = True, 0
    for depth, (parent, label, _) in enumerate(levels):
        start, stop = np.searchsorted(parent, [at, at + 1]).tolist()
        if not on_path or depth >= len(key):
            on_path, at = False, start
            out.append((at, at))
            continue
        wanted = bisect_left(words, key[depth])
        at = start + int(np.searchsorted(label[start:stop], wanted))
        on_path = at < stop and label[at] == wanted and words[wanted] == key[depth]
        out.append((at, at + (on_path and depth + 1 < len(key))))
    return out


def split(words: Sequence[bytes], levels: list[Level], bounds: Sequence[Sequence[bytes]]) -> list[tuple[int, list[Level]]]:
    """(range, levels) for each range of phrases between two bounds that holds any; a
    range keeps the beginnings of its lower bound, with their counts, as the way to its phrases."""
    if not levels or not len(levels[0][1]):
        return []
    lower = [(0, 0)] * len(levels)
    out = []
    for number in range(len(bounds) + 1):
        if number < len(bounds):
            upper = places_before(words, levels, bounds[number])
        else:
            upper = [(len(label), len(label)) for _, label, _ in levels]
        cut, shift = [], 0
        for (start, _), (_, stop), (parent, label, count) in zip(lower, upper, levels):
            cut.append((parent[start:stop] - shift, label[start:stop], count[start:stop]))
            shift = start
        if any(len(label) for _, label, _ in cut):
            out.append((number, cut))
        lower = upper
    return out


@dataclass(frozen=True)
class CountAutomaton:
    """``sizes``: arcs per state, state 0 without any; arcs by state and label. ``words``:
    the list that labels refer to."""

    words: list[bytes]
    root: int
    sizes: np.ndarray
    labels: np.ndarray
    counts: np.ndarray
    targets: np.ndarray

    @classmethod
    def of(cls, words: Sequence[bytes], levels: list[Level]) -> CountAutomaton:
        """Built from sorted phrases: a state is closed when they leave it, and an equal
        one closed before takes its place. Words without an arc are left out."""
        used = np.unique(np.concatenate([label for _, label, _ in levels])) if levels else np.zeros(0, np.int64)
        closed: dict[bytes, int] = {b"": 0}
        targets = None
        for depth in reversed(range(len(levels))):
            parent, label, count = levels[depth]
            targets = np.zeros(len(label), np.int64) if targets is None else targets
            arcs = np.column_stack([np.searchsorted(used, label), count, targets]).astype(np.int64).tobytes()
            parents = len(levels[depth - 1][1]) if depth else 1
            ends = (24 * np.searchsorted(parent, np.arange(parents + 1))).tolist()
            targets = np.array([closed.setdefault(arcs[start:end], len(closed)) for start, end in zip(ends, ends[1:])], np.int64)
        root = int(targets[0]) if levels else 0
        arcs = np.frombuffer(b"".join(closed), np.int64).reshape(-1, 3)
        sizes = np.array([len(state) // 24 for state in closed], np.int64)
        return cls([words[i] for i in used.tolist()], root, sizes, arcs[:, 0], arcs[:, 1], arcs[:, 2])

    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.sizes)])

    def levels(self) -> list[Level]:
        """All paths."""
        starts, state, out = self.starts(), np.array([self.root]), []
        while True:
            size = self.sizes[state]
            total = int(size.sum())
            if not total:
                return out
            parent = np.repeat(np.arange(len(state)), size)
            arc = np.repeat(starts[state] - (np.cumsum(size) - size), size) + np.arange(total)
            out.append((parent, self.labels[arc], self.counts[arc]))
            state = self.targets[arc]

    def count_of(self, phrases: Sequence[Sequence[bytes]]) -> np.ndarray:
        """Counts of phrases, read in step with the arcs: the composition of the phrases'
        own automaton with this one. 0 for a phrase without a path."""
        place = {word: i for i, word in enumerate(self.words)}
        width = max(len(place), 1)
        arcs = np.repeat(np.arange(len(self.sizes)), self.sizes) * width + self.labels
        depth = max(map(len, phrases), default=0)
        codes = np.full((len(phrases), depth), -1, np.int64)
        for i, phrase in enumerate(phrases):
            codes[i, :len(phrase)] = [place.get(word, -2) for word in phrase]
        state, counts = np.full(len(phrases), self.root), np.zeros(len(phrases), np.int64)
        for step in range(depth):
            going = np.flatnonzero(codes[:, step] != -1)
            code = codes[going, step]
            key = state[going] * width + code
            at = np.minimum(np.searchsorted(arcs, key), max(len(arcs) - 1, 0))
            hit = (code >= 0) & (arcs[at] == key) if len(arcs) else np.zeros(len(going), bool)
            counts[going] = np.where(hit, self.counts[at], 0) if len(arcs) else 0
            state[going] = np.where(hit, self.targets[at], 0) if len(arcs) else 0
        return counts

    def packed(self) -> bytes:
        """Numbers of 4 bytes, counts of 8 if one needs them, compressed."""
        wide = len(self.counts) and int(self.counts.max()) >= 1 << 32
        listed = b" ".join(self.words)
        head = np.array([len(self.sizes), len(self.labels), wide, len(listed), self.root], "<u8")
        body = b"".join([head.tobytes(), self.sizes.astype("<u4").tobytes(), self.labels.astype("<u4").tobytes(),
                         self.counts.astype("<u8" if wide else "<u4").tobytes(), self.targets.astype("<u4").tobytes(), listed])
        return len(body).to_bytes(8, "little") + pa.compress(body, "zstd", asbytes=True)

    @classmethod
    def unpacked(cls, data: bytes) -> CountAutomaton:
        body = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
        states, arcs, wide, listed, root = np.frombuffer(body, "<u8", 5).tolist()
        at, columns = 40, []
        for kind, n in (("<u4", states), ("<u4", arcs), ("<u8" if wide else "<u4", arcs), ("<u4", arcs)):
            column = np.frombuffer(body, kind, n, at)
            columns.append(column.astype(np.int64))
            at += column.nbytes
        return cls(body[at:at + listed].split(b" ") if listed else [], root, *columns)
