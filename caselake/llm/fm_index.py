"""A bidirectional FM-index over a delimited list of words, for many searches at once.

The text is ``0 w1 0 w2 ... 0 wn`` read as a ring, with 0 as the delimiter. An interval of
suffix ranks is kept for the text and, in step with it, one for the text read backwards:
(low, low backwards, size). Adding a symbol in front narrows the first and moves the
second by the number of smaller symbols, adding one behind does the reverse. All steps
take arrays of intervals; ranks of symbols come from one bitmap per symbol with a count
per 64 places.
"""

from __future__ import annotations

import numpy as np

PLACES = 4096  # intervals that are tried with all symbols together


def ring_order(text: np.ndarray) -> np.ndarray:
    """Starts of the rotations of ``text`` in order, by doubling the compared length."""
    n = len(text)
    most = int(text.max()) + 1
    bits = max(1, most.bit_length())
    width = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for shift in range(width):  # the first symbols packed into one number
        key = key << bits | np.roll(text, -shift)
    order = np.argsort(key, kind="stable")
    held = key[order]
    while True:
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], held[1:] != held[:-1]]))
        if rank[order[-1]] == n - 1 or width >= 2 * n:
            return order
        key = rank * n + np.roll(rank, -width)
        order = np.argsort(key, kind="stable")
        held = key[order]
        width *= 2


class Ranks:
    """Number of symbols below c among the first i, for every c up to ``symbols``."""

    def __init__(self, last: np.ndarray, symbols: int):
        n = len(last)
        blocks = n // 64 + 1
        padded = np.full(blocks * 64, symbols, np.int64)
        padded[:n] = last
        self.bits = np.empty((blocks, symbols + 1), np.uint64)
        for c in range(symbols + 1):
            self.bits[:, c] = np.packbits(padded < c, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.bits).astype(np.int64)
        self.before = np.concatenate([np.zeros((1, symbols + 1), np.int64), np.cumsum(counts, 0)[:-1]])

    def below(self, i: np.ndarray, c: np.ndarray) -> np.ndarray:
        block = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block, c] + np.bitwise_count(self.bits[block, c] & mask)

    def below_all(self, i: np.ndarray) -> np.ndarray:
        """One row per i, one column per symbol."""
        block = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.bits[block] & mask[:, None])


class WordIndex:
    """Index of different, non-empty words; symbols are numbered from 1 in code-point order."""

    def __init__(self, words: list[str]):
        self.words = words
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        self.alphabet, own = np.unique(points, return_inverse=True)
        sizes = np.array([len(word) for word in words])
        self.starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        text = np.zeros(len(points) + len(words), np.int64)
        text[np.delete(np.arange(len(text)), self.starts)] = own + 1
        self.symbols = len(self.alphabet) + 1
        self.order = ring_order(text)
        self.front = Ranks(text[self.order - 1], self.symbols)
        back = text[::-1]
        self.back = Ranks(back[ring_order(back) - 1], self.symbols)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.symbols))])

    def coded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts one after another, -1 for one that no word has; their sizes."""
        points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == points, at + 1, -1), np.array([len(t) for t in texts], np.int64)

    def put(self, at_front: bool, low: np.ndarray, other: np.ndarray, size: np.ndarray, c: np.ndarray):
        """Intervals after the symbol ``c`` in front (or behind): ``low`` and ``other`` are the
        interval's starts in the text and in the text read backwards (or the reverse)."""
        ranks = self.front if at_front else self.back
        below, below_end = ranks.below(low, c), ranks.below(low + size, c)
        own, own_end = ranks.below(low, c + 1) - below, ranks.below(low + size, c + 1) - below_end
        return self.first[c] + own, other + (below_end - below), own_end - own

    def put_all_behind(self, low_back: np.ndarray, low: np.ndarray, size: np.ndarray):
        """(interval number, symbol, low, low backwards, size) of all live ways to go on."""
        out = []
        for start in range(0, len(size), PLACES):
            at = slice(start, start + PLACES)
            below, below_end = self.back.below_all(low_back[at]), self.back.below_all(low_back[at] + size[at])
            counts = np.diff(below_end, axis=1) - np.diff(below, axis=1)
            which, c = np.nonzero(counts[:, 1:])
            c += 1
            out.append((which + start, c, low[at][which] + (below_end - below)[which, c],
                        self.first[c] + (below[which, c + 1] - below[which, c]), counts[which, c]))
        return [np.concatenate(parts) for parts in zip(*out)] if out else [np.zeros(0, np.int64)] * 5

    def one_edit(self, queries: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, word) where the word differs by exactly one inserted, deleted or
        replaced symbol and has the query's first ``exact`` symbols; every pair once.

        The exact part is matched from its end to the delimiter in front; then the rest is
        read from there to the delimiter behind, with one error allowed.
        """
        codes, sizes = self.coded(queries)
        offset = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        count = len(queries)
        low, back = np.zeros(count, np.int64), np.zeros(count, np.int64)
        size = np.full(count, len(self.order))
        alive = np.arange(count)
        for step in range(int(exact.max(initial=0)) + 1):
            alive = alive[(size[alive] > 0) & (step <= exact[alive])]
            place = exact[alive] - 1 - step
            c = np.where(place >= 0, codes[np.minimum(offset[alive] + np.maximum(place, 0), len(codes) - 1)], 0)
            size[alive[c < 0]] = 0
            alive, c = alive[c >= 0], c[c >= 0]
            low[alive], back[alive], size[alive] = self.put(True, low[alive], back[alive], size[alive], c)
        query = np.flatnonzero(size > 0)
        even = (query, exact[query], low[query], back[query], size[query])  # no error so far
        odd = [np.zeros(0, np.int64)] * 5  # one error
        found = []

        def symbol(query, place):
            """The query's symbol, the delimiter behind its last one."""
            at = np.minimum(offset[query] + place, len(codes) - 1)
            return np.where(place < sizes[query], codes[at], 0)

        while len(even[0]) or len(odd[0]):
            which, c, low, back, size = self.put_all_behind(even[3], even[2], even[4])
            query, place = even[0][which], even[1][which]
            wanted, open_ = symbol(query, place), place < sizes[query]
            one = (query, place, low, back, size)
            same = open_ & (c == wanted)
            replaced = open_ & (c != wanted)
            skipped = even[1] < sizes[even[0]]
            # One error: what is read with it from here on must match.
            states = [odd, [a[skipped] for a in (even[0], even[1] + 1, *even[2:])],
                      [a[replaced] for a in (query, place + 1, low, back, size)], list(one)]
            query, place, low, back, size = (np.concatenate(parts) for parts in zip(*states))
            even = tuple(a[same] for a in (one[0], one[1] + 1, *one[2:]))
            c = symbol(query, place)
            known = c >= 0
            query, place, low, back, size, c = (a[known] for a in (query, place, low, back, size, c))
            back, low, size = self.put(False, back, low, size, c)
            live = size > 0
            done = live & (c == 0)
            # Matched with both delimiters, so the interval is one place: the word's start.
            found.append((query[done], np.searchsorted(self.starts, self.order[low[done]])))
            going = live & (c != 0)
            odd = [a[going] for a in (query, place + 1, low, back, size)]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs = np.unique(np.concatenate([q for q, _ in found]) * len(self.words) + np.concatenate([w for _, w in found]))
        return np.divmod(pairs, len(self.words))
