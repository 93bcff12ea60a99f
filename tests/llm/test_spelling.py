"""Spelling variants against brute force: every pair of words compared letter by letter."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from caselake.llm import queries, spelling
from caselake.llm.fm_index import WordIndex
from caselake.llm.spelling import SpellingSpec

SF = "/root/testdata/sf0.001"


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def plain_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(docs, spec):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = plain_lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if spec.drop_every and h % spec.drop_every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if c >= spec.min_count and len(w) >= spec.min_chars}
    near = {w: [t for t in n if one_apart(w, t)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda t: (-n[t], t), default=None)
        form[w] = best if best is not None and n[best] >= spec.ratio * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def found(frame):
    rows = frame.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def random_docs(seed, letters="abÀÿ", count=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(3, 9))) for _ in range(400)]
    return [(i, " ".join(rng.choice(words[:rng.choice([5, 50, 400])]).capitalize() for _ in range(40))) for i in range(count)]


@pytest.mark.parametrize("letters", ["ab", "abc", "aàbÿz"])
def test_index_finds_what_comparing_all_pairs_finds(letters):
    rng = random.Random(len(letters))
    for size in (1, 2, 5, 150, 150):
        some = lambda: "".join(rng.choice(letters) for _ in range(rng.randrange(1, 10)))
        words = sorted({some() for _ in range(size)})
        asked = words + [some() + rng.choice(["", "q", "日"]) for _ in range(40)]
        exact = np.array([rng.randrange(len(q) + 1) for q in asked])
        q, w = WordIndex(words).one_edit(asked, exact)
        pairs = list(zip(q.tolist(), w.tolist()))
        assert len(set(pairs)) == len(pairs)
        assert set(pairs) == {(i, j) for i, a in enumerate(asked) for j, b in enumerate(words)
                              if one_apart(a, b) and b[:exact[i]] == a[:exact[i]]}


def test_long_words_are_searched_whole():
    word = "ab" * 3000
    words = sorted([word, word[:2999] + "c" + word[3000:], word[1:], word + "b"])
    q, w = WordIndex(words).one_edit([word], np.array([1000]))
    assert {words[i] for i in w} == {x for x in words if one_apart(word, x) and x[:1000] == word[:1000]}


@pytest.mark.parametrize("cell_chars", [200_000, 60])  # the second one makes grids of common halves
def test_groups_are_those_of_brute_force(spark, cell_chars):
    docs = random_docs(cell_chars)
    spec = SpellingSpec(min_chars=4, drop_every=7, cell_chars=cell_chars)
    got = found(spelling.variant_groups(spark.createDataFrame(docs, "doc_id bigint, text string"), spec))
    expected = brute(docs, spec)
    assert got == expected and any(form for form, *_ in got.values())
    assert any(form and form != root for form, root, *_ in got.values())  # a chain of two at least


def test_query_over_the_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert found(queries.op11_spelling_variants(spark, SF)) == brute(docs, SpellingSpec(drop_every=97))


def test_ties_nulls_repeats_clashing_names_and_an_empty_table(spark):
    rows = [(None, "abcde abcde abcde"), (None, None), (1, ""), (2, "abcdx " * 6 + "abcdy " * 6), (2, "x1y2" * 500)]
    docs = spark.createDataFrame([(*r, 1, "w") for r in rows + rows], "doc_id bigint, text string, n int, word string")
    got = found(spelling.variant_groups(docs))
    assert got == brute(rows + rows, SpellingSpec())
    assert got["abcde"] == ("abcdx", "abcdx", 6, 2, 12)  # of equal counts the first in code-point order
    assert found(spelling.variant_groups(docs.limit(0))) == {}


def test_a_letter_dropped_from_a_run_of_one_leaves_no_word(spark):
    docs = spark.createDataFrame([(i, "a") for i in range(300)], "doc_id bigint, text string")
    spec = SpellingSpec(min_chars=1, min_count=1, drop_every=97)
    kept = sum(zlib.crc32(f"{i}:a".encode()) % 97 != 0 for i in range(300))
    assert found(spelling.variant_groups(docs, spec)) == {"a": (None, "a", kept, 0, None)}
