"""Phrases against brute force, and the count automata against plain counters."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselake.llm import collocations as C
from caselake.llm import queries
from caselake.llm.collocations import PhraseSpec
from caselake.llm.count_automata import CountAutomaton, count_levels, split, summed

SF = "/root/testdata/sf0.001"


def pieces(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall("[^ \t]+", piece) for piece in re.split("[.,;:!?\n-\r]", lowered)]


def brute(docs, spec):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for m in range(1, spec.max_words + 1):
                for i in range(len(words) - m + 1):
                    counts[lang][tuple(words[i:i + m])] += 1
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= spec.min_count}
        kept = []
        for p, a in found.items():
            longer = [b for q, b in found.items() if len(q) > len(p)
                      and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * b >= spec.covered * a for b in longer):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:spec.top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def listed(frame):
    return sorted(tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def random_docs(seed, count=150, vocabulary=30):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["Über", "日本", "x\x00"]
    some = lambda: words[min(int(rng.paretovariate(0.8)) - 1, len(words) - 1)]
    return [(rng.choice(["en", "en", "de", None]),
             "".join(some() + rng.choice([" ", " ", " ", "\t", ". ", "\n", ", "]) for _ in range(rng.randrange(60))))
            for _ in range(count)]


def plain_counts(ids, depth):
    out = Counter()
    for i in range(len(ids)):
        for m in range(1, depth + 1):
            gram = tuple(ids[i:i + m])
            if len(gram) == m and -1 not in gram:
                out[gram] += 1
    return out


def paths(words, levels):
    out, above = {}, [()]
    for parent, label, count in levels:
        above = [above[p] + (words[w],) for p, w in zip(parent, label)]
        assert above == sorted(above)
        out |= dict(zip(above, count.tolist()))
    return out


def test_automata_hold_the_counts_and_add_up():
    rng = random.Random(4)
    total, parts = Counter(), []
    for _ in range(4):
        words = sorted(rng.sample([b"a", b"b", b"c", b"d", b"e"], 4))
        ids = np.array([rng.choice([-1, 0, 0, 1, 2, 3]) for _ in range(300)])
        expected = Counter({tuple(words[i] for i in gram): n for gram, n in plain_counts(ids.tolist(), 3).items()})
        levels = count_levels(ids, len(words), 3)
        automaton = CountAutomaton.unpacked(CountAutomaton.of(words, levels).packed())
        assert paths(automaton.words, automaton.levels()) == expected
        asked = [*expected, (b"zz",), (b"a", b"zz", b"a"), (b"a", b"a", b"a", b"a")]
        assert automaton.count_of(asked).tolist() == [expected[g] for g in asked]
        total += expected
        parts.append((automaton.words, automaton.levels()))
    assert paths(*summed(parts)) == total


def test_equal_states_are_one():
    words = [b"a", b"b", b"c"]
    ids = np.array([0, 2, -1, 1, 2, -1])  # a c and b c, once each
    automaton = CountAutomaton.of(words, count_levels(ids, 3, 3))
    assert len(automaton.sizes) == 3 and len(automaton.labels) == 4  # none, "then c", the root


def test_ranges_share_out_all_phrases_with_the_way_to_them():
    rng = random.Random(5)
    words = [b"a", b"b", b"c", b"d"]
    ids = np.array([rng.choice([-1, 0, 0, 1, 2, 3]) for _ in range(400)])
    levels = count_levels(ids, 4, 3)
    whole = paths(words, levels)
    for _ in range(30):
        bounds = sorted({tuple(rng.choice([*words, b"bb"]) for _ in range(rng.randrange(1, 4))) for _ in range(4)})
        seen = {}
        for number, cut in split(words, levels, bounds):
            lower = bounds[number - 1] if number else ()
            here = paths(words, cut)
            assert all(whole[p] == n for p, n in here.items())
            own = {p: n for p, n in here.items() if p >= lower}
            assert all(p == lower[:len(p)] for p in here.keys() - own.keys())
            assert not own.keys() & seen.keys()
            assert number == len(bounds) or all(p < bounds[number] for p in own)
            seen |= own
        assert seen == whole


def test_an_empty_automaton():
    automaton = CountAutomaton.unpacked(CountAutomaton.of([], []).packed())
    assert automaton.levels() == [] and automaton.count_of([(b"a",)]).tolist() == [0]


@pytest.mark.parametrize("spec", [
    PhraseSpec(min_count=3),
    PhraseSpec(min_count=3, top=7, range_bytes=300, chunk_words=200, requests=5, sample_keys=4),
    PhraseSpec(min_count=2, max_words=4, covered=70, range_bytes=2000, chunk_words=1000),
])
def test_phrases_are_those_of_brute_force(spark, spec):
    docs = random_docs(spec.top)
    frame = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    assert listed(C.collocations(frame, spec)) == brute(docs, spec)


def test_query_over_the_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text").collect()]
    assert listed(queries.op13_collocations(spark, SF)) == brute(docs, PhraseSpec())


def test_one_very_common_pair_is_spread_over_ranges(spark):
    rng = random.Random(6)
    docs = [("en", " ".join(f"of the k{rng.randrange(50)}" for _ in range(30))) for _ in range(100)]
    spec = PhraseSpec(range_bytes=2_000, chunk_words=500, requests=10)
    frame = spark.createDataFrame(docs, "lang string, text string")
    bounds = C.range_bounds(frame, spec)["en"]
    assert sum(b[:2] == (b"of", b"the") for b in bounds) > 3
    assert listed(C.collocations(frame, spec)) == brute(docs, spec)


def test_ties_at_the_last_rank_go_by_count_then_phrase(spark):
    rows = [("en", f"p{i:03d} q{i:03d}", 10, 10, 10, 1_000_000) for i in range(300)]
    rows += [("en", f"r{i} s", 20, 20, 20, 1_000_000) for i in range(3)] + [("de", "x y", 12, 12, 24, 500_000)]
    scored = spark.createDataFrame(rows, "lang string, phrase string, a bigint, l bigint, r bigint, score bigint")
    got = [(r["lang"], r["rank"], r["phrase"]) for r in C.best(scored, 5).orderBy("lang", "rank").collect()]
    assert got == [("de", 1, "x y"), ("en", 1, "r0 s"), ("en", 2, "r1 s"), ("en", 3, "r2 s"),
                   ("en", 4, "p000 q000"), ("en", 5, "p001 q001")]


def test_products_beyond_64_bits_are_exact(spark):
    big = 4_000_000_000_007
    cuts = spark.createDataFrame([("en", "a b", big - 10, 1, big, big - 1)],
                                 "lang string, phrase string, a bigint, k bigint, l bigint, r bigint")
    score = C.candidates(cuts, PhraseSpec()).first()["score"]
    assert score == 1_000_000 * (big - 10) ** 2 // (big * (big - 1))


def test_nulls_repeats_clashing_names_and_an_empty_table(spark):
    rows = [(None, None), ("en", ""), ("en", "...\n"), (None, "A b " * 30), (None, "A b " * 30), ("und", "a b")]
    docs = spark.createDataFrame(rows, "lang string, text string").withColumn("body", F.lit(1)).withColumn("n", F.lit(2))
    assert listed(C.collocations(docs)) == brute(rows, PhraseSpec())
    assert listed(C.collocations(docs.limit(0))) == []
    assert listed(C.collocations(docs.filter("text = ''"))) == []
