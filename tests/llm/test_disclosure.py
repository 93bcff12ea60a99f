"""Terms named by chance, and the measures behind a named one, against brute force."""

import math
import random
import re
from collections import Counter

import pytest

from caselake.llm import pii


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_nothing_is_named_among_random_words(spark, seed):
    rng = random.Random(seed)
    some = lambda n: " ".join(f"w{int(rng.paretovariate(0.7)) % 900}" for _ in range(n))
    rows = [(i, f"{some(14)} x@y.example {some(14)}") for i in range(3000)]
    rows += [(10_000 + i, some(30)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert pii.disclosing_terms(docs).count() == 0


def test_disclosure_and_evidence_are_those_counted_by_hand(spark):
    rng = random.Random(9)
    some = lambda n: " ".join(f"w{rng.randrange(300)}" for _ in range(n))
    texts = [f"{some(9)} Zorblatt {some(2)} x@y.example {some(9)}" for _ in range(60)]
    texts += [f"{some(20)} zorblatt {some(3)}"] * 2 + [some(25) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    words = Counter(w.lower() for t in texts for w in t.split())
    total, n_term = sum(words.values()), words["zorblatt"]
    near = both = 0
    for text in texts:
        before, found, after = text.partition("x@y.example")
        if found:
            context = before.split()[-4:] + after.split()[:4]
            near += len(context)
            both += sum(re.fullmatch("zorblatt", w, re.I) is not None for w in context)
    disclosure = math.log2(both * total / (60 * n_term)) / math.log2(total / 60)
    seen, base = both / n_term, near / total
    evidence = n_term * (seen * math.log(seen / base) + (1 - seen) * math.log((1 - seen) / (1 - base)))
    assert both == 60 and n_term == 62 and evidence > 50
    got = {r["term"]: r["disclosure"] for r in pii.disclosing_terms(docs).collect()}
    assert got == {"zorblatt": pytest.approx(disclosure)}
    # With a chance that asks for more evidence than there is, it is not named.
    assert pii.disclosing_terms(docs, pii.Disclosure(chance=1e-300)).count() == 0
