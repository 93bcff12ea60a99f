import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselake.llm import jaccard


def test_unrelated_texts_hardly_meet(spark, monkeypatch):
    """Empty segments are alike in a part of all sets; their keys are given up, links stay."""
    rng = random.Random(7)
    texts = {i: [f"w{rng.randint(0, 5000)}" for _ in range(90)] for i in range(1500)}
    for i in range(0, 50, 5):
        texts[1500 + i] = [*texts[i][:-1], "other"]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id bigint, text string")
    kept, write = {}, jaccard.written

    def written(df, name):
        kept[name] = write(df, name)
        return kept[name]

    monkeypatch.setattr(jaccard, "written", written)
    groups = {r["doc_id"]: r["component_id"] for r in jaccard.link_groups(docs).collect()}
    assert groups == {i: i - 1500 if i >= 1500 else i for i in texts}
    meetings = kept["buckets"].groupBy("key").count().agg(F.sum(F.expr("count * (count - 1) / 2"))).first()[0]
    assert meetings < len(texts)


@pytest.mark.parametrize("ones,more", [(0, 0), (0, 7), (5, 0), (9, 3)])
def test_linked_sets_share_more_keys_than_they_give_up(ones, more):
    spec, rng = jaccard.JaccardSpec(), np.random.default_rng(ones + more)
    for band in jaccard.bands(spec, [(c, 10) for c in range(40)]):
        most = spec.max_difference(band.high + band.upper)
        few = min(ones, most // 2)
        band = replace(band, segments=most + 1 - few + more, one_deletion=few)
        for size in {band.low, (band.low + band.high) // 2, band.high}:
            for partner in {size, size * spec.den // spec.num}:
                # Partners that differ as much as linked sets of their sizes may.
                changed = (spec.max_difference(size + partner) - (partner - size)) // 2
                tokens = rng.integers(0, 1 << 63, partner + changed).astype(np.uint64)
                one, other = np.sort(tokens[:size]), np.sort(tokens[changed:changed + partner])
                keys = [set(jaccard.segment_keys(t, band, 3).tolist()) for t in (one, other)]
                assert len(keys[0] & keys[1]) > max(band.spare(size, spec), band.spare(partner, spec))


def test_no_more_is_left_than_was_there():
    assert jaccard.beyond(3.0, 0) == 3.0
    assert jaccard.beyond(3.0, 3) == pytest.approx(27 / 6 * np.exp(-3) * 3, rel=1e-9)
    assert 0 <= jaccard.beyond(3.0, 30) < 1e-9
