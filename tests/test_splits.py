import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from caselake.operators import splits
from caselake.operators.splits import (
    fold_ends,
    holdout_quotas,
    sample_per_class,
    stratified_folds,
    stratified_split,
    with_folds,
)
from caselake.session import bounded

# Published class sizes and their held-out supports.
CLASS_SIZES = {"Mortgage": 800, "Checking or savings account": 800, "Student loan": 800,
               "Money transfer, virtual currency, or money service": 798,
               "Vehicle loan or lease": 795, "Credit card": 779}
HELD_OUT = {"Checking or savings account": 160, "Credit card": 156,
            "Money transfer, virtual currency, or money service": 160, "Mortgage": 160,
            "Student loan": 160, "Vehicle loan or lease": 159}


@pytest.fixture(scope="module")
def cases(spark):
    rows = [(i, name) for i, name in enumerate(n for n, size in CLASS_SIZES.items() for _ in range(size))]
    return spark.createDataFrame(rows, "complaint_id bigint, product string").repartition(5).persist()


def by_hash(rows, seed):
    """Class members in seeded order, the slow way."""
    order = {}
    for r in sorted(rows, key=lambda r: (hashlib.md5(f"{seed}:{r['complaint_id']}".encode()).hexdigest())):
        order.setdefault(r["product"], []).append(r["complaint_id"])
    return order


def test_held_out_supports_match_the_published_ones(cases):
    quotas = {r["product"]: r["rank"] for r in holdout_quotas(cases, "product").collect()}
    assert quotas == HELD_OUT


def test_split_takes_the_first_rows_in_seeded_order(cases):
    split = stratified_split(cases).collect()
    test = {r["complaint_id"] for r in split if r["split"] == "test"}
    order = by_hash(cases.collect(), 42)
    assert test == {i for name, ids in order.items() for i in ids[: HELD_OUT[name]]}
    assert len(split) == sum(CLASS_SIZES.values())


@pytest.mark.parametrize("parts", [1, 8])
def test_split_does_not_depend_on_partitions(cases, parts):
    expected = {tuple(r) for r in stratified_split(cases).collect()}
    assert {tuple(r) for r in stratified_split(cases.repartition(parts)).collect()} == expected


def test_other_seed_other_rows_same_sizes(cases):
    a, b = stratified_split(cases), stratified_split(cases, seed=7)
    assert a.exceptAll(b).count() > 0
    sizes = {r["product"]: r["count"] for r in b.filter("split = 'test'").groupBy("product").count().collect()}
    assert sizes == HELD_OUT


def test_folds_are_balanced_per_class_and_in_total(cases):
    rows = stratified_folds(cases).collect()
    assert len(rows) == 3 * sum(CLASS_SIZES.values())
    per_fold = Counter((r["repeat"], r["fold"]) for r in rows)
    assert set(per_fold) == {(r, f) for r in range(3) for f in range(5)}
    assert max(per_fold.values()) - min(per_fold.values()) <= 1
    per_class = Counter((r["repeat"], r["fold"], r["product"]) for r in rows)
    for name, size in CLASS_SIZES.items():
        sizes = [per_class[(r, f, name)] for r in range(3) for f in range(5)]
        assert set(sizes) <= {size // 5, math.ceil(size / 5)}


def test_folds_follow_the_seeded_order(cases):
    wide = with_folds(cases).collect()
    fold = {r["complaint_id"]: r["fold_1"] for r in wide}
    for ids in by_hash(cases.collect(), "42:1").values():
        assert [fold[i] for i in ids] == sorted(fold[i] for i in ids)


def test_classes_smaller_than_the_folds(spark):
    df = spark.createDataFrame([(i, "abc"[min(i, 2)]) for i in range(9)], "complaint_id bigint, product string")
    ends = {}
    for r in fold_ends(df, "product").collect():
        ends.setdefault(r["product"], []).append(r["rank"])
    assert {k: max(v) for k, v in ends.items()} == {"a": 1, "b": 1, "c": 7}
    rows = stratified_folds(df).collect()
    assert len(rows) == 27
    assert sorted(Counter(r["fold"] for r in rows if r["repeat"] == 0).values()) == [1, 2, 2, 2, 2]


def test_sample_takes_whole_small_classes(spark):
    df = spark.createDataFrame([(i, "big" if i >= 5 else "small") for i in range(300)],
                               "complaint_id bigint, product string")
    picked = {r["complaint_id"] for r in sample_per_class(df).collect()}
    order = by_hash(df.collect(), 42)
    assert picked == set(order["small"]) | set(order["big"][:40])


def test_rows_without_a_class_drop_out(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a")], "complaint_id bigint, product string")
    assert {r["complaint_id"] for r in stratified_split(df).collect()} == {1, 3}


def test_large_small_side_uses_a_plain_join(cases, monkeypatch):
    monkeypatch.setattr(splits, "bounded", lambda df: bounded(df, 2))
    assert {tuple(r) for r in stratified_split(cases).collect()} == _with_broadcast(cases, monkeypatch)


def _with_broadcast(cases, monkeypatch):
    monkeypatch.setattr(splits, "bounded", bounded)
    return {tuple(r) for r in stratified_split(cases).collect()}


def test_full_rows_are_not_shuffled(spark, cases):
    wide = cases.withColumn("narrative", F.repeat(F.lit("x"), 100))
    split = stratified_split(wide)
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
