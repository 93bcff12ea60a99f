import math
import random

import pytest
from pyspark.sql import functions as F

from caselake.operators import selection
from caselake.operators.external import reliability_summary
from caselake.operators.selection import exact_quantiles, first_per_group, values_at
from caselake.sources.landed import quota_per_category


def plain(values, share):
    values = sorted(values)
    spot = share * (len(values) - 1)
    low, high = math.floor(spot), math.ceil(spot)
    return values[low] if low == high else (high - spot) * values[low] + (spot - low) * values[high]


@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_of_any_numbers(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([rng.gauss(0, 1), 10 ** rng.uniform(-300, 300), -math.ldexp(rng.random(), -1040), 0.0, 3.25])
              for _ in range(700)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 5, "v double").repartition(3)
    shares = [0.0, 0.1, 0.5, 0.95, 1.0]
    assert exact_quantiles(df, "v", shares) == [plain(values, s) for s in shares]


def test_places_with_infinities_nan_and_outside(spark):
    rows = [math.nan, math.inf, -math.inf, 1.0, 1.0, None]
    df = spark.createDataFrame([(v,) for v in rows], "v double")
    assert values_at(df, "v", [0, 1, 2, 3]) == [-math.inf, 1.0, 1.0, math.inf]
    assert all(math.isnan(v) for v in values_at(df, "v", [4, 5]))
    assert exact_quantiles(df.filter("v is null"), "v", [0.5]) == [None]
    assert exact_quantiles(df.limit(0), "v", [0.5, 0.9]) == [None, None]


def test_a_million_different_latencies(spark):
    """No task holds them: each round sends a histogram."""
    n = 1_000_000
    df = spark.range(n).select(((F.col("id") * 7919) % n / 1000).alias("latency_s"), F.lit("a").alias("true_product"),
                               F.lit("a").alias("baseline_pred"), F.lit("a").alias("external_pred"),
                               F.lit(None).cast("string").alias("error"))
    got = reliability_summary(df).first()
    assert got["p50_latency_s"] == pytest.approx((n - 1) / 2000, abs=1e-9)
    assert got["p95_latency_s"] == pytest.approx(0.95 * (n - 1) / 1000, abs=1e-9)


def first_rows(rows, n):
    by_group = {}
    for row in sorted(rows, key=lambda r: tuple((v is None, v) for v in r[1:])):
        by_group.setdefault(row[0], []).append(row)
    return sorted((r for rows in by_group.values() for r in rows[:n]), key=str)


@pytest.mark.parametrize("few,n", [(5000, 30), (3, 30), (50, 500)])
def test_first_rows_by_several_keys_with_ties_and_nulls(spark, few, n, monkeypatch):
    monkeypatch.setattr(selection, "FEW", few)
    rng = random.Random(n)
    rows = [(rng.choice(["hot", "hot", "hot", "cold", None]), rng.choice([None, -5, 0, 7, rng.randrange(10**12)]),
             rng.choice([None, "", "a", "ab", "é", "日"])) for _ in range(1500)]
    df = spark.createDataFrame(rows, "g string, k bigint, t string").repartition(4)
    got = sorted((tuple(r) for r in first_per_group(df, "g", [F.col("k"), F.col("t")], n).collect()), key=str)
    assert got == first_rows(rows, n)


def test_equal_rows_fill_the_room_that_is_left(spark):
    df = spark.createDataFrame([("g", 1, "x")] * 900 + [("g", 0, "y")] * 3, "g string, k int, t string")
    got = first_per_group(df, "g", [F.col("k")], 10).groupBy("t").count().collect()
    assert {r["t"]: r["count"] for r in got} == {"y": 3, "x": 7}
    assert first_per_group(df, "g", [F.col("k")], 0).count() == 0
    assert first_per_group(df.limit(0), "g", [F.col("k")], 5).count() == 0


def test_dates_and_booleans_order_and_other_types_fail(spark):
    df = spark.sql("select 'g' as g, date '1960-01-01' + int(id) as d, id % 2 = 0 as b from range(2000) t(id)")
    got = {str(r["d"]) for r in first_per_group(df, "g", [F.col("b"), F.col("d")], 2).collect()}
    assert got == {"1960-01-02", "1960-01-04"}
    with pytest.raises(TypeError):
        first_per_group(df, "g", [F.lit(1.5)], 2)


def test_a_large_quota_needs_no_window_over_a_category(spark):
    df = spark.range(40_000).select(
        (F.col("id") * 7 % 40_000).cast("string").alias("complaint_id"),
        F.when(F.col("id") % 10 > 0, "hot").otherwise("cold").alias("product"))
    kept = quota_per_category(df, 5000)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    rows = kept.collect()
    for product in ("hot", "cold"):
        ids = sorted(int(r["complaint_id"]) for r in df.filter(F.col("product") == product).collect())
        assert sorted(int(r["complaint_id"]) for r in rows if r["product"] == product) == ids[:5000]
