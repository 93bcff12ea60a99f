import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from caselake.operators import marts, ranking
from caselake.operators.ranking import average_rate, rank_by_rate, rate_by_pair, underperformers
from caselake.operators.staging import stage_cases

FLAGS = "product string, company string, was_timely boolean"


@pytest.fixture()
def flags(spark):
    def make(*groups):
        rows = [(p, c, flag) for p, c, flag, n in groups for _ in range(n)]
        return spark.createDataFrame(rows, FLAGS)

    return make


def test_only_the_below_average_company(flags):
    df = flags(("Mortgage", "BankA", True, 5), ("Mortgage", "BankB", True, 1), ("Mortgage", "BankB", False, 4))
    assert [tuple(r) for r in underperformers(df).collect()] == [("Mortgage", "BankB", 5, 20.0, 60.0, 1)]


def test_low_volume_is_not_judged_but_counts_in_the_average(flags):
    df = flags(("Mortgage", "BankA", True, 5), ("Mortgage", "BankC", False, 2))
    assert underperformers(df).collect() == []
    assert average_rate(df).collect()[0]["category_avg_pct_timely"] == 71.4


def test_nobody_below_when_all_are_equal(flags):
    assert underperformers(flags(("M", "A", True, 5), ("M", "B", True, 5))).collect() == []


def test_unknown_flags(flags):
    df = flags(("M", "A", True, 5), ("M", "B", True, 4), ("M", "B", None, 4), ("M", "C", None, 5),
               ("M", "D", False, 5), (None, "E", False, 5))
    rates = {r["company"]: r["pct_timely_response"] for r in rate_by_pair(df).filter("product = 'M'").collect()}
    assert rates == {"A": 100.0, "B": 50.0, "C": None, "D": 0.0}
    # the pair without a rate ranks first and is then not below anything
    assert [(r["company"], r["rank_within_category"]) for r in underperformers(df).collect()] == [
        ("D", 2), ("B", 3),
    ]


def test_comparison_after_rounding(flags):
    # 1999 of 2000 is 99.95 and rounds to 100.0, the average 99.97 rounds to 100.0
    df = flags(("M", "A", True, 1999), ("M", "A", False, 1), ("M", "B", True, 2000))
    assert underperformers(df).collect() == []


def test_ranks_share_and_leave_gaps_like_a_window(spark):
    pairs = spark.range(0, 4000, 1, 4).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("product"),
        F.col("id").cast("string").alias("company"),
        F.when(F.col("id") % 11 > 0, F.round(F.pmod(F.xxhash64("id"), F.lit(50)) / 7.0, 1)).alias("pct_timely_response"),
    )
    window = Window.partitionBy("product").orderBy(F.col("pct_timely_response").asc_nulls_first())
    expected = pairs.withColumn("rank_within_category", F.rank().over(window).cast("bigint"))
    got = rank_by_rate(pairs).select(expected.columns)
    assert got.exceptAll(expected).count() == 0 and got.count() == 4000


def test_facts_are_read_once(spark, tmp_path, flags):
    path = str(tmp_path / "facts")
    flags(("M", "A", True, 5), ("M", "B", False, 5)).write.parquet(path)
    result = underperformers(spark.read.parquet(path))
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1, plan


def test_marts_from_facts_and_cube(make_raw):
    raw = make_raw(
        *[{"company": f"C{i % 3}", "timely": ["Yes", "No", None][i % 3], "product": f"P{i % 2}",
           "company_response": f"R{i % 4}"} for i in range(40)],
        {"date_sent_to_company": None, "company": None},
    )
    facts = stage_cases(raw)
    rows, cube = marts.measures(facts), marts.case_cube(facts)
    for mart in (marts.mart_by_category, marts.mart_by_response, marts.mart_top_companies):
        assert [tuple(r) for r in mart(rows).collect()] == [tuple(r) for r in mart(cube).collect()]
    by_category = {r["product"]: r for r in marts.mart_by_category(cube).collect()}
    assert by_category["Mortgage"]["avg_days_to_route"] is None
    assert by_category["Mortgage"]["distinct_companies"] == 0
    assert by_category["P0"]["pct_timely_response"] == 35.0  # unknown counts as not timely
    sums = marts.reconcile(facts, marts.mart_by_category(cube), marts.mart_by_response(cube)).collect()[0]
    assert tuple(sums) == (41, 41, 41, True)


def test_top_companies_break_ties_by_name(make_raw):
    raw = make_raw(*[{"company": f"C{i % 30:02d}"} for i in range(300)])
    cube = marts.case_cube(stage_cases(raw))
    assert [r["company"] for r in marts.mart_top_companies(cube).collect()] == [f"C{i:02d}" for i in range(25)]
    assert marts.mart_top_companies(cube, min_cases=11).count() == 0


def test_any_rate_keeps_its_own_rank(spark):
    """Null comes first and shares its rank with no number, negative ones included."""
    pairs = spark.createDataFrame(
        [("g", "a", None), ("g", "b", -1.0), ("g", "c", -2.0), ("g", "d", -1.0), (None, "e", 3.0)],
        "product string, company string, pct_timely_response double")
    got = {r["company"]: r["rank_within_category"] for r in rank_by_rate(pairs).collect()}
    assert got == {"a": 1, "c": 2, "b": 3, "d": 3, "e": 1}


def test_pairs_are_not_shuffled_by_rate(spark):
    df = spark.range(3000).selectExpr("'g' || id % 3 as product", "'c' || id % 97 as company", "id % 5 > 0 as was_timely")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ranked = ranking.rank_by_rate(ranking.rate_by_pair(df))
        plan = ranked._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        assert ranked.count() == ranking.rate_by_pair(df).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_more_groups_than_may_be_broadcast_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(ranking, "MAX_GROUPS", 2)
    pairs = spark.createDataFrame([(g, "c", 50.0) for g in "abc"], "product string, company string, pct_timely_response double")
    with pytest.raises(Exception, match="more than the 2 groups"):
        ranking.rank_by_rate(pairs).collect()
    assert ranking.rank_by_rate(pairs.filter("product <> 'c'")).count() == 2
