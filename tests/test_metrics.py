import math

import pytest
from pyspark.sql import functions as F

from caselake.functions.stats import t_quantile
from caselake.operators import profile
from caselake.operators.external import (
    RateLimited,
    call_with_retry,
    external_scores,
    reliability_summary,
)
from caselake.operators.metrics import (
    class_scores,
    classification_report,
    compare_same_rows,
    confusion_matrix,
    macro_f1,
    mean_ci,
)

# Published report (label, precision, recall, F1, support).
REPORT = [
    ("Checking or savings account", 0.7100591715976331, 0.75, 0.729483282674772, 160),
    ("Credit card", 0.8767123287671232, 0.8205128205128205, 0.847682119205298, 156),
    ("Money transfer, virtual currency, or money service", 0.7261904761904762, 0.7625, 0.7439024390243902, 160),
    ("Mortgage", 0.9, 0.95625, 0.9272727272727272, 160),
    ("Student loan", 0.9797297297297297, 0.90625, 0.9415584415584416, 160),
    ("Vehicle loan or lease", 0.8636363636363636, 0.8364779874213837, 0.8498402555910544, 159),
]
ACCURACY, MACRO_F1, WEIGHTED_F1 = 0.8387434554973822, 0.8399565442211139, 0.8399138363558714
PREDICTIONS = "true_product string, baseline_pred string"


@pytest.fixture(scope="module")
def published(spark):
    """A prediction table with exactly the published hits, predictions and supports."""
    hits = {label: round(recall * n) for label, _, recall, _, n in REPORT}
    predicted = {label: round(hits[label] / p) for label, p, _, _, _ in REPORT}
    missed = [label for label, _, _, _, n in REPORT for _ in range(n - hits[label])]
    wrong = [label for label in predicted for _ in range(predicted[label] - hits[label])]
    rows = [(label, label) for label, n in hits.items() for _ in range(n)]
    for offset in range(len(wrong)):  # rotate until no pair agrees
        turned = wrong[offset:] + wrong[:offset]
        if all(a != b for a, b in zip(missed, turned)):
            return spark.createDataFrame(rows + list(zip(missed, turned)), PREDICTIONS)
    raise AssertionError("no pairing")


def test_report_reproduces_the_published_one(published):
    report = {r["label"]: r for r in classification_report(published).collect()}
    for label, precision, recall, f1, support in REPORT:
        got = report[label]
        assert (got["precision"], got["recall"], got["support"]) == pytest.approx((precision, recall, support))
        assert got["f1-score"] == pytest.approx(f1)
    assert report["accuracy"]["support"] == pytest.approx(ACCURACY)
    assert report["macro avg"]["f1-score"] == pytest.approx(MACRO_F1)
    assert report["weighted avg"]["f1-score"] == pytest.approx(WEIGHTED_F1)
    assert report["weighted avg"]["support"] == 955
    assert classification_report(published).collect()[-3]["label"] == "accuracy"


def test_macro_is_not_weighted(published):
    scores = macro_f1(published).collect()[0]
    assert (scores["macro_f1"], scores["weighted_f1"], scores["accuracy"]) == pytest.approx(
        (MACRO_F1, WEIGHTED_F1, ACCURACY)
    )


def test_empty_denominators_score_zero(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "a"), ("c", None)], PREDICTIONS)
    scores = {r["label"]: (r["precision"], r["recall"], r["f1"]) for r in class_scores(df).collect()}
    assert scores["b"] == (0.0, 0.0, 0.0) and scores["c"] == (0.0, 0.0, 0.0)
    assert scores["a"] == pytest.approx((1.0, 0.5, 2 / 3))


def test_confusion_matrix_has_all_cells_of_the_true_labels(spark):
    df = spark.createDataFrame([("b", "a"), ("a", "a"), ("a", "z"), ("b", None)], PREDICTIONS)
    cells = [tuple(r) for r in confusion_matrix(df).collect()]
    assert cells == [("a", "a", 1), ("a", "b", 0), ("b", "a", 1), ("b", "b", 0)]
    given = confusion_matrix(df, labels=["a", "z"]).collect()
    assert [tuple(r) for r in given] == [("a", "a", 1), ("a", "z", 1), ("z", "a", 0), ("z", "z", 0)]
    plan = confusion_matrix(df)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_mean_and_interval(spark):
    df = spark.createDataFrame([("x", 0.80), ("x", 0.84), ("x", 0.85), ("y", 0.5)], "g string, v double")
    got = {r["g"]: r for r in mean_ci(df, "v", ["g"]).collect()}
    sd = math.sqrt(sum((v - 0.83) ** 2 for v in (0.80, 0.84, 0.85)) / 2)
    assert got["x"]["half_width"] == pytest.approx(4.302652729911275 * sd / math.sqrt(3))
    assert got["x"]["summary"] == "0.830 ± 0.066"
    assert math.isnan(got["y"]["half_width"]) and got["y"]["summary"] == "0.500 ± nan"


@pytest.mark.parametrize("dof,confidence,value", [
    (1, 0.95, 12.706204736), (4, 0.95, 2.776445105), (14, 0.95, 2.144786688), (30, 0.95, 2.042272456),
    (100, 0.95, 1.983971519), (5, 0.99, 4.032142984), (10, 0.9, 1.812461123), (10**6, 0.95, 1.959966357),
])
def test_t_values(dof, confidence, value):
    assert t_quantile(dof, confidence) == pytest.approx(value, abs=2e-9)


def test_same_rows_only(spark):
    base = spark.createDataFrame([(1, "a", "a"), (2, "a", "b"), (3, "b", "b"), (4, "b", "b")],
                                 "complaint_id int, true_product string, baseline_pred string")
    ext = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (9, "a")], "complaint_id int, external_pred string")
    got = compare_same_rows(base, ext).collect()[0].asDict()
    assert got["n_rows"] == 3 and got["external_unparseable"] == 1
    assert got["baseline_acc"] == pytest.approx(2 / 3)
    assert got["external_acc_parseable_only"] == 1.0
    assert got["external_acc_all_rows"] == pytest.approx(2 / 3)


def test_retry_rules():
    waits, calls = [], []

    def failing(error, times):
        def call(prompt):
            calls.append(prompt)
            if len(calls) <= times:
                raise error
            return "ok"
        calls.clear(), waits.clear()
        return call

    def run(call, **kw):
        return call_with_retry(call, "p", sleep=waits.append, **kw)

    assert run(failing(TimeoutError("slow"), 2)) == ("ok", None) and waits == [3.0, 3.0]
    assert run(failing(RateLimited("429"), 2)) == ("ok", None) and waits == [6.0, 9.0]
    assert run(failing(RateLimited("429 for key s3cret"), 9), secrets=["s3cret", None]) == (
        "", "429 for key [REDACTED]"
    )
    assert len(calls) == 3
    assert run(failing(ValueError("503"), 9)) == ("", "503") and len(calls) == 1 and waits == []
    assert run(failing(ValueError("503"), 9), max_tries=0) == ("", "max retries exceeded")


def test_external_scores_never_fail_the_job(spark):
    def client():
        def answer(prompt):
            text = prompt.split("Complaint:\n")[1]
            if "broken" in text:
                raise ValueError("503 with token s3cret")
            return "  MORTGAGE. " if "house" in text else "no idea"
        return answer

    df = spark.createDataFrame([(1, "my house"), (2, "broken line"), (3, "else")], "id int, narrative string")
    got = {r["id"]: r for r in external_scores(df, client, secrets=["s3cret"]).collect()}
    assert got[1]["external_pred"] == "Mortgage" and got[1]["external_raw_output"] == "  MORTGAGE. "
    assert (got[2]["external_raw_output"], got[2]["external_pred"]) == ("", None)
    assert got[2]["error"] == "503 with token [REDACTED]"
    assert got[3]["error"] is None and got[3]["external_pred"] is None
    assert all(r["latency_s"] >= 0 for r in got.values())


def test_requests_become_strings_one_at_a_time(spark):
    """A worker's strings stay few however many rows a batch has; beside the batch as it was read."""
    def client():
        import tracemalloc
        tracemalloc.start()
        return lambda prompt: str(tracemalloc.get_traced_memory()[1])

    df = spark.range(3000, numPartitions=1).select("id", F.rpad(F.col("id").cast("string"), 10_000, "x").alias("narrative"))
    got = external_scores(df, client, ["x"]).select("id", "error", F.col("external_raw_output").cast("long").alias("peak")).collect()
    assert sorted(r["id"] for r in got) == list(range(3000)) and not any(r["error"] for r in got)
    assert max(r["peak"] for r in got) < 100_000_000  # a batch of 30 MB of texts and 30 MB of requests, as it is read


def test_scored_rows_keep_their_columns(spark):
    """Nulls, nested and timed columns, and a request that is null."""
    rows = [(1, None, [1, None], 2.5), (2, "house", None, None)]
    df = spark.createDataFrame(rows, "id int, narrative string, many array<int>, x double").withColumns(
        {"at": F.timestamp_seconds(F.lit(5)), "s": F.struct("id", "x"), "m": F.create_map(F.lit("k"), "x")})
    scored = external_scores(df.repartition(3), lambda: (lambda prompt: str(len(prompt))), ["x"])
    assert scored.columns == [*df.columns, "external_raw_output", "latency_s", "error", "external_pred"]
    assert sorted(scored.select(df.columns).collect(), key=lambda r: r["id"]) == sorted(df.collect(), key=lambda r: r["id"])


def test_reliability_keeps_errors_and_invalid_labels_apart(spark):
    rows = [("a", "a", "a", 1.0, None), ("a", "b", "a", 2.0, None), ("a", "a", None, 4.0, None),
            ("b", "b", None, 5.0, "503"), ("b", "b", "a", 3.0, None)]
    df = spark.createDataFrame(rows, "true_product string, baseline_pred string, external_pred string, "
                                     "latency_s double, error string")
    got = reliability_summary(df).collect()[0].asDict()
    assert got == pytest.approx({
        "n_rows": 5, "baseline_acc": 0.8, "external_acc_parseable_only": 2 / 3, "external_acc_all_rows": 0.4,
        "external_unparseable": 2, "errors": 1, "invalid_label": 1, "mean_latency_s": 3.0,
        "p50_latency_s": 3.0, "p95_latency_s": 4.8,
    })


def test_length_profiles(spark):
    df = spark.createDataFrame([("g", "x" * n) for n in (1, 2, 3, 4, 40)] + [("h", "xx"), ("h", None)],
                               "product string, narrative string")
    got = profile.length_profile(df.filter("product = 'g'")).collect()[0].asDict()
    assert got == pytest.approx({"count": 5, "mean": 10.0, "std": 16.8077363, "min": 1, "q1": 2.0,
                                 "median": 3.0, "q3": 4.0, "max": 40})
    boxes = {r["product"]: tuple(r)[1:] for r in profile.length_box(df).collect()}
    assert boxes == {"g": (5, 1, 2.0, 3.0, 4.0, 4), "h": (1, 2, 2.0, 2.0, 2.0, 2)}
    single = profile.length_profile(df.filter("product = 'h'")).collect()[0]
    assert single["count"] == 1 and single["std"] is None
    assert [tuple(r) for r in profile.class_balance(df).collect()] == [("g", 5), ("h", 2)]
