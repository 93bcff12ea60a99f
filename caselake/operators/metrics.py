"""Evaluation of predicted labels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.functions.stats import t_critical


def mean_ci(
    df: DataFrame, value: str, by: Sequence[str] = (), confidence: float = 0.95
) -> DataFrame:
    """Mean and half width of its t interval; one value alone has no width (NaN)."""
    stats = df.groupBy(*by).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd")
    )
    width = t_critical(F.col("n") - 1, confidence) * F.col("sd") / F.sqrt(F.col("n"))
    half = F.when(F.col("n") < 2, F.lit(float("nan"))).otherwise(width)
    return stats.withColumn("half_width", half).select(
        *by, "n", "mean", "half_width",
        format_ci(F.col("mean"), F.col("half_width")).alias("summary"),
    )


def format_ci(mean: Column, half_width: Column, decimals: int = 3) -> Column:
    """Text like ``0.836 ± 0.007``."""
    number = f"%.{decimals}f"

    def show(c: Column) -> Column:
        return F.when(F.isnan(c), "nan").otherwise(F.format_string(number, c))

    return F.concat(show(mean), F.lit(" ± "), show(half_width))


def confusion_matrix(
    df: DataFrame, true: str = "true_product", pred: str = "baseline_pred",
    labels: Sequence[str] | None = None,
) -> DataFrame:
    """One row per cell over the true labels (or a given list), empty cells included.

    Predictions outside the labels have no column. Cells come from counts plus a
    zero for every label pair; the pairs are an explode of the label set.
    """
    counts = df.groupBy(F.col(true).alias("true_label"), F.col(pred).alias("pred_label")).agg(
        F.count(F.lit(1)).alias("count")
    )
    if labels is None:
        label_set = counts.agg(F.array_sort(F.collect_set("true_label"))).scalar()
    else:
        label_set = F.array(*[F.lit(p) for p in labels])
    spark = df.sparkSession
    zeros = (
        spark.range(1)
        .select(F.explode(label_set).alias("true_label"))
        .select("true_label", F.explode(label_set).alias("pred_label"))
        .withColumn("count", F.lit(0).cast("bigint"))
    )
    inside = F.array_contains(label_set, F.col("true_label")) & F.array_contains(
        label_set, F.col("pred_label")
    )
    return (
        counts.filter(inside).unionByName(zeros)
        .groupBy("true_label", "pred_label")
        .agg(F.sum("count").alias("count"))
        .orderBy("true_label", "pred_label")
    )


def class_scores(
    df: DataFrame, true: str = "true_product", pred: str = "baseline_pred",
    by: Sequence[str] = (),
) -> DataFrame:
    """Hits, predicted and actual rows with precision, recall and F1 per label.

    Labels are those that occur on either side; an empty denominator scores 0.
    """
    counts = df.groupBy(*by, F.col(true).alias("_t"), F.col(pred).alias("_p")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("_t") == F.col("_p"), F.col("_n")).otherwise(zero)
    sides = F.explode(F.array(
        F.struct(F.col("_t").alias("label"), hit.alias("tp"),
                 zero.alias("predicted"), F.col("_n").alias("actual")),
        F.struct(F.col("_p").alias("label"), zero.alias("tp"),
                 F.col("_n").alias("predicted"), zero.alias("actual")),
    ))
    totals = (
        counts.select(*by, sides.alias("s")).select(*by, "s.*")
        .filter(F.col("label").isNotNull())
        .groupBy(*by, "label")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "predicted", "actual")])
    )

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    return totals.select(
        *by, "label", "tp", "predicted", "actual",
        ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        ratio(F.col("tp"), F.col("actual")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("predicted") + F.col("actual")).alias("f1"),
    )


def macro_f1(
    df: DataFrame, true: str = "true_product", pred: str = "baseline_pred",
    by: Sequence[str] = (),
) -> DataFrame:
    """Unweighted and support-weighted mean F1, and accuracy, over all rows or per ``by``."""
    return class_scores(df, true, pred, by).groupBy(*by).agg(
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("actual")) / F.sum("actual")).alias("weighted_f1"),
        (F.sum("tp") / F.sum("actual")).alias("accuracy"),
    )


def classification_report(
    df: DataFrame, true: str = "true_product", pred: str = "baseline_pred"
) -> DataFrame:
    """Per-label scores followed by the accuracy, macro and weighted rows."""
    scores = class_scores(df, true, pred)
    support = F.col("actual").cast("double")
    per_label = scores.select(
        F.lit(0).alias("_at"), "label", "precision", "recall",
        F.col("f1").alias("f1-score"), support.alias("support"),
    )
    total = F.sum(support)
    accuracy = F.sum("tp") / total

    def weighted(c: str) -> Column:
        return F.sum(F.col(c) * support) / total

    def summary(at: int, name: str, *values: Column) -> Column:
        fields = zip(("precision", "recall", "f1-score", "support"), values)
        return F.struct(F.lit(at).alias("_at"), F.lit(name).alias("label"),
                        *[v.alias(f) for f, v in fields])

    summaries = scores.agg(F.array(
        summary(1, "accuracy", accuracy, accuracy, accuracy, accuracy),
        summary(2, "macro avg", F.avg("precision"), F.avg("recall"), F.avg("f1"), total),
        summary(3, "weighted avg", weighted("precision"), weighted("recall"), weighted("f1"), total),
    ).alias("rows")).select(F.inline("rows"))
    return per_label.unionByName(summaries).orderBy("_at", "label").drop("_at")


def report_identities(
    report: DataFrame, predicted: DataFrame, true: str = "true_product", pred: str = "baseline_pred",
    within: float = 1e-9,
) -> DataFrame:
    """(label, support, agrees) for every row of a classification report.

    A class agrees when its F1 is 2PR / (P + R) and its recall is the share of its own rows
    predicted right; the three rows at the end when they are the share of all rows predicted
    right, the plain and the support-weighted means of the classes' scores. ``support`` is
    the number of rows that a report row stands for; the report itself has the accuracy
    in all columns of its row.
    """
    names = ("accuracy", "macro avg", "weighted avg")
    scores = ("precision", "recall", "f1-score")
    right = F.avg((F.col(true) == F.col(pred)).cast("double"))
    classes = report.filter(~F.col("label").isin(*names))
    total = F.sum("support")

    def near(a: Column, b: Column) -> Column:
        return F.abs(a - b) <= within

    p, rc, f = (F.col(c) for c in scores)
    harmonic = F.coalesce(F.try_divide(2 * p * rc, p + rc), F.lit(0.0))
    own = predicted.groupBy(F.col(true).alias("label")).agg(right.alias("right"))
    per_class = classes.join(own, "label", "left").select(
        "label", "support", (near(f, harmonic) & near(rc, F.coalesce("right", F.lit(0.0)))).alias("agrees"))
    whole = predicted.agg(right.alias("right")).crossJoin(classes.agg(
        total.alias("total"),
        *[F.avg(c).alias(f"macro {c}") for c in scores],
        *[(F.sum(F.col(c) * F.col("support")) / total).alias(f"weighted {c}") for c in scores]))
    means = report.filter(F.col("label").isin(*names)).crossJoin(whole)
    expected = [
        F.when(F.col("label") == "accuracy", F.col("right"))
        .when(F.col("label") == "macro avg", F.col(f"macro {c}")).otherwise(F.col(f"weighted {c}"))
        for c in scores
    ]
    support = F.when(F.col("label") == "accuracy", F.col("right")).otherwise(F.col("total"))
    ok = reduce(Column.__and__, [near(F.col(c), e) for c, e in zip([*scores, "support"], [*expected, support])])
    return per_class.unionByName(means.select("label", F.col("total").alias("support"), ok.alias("agrees")))


def compare_same_rows(
    baseline: DataFrame, external: DataFrame, id_col: str = "complaint_id",
    true: str = "true_product", baseline_pred: str = "baseline_pred",
    external_pred: str = "external_pred",
) -> DataFrame:
    """Both classifiers on the rows both have scored.

    The external accuracy is given over parseable rows and over all rows.
    """
    both = baseline.select(id_col, true, baseline_pred).join(
        external.select(id_col, external_pred), id_col
    )
    right = F.col(external_pred) == F.col(true)
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg((F.col(baseline_pred) == F.col(true)).cast("double")).alias("baseline_acc"),
        F.avg(right.cast("double")).alias("external_acc_parseable_only"),
        F.avg(F.coalesce(right, F.lit(False)).cast("double")).alias("external_acc_all_rows"),
        F.count_if(F.col(external_pred).isNull()).alias("external_unparseable"),
    )
