"""Class balance and text-length profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caselake.functions.text import char_length


def class_balance(df: DataFrame, label: str = "product") -> DataFrame:
    """Rows per label, largest first."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), label)


def _length_counts(df: DataFrame, text: str, *keys: str) -> DataFrame:
    """Rows per text length: exact statistics follow from this small table."""
    lengths = df.filter(F.col(text).isNotNull()).select(*keys, char_length(F.col(text)).alias("length"))
    return lengths.groupBy(*keys, "length").agg(F.count(F.lit(1)).alias("n"))


def length_profile(df: DataFrame, text: str = "narrative") -> DataFrame:
    """One row: count, mean, sample deviation, minimum, exact quartiles, maximum.

    Moments are whole-number sums, so the result does not depend on how the rows
    are spread over tasks.
    """
    n, length = F.col("n").cast("decimal(38,0)"), F.col("length").cast("decimal(38,0)")
    quartiles = F.expr("percentile(length, array(0.25D, 0.5D, 0.75D), n)")
    sums = _length_counts(df, text).agg(
        F.sum("n").alias("count"),
        F.sum((n * length).cast("decimal(38,0)")).alias("s1"),
        F.sum((n * length * length).cast("decimal(38,0)")).alias("s2"),
        F.min("length").alias("min"),
        quartiles.alias("q"),
        F.max("length").alias("max"),
    )
    count = F.col("count").cast("decimal(38,0)")
    spread = (count * F.col("s2") - F.col("s1") * F.col("s1")).cast("double")
    pairs = F.col("count").cast("double") * (F.col("count") - 1)
    return sums.select(
        "count",
        F.try_divide(F.col("s1").cast("double"), F.col("count")).alias("mean"),
        F.sqrt(F.try_divide(spread, pairs)).alias("std"),
        "min",
        F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"),
        "max",
    )


def length_box(df: DataFrame, group: str = "product", text: str = "narrative") -> DataFrame:
    """Box-plot numbers of the text length per group, outliers left out.

    Whiskers are the outermost lengths within 1.5 interquartile ranges. The
    window runs over at most one row per different length of a group.
    """
    quartiles = F.percentile("length", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n"))
    boxed = _length_counts(df, text, group).withColumn("q", quartiles.over(Window.partitionBy(group)))
    reach = F.lit(1.5) * (F.col("q")[2] - F.col("q")[0])
    low, high = F.col("q")[0] - reach, F.col("q")[2] + reach
    return boxed.groupBy(group).agg(
        F.sum("n").alias("count"),
        F.min(F.when(F.col("length") >= low, F.col("length"))).alias("whisker_low"),
        F.first(F.col("q")[0]).alias("q1"),
        F.first(F.col("q")[1]).alias("median"),
        F.first(F.col("q")[2]).alias("q3"),
        F.max(F.when(F.col("length") <= high, F.col("length"))).alias("whisker_high"),
    )
