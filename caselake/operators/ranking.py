"""Which entities fall below the average of their own group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: pairs with fewer cases are not judged.
MIN_PAIR_CASES = 5

# Groups whose ranks are broadcast at most: 1,002 rates each, some 50 MB in all.
MAX_GROUPS = 2_000


def _flag_counts(df: DataFrame, group: str, entity: str, flag: str) -> DataFrame:
    """Rows per (group, entity, flag value): the only pass over the facts.

    Pair rates and group averages are both sums over this table, and both need
    the same columns of it, so Spark reuses one exchange for all of them.
    """
    return df.groupBy(group, entity, F.col(flag).alias("_flag")).agg(
        F.count(F.lit(1)).alias("_n")
    )


def _pairs(counts: DataFrame, group: str, entity: str, min_count: int) -> DataFrame:
    hits = F.sum(F.when(F.col("_flag").isNotNull(), F.col("_flag").cast("int") * F.col("_n")))
    return (
        counts.groupBy(group, entity)
        .agg(F.sum("_n").alias("complaint_count"), hits.alias("_hits"))
        .filter(F.col("complaint_count") >= min_count)
        .select(
            group, entity, "complaint_count",
            F.round(F.lit(100.0) * F.col("_hits") / F.col("complaint_count"), 1)
            .alias("pct_timely_response"),
        )
    )


def _averages(counts: DataFrame, group: str) -> DataFrame:
    known = F.when(F.col("_flag").isNotNull(), F.col("_n"))
    hits = F.when(F.col("_flag").isNotNull(), F.col("_flag").cast("int") * F.col("_n"))
    return counts.groupBy(group).agg(
        F.round(F.lit(100.0) * F.try_divide(F.sum(hits), F.sum(known)), 1)
        .alias("category_avg_pct_timely")
    )


def rate_by_pair(
    df: DataFrame, group: str = "product", entity: str = "company", flag: str = "was_timely",
    min_count: int = MIN_PAIR_CASES,
) -> DataFrame:
    """Count and rate per pair with enough cases.

    Unknown flags stay in the denominator; a pair with only unknown flags has no rate.
    """
    return _pairs(_flag_counts(df, group, entity, flag), group, entity, min_count)


def average_rate(df: DataFrame, group: str = "product", flag: str = "was_timely") -> DataFrame:
    """Rate per group over all its rows with a known flag, small entities included."""
    counts = df.groupBy(group, F.col(flag).alias("_flag")).agg(F.count(F.lit(1)).alias("_n"))
    return _averages(counts, group)


def rank_by_rate(
    pairs: DataFrame, group: str = "product", rate: str = "pct_timely_response",
    out: str = "rank_within_category",
) -> DataFrame:
    """Rank inside the group from the lowest rate, ties sharing a rank, null rates first.

    A rate has one decimal, so a group has at most 1,002 different ones. The rank
    is one plus the pairs at lower rates, read off a running sum over that small
    histogram; a group's pairs themselves are never sorted in one task, nor shuffled
    again: the histogram is broadcast, and more than ``MAX_GROUPS`` groups are an error.
    """
    return _with_ranks(pairs, _ranks(pairs, group, rate, out), group, rate)


def _ranks(pairs: DataFrame, group: str, rate: str, out: str) -> DataFrame:
    """(_group, _rate, rank): a row per group and rate that occurs in it."""
    below = (
        Window.partitionBy(group).orderBy(F.col("_rate").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        pairs.groupBy(group, F.col(rate).alias("_rate"))
        .agg(F.count(F.lit(1)).alias("_pairs"))
        .select(
            F.col(group).alias("_group"), "_rate",
            (F.coalesce(F.sum("_pairs").over(below), F.lit(0)) + 1).alias(out),
        )
    )


def _with_ranks(pairs: DataFrame, ranks: DataFrame, group: str, rate: str) -> DataFrame:
    """``pairs`` with what ``ranks`` says about their group and rate, both null-safe.

    Many pairs share a rate, so they do not meet by it: the ranks become one row per group
    with a list by rate, which is counted before it is broadcast.
    """
    others = [c for c in ranks.columns if c not in ("_group", "_rate")]
    lists = ranks.groupBy("_group").agg(F.collect_list(F.struct("_rate", *others)).alias("_list"))
    by_rate = F.map_from_entries(F.transform("_list", lambda e: F.struct(_rate_key(e["_rate"]), e)))
    groups = F.count(F.lit(1)).over(Window.partitionBy())  # of no more than one too many
    checked = lists.limit(MAX_GROUPS + 1).select("_group", by_rate.alias("_by_rate"), groups.alias("_groups")).select(
        "_group", F.when(F.col("_groups") > MAX_GROUPS, F.raise_error(F.lit(
            f"more than the {MAX_GROUPS} groups whose ranks are broadcast")))
        .otherwise(F.col("_by_rate")).alias("_by_rate"))
    found = pairs.join(F.broadcast(checked), F.col(group).eqNullSafe(F.col("_group"))).select(
        *pairs.columns, F.try_element_at("_by_rate", _rate_key(F.col(rate))).alias("_hit"))
    return found.filter(F.col("_hit").isNotNull()).select(
        *pairs.columns, *[F.col(f"_hit.{c}").alias(c) for c in others])


def _rate_key(rate: Column) -> Column:
    """A rate of one decimal as a key; null has its own."""
    return F.coalesce(F.round(rate * 10).cast("int"), F.lit(-(1 << 31)))


def underperformers(
    df: DataFrame, group: str = "product", entity: str = "company", flag: str = "was_timely",
    min_count: int = MIN_PAIR_CASES,
) -> DataFrame:
    """Pairs whose rounded rate lies strictly below the rounded average of their group.

    Ranks are taken after the volume cut and before the comparison; the average
    covers all entities. Groups without a name match no average and drop out.
    """
    counts = _flag_counts(df.filter(F.col(group).isNotNull()), group, entity, flag)
    pairs, rate = _pairs(counts, group, entity, min_count), "pct_timely_response"
    ranks = _ranks(pairs, group, rate, "rank_within_category")
    # The average joins the few rates of a group and drops those not below it, so that
    # the pairs meet one small table and only in the rates that stay.
    low = ranks.join(
        _averages(counts, group).withColumnRenamed(group, "_of"), F.col("_group") == F.col("_of")
    ).filter(F.col("_rate") < F.col("category_avg_pct_timely")).drop("_of")
    return (
        _with_ranks(pairs, low, group, rate)
        .select(
            group, entity, "complaint_count", "pct_timely_response",
            "category_avg_pct_timely", "rank_within_category",
        )
        .orderBy(group, "rank_within_category", entity)
    )
