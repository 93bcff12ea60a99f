"""Category, response and entity marts.

Every mart is a re-aggregation of additive measures, so it takes either the
facts (through ``measures``) or a much smaller ``case_cube`` built in one scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURES = ("cases", "timely", "days_sum", "days_known", "length_sum", "length_known")
CUBE_KEYS = ("product", "company", "company_response")

# Volume cut and size of the entity mart.
MIN_COMPANY_CASES = 10
TOP_COMPANIES = 25


def _one(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).cast("bigint")


def measures(facts: DataFrame) -> DataFrame:
    """Keys and per-row measures; an unknown timeliness counts as not timely."""
    return facts.select(
        *CUBE_KEYS,
        F.lit(1).cast("bigint").alias("cases"),
        _one(F.col("was_timely")).alias("timely"),
        F.col("days_to_route").alias("days_sum"),
        _one(F.col("days_to_route").isNotNull()).alias("days_known"),
        F.col("narrative_length").alias("length_sum"),
        _one(F.col("narrative_length").isNotNull()).alias("length_known"),
    )


def case_cube(facts: DataFrame) -> DataFrame:
    """Measures summed per product, company and response: the common grain of the marts."""
    return measures(facts).groupBy(*CUBE_KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])


def _cases() -> Column:
    return F.sum("cases").alias("complaint_count")


def _pct_timely() -> Column:
    return F.round(F.lit(100.0) * F.sum("timely") / F.sum("cases"), 1).alias("pct_timely_response")


def _mean(total: str, known: str, digits: int) -> Column:
    return F.round(F.try_divide(F.sum(total), F.sum(known)), digits)


def mart_by_category(measured: DataFrame) -> DataFrame:
    """Volume, text length, timeliness, routing delay and entities per product."""
    return (
        measured.groupBy("product")
        .agg(
            _cases(),
            _mean("length_sum", "length_known", 0).alias("avg_narrative_length"),
            _pct_timely(),
            _mean("days_sum", "days_known", 1).alias("avg_days_to_route"),
            F.countDistinct("company").alias("distinct_companies"),
        )
        .orderBy(F.desc("complaint_count"), "product")
    )


def mart_by_response(measured: DataFrame) -> DataFrame:
    """Volume, timeliness and routing delay per response type."""
    return (
        measured.groupBy("company_response")
        .agg(_cases(), _pct_timely(), _mean("days_sum", "days_known", 1).alias("avg_days_to_route"))
        .orderBy(F.desc("complaint_count"), "company_response")
    )


def mart_top_companies(
    measured: DataFrame, min_cases: int = MIN_COMPANY_CASES, limit: int = TOP_COMPANIES
) -> DataFrame:
    """The companies with most cases; ties at the cut go by name."""
    return (
        measured.groupBy("company")
        .agg(_cases(), _pct_timely(), F.countDistinct("product").alias("distinct_products"))
        .filter(F.col("complaint_count") >= min_cases)
        .orderBy(F.desc("complaint_count"), "company")
        .limit(limit)
    )


def reconcile(staged: DataFrame, by_category: DataFrame, by_response: DataFrame) -> DataFrame:
    """Case totals of the facts and of both full marts; one row, all equal when sound."""
    parts = [
        staged.agg(F.count(F.lit(1)).alias("n")).select(F.lit("staged").alias("part"), "n"),
        by_category.agg(F.sum("complaint_count").alias("n")).select(F.lit("category"), "n"),
        by_response.agg(F.sum("complaint_count").alias("n")).select(F.lit("response"), "n"),
    ]
    table = parts[0].union(parts[1]).union(parts[2])
    total = {p: F.coalesce(F.sum(F.when(F.col("part") == p, F.col("n"))), F.lit(0))
             for p in ("staged", "category", "response")}
    return table.agg(
        total["staged"].alias("staged_cases"),
        total["category"].alias("category_cases"),
        total["response"].alias("response_cases"),
    ).withColumn(
        "reconciled",
        (F.col("staged_cases") == F.col("category_cases"))
        & (F.col("staged_cases") == F.col("response_cases")),
    )
