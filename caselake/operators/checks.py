"""Declarative data checks: each yields (check, model, column, failures)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselake.schemas import CATEGORIES


class CheckFailure(RuntimeError):
    """Raised when a gate finds violations."""


@dataclass(frozen=True)
class ModelChecks:
    """What must hold for one table."""

    unique: Sequence[str] = ()
    not_null: Sequence[str] = ()
    accepted: Mapping[str, Sequence[str]] = field(default_factory=dict)
    non_negative: Sequence[str] = ()


def case_checks(categories: Sequence[str] = CATEGORIES) -> dict[str, ModelChecks]:
    """The 15 checks on the staged facts and the three marts."""
    return {
        "stg_complaints": ModelChecks(
            unique=("complaint_id",),
            not_null=("complaint_id", "product", "narrative", "narrative_length", "was_timely"),
            accepted={"product": categories},
            non_negative=("days_to_route",),
        ),
        "mart_complaints_by_category": ModelChecks(
            unique=("product",), not_null=("product", "complaint_count")
        ),
        "mart_company_response_analysis": ModelChecks(
            unique=("company_response",), not_null=("company_response",)
        ),
        "mart_top_companies": ModelChecks(unique=("company",), not_null=("company",)),
    }


def _tag(df: DataFrame, check: str, model: str, column: str) -> DataFrame:
    return df.select(
        F.lit(check).alias("check"), F.lit(model).alias("model"),
        F.lit(column).alias("column"), F.col("failures").cast("bigint").alias("failures"),
    )


def check_unique(df: DataFrame, column: str, model: str) -> DataFrame:
    """Values that occur more than once; nulls do not count."""
    repeated = df.filter(F.col(column).isNotNull()).groupBy(column).count().filter("count > 1")
    return _tag(repeated.agg(F.count(F.lit(1)).alias("failures")), "unique", model, column)


def check_accepted(df: DataFrame, column: str, values: Sequence[str], model: str) -> DataFrame:
    """Different values outside the list; nulls pass."""
    others = df.filter(~F.col(column).isin(*values)).select(column).distinct()
    return _tag(others.agg(F.count(F.lit(1)).alias("failures")), "accepted_values", model, column)


def _row_checks(
    df: DataFrame, not_null: Sequence[str], non_negative: Sequence[str], model: str
) -> DataFrame:
    """All checks that look at single rows, counted in one pass over the table."""
    rules = [("not_null", c, F.col(c).isNull()) for c in not_null]
    rules += [("non_negative", c, F.col(c) < 0) for c in non_negative]
    totals = df.agg(*[F.count_if(broken).alias(f"_{i}") for i, (_, _, broken) in enumerate(rules)])
    found = F.explode(F.array(*[
        F.struct(
            F.lit(check).alias("check"), F.lit(column).alias("column"),
            F.col(f"_{i}").alias("failures"),
        )
        for i, (check, column, _) in enumerate(rules)
    ])).alias("found")
    return totals.select(found).select(
        "found.check", F.lit(model).alias("model"), "found.column", "found.failures"
    )


def check_not_null(df: DataFrame, columns: Sequence[str], model: str) -> DataFrame:
    """Rows without a value, per column."""
    return _row_checks(df, columns, (), model)


def check_non_negative(df: DataFrame, columns: Sequence[str], model: str) -> DataFrame:
    """Rows with a value below zero, per column; nulls pass."""
    return _row_checks(df, (), columns, model)


def run_checks(
    tables: Mapping[str, DataFrame], checks: Mapping[str, ModelChecks] | None = None
) -> DataFrame:
    """One row per check over all tables."""
    parts = []
    for model, rules in (checks or case_checks()).items():
        df = tables[model]
        if rules.not_null or rules.non_negative:
            parts.append(_row_checks(df, rules.not_null, rules.non_negative, model))
        parts += [check_unique(df, c, model) for c in rules.unique]
        parts += [check_accepted(df, c, values, model) for c, values in rules.accepted.items()]
    return reduce(DataFrame.unionByName, parts)


def require_passed(results: DataFrame) -> None:
    """Raise when any check has violations; the rows fetched are one per check."""
    failed = [r for r in results.collect() if r["failures"]]
    if failed:
        raise CheckFailure("; ".join(
            f"{r['check']} on {r['model']}.{r['column']}: {r['failures']}" for r in failed
        ))
