"""Daily build: raw records to checked marts and a dated lake snapshot."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.operators.checks import ModelChecks, case_checks, require_passed, run_checks
from caselake.operators.marts import (
    case_cube,
    mart_by_category,
    mart_by_response,
    mart_top_companies,
)
from caselake.operators.ranking import underperformers
from caselake.operators.staging import stage_cases
from caselake.schemas import CATEGORIES
from caselake.session import new_path, written_at
from caselake.sources.lake import publish, read_lake, remove, require_rows

# Dataset names in the lake.
FACTS = "stg_complaints"
MARTS = {
    "mart_complaints_by_category": mart_by_category,
    "mart_company_response_analysis": mart_by_response,
    "mart_top_companies": mart_top_companies,
}


def build_tables(raw: DataFrame, folder: str | None = None) -> dict[str, DataFrame]:
    """Staged facts and the three marts, each written under its name in ``folder``.

    Staging, the one step that shuffles texts, is written once; the marts come
    from a cube that reads three keys and three measures of it in one scan. The
    marts, small by then, are written too: every check reads them. Without a ``folder``
    it is a new one in the shared folder.
    """
    folder = folder or new_path(raw.sparkSession, "build")
    staged = written_at(stage_cases(raw), f"{folder}/{FACTS}")
    cube = written_at(case_cube(staged), f"{folder}/cube")
    tables = {name: written_at(mart(cube), f"{folder}/{name}") for name, mart in MARTS.items()}
    tables[FACTS] = staged
    return tables


def run_daily(
    raw: DataFrame, lake_root: str, run_date: str | None = None,
    categories: Sequence[str] = CATEGORIES, checks: Mapping[str, ModelChecks] | None = None,
) -> DataFrame:
    """Build, check, then publish; a failed check or an empty table leaves the lake as it was.

    All tables are written once, beside the lake, and checked there. Publishing renames
    their folders, the facts last. Running a date again replaces that date only.
    Returns (dataset, kind, rows), one row per exported table.
    """
    spark, root = raw.sparkSession, lake_root.rstrip("/")
    day = date.fromisoformat(run_date).isoformat() if run_date else date.today().isoformat()
    names, staged = [*MARTS, FACTS], f"{root}.staging-{uuid.uuid4().hex}"
    try:
        tables = build_tables(raw, staged)
        require_passed(run_checks(tables, checks or case_checks(categories)))
        empty = [name for name in names if tables[name].isEmpty()]
        if empty:
            raise RuntimeError(f"{', '.join(empty)}: 0 rows, refusing to export empty partitions")
        publish(spark, staged, root, names, day)
    finally:
        remove(spark, staged)
    counts = [
        (name, "mart" if name in MARTS else "fact table", read_lake(spark, root, name, day).count())
        for name in names
    ]
    return spark.createDataFrame(counts, "dataset string, kind string, rows bigint")


def lake_underperformers(spark: SparkSession, lake_root: str, run_date: str = "latest") -> DataFrame:
    """Entities below their own category's average, from the staged facts in the lake."""
    facts = read_lake(spark, lake_root, FACTS, run_date)
    require_rows(facts, f"{lake_root}/{FACTS}")
    return underperformers(facts.select("product", "company", F.col("was_timely")))
