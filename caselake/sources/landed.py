"""Readers and writers for landed responses, CSV extracts and metric files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.functions.text import is_present
from caselake.operators.dedupe import first_per_key
from caselake.operators.selection import first_per_group
from caselake.schemas import (
    CATEGORIES,
    DAILY_QUOTA,
    DATE_MIN,
    RAW_FIELDS,
    response_schema,
    text_schema,
)

PEEKS = 16  # files whose header is read at the same time

# Cell texts that mean "no value" in a CSV extract.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)


def read_responses(
    spark: SparkSession, path: str, fields: Sequence[str] = RAW_FIELDS, multi_line: bool = True
) -> DataFrame:
    """Landed search responses to one row per hit; absent fields are null.

    ``multi_line`` takes one pretty-printed response per file; with one response
    per line set it to False, so that large files split over tasks. A response that
    cannot be parsed or has no list of hits, such as an error body, fails the read; an
    empty list is sound. ``rejected_pages`` counts such responses instead.
    """
    hits = _pages(spark, path, fields, multi_line, "FAILFAST").select("hits.hits").select(
        F.coalesce("hits", F.raise_error(F.lit(f"a response under {path} has no hits"))).alias("hits")
    )
    return hits.select(F.explode("hits").alias("h")).select("h._source.*")


def rejected_pages(
    spark: SparkSession, path: str, fields: Sequence[str] = RAW_FIELDS, multi_line: bool = True
) -> DataFrame:
    """One row: how many responses there are, and how many ``read_responses`` fails on."""
    pages = _pages(spark, path, fields, multi_line, "PERMISSIVE")
    return pages.agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(F.col("hits.hits").isNull()).alias("rejected")
    )


def _pages(spark: SparkSession, path: str, fields: Sequence[str], multi_line: bool, mode: str) -> DataFrame:
    return spark.read.schema(response_schema(fields)).options(multiLine=multi_line, mode=mode).json(path)


def source_filter(
    df: DataFrame, categories: Sequence[str] = CATEGORIES, date_min: str = DATE_MIN
) -> DataFrame:
    """Records of the wanted categories, with a narrative, received since ``date_min``."""
    return df.filter(
        F.col("product").isin(*categories)
        & is_present(F.col("complaint_what_happened"))
        & (F.col("date_received") >= F.lit(date_min))
    )


def quota_per_category(
    df: DataFrame, n: int = DAILY_QUOTA, order: Sequence[Column] | None = None,
    group: str = "product", id_col: str = "complaint_id",
) -> DataFrame:
    """At most ``n`` rows per category, the first by ``order``, ascending and nulls last
    (numeric id if not given)."""
    order = order or [F.col(id_col).try_cast("bigint"), F.col(id_col)]
    return first_per_group(df, group, order, n)


def dedupe_by_id(
    df: DataFrame, id_col: str = "complaint_id", order: Sequence[Column] = ()
) -> DataFrame:
    """One row per id. Without an ``order``, the smallest row by its own columns stays."""
    order = order or [F.col(c).asc_nulls_last() for c in df.columns if c != id_col]
    return first_per_key(df, id_col, order)


def union_categories(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of the per-category frames, matched by column name."""
    return reduce(DataFrame.unionByName, parts)


def load_raw(
    spark: SparkSession, path: str, categories: Sequence[str] = CATEGORIES,
    n: int = DAILY_QUOTA, date_min: str = DATE_MIN, fields: Sequence[str] = RAW_FIELDS,
    multi_line: bool = True,
) -> DataFrame:
    """Landed responses to the raw table: filter, quota per category, one row per id.

    Of an id in several categories, the row of the category listed first stays.
    """
    wanted = source_filter(read_responses(spark, path, fields, multi_line), categories, date_min)
    listed = F.array_position(F.array(*map(F.lit, categories)), F.col("product"))
    rest = [F.col(c).asc_nulls_last() for c in fields if c not in ("complaint_id", "product")]
    return dedupe_by_id(quota_per_category(wanted, n), order=[listed, *rest])


def replace_table(df: DataFrame, path: str) -> int:
    """Replace the table at ``path`` by ``df``; returns the rows found there afterwards."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


def csv_layouts(spark: SparkSession, path: str, multi_line: bool = True) -> dict[tuple[str, ...], list[str]]:
    """Files below ``path`` by the names in their own header, in order; empty files are left out.

    Only the beginning of each file is read, ``PEEKS`` files at a time.
    """
    files = sorted(spark.read.text(path).inputFiles())

    def header(file: str) -> tuple[str, ...]:
        return tuple(spark.read.options(**_csv(multi_line)).csv(file).columns)

    with ThreadPoolExecutor(PEEKS) as pool:
        headers = list(pool.map(inheritable_thread_target(spark)(header), files))
    layouts: dict[tuple[str, ...], list[str]] = {}
    for file, names in zip(files, headers):
        if names:
            layouts.setdefault(names, []).append(file)
    return layouts


def _csv(multi_line: bool) -> dict:
    return dict(header=True, multiLine=multi_line, quote='"', escape='"', inferSchema=False)


def read_csv(
    spark: SparkSession, path: str, fields: Sequence[str], null_tokens: Sequence[str] = NULL_TOKENS,
    multi_line: bool = True,
) -> DataFrame:
    """CSV extract as text columns, found by the names in each file's own header.

    Files of one folder may have their columns in any order and unlike ones: there is one
    read per layout, and the results are united by name. Further columns are left out and
    missing ones are null, but a file with none of the ``fields`` is an error, as is a
    folder without any row of names. A header that changes after it was looked at fails
    the read. Quoted cells may hold line breaks; a file with such cells cannot be split, so
    land many files rather than a large one, and set ``multi_line`` to False where cells
    hold none.
    """
    layouts = csv_layouts(spark, path, multi_line)
    for names, files in layouts.items():
        if not set(fields) & set(names):
            raise ValueError(f"{files[0]} has none of the columns {list(fields)}, but {list(names)}")
    if not layouts:
        raise ValueError(f"{path} has none of the columns {list(fields)}, but no header at all")

    def wanted(df: DataFrame) -> DataFrame:
        return df.select(*[
            F.when(~F.col(f"`{f}`").isin(*null_tokens), F.col(f"`{f}`")).alias(f)
            if f in df.columns else F.lit(None).cast("string").alias(f)
            for f in fields
        ])

    return reduce(DataFrame.unionByName, [
        wanted(spark.read.options(**_csv(multi_line), enforceSchema=False).schema(text_schema(names)).csv(files))
        for names, files in layouts.items()
    ])


def write_csv(df: DataFrame, path: str, single_file: bool = False, append: bool = False) -> None:
    """CSV with header. ``single_file`` is for reports, whose size is a few rows; with
    ``append`` the files join those already there."""
    out = df.coalesce(1) if single_file else df
    (
        out.write.mode("append" if append else "overwrite")
        .options(header=True, quote='"', escape='"',
                 ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """``key=value`` lines to (metric, value, number); number is null for text values."""
    parts = F.split("value", "=", 2)
    lines = spark.read.text(path).filter(F.contains("value", F.lit("=")))
    return lines.select(parts[0].alias("metric"), parts[1].alias("value")).withColumn(
        "number", F.col("value").try_cast("double")
    )


def metric_rows(row: DataFrame, formats: Mapping[str, str]) -> DataFrame:
    """A one-row result to (metric, value), each value printed by its format."""
    entries = F.explode(F.array(*[
        F.struct(F.lit(name).alias("metric"), F.format_string(form, name).alias("value"))
        for name, form in formats.items()
    ]))
    return row.select(entries.alias("e")).select("e.metric", "e.value")


def write_metrics(df: DataFrame, path: str) -> None:
    """(metric, value) rows to ``key=value`` lines in one file."""
    df.select(F.concat_ws("=", "metric", "value")).coalesce(1).write.mode("overwrite").text(path)
