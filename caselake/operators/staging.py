"""Raw text records to typed, de-duplicated case facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselake.functions.text import char_length, strip_whitespace, trim_spaces
from caselake.functions.typing import days_between, iso_date, to_bigint
from caselake.operators.dedupe import first_per_key
from caselake.schemas import STAGED_SCHEMA

# Fixed value: shorter narratives are not real cases.
MIN_NARRATIVE = 20


def type_records(raw: DataFrame, strict: bool = True) -> DataFrame:
    """13 text columns to the 15 typed ones; no row is dropped here."""
    typed = raw.select(
        to_bigint(F.col("complaint_id"), strict).alias("complaint_id"),
        "product", "sub_product", "issue", "sub_issue", "company", "state",
        iso_date(F.col("date_received"), strict).alias("date_received"),
        iso_date(F.col("date_sent_to_company"), strict).alias("date_sent_to_company"),
        "company_response",
        (F.col("timely") == "Yes").alias("was_timely"),
        "submitted_via",
        trim_spaces(F.col("complaint_what_happened")).alias("narrative"),
    )
    return typed.select(
        "*",
        days_between(F.col("date_received"), F.col("date_sent_to_company")).alias("days_to_route"),
        char_length(F.col("narrative")).alias("narrative_length"),
    ).select(*STAGED_SCHEMA.fieldNames())


def stage_cases(
    raw: DataFrame, min_length: int = MIN_NARRATIVE, strict: bool = True
) -> DataFrame:
    """Typed facts with a real narrative, one row per distinct narrative.

    The length cut runs below the window (a null narrative has no length and
    goes too); of equal narratives, anywhere in the table, the lowest id stays.
    """
    long_enough = type_records(raw, strict).filter(F.col("narrative_length") >= min_length)
    return first_per_key(long_enough, "narrative", [F.col("complaint_id").asc_nulls_last()])


def clean_for_training(
    raw: DataFrame,
    text: str = "complaint_what_happened",
    label: str = "product",
    order: str = "complaint_id",
    min_length: int = MIN_NARRATIVE,
) -> DataFrame:
    """Labelled, distinct texts for the classifier.

    Rows without text or label go, all outer white space is stripped, short
    texts go, and of equal texts the first by ``order`` stays.
    """
    kept = (
        raw.dropna(subset=[text, label])
        .withColumn(text, strip_whitespace(F.col(text)))
        .filter(F.length(text) >= min_length)
    )
    return first_per_key(kept, text, [F.col(order).asc_nulls_last()])


def cleaning_report(
    raw: DataFrame,
    text: str = "complaint_what_happened",
    label: str = "product",
    min_length: int = MIN_NARRATIVE,
) -> DataFrame:
    """One row: rows before and after cleaning, duplicates, and missing or short rows.

    Only a 32-byte digest of each text is shuffled.
    """
    stripped = strip_whitespace(F.col(text))
    usable = F.col(label).isNotNull() & (F.length(stripped) >= min_length)
    digests = raw.select(F.when(usable, F.sha2(stripped, 256)).alias("digest"))
    per_text = digests.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    usable_rows = F.coalesce(F.sum(F.when(F.col("digest").isNotNull(), F.col("n"))), F.lit(0))
    return per_text.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
        F.count("digest").alias("rows_after"),
        (usable_rows - F.count("digest")).alias("duplicates"),
        F.coalesce(F.sum(F.when(F.col("digest").isNull(), F.col("n"))), F.lit(0)).alias("missing_or_short"),
    )
