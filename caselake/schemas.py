"""Record layouts shared by the sources, the staging step and the lake."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

# Field names of a landed case record.
RAW_FIELDS = (
    "complaint_id", "product", "sub_product", "issue", "sub_issue",
    "company", "state", "date_received", "date_sent_to_company",
    "company_response", "timely", "complaint_what_happened", "submitted_via",
)
# The training extract carries neither the routing date nor the channel.
TRAINING_FIELDS = tuple(
    f for f in RAW_FIELDS if f not in ("date_sent_to_company", "submitted_via")
)

# The categories a case may belong to, in matching order.
CATEGORIES = (
    "Credit card",
    "Mortgage",
    "Checking or savings account",
    "Student loan",
    "Vehicle loan or lease",
    "Money transfer, virtual currency, or money service",
)

# Ingest limits.
DATE_MIN = "2023-01-01"
DAILY_QUOTA = 500
TRAINING_QUOTA = 800

# Names and types of the staged columns.
STAGED_SCHEMA = T.StructType([
    T.StructField("complaint_id", T.LongType()),
    T.StructField("product", T.StringType()),
    T.StructField("sub_product", T.StringType()),
    T.StructField("issue", T.StringType()),
    T.StructField("sub_issue", T.StringType()),
    T.StructField("company", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("date_received", T.DateType()),
    T.StructField("date_sent_to_company", T.DateType()),
    T.StructField("days_to_route", T.LongType()),
    T.StructField("company_response", T.StringType()),
    T.StructField("was_timely", T.BooleanType()),
    T.StructField("submitted_via", T.StringType()),
    T.StructField("narrative", T.StringType()),
    T.StructField("narrative_length", T.LongType()),
])


def text_schema(fields: Sequence[str] = RAW_FIELDS) -> T.StructType:
    """All-string record: nothing is typed at load time."""
    return T.StructType([T.StructField(f, T.StringType()) for f in fields])


def response_schema(fields: Sequence[str] = RAW_FIELDS) -> T.StructType:
    """One landed search response: ``hits.hits[*]._source.<field>``."""
    hit = T.StructType([T.StructField("_source", text_schema(fields))])
    hits = T.StructType([T.StructField("hits", T.ArrayType(hit))])
    return T.StructType([T.StructField("hits", hits)])
