"""Typed casts that fail (or not) regardless of the session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fraction and offset are both required; fraction 1 to 6 digits.
STRICT_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSX"
LENIENT_ISO = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]X"


def _or_fail(typed: Column, source: Column, what: str) -> Column:
    message = F.concat(F.lit(f"not a valid {what}: "), source)
    return F.when(typed.isNull() & source.isNotNull(), F.raise_error(message)).otherwise(typed)


def to_bigint(source: Column, strict: bool = True) -> Column:
    typed = source.try_cast("bigint")
    return _or_fail(typed, source, "integer") if strict else typed


def parse_iso_timestamp(source: Column, strict: bool = True) -> Column:
    """ISO-8601 text with an offset to an instant.

    Strict mode requires the fraction and fails on anything else; lenient mode
    also takes text without a fraction and yields null for the rest.
    """
    if strict:
        return _or_fail(F.try_to_timestamp(source, F.lit(STRICT_ISO)), source, "timestamp")
    return F.try_to_timestamp(source, F.lit(LENIENT_ISO))


def utc_date(instant: Column) -> Column:
    """Calendar date in UTC, whatever time zone the session has."""
    seconds = F.unix_seconds(instant)
    days = (seconds - F.pmod(seconds, F.lit(86400))) / 86400
    return F.date_from_unix_date(days.cast("int"))


def iso_date(source: Column, strict: bool = True) -> Column:
    return utc_date(parse_iso_timestamp(source, strict))


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("bigint")
