"""Text expressions. All are built from JVM functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from caselake.schemas import CATEGORIES

# Unicode space separators (category Zs).
SPACES = (
    " \u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)
# The other characters that count as white space.
CONTROL_SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\u2028\u2029"

# Wording of the classification request.
PROMPT_HEAD = (
    "Classify this consumer complaint into exactly one of these categories. "
    "Reply with only the category name, nothing else.\n\n"
    "Categories:\n"
)
PROMPT_BODY = "\n\nComplaint:\n"
PROMPT_TAIL = "\n\nCategory:"
REDACTED = "[REDACTED]"


def trim_spaces(c: Column) -> Column:
    """Strip space characters from both ends; tabs and line breaks stay."""
    return F.btrim(c, F.lit(SPACES))


def strip_whitespace(c: Column) -> Column:
    """Strip all white space from both ends, line breaks included."""
    return F.btrim(c, F.lit(SPACES + CONTROL_SPACES))


def char_length(c: Column) -> Column:
    """Length in code points."""
    return F.length(c).cast("bigint")


def is_present(c: Column) -> Column:
    """True for non-null, non-empty text; never null."""
    return F.coalesce(c != "", F.lit(False))


def short_label(c: Column, limit: int = 18, keep: int = 16) -> Column:
    """Labels over ``limit`` characters become their first ``keep`` plus an ellipsis."""
    return F.when(F.length(c) <= limit, c).otherwise(F.concat(F.substring(c, 1, keep), F.lit("…")))


def parse_label(raw: Column, labels: Sequence[str] = CATEGORIES) -> Column:
    """First label, in list order, contained in ``raw`` regardless of case; else null."""
    text = F.lower(strip_whitespace(raw))
    return F.coalesce(*[F.when(F.contains(text, F.lit(p.lower())), F.lit(p)) for p in labels])


def build_prompt(narrative: Column, labels: Sequence[str] = CATEGORIES) -> Column:
    """Classification request for one narrative: fixed head, label bullets, text."""
    head = PROMPT_HEAD + "\n".join(f"- {p}" for p in labels) + PROMPT_BODY
    return F.concat(F.lit(head), narrative, F.lit(PROMPT_TAIL))


def scrub(c: Column, secrets: Sequence[str | None]) -> Column:
    """Replace every known secret; empty or missing secrets are skipped."""
    for secret in secrets:
        if secret:
            c = F.replace(c, F.lit(secret), F.lit(REDACTED))
    return c
