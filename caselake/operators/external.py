"""Scoring rows with an external classifier, and judging what comes back."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselake.functions.text import REDACTED, build_prompt, parse_label
from caselake.operators.selection import exact_quantiles
from caselake.schemas import CATEGORIES
from caselake.session import written

# Retry rule.
MAX_TRIES = 3
PAUSE_S = 3.0
GAVE_UP = "max retries exceeded"

# Rows answered and handed back together.
ROWS = 256


class RateLimited(Exception):
    """To be raised by a client whose service asks for fewer calls."""


def call_with_retry(
    call: Callable[[str], str], prompt: str, max_tries: int = MAX_TRIES,
    pause_s: float = PAUSE_S, transient: tuple[type[Exception], ...] = (TimeoutError, ConnectionError),
    secrets: Sequence[str | None] = (), sleep: Callable[[float], None] = time.sleep,
) -> tuple[str, str | None]:
    """(output, None) or ('', error text). Never raises.

    Transient errors wait one pause and rate limits an ever longer one; the last
    try and any other error end it. Secrets are taken out of the error text.
    """
    # Per try the pause after a rate limit and after a transient error; none after the last.
    pauses = [(pause_s * (n + 1), pause_s) for n in range(1, max_tries)] + [(None, None)] * (max_tries > 0)
    output, message = "", GAVE_UP
    for after_limit, after_fault in pauses:
        try:
            output, message = call(prompt), None
            break
        except Exception as error:
            message = reduce(lambda text, secret: text.replace(secret, REDACTED), filter(None, secrets), str(error))
            known = {True: after_limit, False: after_fault if isinstance(error, transient) else None}
            pause = known[isinstance(error, RateLimited)]
        if pause is None:
            break
        sleep(pause)
    return output, message


def external_scores(
    df: DataFrame, make_client: Callable[[], Callable[[str], str]],
    labels: Sequence[str] = CATEGORIES, text: str = "narrative",
    max_tries: int = MAX_TRIES, pause_s: float = PAUSE_S,
    transient: tuple[type[Exception], ...] = (TimeoutError, ConnectionError),
    secrets: Sequence[str | None] = (),
) -> DataFrame:
    """Add raw output, parsed label, latency and error to every row.

    ``make_client`` runs once per partition, so a connection is reused for all
    its rows; the number of partitions is the number of parallel callers. A
    failed call leaves an error in its row and no label. Every action on the
    result calls the service again: write it before using it twice. The rows stay in
    Arrow's form, one batch of them at a time; one request at a time becomes a string.
    """
    source = df.withColumn("_prompt", build_prompt(F.col(text), labels))
    schema = T.StructType([
        *df.schema.fields,
        T.StructField("external_raw_output", T.StringType()),
        T.StructField("latency_s", T.DoubleType()),
        T.StructField("error", T.StringType()),
    ])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = make_client()
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                rows = batch.slice(first, ROWS)
                outputs, seconds, errors = [], [], []
                for prompt in rows.column("_prompt"):
                    start = time.monotonic()
                    output, error = call_with_retry(client, prompt.as_py(), max_tries, pause_s, transient, secrets)
                    seconds.append(time.monotonic() - start)
                    outputs.append(output)
                    errors.append(error)
                kept = rows.drop_columns(["_prompt"])
                text = rows.schema.field("_prompt").type
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(outputs, text), pa.array(seconds, pa.float64()), pa.array(errors, text)],
                    names=[*kept.schema.names, "external_raw_output", "latency_s", "error"],
                )

    answered = source.mapInArrow(score, schema)
    label = F.when(F.col("error").isNull(), parse_label(F.col("external_raw_output"), labels))
    return answered.withColumn("external_pred", label)


def reliability_summary(
    scored: DataFrame, true: str = "true_product", baseline_pred: str = "baseline_pred",
    external_pred: str = "external_pred", latency: str = "latency_s", error: str = "error",
) -> DataFrame:
    """One row: accuracies on the same rows, unparseable answers, errors, latency.

    Unparseable is the sum of failed calls and answers without a valid label. Latency
    percentiles are exact, found by narrowing histograms over the latencies, which are
    written once; no task holds them all.
    """
    right = F.col(external_pred) == F.col(true)
    failed = F.col(error).isNotNull()
    rows = F.count(F.lit(1))
    judged = written(scored.select(
        (F.col(baseline_pred) == F.col(true)).alias("base_right"), right.alias("right"),
        F.col(external_pred).isNotNull().alias("parsed"), failed.alias("failed"), F.col(latency).alias("seconds"),
    ), "judged")
    median, high = exact_quantiles(judged, "seconds", (0.5, 0.95))
    return judged.agg(
        rows.alias("n_rows"),
        F.try_divide(F.count_if("base_right"), rows).alias("baseline_acc"),
        F.try_divide(F.count_if("right"), F.count_if("parsed")).alias("external_acc_parseable_only"),
        F.try_divide(F.count_if("right"), rows).alias("external_acc_all_rows"),
        F.count_if(~F.col("parsed")).alias("external_unparseable"),
        F.count_if("failed").alias("errors"),
        F.count_if(~F.col("failed") & ~F.col("parsed")).alias("invalid_label"),
        F.avg("seconds").alias("mean_latency_s"),
        F.lit(median).cast("double").alias("p50_latency_s"),
        F.lit(high).cast("double").alias("p95_latency_s"),
    )
