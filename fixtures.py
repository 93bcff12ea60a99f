"""Views that give the test tables the roles of case records."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.operators.external import RateLimited

LANGS = ("de", "en", "es", "fr")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and labels as the 13 text columns of a landed record."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    docs = table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    d = F.col("doc_id")

    def day(offset: Column, clock: str) -> Column:
        received = F.date_add(F.lit("2023-01-01").cast("date"), offset.cast("int"))
        return F.concat(received.cast("string"), F.lit(clock))

    return docs.select(
        d.cast("string").alias("complaint_id"),
        F.col("lang").alias("product"),
        F.concat("lang", F.lit("-"), (d % 3).cast("string")).alias("sub_product"),
        F.concat(F.lit("issue "), (d % 7).cast("string")).alias("issue"),
        F.when(d % 2 == 0, F.concat(F.lit("detail "), (d % 11).cast("string"))).alias("sub_issue"),
        F.col("source").alias("company"),
        F.concat(F.lit("S"), (d % 50).cast("string")).alias("state"),
        day(d % 365, "T22:07:34.000Z").alias("date_received"),
        day(d % 365 + (d * 7) % 5, "T01:00:00.000Z").alias("date_sent_to_company"),
        F.when(d % 10 == 0, "Untimely response").when(d % 10 < 3, "Closed with relief")
        .otherwise("Closed with explanation").alias("company_response"),
        F.when(F.col("quality") == 1, "Yes").when(F.col("quality") == 0, "No").alias("timely"),
        F.col("text").alias("complaint_what_happened"),
        F.when(d % 4 == 0, "Phone").otherwise("Web").alias("submitted_via"),
    )


def answered_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records whose timeliness is known everywhere, so that all checks pass."""
    return raw_cases(spark, sf_dir).withColumn("timely", F.coalesce("timely", F.lit("No")))


def order_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as cases: market segment, nation of the customer, finished or not."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .select(
            F.col("o_orderkey").alias("complaint_id"), F.col("c_mktsegment").alias("product"),
            F.col("n_name").alias("company"), F.col("o_orderdate").cast("date").alias("date_received"),
            (F.col("o_orderstatus") == "F").alias("was_timely"),
        )
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deterministic predictions per document, with answers of an external classifier."""
    d = F.col("doc_id")
    label = F.when(d % 5 == 0, "fr").otherwise(F.col("lang"))
    return table(spark, sf_dir, "documents").select(
        d.alias("complaint_id"),
        F.col("lang").alias("true_product"),
        F.when(d % 7 == 0, "en").otherwise(F.col("lang")).alias("baseline_pred"),
        F.when(d % 11 == 0, "").when(d % 13 == 0, "no idea")
        .otherwise(F.concat(F.lit(" Lang-"), F.upper(label), F.lit(" \n"))).alias("external_raw_output"),
        ((d * 37) % 997 / F.lit(100.0)).alias("latency_s"),
        F.when(d % 11 == 0, "503 service unavailable").alias("error"),
    )


EXTERNAL_LABELS = tuple(f"lang-{code}" for code in LANGS)


def word_count_client() -> Callable[[str], str]:
    """Stand-in for a remote classifier: votes by frequent short words of each language."""
    words = {
        "en": {"the", "and", "of", "to", "in"}, "fr": {"le", "la", "les", "des", "et"},
        "de": {"der", "die", "und", "das", "ein"}, "es": {"el", "los", "y", "que", "del"},
    }

    def answer(prompt: str) -> str:
        seen = prompt.lower().split()
        votes = {code: sum(w in known for w in seen) for code, known in words.items()}
        return f"It is {max(sorted(votes), key=votes.get)}."

    return answer


def failing_client() -> Callable[[str], str]:
    """Stand-in for a remote classifier that fails at first: ``id % 5`` times for the case
    named in the request, by a refused connection if ``id % 7`` is 0, else for too many
    calls; a case with ``id % 11 = 0`` fails for good."""
    tries: Counter[int] = Counter()

    def answer(prompt: str) -> str:
        case = int(re.search(r"case (\d+) ", prompt)[1])
        tries[case] += 1
        if case % 11 == 0:
            raise ValueError("bad request")
        if tries[case] <= case % 5:
            raise ConnectionError("refused") if case % 7 == 0 else RateLimited("too many calls")
        return f"try {tries[case]}"

    return answer
