"""Keep-first per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """One row per value of ``key``: the first one by ``order``.

    The window is partitioned by hash and value, so rows sort on eight bytes and
    long shared openings are compared only when hashes meet. ``row_number = 1``
    is applied before the shuffle as well (WindowGroupLimit): however many copies
    a text has, a map task passes on one of them.
    """
    window = Window.partitionBy("_hash", key).orderBy(*order)
    return (
        df.withColumn("_hash", F.xxhash64(key))
        .withColumn("_n", F.row_number().over(window))
        .filter("_n = 1")
        .drop("_hash", "_n")
    )
