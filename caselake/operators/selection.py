"""Exact order statistics without sorting: histograms narrow down to the wanted places.

Each round counts rows per bin and keeps, per wanted place, only the bin that holds it.
A task sends at most one row per bin and group, whatever the number of rows or of
different values, and no task ever holds a group's values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselake.session import written

BINS = 1024  # bins of a numeric interval
DIGITS = 3  # hex digits of a sort key that one round tells apart: 4,096 bins and the ends
FEW = 20_000  # rows of a bin that are put in order directly


def values_at(df: DataFrame, value: str, places: Sequence[int]) -> list[float]:
    """The numbers at 0-based ``places`` of ``value`` in ascending order, nulls left out, NaN last.

    The first round tells numbers apart by sign and power of two, later ones cut the interval
    from the smallest to the largest number of a bin into ``BINS``: at most eight passes
    over ``value``, so pass a written table. Places outside the column give NaN.
    """
    numbers = df.select(F.col(value).cast("double").alias("v")).filter("v is not null")
    power = F.floor(F.log2(F.abs("v"))).cast("int")  # monotone, which is all a bin needs
    kinds = (
        F.when(F.isnan("v"), 9000).when(F.col("v") == math.inf, 8000).when(F.col("v") == -math.inf, -8000)
        .when(F.col("v") == 0, 0).when(F.col("v") > 0, power + 2000).otherwise(-power - 2000)
    )
    open_ = {(None, None): (0, sorted(set(places)))}  # interval: rows before it, places in it
    found: dict[int, float] = {}
    while open_:
        inside, at_bin = [], F.lit(None).cast("int")
        for number, (low, high) in enumerate(open_):
            if low is None:
                at_bin, number_of = kinds, F.lit(0)
                break
            here = F.col("v").between(low, high)
            part = (F.col("v") - low) / (high - low)  # within one power of two
            at_bin = F.when(here, F.least(F.floor(part * BINS), F.lit(BINS - 1)).cast("int")).otherwise(at_bin)
            inside.append((here, number))
        else:
            number_of = F.lit(None).cast("int")
            for here, number in inside:
                number_of = F.when(here, number).otherwise(number_of)
        bins = (
            numbers.select("v", number_of.alias("i"), at_bin.alias("b")).filter("i is not null")
            .groupBy("i", "b").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
            .collect()
        )
        bins.sort(key=lambda row: (row["i"], row["b"]))
        narrowed = {}
        for number, (before, wanted) in enumerate(list(open_.values())):
            for row in (row for row in bins if row["i"] == number):
                here = [place for place in wanted if before <= place < before + row["n"]]
                if here and (row["low"] == row["high"] or math.isnan(row["low"])):
                    found.update((place, row["low"]) for place in here)
                elif here:
                    narrowed[row["low"], row["high"]] = (before, here)
                before += row["n"]
        open_ = narrowed
    return [found.get(place, math.nan) for place in places]


def exact_quantiles(df: DataFrame, value: str, shares: Sequence[float]) -> list[float | None]:
    """Quantiles with linear interpolation between neighbours; None for a column of nulls."""
    n = df.agg(F.count(value)).first()[0]
    if not n:
        return [None] * len(shares)
    spots = [share * (n - 1) for share in shares]
    sides = [(math.floor(spot), math.ceil(spot)) for spot in spots]
    places = sorted({place for pair in sides for place in pair})
    at = dict(zip(places, values_at(df, value, places)))
    return [at[low] if low == high else (high - spot) * at[low] + (spot - low) * at[high]
            for spot, (low, high) in zip(spots, sides)]


def sort_key(column: Column, kind: T.DataType) -> Column:
    """Text of hex digits that sorts as ``column`` does, nulls last.

    For whole numbers, dates, timestamps, booleans, text and bytes. Texts end with a
    character below all digits, so keys of several columns can be joined.
    """
    if isinstance(kind, (T.StringType, T.BinaryType)):
        digits = F.concat(F.hex(column if isinstance(kind, T.BinaryType) else F.encode(column, "utf-8")), F.lit("!"))
    else:
        if isinstance(kind, T.DateType):
            number = F.unix_date(column)
        elif isinstance(kind, T.TimestampType):
            number = F.unix_micros(column)
        elif isinstance(kind, (T.IntegralType, T.BooleanType)):
            number = column
        else:
            raise TypeError(f"no sort key for {kind.simpleString()}")
        # With the sign bit turned, all numbers sort as they would without a sign.
        digits = F.lpad(F.hex(number.cast("bigint").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return F.coalesce(digits, F.lit("~"))


def first_per_group(df: DataFrame, group: str, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group in ascending ``order``, nulls last, as a filter.

    Rows carry their sort key: ``order``, then a hash of the whole row, so that only equal
    rows tie. Per group the key of the n-th row is found from histograms of key digits
    (one row per group and bin leaves a task), the digits all keys of the bin share being
    skipped; the last bin's few rows are put in order. Then rows are filtered by that
    key, and of the rows equal to it as many stay as there is room for. Groups are not
    sorted or collected; a null group is a group. ``df`` is read twice, once for its keys,
    which are written, and once for the rows; it must be the same both times.
    """
    if n < 1:
        return df.limit(0)
    kinds = df.select(*order).schema
    parts = [sort_key(column, field.dataType) for column, field in zip(order, kinds)]
    parts.append(F.lpad(F.hex(F.xxhash64(*[df[f"`{c}`"] for c in df.columns])), 16, "0"))
    keyed = df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"),
                      F.col(group).alias("g"), F.concat(*parts).alias("key"))
    keys = written(keyed.select("g", "key"), "sort-keys")

    def shared(low: Column, high: Column) -> Column:
        """Number of characters that two keys begin alike with."""
        alike = F.zip_with(F.split(low, ""), F.split(high, ""), lambda a, b: a == b)
        first = F.array_position(alike, False)
        return F.when(low == high, F.length(low)).otherwise(F.greatest(first - 1, F.lit(0))).cast("int")

    ends = keys.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
    # Groups that must be cut: rows before the open bin, and what all keys in it begin with.
    state = ends.filter(F.col("n") > n).select(
        "g", F.lit(0).cast("bigint").alias("before"), "n", F.substring("low", F.lit(1), shared(F.col("low"), F.col("high"))).alias("prefix"),
        F.col("low") == F.col("high"))
    columns = ["g", "before", "n", "prefix", "done"]
    state = state.toDF(*columns)
    found = []
    while True:
        state = written(state, "selection")
        found.append(state.filter(F.col("done")))
        state = state.filter(~F.col("done"))
        few = state.filter(F.col("n") <= FEW)
        place = F.row_number().over(Window.partitionBy("g").orderBy("key"))
        last = _inside(keys, few).withColumn("place", F.col("before") + place)
        # Rows equal to the n-th one begin where the first of them stands.
        alike = Window.partitionBy("g", "key")
        last = last.withColumn("first", F.min("place").over(alike)).withColumn("n", F.count(F.lit(1)).over(alike))
        found.append(last.filter(F.col("place") == n).select(
            "g", (F.col("first") - 1).alias("before"), "n", F.col("key").alias("prefix"), F.lit(True).alias("done")))
        state = state.filter(F.col("n") > FEW)
        if state.isEmpty():
            break
        bins = _inside(keys, state).groupBy(
            "g", "before", F.substring("key", F.length("prefix") + 1, F.lit(DIGITS)).alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
        upto = F.sum("n").over(Window.partitionBy("g").orderBy("bin"))
        held = bins.withColumn("upto", F.col("before") + upto).withColumn("from", F.col("upto") - F.col("n"))
        state = held.filter((F.col("from") < n) & (F.col("upto") >= n)).select(
            "g", F.col("from").alias("before"), "n",
            F.substring("low", F.lit(1), shared(F.col("low"), F.col("high"))).alias("prefix"), F.col("low") == F.col("high")).toDF(*columns)
    cuts = found[0]
    for more in found[1:]:
        cuts = cuts.unionByName(more)
    cuts = written(cuts.select(
        F.col("g").alias("cut_g"), F.col("prefix").alias("cut"), "n", (F.lit(n) - F.col("before")).alias("room")), "cuts")
    judged = keyed.join(cuts.drop("n"), F.col("g").eqNullSafe(F.col("cut_g")), "left")
    if cuts.filter(F.col("n") > F.col("room")).isEmpty():  # no row has to go for an equal one
        return judged.filter(F.col("cut").isNull() | (F.col("key") <= F.col("cut"))).select("row.*")
    under = judged.filter(F.col("cut").isNull() | (F.col("key") < F.col("cut"))).select("row.*")
    equal = judged.filter(F.col("key") == F.col("cut")).groupBy("g", "key").agg(
        F.first("row").alias("row"), F.count(F.lit(1)).alias("copies"), F.first("room").alias("room"))
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.least("copies", "room")))
    return under.unionByName(equal.select("row", copies).select("row.*"))


def _inside(keys: DataFrame, state: DataFrame) -> DataFrame:
    """Keys of the open bins, with ``before`` and ``prefix`` of their bin."""
    open_ = state.select(F.col("g").alias("state_g"), "before", "prefix")
    return keys.join(open_, F.col("g").eqNullSafe(F.col("state_g")) & F.startswith("key", F.col("prefix"))).drop("state_g")
