"""Mixing sources to target weights by entropy balancing.

Every document gets a rate; rates stay as close to 1 as the token targets allow, in
the sense of the relative entropy of token mass. The optimum tilts exponentially:
rate = exp(sum of the multipliers of the document's groups), and the multipliers
minimise the convex dual, sum of mass * rate - sum of target * multiplier. Documents
with the same groups share a rate, so the dual is solved on cells (one row per
combination of groups). Each Newton iteration is a grouped sum over the cells and one
damped step per multiplier. Rates are then rounded to whole copies so that the words
taken meet every cell's target up to about its smallest document.

Defined results: a null or empty text has size 0 and takes nothing; a null source is
a source of its own, last in order; repeated rows and ids are documents of their own
with the same chance; an empty table gives an empty result. Only ``doc_id``, ``text``
and the group columns are read; ``repeat_rows`` keeps all columns of its input.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.llm.common import WORD, row_key, whole_text
from caselake.session import written

# Weights of the sources by place in order, and the most a source is repeated.
WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
SALTS = 64


def sized(docs: DataFrame, group: str = "source") -> DataFrame:
    """(doc_id, text_hash, source, size): size in words."""
    words = F.regexp_count(whole_text(), F.lit(WORD)).cast("bigint")
    return docs.select(*row_key(), F.col(group).alias("source"), words.alias("size"))


def ranked(values: DataFrame, column: str) -> DataFrame:
    """Add ``place``, 0 for the smallest: a range sort, then one offset per partition.

    The sorted rows are written first, so that partition numbers are those of files
    that stay; the offsets are one row per partition.
    """
    missing = F.col(column).isNull()
    sorted_rows = written(
        values.select("*", missing.alias("_last")).sort("_last", column)
        .withColumn("_at", F.monotonically_increasing_id()), "in-order")
    part, row = F.shiftright("_at", 33), F.col("_at") % (1 << 33)
    placed = sorted_rows.withColumn("_part", part)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return placed.join(F.broadcast(offsets), "_part").withColumn("place", F.col("_offset") + row).drop(
        "_part", "_offset", "_at", "_last")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target): shares by weight, none above ``most`` times its source.

    The excess of sources at their limit goes to the others by weight, until none is
    above. Every round is one sum over the sources, of which only two numbers come back.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    places = ranked(totals, "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("place") % len(weights) + 1).cast("int"))
    rows = written(places.select("source", "source_size", weight.alias("weight")), "sources")
    limit = F.col("source_size") * most
    left = rows.agg(F.sum("source_size").alias("s")).first()["s"] or 0
    share, capped = 0.0, -1
    while True:
        # Shares only grow from round to round, so a source at its limit stays there.
        full = limit <= F.col("weight") * share if capped >= 0 else F.lit(False)
        got = rows.agg(
            F.sum(F.when(full, limit).otherwise(0)).alias("fixed"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weight"),
            F.count(F.when(full, 1)).alias("n"),
        ).first()
        if got["n"] == capped or not got["weight"]:
            break
        share, capped = (left - got["fixed"]) / got["weight"], got["n"]
    return rows.select("source", "source_size", F.least(limit.cast("double"), F.col("weight") * share).alias("target"))


def balance(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = 1e-9, most: int = 60) -> DataFrame:
    """Add ``rate`` to ``cells`` (group columns, ``mass``): tilted so that the mass of
    every group value comes to its target.

    ``targets`` maps a group column to (that column, ``target``). Several columns may
    constrain together: their multipliers take turns. Values with no target are left
    free, a target of 0 empties its group, and targets that contradict each other end
    at ``most`` rounds.
    """
    state = written(cells.withColumn("tilt", F.lit(0.0)), "cells")
    for _ in range(most):
        worst = 0.0
        for column, wanted in targets.items():
            now = state.groupBy(column).agg(F.sum(F.col("mass") * F.exp("tilt")).alias("now"))
            same = now[column].eqNullSafe(wanted[column])
            steps = now.join(wanted, same, "left").select(
                now[column].alias("_value"), _newton_step(F.col("now"), F.col("target")).alias("_step"),
                F.when(F.col("target") > 0, F.abs(F.col("now") / F.col("target") - 1)).alias("_gap"))
            tilted = state.join(steps, state[column].eqNullSafe(steps["_value"]), "left").withColumn(
                "tilt", F.col("tilt") + F.coalesce("_step", F.lit(0.0)))
            state = written(tilted.drop("_value", "_step"), "cells")
            gap = state.filter(F.col("mass") > 0).agg(F.max("_gap").alias("g")).first()["g"]
            worst = max(worst, gap or 0.0)
            state = state.drop("_gap")
        if worst <= tolerance:
            break
    return state.withColumn("rate", F.exp("tilt")).drop("tilt")


def _newton_step(now: Column, target: Column) -> Column:
    """Newton on one multiplier: gradient now - target, curvature now. Steps are cut to
    one unit, within which the dual's curvature changes by a bounded factor. A group
    without mass is left alone; one with a target of 0 goes down by a unit a round."""
    step = (target - now) / F.when(now > 0, now)
    return F.when(target.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), step)))


def copies(sizes: DataFrame, rates: DataFrame) -> DataFrame:
    """Add ``copies`` and the columns of ``rates`` (source, rate, ...) to ``sizes``.

    Every document gets the whole part of its rate. The rest of the words goes to
    whole documents, largest sizes first, each size taking what still fits, so later
    and smaller ones make up for what the larger ones missed. That is decided on one
    row per source and size: sizes that differ add up to the source's words, so there
    are at most sqrt(2 * words) of them, and no document row is gathered. Among equal
    sizes the documents with the smallest hashes are taken; they are counted in
    ``SALTS`` slices, so that none has to be sorted as a whole.
    """
    salted = sizes.withColumn("order", F.xxhash64("doc_id", "text_hash")).withColumn(
        "salt", F.pmod(F.shiftright("order", 40), F.lit(SALTS)))
    slices = written(salted.groupBy("source", "size", "salt").agg(F.count(F.lit(1)).alias("here")), "slices")
    histogram = slices.groupBy("source", "size").agg(F.sum("here").alias("n"))
    rated = rates.withColumnRenamed("source", "_source")
    rows = histogram.join(rated, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    extra_names = [c for c in rates.columns if c not in ("source", "rate")]
    chosen = rows.groupBy("source").applyInPandas(
        _extras, rows.select("source", "size", "rate", *extra_names).withColumn("base", F.lit(0).cast("bigint"))
        .withColumn("extra", F.lit(0).cast("bigint")).schema)
    before = Window.partitionBy("source", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    counted = slices.withColumn("before", F.coalesce(F.sum("here").over(before), F.lit(0)))  # SALTS rows at most
    key = lambda a, b: a["source"].eqNullSafe(b["s"]) & (a["size"] == b["z"])
    named = chosen.withColumnsRenamed({"source": "s", "size": "z"})
    plan = counted.join(named, key(counted, named)).drop("s", "z")
    plan = plan.withColumnsRenamed({"source": "s", "size": "z", "salt": "_salt"})
    rank = Window.partitionBy("source", "size", "salt").orderBy("order", "doc_id")
    ordered = salted.withColumn("at", F.row_number().over(rank))
    joined = ordered.join(plan, key(ordered, plan) & (ordered["salt"] == plan["_salt"]))
    taken = F.col("base") + F.when(F.col("before") + F.col("at") <= F.col("extra"), 1).otherwise(0)
    return joined.select("doc_id", "text_hash", "source", "size", "rate", *extra_names, taken.alias("copies"))


def _extras(rows: pd.DataFrame) -> pd.DataFrame:
    """Whole copies per size, and how many documents of it get one more."""
    rows = rows.sort_values("size", ascending=False, kind="stable")
    base = rows["rate"].astype(int)
    due = float((rows["size"] * rows["n"] * (rows["rate"] - base)).sum())
    left = float((rows["size"] * rows["n"]).sum())
    extra = []
    for size, n, rate, whole in zip(rows["size"], rows["n"], rows["rate"], base):
        fair = due * size * n / left if left else 0.0  # what this size owes if the rest stay in proportion
        k = 0 if size == 0 or rate <= whole else int(max(0, min(n, fair / size + 0.5)))
        extra.append(k)
        due -= k * size
        left -= size * n
    return rows.assign(base=base.astype("int64"), extra=extra).drop(columns="n")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(doc_id, text_hash, source, size, source_size, target, rate, copies) per document."""
    sizes = written(sized(docs), "sizes")
    targets = written(source_targets(sizes, weights, most), "targets")
    cells = targets.select("source", F.col("source_size").alias("mass"))
    rates = balance(cells, {"source": targets.select("source", "target")}).drop("mass")
    limited = rates.withColumn("rate", F.least(F.col("rate"), F.lit(float(most)))).withColumnRenamed("source", "_s")
    full = targets.join(limited, targets["source"].eqNullSafe(limited["_s"])).drop("_s")
    return copies(sizes, written(full, "rates"))


def repeat_rows(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``docs`` as the mix holds them: every row as often as it is taken, or not at all.

    Rows equal in id, text and source share their copies: each gets the whole part of the
    share, and the first ``copies mod rows`` of them, in the order of places they are
    dealt to, one more. Places are slices of the written input's rows, and only a count per
    place is ranked, so no group of equal rows is gathered.
    """
    own = F.xxhash64(F.col("source").isNull(), F.coalesce(F.col("source").cast("string"), F.lit("")))
    mixed = mix(docs, weights, most).groupBy("doc_id", "text_hash", own.alias("source_hash")).agg(
        F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
    # Row numbers are written, so that they stay the same when a task is run again.
    marked = written(docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"), *row_key(), own.alias("source_hash"),
        F.monotonically_increasing_id().alias("_row")), "rows")
    key = ["doc_id", "text_hash", "source_hash"]
    many = mixed.filter((F.col("_copies") > 0) & (F.col("_copies") % F.col("_rows") > 0))
    names = dict(zip(key, ("_d", "_t", "_s")))
    same = lambda a, b: (a["doc_id"].eqNullSafe(b["_d"])
                         & (a["text_hash"] == b["_t"]) & (a["source_hash"] == b["_s"]))
    place = F.shiftright("_row", 33)  # the task that wrote the row
    shared = many.select(*key).withColumnsRenamed(names)
    slim = marked.select(*key, "_row", place.alias("_place"))
    odd = slim.join(shared, same(slim, shared), "left_semi")
    here = odd.groupBy(*key, "_place").agg(F.count(F.lit(1)).alias("_here"))
    ahead = Window.partitionBy(*key).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    before = here.withColumn("_before", F.coalesce(F.sum("_here").over(ahead), F.lit(0))).drop("_here")
    rank = Window.partitionBy(*key, "_place").orderBy("_row")
    numbered = odd.withColumn("_at", F.row_number().over(rank))
    offsets = before.withColumnsRenamed(names | {"_place": "_p"})
    at = numbered.join(offsets, same(numbered, offsets) & (numbered["_place"] == offsets["_p"])).select(
        F.col("_row").alias("_r"), (F.col("_before") + F.col("_at")).alias("_number"))
    taken = mixed.filter(F.col("_copies") > 0).withColumnsRenamed(names)
    joined = marked.join(taken, same(marked, taken)).join(at, F.col("_row") == F.col("_r"), "left")
    whole = F.floor(F.col("_copies") / F.col("_rows"))
    more = F.when(F.col("_number") <= F.col("_copies") % F.col("_rows"), 1).otherwise(0)
    return (
        joined.withColumn("_times", (whole + more).cast("int")).filter(F.col("_times") > 0)
        .select("doc", F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_n")).select("doc.*")
    )
