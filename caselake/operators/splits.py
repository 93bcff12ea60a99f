"""Seeded, exactly stratified hold-out, folds and samples.

Rows of a class are put in the order of ``md5(seed:id)``. Which side a row falls
on then depends only on a few cut points per class, found from a histogram of
hash prefixes and from the rows of the few prefixes that hold a cut. No class is
ever sorted as a whole, full rows are never shuffled, and the outcome does not
depend on partitioning. Ids must be unique; rows without a class drop out.

The class table is read several times: pass one that is written or cheap.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.session import bounded

# Shape of the evaluation.
TEST_SHARE = 0.2
FOLDS = 5
REPEATS = 3
SEED = 42
SAMPLE_PER_CLASS = 40

PREFIX = 4  # hex digits: up to 65,536 histogram rows per class and seed


def hash_order(seed: str | Column, id_col: str) -> Column:
    seed = F.lit(seed) if isinstance(seed, str) else seed
    return F.md5(F.concat(seed, F.lit(":"), F.col(id_col).cast("string")))


def _class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def holdout_quotas(df: DataFrame, label: str, share: float = TEST_SHARE) -> DataFrame:
    """Held-out rows per class: ceil(share * rows) in all, by largest remainder."""
    return _quotas(df, label, F.ceil(F.lit(float(share)) * F.col("total")))


def _quotas(df: DataFrame, label: str, wanted: Column) -> DataFrame:
    """Rows per class, ``wanted`` in all, which may use the column ``total``: by largest
    remainder of each class's share.

    Works on one row per class. Equal remainders go by label.
    """
    everything = Window.partitionBy()
    wide = F.col("n").cast("decimal(19,0)")
    total, test = F.col("total").cast("decimal(19,0)"), F.col("test").cast("decimal(19,0)")
    shares = (
        _class_counts(df, label)
        .withColumn("total", F.sum("n").over(everything))
        .withColumn("test", wanted)
        .withColumn("rest", (wide * test) % total)
        .withColumn("base", ((wide * test - F.col("rest")) / total).cast("bigint"))
    )
    place = F.row_number().over(Window.orderBy(F.desc("rest"), label))
    spare = F.col("test") - F.sum("base").over(everything)
    return shares.select(
        label, "n", (F.col("base") + F.when(place <= spare, 1).otherwise(0)).alias("rank")
    )


def fold_ends(df: DataFrame, label: str, folds: int = FOLDS) -> DataFrame:
    """Last position of each fold within each class.

    Classes laid end to end are dealt to the folds in turn, so fold sizes differ
    by at most one per class and in total.
    """
    before = Window.orderBy(label).rowsBetween(Window.unboundedPreceding, -1)

    def dealt(position: Column, fold: Column) -> Column:
        return F.floor((position - fold + (folds - 1)) / folds)

    sizes = (
        _class_counts(df, label)
        .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
        .withColumn(
            "size",
            dealt(F.col("start") + F.col("n"), F.col("fold")) - dealt(F.col("start"), F.col("fold")),
        )
    )
    so_far = Window.partitionBy(label).orderBy("fold").rowsBetween(Window.unboundedPreceding, 0)
    return sizes.select(label, F.sum("size").over(so_far).cast("bigint").alias("rank"))


def _cuts(df: DataFrame, ranks: DataFrame, id_col: str, label: str, seeds: Mapping[str, str]) -> DataFrame:
    """Per class: for each seed, the (hash, id) found at each requested rank, in order."""
    streams = F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(seed).alias("seed")) for name, seed in seeds.items()
    ]))
    keyed = (
        df.filter(F.col(label).isNotNull())
        .select(F.col(label).alias("label"), F.col(id_col).alias("id"), streams.alias("stream"))
        .select("label", "id", F.col("stream.name").alias("name"),
                hash_order(F.col("stream.seed"), "id").alias("h"))
        .withColumn("prefix", F.substring("h", 1, PREFIX))
    )
    wanted = ranks.select(F.col(label).alias("label"), "rank")
    running = Window.partitionBy("name", "label").orderBy("prefix")
    histogram = (
        keyed.groupBy("name", "label", "prefix").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(running))
        .withColumn("before", F.col("upto") - F.col("n"))
    )
    at = bounded(
        histogram.join(wanted, "label")
        .filter((F.col("before") < F.col("rank")) & (F.col("rank") <= F.col("upto")))
        .groupBy("name", "label", "prefix")
        .agg(F.first("before").alias("before"), F.collect_list("rank").alias("ranks"))
    )
    in_prefix = Window.partitionBy("name", "label", "prefix").orderBy("h", "id")
    rank = F.col("before") + F.row_number().over(in_prefix)
    found = (
        keyed.join(at, ["name", "label", "prefix"])
        .withColumn("rank", rank)
        .withColumn("hit", F.explode(F.filter("ranks", lambda wanted_rank: wanted_rank == F.col("rank"))))
        .select("name", "label", F.struct("rank", "h", "id").alias("cut"))
    )
    names = F.explode(F.array(*[F.lit(name) for name in seeds]))
    empty = wanted.filter("rank = 0").select(
        names.alias("name"), "label",
        F.struct("rank", F.lit("").alias("h"), F.lit(None).cast(df.schema[id_col].dataType).alias("id"))
        .alias("cut"),
    )
    per_seed = [
        F.array_sort(F.collect_list(F.when(F.col("name") == name, F.col("cut")))).alias(name)
        for name in seeds
    ]
    return found.unionByName(empty).groupBy("label").agg(*per_seed)


def with_slots(
    df: DataFrame, ranks: DataFrame, id_col: str, label: str, seeds: Mapping[str, str]
) -> DataFrame:
    """Add one column per seed: how many of the class's cut ranks lie before the row."""
    cuts = bounded(_cuts(df, ranks, id_col, label, seeds))
    cuts = cuts.select(F.col("label").alias("_label"), *[F.col(s).alias(f"_{s}") for s in seeds])

    hashed = df.join(cuts, F.col(label) == F.col("_label")).select(
        "*", *[hash_order(seed, id_col).alias(f"_{name}_h") for name, seed in seeds.items()]
    )

    def slot(name: str) -> Column:
        h = F.col(f"_{name}_h")

        def lies_before(cut: Column) -> Column:
            return (cut["h"] < h) | ((cut["h"] == h) & (cut["id"] < F.col(id_col)))

        return F.size(F.filter(F.col(f"_{name}"), lies_before)).alias(name)

    return hashed.select(*df.columns, *[slot(name) for name in seeds])


def stratified_split(
    df: DataFrame, id_col: str = "complaint_id", label: str = "product",
    share: float = TEST_SHARE, seed: int = SEED,
) -> DataFrame:
    """Add ``split``: 'test' for an exact stratified share of the rows, else 'train'."""
    slots = with_slots(df, holdout_quotas(df, label, share), id_col, label, {"_slot": str(seed)})
    side = F.when(F.col("_slot") == 0, "test").otherwise("train")
    return slots.withColumn("split", side).drop("_slot")


def stratified_rows(
    df: DataFrame, rows: int, id_col: str = "complaint_id", label: str = "product", seed: int = SEED,
) -> DataFrame:
    """``rows`` rows of all classes by their exact shares, the first in seeded order of
    each, and one of every class at least; all rows where there are not more."""
    if rows < 1:
        raise ValueError(f"a sample of {rows} rows")
    quotas = _quotas(df, label, F.least(F.lit(rows), F.col("total")))
    ranks = quotas.select(label, F.greatest("rank", F.lit(1)).alias("rank"))
    return with_slots(df, ranks, id_col, label, {"_slot": str(seed)}).filter("_slot = 0").drop("_slot")


def with_folds(
    df: DataFrame, id_col: str = "complaint_id", label: str = "product",
    folds: int = FOLDS, repeats: int = REPEATS, seed: int = SEED,
) -> DataFrame:
    """Add ``fold_0 .. fold_<repeats-1>``, each a stratified k-fold assignment."""
    seeds = {f"fold_{r}": f"{seed}:{r}" for r in range(repeats)}
    return with_slots(df, fold_ends(df, label, folds), id_col, label, seeds)


def stratified_folds(
    df: DataFrame, id_col: str = "complaint_id", label: str = "product",
    folds: int = FOLDS, repeats: int = REPEATS, seed: int = SEED,
) -> DataFrame:
    """Fold membership as rows (id, label, repeat, fold)."""
    narrow = with_folds(df.select(id_col, label), id_col, label, folds, repeats, seed)
    members = F.explode(F.array(*[
        F.struct(F.lit(r).alias("repeat"), F.col(f"fold_{r}").alias("fold")) for r in range(repeats)
    ]))
    return narrow.select(id_col, label, members.alias("m")).select(id_col, label, "m.repeat", "m.fold")


def sample_per_class(
    df: DataFrame, id_col: str = "complaint_id", label: str = "product",
    n: int = SAMPLE_PER_CLASS, seed: int = SEED,
) -> DataFrame:
    """The first ``n`` rows of every class in seeded order, or the whole class."""
    ranks = _class_counts(df, label).select(label, F.least(F.col("n"), F.lit(n)).alias("rank"))
    slots = with_slots(df, ranks, id_col, label, {"_slot": str(seed)})
    return slots.filter("_slot = 0").drop("_slot")
