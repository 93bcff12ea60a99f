"""Things an operator needs from the session it runs in."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 10_000


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can read: what ``spark.checkpoint.dir`` names.

    Without that setting it is the checkpoint folder set on the context. Only a
    local-mode session that has neither gets a temporary folder; on a cluster
    that is an error rather than a machine-local path.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="caselake-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own inside the shared folder, so reruns never collide."""
    return f"{shared_folder(spark)}/caselake/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage with files that outlive a lost executor.
    """
    return written_at(df, new_path(df.sparkSession, name))


def written_at(df: DataFrame, path: str) -> DataFrame:
    """As ``written``, in a folder of the caller's choice."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame, key: str) -> DataFrame:
    """One task per core for costly row work on a scan with few splits.

    Small files often hold all their rows in one of their splits. A scan with two
    splits per core or more, so any large one, is left alone.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, key) if scan.rdd.getNumPartitions() < 2 * cores else scan


def bounded(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast form of a per-class table, after its size was checked.

    At most ``max_rows + 1`` rows reach the driver. A larger table is returned
    as it is, so the join that uses it becomes an ordinary shuffle join.
    """
    rows = df.take(max_rows + 1)
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
