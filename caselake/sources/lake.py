"""Date-partitioned Parquet lake: ``<root>/<table>/run_date=YYYY-MM-DD/``."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITION = "run_date"


def export_table(df: DataFrame, root: str, table: str, run_date: str) -> int:
    """Write one dated snapshot and return its row count as read back.

    An empty table is refused before anything is written. Running a date again
    replaces that date only.
    """
    if df.isEmpty():
        raise RuntimeError(f"{table} has 0 rows: refusing to export an empty partition")
    date.fromisoformat(run_date)
    (
        df.withColumn(PARTITION, F.lit(run_date).cast("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION)
        .parquet(f"{root}/{table}")
    )
    return read_lake(df.sparkSession, root, table, run_date).count()


def _path(spark: SparkSession, path: str) -> JavaObject:
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str) -> JavaObject:
    """The file system of ``path``; listing and renaming have no call in PySpark's own API."""
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def publish(spark: SparkSession, staged: str, root: str, tables: Sequence[str], run_date: str) -> None:
    """Move the tables written under ``staged`` into their partition of ``run_date``, all or none.

    ``staged`` lies on the file system of ``root``, so only folders are renamed. What the
    date held before is set aside under ``staged``; if a move fails, the moves before it
    are taken back.
    """
    date.fromisoformat(run_date)
    files, moved = _files(spark, root), []

    def move(source: str, target: str) -> None:
        files.mkdirs(_path(spark, target).getParent())
        if not files.rename(_path(spark, source), _path(spark, target)):
            raise RuntimeError(f"could not move {source} to {target}")
        moved.append((source, target))

    try:
        for table in tables:
            target = f"{root}/{table}/{PARTITION}={run_date}"
            if files.exists(_path(spark, target)):
                move(target, f"{staged}/replaced/{table}")
            move(f"{staged}/{table}", target)
    except Exception:
        for source, target in reversed(moved):
            files.rename(_path(spark, target), _path(spark, source))
        raise


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of scratch data, if it is there."""
    _files(spark, path).delete(_path(spark, path), True)


def _is_date(text: str) -> bool:
    try:
        return date.fromisoformat(text).isoformat() == text
    except ValueError:
        return False


def snapshot_dates(spark: SparkSession, root: str, table: str) -> list[str]:
    """Dates present for a table, oldest first: one directory listing, no file is opened.

    Partitions whose value is no date, such as that of null, are left out.
    """
    folder, files = _path(spark, f"{root}/{table}"), _files(spark, root)
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    values = [n.split("=", 1)[1] for n in names if n.startswith(f"{PARTITION}=")]
    return sorted(filter(_is_date, values))


def read_lake(
    spark: SparkSession, root: str, table: str, run_date: str = "latest"
) -> DataFrame:
    """One snapshot ("latest" or a date), or every snapshot with "all".

    A single snapshot is read by its own path, so the other dates are neither
    listed nor opened. "all" holds a record once per day it was exported.
    """
    path = f"{root}/{table}"
    if run_date == "all":
        return spark.read.parquet(path)
    if run_date == "latest":
        dates = snapshot_dates(spark, root, table)
        if not dates:
            raise RuntimeError(f"no snapshot of {table} under {root}")
        run_date = dates[-1]
    return spark.read.option("basePath", path).parquet(f"{path}/{PARTITION}={run_date}")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Raise when ``df`` has no rows, else return it."""
    if df.isEmpty():
        raise RuntimeError(f"no rows read from {what}: has the export been run yet?")
    return df
