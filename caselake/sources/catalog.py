"""Facts and marts by name in the session's catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame

from caselake.session import new_path


def _quoted(name: str) -> str:
    if not name or "\n" in name:
        raise ValueError(f"no name for a table: {name!r}")
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def save_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once and register it as the table ``name``, in place of one of that name;
    returns the table read by name.

    The files lie at ``path``, which must not exist yet, or in the shared folder, not in
    a warehouse of the catalog's own: replacing a name leaves the older files to those
    who still read them. The name changes only after all files are written.
    """
    spark = df.sparkSession
    path = path or new_path(spark, f"table-{name.replace('.', '-')}")
    df.write.parquet(path)
    spark.sql(f"drop table if exists {_quoted(name)}")
    spark.catalog.createTable(_quoted(name), path=path, source="parquet")
    return spark.table(_quoted(name))


def save_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` as a view of this session, in place of one of that name. Each
    reader computes it anew, so let it rest on tables."""
    if "." in name:
        raise ValueError(f"a view of the session has no database: {name}")
    df.createOrReplaceTempView(_quoted(name))
    return df.sparkSession.table(_quoted(name))
