"""Replace-table sink and row-count audit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import versioned
from .versioned import delete, exists

__all__ = ["delete", "exists", "read_table", "replace_table", "table_counts"]


def replace_table(df: DataFrame, name: str | None = None, path: str | None = None,
                  fmt: str = "parquet", partition_by: tuple[str, ...] = (),
                  only_partitions_present: bool = False) -> None:
    """``CREATE OR REPLACE TABLE ... AS``: overwrite a catalog table or a versioned table at a path.

    ``partition_by`` keeps folder partitions (so later filters prune them);
    ``only_partitions_present=True`` replaces just the partitions that occur in
    ``df`` and keeps the others.  A table at a path is replaced by one commit: a
    failed job leaves the old table, and readers (:func:`read_table`) see the old or
    the new one.
    """
    if path and fmt == "parquet":
        versioned.write(df, path, partition_by, present_only=only_partitions_present)
    elif name:
        if partition_by:
            df = df.hint("rebalance", *partition_by)
        w = df.write.mode("overwrite").format(fmt)
        if partition_by:
            w = w.partitionBy(*partition_by)
            w = w.option("partitionOverwriteMode", "dynamic" if only_partitions_present else "static")
        w.saveAsTable(name)
    else:
        raise ValueError("give a table name, or a path for a Parquet table")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`replace_table` left at a path (or any Parquet path)."""
    return versioned.read(spark, path)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``SELECT '<t>' AS tbl, count(*) AS n ... UNION ALL ... ORDER BY tbl`` in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tbl"), "n")
             for name, df in tables.items()]
    return reduce(DataFrame.unionAll, parts).orderBy("tbl")
