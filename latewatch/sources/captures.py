"""Capture files under ``<root>/dt=YYYY-MM-DD/hour=HH/``.

* :func:`land_captures` (S8) appends flattened captures in the contract schema,
  partitioned by the **UTC** date and hour of the capture.
* :func:`read_captures` (S1) scans them back with a fixed schema and partition
  discovery, so filters on ``dt``/``hour`` prune directories.
* :func:`read_captures_tolerant` (S2) reads files written by other tools whose
  column types drift from file to file (int vs double delays, all-NULL columns,
  nanosecond timestamps): Spark's own file systems hand each file to a task,
  which decodes it and casts its columns to the contract.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .. import schemas
from ..functions.columns import utc_wall_clock

PARTITIONS = T.StructType([T.StructField("dt", T.DateType()), T.StructField("hour", T.IntegerType())])


def with_partitions(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + list(PARTITIONS.fields))


def land_captures(df: DataFrame, root: str, schema: T.StructType = schemas.TRIP_UPDATES,
                  mode: str = "append") -> None:
    """Write captures (contract columns) under ``dt=/hour=`` of the UTC capture time."""
    session_zone = df.sparkSession.conf.get("spark.sql.session.timeZone", "UTC")
    utc = utc_wall_clock(df, "captured_at", session_zone)
    out = conform(df, schema).withColumn("dt", F.to_date(utc)).withColumn("hour", F.hour(utc))
    # rebalance by (dt, hour): a capture lands as one file per hour folder, while AQE splits an
    # hour that is unusually large (a backfill) over several tasks instead of one
    out.hint("rebalance", "dt", "hour").write.mode(mode).partitionBy("dt", "hour").parquet(root)


def read_captures(spark: SparkSession, root: str, schema: T.StructType = schemas.TRIP_UPDATES,
                  where: Column | None = None) -> DataFrame:
    """Every capture file below ``root`` (or in the folders ``where`` picks by dt and hour) with the contract schema plus ``dt``, ``hour``."""
    rows = spark.read.schema(with_partitions(schema)).option("basePath", root).parquet(root)
    return rows if where is None else rows.where(where)


def landed_hours(spark: SparkSession, root: str) -> dict[tuple, str]:
    """(dt, hour) -> what lies in that folder (files, bytes, newest change); no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(root)
    by = [F.col(c) if c in files.columns else F.lit(None) for c in ("dt", "hour")]
    found = files.groupBy(by[0].cast("date").alias("dt"), by[1].cast("int").alias("hour")).agg(
        F.concat_ws("/", F.count(F.lit(1)), F.sum("length"), F.unix_micros(F.max("modificationTime"))).alias("state"))
    return {(r.dt, r.hour): r.state for r in found.collect()}       # 24 a day


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast/rename ``df`` to ``schema``: missing columns are NULL, extra ones dropped."""
    have = set(df.columns)
    return df.select([(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                      for f in schema.fields])


def _cast(column: pa.Array, kind: pa.DataType) -> pa.Array:
    """Times lose what is below a microsecond (those without a zone are UTC); any other loss is an error."""
    return column.cast(kind, safe=not pa.types.is_timestamp(kind))


def _decoded(schema: T.StructType):
    """Parquet files (content and partition columns) to rows of the contract."""
    want = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                of_file = {n: batch.column(n)[i] for n in batch.schema.names if n != "content"}
                for part in pq.ParquetFile(pa.BufferReader(batch.column("content")[i].as_buffer())).iter_batches():
                    columns = []
                    for f in want:
                        if f.name in part.schema.names:
                            columns.append(_cast(part.column(f.name), f.type))
                        elif f.name in of_file:
                            columns.append(_cast(pa.repeat(of_file[f.name], part.num_rows), f.type))
                        else:
                            columns.append(pa.nulls(part.num_rows, f.type))
                    yield pa.RecordBatch.from_arrays(columns, schema=want)
    return run


def read_captures_tolerant(spark: SparkSession, root: str,
                           schema: T.StructType = schemas.TRIP_UPDATES, where: Column | None = None) -> DataFrame:
    """Drift-tolerant scan of captures written with per-file inferred types.

    A task holds the files of one scan split at a time (``spark.sql.files.maxPartitionBytes``,
    or one larger file).  Columns are not pruned at the file, so land what it returns
    once and scan that with :func:`read_captures`.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(root)
    if where is not None:
        files = files.where(where)
    keep = [f.name for f in PARTITIONS.fields if f.name in files.columns]
    return files.select("content", *keep).mapInArrow(_decoded(with_partitions(schema)), with_partitions(schema))
