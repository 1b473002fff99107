"""S3: static timetable tables, every column a string.

Timetable times can exceed 24:00 (``25:30:00``), so nothing is typed here; the
silver build types what it reads.  Empty fields become NULL.  Unlike a
pandas reader, text such as ``NA`` stays text (a station may be called NA).
A UTF-8 byte-order mark in front of the header is removed from the first
column name.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

# Tables landed from a schedule bundle (others in the bundle are ignored).
SCHEDULE_TABLES = ("agency", "routes", "trips", "stops", "stop_times", "calendar", "calendar_dates")


def as_all_strings(df: DataFrame) -> DataFrame:
    """Every column cast to STRING, empty strings to NULL, BOM stripped from names."""
    out = []
    for c in df.columns:
        s = F.col(f"`{c}`").cast(T.StringType())
        out.append(F.when(s != "", s).alias(c.lstrip("﻿").strip()))
    return df.select(out)


def read_schedule_table(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame | None:
    """One timetable file (CSV with header, or Parquet) as all-string columns; ``None`` if absent.

    ``multiline=True`` allows newlines inside quoted fields but makes each file
    one task; timetable files rarely need it, so splittable reading is the default.
    """
    try:
        if path.endswith(".parquet"):
            df = spark.read.parquet(path)
        else:
            df = (spark.read.option("header", "true").option("inferSchema", "false")
                  .option("quote", '"').option("escape", '"').option("multiLine", str(multiline).lower())
                  .option("encoding", "UTF-8").csv(path))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return as_all_strings(df)


def read_schedule(spark: SparkSession, folder: str, tables: Iterable[str] = SCHEDULE_TABLES,
                  ext: str = "txt", multiline: bool = False) -> dict[str, DataFrame]:
    """Every table of ``tables`` present under ``folder`` (``<table>.<ext>``); missing ones skipped."""
    out = {}
    for t in tables:
        df = read_schedule_table(spark, f"{folder.rstrip('/')}/{t}.{ext}", multiline)
        if df is not None:
            out[t] = df
    return out
