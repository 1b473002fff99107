"""Hourly weather — payload arrays to rows, and the weather table scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from .. import schemas
from . import versioned


def weather_rows(payloads: DataFrame, payload_col: str = "payload") -> DataFrame:
    """Open-Meteo style ``hourly`` parallel arrays -> one row per hour.

    ``time[]``, ``precipitation[]``, ``temperature_2m[]`` and optional ``rain[]``
    are zipped position by position (``arrays_zip`` + ``inline``); a missing rain
    array gives NULL rain; a broken payload fails the job.  obs_date is characters 1-10 of the local time,
    obs_hour characters 12-13 as an int.
    """
    h = F.from_json(F.col(payload_col), schemas.WEATHER_JSON, {"mode": "FAILFAST"}).getField("hourly")
    times = h.getField("time")
    no_rain = F.array_repeat(F.lit(None).cast(T.DoubleType()), F.size(times))
    zipped = F.arrays_zip(times, h.getField("precipitation"),
                          F.coalesce(h.getField("rain"), no_rain), h.getField("temperature_2m"))
    rows = payloads.select(F.inline(zipped)).toDF("obs_time_local", "precip_mm", "rain_mm", "temp_c")
    return to_weather_contract(rows)


def to_weather_contract(df: DataFrame) -> DataFrame:
    """Typed weather rows: obs_time_local, precip_mm, rain_mm, temp_c, obs_date, obs_hour."""
    t = F.col("obs_time_local")
    rain = F.col("rain_mm") if "rain_mm" in df.columns else F.lit(None)
    return df.select(
        t.cast(T.StringType()).alias("obs_time_local"),
        F.col("precip_mm").cast(T.DoubleType()).alias("precip_mm"),
        rain.cast(T.DoubleType()).alias("rain_mm"),
        F.col("temp_c").cast(T.DoubleType()).alias("temp_c"),
        F.substring(t, 1, 10).alias("obs_date"),
        F.substring(t, 12, 2).cast(T.IntegerType()).alias("obs_hour"),
    )


def read_weather(spark: SparkSession, path: str) -> DataFrame | None:
    """The weather table (a Parquet file or a versioned table), or ``None`` when it is absent."""
    try:
        df = versioned.read(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return to_weather_contract(df)


def upsert_weather(spark: SparkSession, new: DataFrame, path: str) -> versioned.Version:
    """Weather history: hours of ``new`` replace those of the table at ``path``, all others stay.

    The version's ``meta["dates"]`` tells which version last changed an obs_date; nothing is
    committed when nothing changes.  Rows of ``new`` that share an hour all stay.
    """
    new = to_weather_contract(new)
    old = versioned.latest(spark, path)
    if old is None:
        dates = _dates(new)
        return versioned.write(new, path, meta={"dates": dict.fromkeys(dates, 1)})
    before = versioned.read(spark, path, old)
    hours = new.select(F.col("obs_date").alias("_date"), F.col("obs_hour").alias("_hour")).distinct()
    same = F.col("obs_date").eqNullSafe(F.col("_date")) & F.col("obs_hour").eqNullSafe(F.col("_hour"))
    after = before.join(hours, same, "left_anti").unionByName(new)
    dates = _dates(after.exceptAll(before).unionByName(before.exceptAll(after)))
    if not dates:
        return old
    meta = {"dates": {**old.meta.get("dates", {}), **dict.fromkeys(dates, old.number + 1)}}
    return versioned.write(after.coalesce(1), path, meta=meta, base=old)


def _dates(rows: DataFrame) -> list[str]:
    return [r[0] or "" for r in rows.select("obs_date").distinct().collect()]       # days
