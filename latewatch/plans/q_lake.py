"""Queries through files: the readers, sinks, streams and the refresh (S1-S4, S8, S9, ST1, ST2, C1).

Each query writes driver-table rows to a new folder below ``spark.checkpoint.dir``,
runs the operator on what was written and returns what it left; the oracle is the
relational meaning.  Capture ids are padded, so that their order as text is that of
the numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..session import scratch_path
from ..sources import captures, schedule, sinks, weather
from ..streaming import ingest
from . import fixtures as fx
from . import pipeline, q_sources
from . import sql as Q
from .registry import register

#: Captures before this moment are landed first, the others by a second landing.
SECOND_LANDING = "2024-01-21"

_ID = "lpad(CAST(event_id AS VARCHAR), 19, '0')"
#: What every contract column holds for a fixture update; columns not named are NULL.
_HELD = {"entity_id": _ID, **{c: c for c in ("trip_id", "route_id", "stop_id", "arrival_delay", "departure_delay",
                                             "stu_schedule_relationship", "captured_at")}}
_DUCK = {T.StringType(): "VARCHAR", T.IntegerType(): "INTEGER", T.LongType(): "BIGINT", T.DoubleType(): "DOUBLE"}
CAPTURES_SQL = fx.with_views(
    "SELECT " + ", ".join(f"{_HELD.get(f.name) or f'CAST(NULL AS {_DUCK[f.dataType]})'} AS {f.name}" for f in schemas.TRIP_UPDATES.fields)
    + ", CAST(captured_at AS DATE) AS dt, CAST(EXTRACT(HOUR FROM captured_at) AS INTEGER) AS hour FROM fx_trip_updates",
    "fx_trip_updates")


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``."""
    return scratch_path(spark, name)


def updates(spark: SparkSession, d: str) -> DataFrame:
    return fx.fx_trip_updates(spark, d).withColumn("entity_id", F.lpad(F.col("event_id").cast("string"), 19, "0"))


def _landings(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """All updates, by landing."""
    late = F.col("captured_at") >= F.lit(SECOND_LANDING).cast("timestamp_ntz")
    u = updates(spark, d)
    return u.where(~late), u.where(late)


def _wall_clock(df: DataFrame) -> DataFrame:
    return df.withColumn("captured_at", F.col("captured_at").cast("timestamp_ntz"))


# S8 + S1 ------------------------------------------------------------------------------
@register("capture_scan", CAPTURES_SQL)
def capture_scan(spark: SparkSession, d: str) -> DataFrame:
    root = folder(spark, "captures")
    for part in _landings(spark, d):
        captures.land_captures(part, root)
    return _wall_clock(captures.read_captures(spark, root))


# Half of the files have other column types, fewer columns and one more -------------
@register("capture_scan_tolerant", CAPTURES_SQL)
def capture_scan_tolerant(spark: SparkSession, d: str) -> DataFrame:
    root, (first, second) = folder(spark, "drifting"), _landings(spark, d)
    captures.land_captures(first, root)
    delays = [F.col(c).cast("int").alias(c) for c in ("arrival_delay", "departure_delay")]
    drifted = second.select("entity_id", "trip_id", "route_id", "stop_id", *delays, "stu_schedule_relationship", "captured_at",
                            F.lit("x").alias("note"), F.to_date("captured_at").alias("dt"), F.hour("captured_at").alias("hour"))
    drifted.hint("rebalance", "dt", "hour").write.mode("append").partitionBy("dt", "hour").parquet(root)
    return _wall_clock(captures.read_captures_tolerant(spark, root))


# S3: the timetable from CSV files ---------------------------------------------------------
def _timetable(spark: SparkSession, d: str) -> str:
    root = folder(spark, "timetable")
    for name, df in {"routes": fx.fx_routes(spark, d), "stops": fx.fx_stops(spark, d), "stop_times": fx.fx_stop_times(spark, d)}.items():
        df.write.option("header", "true").option("quote", '"').option("escape", '"').csv(f"{root}/{name}.txt")
    return root


for _t in ("routes", "stop_times"):
    register(f"bronze_{_t}", fx.with_views(f"SELECT * FROM fx_{_t}", f"fx_{_t}"))(
        lambda spark, d, t=_t: schedule.read_schedule(spark, _timetable(spark, d))[t])


# S9 + S4: the weather table, written over another one ---------------------------------------
def _weather_table(spark: SparkSession, d: str) -> str:
    path = f"{folder(spark, 'weather')}/weather"
    w = q_sources.bronze_weather(spark, d)
    sinks.replace_table(w.withColumn("precip_mm", F.col("precip_mm") + 1), path=path)
    sinks.replace_table(w, path=path)
    return path


register("weather_scan", q_sources._WEATHER_ORACLE)(lambda spark, d: weather.read_weather(spark, _weather_table(spark, d)))


# ST1, ST2: two runs, the second after more captures have landed -----------------------------
def _streamed(spark: SparkSession, d: str, start, then=lambda: None) -> None:
    """``start(landing, checkpoint)`` once after each landing, and what follows a run."""
    root = folder(spark, "stream")
    for part in _landings(spark, d):
        captures.land_captures(part, f"{root}/landing")
        start(f"{root}/landing", f"{root}/progress").awaitTermination()
        then()


@register("stream_ingest", CAPTURES_SQL)
def stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    bronze = folder(spark, "ingested")
    _streamed(spark, d, lambda landing, progress: ingest.start_capture_ingest(spark, landing, bronze, progress))
    return _wall_clock(captures.read_captures(spark, bronze))


@register("stream_latest", fx.with_views(f"""
SELECT {_ID} AS entity_id, trip_id, route_id, stop_id, delay_seconds, captured_at, service_date FROM latest""",
                                         "fx_trip_updates", "latest", extra={"latest": Q.LATEST}))
def stream_latest(spark: SparkSession, d: str) -> DataFrame:
    state = folder(spark, "state")
    _streamed(spark, d, lambda landing, progress: ingest.start_latest_state(spark, landing, state, progress))
    return _wall_clock(ingest.read_latest_state(spark, state)).select(
        "entity_id", "trip_id", "route_id", "stop_id", "delay_seconds", "captured_at", "service_date")


# C1 without a date: what the second landing changed is found in the tables' logs ---------------
def _updated(spark: SparkSession, d: str) -> str:
    root = folder(spark, "updated")
    wx, timetable = _weather_table(spark, d), _timetable(spark, d)
    for part in _landings(spark, d):
        captures.land_captures(part, f"{root}/landing")
        pipeline.update(spark, root, f"{root}/landing", wx, timetable)
        timetable = None                                             # landed once: a new one makes silver anew
    return root


@register("gold_update", Q.over_gold("SELECT * FROM line_punctuality", "line_punctuality"))
def gold_update(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.read_gold(spark, _updated(spark, d), "line_punctuality")


@register("stream_refresh", Q.over_silver("SELECT * FROM silver"))
def stream_refresh(spark: SparkSession, d: str) -> DataFrame:
    root = folder(spark, "followed")
    wx, timetable = _weather_table(spark, d), _timetable(spark, d)
    pipeline.refresh_bronze(spark, root, None, wx, timetable)
    _streamed(spark, d, lambda landing, progress: ingest.start_latest_state(spark, landing, f"{root}/state", progress),
              lambda: pipeline.update_from_stream(spark, root, f"{root}/state"))
    return _wall_clock(pipeline.read_silver(spark, root))


# A full refresh, then one of the days since -----------------------------------------------
def _lake(spark: SparkSession, d: str) -> str:
    root, (first, second) = folder(spark, "lake"), _landings(spark, d)
    captures.land_captures(first, f"{root}/landing")
    wx, timetable = _weather_table(spark, d), _timetable(spark, d)
    pipeline.refresh(spark, root, f"{root}/landing", wx, timetable)
    captures.land_captures(second, f"{root}/landing")
    pipeline.refresh(spark, root, f"{root}/landing", wx, since=SECOND_LANDING)
    return root


@register("medallion_refresh", Q.over_silver("SELECT * FROM silver"))
def medallion_refresh(spark: SparkSession, d: str) -> DataFrame:
    return _wall_clock(pipeline.read_silver(spark, _lake(spark, d)))
