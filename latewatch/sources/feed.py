"""Flatten GTFS-Realtime feed messages (proto3-JSON form) into rows.

Input: a DataFrame with one feed message per row (a JSON string column) and
the capture time.  ``from_json`` parses with a fixed schema (no inference),
``explode`` walks the entities and ``explode_outer`` the stop updates, so an
entity with an empty stop list still yields one row with NULL stop fields.
Everything is a built-in expression: no Python runs per row.

Proto rules kept from the original parser: empty strings and zero timestamps
are NULL (``x or None``); fields with explicit presence (direction, stop
sequence, delays, times, bearing, speed) are NULL only when absent; schedule
relationships default to SCHEDULED (0) when absent.  A message that is not JSON
of the feed's shape, or names an unknown relationship, fails the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params, schemas


def _blank_null(c: Column) -> Column:
    return F.when(c != "", c)


def _zero_null(c: Column) -> Column:
    v = c.cast(T.LongType())
    return F.when(v != 0, v)


def _enum(c: Column, mapping: dict[str, int], default: int | None = 0) -> Column:
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    code = F.coalesce(m[c], c.try_cast(T.IntegerType()))   # name or numeric form
    unknown = F.raise_error(F.concat(F.lit("unknown schedule relationship "), c)).cast(T.IntegerType())
    return F.when(c.isNull(), F.lit(default)).when(code.isNull(), unknown).otherwise(code)


def _entities(feeds: DataFrame, feed_col: str, captured_col: str) -> DataFrame:
    msg = F.from_json(F.col(feed_col), schemas.FEED_JSON, {"mode": "FAILFAST"})
    return (feeds.select(msg.alias("_m"), F.col(captured_col).alias("captured_at"))
                 .select(_zero_null(F.col("_m.header.timestamp")).alias("feed_ts"), "captured_at",
                         F.explode("_m.entity").alias("_e")))


def flatten_trip_updates(feeds: DataFrame, feed_col: str = "feed",
                         captured_col: str = "captured_at") -> DataFrame:
    """One row per (capture, trip-update entity, stop update); contract ``TRIP_UPDATES``."""
    e = _entities(feeds, feed_col, captured_col).where(F.col("_e.tripUpdate").isNotNull())
    tu = "_e.tripUpdate"
    base = e.select(
        F.col("_e.id").alias("entity_id"),
        _blank_null(F.col(f"{tu}.trip.tripId")).alias("trip_id"),
        _blank_null(F.col(f"{tu}.trip.routeId")).alias("route_id"),
        _blank_null(F.col(f"{tu}.trip.startDate")).alias("start_date"),
        _blank_null(F.col(f"{tu}.trip.startTime")).alias("start_time"),
        F.col(f"{tu}.trip.directionId").cast(T.IntegerType()).alias("direction_id"),
        _enum(F.col(f"{tu}.trip.scheduleRelationship"), params.TRIP_RELATIONSHIP).alias(
            "trip_schedule_relationship"),
        _blank_null(F.col(f"{tu}.vehicle.id")).alias("vehicle_id"),
        _zero_null(F.col(f"{tu}.timestamp")).alias("trip_update_ts"),
        "feed_ts", "captured_at",
        F.explode_outer(f"{tu}.stopTimeUpdate").alias("_s"),
    )
    has_stu = F.col("_s").isNotNull()
    return base.select(
        "entity_id", "trip_id", "route_id", "start_date", "start_time", "direction_id",
        "trip_schedule_relationship", "vehicle_id", "trip_update_ts", "feed_ts", "captured_at",
        F.col("_s.stopSequence").cast(T.IntegerType()).alias("stop_sequence"),
        _blank_null(F.col("_s.stopId")).alias("stop_id"),
        F.col("_s.arrival.delay").cast(T.DoubleType()).alias("arrival_delay"),
        F.col("_s.arrival.time").cast(T.LongType()).alias("arrival_time"),
        F.col("_s.departure.delay").cast(T.DoubleType()).alias("departure_delay"),
        F.col("_s.departure.time").cast(T.LongType()).alias("departure_time"),
        F.when(has_stu, _enum(F.col("_s.scheduleRelationship"), params.STOP_RELATIONSHIP)).alias(
            "stu_schedule_relationship"),
    )


def flatten_vehicle_positions(feeds: DataFrame, feed_col: str = "feed",
                              captured_col: str = "captured_at") -> DataFrame:
    """One row per (capture, vehicle entity); contract ``VEHICLE_POSITIONS``."""
    e = _entities(feeds, feed_col, captured_col).where(F.col("_e.vehicle").isNotNull())
    v = "_e.vehicle"
    return e.select(
        F.col("_e.id").alias("entity_id"),
        _blank_null(F.col(f"{v}.trip.tripId")).alias("trip_id"),
        _blank_null(F.col(f"{v}.trip.routeId")).alias("route_id"),
        _blank_null(F.col(f"{v}.vehicle.id")).alias("vehicle_id"),
        F.col(f"{v}.position.latitude").alias("lat"),
        F.col(f"{v}.position.longitude").alias("lon"),
        F.col(f"{v}.position.bearing").alias("bearing"),
        F.col(f"{v}.position.speed").alias("speed"),
        _zero_null(F.col(f"{v}.timestamp")).alias("vehicle_ts"),
        "feed_ts", "captured_at",
    )


def read_feed_json(spark, path: str, captured_col: str = "captured_at") -> DataFrame:
    """Whole-file feed captures (one JSON message per file) -> (feed, captured_at).

    The capture time is the epoch in the file's name (ten digits), else the feed
    header's timestamp; a file with neither fails the job.  Copying a file does
    not change it.
    """
    raw = spark.read.format("text").option("wholetext", "true").load(path)
    named = F.regexp_extract(F.col("_metadata.file_name"), r"(?<!\d)(\d{10})(?!\d)", 1).try_cast("long")
    header = F.get_json_object("value", "$.header.timestamp").try_cast("long")
    missing = F.raise_error(F.concat(F.lit("no capture time in "), F.col("_metadata.file_name"))).cast("long")
    epoch = F.coalesce(named, F.when(header > 0, header), missing)
    return raw.select(F.col("value").alias("feed"), F.timestamp_seconds(epoch).alias(captured_col))
