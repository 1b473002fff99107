"""Source queries (S1, S3-S7, S10) over the driver tables.

The feed flatteners read feed messages that Spark builds from the driver
tables (one small message per entity group, never one message per table),
so the flatten work grows with the data; the oracle is the equivalent
relational projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.joins import left_join_small
from ..sources import captures, feed, schedule, sinks, weather
from . import fixtures as fx
from .registry import register

EPOCH0 = 1704067200            # 2024-01-01T00:00:00Z, base of the fixture feed times
FEED_TS = 1704153600           # 2024-01-02T00:00:00Z
CAPTURED = "2024-01-02 00:00:00"


def _s(c) -> F.Column:
    return c.cast(T.StringType())


def _ntz_contract(schema: T.StructType) -> T.StructType:
    """The contract with captured_at kept as TIMESTAMP_NTZ (the driver tables' type)."""
    return T.StructType([T.StructField(f.name, T.TimestampNTZType() if f.name == "captured_at"
                                       else f.dataType, True) for f in schema.fields])


# Contract projection of the stop updates with UTC partitions ----------------------
@register("bronze_trip_updates", fx.with_views("""
SELECT CAST(event_id AS VARCHAR) AS entity_id, trip_id, route_id,
  CAST(NULL AS VARCHAR) AS start_date, CAST(NULL AS VARCHAR) AS start_time,
  CAST(NULL AS INTEGER) AS direction_id, CAST(NULL AS INTEGER) AS trip_schedule_relationship,
  CAST(NULL AS VARCHAR) AS vehicle_id, CAST(NULL AS BIGINT) AS trip_update_ts,
  CAST(NULL AS BIGINT) AS feed_ts, captured_at, CAST(NULL AS INTEGER) AS stop_sequence, stop_id,
  arrival_delay, CAST(NULL AS BIGINT) AS arrival_time, departure_delay,
  CAST(NULL AS BIGINT) AS departure_time, stu_schedule_relationship,
  CAST(captured_at AS DATE) AS dt, CAST(EXTRACT(HOUR FROM captured_at) AS INTEGER) AS hour
FROM fx_trip_updates""", "fx_trip_updates"))
def bronze_trip_updates(spark: SparkSession, d: str) -> DataFrame:
    u = fx.fx_trip_updates(spark, d).withColumn("entity_id", _s(F.col("event_id")))
    out = captures.conform(u, _ntz_contract(schemas.TRIP_UPDATES))
    return out.withColumn("dt", F.to_date("captured_at")).withColumn("hour", F.hour("captured_at"))


# S3: all-string timetable landing (part plays the stops table) -----------------------
@register("bronze_stops", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, NULLIF(p_name, '') AS p_name,
  NULLIF(p_brand, '') AS p_brand, NULLIF(p_type, '') AS p_type,
  CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice
FROM part""")
def bronze_stops(spark: SparkSession, d: str) -> DataFrame:
    return schedule.as_all_strings(fx.table(spark, d, "part"))


# Weather ---------------------------------------------------------------------
_WEATHER_ORACLE = fx.with_views("""
SELECT obs_date || 'T' || lpad(CAST(obs_hour AS VARCHAR), 2, '0') || ':00' AS obs_time_local,
  precip_mm, CAST(NULL AS DOUBLE) AS rain_mm, temp_c, obs_date, obs_hour
FROM fx_weather""", "fx_weather")


def _local_time() -> F.Column:
    return F.concat(F.col("obs_date"), F.lit("T"), F.lpad(_s(F.col("obs_hour")), 2, "0"), F.lit(":00"))


@register("bronze_weather", _WEATHER_ORACLE)
def bronze_weather(spark: SparkSession, d: str) -> DataFrame:
    return weather.to_weather_contract(fx.fx_weather(spark, d).withColumn("obs_time_local", _local_time()))


def weather_payloads(spark: SparkSession, d: str) -> DataFrame:
    """One hourly payload per day (<= 24 entries each): parallel arrays ordered by hour."""
    w = fx.fx_weather(spark, d).withColumn("obs_time_local", _local_time())
    days = w.groupBy("obs_date").agg(F.sort_array(F.collect_list(F.struct(
        "obs_hour", "obs_time_local", "precip_mm", "temp_c"))).alias("h"))
    hourly = F.struct(
        F.transform("h", lambda x: x["obs_time_local"]).alias("time"),
        F.transform("h", lambda x: x["precip_mm"]).alias("precipitation"),
        F.transform("h", lambda x: x["temp_c"]).alias("temperature_2m"))
    return days.select(F.to_json(F.struct(hourly.alias("hourly"))).alias("payload"))


@register("weather_rows", _WEATHER_ORACLE)
def weather_rows(spark: SparkSession, d: str) -> DataFrame:
    return weather.weather_rows(weather_payloads(spark, d))


# Trip-update feed ------------------------------------------------------------------
def trip_update_feeds(spark: SparkSession, d: str) -> DataFrame:
    """Feed messages from customers and their orders.

    One entity per (customer, block of 64 order keys), one message per entity,
    so no message grows with the data; a customer without orders is one
    entity with an empty stop list.
    """
    c = fx.table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    o = fx.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    j = left_join_small(c, o, c["c_custkey"] == o["o_custkey"])
    ok, price = F.col("o_orderkey"), F.floor(F.col("o_totalprice"))
    stu = F.when(ok.isNotNull(), F.struct(
        (ok % 50).alias("stopSequence"),
        F.concat(F.lit("o_"), _s(ok)).alias("stopId"),
        F.when(ok % 3 != 0, F.struct((price % 900 - 300).alias("delay"))).alias("arrival"),
        F.struct((price % 900 - 270).alias("delay"), _s(ok * 60 + EPOCH0).alias("time")).alias("departure"),
        F.when(ok % 7 == 0, F.lit("SKIPPED")).alias("scheduleRelationship")))
    bucket = F.coalesce(F.floor(ok / 64), F.lit(-1))
    ents = j.groupBy("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment", bucket.alias("bucket")).agg(
        F.sort_array(F.collect_list(stu)).alias("stus"))
    ck = F.col("c_custkey")
    entity = F.struct(
        F.concat(F.lit("e"), _s(ck), F.lit("_"), _s(F.col("bucket"))).alias("id"),
        F.struct(
            F.struct(F.concat(F.lit("trip_"), _s(ck)).alias("tripId"),
                     F.concat(F.lit("r_"), _s(F.col("c_nationkey"))).alias("routeId"),
                     F.when(F.col("c_acctbal") > 0, ck % 2).alias("directionId"),
                     F.lit("SCHEDULED").alias("scheduleRelationship")).alias("trip"),
            F.struct(F.when(F.col("c_mktsegment") != "BUILDING", F.concat(F.lit("v_"), _s(ck)))
                     .otherwise(F.lit("")).alias("id")).alias("vehicle"),
            F.when(ck % 5 == 0, F.lit("0")).otherwise(_s(ck + EPOCH0)).alias("timestamp"),
            F.col("stus").alias("stopTimeUpdate")).alias("tripUpdate"))
    header = F.struct(F.lit("2.0").alias("gtfsRealtimeVersion"), F.lit(str(FEED_TS)).alias("timestamp"))
    return ents.select(F.to_json(F.struct(header.alias("header"), F.array(entity).alias("entity"))).alias("feed"),
                       F.to_timestamp_ntz(F.lit(CAPTURED)).alias("captured_at"))


@register("flatten_trip_updates", f"""
SELECT 'e' || CAST(c.c_custkey AS VARCHAR) || '_' || CAST(coalesce(o.o_orderkey // 64, -1) AS VARCHAR) AS entity_id,
  'trip_' || CAST(c.c_custkey AS VARCHAR) AS trip_id, 'r_' || CAST(c.c_nationkey AS VARCHAR) AS route_id,
  CAST(NULL AS VARCHAR) AS start_date, CAST(NULL AS VARCHAR) AS start_time,
  CASE WHEN c.c_acctbal > 0 THEN CAST(c.c_custkey % 2 AS INTEGER) END AS direction_id,
  0 AS trip_schedule_relationship,
  CASE WHEN c.c_mktsegment <> 'BUILDING' THEN 'v_' || CAST(c.c_custkey AS VARCHAR) END AS vehicle_id,
  CASE WHEN c.c_custkey % 5 = 0 THEN NULL ELSE {EPOCH0} + c.c_custkey END AS trip_update_ts,
  CAST({FEED_TS} AS BIGINT) AS feed_ts, TIMESTAMP '{CAPTURED}' AS captured_at,
  CAST(o.o_orderkey % 50 AS INTEGER) AS stop_sequence, 'o_' || CAST(o.o_orderkey AS VARCHAR) AS stop_id,
  CASE WHEN o.o_orderkey % 3 <> 0 THEN CAST(CAST(floor(o.o_totalprice) AS BIGINT) % 900 - 300 AS DOUBLE) END
    AS arrival_delay,
  CAST(NULL AS BIGINT) AS arrival_time,
  CAST(CAST(floor(o.o_totalprice) AS BIGINT) % 900 - 270 AS DOUBLE) AS departure_delay,
  {EPOCH0} + o.o_orderkey * 60 AS departure_time,
  CASE WHEN o.o_orderkey IS NULL THEN NULL WHEN o.o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS stu_schedule_relationship
FROM customer c
LEFT JOIN orders o ON o.o_custkey = c.c_custkey""")
def flatten_trip_updates(spark: SparkSession, d: str) -> DataFrame:
    return feed.flatten_trip_updates(trip_update_feeds(spark, d))


# Vehicle-position feed -----------------------------------------------------------
def vehicle_feeds(spark: SparkSession, d: str) -> DataFrame:
    """One feed message per supplier: a vehicle entity, plus a trip-update-only entity
    for every fourth supplier (which the vehicle flattener must skip)."""
    s = fx.table(spark, d, "supplier")
    k, nk, bal = F.col("s_suppkey"), F.col("s_nationkey"), F.col("s_acctbal")
    pos = F.when(nk % 5 != 0, F.struct(
        (bal / 100.0).alias("latitude"), (nk + 0.5).alias("longitude"),
        F.when(k % 2 == 0, (k % 360).cast(T.DoubleType())).alias("bearing"),
        F.when(k % 3 == 0, bal % 30).alias("speed")))
    vehicle_entity = F.struct(
        F.concat(F.lit("v"), _s(k)).alias("id"),
        F.struct(
            F.struct(F.concat(F.lit("trip_"), _s(k)).alias("tripId"),
                     F.when(nk % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("r_"), _s(nk))).alias("routeId"))
            .alias("trip"),
            F.struct(F.concat(F.lit("bus_"), _s(k)).alias("id")).alias("vehicle"),
            pos.alias("position"),
            _s(k + EPOCH0).alias("timestamp")).alias("vehicle"))
    tu_entity = F.struct(F.concat(F.lit("t"), _s(k)).alias("id"),
                         F.struct(F.struct(F.concat(F.lit("trip_"), _s(k)).alias("tripId")).alias("trip"))
                         .alias("tripUpdate"))
    # entities of different shapes: join their JSON texts into one list
    ents = F.concat(F.lit("["), F.to_json(vehicle_entity),
                    F.when(k % 4 == 0, F.concat(F.lit(","), F.to_json(tu_entity))).otherwise(F.lit("")),
                    F.lit("]"))
    header = F.struct(F.lit("2.0").alias("gtfsRealtimeVersion"), F.lit(str(FEED_TS)).alias("timestamp"))
    msg = F.concat(F.lit('{"header":'), F.to_json(header), F.lit(',"entity":'), ents, F.lit("}"))
    return s.select(msg.alias("feed"), F.to_timestamp_ntz(F.lit(CAPTURED)).alias("captured_at"))


@register("flatten_vehicle_positions", f"""
SELECT 'v' || CAST(s_suppkey AS VARCHAR) AS entity_id, 'trip_' || CAST(s_suppkey AS VARCHAR) AS trip_id,
  CASE WHEN s_nationkey % 3 = 0 THEN NULL ELSE 'r_' || CAST(s_nationkey AS VARCHAR) END AS route_id,
  'bus_' || CAST(s_suppkey AS VARCHAR) AS vehicle_id,
  CASE WHEN s_nationkey % 5 <> 0 THEN s_acctbal / 100.0 END AS lat,
  CASE WHEN s_nationkey % 5 <> 0 THEN s_nationkey + 0.5 END AS lon,
  CASE WHEN s_nationkey % 5 <> 0 AND s_suppkey % 2 = 0 THEN CAST(s_suppkey % 360 AS DOUBLE) END AS bearing,
  CASE WHEN s_nationkey % 5 <> 0 AND s_suppkey % 3 = 0 THEN s_acctbal % 30 END AS speed,
  {EPOCH0} + s_suppkey AS vehicle_ts, CAST({FEED_TS} AS BIGINT) AS feed_ts,
  TIMESTAMP '{CAPTURED}' AS captured_at
FROM supplier""")
def flatten_vehicle_positions(spark: SparkSession, d: str) -> DataFrame:
    return feed.flatten_vehicle_positions(vehicle_feeds(spark, d))


# Row-count audit of every driver table ----------------------------------------------
@register("table_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS tbl, count(*) AS n FROM {t}" for t in fx.DRIVER_TABLES) + " ORDER BY tbl")
def table_counts(spark: SparkSession, d: str) -> DataFrame:
    return sinks.table_counts({t: fx.table(spark, d, t) for t in fx.DRIVER_TABLES})
