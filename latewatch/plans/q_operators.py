"""Single-operator queries: P1-P13, J1-J4 and W1 in isolation over the fixture views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params
from ..functions import columns as C
from ..operators import enrich as E
from ..operators.joins import left_join_small
from ..operators.latest import latest_per_key
from . import fixtures as fx
from . import sql as Q
from .registry import register


def _updates(spark: SparkSession, d: str) -> DataFrame:
    return fx.fx_trip_updates(spark, d)


def _with_delay(spark: SparkSession, d: str) -> DataFrame:
    return _updates(spark, d).withColumn("delay_seconds", C.canonical_delay()).where(
        F.col("delay_seconds").isNotNull())


def _latest(spark: SparkSession, d: str) -> DataFrame:
    """W1 over the prepared fixture updates (the silver build's first half)."""
    return E.latest_stop_events(E.prepare_updates(_updates(spark, d), tie_breakers=("event_id",)),
                                ("event_id",))


def _over(body: str, *names: str, extra=None) -> str:
    return fx.with_views(body, *names, extra=extra)


# P1 -----------------------------------------------------------------------------
register("canonical_delay", _over("""
SELECT event_id, arrival_delay, departure_delay, coalesce(arrival_delay, departure_delay) AS delay_seconds
FROM fx_trip_updates WHERE coalesce(arrival_delay, departure_delay) IS NOT NULL""", "fx_trip_updates"))(
    lambda spark, d: _with_delay(spark, d).select("event_id", "arrival_delay", "departure_delay",
                                                  "delay_seconds"))

# P2 -----------------------------------------------------------------------------
register("served_stops", _over("""
SELECT event_id, stu_schedule_relationship FROM fx_trip_updates
WHERE stu_schedule_relationship IS NULL OR stu_schedule_relationship = 0""", "fx_trip_updates"))(
    lambda spark, d: _updates(spark, d).where(C.is_served()).select("event_id",
                                                                     "stu_schedule_relationship"))

# P3 -----------------------------------------------------------------------------
register("revenue_only", _over(f"""
SELECT event_id, route_id FROM fx_trip_updates WHERE route_id NOT LIKE '{params.NON_REVENUE_PREFIX}%'""",
                               "fx_trip_updates"))(
    lambda spark, d: _updates(spark, d).where(C.is_revenue()).select("event_id", "route_id"))


# P4 + P5 ------------------------------------------------------------------------
@register("service_date", _over(f"""
SELECT event_id, captured_at, {Q.SERVICE_DATE} AS service_date,
  strftime({Q.SERVICE_DATE}, '%a') AS day_of_week
FROM fx_trip_updates""", "fx_trip_updates"))
def service_date(spark: SparkSession, d: str) -> DataFrame:
    u = _updates(spark, d)
    return (u.select("event_id", "captured_at", C.service_date_of(u, "captured_at").alias("service_date"))
             .withColumn("day_of_week", C.day_of_week("service_date")))


# P9 + P10 -----------------------------------------------------------------------
register("delay_units", _over(f"""
SELECT event_id, CAST(delay_seconds AS INTEGER) AS delay_seconds,
  round(delay_seconds / 60.0, 2) AS delay_minutes,
  delay_seconds > {params.LATE_SECONDS} AS is_late_5min,
  delay_seconds <= {params.LATE_SECONDS} AS is_on_time
FROM (SELECT event_id, coalesce(arrival_delay, departure_delay) AS delay_seconds FROM fx_trip_updates) t
WHERE delay_seconds IS NOT NULL""", "fx_trip_updates"))(
    lambda spark, d: _with_delay(spark, d).select(
        "event_id", C.delay_seconds_int().alias("delay_seconds"), C.delay_minutes().alias("delay_minutes"),
        C.is_late().alias("is_late_5min"), C.is_on_time().alias("is_on_time")))


# J1 + P6 + P7 -------------------------------------------------------------------
def _routes_joined(spark: SparkSession, d: str) -> DataFrame:
    u = _updates(spark, d).select("event_id", "route_id")
    return E.join_routes(u, fx.fx_routes(spark, d))


_ROUTES_SQL = f"""
SELECT u.event_id, u.route_id, r.route_short_name AS line_code, r.route_long_name AS line_name,
  r.route_type AS route_type_text, TRY_CAST(r.route_type AS INTEGER) AS route_type,
  regexp_matches(r.route_short_name, '{params.SUBURBAN_LINE_PATTERN}') AS is_suburban
FROM fx_trip_updates u LEFT JOIN fx_routes r ON r.route_id = u.route_id"""

register("join_routes", _over(f"SELECT event_id, route_id, line_code, line_name, route_type, is_suburban "
                              f"FROM ({_ROUTES_SQL}) j", "fx_trip_updates", "fx_routes"))(_routes_joined)


@register("safe_route_type", _over(f"SELECT event_id, route_type_text, route_type FROM ({_ROUTES_SQL}) j",
                                   "fx_trip_updates", "fx_routes"))
def safe_route_type(spark: SparkSession, d: str) -> DataFrame:
    u = _updates(spark, d).select("event_id", "route_id")
    r = fx.fx_routes(spark, d).select("route_id", F.col("route_type").alias("route_type_text"),
                                      C.safe_int("route_type").alias("route_type"))
    return left_join_small(u, r, "route_id").select("event_id", "route_type_text", "route_type")


register("suburban_flag", _over(f"SELECT event_id, line_code, is_suburban FROM ({_ROUTES_SQL}) j",
                                "fx_trip_updates", "fx_routes"))(
    lambda spark, d: _routes_joined(spark, d).select("event_id", "line_code", "is_suburban"))


# J2 ---------------------------------------------------------------------------------
register("join_stops", _over("""
SELECT u.event_id, u.stop_id, s.stop_name FROM fx_trip_updates u LEFT JOIN fx_stops s ON s.stop_id = u.stop_id""",
                             "fx_trip_updates", "fx_stops"))(
    lambda spark, d: E.join_stops(_updates(spark, d).select("event_id", "stop_id"), fx.fx_stops(spark, d)))


# J3 + P8 + P11 ----------------------------------------------------------------------
def _schedule_joined(spark: SparkSession, d: str) -> DataFrame:
    u = _updates(spark, d).select("event_id", "trip_id", "stop_id")
    return E.join_schedule(u, fx.fx_stop_times(spark, d))


_SCHED_SQL = f"""
SELECT u.event_id, u.trip_id, u.stop_id, st.arrival_time AS sched_arrival, {Q.SCHED_HOUR} AS sched_hour,
  st.trip_id IS NOT NULL AS schedule_matched
FROM fx_trip_updates u LEFT JOIN fx_stop_times st ON st.trip_id = u.trip_id AND st.stop_id = u.stop_id"""

register("sched_hour", _over(f"SELECT event_id, sched_arrival, sched_hour FROM ({_SCHED_SQL}) j",
                             "fx_trip_updates", "fx_stop_times"))(
    lambda spark, d: _schedule_joined(spark, d).select("event_id", "sched_arrival", "sched_hour"))

register("schedule_matched", _over(f"SELECT event_id, trip_id, stop_id, schedule_matched FROM ({_SCHED_SQL}) j",
                                   "fx_trip_updates", "fx_stop_times"))(
    lambda spark, d: _schedule_joined(spark, d).select("event_id", "trip_id", "stop_id", "schedule_matched"))


# J4 + P12 + P13 ------------------------------------------------------------------------
def _weather_joined(spark: SparkSession, d: str) -> DataFrame:
    ev = E.join_schedule(_latest(spark, d), fx.fx_stop_times(spark, d))
    return E.join_weather(ev, fx.fx_weather(spark, d))


_WX_SQL = f"""
SELECT l.trip_id, l.service_date, l.stop_id, {Q.SCHED_HOUR} AS sched_hour, wx.precip_mm, wx.temp_c,
  coalesce(wx.precip_mm, 0) >= {params.RAIN_MM} AS is_raining
FROM latest l
LEFT JOIN fx_stop_times st ON st.trip_id = l.trip_id AND st.stop_id = l.stop_id
LEFT JOIN fx_weather wx ON CAST(wx.obs_date AS DATE) = l.service_date AND wx.obs_hour = {Q.SCHED_HOUR}"""

_LATEST_VIEWS = ("fx_trip_updates", "fx_stop_times", "fx_weather", "latest")

register("weather_join", _over(f"SELECT trip_id, service_date, stop_id, sched_hour, precip_mm, temp_c FROM ({_WX_SQL}) j",
                               *_LATEST_VIEWS, extra={"latest": Q.LATEST}))(
    lambda spark, d: _weather_joined(spark, d).select("trip_id", "service_date", "stop_id", "sched_hour",
                                                      "precip_mm", "temp_c"))

register("rain_flag", _over(f"SELECT trip_id, service_date, stop_id, precip_mm, is_raining FROM ({_WX_SQL}) j",
                            *_LATEST_VIEWS, extra={"latest": Q.LATEST}))(
    lambda spark, d: _weather_joined(spark, d).select("trip_id", "service_date", "stop_id", "precip_mm",
                                                      "is_raining"))


# W1 (native) ---------------------------------------------------------------------------
@register("latest_per_key", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)
                               ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) t
WHERE rn = 1""")
def latest_events(spark: SparkSession, d: str) -> DataFrame:
    ev = fx.table(spark, d, "events").withColumn("_day", F.col("ts").cast("date"))
    return latest_per_key(ev, ("user_id", "event_type", "_day"), ("ts",), ("event_id",)).drop("_day")
