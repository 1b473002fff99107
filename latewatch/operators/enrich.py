"""Silver build: one row per realised stop event.

Pipeline: canonical delay + served/revenue filters + service date (P1-P4) ->
newest capture per (trip, service date, stop) (W1) -> LEFT JOIN timetable
(J3) -> LEFT JOIN routes (J1), stops (J2) and hourly weather (J4).

Scale notes: the only shuffles of the event stream are the W1 window
(pre-reduced per map task by the group limit) and, when the timetable is too
big to broadcast, the J3 sort-merge join over the already de-duplicated
events.  Dimensions are broadcast only under a size check (Spark's statistics
and AQE's measured sizes), see
:mod:`latewatch.operators.joins`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params
from ..functions import columns as C
from .joins import left_join_small
from .latest import latest_per_key

EVENT_KEYS = ("trip_id", "service_date", "stop_id")

SILVER_COLUMNS = (
    "service_date", "day_of_week", "trip_id", "route_id", "line_code", "line_name", "route_type",
    "is_suburban", "stop_id", "stop_name", "sched_arrival", "sched_hour", "delay_seconds",
    "delay_minutes", "is_late_5min", "schedule_matched", "captured_at", "precip_mm", "temp_c",
    "is_raining",
)


def prepare_updates(updates: DataFrame, zone: str = params.SERVICE_ZONE,
                    tie_breakers: Sequence[str] = (),
                    non_revenue_prefix: str = params.NON_REVENUE_PREFIX) -> DataFrame:
    """P1-P4 on raw stop updates, filters first so bad later captures never win W1.

    Output: trip_id, route_id, stop_id, delay_seconds (canonical, DOUBLE),
    captured_at, service_date and any ``tie_breakers`` columns.
    """
    delay = C.canonical_delay()
    sd = C.service_date_of(updates, "captured_at", zone)
    return (updates
            .where(delay.isNotNull() & C.is_served() & C.is_revenue(prefix=non_revenue_prefix))
            .select("trip_id", "route_id", "stop_id", delay.cast(T.DoubleType()).alias("delay_seconds"),
                    "captured_at", sd.alias("service_date"), *tie_breakers))


def latest_stop_events(prepared: DataFrame, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """W1 over prepared updates: newest capture per (trip_id, service_date, stop_id)."""
    return latest_per_key(prepared, EVENT_KEYS, ("captured_at",), tie_breakers)


def join_schedule(events: DataFrame, stop_times: DataFrame) -> DataFrame:
    """J3 + P8 + P11: scheduled arrival by (trip_id, stop_id).

    A timetable with duplicate (trip, stop) rows fans the event out, as the
    original SQL does.
    """
    st = stop_times.select("trip_id", "stop_id", F.col("arrival_time").alias("sched_arrival"),
                           F.lit(True).alias("_st_hit"))
    out = left_join_small(events, st, ["trip_id", "stop_id"])
    return (out.withColumn("sched_hour", C.sched_hour("sched_arrival"))
               .withColumn("schedule_matched", F.coalesce(F.col("_st_hit"), F.lit(False)))
               .drop("_st_hit"))


def join_routes(events: DataFrame, routes: DataFrame,
                pattern: str = params.SUBURBAN_LINE_PATTERN) -> DataFrame:
    """J1 + P6 + P7: line code/name, tolerant route type and suburban flag by route_id."""
    r = routes.select("route_id", F.col("route_short_name").alias("line_code"),
                      F.col("route_long_name").alias("line_name"),
                      C.safe_int("route_type").alias("route_type"),
                      C.is_suburban("route_short_name", pattern).alias("is_suburban"))
    return left_join_small(events, r, "route_id")


def join_stops(events: DataFrame, stops: DataFrame) -> DataFrame:
    """Station name by stop_id."""
    return left_join_small(events, stops.select("stop_id", "stop_name"), "stop_id")


def join_weather(events: DataFrame, weather: DataFrame, rain_mm: float = params.RAIN_MM) -> DataFrame:
    """J4 + P12 + P13: hourly weather on (service_date, sched_hour).

    A NULL sched_hour never matches; missing weather gives is_raining FALSE.
    """
    wx = weather.select(F.to_date("obs_date").alias("_wx_date"), F.col("obs_hour").alias("_wx_hour"),
                        "precip_mm", "temp_c")
    cond = (F.col("service_date") == F.col("_wx_date")) & (F.col("sched_hour") == F.col("_wx_hour"))
    out = left_join_small(events, wx, cond)
    return (out.drop("_wx_date", "_wx_hour")
               .withColumn("is_raining", C.is_raining("precip_mm", rain_mm)))


def finish_silver(enriched: DataFrame, late_seconds: int = params.LATE_SECONDS) -> DataFrame:
    """Typed projection in silver column order."""
    return enriched.select(
        "service_date", C.day_of_week("service_date").alias("day_of_week"), "trip_id", "route_id",
        "line_code", "line_name", "route_type", "is_suburban", "stop_id", "stop_name",
        "sched_arrival", "sched_hour",
        C.delay_seconds_int("delay_seconds").alias("delay_seconds"),
        C.delay_minutes("delay_seconds").alias("delay_minutes"),
        C.is_late("delay_seconds", late_seconds).alias("is_late_5min"),
        "schedule_matched", "captured_at", "precip_mm", "temp_c", "is_raining",
    )


def build_silver(updates: DataFrame, routes: DataFrame, stops: DataFrame, stop_times: DataFrame,
                 weather: DataFrame, *, zone: str = params.SERVICE_ZONE,
                 tie_breakers: Sequence[str] = (), late_seconds: int = params.LATE_SECONDS,
                 rain_mm: float = params.RAIN_MM, pattern: str = params.SUBURBAN_LINE_PATTERN,
                 non_revenue_prefix: str = params.NON_REVENUE_PREFIX) -> DataFrame:
    """The full silver ``stop_delays`` table (20 columns, see ``SILVER_COLUMNS``)."""
    ev = latest_stop_events(prepare_updates(updates, zone, tie_breakers, non_revenue_prefix),
                            tie_breakers)
    return enrich_events(ev, routes, stops, stop_times, weather, late_seconds=late_seconds, rain_mm=rain_mm, pattern=pattern)


def enrich_events(events: DataFrame, routes: DataFrame, stops: DataFrame, stop_times: DataFrame, weather: DataFrame, *,
                  late_seconds: int = params.LATE_SECONDS, rain_mm: float = params.RAIN_MM,
                  pattern: str = params.SUBURBAN_LINE_PATTERN) -> DataFrame:
    """J1-J4 over W1's rows: the silver columns."""
    ev = join_schedule(events, stop_times)
    ev = join_routes(ev, routes, pattern)
    ev = join_stops(ev, stops)
    ev = join_weather(ev, weather, rain_mm)
    return finish_silver(ev, late_seconds)
