"""Contract schemas of the bronze, silver and model tables."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# One row per (capture, entity, stop_time_update).  Delays are always DOUBLE and
# captured_at is a micros TIMESTAMP: the landing sink writes this contract so the
# batch scan never meets per-file type drift (the drift reader handles old files).
TRIP_UPDATES = _struct(
    ("entity_id", S), ("trip_id", S), ("route_id", S), ("start_date", S), ("start_time", S),
    ("direction_id", I), ("trip_schedule_relationship", I), ("vehicle_id", S),
    ("trip_update_ts", L), ("feed_ts", L), ("captured_at", T.TimestampType()),
    ("stop_sequence", I), ("stop_id", S), ("arrival_delay", D), ("arrival_time", L),
    ("departure_delay", D), ("departure_time", L), ("stu_schedule_relationship", I),
)

VEHICLE_POSITIONS = _struct(
    ("entity_id", S), ("trip_id", S), ("route_id", S), ("vehicle_id", S),
    ("lat", D), ("lon", D), ("bearing", D), ("speed", D),
    ("vehicle_ts", L), ("feed_ts", L), ("captured_at", T.TimestampType()),
)

WEATHER = _struct(
    ("obs_time_local", S), ("precip_mm", D), ("rain_mm", D), ("temp_c", D),
    ("obs_date", S), ("obs_hour", I),
)

# Schedule tables are all-string; only the columns the silver build reads are fixed.
ROUTES = _struct(("route_id", S), ("route_short_name", S), ("route_long_name", S), ("route_type", S))
STOPS = _struct(("stop_id", S), ("stop_name", S))
STOP_TIMES = _struct(("trip_id", S), ("stop_id", S), ("arrival_time", S))

SILVER = _struct(
    ("service_date", T.DateType()), ("day_of_week", S), ("trip_id", S), ("route_id", S),
    ("line_code", S), ("line_name", S), ("route_type", I), ("is_suburban", B),
    ("stop_id", S), ("stop_name", S), ("sched_arrival", S), ("sched_hour", I),
    ("delay_seconds", I), ("delay_minutes", D), ("is_late_5min", B), ("schedule_matched", B),
    ("captured_at", T.TimestampType()), ("precip_mm", D), ("temp_c", D), ("is_raining", B),
)

PREDICTIONS = _struct(
    ("trip_id", S), ("stop_id", S), ("service_date", T.DateType()), ("line_code", S),
    ("sched_hour", I), ("delay_minutes", D), ("is_late_5min", I), ("prob_late", D), ("pred_late", I),
)

# proto3-JSON form of a GTFS-Realtime FeedMessage (64-bit ints are strings,
# enums are names).  Only the fields the flatteners read are declared.
_TRIP = _struct(("tripId", S), ("routeId", S), ("startDate", S), ("startTime", S),
                ("directionId", L), ("scheduleRelationship", S))
_EVENT = _struct(("delay", L), ("time", S))
_STU = _struct(("stopSequence", L), ("stopId", S), ("arrival", _EVENT), ("departure", _EVENT),
               ("scheduleRelationship", S))
_POSITION = _struct(("latitude", D), ("longitude", D), ("bearing", D), ("speed", D))
FEED_JSON = _struct(
    ("header", _struct(("gtfsRealtimeVersion", S), ("timestamp", S))),
    ("entity", T.ArrayType(_struct(
        ("id", S),
        ("tripUpdate", _struct(("trip", _TRIP), ("vehicle", _struct(("id", S))), ("timestamp", S),
                               ("stopTimeUpdate", T.ArrayType(_STU)))),
        ("vehicle", _struct(("trip", _TRIP), ("vehicle", _struct(("id", S))),
                            ("position", _POSITION), ("timestamp", S))),
    ))),
)

# Open-Meteo style hourly payload: parallel arrays.
WEATHER_JSON = _struct(("hourly", _struct(
    ("time", T.ArrayType(S)), ("precipitation", T.ArrayType(D)),
    ("temperature_2m", T.ArrayType(D)), ("rain", T.ArrayType(D)))))
