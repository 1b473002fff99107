"""Scalar column expressions.

Every function returns a :class:`pyspark.sql.Column` made only of built-in
functions, so it stays inside whole-stage code generation.  NULL rules are
those of the original SQL and are spelled out per function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params

__all__ = [
    "canonical_delay", "is_served", "is_revenue", "utc_wall_clock", "service_date",
    "service_date_of",
    "day_of_week", "safe_int", "is_suburban", "sched_hour", "delay_seconds_int",
    "delay_minutes", "is_late", "is_on_time", "is_raining", "condition_label",
]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def canonical_delay(arrival="arrival_delay", departure="departure_delay") -> Column:
    """Arrival delay, else departure delay; NULL when neither is present."""
    return F.coalesce(_c(arrival), _c(departure))


def is_served(relationship="stu_schedule_relationship") -> Column:
    """NULL or 0 (SCHEDULED) is served; every other code is dropped."""
    r = _c(relationship)
    return r.isNull() | (r == 0)


def is_revenue(route_id="route_id", prefix: str = params.NON_REVENUE_PREFIX) -> Column:
    """``route_id NOT LIKE 'RTTA%'`` — NULL route ids are NULL, hence dropped by a filter."""
    return ~_c(route_id).like(prefix + "%")


def utc_wall_clock(df: DataFrame, col: str, session_zone: str) -> Column:
    """UTC wall-clock time of an instant as TIMESTAMP_NTZ, whatever the session zone.

    TIMESTAMP_NTZ columns (the driver tables, pandas-written captures) already
    hold UTC wall clock.  TIMESTAMP (LTZ) columns are cast with the session zone
    and converted back to UTC.
    """
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.col(col)
    ntz = F.col(col).cast(T.TimestampNTZType())
    return F.convert_timezone(F.lit(session_zone), F.lit("UTC"), ntz)


_UTC_NAMES = {"UTC", "Z", "GMT", "Etc/UTC", "Etc/GMT", "+00:00", "UCT", "Zulu"}


def service_date(utc_ntz: Column, zone: str = params.SERVICE_ZONE) -> Column:
    """Calendar date of a UTC instant (as UTC wall clock NTZ) in the service zone."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_ntz))


def service_date_of(df: DataFrame, col: str, zone: str = params.SERVICE_ZONE) -> Column:
    """P4 for a TIMESTAMP or TIMESTAMP_NTZ column of ``df``, right under any session zone.

    Under a UTC session (the package default) it is ``to_date(from_utc_timestamp(ts, zone))``,
    whose zone rules are resolved once per task; under any other session zone
    it falls back to ``convert_timezone``, which resolves the zone per row.
    """
    session_zone = df.sparkSession.conf.get("spark.sql.session.timeZone", "UTC")
    if session_zone in _UTC_NAMES:
        ts = F.col(col)
        if isinstance(df.schema[col].dataType, T.TimestampNTZType):
            ts = ts.cast(T.TimestampType())      # identity on the micros under UTC
        return F.to_date(F.from_utc_timestamp(ts, zone))
    return service_date(utc_wall_clock(df, col, session_zone), zone)


def day_of_week(date_col="service_date") -> Column:
    """P5: three-letter day name, e.g. ``Thu``."""
    return F.date_format(_c(date_col), "E")


def safe_int(x) -> Column:
    """Tolerant integer cast — non-numeric text gives NULL, never an error."""
    return _c(x).try_cast(T.IntegerType())


def is_suburban(line_code="line_code", pattern: str = params.SUBURBAN_LINE_PATTERN) -> Column:
    """``line RLIKE '^T[0-9]'``; NULL when the route was not matched."""
    return _c(line_code).rlike(pattern)


def sched_hour(arrival_time="arrival_time") -> Column:
    """First ``:`` field as a tolerant int, mod 24 (``25:30:00`` -> 1)."""
    return F.split(_c(arrival_time), ":").getItem(0).try_cast(T.IntegerType()) % 24


def delay_seconds_int(delay="delay_seconds") -> Column:
    """Delay in whole seconds (INT)."""
    return _c(delay).cast(T.IntegerType())


def delay_minutes(delay="delay_seconds") -> Column:
    """``round(delay / 60.0, 2)`` as DOUBLE."""
    return F.round(_c(delay).cast(T.DoubleType()) / F.lit(60.0), 2)


def is_late(delay="delay_seconds", threshold: int = params.LATE_SECONDS) -> Column:
    """P10: late when delay > threshold seconds."""
    return _c(delay) > threshold


def is_on_time(delay="delay_seconds", threshold: int = params.LATE_SECONDS) -> Column:
    """P10: on time when delay <= threshold seconds (early counts as on time)."""
    return _c(delay) <= threshold


def is_raining(precip="precip_mm", threshold: float = params.RAIN_MM) -> Column:
    """``coalesce(precip, 0) >= 0.2`` — missing weather is FALSE, not NULL."""
    return F.coalesce(_c(precip), F.lit(0.0)) >= threshold


def condition_label(raining="is_raining") -> Column:
    """P15: 'Wet' when raining, else 'Dry' (NULL counts as Dry)."""
    return F.when(_c(raining), F.lit(params.WET_LABEL)).otherwise(F.lit(params.DRY_LABEL))
