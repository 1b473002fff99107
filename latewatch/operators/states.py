"""Mergeable partial states of the gold tables (A1-A6), kept per service date.

A day's events are reduced once, by one scan with grouping sets: rows per delay, trip, line
and capture (what exact percentiles and distinct counts need) and sums per hour, station,
weather and day.  Names are keys where a gold table shows them.  Counts and scaled integer sums add up and minima of minima are
minima, so any set of days merges to exactly what the aggregates of
:mod:`latewatch.operators.aggregates` give over those days' events.  When days change, only
their states are computed anew; the gold tables read states, never the history of events.

A day's state has a row a trip, delay, line, hour, station and capture, however many events it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params
from ..functions.rounding import round_ratio
from . import aggregates as A

#: Grouping set -> the columns it keeps, besides service_date.
SETS = {
    "delay": ("is_suburban", "delay_minutes"),
    "trip": ("is_suburban", "trip_id"),
    "line": ("is_suburban", "line_code"),
    "capture": ("is_suburban", "captured_at"),
    "line_delay": ("line_code", "line_name", "delay_minutes"),
    "line_trip": ("line_code", "line_name", "trip_id"),
    "hour": ("is_suburban", "sched_hour"),
    "day": ("is_suburban", "day_of_week"),
    "stop": ("is_suburban", "stop_id", "stop_name"),
    "weather": ("is_suburban", "is_raining", "has_weather"),
}
KEYS = tuple(dict.fromkeys(c for of in SETS.values() for c in of))


def _count(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def _sum(x: Column) -> Column:
    return F.coalesce(F.sum(x.cast(T.LongType())), F.lit(0).cast(T.LongType()))


def daily_states(silver: DataFrame, late_seconds: int = params.LATE_SECONDS) -> DataFrame:
    """service_date, of (the grouping set), its keys and the mergeable measures."""
    rain = F.col("precip_mm")
    # the measures are columns of their own: a grouping column is NULL in the sets that leave it out
    rows = silver.select(
        "service_date", *[rain.isNotNull().alias(k) if k == "has_weather" else F.col(k) for k in KEYS],
        F.col("delay_minutes").isNotNull().alias("_known"), F.round(F.col("delay_minutes") * F.lit(100.0)).cast(T.LongType()).alias("_cents"),
        F.col("is_late_5min").alias("_late"), (F.col("delay_seconds") <= late_seconds).alias("_on_time"),
        F.round(rain * F.lit(1000.0)).cast(T.LongType()).alias("_rain"), F.when(F.col("is_raining"), 1).otherwise(0).alias("_raining"),
        F.col("is_suburban").alias("_suburban"), F.col("route_type").alias("_type"))
    numbers = {sum(1 << (len(KEYS) - 1 - i) for i, k in enumerate(KEYS) if k not in kept): of for of, kept in SETS.items()}
    of = F.create_map(*[x for n, name in numbers.items() for x in (F.lit(n).cast("long"), F.lit(name))])
    grouped = rows.groupingSets([["service_date", *kept] for kept in SETS.values()], "service_date", *KEYS)
    # all of fixed width (names are keys), so rows are hashed, not sorted
    states = grouped.agg(
        of[F.grouping_id()].alias("of"),
        F.count(F.lit(1)).alias("n"), _count(F.col("_known")).alias("known"), _sum(F.col("_cents")).alias("cents"),
        _count(F.col("_late")).alias("late"), _count(F.col("_on_time")).alias("on_time"),
        F.count("_rain").alias("rain_known"), _sum(F.col("_rain")).alias("rain_sum"),
        F.max("_raining").alias("any_rain"), F.min("_suburban").alias("line_suburban"), F.min("_type").alias("route_type"))
    return states.select("service_date", "of", *KEYS, *[c for c in states.columns if c not in ("service_date", "of", *KEYS)])


def _of(states: DataFrame, *names: str, suburban: bool = True) -> DataFrame:
    found = states.where(F.col("of").isin(*names))
    return found.where(F.col("is_suburban")) if suburban else found


_VALUE = {"delay": "delay_minutes", "trip": "trip_id", "line": "line_code", "capture": "captured_at", "line_delay": "delay_minutes", "line_trip": "trip_id"}


def _values(states: DataFrame, names: tuple[str, ...], by: tuple[str, ...], *more: Column) -> DataFrame:
    """The days' rows per value as one row a value, named as the aggregates want them."""
    kept = list(dict.fromkeys([*by, *(_VALUE[n] for n in names)]))
    merged = states.groupBy("of", *kept).agg(
        F.sum("n").alias("_n"), F.sum("late").alias("_late"), F.sum("on_time").alias("_on_time"),
        F.min("service_date").alias("_first"), F.max("service_date").alias("_last"), *more)
    return merged.withColumn("_of", F.create_map(*[x for n in names for x in (F.lit(n), F.lit(_VALUE[n]))])[F.col("of")])


def network_kpi(states: DataFrame) -> DataFrame:
    """A1."""
    names = ("delay", "trip", "line", "capture")
    return A.kpi_of_counts(_values(_of(states, *names), names, ()))


def line_punctuality(states: DataFrame) -> DataFrame:
    """A2."""
    names = ("line_delay", "line_trip")
    rows = _of(states, *names, suburban=False).where(F.col("line_code").isNotNull()).drop("is_suburban")
    rows = rows.withColumnRenamed("line_suburban", "is_suburban")
    return A.lines_of_counts(_values(rows, names, ("line_code",), *[F.min(c).alias(c) for c in A.LINE_DESCRIBED]))


def _events() -> Column:
    return F.sum("n").alias("stop_events")


def _avg() -> Column:
    return round_ratio(F.sum("cents"), F.sum("known"), 2).alias("avg_delay_min")


def _pct_late() -> Column:
    return round_ratio(F.sum("late") * 1000, F.sum("n"), 1).alias("pct_late_5min")


def hourly_punctuality(states: DataFrame) -> DataFrame:
    """A3."""
    return _of(states, "hour").where(F.col("sched_hour").isNotNull()).groupBy("sched_hour").agg(_events(), _avg(), _pct_late())


def daily_punctuality(states: DataFrame) -> DataFrame:
    """A4."""
    return _of(states, "day").groupBy("service_date").agg(
        F.min("day_of_week").alias("day_of_week"), _events(), _avg(), _pct_late(),
        round_ratio(F.sum("rain_sum"), F.sum("rain_known"), 3).alias("avg_precip_mm"), F.max("any_rain").alias("any_rain"))


def stop_punctuality(states: DataFrame, min_events: int = params.MIN_STOP_EVENTS) -> DataFrame:
    """A5."""
    found = _of(states, "stop").where(F.col("stop_name").isNotNull()).groupBy("stop_id").agg(F.min("stop_name").alias("stop_name"), _events(), _avg(), _pct_late())
    return found.where(F.col("stop_events") >= min_events)


def weather_delay(states: DataFrame) -> DataFrame:
    """A6."""
    return _of(states, "weather").where(F.col("has_weather")).groupBy("is_raining").agg(_events(), _avg(), _pct_late())


GOLD_TABLES = {f.__name__: f for f in (network_kpi, line_punctuality, hourly_punctuality, daily_punctuality, stop_punctuality, weather_delay)}
