"""Gold aggregates over the silver table.

All are ``groupBy().agg()`` with partial (map-side) aggregation.  Where distinct
counts and exact percentiles meet (A1, A2), one scan counts the rows of each value
of each column (grouping sets), and everything follows from those counts; the
percentiles' value counts are bounded by the distinct delays (0.01 minute
resolution), not by the number of rows.  Averages and percentages use
the exact integer rounding of :mod:`latewatch.functions.rounding`.

``any_value`` of the original is ``min`` here: several routes share one short
name, so ``any_value(line_name)`` is not determined by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params
from ..functions.rounding import exact_avg, exact_pct, round_ratio


def _by_value(rows: DataFrame, by: list[str], values: list[str], *sums: Column) -> DataFrame:
    """One row for each value of each column of ``values`` (and each ``by``), from one scan.

    Every column is a grouping set of its own: ``_n`` counts the rows of a value and
    ``_of`` names the column it is of.
    """
    of = F.coalesce(*[F.when(F.grouping(v) == 0, F.lit(v)) for v in values])
    return rows.groupingSets([[*by, v] for v in values], *by, *values).agg(
        of.alias("_of"), F.count(F.lit(1)).alias("_n"), *sums)


def _distinct(col: str) -> Column:
    """``count(DISTINCT col)`` over the rows of :func:`_by_value`."""
    return F.count(F.when(F.col("_of") == col, F.col(col)))


def _total(of: str, x: Column) -> Column:
    """Sum over the rows of one of the grouping sets of :func:`_by_value`."""
    return F.coalesce(F.sum(F.when(F.col("_of") == of, x)), F.lit(0)).cast(T.LongType())


def _delays() -> list[Column]:
    """Of the delay's grouping set: rows, rows with a delay, their sum (0.01 minutes), value counts in order."""
    d = F.col("delay_minutes")
    known = d.isNotNull()
    return [_total("delay_minutes", F.col("_n")).alias("stop_events"),
            _total("delay_minutes", F.when(known, F.col("_n"))).alias("_known"),
            _total("delay_minutes", F.round(d * F.lit(100.0)).cast(T.LongType()) * F.col("_n")).alias("_sum"),
            F.sort_array(F.collect_list(F.when((F.col("_of") == "delay_minutes") & known,
                                               F.struct(d.alias("v"), F.col("_n").alias("n"))))).alias("_values")]


def _percentile(q: float) -> Column:
    """Exact discrete percentile (the smallest value whose cumulative share >= q) of ``_values``."""
    rank = F.greatest(F.ceil(F.lit(q) * F.col("_known")), F.lit(1))
    start = F.struct(F.lit(0).cast(T.LongType()).alias("seen"), F.lit(None).cast(T.DoubleType()).alias("value"))

    def step(a: Column, x: Column) -> Column:
        seen = a["seen"] + x["n"]
        return F.struct(seen.alias("seen"),
                        F.when(a["value"].isNull() & (seen >= rank), x["v"]).otherwise(a["value"]).alias("value"))
    return F.round(F.aggregate("_values", start, step, lambda a: a["value"]), 2)


def _avg() -> Column:
    return exact_avg("delay_minutes", 2).alias("avg_delay_min")


def _pct_late() -> Column:
    return exact_pct(F.col("is_late_5min")).alias("pct_late_5min")


def _suburban(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("is_suburban"))


def network_kpi(silver: DataFrame, late_seconds: int = params.LATE_SECONDS) -> DataFrame:
    """A1: one row of suburban network KPIs, from one scan."""
    counts = _by_value(
        _suburban(silver), [], ["delay_minutes", "trip_id", "line_code", "captured_at"],
        F.count(F.when(F.col("is_late_5min"), 1)).alias("_late"),
        F.count(F.when(F.col("delay_seconds") <= late_seconds, 1)).alias("_on_time"),
        F.min("service_date").alias("_first"), F.max("service_date").alias("_last"))
    return kpi_of_counts(counts)


def kpi_of_counts(counts: DataFrame) -> DataFrame:
    """A1 from the rows of :func:`_by_value` (``_of``, its value, ``_n``, ``_late``, ``_on_time``, ``_first``, ``_last``)."""
    k = counts.agg(
        *_delays(),
        _distinct("trip_id").alias("trips"), _distinct("line_code").alias("lines"),
        _distinct("captured_at").alias("captures"),
        _total("delay_minutes", F.col("_late")).alias("_late"),
        _total("delay_minutes", F.col("_on_time")).alias("_on_time"),
        F.min("_first").alias("first_day"), F.max("_last").alias("last_day"))
    return k.select(
        "stop_events", "trips", "lines",
        round_ratio(F.col("_sum"), F.col("_known"), 2).alias("avg_delay_min"),
        _percentile(0.5).alias("median_delay_min"), _percentile(0.9).alias("p90_delay_min"),
        round_ratio(F.col("_late") * 1000, F.col("stop_events"), 1).alias("pct_late_5min"),
        round_ratio(F.col("_on_time") * 1000, F.col("stop_events"), 1).alias("pct_on_time"),
        "first_day", "last_day", "captures")


def line_punctuality(silver: DataFrame) -> DataFrame:
    """A2: every line (suburban or not) with its punctuality, from one scan."""
    counts = _by_value(
        silver.where(F.col("line_code").isNotNull()), ["line_code"], ["delay_minutes", "trip_id"],
        F.count(F.when(F.col("is_late_5min"), 1)).alias("_late"), *[F.min(c).alias(c) for c in LINE_DESCRIBED])
    return lines_of_counts(counts)


#: What describes a line; ``min`` where its events differ.
LINE_DESCRIBED = ("line_name", "is_suburban", "route_type")


def lines_of_counts(counts: DataFrame) -> DataFrame:
    """A2 from the rows of :func:`_by_value` by line."""
    described = LINE_DESCRIBED
    k = counts.groupBy("line_code").agg(
        *_delays(), _distinct("trip_id").alias("trips"),
        _total("delay_minutes", F.col("_late")).alias("_late"), *[F.min(c).alias(c) for c in described])
    return k.select(
        "line_code", *described, "stop_events", "trips",
        round_ratio(F.col("_sum"), F.col("_known"), 2).alias("avg_delay_min"),
        _percentile(0.9).alias("p90_delay_min"),
        round_ratio(F.col("_late") * 1000, F.col("stop_events"), 1).alias("pct_late_5min"))


def hourly_punctuality(silver: DataFrame) -> DataFrame:
    """A3: suburban punctuality per scheduled hour."""
    return (_suburban(silver).where(F.col("sched_hour").isNotNull()).groupBy("sched_hour")
            .agg(F.count(F.lit(1)).alias("stop_events"), _avg(), _pct_late()))


def daily_punctuality(silver: DataFrame) -> DataFrame:
    """A4: suburban punctuality per service date, with the day's rain."""
    return _suburban(silver).groupBy("service_date").agg(
        F.min("day_of_week").alias("day_of_week"),
        F.count(F.lit(1)).alias("stop_events"),
        _avg(), _pct_late(),
        exact_avg("precip_mm", 3).alias("avg_precip_mm"),
        F.max(F.when(F.col("is_raining"), 1).otherwise(0)).alias("any_rain"),
    )


def stop_punctuality(silver: DataFrame, min_events: int = params.MIN_STOP_EVENTS) -> DataFrame:
    """A5: suburban stations with at least ``min_events`` stop events."""
    return (_suburban(silver).where(F.col("stop_name").isNotNull()).groupBy("stop_id").agg(
        F.min("stop_name").alias("stop_name"),
        F.count(F.lit(1)).alias("stop_events"),
        _avg(), _pct_late(),
    ).where(F.col("stop_events") >= min_events))


def weather_delay(silver: DataFrame) -> DataFrame:
    """Suburban dry vs wet split; events without weather are excluded."""
    return (_suburban(silver).where(F.col("precip_mm").isNotNull()).groupBy("is_raining")
            .agg(F.count(F.lit(1)).alias("stop_events"), _avg(), _pct_late()))


def silver_overview(silver: DataFrame) -> DataFrame:
    """Events, trips, lines and % with a scheduled time."""
    return silver.agg(
        F.count(F.lit(1)).alias("stop_events"),
        F.countDistinct("trip_id").alias("trips"),
        F.countDistinct("line_code").alias("lines"),
        exact_pct(F.col("schedule_matched")).alias("pct_schedule_matched"),
    )


def suburban_summary(silver: DataFrame) -> DataFrame:
    """Suburban average delay, % late and worst delay."""
    return _suburban(silver).agg(_avg(), _pct_late(),
                                 F.max("delay_minutes").alias("max_delay_min"))


def worst_lines(silver: DataFrame, min_events: int = params.MIN_LINE_EVENTS,
                limit: int = params.WORST_LINES_LIMIT) -> DataFrame:
    """Suburban lines with >= ``min_events`` events, worst average first."""
    agg = (_suburban(silver).groupBy("line_code").agg(
        F.min("line_name").alias("line_name"),
        F.count(F.lit(1)).alias("stop_events"),
        _avg(), _pct_late(),
    ).where(F.col("stop_events") >= min_events))
    return agg.orderBy(F.col("avg_delay_min").desc_nulls_last(), F.col("line_code").asc()).limit(limit)


def weather_overview(silver: DataFrame) -> DataFrame:
    """A10: weather coverage and dry/wet averages over all events.

    Events with no weather count as dry here (P12), unlike ``weather_delay``.
    """
    raining = F.col("is_raining")
    return silver.agg(
        exact_pct(F.col("precip_mm").isNotNull()).alias("pct_weather_matched"),
        exact_avg(F.when(~raining, F.col("delay_minutes")), 2).alias("avg_dry_min"),
        exact_avg(F.when(raining, F.col("delay_minutes")), 2).alias("avg_wet_min"),
        F.sum(F.when(raining, 1).otherwise(0)).cast(T.LongType()).alias("wet_events"),
    )


GOLD_TABLES = {
    "network_kpi": network_kpi,
    "line_punctuality": line_punctuality,
    "hourly_punctuality": hourly_punctuality,
    "daily_punctuality": daily_punctuality,
    "stop_punctuality": stop_punctuality,
    "weather_delay": weather_delay,
}
