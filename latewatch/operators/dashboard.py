"""Data behind the dashboard widgets.

A bar widget groups its dataset by the dimension and averages the measure;
these functions return exactly those rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params
from ..functions.columns import condition_label
from .ranking import worst_stations


def widget_kpis(kpi_table: DataFrame) -> DataFrame:
    """The three counters (on-time %, average and P90 delay)."""
    return kpi_table.select("pct_on_time", "avg_delay_min", "p90_delay_min")


def _bar(df: DataFrame, dim: str) -> DataFrame:
    return df.groupBy(dim).agg(F.avg("avg_delay_min").alias("avg_delay"))


def widget_lines(line_table: DataFrame) -> DataFrame:
    """Suburban lines -> average delay per line."""
    return _bar(line_table.where(F.col("is_suburban")), "line_code")


def widget_hours(hourly_table: DataFrame) -> DataFrame:
    """D3: average delay per scheduled hour."""
    return _bar(hourly_table, "sched_hour")


def widget_stations(stop_table: DataFrame, k: int = params.WIDGET_STATIONS_LIMIT) -> DataFrame:
    """The 15 worst stations, then averaged by station name.

    Stops that share a name become one bar (an average of averages), as the
    widget does.
    """
    return _bar(worst_stations(stop_table, k), "stop_name")


def widget_weather(weather_table: DataFrame) -> DataFrame:
    """Dry/Wet label -> average delay."""
    return _bar(weather_table.withColumn("condition", condition_label("is_raining")), "condition")
