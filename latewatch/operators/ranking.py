"""Top-k reports over the gold tables.

``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: every partition keeps
its own k best rows and only those reach the final merge.  The group key is
the second sort key so that equal rounded averages give a stable answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params


def _worst_first(df: DataFrame, key: str, k: int) -> DataFrame:
    return df.orderBy(F.col("avg_delay_min").desc_nulls_last(), F.col(key).asc_nulls_last()).limit(k)


def top_lines(line_table: DataFrame, k: int = params.TOP_K) -> DataFrame:
    """Worst suburban lines."""
    return _worst_first(line_table.where(F.col("is_suburban")), "line_code", k).select(
        "line_code", "line_name", "stop_events", "avg_delay_min", "p90_delay_min", "pct_late_5min")


def top_hours(hourly_table: DataFrame, k: int = params.TOP_K) -> DataFrame:
    """Scheduled hours with the highest average delay."""
    return _worst_first(hourly_table, "sched_hour", k).select(
        "sched_hour", "stop_events", "avg_delay_min", "pct_late_5min")


def worst_stations(stop_table: DataFrame, k: int) -> DataFrame:
    """Stations with the highest average delay (stop_id breaks ties)."""
    return _worst_first(stop_table, "stop_id", k)


def top_stations(stop_table: DataFrame, k: int = params.TOP_K) -> DataFrame:
    """Worst stations."""
    return worst_stations(stop_table, k).select(
        "stop_name", "stop_events", "avg_delay_min", "pct_late_5min")


def weather_split(weather_table: DataFrame) -> DataFrame:
    """T5: the dry and the wet row of the weather table, dry first (rain unknown before both)."""
    return weather_table.orderBy(F.col("is_raining").asc_nulls_first())
