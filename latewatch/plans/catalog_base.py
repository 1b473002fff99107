"""The fixture silver table shared by the catalogue queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.enrich import build_silver
from . import fixtures as fx


def fixture_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SIL: the silver table over the fixture views (ties broken by event_id, descending)."""
    return build_silver(
        fx.fx_trip_updates(spark, sf_dir), fx.fx_routes(spark, sf_dir), fx.fx_stops(spark, sf_dir),
        fx.fx_stop_times(spark, sf_dir), fx.fx_weather(spark, sf_dir), tie_breakers=("event_id",))
