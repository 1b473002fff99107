"""The query catalogue: every operator as a (Spark query, DuckDB oracle SQL) pair.

Each Spark query is a callable ``(spark, sf_dir) -> DataFrame`` over the
driver's tables (through the fixture adapters of :mod:`.fixtures`); the
oracle is the same computation as SQL text over the same parquet tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import aggregates as A
from ..operators import dashboard as D
from ..operators import ranking as R
from . import sql as Q
from .catalog_base import fixture_silver
from .registry import CATALOG, Query, register


# --- J5 silver and the gold tables (A1-A6) ------------------------------------
register("silver_stop_delays", Q.over_silver("SELECT * FROM silver"))(fixture_silver)


def _gold(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return A.GOLD_TABLES[name](fixture_silver(spark, sf_dir))
    q.__name__ = name
    return q


for _name in A.GOLD_TABLES:
    register(_name, Q.over_silver(Q.GOLD[_name]))(_gold(_name))


# --- A7-A10 proof queries -----------------------------------------------------
register("silver_overview", Q.over_silver(f"""
SELECT count(*) AS stop_events, count(DISTINCT trip_id) AS trips, count(DISTINCT line_code) AS lines,
  {Q.exact_pct('schedule_matched')} AS pct_schedule_matched
FROM silver"""))(lambda spark, d: A.silver_overview(fixture_silver(spark, d)))

register("suburban_summary", Q.over_silver(f"""
SELECT {Q.AVG}, {Q.PCT_LATE}, max(delay_minutes) AS max_delay_min FROM silver WHERE is_suburban"""))(
    lambda spark, d: A.suburban_summary(fixture_silver(spark, d)))

register("worst_lines", Q.over_silver(f"""
SELECT line_code, min(line_name) AS line_name, count(*) AS stop_events, {Q.AVG}, {Q.PCT_LATE}
FROM silver WHERE is_suburban GROUP BY line_code HAVING count(*) >= 25
ORDER BY avg_delay_min DESC NULLS LAST, line_code LIMIT 8"""))(
    lambda spark, d: A.worst_lines(fixture_silver(spark, d)))

register("weather_overview", Q.over_silver(f"""
SELECT {Q.exact_pct('precip_mm IS NOT NULL')} AS pct_weather_matched,
  {Q.exact_avg('CASE WHEN NOT is_raining THEN delay_minutes END')} AS avg_dry_min,
  {Q.exact_avg('CASE WHEN is_raining THEN delay_minutes END')} AS avg_wet_min,
  CAST(sum(CASE WHEN is_raining THEN 1 ELSE 0 END) AS BIGINT) AS wet_events
FROM silver"""))(lambda spark, d: A.weather_overview(fixture_silver(spark, d)))


# --- T1-T4 top-k ----------------------------------------------------------------
register("top_lines", Q.over_gold("""
SELECT line_code, line_name, stop_events, avg_delay_min, p90_delay_min, pct_late_5min
FROM line_punctuality WHERE is_suburban ORDER BY avg_delay_min DESC NULLS LAST, line_code LIMIT 6""",
                                  "line_punctuality"))(
    lambda spark, d: R.top_lines(A.line_punctuality(fixture_silver(spark, d))))

register("weather_split", Q.over_gold("SELECT * FROM weather_delay ORDER BY is_raining", "weather_delay"))(
    lambda spark, d: R.weather_split(A.weather_delay(fixture_silver(spark, d))))

register("top_hours", Q.over_gold("""
SELECT sched_hour, stop_events, avg_delay_min, pct_late_5min FROM hourly_punctuality
ORDER BY avg_delay_min DESC NULLS LAST, sched_hour LIMIT 6""", "hourly_punctuality"))(
    lambda spark, d: R.top_hours(A.hourly_punctuality(fixture_silver(spark, d))))

register("top_stations", Q.over_gold("""
SELECT stop_name, stop_events, avg_delay_min, pct_late_5min FROM stop_punctuality
ORDER BY avg_delay_min DESC NULLS LAST, stop_id LIMIT 6""", "stop_punctuality"))(
    lambda spark, d: R.top_stations(A.stop_punctuality(fixture_silver(spark, d))))


# --- D1-D5 dashboard widgets ------------------------------------------------------
register("widget_kpis", Q.over_gold(
    "SELECT pct_on_time, avg_delay_min, p90_delay_min FROM network_kpi", "network_kpi"))(
    lambda spark, d: D.widget_kpis(A.network_kpi(fixture_silver(spark, d))))

register("widget_lines", Q.over_gold("""
SELECT line_code, avg(avg_delay_min) AS avg_delay FROM line_punctuality WHERE is_suburban
GROUP BY line_code""", "line_punctuality"))(
    lambda spark, d: D.widget_lines(A.line_punctuality(fixture_silver(spark, d))))

register("widget_hours", Q.over_gold("""
SELECT sched_hour, avg(avg_delay_min) AS avg_delay FROM hourly_punctuality GROUP BY sched_hour""",
                                     "hourly_punctuality"))(
    lambda spark, d: D.widget_hours(A.hourly_punctuality(fixture_silver(spark, d))))

register("widget_stations", Q.over_gold("""
SELECT stop_name, avg(avg_delay_min) AS avg_delay FROM (
  SELECT stop_name, avg_delay_min FROM stop_punctuality
  ORDER BY avg_delay_min DESC NULLS LAST, stop_id LIMIT 15) t
GROUP BY stop_name""", "stop_punctuality"))(
    lambda spark, d: D.widget_stations(A.stop_punctuality(fixture_silver(spark, d))))

register("widget_weather", Q.over_gold("""
SELECT CASE WHEN is_raining THEN 'Wet' ELSE 'Dry' END AS condition, avg(avg_delay_min) AS avg_delay
FROM weather_delay GROUP BY CASE WHEN is_raining THEN 'Wet' ELSE 'Dry' END""", "weather_delay"))(
    lambda spark, d: D.widget_weather(A.weather_delay(fixture_silver(spark, d))))


from . import q_operators, q_sources, q_model, q_lake  # noqa: E402,F401  (register their queries)


def queries() -> dict[str, Query]:
    return {k: fn for k, (fn, _) in CATALOG.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in CATALOG.items() if sql is not None}
