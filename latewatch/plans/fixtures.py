"""Adapter views: the driver's star-schema tables re-shaped as GTFS inputs.

Roles: an event is a stop update, a user is a trip, the customer's nation is
the route, ``props.k`` (0-99) is the stop, part names are stop names and the
hours that have events carry weather.  Each view exists twice: as DataFrame
code (what the Spark queries run) and as SQL text in one dialect that DuckDB
runs for the oracle.  Both give identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import left_join_small

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


_TABLES: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table.  The driver tables are read-only, so the (lazy) reader is
    kept per session and path, saving the file listing and footer read per query."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def _k(props="props") -> F.Column:
    return F.regexp_extract(F.col(props), r"([0-9]+)", 1).cast(T.IntegerType())


def _s(x) -> F.Column:
    return x.cast(T.StringType())


def fx_trip_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop updates: one per event, route from the user's nation, stop from props.k."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", _k().alias("k"))
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_custkey"), F.col("c_nationkey").alias("nk"))
    x = left_join_small(ev, cust, ev["user_id"] == cust["c_custkey"])
    et, k, nk, v = F.col("event_type"), F.col("k"), F.col("nk"), F.col("value")
    delay = F.floor(v * 6).cast(T.DoubleType()) - 60
    return x.select(
        "event_id",
        F.concat(F.lit("trip_"), _s(F.col("user_id"))).alias("trip_id"),
        F.when(nk >= 23, F.concat(F.lit("RTTA_"), _s(nk)))
         .when(nk == 22, F.lit(None).cast(T.StringType()))
         .otherwise(F.concat(F.lit("r_"), _s(nk))).alias("route_id"),
        F.when((et == "click") & (k >= 95), F.lit(None).cast(T.StringType()))
         .otherwise(F.concat(F.lit("s_"), _s(k))).alias("stop_id"),
        F.when(et == "view", F.lit(None).cast(T.DoubleType())).otherwise(delay).alias("arrival_delay"),
        F.when((et == "view") & (k < 10), F.lit(None).cast(T.DoubleType()))
         .otherwise(F.floor(v * 6).cast(T.DoubleType()) - 30).alias("departure_delay"),
        F.when((et == "error") & (k < 50), F.lit(1))
         .when(et == "signup", F.lit(None).cast(T.IntegerType()))
         .otherwise(F.lit(0)).alias("stu_schedule_relationship"),
        F.col("ts").alias("captured_at"),
    )


def fx_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        F.concat(F.when(n == 21, "closed_").otherwise("r_"), _s(n)).alias("route_id"),
        F.concat(F.when(n < 10, F.lit("T")).otherwise(F.lit("C")), _s(n)).alias("route_short_name"),
        F.col("n_name").alias("route_long_name"),
        F.when(n % 7 == 6, F.lit("rail")).otherwise(F.lit("2")).alias("route_type"),
    )


def fx_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.concat(F.when(p == 13, "closed_").otherwise("s_"), _s(p)).alias("stop_id"), F.col("p_name").alias("stop_name"))


def fx_stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheduled arrival per (trip, stop): earliest event hour, hours < 4 written as 24+.

    One pair in fifty is under another trip key, so that some events find no schedule.
    """
    a = table(spark, sf_dir, "events").select(
        "user_id", F.hour("ts").alias("h"), _k().alias("k"))
    b = a.groupBy("user_id", "k").agg(F.min("h").alias("h"))
    h = F.col("h")
    hh = F.lpad(_s(F.when(h < 4, h + 24).otherwise(h)), 2, "0")
    other = (F.col("user_id") + F.col("k")) % 50 == 0
    return b.select(
        F.concat(F.when(other, "closed_").otherwise("trip_"), _s(F.col("user_id"))).alias("trip_id"),
        F.concat(F.lit("s_"), _s(F.col("k"))).alias("stop_id"),
        F.concat(hh, F.lit(":10:00")).alias("arrival_time"),
    )


def fx_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather for every (date, hour) that has events; 03:00 is filed as hour 27, so
    that events of that hour find none."""
    w = table(spark, sf_dir, "events").select(
        _s(F.col("ts").cast(T.DateType())).alias("obs_date"),
        F.dayofmonth("ts").alias("d"), F.hour("ts").alias("h")).distinct()
    d, h = F.col("d"), F.col("h")
    return w.select(
        "obs_date", F.when(h == 3, 27).otherwise(h).cast(T.IntegerType()).alias("obs_hour"),
        F.when((d * 5 + h) % 4 == 0, ((d * 7 + h * 3) % 20).cast(T.DoubleType()) / 10)
         .otherwise(F.lit(0.0)).alias("precip_mm"),
        (F.lit(15) + (d * 3 + h) % 12).cast(T.DoubleType()).alias("temp_c"),
    )


# The same five views in SQL (DuckDB dialect; also valid Spark SQL).
FX_SQL = {
    "fx_trip_updates": """
SELECT event_id,
  'trip_' || CAST(user_id AS STRING) AS trip_id,
  CASE WHEN nk >= 23 THEN 'RTTA_' || CAST(nk AS STRING)
       WHEN nk = 22 THEN NULL
       ELSE 'r_' || CAST(nk AS STRING) END AS route_id,
  CASE WHEN event_type = 'click' AND k >= 95 THEN NULL
       ELSE 's_' || CAST(k AS STRING) END AS stop_id,
  CASE WHEN event_type = 'view' THEN NULL
       ELSE CAST(FLOOR(value * 6) AS DOUBLE) - 60 END AS arrival_delay,
  CASE WHEN event_type = 'view' AND k < 10 THEN NULL
       ELSE CAST(FLOOR(value * 6) AS DOUBLE) - 30 END AS departure_delay,
  CASE WHEN event_type = 'error' AND k < 50 THEN 1
       WHEN event_type = 'signup' THEN NULL ELSE 0 END AS stu_schedule_relationship,
  ts AS captured_at
FROM (SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value, c.c_nationkey AS nk,
             CAST(regexp_extract(e.props, '([0-9]+)', 1) AS INT) AS k
      FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id) x""",
    "fx_routes": """
SELECT CASE WHEN n_nationkey = 21 THEN 'closed_' ELSE 'r_' END || CAST(n_nationkey AS STRING) AS route_id,
  CASE WHEN n_nationkey < 10 THEN 'T' ELSE 'C' END || CAST(n_nationkey AS STRING) AS route_short_name,
  n_name AS route_long_name,
  CASE WHEN n_nationkey % 7 = 6 THEN 'rail' ELSE '2' END AS route_type
FROM nation""",
    "fx_stops": """
SELECT CASE WHEN p_partkey = 13 THEN 'closed_' ELSE 's_' END || CAST(p_partkey AS STRING) AS stop_id, p_name AS stop_name
FROM part""",
    "fx_stop_times": """
SELECT CASE WHEN (user_id + k) % 50 = 0 THEN 'closed_' ELSE 'trip_' END || CAST(user_id AS STRING) AS trip_id, 's_' || CAST(k AS STRING) AS stop_id,
  LPAD(CAST(CASE WHEN h < 4 THEN h + 24 ELSE h END AS STRING), 2, '0') || ':10:00' AS arrival_time
FROM (SELECT user_id, k, MIN(h) AS h
      FROM (SELECT user_id, EXTRACT(HOUR FROM ts) AS h,
                   CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events) a
      GROUP BY user_id, k) b""",
    "fx_weather": """
SELECT obs_date, CAST(CASE WHEN h = 3 THEN 27 ELSE h END AS INT) AS obs_hour,
  CASE WHEN (d * 5 + h) % 4 = 0 THEN CAST((d * 7 + h * 3) % 20 AS DOUBLE) / 10 ELSE CAST(0 AS DOUBLE) END AS precip_mm,
  CAST(15 + (d * 3 + h) % 12 AS DOUBLE) AS temp_c
FROM (SELECT DISTINCT CAST(CAST(ts AS DATE) AS STRING) AS obs_date,
             EXTRACT(DAY FROM ts) AS d, EXTRACT(HOUR FROM ts) AS h FROM events) w""",
}


def with_views(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with a WITH clause defining the named fixture views (in order)."""
    defs = dict(FX_SQL)
    defs.update(extra or {})
    parts = [f"{n} AS ({defs[n].strip()})" for n in names]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
