"""Small builders for hand-written test inputs."""

from datetime import datetime

from latewatch import schemas

ROUTES = [("r1", "T1", "North Shore", "2"), ("r2", "T4", "Eastern Suburbs", "2"),
          ("r3", "CCN", "Central Coast", "rail"), ("RTTA_1", "RTTA", "Depot run", "2")]
STOPS = [("s1", "Central"), ("s2", "Town Hall"), ("s3", "Wynyard")]


def updates(spark, rows):
    """rows: dicts with any of the trip-update contract columns (others NULL)."""
    cols = [f.name for f in schemas.TRIP_UPDATES.fields]
    data = [tuple(r.get(c) for c in cols) for r in rows]
    return spark.createDataFrame(data, schemas.TRIP_UPDATES)


def routes(spark, rows=ROUTES):
    return spark.createDataFrame(rows, schemas.ROUTES)


def stops(spark, rows=STOPS):
    return spark.createDataFrame(rows, schemas.STOPS)


def stop_times(spark, rows):
    return spark.createDataFrame(rows, schemas.STOP_TIMES)


def weather(spark, rows):
    """rows: (obs_date, obs_hour, precip_mm, temp_c)."""
    full = [(f"{d}T{h:02d}:00", p, None, t, d, h) for d, h, p, t in rows]
    return spark.createDataFrame(full, schemas.WEATHER)


def utc(*a):
    return datetime(*a)
