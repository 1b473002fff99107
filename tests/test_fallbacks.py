"""The silver build gives the same rows on every physical path.

* broadcasting switched off for the session (sort-merge joins)
* a non-UTC session time zone (service-date fallback expression)
"""

import contextlib
import io

from latewatch.operators.enrich import build_silver
from latewatch.plans import fixtures as fx
from latewatch.plans.catalog_base import fixture_silver
from conftest import SF_SMALL


def _silver(spark, **kw):
    d = SF_SMALL
    return build_silver(fx.fx_trip_updates(spark, d), fx.fx_routes(spark, d), fx.fx_stops(spark, d),
                        fx.fx_stop_times(spark, d), fx.fx_weather(spark, d), tie_breakers=("event_id",), **kw)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_shuffle_joins_give_the_same_rows(spark):
    want = _rows(fixture_silver(spark, SF_SMALL))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        shuffled = _silver(spark)
        p = _plan(shuffled)
        assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p
        assert _rows(shuffled) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_session_zone_does_not_change_results(spark):
    want = _rows(fixture_silver(spark, SF_SMALL))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = _rows(_silver(spark))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == want
