"""Silver build (P1-P13, W1, J1-J5) on hand-written captures."""

from datetime import datetime

from pyspark.sql import functions as F

from latewatch.operators import aggregates as A
from latewatch.operators.enrich import SILVER_COLUMNS, build_silver
from helpers import routes, stop_times, stops, updates, weather

T0 = datetime(2024, 1, 1, 21, 0)      # 08:00 Sydney (UTC+11) on 2024-01-02
T1 = datetime(2024, 1, 1, 21, 15)


def _build(spark, rows, st_rows=None, wx_rows=None, **kw):
    st_rows = st_rows if st_rows is not None else [("t1", "s1", "08:10:00"), ("t1", "s2", "25:30:00")]
    wx_rows = wx_rows if wx_rows is not None else [("2024-01-02", 8, 0.2, 21.0), ("2024-01-02", 1, 0.0, 18.0)]
    return build_silver(updates(spark, rows), routes(spark), stops(spark), stop_times(spark, st_rows),
                        weather(spark, wx_rows), tie_breakers=("entity_id",), **kw)


def test_schema_and_basic_row(spark):
    s = _build(spark, [dict(entity_id="a", trip_id="t1", route_id="r1", stop_id="s1",
                            arrival_delay=372.0, captured_at=T0)])
    assert tuple(s.columns) == SILVER_COLUMNS
    r = s.first()
    assert str(r.service_date) == "2024-01-02" and r.day_of_week == "Tue"
    assert (r.line_code, r.is_suburban, r.route_type, r.stop_name) == ("T1", True, 2, "Central")
    assert (r.sched_hour, r.delay_seconds, r.delay_minutes, r.is_late_5min) == (8, 372, 6.2, True)
    assert r.schedule_matched and r.precip_mm == 0.2 and r.is_raining is True


def test_newest_valid_capture_wins(spark):
    rows = [dict(entity_id="a", trip_id="t1", route_id="r1", stop_id="s1", arrival_delay=60.0, captured_at=T0),
            # newer capture without any delay must not displace the older good one
            dict(entity_id="b", trip_id="t1", route_id="r1", stop_id="s1", captured_at=T1),
            # newer capture that is skipped must not win either
            dict(entity_id="c", trip_id="t1", route_id="r1", stop_id="s1", departure_delay=999.0,
                 stu_schedule_relationship=1, captured_at=T1)]
    r = _build(spark, rows).collect()
    assert len(r) == 1 and r[0].delay_seconds == 60


def test_tie_on_captured_at_is_deterministic(spark):
    rows = [dict(entity_id=e, trip_id="t1", route_id="r1", stop_id="s1", arrival_delay=d, captured_at=T0)
            for e, d in [("a", 10.0), ("z", 20.0), ("m", 30.0)]]
    assert [r.delay_seconds for r in _build(spark, rows).collect()] == [20]


def test_filters_and_null_route(spark):
    rows = [dict(entity_id="a", trip_id="t1", route_id="RTTA_1", stop_id="s1", arrival_delay=1.0, captured_at=T0),
            dict(entity_id="b", trip_id="t2", route_id=None, stop_id="s1", arrival_delay=1.0, captured_at=T0),
            dict(entity_id="c", trip_id="t3", route_id="r9", stop_id="s1", arrival_delay=1.0, captured_at=T0)]
    r = _build(spark, rows).collect()
    assert [x.trip_id for x in r] == ["t3"]                  # unmatched route kept, NULL line
    assert r[0].line_code is None and r[0].is_suburban is None


def test_post_midnight_and_missing_weather(spark):
    rows = [dict(entity_id="a", trip_id="t1", route_id="r3", stop_id="s2", arrival_delay=-30.0, captured_at=T0),
            dict(entity_id="b", trip_id="t1", route_id="r3", stop_id="s3", arrival_delay=0.0, captured_at=T0)]
    r = {x.stop_id: x for x in _build(spark, rows).collect()}
    # 25:30 -> hour 1 of the capture's service date (the original's rule, reproduced)
    assert r["s2"].sched_hour == 1 and r["s2"].precip_mm == 0.0 and r["s2"].is_raining is False
    assert r["s2"].route_type is None                        # 'rail' is not an int
    assert r["s3"].sched_hour is None and not r["s3"].schedule_matched
    assert r["s3"].precip_mm is None and r["s3"].is_raining is False


def test_duplicate_schedule_row_fans_out(spark):
    rows = [dict(entity_id="a", trip_id="t1", route_id="r1", stop_id="s1", arrival_delay=5.0, captured_at=T0)]
    st = [("t1", "s1", "08:10:00"), ("t1", "s1", "09:10:00")]
    assert _build(spark, rows, st_rows=st).count() == 2


def test_stop_punctuality_threshold(spark):
    rows = []
    for i in range(20):
        rows.append(dict(entity_id=f"a{i}", trip_id=f"t{i}", route_id="r1", stop_id="s1",
                         arrival_delay=60.0, captured_at=T0))
    for i in range(19):
        rows.append(dict(entity_id=f"b{i}", trip_id=f"t{i}", route_id="r1", stop_id="s2",
                         arrival_delay=60.0, captured_at=T0))
    g = A.stop_punctuality(_build(spark, rows)).collect()
    assert [(r.stop_id, r.stop_events) for r in g] == [("s1", 20)]


def test_network_kpi_values(spark):
    rows = [dict(entity_id=f"e{i}", trip_id=f"t{i % 3}", route_id="r2", stop_id=f"s{i % 3 + 1}",
                 arrival_delay=float(d), captured_at=T0) for i, d in enumerate([0, 60, 120, 301, 600])]
    k = A.network_kpi(_build(spark, rows)).first()
    assert k.stop_events == 3 and k.trips == 3 and k.lines == 1     # W1 keeps 3 (trip, stop) keys
    assert k.captures == 1 and str(k.first_day) == "2024-01-02"
    silver = _build(spark, rows)
    assert k.pct_late_5min == round(100.0 * silver.where(F.col("is_late_5min")).count() / 3, 1)
