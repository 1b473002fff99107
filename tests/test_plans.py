"""Physical-plan properties of the catalogue queries (read from ``explain``)."""

import contextlib
import io

import pytest

from latewatch.plans import catalog as entry
from latewatch.plans.catalog_base import fixture_silver
from conftest import SF_SMALL

FITTED = {"ml_encode", "fit_optimum"}   # explain would fit a model
#: Jobs that write and stream before there is a plan, which is then a scan; tests/test_catalog.py runs them.
THROUGH_FILES = {"capture_scan", "capture_scan_tolerant", "stream_ingest", "stream_latest", "medallion_refresh", "gold_update", "stream_refresh"}


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(set(entry.queries()) - FITTED - THROUGH_FILES))
def test_no_pair_explosion_or_python_rows(spark, key):
    p = plan(entry.queries()[key](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in p, f"{key}: {bad}"


def test_latest_per_key_is_reduced_before_the_shuffle(spark):
    p = plan(fixture_silver(spark, SF_SMALL), "simple")
    lines = [ln.strip() for ln in p.splitlines()]
    partial = [i for i, ln in enumerate(lines) if "WindowGroupLimit" in ln and "Partial" in ln]
    assert partial, p
    # the partial limit sits below (is printed after) the window's exchange
    exchange = [i for i, ln in enumerate(lines) if ln.startswith("+- Exchange hashpartitioning(trip_id")
                or "Exchange hashpartitioning(trip_id" in ln]
    assert exchange and min(exchange) < max(partial)


def test_dimensions_are_broadcast_under_the_size_check(spark):
    p = plan(fixture_silver(spark, SF_SMALL), "simple")
    assert p.count("BroadcastHashJoin") >= 4
    assert "SortMergeJoin" not in p


def test_gold_over_written_silver_prunes_and_pushes_down(spark, tmp_path):
    from latewatch.operators import aggregates as A
    path = str(tmp_path / "silver")
    fixture_silver(spark, SF_SMALL).write.parquet(path)
    p = plan(A.hourly_punctuality(spark.read.parquet(path)), "simple")
    scan = next(ln for ln in p.splitlines() if "FileScan parquet" in ln)
    assert "PushedFilters: [IsNotNull(is_suburban), EqualTo(is_suburban,true), IsNotNull(sched_hour)]" in scan
    read_schema = scan.split("ReadSchema: ")[1]
    assert "trip_id" not in read_schema and "stop_name" not in read_schema   # column pruning


@pytest.mark.parametrize("name", ["network_kpi", "line_punctuality"])
def test_distinct_counts_and_percentiles_share_one_scan(spark, tmp_path, name):
    from latewatch.operators import aggregates as A
    path = str(tmp_path / "silver")
    fixture_silver(spark, SF_SMALL).write.parquet(path)
    p = plan(A.GOLD_TABLES[name](spark.read.parquet(path)), "simple")
    assert p.count("FileScan parquet") == 1 and "Join" not in p and "Subquery" not in p


def test_one_scan_aggregates_on_missing_values_and_empty_input(spark):
    from latewatch.operators import aggregates as A
    rows = [("a", "T1", None, 0.5, True), ("a", None, "x", None, None), (None, "T1", "y", -0.5, False)]
    df = spark.createDataFrame(rows, "trip_id string, line_code string, line_name string, delay_minutes double, is_late_5min boolean")
    df = df.selectExpr("*", "true as is_suburban", "2 as route_type", "cast(delay_minutes * 60 as int) as delay_seconds",
                       "date'2024-01-01' as service_date", "timestamp'2024-01-01 00:00:00' as captured_at")
    k = A.network_kpi(df).first()
    assert (k.stop_events, k.trips, k.lines, k.captures) == (3, 1, 1, 1)
    assert (k.avg_delay_min, k.median_delay_min, k.p90_delay_min, k.pct_late_5min, k.pct_on_time) == (0.0, -0.5, 0.5, 33.3, 66.7)
    (line,) = A.line_punctuality(df).collect()
    assert (line.line_code, line.line_name, line.stop_events, line.trips, line.p90_delay_min) == ("T1", "y", 2, 1, 0.5)
    k = A.network_kpi(df.limit(0)).first()
    assert (k.stop_events, k.trips, k.captures) == (0, 0, 0) and k.median_delay_min is None and k.pct_on_time is None
    assert A.line_punctuality(df.limit(0)).count() == 0


def test_tables_have_their_contract(spark):
    from latewatch import schemas
    from latewatch.operators import model as M
    from latewatch.plans.q_model import WEIGHTS
    silver = fixture_silver(spark, SF_SMALL)
    silver = silver.withColumn("captured_at", silver.captured_at.cast("timestamp"))   # the driver's events have no zone
    predictions = M.delay_predictions(WEIGHTS, M.ml_features(silver))
    for df, want in ((silver, schemas.SILVER), (predictions, schemas.PREDICTIONS)):
        assert {f.name: f.dataType for f in df.schema} == {f.name: f.dataType for f in want}
