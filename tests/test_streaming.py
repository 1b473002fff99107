"""ST1/ST2: stream results equal the batch results, and a replayed batch is harmless."""

from pyspark.sql import functions as F

from latewatch.operators.enrich import latest_stop_events, prepare_updates
from latewatch.plans import fixtures as fx
from latewatch.sources import captures, versioned
from latewatch.streaming import ingest
from conftest import SF_SMALL


def _land_in_three_captures(spark, root):
    u = fx.fx_trip_updates(spark, SF_SMALL).withColumn("entity_id", F.col("event_id").cast("string"))
    day = F.dayofmonth("captured_at")
    for lo, hi in [(1, 10), (11, 20), (21, 31)]:
        captures.land_captures(u.where((day >= lo) & (day <= hi)), root)
    return u


def _key(r):
    return (r.trip_id, str(r.service_date), r.stop_id, r.captured_at, r.delay_seconds)


def test_ingest_and_latest_state_equal_batch(spark, tmp_path):
    landing = str(tmp_path / "landing")
    _land_in_three_captures(spark, landing)
    bronze = str(tmp_path / "bronze")
    q = ingest.start_capture_ingest(spark, landing, bronze, str(tmp_path / "cp1"))
    q.awaitTermination()
    batch = captures.read_captures(spark, landing)
    assert spark.read.parquet(bronze).count() == batch.count()

    state = str(tmp_path / "state")
    q2 = ingest.start_latest_state(spark, landing, state, str(tmp_path / "cp2"), tie_breakers=("entity_id",),
                                   max_files_per_trigger=8)
    q2.awaitTermination()
    assert len(q2.recentProgress) >= 2                      # really incremental
    streamed = ingest.read_latest_state(spark, state)
    expected = latest_stop_events(prepare_updates(batch, tie_breakers=("entity_id",)), ("entity_id",))
    got = sorted(map(_key, streamed.collect()), key=repr)
    want = sorted(map(_key, expected.collect()), key=repr)
    assert got == want and len(got) > 0

    # replaying the last batch id with the same rows changes nothing
    last = batch.where(F.dayofmonth(F.col("captured_at")) >= 21)
    ingest.merge_batch(last, 99, state, ("entity_id",))
    again = sorted(map(_key, ingest.read_latest_state(spark, state).collect()), key=repr)
    assert again == want


def _state(spark, state):
    return sorted(map(_key, ingest.read_latest_state(spark, state).collect()), key=repr)


def test_a_job_that_dies_at_any_write_loses_nothing(spark, tmp_path, monkeypatch):
    """Stops before, between and after the writes of a batch, then replays its id."""
    import pytest
    u = fx.fx_trip_updates(spark, SF_SMALL).withColumn("entity_id", F.col("event_id").cast("string"))
    day = F.dayofmonth("captured_at")
    batches = [u.where((day >= lo) & (day <= hi)) for lo, hi in [(1, 10), (9, 20), (18, 31)]]
    want = sorted(map(_key, latest_stop_events(prepare_updates(u, tie_breakers=("entity_id",)), ("entity_id",)).collect()), key=repr)
    for broken, after in ((step, x) for step in ("_rows", "_put", "_clean") for x in (False, True)):
        state = str(tmp_path / f"{broken}-{after}")
        for i, batch in enumerate(batches):
            if i:
                plain = getattr(versioned, broken)

                def dies(*a, **k):
                    if after:
                        plain(*a, **k)
                    raise RuntimeError("lost")
                before = _state(spark, state)
                with monkeypatch.context() as m:
                    m.setattr(versioned, broken, dies)
                    with pytest.raises(RuntimeError):
                        ingest.merge_batch(batch, i, state)
                if broken == "_rows" or (broken == "_put" and not after):
                    assert _state(spark, state) == before
            ingest.merge_batch(batch, i, state)
        assert _state(spark, state) == want


def test_stream_refresh_and_stream_again(spark, tmp_path):
    """The batch refresh replaces its own table only; the stream goes on."""
    from latewatch.plans.pipeline import refresh_bronze
    landing, lake = str(tmp_path / "landing"), str(tmp_path / "lake")
    u = fx.fx_trip_updates(spark, SF_SMALL).withColumn("entity_id", F.col("event_id").cast("string"))
    captures.land_captures(u.where(F.dayofmonth("captured_at") <= 15), landing)
    go = lambda: ingest.start_capture_ingest(spark, landing, f"{lake}/stream/rt_trip_updates", f"{lake}/cp").awaitTermination()
    go()
    refresh_bronze(spark, lake, landing, None)
    captures.land_captures(u.where(F.dayofmonth("captured_at") > 15), landing)
    go()
    assert spark.read.parquet(f"{lake}/stream/rt_trip_updates").count() == u.count()
    refresh_bronze(spark, lake, landing, None)
    assert versioned.read(spark, f"{lake}/bronze/rt_trip_updates").count() == u.count()
