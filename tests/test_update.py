"""Updates that need no date: what changed is found in the tables' logs and equals a full rebuild."""

import pytest
from pyspark.sql import functions as F

from latewatch.operators import aggregates as A
from latewatch.plans import fixtures as fx
from latewatch.plans import pipeline as P
from latewatch.sources import captures, versioned, weather
from latewatch.streaming import ingest
from conftest import SF_SMALL


def rows(df):
    return sorted(repr(r) for r in df.select(sorted(df.columns)).collect())


class Raw:
    """Captures of a week, landed by days; a timetable and two weather files."""

    def __init__(self, spark, root):
        self.spark, self.landing, self.schedule = spark, f"{root}/landing", f"{root}/schedule"
        u = fx.fx_trip_updates(spark, SF_SMALL).withColumn("entity_id", F.lpad(F.col("event_id").cast("string"), 8, "0"))
        u = u.where(F.dayofmonth("captured_at") <= 7).coalesce(2).withColumn("captured_at", F.date_trunc("day", "captured_at") + F.expr("make_dt_interval(0, 7 * (hour(captured_at) div 8))"))
        u.write.parquet(f"{root}/updates")
        self.updates = spark.read.parquet(f"{root}/updates")
        for name in ("routes", "stops", "stop_times"):
            getattr(fx, f"fx_{name}")(spark, SF_SMALL).write.parquet(f"{self.schedule}/{name}.parquet")
        wx = fx.fx_weather(spark, SF_SMALL).withColumn("obs_time_local", F.format_string("%sT%02d:00", "obs_date", "obs_hour"))
        wx = wx.where(F.dayofmonth(F.to_date("obs_date")) <= 7).coalesce(1)
        self.weather, self.later = f"{root}/weather.parquet", f"{root}/later.parquet"
        wx.write.parquet(self.weather)
        # a later file: only two days, one of them corrected in its rainy hours
        some = wx.where(F.dayofmonth(F.to_date("obs_date")).isin(5, 6))
        some.withColumn("precip_mm", F.when(F.dayofmonth(F.to_date("obs_date")) == 5, F.col("precip_mm") + 1).otherwise(F.col("precip_mm"))).write.parquet(self.later)

    def land(self, first, last):
        captures.land_captures(self.updates.where(F.dayofmonth("captured_at").between(first, last)), self.landing)


@pytest.fixture
def raw(spark, tmp_path):
    return Raw(spark, str(tmp_path / "raw"))


def everything(spark, lake):
    return {"silver": rows(P.read_silver(spark, lake)), **{n: rows(P.read_gold(spark, lake, n)) for n in A.GOLD_TABLES}}


def full(spark, lake, raw, *weathers):
    """A lake built at once; the weather files in their order."""
    for w in weathers:
        P.refresh_bronze(spark, lake, raw.landing, w)
    P.refresh(spark, lake, raw.landing, weathers[-1], raw.schedule, schedule_ext="parquet")
    silver = P.read_silver(spark, lake)
    out = everything(spark, lake)
    assert all(out[n] == rows(fn(silver)) for n, fn in A.GOLD_TABLES.items())       # gold is silver's aggregates
    return out


def folders(spark, lake, layer, name):
    return versioned.latest(spark, f"{lake}/{layer}/{name}").folders


def test_update_equals_a_full_refresh(spark, tmp_path, raw):
    lake = str(tmp_path / "lake")
    raw.land(1, 4)
    assert P.update(spark, lake, raw.landing, raw.weather, raw.schedule, "parquet") == ["all"]
    before, states = folders(spark, lake, "silver", "stop_delays"), folders(spark, lake, "gold", "daily_states")
    assert P.update(spark, lake, raw.landing, raw.weather) == set()
    assert folders(spark, lake, "silver", "stop_delays") == before                   # nothing new, nothing written
    raw.land(4, 5)                                                                    # day 4 again: more files, equal rows
    # events of dates that did not change are not read again: their files may as well be broken
    for day, folder in before.items():
        if day <= "service_date=2024-01-03":
            for f in (tmp_path / "lake" / "silver" / "stop_delays" / folder / day).glob("*.parquet"):
                f.with_name(f"_{f.name}").write_bytes(f.read_bytes())
                f.write_bytes(b"broken")
                f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    touched = {str(d) for d in P.update(spark, lake, raw.landing, raw.weather)}
    assert touched and min(touched) >= "2024-01-04"
    for f in (tmp_path / "lake" / "silver").rglob("_part-*"):
        f.with_name(f.name[1:]).write_bytes(f.read_bytes())
    after = folders(spark, lake, "silver", "stop_delays")
    assert all(after[p] == before[p] for p in before if p.split("=")[1] not in touched)
    assert all(folders(spark, lake, "gold", "daily_states")[p] == states[p] for p in states if p.split("=")[1] not in touched)
    assert everything(spark, lake) == full(spark, str(tmp_path / "other"), raw, raw.weather)


def test_corrected_weather_and_a_removed_hour(spark, tmp_path, raw):
    lake = str(tmp_path / "lake")
    raw.land(1, 7)
    P.update(spark, lake, raw.landing, raw.weather, raw.schedule, "parquet")
    assert {str(d) for d in P.update(spark, lake, raw.landing, raw.later)} == {"2024-01-05"}
    assert everything(spark, lake) == full(spark, str(tmp_path / "a"), raw, raw.weather, raw.later)
    kept = versioned.read(spark, f"{lake}/bronze/weather")
    assert kept.count() == spark.read.parquet(raw.weather).count()                    # older hours stay
    hour = sorted((tmp_path / "raw" / "landing" / "dt=2024-01-02").iterdir())[0]
    for f in hour.iterdir():
        f.unlink()
    hour.rmdir()
    assert {str(d) for d in P.update(spark, lake, raw.landing)} <= {"2024-01-02", "2024-01-03"}
    assert everything(spark, lake) == full(spark, str(tmp_path / "b"), raw, raw.weather, raw.later)


def test_a_run_that_dies_at_any_commit_loses_nothing(spark, tmp_path, raw, monkeypatch):
    raw.land(1, 2)
    start = str(tmp_path / "start")
    P.update(spark, start, raw.landing, raw.weather, raw.schedule, "parquet")
    raw.land(3, 3)
    want = full(spark, str(tmp_path / "other"), raw, raw.weather)
    import shutil
    plain = versioned._put
    for at in (1, 2, 3, 5):          # bronze, silver, states, one of the gold tables
        lake, commits = str(tmp_path / f"lake{at}"), []
        shutil.copytree(start, lake)

        def dies(*a):
            commits.append(a[1])
            if len(commits) == at:
                raise RuntimeError("lost")
            plain(*a)
        with monkeypatch.context() as m:
            m.setattr(versioned, "_put", dies)
            with pytest.raises(RuntimeError, match="lost"):
                P.update(spark, lake, raw.landing, raw.weather)
        P.update(spark, lake, raw.landing, raw.weather)
        assert everything(spark, lake) == want, commits


def test_update_follows_the_stream(spark, tmp_path, raw):
    lake, state = str(tmp_path / "lake"), str(tmp_path / "state")
    assert P.update_from_stream(spark, lake, state) == set()                          # nothing streamed yet
    go = lambda: ingest.start_latest_state(spark, raw.landing, state, str(tmp_path / "cp")).awaitTermination()
    raw.land(1, 4)
    go()
    assert P.update_from_stream(spark, lake, state, raw.weather, raw.schedule, "parquet") == ["all"]
    raw.land(4, 6)
    go()
    touched = {str(d) for d in P.update_from_stream(spark, lake, state)}
    assert touched and min(touched) >= "2024-01-04" and P.update_from_stream(spark, lake, state) == set()
    assert everything(spark, lake) == full(spark, str(tmp_path / "other"), raw, raw.weather)
    plan = versioned.read(spark, state)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1                                                # a state of many folders is one scan


def test_weather_history(spark, tmp_path):
    p = str(tmp_path / "w")
    day = lambda d, mm: [(f"2024-01-{d:02d}T{h:02d}:00", mm, None, 20.0) for h in (7, 8)]
    frame = lambda data: spark.createDataFrame(data, "obs_time_local string, precip_mm double, rain_mm double, temp_c double")
    assert weather.upsert_weather(spark, frame(day(1, 0.1) + day(2, 0.2)), p).number == 1
    assert weather.upsert_weather(spark, frame(day(2, 0.2)), p).number == 1           # nothing differs
    v = weather.upsert_weather(spark, frame(day(2, 0.5) + day(9, 0.9)), p)
    assert v.meta["dates"] == {"2024-01-01": 1, "2024-01-02": 2, "2024-01-09": 2}
    got = {(r.obs_date, r.obs_hour): r.precip_mm for r in versioned.read(spark, p).collect()}
    assert got == {(f"2024-01-{d:02d}", h): mm for d, mm in ((1, 0.1), (2, 0.5), (9, 0.9)) for h in (7, 8)}
    again = frame(day(9, 0.9) * 2)                                                    # a repeated local hour (clock change)
    assert weather.upsert_weather(spark, again, p).number == 3 and versioned.read(spark, p).count() == 8
