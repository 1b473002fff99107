"""Sources and sinks: feed flatteners, weather payloads, timetable CSV, landing, drift reader."""

import json
from datetime import datetime

import pandas as pd
from pyspark.sql import functions as F

from latewatch import schemas
from latewatch.sources import captures, feed, schedule, sinks, weather

SMOKE = {  # the original smoke message: one late T1 trip with three stops
    "header": {"gtfsRealtimeVersion": "2.0", "timestamp": "1718700000"},
    "entity": [
        {"id": "synthetic-1", "tripUpdate": {"trip": {"tripId": "T1.SYNTH.0700", "routeId": "T1"},
         "stopTimeUpdate": [
             {"stopSequence": 1, "stopId": "2000", "arrival": {"delay": 0}, "departure": {"delay": 0}},
             {"stopSequence": 2, "stopId": "2010", "arrival": {"delay": 120}, "departure": {"delay": 120}},
             {"stopSequence": 3, "stopId": "2020", "arrival": {"delay": 372}, "departure": {"delay": 372}}]}},
        {"id": "empty", "tripUpdate": {"trip": {"tripId": "T2.X", "routeId": "", "directionId": 0},
                                       "vehicle": {"id": ""}, "timestamp": "0"}},
        {"id": "skipped", "tripUpdate": {"trip": {"tripId": "T3.X", "scheduleRelationship": "ADDED"},
         "stopTimeUpdate": [{"stopId": "3000", "scheduleRelationship": "SKIPPED"}]}},
        {"id": "bus-1", "vehicle": {"trip": {"tripId": "T1.SYNTH.0700"}, "vehicle": {"id": "V1"},
                                    "position": {"latitude": -33.86, "longitude": 151.2, "speed": 12.5},
                                    "timestamp": "1718700001"}},
        {"id": "bus-2", "vehicle": {"vehicle": {"id": "V2"}}},
    ]}


def _feeds(spark):
    return spark.createDataFrame([(json.dumps(SMOKE), datetime(2024, 6, 18, 3, 0))],
                                 "feed string, captured_at timestamp")


def test_flatten_trip_updates(spark):
    rows = feed.flatten_trip_updates(_feeds(spark)).collect()
    assert len(rows) == 5
    by = {(r.entity_id, r.stop_id): r for r in rows}
    assert by[("synthetic-1", "2020")].arrival_delay == 372.0
    assert by[("synthetic-1", "2020")].stu_schedule_relationship == 0
    e = by[("empty", None)]                       # empty stop list -> one row, NULL stop fields
    assert e.stu_schedule_relationship is None and e.stop_sequence is None
    assert e.route_id is None and e.vehicle_id is None and e.trip_update_ts is None
    assert e.direction_id == 0                    # explicit presence keeps 0
    s = by[("skipped", "3000")]
    assert s.stu_schedule_relationship == 1 and s.trip_schedule_relationship == 1
    assert s.arrival_delay is None and s.stop_sequence is None
    assert all(r.feed_ts == 1718700000 for r in rows)
    assert set(r.name for r in schemas.TRIP_UPDATES.fields) == set(rows[0].asDict())


def test_flatten_vehicle_positions(spark):
    rows = {r.entity_id: r for r in feed.flatten_vehicle_positions(_feeds(spark)).collect()}
    assert set(rows) == {"bus-1", "bus-2"}
    assert rows["bus-1"].lat == -33.86 and rows["bus-1"].bearing is None and rows["bus-1"].speed == 12.5
    assert rows["bus-2"].lat is None and rows["bus-2"].vehicle_ts is None


def test_weather_rows_with_and_without_rain(spark):
    p1 = {"hourly": {"time": ["2024-01-02T00:00", "2024-01-02T01:00"], "precipitation": [0.0, 0.4],
                     "temperature_2m": [20.1, 19.5]}}
    p2 = {"hourly": {"time": ["2024-01-03T05:00"], "precipitation": [0.2], "temperature_2m": [18.0],
                     "rain": [0.1]}}
    df = spark.createDataFrame([(json.dumps(p1),), (json.dumps(p2),)], "payload string")
    rows = sorted(weather.weather_rows(df).collect(), key=lambda r: r.obs_time_local)
    assert [(r.obs_date, r.obs_hour, r.precip_mm, r.rain_mm) for r in rows] == [
        ("2024-01-02", 0, 0.0, None), ("2024-01-02", 1, 0.4, None), ("2024-01-03", 5, 0.2, 0.1)]


def test_schedule_csv(spark, tmp_path):
    d = tmp_path / "gtfs"
    d.mkdir()
    (d / "stops.txt").write_text('﻿stop_id,stop_name,platform\n1,"Central, Platform 1",\n2,NA,"3"\n',
                                 encoding="utf-8")
    (d / "stop_times.txt").write_text("trip_id,stop_id,arrival_time\nt1,1,25:30:00\n", encoding="utf-8")
    got = schedule.read_schedule(spark, str(d))
    assert set(got) == {"stops", "stop_times"}                # missing tables skipped
    rows = got["stops"].orderBy("stop_id").collect()
    assert got["stops"].columns == ["stop_id", "stop_name", "platform"]
    assert rows[0].stop_name == "Central, Platform 1" and rows[0].platform is None
    assert rows[1].stop_name == "NA"                          # text NA stays text
    assert got["stop_times"].first().arrival_time == "25:30:00"
    assert all(str(f.dataType) == "StringType()" for f in got["stops"].schema.fields)


def test_landing_and_scan_roundtrip(spark, tmp_path):
    root = str(tmp_path / "landing")
    rows = [("e1", "t1", datetime(2024, 1, 1, 13, 59), 30.0), ("e2", "t2", datetime(2024, 1, 1, 14, 0), None)]
    df = spark.createDataFrame(rows, "entity_id string, trip_id string, captured_at timestamp, arrival_delay double")
    captures.land_captures(df, root)
    captures.land_captures(df.limit(1), root)                # append-only
    back = captures.read_captures(spark, root)
    assert back.count() == 3
    parts = sorted((str(r.dt), r.hour) for r in back.select("dt", "hour").distinct().collect())
    assert parts == [("2024-01-01", 13), ("2024-01-01", 14)]
    assert back.where(F.col("hour") == 14).count() == 1      # partition pruning path


def test_drift_tolerant_reader(spark, tmp_path):
    root = tmp_path / "pandas"
    (root / "dt=2024-01-01" / "hour=13").mkdir(parents=True)
    (root / "dt=2024-01-01" / "hour=14").mkdir(parents=True)
    a = pd.DataFrame({"entity_id": ["e1", "e2"], "trip_id": ["t1", "t2"], "start_date": [None, None],
                      "arrival_delay": [60, 400],
                      "captured_at": [pd.Timestamp("2024-01-01 13:59:00.123456789", tz="UTC")] * 2})
    b = pd.DataFrame({"entity_id": ["e3"], "trip_id": ["t3"], "start_date": ["20240101"],
                      "arrival_delay": [None], "departure_delay": [12.5],
                      "captured_at": [pd.Timestamp("2024-01-01 14:00:00", tz="UTC")]})
    a.to_parquet(root / "dt=2024-01-01" / "hour=13" / "a.parquet", index=False)
    b.to_parquet(root / "dt=2024-01-01" / "hour=14" / "b.parquet", index=False)
    df = captures.read_captures_tolerant(spark, str(root))
    assert df.schema["arrival_delay"].dataType.typeName() == "double"
    rows = {r.entity_id: r for r in df.collect()}
    assert rows["e1"].arrival_delay == 60.0 and rows["e3"].arrival_delay is None
    assert rows["e3"].departure_delay == 12.5 and rows["e3"].start_date == "20240101"
    assert rows["e1"].captured_at == datetime(2024, 1, 1, 13, 59, 0, 123456)
    assert rows["e3"].hour == 14 and str(rows["e3"].dt) == "2024-01-01"


def test_table_counts_and_replace(spark, tmp_path):
    a = spark.range(5)
    b = spark.range(2)
    rows = sinks.table_counts({"b": b, "a": a}).collect()
    assert [(r.tbl, r.n) for r in rows] == [("a", 5), ("b", 2)]
    p = str(tmp_path / "t")
    sinks.replace_table(a, path=p)
    sinks.replace_table(b, path=p)
    assert sinks.read_table(spark, p).count() == 2


def _fails(df, *words):
    import pytest
    with pytest.raises(Exception) as e:
        df.collect()
    assert all(w in str(e.value) for w in words), str(e.value)[:500]


def test_broken_input_fails_the_job(spark):
    cut = spark.createDataFrame([(json.dumps(SMOKE)[:-40], datetime(2024, 6, 18, 3, 0))], "feed string, captured_at timestamp")
    _fails(feed.flatten_trip_updates(cut), "MALFORMED_RECORD_IN_PARSING")
    _fails(feed.flatten_vehicle_positions(cut), "MALFORMED_RECORD_IN_PARSING")
    _fails(weather.weather_rows(spark.createDataFrame([('{"hourly": {"time": ["2024-01-0',)], "payload string")), "MALFORMED_RECORD_IN_PARSING")
    odd = json.loads(json.dumps(SMOKE))
    odd["entity"][0]["tripUpdate"]["stopTimeUpdate"][0]["scheduleRelationship"] = "NEW_KIND"
    _fails(feed.flatten_trip_updates(spark.createDataFrame([(json.dumps(odd), datetime(2024, 6, 18))], "feed string, captured_at timestamp")), "NEW_KIND")


def test_only_a_missing_path_counts_as_absent(spark, tmp_path):
    import pytest
    assert schedule.read_schedule_table(spark, str(tmp_path / "none.parquet")) is None
    assert weather.read_weather(spark, str(tmp_path / "none.parquet")) is None
    (tmp_path / "empty.parquet").mkdir()
    for read in (schedule.read_schedule_table, weather.read_weather):
        with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA|infer"):
            read(spark, str(tmp_path / "empty.parquet"))


def test_capture_time_is_not_the_files_date(spark, tmp_path):
    import os
    import shutil
    a, b = tmp_path / "a", tmp_path / "b"
    a.mkdir(), b.mkdir()
    (a / "feed_1718600000.json").write_text(json.dumps(SMOKE))
    (a / "plain.json").write_text(json.dumps(SMOKE))
    shutil.copytree(a, b, dirs_exist_ok=True)
    for f in b.iterdir():
        os.utime(f, (1, 1))
    times = [sorted(r[0] for r in feed.read_feed_json(spark, str(x)).selectExpr("unix_timestamp(captured_at)").collect()) for x in (a, b)]
    assert times[0] == times[1] == [1718600000, 1718700000]
    (b / "none.json").write_text("{}")
    _fails(feed.read_feed_json(spark, str(b)), "no capture time")


def test_a_failed_replace_keeps_the_old_table(spark, tmp_path):
    p = str(tmp_path / "t")
    sinks.replace_table(spark.range(5), path=p)
    import pytest
    with pytest.raises(Exception):
        sinks.replace_table(spark.range(5).select(F.raise_error(F.lit("stop")).alias("x")), path=p)
    assert sinks.read_table(spark, p).count() == 5
    sinks.replace_table(spark.range(7), path=p)
    assert sinks.read_table(spark, p).count() == 7
