"""The command line, end to end: land feeds and weather, refresh, proof, train, predict."""

import json

from pyspark.sql import functions as F

from latewatch import schemas
from latewatch.__main__ import main
from latewatch.plans import fixtures as fx
from latewatch.sources import captures, sinks
from conftest import SF_SMALL
from test_sources import SMOKE


def test_cli_end_to_end(spark, tmp_path, capsys):
    raw = tmp_path / "raw"
    (raw / "feeds").mkdir(parents=True)
    (raw / "feeds" / "capture_1.json").write_text(json.dumps(SMOKE))
    land = str(raw / "captures")
    assert main(["land-feed", "--feeds", str(raw / "feeds"), "--landing", land]) == 0
    assert captures.read_captures(spark, land).where(F.col("stop_id") == "2020").first().arrival_delay == 372.0
    vland = str(raw / "vehicles")
    assert main(["land-feed", "--feeds", str(raw / "feeds"), "--landing", vland, "--kind", "vehiclepos"]) == 0
    v = captures.read_captures(spark, vland, schemas.VEHICLE_POSITIONS)
    assert sorted(r.vehicle_id for r in v.collect()) == ["V1", "V2"]

    (raw / "weather").mkdir()
    payload = {"hourly": {"time": ["2024-01-02T08:00"], "precipitation": [0.4], "temperature_2m": [20.0]}}
    (raw / "weather" / "p.json").write_text(json.dumps(payload))
    assert main(["land-weather", "--payloads", str(raw / "weather"), "--out", str(raw / "weather.parquet")]) == 0
    assert sinks.read_table(spark, str(raw / "weather.parquet")).first().obs_hour == 8

    u = fx.fx_trip_updates(spark, SF_SMALL).withColumn("entity_id", F.lpad(F.col("event_id").cast("string"), 8, "0"))
    captures.land_captures(u, land)
    sched = raw / "schedule"
    for name, df in {"routes": fx.fx_routes(spark, SF_SMALL), "stops": fx.fx_stops(spark, SF_SMALL),
                     "stop_times": fx.fx_stop_times(spark, SF_SMALL)}.items():
        df.write.mode("overwrite").parquet(str(sched / f"{name}.parquet"))
    lake = str(tmp_path / "lake")
    assert main(["refresh", "--lake", lake, "--captures", land, "--weather", str(raw / "weather.parquet"),
                 "--schedule", str(sched), "--schedule-ext", "parquet"]) == 0
    # scheduled refresh: realtime + weather only, timetable kept from the full refresh
    assert main(["bronze", "--lake", lake, "--captures", land, "--weather", str(raw / "weather.parquet")]) == 0
    assert main(["silver", "--lake", lake]) == 0 and main(["gold", "--lake", lake]) == 0
    assert main(["proof", "--lake", lake]) == 0
    out = capsys.readouterr().out
    assert "network_kpi" in out and "top_stations" in out

    assert main(["train", "--lake", lake, "--max-iter", "100"]) == 0
    metrics = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert metrics["n_train"] + metrics["n_test"] == metrics["rows"]
    assert len(metrics["confusion_matrix"]) == 2
    preds = sinks.read_table(spark, f"{lake}/gold/delay_predictions")
    assert preds.count() == metrics["rows"] and len(preds.columns) == 9

    assert main(["predict", "--lake", lake, "--line", "T4", "--hour", "8", "--dow", "Thu", "--route-type", "2", "--rain"]) == 0
    assert "prob_late" in json.loads(capsys.readouterr().out.strip().splitlines()[-1])
