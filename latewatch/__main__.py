"""Command line: ``python -m latewatch <command> ...`` (one Spark application per call).

Commands mirror the stages of the original application:

    land-feed     flatten saved GTFS-RT feed captures (proto3-JSON files) and append them to
                  the landing folder (``--kind tripupdate|vehiclepos``)
    land-weather  turn saved hourly weather payloads (JSON files) into the weather table
    bronze        land bronze tables (timetable only with --schedule)
    silver        build and replace silver.stop_delays
    gold          build and replace the six gold tables
    refresh       bronze -> silver -> gold
    update        the same for what has changed since the last run; needs no date.  With --stream
                  silver follows the state that ``stream`` maintains
    proof         print the silver/gold proof queries and top-k reports
    train         fit, evaluate, save the model and write gold/delay_predictions
    predict       score one scenario with the saved model
    stream        incremental ingest and newest-capture state (available-now trigger)
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from . import params, schemas
from .operators import aggregates as A
from .operators import ranking as R
from .plans import pipeline, training
from .session import get_session
from .sources import captures, feed, sinks, weather


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="latewatch", description=__doc__.split("\n")[0])
    p.add_argument("--master", default=None, help="Spark master for local runs (cluster: spark-submit)")
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("land-feed")
    s.add_argument("--feeds", required=True, help="folder or glob of feed JSON files (one message each)")
    s.add_argument("--landing", required=True)
    s.add_argument("--kind", choices=["tripupdate", "vehiclepos"], default="tripupdate")

    s = sub.add_parser("land-weather")
    s.add_argument("--payloads", required=True)
    s.add_argument("--out", required=True)

    for name in ("bronze", "refresh", "update"):
        s = sub.add_parser(name)
        s.add_argument("--lake", required=True)
        s.add_argument("--captures", required=name != "update")
        s.add_argument("--vehicles", default=None, help="landing folder of vehicle positions")
        s.add_argument("--weather", default=None)
        s.add_argument("--schedule", default=None, help="timetable folder (full refresh only)")
        s.add_argument("--schedule-ext", default="txt")
        s.add_argument("--tolerant", action="store_true", help="captures with per-file type drift (S2)")
        if name == "update":
            s.add_argument("--stream", action="store_true", help="follow the streamed state instead of --captures")
        if name == "refresh":
            s.add_argument("--since", default=None, help="rebuild silver for service dates >= YYYY-MM-DD only")
    for name in ("silver", "gold", "proof", "train"):
        s = sub.add_parser(name)
        s.add_argument("--lake", required=True)
        if name == "silver":
            s.add_argument("--since", default=None, help="rebuild service dates >= YYYY-MM-DD only")
        if name == "train":
            s.add_argument("--max-iter", type=int, default=params.MAX_ITER)

    s = sub.add_parser("predict")
    s.add_argument("--lake", required=True)
    s.add_argument("--line", required=True)
    s.add_argument("--hour", type=int, required=True)
    s.add_argument("--dow", required=True)
    s.add_argument("--route-type", type=int, required=True)
    s.add_argument("--rain", action="store_true")

    s = sub.add_parser("stream")
    s.add_argument("--landing", required=True)
    s.add_argument("--lake", required=True)
    s.add_argument("--checkpoint", default=None, help="default: <spark.checkpoint.dir>/latewatch-stream")
    return p


def _show(title: str, df) -> None:
    print(f"\n{title}")
    for r in df.collect():                                   # proof outputs are a handful of rows
        print("  " + " | ".join("" if v is None else str(v) for v in r))


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = get_session(a.master)
    if a.cmd == "land-feed":
        feeds = feed.read_feed_json(spark, a.feeds)
        if a.kind == "tripupdate":
            captures.land_captures(feed.flatten_trip_updates(feeds), a.landing)
        else:
            captures.land_captures(feed.flatten_vehicle_positions(feeds), a.landing, schemas.VEHICLE_POSITIONS)
    elif a.cmd == "land-weather":
        payloads = spark.read.format("text").option("wholetext", "true").load(a.payloads)
        sinks.replace_table(weather.weather_rows(payloads.withColumnRenamed("value", "payload")), path=a.out)
    elif a.cmd == "bronze":
        out = pipeline.refresh_bronze(spark, a.lake, a.captures, a.weather, a.schedule, a.schedule_ext,
                                      vehicles_root=a.vehicles, tolerant=a.tolerant)
        counts = sinks.table_counts({t: sinks.read_table(spark, p) for t, p in out.items()})
        _show("bronze tables", counts)
    elif a.cmd == "silver":
        print("built", pipeline.refresh_silver(spark, a.lake, since=a.since))
    elif a.cmd == "gold":
        print("built", ", ".join(pipeline.refresh_gold(spark, a.lake)))
    elif a.cmd == "refresh":
        out = pipeline.refresh(spark, a.lake, a.captures, a.weather, a.schedule, a.schedule_ext,
                               tolerant=a.tolerant, since=a.since, vehicles_root=a.vehicles)
        print("built", ", ".join(out))
    elif a.cmd == "update":
        if a.stream:
            out = pipeline.update_from_stream(spark, a.lake, training.lake_path(a.lake, "state", "latest"), a.weather, a.schedule, a.schedule_ext)
        elif a.captures:
            out = pipeline.update(spark, a.lake, a.captures, a.weather, a.schedule, a.schedule_ext, tolerant=a.tolerant, vehicles_root=a.vehicles)
        else:
            raise SystemExit("update needs --captures or --stream")
        print("service dates:", ", ".join(sorted(map(str, out))) or "none")
    elif a.cmd == "proof":
        silver = pipeline.read_silver(spark, a.lake)
        g = lambda n: pipeline.read_gold(spark, a.lake, n)
        for name, df in {
                "silver_overview": A.silver_overview(silver), "suburban_summary": A.suburban_summary(silver),
                "worst_lines": A.worst_lines(silver), "weather_overview": A.weather_overview(silver),
                "network_kpi": g("network_kpi"), "top_lines": R.top_lines(g("line_punctuality")),
                "top_hours": R.top_hours(g("hourly_punctuality")), "top_stations": R.top_stations(g("stop_punctuality")),
                "weather_delay": R.weather_split(g("weather_delay"))}.items():
            _show(f"{name}: {', '.join(df.columns)}", df)
    elif a.cmd == "train":
        m = training.train_and_score(spark, a.lake, a.max_iter)
        print(json.dumps(m, default=str))
    elif a.cmd == "predict":
        row = spark.createDataFrame([(a.line, a.dow, a.hour, a.route_type, a.rain)],
                                    "line_code string, day_of_week string, sched_hour int, "
                                    "route_type int, rain boolean")
        r = training.predict_scenarios(spark, a.lake, row).first()
        print(json.dumps(r.asDict()))
    elif a.cmd == "stream":
        from .session import checkpoint_root
        from .streaming import ingest
        cp = a.checkpoint or f"{checkpoint_root(spark)}/latewatch-stream"
        q1 = ingest.start_capture_ingest(spark, a.landing, training.lake_path(a.lake, "stream", "rt_trip_updates"),
                                         f"{cp}/ingest")
        q1.awaitTermination()
        q2 = ingest.start_latest_state(spark, a.landing, training.lake_path(a.lake, "state", "latest"),
                                       f"{cp}/latest")
        q2.awaitTermination()
        print("stream caught up; state rows:",
              ingest.read_latest_state(spark, training.lake_path(a.lake, "state", "latest"))
              .agg(F.count(F.lit(1))).first()[0])
    return 0


if __name__ == "__main__":
    sys.exit(main())
