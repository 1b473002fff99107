"""The medallion refresh — bronze -> silver -> gold, each an idempotent commit.

:func:`refresh` builds everything anew, or silver's service dates since a given one.
:func:`update` and :func:`update_from_stream` need no date: every table is a versioned table
(:mod:`latewatch.sources.versioned`) whose log tells which partitions changed since a
version, and whoever reads one commits the version it has read together with its own rows.

    landing hours whose files changed -> bronze hours -> service dates -> silver's dates
    weather hours that differ         -> their dates  ->
    (or the dates that the streamed state wrote)

    silver's changed dates -> their partial states -> the gold tables, merged from all states

A job that dies anywhere leaves every table at its last commit with the position that
belongs to it, and the next run carries on from there.  A timetable that was landed
anew makes silver anew.  Gold reads states of days (:mod:`latewatch.operators.states`), never the
history of events; the events of a changed date are read once.

The weather table is a history: hours of a new file replace theirs, older ones stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params, schemas
from ..functions import columns as C
from ..operators import states as S
from ..operators.enrich import SILVER_COLUMNS, build_silver, enrich_events
from ..sources import captures, schedule, versioned, weather

HOURS = ("dt", "hour")
TIMETABLE = ("gtfs_routes", "gtfs_stops", "gtfs_stop_times")


def _path(out_root: str, layer: str, name: str) -> str:
    return f"{out_root.rstrip('/')}/{layer}/{name}"


# bronze -----------------------------------------------------------------------------------
def refresh_bronze(spark: SparkSession, out_root: str, captures_root: str | None, weather_path: str | None,
                   schedule_dir: str | None = None, schedule_ext: str = "txt",
                   vehicles_root: str | None = None, tolerant: bool = False,
                   since: str | date | None = None, changed_only: bool = False) -> dict[str, str]:
    """Land the bronze tables; returns table name -> path.

    ``tolerant=True`` reads captures written by other tools with per-file type
    drift (S2) instead of the fixed-schema scan (S1).  ``since`` replaces only the
    hours of UTC folders ``dt >= since - 1 day`` of a table that is there, ``changed_only``
    those whose files are not the ones that were read last; hours without captures are dropped
    and the others stay as they are.
    """
    out = {}
    for name, root, schema in (("rt_trip_updates", captures_root, schemas.TRIP_UPDATES), ("rt_vehicle_positions", vehicles_root, schemas.VEHICLE_POSITIONS)):
        if root:
            out[name] = p = _path(out_root, "bronze", name)
            _land_hours(spark, p, root, schema, tolerant, since, changed_only)
    if weather_path and (w := weather.read_weather(spark, weather_path)) is not None:
        out["weather"] = _path(out_root, "bronze", "weather")
        weather.upsert_weather(spark, w, out["weather"])
    if schedule_dir:
        for t, df in schedule.read_schedule(spark, schedule_dir, ext=schedule_ext).items():
            out[f"gtfs_{t}"] = _path(out_root, "bronze", f"gtfs_{t}")
            versioned.write(df, out[f"gtfs_{t}"])
    return out


def _hour_name(hour: tuple) -> str:
    return "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if x is None else x}" for c, x in zip(HOURS, hour, strict=True))


def _land_hours(spark: SparkSession, path: str, root: str, schema, tolerant: bool, since: str | date | None, changed_only: bool) -> None:
    scan = captures.read_captures_tolerant if tolerant else captures.read_captures
    landed = {_hour_name(h): state for h, state in captures.landed_hours(spark, root).items()}
    old = versioned.latest(spark, path)
    if old is None or (since is None and not changed_only):
        versioned.write(scan(spark, root, schema), path, HOURS, meta={"landed": landed})
        return
    seen = old.meta.get("landed", {})
    if since is not None:
        first = str(date.fromisoformat(str(since)) - timedelta(days=1))
        hours = {h for h in {*landed, *old.folders} if (versioned.values(h)["dt"] or "") >= first}
    else:
        hours = {h for h in {*landed, *seen, *old.folders} if landed.get(h) != seen.get(h)}
    if not hours:
        return
    meta = {"landed": {**{h: s for h, s in seen.items() if h not in hours}, **{h: s for h, s in landed.items() if h in hours}}}
    versioned.write(scan(spark, root, schema, _in_hours(hours)), path, HOURS, scope=lambda x: _hour_name((x["dt"], x["hour"])) in hours,
                    meta=meta, base=old)


def _in_hours(hours: Iterable[str]) -> Column:
    """The rows of some hour folders, as a filter that prunes folders."""
    by_day: dict[str | None, list] = {}
    for h in hours:
        v = versioned.values(h)
        by_day.setdefault(v["dt"], []).append(v["hour"])
    one = lambda c, x, kind: F.col(c).isNull() if x is None else F.col(c) == F.lit(x).cast(kind)
    parts = [one("dt", d, "date") & reduce(Column.__or__, [one("hour", h, "int") for h in some]) for d, some in by_day.items()]
    return reduce(Column.__or__, parts)


# silver -----------------------------------------------------------------------------------
def _table(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    return versioned.read(spark, _path(out_root, "bronze", name))


def _dimensions(spark: SparkSession, out_root: str) -> list[DataFrame]:
    return [_table(spark, out_root, n) for n in (*TIMETABLE, "weather")]


def _number(spark: SparkSession, path: str) -> int:
    found = versioned.latest(spark, path)
    return found.number if found else 0


def _positions(spark: SparkSession, out_root: str, **source: int) -> dict:
    """What silver is made from: the source's version, the weather's, the timetable's."""
    return {**source, "weather": _number(spark, _path(out_root, "bronze", "weather")),
            "timetable": {t: _number(spark, _path(out_root, "bronze", t)) for t in TIMETABLE}}


def _dates_of_hours(spark: SparkSession, hours: Iterable[str], zone: str) -> set[date] | None:
    """Service dates that captures of those UTC hours may have; ``None``: any."""
    starts = []
    for h in hours:
        v = versioned.values(h)
        if v["dt"] is None or v["hour"] is None:
            return None
        start = datetime.combine(date.fromisoformat(v["dt"]), datetime.min.time()) + timedelta(hours=int(v["hour"]))
        starts += [(start,), (start + timedelta(hours=1, microseconds=-1),)]
    if not starts:
        return set()
    at = spark.createDataFrame(starts, "at timestamp_ntz")
    return {r[0] for r in at.select(C.service_date("at", zone)).distinct().collect()}


def _stale_dates(spark: SparkSession, silver: versioned.Version | None, now: dict, source: str, changed: Callable[[int], set[date] | None],
                 weather_path: str) -> set[date] | None:
    """Service dates whose rows may differ from what silver was made from; ``None``: all of them."""
    if silver is None or source not in silver.meta or silver.meta["timetable"] != now["timetable"]:
        return None
    dates = changed(silver.meta[source])
    if dates is None:
        return None
    wx = versioned.latest(spark, weather_path)
    return dates | {date.fromisoformat(d) for d, n in (wx.meta.get("dates", {}) if wx else {}).items() if d and n > silver.meta["weather"]}


def _is_date(dates: Iterable[date]) -> Column:
    return F.col("service_date").isin([F.lit(d) for d in sorted(dates)])


def refresh_silver(spark: SparkSession, out_root: str, tie_breakers: Sequence[str] = ("entity_id",),
                   since: str | date | None = None) -> str:
    """Build silver from the bronze tables and replace it (partitioned by service_date).

    ``since`` rebuilds only service dates on or after it: captures are read from
    UTC folders ``dt >= since - 1 day`` (a service day starts the previous UTC
    day in the service zone) and exactly those ``service_date`` partitions are
    replaced, in one commit: dates that no longer have rows go.  W1 never crosses
    service dates, so the rows equal a full rebuild.
    """
    p = _path(out_root, "silver", "stop_delays")
    now = _positions(spark, out_root, bronze=_number(spark, _path(out_root, "bronze", "rt_trip_updates")))
    updates, old = _table(spark, out_root, "rt_trip_updates"), versioned.latest(spark, p)
    if since is None or old is None:
        versioned.write(build_silver(updates, *_dimensions(spark, out_root), tie_breakers=tie_breakers), p, ("service_date",), meta=now)
        return p
    first = F.lit(str(since)).cast("date")
    silver = build_silver(updates.where(F.col("dt") >= F.date_sub(first, 1)), *_dimensions(spark, out_root), tie_breakers=tie_breakers)
    # older dates are as they were: so is the position
    versioned.write(silver.where(F.col("service_date") >= first), p, ("service_date",), scope=lambda x: (x["service_date"] or "") >= str(since),
                    meta=old.meta, base=old)
    return p


def update_silver(spark: SparkSession, out_root: str, tie_breakers: Sequence[str] = ("entity_id",), zone: str = params.SERVICE_ZONE) -> set[date] | None:
    """Rebuilds the service dates that bronze's new versions touch; returns them (``None``: all)."""
    p, source = _path(out_root, "silver", "stop_delays"), _path(out_root, "bronze", "rt_trip_updates")
    old, bronze = versioned.latest(spark, p), versioned.latest(spark, source)
    now = _positions(spark, out_root, bronze=bronze.number)
    dates = _stale_dates(spark, old, now, "bronze", lambda n: _dates_of_hours(spark, versioned.changed(bronze, n), zone), _path(out_root, "bronze", "weather"))
    if dates is None:
        refresh_silver(spark, out_root, tie_breakers)
        return None
    if dates:
        near = sorted({d + timedelta(days=i) for d in dates for i in (-1, 0, 1)})       # UTC folders around a service day
        updates = versioned.read(spark, source, bronze).where(F.col("dt").isin([F.lit(d) for d in near]))
        silver = build_silver(updates, *_dimensions(spark, out_root), zone=zone, tie_breakers=tie_breakers)
        _replace_dates(silver, p, dates, now, old)
    return dates


def _replace_dates(silver: DataFrame, path: str, dates: set[date], meta: dict, old: versioned.Version) -> None:
    names = {str(d) for d in dates}
    versioned.write(silver.where(_is_date(dates)), path, ("service_date",), scope=lambda x: x["service_date"] in names, meta=meta, base=old)


def update_silver_from_stream(spark: SparkSession, out_root: str, state_root: str) -> set[date] | None:
    """Enriches the service dates that the streamed state (ST2) has written since; returns them (``None``: all)."""
    p = _path(out_root, "silver", "stop_delays")
    old, state = versioned.latest(spark, p), versioned.latest(spark, state_root)
    if state is None:
        return set()
    now = _positions(spark, out_root, stream=state.number)

    def changed(n: int) -> set[date] | None:
        found = [versioned.values(x)["service_date"] for x in versioned.changed(state, n)]
        return None if None in found else {date.fromisoformat(d) for d in found}
    dates = _stale_dates(spark, old, now, "stream", changed, _path(out_root, "bronze", "weather"))
    if dates == set():
        return dates
    events = versioned.read(spark, state_root, state)
    if dates is None:
        versioned.write(enrich_events(events, *_dimensions(spark, out_root)), p, ("service_date",), meta=now)
    else:
        _replace_dates(enrich_events(events.where(_is_date(dates)), *_dimensions(spark, out_root)), p, dates, now, old)
    return dates


def read_silver(spark: SparkSession, out_root: str) -> DataFrame:
    """The silver table in its contract column order."""
    return versioned.read(spark, _path(out_root, "silver", "stop_delays")).select(*SILVER_COLUMNS)


# gold -------------------------------------------------------------------------------------
def refresh_gold(spark: SparkSession, out_root: str) -> dict[str, str]:
    """The six gold tables, merged from daily states; only dates that silver changed since get new states."""
    source, p = _path(out_root, "silver", "stop_delays"), _path(out_root, "gold", "daily_states")
    silver, old = versioned.latest(spark, source), versioned.latest(spark, p)
    names = {versioned.values(x)["service_date"] for x in versioned.changed(silver, old.meta["silver"] if old else 0)}
    position = {"silver": silver.number}
    if old is None or None in names:
        old = versioned.write(S.daily_states(versioned.read(spark, source, silver)), p, ("service_date",), meta=position)
    elif names:
        events = versioned.read(spark, source, silver).where(_is_date({date.fromisoformat(d) for d in names}))
        old = versioned.write(S.daily_states(events), p, ("service_date",), scope=lambda x: x["service_date"] in names, meta=position, base=old)
    states, out = versioned.read(spark, p, old), {}
    for name, fn in S.GOLD_TABLES.items():
        out[name] = _path(out_root, "gold", name)
        table = versioned.latest(spark, out[name])
        if table is None or table.meta.get("states") != old.number:
            versioned.write(fn(states), out[name], meta={"states": old.number})
    return out


def read_gold(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    return versioned.read(spark, _path(out_root, "gold", name))


# whole runs -------------------------------------------------------------------------------
def refresh(spark: SparkSession, out_root: str, captures_root: str, weather_path: str | None,
            schedule_dir: str | None = None, schedule_ext: str = "txt",
            tie_breakers: Sequence[str] = ("entity_id",), tolerant: bool = False,
            since: str | date | None = None, vehicles_root: str | None = None) -> dict[str, str]:
    """bronze -> silver -> gold in order; returns every written table's path."""
    out = refresh_bronze(spark, out_root, captures_root, weather_path, schedule_dir, schedule_ext,
                         vehicles_root=vehicles_root, tolerant=tolerant, since=since)
    out["stop_delays"] = refresh_silver(spark, out_root, tie_breakers, since)
    out.update(refresh_gold(spark, out_root))
    return out


def update(spark: SparkSession, out_root: str, captures_root: str, weather_path: str | None = None,
           schedule_dir: str | None = None, schedule_ext: str = "txt", tie_breakers: Sequence[str] = ("entity_id",),
           tolerant: bool = False, vehicles_root: str | None = None) -> set[date] | list[str]:
    """Brings the lake up to what is landed, without being told a date; returns the service dates rebuilt.

    Equal to :func:`refresh` over the same inputs.  The first run builds everything.
    """
    refresh_bronze(spark, out_root, captures_root, weather_path, schedule_dir, schedule_ext,
                   vehicles_root=vehicles_root, tolerant=tolerant, changed_only=True)
    dates = update_silver(spark, out_root, tie_breakers)
    refresh_gold(spark, out_root)
    return ["all"] if dates is None else dates


def update_from_stream(spark: SparkSession, out_root: str, state_root: str, weather_path: str | None = None,
                       schedule_dir: str | None = None, schedule_ext: str = "txt") -> set[date] | list[str]:
    """Brings silver and gold up to the streamed state; returns the service dates rebuilt."""
    if weather_path or schedule_dir:
        refresh_bronze(spark, out_root, None, weather_path, schedule_dir, schedule_ext)
    dates = update_silver_from_stream(spark, out_root, state_root)
    if dates != set() or versioned.latest(spark, _path(out_root, "silver", "stop_delays")):
        refresh_gold(spark, out_root)
    return ["all"] if dates is None else dates
