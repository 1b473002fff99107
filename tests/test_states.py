"""The gold tables from daily states equal the aggregates over the events."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from latewatch.operators import aggregates as A
from latewatch.operators import states as S
from latewatch.plans.catalog_base import fixture_silver
from conftest import SF_CHECK


def rows(df):
    return sorted((repr(r) for r in df.select(sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    p = str(tmp_path_factory.mktemp("silver") / "s")
    fixture_silver(spark, SF_CHECK).write.parquet(p)
    return spark.read.parquet(p)


@pytest.mark.parametrize("name", sorted(A.GOLD_TABLES))
def test_merged_states_equal_the_aggregates(silver, name):
    got, want = S.GOLD_TABLES[name](S.daily_states(silver)), A.GOLD_TABLES[name](silver)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert rows(got) == rows(want) != []


@pytest.mark.parametrize("name", sorted(A.GOLD_TABLES))
def test_any_split_into_days_and_jobs_merges_alike(silver, name):
    """States computed by several jobs, written in any order, and only some days of them."""
    first = F.dayofmonth("service_date") % 3 == 0
    both = S.daily_states(silver.where(first)).unionByName(S.daily_states(silver.where(~first)))
    assert rows(S.GOLD_TABLES[name](both)) == rows(A.GOLD_TABLES[name](silver))
    some = F.dayofmonth("service_date").between(5, 9)
    assert rows(S.GOLD_TABLES[name](both.where(some))) == rows(A.GOLD_TABLES[name](silver.where(some)))


def test_nulls_in_every_column(spark, silver):
    """NULL keys are values of their own, never the NULL of a set that leaves the column out."""
    d, t = date(2024, 1, 1), datetime(2024, 1, 1, 5)
    full = dict(zip(silver.columns, (d, "Mon", "t1", "r", "T1", "North", 2, True, "s1", "Central", "08:00:00", 8, 60, 1.0, False, True, t, 0.4, 20.0, True), strict=True))
    data = [full] + [{**full, c: None} for c in silver.columns if c != "service_date"] + [{**full, "is_suburban": False}] * 2
    odd = spark.createDataFrame([tuple(x[c] for c in silver.columns) for x in data * 3], silver.schema)
    for name in A.GOLD_TABLES:
        assert rows(S.GOLD_TABLES[name](S.daily_states(odd))) == rows(A.GOLD_TABLES[name](odd))
    assert rows(S.daily_states(odd.limit(0))) == []
    for name in A.GOLD_TABLES:
        assert rows(S.GOLD_TABLES[name](S.daily_states(odd.limit(0)))) == rows(A.GOLD_TABLES[name](odd.limit(0)))


def test_states_are_hashed_not_sorted(silver):
    """Ten grouping sets make ten rows an event: those are never sorted, whatever the names are."""
    plan = S.daily_states(silver)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_several_names_of_a_line_and_a_station(spark, silver):
    """Names are keys of the states, yet the gold tables have a row a line and a station."""
    d, t = date(2024, 1, 1), datetime(2024, 1, 1, 5)
    full = dict(zip(silver.columns, (d, "Mon", "t1", "r", "T1", "North", 2, True, "s1", "Central", "08:00:00", 8, 60, 1.0, False, True, t, 0.4, 20.0, True), strict=True))
    data = [{**full, "line_name": n, "stop_name": s, "day_of_week": w, "delay_minutes": m, "trip_id": i} for n, s, w, m, i in (
        ("North", "Central", "Mon", 1.0, "t1"), ("Nord", "Centre", "Lun", 1.0, "t1"), (None, None, None, 1.0, "t1"), ("North", "Centre", "Mon", 2.0, "t2"))]
    odd = spark.createDataFrame([tuple(x[c] for c in silver.columns) for x in data * 5], silver.schema)
    for name in A.GOLD_TABLES:
        assert rows(S.GOLD_TABLES[name](S.daily_states(odd))) == rows(A.GOLD_TABLES[name](odd))
