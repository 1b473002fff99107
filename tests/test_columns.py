"""Scalar rules P1-P15 on hand-written edge cases."""

from pyspark.sql import functions as F

from latewatch.functions import columns as C


def one(spark, expr, ddl, *values):
    df = spark.createDataFrame([values], ddl)
    return df.select(expr.alias("x")).first()["x"]


def test_canonical_delay(spark):
    assert one(spark, C.canonical_delay(), "arrival_delay double, departure_delay double", None, 30.0) == 30.0
    assert one(spark, C.canonical_delay(), "arrival_delay double, departure_delay double", 10.0, 30.0) == 10.0
    assert one(spark, C.canonical_delay(), "arrival_delay double, departure_delay double", None, None) is None


def test_served_codes(spark):
    for code, keep in [(None, True), (0, True), (1, False), (2, False), (3, False)]:
        assert one(spark, C.is_served(), "stu_schedule_relationship int", code) is keep


def test_revenue_null_route_is_dropped(spark):
    df = spark.createDataFrame([("RTTA_1",), ("r1",), (None,), ("RTTA",)], "route_id string")
    assert [r.route_id for r in df.where(C.is_revenue()).collect()] == ["r1"]


def test_sched_hour(spark):
    cases = {"25:30:00": 1, "07:10:00": 7, "24:00:00": 0, "": None, "garbage": None, None: None,
             "x:10:00": None}
    for text, want in cases.items():
        assert one(spark, C.sched_hour(), "arrival_time string", text) == want, text


def test_late_boundary(spark):
    assert one(spark, C.is_late(), "delay_seconds double", 300.0) is False
    assert one(spark, C.is_late(), "delay_seconds double", 301.0) is True
    assert one(spark, C.is_on_time(), "delay_seconds double", -120.0) is True


def test_delay_minutes(spark):
    assert one(spark, C.delay_minutes(), "delay_seconds double", 372.0) == 6.2
    assert one(spark, C.delay_minutes(), "delay_seconds double", -45.0) == -0.75


def test_rain_threshold(spark):
    assert one(spark, C.is_raining(), "precip_mm double", 0.19) is False
    assert one(spark, C.is_raining(), "precip_mm double", 0.2) is True
    assert one(spark, C.is_raining(), "precip_mm double", None) is False


def test_suburban_and_safe_int(spark):
    assert one(spark, C.is_suburban(), "line_code string", "T4") is True
    assert one(spark, C.is_suburban(), "line_code string", "CCN") is False
    assert one(spark, C.is_suburban(), "line_code string", None) is None
    assert one(spark, C.safe_int("route_type"), "route_type string", "rail") is None
    assert one(spark, C.safe_int("route_type"), "route_type string", "2") == 2


def test_service_date_edges(spark):
    # 13:59Z is 00:59 next day in Sydney summer (UTC+11); 12:59Z is 23:59 same day.
    df = spark.createDataFrame([("2024-01-01 12:59:00",), ("2024-01-01 13:00:00",),
                                ("2024-04-06 13:59:00",), ("2024-04-06 14:00:00",),
                                ("2024-07-01 13:59:00",), ("2024-07-01 14:00:00",)], "t string")
    df = df.select(F.to_timestamp_ntz("t").alias("captured_at"))
    got = [str(r.d) for r in df.select(C.service_date_of(df, "captured_at").alias("d")).collect()]
    # 2024-04-07 03:00 local is the end of daylight saving (UTC+11 -> UTC+10)
    assert got == ["2024-01-01", "2024-01-02", "2024-04-07", "2024-04-07", "2024-07-01", "2024-07-02"]


def test_service_date_same_under_other_session_zone(spark):
    df = spark.createDataFrame([("2024-01-01 13:00:00",)], "t string").select(
        F.to_timestamp_ntz("t").alias("captured_at"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Australia/Sydney")
        d = df.select(C.service_date_of(df, "captured_at").alias("d")).first().d
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert str(d) == "2024-01-02"


def test_day_and_condition(spark):
    assert one(spark, C.day_of_week(F.to_date(F.lit("2024-01-04"))), "x int", 1) == "Thu"
    assert one(spark, C.condition_label(), "is_raining boolean", True) == "Wet"
    assert one(spark, C.condition_label(), "is_raining boolean", None) == "Dry"
