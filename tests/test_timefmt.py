import datetime as dt

from pyspark.sql import functions as F

from sigfleet.functions.timefmt import format_time, lookback_hours, lookback_start, range_end, range_start

NOW = dt.datetime(2024, 1, 30, 12, 0, 0)


def one_col(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_format_time_goldens(spark):
    cases = {
        "2025-10-22T00:00:00": "2025-10-22T00:00:00Z",
        "2025-10-22T14:30:45.123456": "2025-10-22T14:30:45Z",
        "2025-10-22T00:00:00Z": "2025-10-22T00:00:00Z",
        "2025-10-22": "2025-10-22T00:00:00Z",
        "2025-10-22T10:00:00+02:00": "2025-10-22T10:00:00Z",
        "fooZ": "foo",
        "2025-13-01T00:00:00": "2025-13-01T00:00:00",
    }
    got = one_col(spark, list(cases), format_time)
    assert got == list(cases.values())


def test_format_time_url_encoded(spark):
    got = one_col(spark, ["2025-10-22T00:00:00"], lambda c: format_time(c, url_encode=True))
    assert got == ["2025-10-22T00%3A00%3A00Z"]


def test_format_time_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = one_col(spark, ["2025-10-22T14:30:45"], format_time)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == ["2025-10-22T14:30:45Z"]


def test_range_start_keywords_and_dates(spark):
    vals = ["", "hoy", " TODAY ", "ayer", "yesterday", "semana", "Week", "2024-01-05", "2024-01-05 14:30", "nonsense", "2024-02-30"]
    got = one_col(spark, vals, lambda c: range_start(c, NOW))
    d = dt.timedelta
    assert got == [
        NOW - d(days=1),
        NOW - d(days=1),
        NOW - d(days=1),
        NOW - d(days=2),
        NOW - d(days=2),
        NOW - d(days=7),
        NOW - d(days=7),
        dt.datetime(2024, 1, 5),
        dt.datetime(2024, 1, 5, 14, 30),
        None,
        None,
    ]


def test_range_end(spark):
    vals = ["2024-01-05 9:30", "2024-1-05 1:05", "\t2024-01-05\n", "2024-02-30"]
    got = one_col(spark, vals, lambda c: range_end(c, NOW))
    day = dt.datetime(2024, 1, 5)
    assert got == [day + dt.timedelta(hours=9, minutes=30), day + dt.timedelta(hours=1, minutes=5),
                   dt.datetime(2024, 1, 5, 23, 59, 59), None]
    vals = ["", "2024-01-05", "2024-01-05 14:30", "hoy", "bad"]
    got = one_col(spark, vals, lambda c: range_end(c, NOW))
    assert got == [NOW, dt.datetime(2024, 1, 5, 23, 59, 59), dt.datetime(2024, 1, 5, 14, 30), None, None]


def test_lookback_hours(spark):
    got = one_col(spark, ["", "6", "abc", " 48 ", None], lookback_hours)
    assert got == [24, 6, 24, 48, 24]
    df = spark.createDataFrame([(6,)], "h int")
    assert df.select(lookback_start(F.col("h"), NOW)).first()[0] == NOW - dt.timedelta(hours=6)


def test_calendar_yesterday(spark):
    got = one_col(spark, ["ayer", "hoy"], lambda c: range_start(c, NOW, calendar=True))
    assert got == [dt.datetime(2024, 1, 29, 0, 0), NOW - dt.timedelta(days=1)]
