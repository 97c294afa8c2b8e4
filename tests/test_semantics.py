"""Casts, wall-clock time, rounding and labels on hand-made rows."""

from __future__ import annotations

from datetime import date, datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from tripmart.functions import casts, clock, codes, labels
from tripmart.functions.rounding import round_half_away


def times(spark, *rows):
    return spark.createDataFrame(
        [tuple(datetime.fromisoformat(t) if t else None for t in r) for r in rows],
        "a timestamp_ntz, b timestamp_ntz",
    )


def values(df, *columns):
    return [tuple(r) if len(r) > 1 else r[0] for r in df.select(*columns).collect()]


DST_CASES = [
    # fall back: the repeated hour is read as its second pass
    ("2025-11-02 01:30:00", "2025-11-02 01:10:00", -20.0),
    ("2025-11-02 00:50:00", "2025-11-02 01:10:00", 80.0),
    ("2025-11-02 01:59:59", "2025-11-02 02:00:00", 1 / 60),
    # spring forward: 02:00 to 03:00 does not exist
    ("2025-03-09 01:50:00", "2025-03-09 03:10:00", 20.0),
    ("2025-03-09 02:30:00", "2025-03-09 03:40:00", 10.0),
    # an ordinary night
    ("2025-06-01 23:50:00", "2025-06-02 00:10:00", 20.0),
]


@pytest.mark.parametrize("start, end, minutes", DST_CASES)
def test_elapsed_minutes(spark, start, end, minutes):
    df = times(spark, (start, end))
    assert values(df, clock.elapsed_minutes(F.col("a"), F.col("b"))) == [minutes]
    assert values(df, clock.is_after(F.col("b"), F.col("a"))) == [minutes > 0]


def test_instants_equal_duckdb(spark):
    """Every quarter hour of both switch weekends."""
    days = ("2025-03-08", "2025-03-09", "2025-11-01", "2025-11-02", "2026-03-08", "2026-11-01")
    steps = [
        (f"{d} {h:02d}:{m:02d}:00", f"{d} {h:02d}:{m:02d}:00")
        for d in days
        for h in range(24)
        for m in (0, 15, 30, 45)
    ]
    df = times(spark, *steps)
    got = dict(values(df, "a", clock.ny_instant(F.col("a"))))
    db = duckdb.connect()
    for written, _ in steps:
        sql = f"SELECT (timezone('America/New_York', TIMESTAMP '{written}')) AT TIME ZONE 'UTC'"
        assert got[datetime.fromisoformat(written)] == db.execute(sql).fetchone()[0], written


def test_results_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", other)
            df = times(spark, *[(s, e) for s, e, _ in DST_CASES])
            got = values(df, clock.elapsed_minutes(F.col("a"), F.col("b")))
            assert got == [m for _, _, m in DST_CASES]
            spring = times(spark, ("2025-03-09 02:30:00", None))
            assert values(spring, clock.hour_start(F.col("a"))) == [datetime(2025, 3, 9, 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_second_boundaries_are_counted(spark):
    df = times(
        spark,
        ("2025-01-01 00:00:00.9", "2025-01-01 00:00:01.1"),
        ("2025-01-01 00:00:00.1", "2025-01-01 00:00:00.9"),
        ("2025-01-01 00:00:01.1", "2025-01-01 00:00:00.9"),
    )
    assert values(df, clock.seconds_between(F.col("a"), F.col("b"))) == [1, 0, -1]


def test_null_times(spark):
    df = times(spark, ("2025-01-01 00:00:00", None), (None, None))
    assert values(df, clock.elapsed_minutes(F.col("a"), F.col("b"))) == [None, None]
    assert values(df, clock.is_after(F.col("b"), F.col("a"))) == [None, None]


def test_near_switch_days(spark):
    df = times(
        spark,
        *[
            (f"{d} 12:00:00", None)
            for d in ("2025-03-09", "2025-03-16", "2025-11-02", "2025-11-03", "2025-10-05")
        ],
    )
    assert values(df, clock.near_switch(F.col("a"))) == [True, False, True, False, False]


def test_day_numbers(spark):
    df = times(spark, ("2025-01-05 00:00:00", None), ("2025-01-06 00:00:00", None))
    assert values(df, clock.sunday_first(F.col("a")), clock.monday_first(F.col("a"))) == [
        (0, 7),
        (1, 1),
    ]


@pytest.mark.parametrize(
    "value, digits, expected",
    [
        (1.005, 2, 1.0),
        (2.675, 2, 2.68),
        (0.49999999999999994, 0, 0.0),
        (2.5, 0, 3.0),
        (-2.5, 0, -3.0),
        (-1.25, 1, -1.3),
        (1e300, 2, 1e300),
        (None, 2, None),
    ],
)
def test_round(spark, value, digits, expected):
    df = spark.createDataFrame([(value,)], "x double")
    assert values(df, round_half_away(F.col("x"), digits)) == [expected]
    if value is not None and value < 1e300:
        sql = f"SELECT round({value!r}::DOUBLE, {digits})"
        assert duckdb.connect().execute(sql).fetchone()[0] == expected


def test_int_cast_rounds_halves_to_even(spark):
    df = spark.createDataFrame([(1.5,), (2.5,), (3.5,), (-1.5,), (None,)], "x double")
    assert values(df, casts.int_column(df, "x")) == [2, 2, 4, -2, None]
    decimals = df.select(F.col("x").cast("decimal(4,1)").alias("x"))
    assert values(decimals, casts.int_column(decimals, "x")) == [2, 3, 4, -2, None]


def test_text_times(spark):
    df = spark.createDataFrame([("2025-01-01T05:00",)], "t string")
    assert values(df, casts.to_wall_clock("t")) == [datetime(2025, 1, 1, 5)]


def test_unlisted_code_has_no_name(spark):
    df = spark.createDataFrame([(1,), (3,), (None,)], "code int")
    assert values(df, codes.translate("code", codes.VENDORS)) == [codes.VENDORS[1], None, None]


def test_labels_sort_in_calendar_order(spark):
    days = spark.createDataFrame([(date(2025, 1, 6 + n),) for n in range(7)], "d date")
    got = values(days, labels.weekday_label(F.col("d")))
    assert sorted(got) == got
    assert [g.strip(labels.ZERO_WIDTH) for g in got] == list(labels.DAYS)
    assert [len(g) for g in got] == [3, 4, 5, 6, 7, 8, 9]
    assert values(days, labels.numbered_weekday(F.col("d")))[0] == "1 Mon"
    assert values(days, labels.day_type(F.col("d")))[4:] == ["Weekday", "Weekend", "Weekend"]


def test_rain_bands(spark):
    df = spark.createDataFrame([(0.9,), (1.0,), (4.9,), (5.0,), (15.0,), (None,)], "mm double")
    names = [b.strip(labels.ZERO_WIDTH).split(" ")[0] for b in values(df, labels.rain_band(F.col("mm")))]
    assert names == ["Dry", "Light", "Light", "Moderate", "Heavy", "Heavy"]


def test_hour_label(spark):
    df = times(spark, ("2025-01-01 07:59:00", None), ("2025-01-01 23:00:00", None))
    assert values(df, labels.hour_label(F.col("a"))) == ["07h", "23h"]
