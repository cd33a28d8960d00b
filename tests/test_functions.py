import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewise.functions import calendars, clock, labels
from tests.helpers import rows


def clock_frame(spark, data):
    df = spark.createDataFrame(data, "cutoff int, hours int, shipped string")
    shipped = F.concat(F.lit("2023-01-01 "), F.col("shipped")).cast("timestamp_ntz")
    return df.select(
        "cutoff",
        clock.shift(clock.from_hhmmss(F.col("cutoff")), F.col("hours")).alias("pull"),
        clock.seconds_of_day(shipped).alias("ship"),
    )


@pytest.mark.parametrize(
    "cutoff, hours, shipped, pull, after, until",
    [
        (220000, 5, "23:10:00", "03:00:00", 0, 3.83),
        (220000, 5, "03:30:00", "03:00:00", 1, 23.5),
        (123456, 3, "10:00:00", "15:34:56", 0, 5.58),
        (243000, 3, "10:00:00", None, 0, 14.0),
        (None, 3, "10:00:00", None, 0, 14.0),
        (100000, 3, "13:00:17", "13:00:00", 1, 0.0),
        (100000, 3, "13:00:18", "13:00:00", 1, 23.99),
        (10000, 3, "04:00:00", "04:00:00", 0, 0.0),
        (5959, 3, "04:00:00", "03:59:59", 1, 0.0),
        (5959, 3, "04:00:01", "03:59:59", 0, 0.0),
    ],
)
def test_clock(spark, cutoff, hours, shipped, pull, after, until):
    df = clock_frame(spark, [(cutoff, hours, shipped)])
    row = df.select(
        clock.format_clock(F.col("pull")).alias("pull"),
        clock.is_after(F.col("ship"), F.col("pull")).alias("after"),
        clock.hours_until(F.col("pull"), F.col("ship")).alias("until"),
    ).first()
    assert tuple(row) == (pull, after, until)


def test_unknown_ship_time_is_never_late(spark):
    row = clock_frame(spark, [(100000, 3, None)]).select(
        clock.is_after(F.col("ship"), F.col("pull")), clock.hours_until(F.col("pull"), F.col("ship"))
    )
    assert tuple(row.first()) == (0, None)


def test_hhmmss_that_is_no_time_of_day_is_null(spark):
    codes = [0, 235959, 240000, 126000, 120060, -1, None]
    df = spark.createDataFrame([(code,) for code in codes], "code int")
    found = [row[0] for row in df.select(clock.from_hhmmss(F.col("code"))).collect()]
    assert found == [0, 86399, None, None, None, None, None]


def test_clock_does_not_depend_on_the_time_zone(spark, conf):
    df = clock_frame(spark, [(20000, 3, "02:30:00")])
    out = df.select("ship", "pull", clock.hours_until(F.col("pull"), F.col("ship")))
    utc = rows(out)
    conf(spark__sql__session__timeZone="America/New_York")
    assert rows(out) == utc


def test_weekday_counts_from_sunday(spark):
    days = [(dt.date(2023, 1, 1),), (dt.date(2023, 1, 6),), (dt.date(2023, 1, 7),)]
    df = spark.createDataFrame(days, "day date")
    found = df.select(
        calendars.weekday0(F.col("day")),
        labels.label_values(calendars.weekday0(F.col("day")), {5: "friday", 6: "saturday"}, "regular"),
    )
    assert [tuple(row) for row in found.collect()] == [(0, "regular"), (5, "friday"), (6, "saturday")]


def test_days_between_ignores_the_time(spark):
    df = spark.sql("select timestamp_ntz'2023-01-02 00:01:00' as e, timestamp_ntz'2023-01-01 23:59:00' as s")
    assert df.select(calendars.days_between(F.col("e"), F.col("s"))).first()[0] == 1


def test_parse_mdy(spark):
    texts = ["7/4/23", "07/04/23", "2/30/23", "x", None, "1/1/68", "1/1/69", "2/29/72", "12/31/99"]
    df = spark.createDataFrame([(text,) for text in texts], "text string")
    found = [row[0] for row in df.select(calendars.parse_mdy(F.col("text"))).collect()]
    july = dt.date(2023, 7, 4)
    assert found == [
        july, july, None, None, None, dt.date(2068, 1, 1), dt.date(1969, 1, 1), dt.date(1972, 2, 29), dt.date(1999, 12, 31),
    ]


def test_holiday_note_wins(spark):
    df = spark.createDataFrame([("A", None), ("A", "n"), (None, None), (None, "n")], "holiday string, note string")
    found = [row[0] for row in df.select(calendars.holiday_label(F.col("holiday"), F.col("note"))).collect()]
    assert found == ["holiday", "before_holiday", "regular", "before_holiday"]


def test_band(spark):
    bounds = [250, 500, 1000, 1500, 2000, 3000]
    df = spark.createDataFrame([(250.0,), (250.1,), (3000.0,), (3000.1,), (None,)], "miles double")
    found = df.select(labels.band(F.col("miles"), bounds), labels.band(F.col("miles"), bounds, null_band=0)).collect()
    assert [row[0] for row in found] == [1, 2, 6, 7, 7]
    assert found[-1][1] == 0


def test_pad_zip(spark):
    df = spark.createDataFrame([("123",), ("1234567",), (None,)], "zip string")
    found = df.select(labels.pad_zip(F.col("zip")), labels.prefix(labels.pad_zip(F.col("zip")), 3)).collect()
    assert [tuple(row) for row in found] == [("00123", "001"), ("12345", "123"), (None, None)]


def test_flags_and_fallbacks(spark):
    df = spark.createDataFrame([(True, "A", 1), (False, "B", None), (None, None, None)], "b boolean, s string, n int")
    found = df.select(
        labels.flag(F.col("b")), labels.flag_in(F.col("s"), ["A"], "G2", "G1"), labels.fallback(F.col("n"), 7)
    )
    assert [tuple(row) for row in found.collect()] == [(1, "G2", 1), (0, "G1", 7), (0, "G1", 7)]


def test_casts_give_null_for_text_that_is_no_number(spark):
    df = spark.createDataFrame([("12",), ("1.5",), ("x",), (None,)], "text string")
    found = df.select(labels.to_int(F.col("text")), labels.to_double(F.col("text"))).collect()
    assert [row[1] for row in found] == [12.0, 1.5, None, None]
    assert [row[0] for row in found][2:] == [None, None] and found[0][0] == 12


def test_rounding_goes_to_the_even_number(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "x double")
    assert [row[0] for row in df.select(labels.round_half_even(F.col("x"))).collect()] == [0.0, 2.0, 2.0, 0.0]


def test_volume_with_a_missing_side_is_null(spark):
    df = spark.createDataFrame([(2.0, 3.0, 4.0), (2.0, None, 4.0)], T.StructType([T.StructField(c, T.DoubleType()) for c in "hlw"]))
    assert [row[0] for row in df.select(labels.volume(F.col("h"), F.col("l"), F.col("w"))).collect()] == [24.0, None]
