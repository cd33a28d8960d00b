import datetime as dt
import itertools
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewise.operators import calendar_index, trailing_name, trailing_stats
from lanewise.operators.rolling import WIDE, _takes_prefix
from lanewise.sources import stage
from tests.helpers import rows


def direct(df, values, groups, ranges, date_col, stats, default=1.0):
    """The plain statement of the operator: windows over all rows."""
    df = df.join(calendar_index(df, date_col), date_col)
    for group, days, value, stat in itertools.product(groups, ranges, values, stats):
        window = Window.partitionBy(*group).orderBy("index").rangeBetween(*days)
        column = F.coalesce(getattr(F, stat)(value).over(window).cast("double"), F.lit(default))
        df = df.withColumn(trailing_name(stat, days, value, group), column)
    return df


def rounded(df, columns):
    return rows(df.select(*[F.round(F.col(f"`{c}`").cast("double"), 6) if c.split("_")[0] in STATS else F.col(c).cast("string") for c in columns]))


STATS = ["avg", "sum", "count", "min", "max", "stddev"]
START = dt.date(2023, 1, 1)


def test_gaps_and_defaults(spark):
    """Five days of one group: the range counts days that occur, not calendar days."""
    data = [(START + dt.timedelta(days=n), "g", float(n)) for n in (1, 2, 3, 5, 8)]
    out = trailing_stats(spark.createDataFrame(data, "d date, g string, v double"), ["v"], [["g"]], [(-2, -1)], "d", default=None)
    found = [tuple(row) for row in out.orderBy("index").select("index", "`avg_-2_-1_v_g`").collect()]
    assert found == [(1, None), (2, 1.0), (3, 1.5), (4, 2.5), (5, 4.0)]


def test_absent_days_of_a_group_leave_holes(spark):
    """A group without rows on some days of the calendar: positions are those of the whole table."""
    present = [(START + dt.timedelta(days=n), "g", float(n)) for n in (1, 2, 3, 5, 8)]
    others = [(START + dt.timedelta(days=n), "other", 0.0) for n in range(1, 9)]
    df = spark.createDataFrame(present + others, "d date, g string, v double")
    out = trailing_stats(df, ["v"], [["g"]], [(-2, -1)], "d", default=None).filter("g = 'g'")
    found = [tuple(row) for row in out.orderBy("index").select("index", "`avg_-2_-1_v_g`").collect()]
    assert found == [(1, None), (2, 1.0), (3, 1.5), (5, 3.0), (8, None)]


def test_own_day_is_left_out_and_null_groups_count(spark):
    data = [(START, None, 2), (START, None, 4), (START + dt.timedelta(1), None, 9), (None, None, 100)]
    out = trailing_stats(spark.createDataFrame(data, "d date, g string, v int"), ["v"], [["g"]], [(-7, -1)], "d")
    assert rows(out.select("v", "`avg_-7_-1_v_g`")) == [(2, 1.0), (4, 1.0), (9, 3.0)]


def test_unknown_statistic(spark):
    with pytest.raises(ValueError, match="median"):
        trailing_stats(spark.range(1), ["id"], [[]], [(-1, -1)], "id", stat="median")


row = st.tuples(
    st.one_of(st.none(), st.integers(0, 12)),
    st.sampled_from(["a", "b", None]),
    st.sampled_from([0, 1, None]),
    st.one_of(st.none(), st.integers(-50, 50)),
)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=1, max_size=60))
def test_equals_windows_over_all_rows(spark, data):
    data = [(None if n is None else START + dt.timedelta(days=n), g, h, v) for n, g, h, v in data]
    df = spark.createDataFrame(data, "d date, g string, h int, v int")
    arguments = (["v"], [["g", "h"], ["h"]], [(-4, -1), (-2, -2)], "d")
    expected = direct(df, *arguments, STATS)
    found = trailing_stats(df, *arguments, stat=STATS)
    assert set(found.columns) == set(expected.columns)
    assert rounded(found, expected.columns) == rounded(expected, expected.columns)


def test_stddev_of_large_values_does_not_cancel(spark):
    data = [(START + dt.timedelta(days=n), 1e9 + n % 3) for n in range(10)]
    out = trailing_stats(spark.createDataFrame(data, "d date, v double"), ["v"], [[]], [(-3, -1)], "d", "stddev")
    found = [row[0] for row in out.filter("index > 3").select("`stddev_-3_-1_v`").collect()]
    assert found == pytest.approx([1.0] * 7)


def test_stddev_of_groups_at_different_levels(spark):
    data = [(START + dt.timedelta(days=n), g, level + n % 2) for n in range(12) for g, level in (("a", 1e9), ("b", 0.0))]
    out = trailing_stats(spark.createDataFrame(data, "d date, g string, v double"), ["v"], [["g"]], [(-4, -1)], "d", "stddev")
    found = [row[0] for row in out.filter("index > 4").select("`stddev_-4_-1_v_g`").collect()]
    assert found == pytest.approx([(1 / 3) ** 0.5] * 16)


def test_prefixes_equal_frames(spark):
    rng = random.Random(8)
    data = [(rng.choice([None, *(START + dt.timedelta(days=n) for n in range(13))]), rng.choice(["a", "b", None]), rng.choice([None, *range(-50, 50)])) for _ in range(60)]
    df = stage(spark.createDataFrame(data, "d date, g string, v int"))
    arguments = (["v"], [["g"]], [(-8, -1), (-2, 0), (1, 4)], "d")
    by_frame = trailing_stats(df, *arguments, stat=STATS, strategy="window", default=None)
    by_prefix = trailing_stats(df, *arguments, stat=STATS, strategy="prefix", default=None)
    assert rounded(by_prefix, by_frame.columns) == rounded(by_frame, by_frame.columns)
    assert dict(by_prefix.dtypes) == dict(by_frame.dtypes)


def test_rule_of_auto():
    whole, fraction = T.LongType(), T.DoubleType()
    wide, narrow = (-WIDE, -1), (-28, -1)
    assert _takes_prefix("auto", "avg", wide, whole) and _takes_prefix("auto", "min", wide, fraction)
    assert not _takes_prefix("auto", "avg", wide, fraction) and not _takes_prefix("auto", "sum", narrow, whole)
    assert _takes_prefix("prefix", "sum", narrow, fraction) and not _takes_prefix("prefix", "stddev", wide, whole)
    with pytest.raises(ValueError, match="strategy"):
        _takes_prefix("fast", "avg", wide, whole)


def known(data, lo, hi):
    """Per row (index, n, total) of the values in its range that were known by its day; brute force."""
    days = sorted({d for d, _, _, _ in data if d is not None}, key=lambda d: d)
    first = 2 if any(d is None for d, _, _, _ in data) else 1
    at = {d: i for i, d in enumerate(days, first)}
    out = []
    for d, g, _, _ in data:
        if d is not None:
            seen = [v for e, h, k, v in data if e is not None and h == g and k is not None and k <= d and lo <= at[e] - at[d] <= hi and v is not None]
            out.append((at[d], g, len(seen), sum(seen) if seen else None))
    return sorted(out, key=repr)


known_row = st.tuples(st.one_of(st.none(), st.integers(0, 12)), st.sampled_from(["a", None]), st.one_of(st.none(), st.integers(-3, 20)), st.one_of(st.none(), st.integers(-50, 50)))


@settings(max_examples=2, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(known_row, min_size=1, max_size=40))
def test_known_by_takes_nothing_that_lay_ahead(spark, data):
    day = lambda n: None if n is None else START + dt.timedelta(days=2 * n)  # noqa: E731  known days lie between those of the calendar
    data = [(day(n), g, None if k is None else START + dt.timedelta(days=k), v) for n, g, k, v in data]
    df = spark.createDataFrame(data, "d date, g string, k date, v int")
    for lo, hi in ((-4, -1), (-9, 0)):
        out = trailing_stats(df, ["v"], [["g"]], [(lo, hi)], "d", ["count", "sum", "avg"], None, known_by="k")
        found = [tuple(r) for r in out.select("index", "g", f"`count_{lo}_{hi}_v_g`", f"`sum_{lo}_{hi}_v_g`").collect()]
        assert sorted(found, key=repr) == known(data, lo, hi)
        assert out.filter(f"`avg_{lo}_{hi}_v_g` <> `sum_{lo}_{hi}_v_g` / `count_{lo}_{hi}_v_g`").count() == 0


def test_known_by_needs_sums_and_a_date(spark):
    df = spark.createDataFrame([(START, "x", 1)], "d date, k string, v int")
    with pytest.raises(ValueError, match="avg, sum, count"):
        trailing_stats(df, ["v"], [[]], [(-1, -1)], "d", "max", known_by="d")
    with pytest.raises(TypeError, match="k must be a date"):
        trailing_stats(df, ["v"], [[]], [(-1, -1)], "d", known_by="k")
    assert trailing_stats(df.limit(0), ["v"], [[]], [(-1, -1)], "d", known_by="d").count() == 0


def test_statistics_of_all_rows_added_to_some(spark):
    days = spark.range(0, 200, 1, 4).selectExpr("id", "date_add(date'2020-01-01', cast(id % 20 as int)) AS day", "id % 3 AS g", "id % 7 AS v")
    some = days.where("id % 5 = 0").withColumn("more", F.lit(1))
    whole = trailing_stats(days, ["v"], [["g"]], [(-5, -1)], "day")
    found = trailing_stats(days, ["v"], [["g"]], [(-5, -1)], "day", to=some)
    assert rows(found.drop("more")) == rows(whole.where("id % 5 = 0")) and found.count() == 40
