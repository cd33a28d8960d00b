"""Codes of many values, dictionaries that grow, and sparse indicators."""

import pytest
from pyspark.sql import functions as F

from lanewise.operators.dictionary import dictionary, sizes, with_codes, with_vector
from tests.helpers import plan, rows


def test_a_million_values(spark):
    df = spark.range(0, 1_000_000, 1, 8).select(F.concat(F.lit("v"), F.col("id")).alias("a"), (F.col("id") % 3).alias("b"))
    known = dictionary(df, ["a", "b"], partitions=7)
    assert known.count() == 1_000_003 and sizes(known, ["a", "b", "c"]) == {"a": 1_000_000, "b": 3, "c": 0}
    codes = known.filter("col = 'a'")
    assert codes.agg(F.min("code"), F.max("code"), F.countDistinct("code")).first() == (0, 999_999, 1_000_000)
    # In order: of sorted values the codes count up.
    low = codes.filter("value < 'v10001'").agg(F.count("*"), F.max("code")).first()
    assert low[0] == low[1] + 1 == spark.range(1_000_000).filter("concat('v', id) < 'v10001'").count()
    assert rows(known.filter("col = 'b'").select("value", "code")) == [("0", 0), ("1", 1), ("2", 2)]


def test_codes_stay_when_values_come(spark):
    first = spark.createDataFrame([("b", 1), ("d", None), (None, 1), ("b", 1)], "x string, y int")
    known = dictionary(first, ["x", "y"])
    assert rows(known) == [("x", "b", 0, 1), ("x", "d", 1, 1), ("y", "1", 0, 1)]
    more = dictionary(spark.createDataFrame([("a", 1, "n"), ("b", 2, None), ("c", 2, "m")], "x string, y int, z string"), ["x", "y", "z"], known)
    new = [("x", "a", 2, 2), ("x", "c", 3, 2), ("y", "2", 1, 2), ("z", "m", 0, 2), ("z", "n", 1, 2)]
    assert rows(more) == sorted(rows(known) + new, key=repr)
    assert rows(dictionary(first, ["x"], more)) == rows(more)
    assert rows(with_codes(first, more, ["x", "y"])) == rows(with_codes(first, known, ["x", "y"]))


def test_unknown_and_null_values(spark):
    known = dictionary(spark.createDataFrame([("a",), ("b",)], "x string"), ["x"])
    df = spark.createDataFrame([("a", 1), ("q", 2), (None, 3)], "x string, value int")
    assert rows(with_codes(df, known, ["x"]).select("value", "x_code")) == [(1, 0), (2, None), (3, None)]
    out = {r.value: r.indicators.toArray().tolist() for r in with_vector(df, known, ["x"]).collect()}
    assert out == {1: [1, 0, 0], 2: [0, 0, 1], 3: [0, 0, 1]}
    assert dictionary(df.limit(0), ["x"]).count() == 0


def test_vectors_are_sparse_and_columns_follow_each_other(spark):
    df = spark.range(2_000).select(F.concat(F.lit("k"), F.col("id") % 500).alias("a"), (F.col("id") % 2).alias("b"))
    known = dictionary(df, ["a", "b"])
    out = with_vector(df, known, ["a", "b"])
    assert out.columns == ["a", "b", "indicators"]
    for row in out.limit(50).collect():
        assert row.indicators.size == 501 + 3 and row.indicators.numNonzeros() == 2
        assert row.indicators.indices[1] == 501 + row.b and len(row.indicators.indices) == 2
    assert "CartesianProduct" not in plan(out)


@pytest.mark.parametrize("share", [None, 0.2])
def test_hot_values_have_their_code(spark, share):
    df = spark.range(900).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), "id")).alias("a"))
    out = with_codes(df, dictionary(df, ["a"]), ["a"], hot_share=share)
    assert out.filter("a_code IS NULL").count() == 0 and out.select("a_code").distinct().count() == 601 and out.count() == 900
