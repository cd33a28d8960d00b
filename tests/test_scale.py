"""The shape of plans: what must hold however large the tables are."""

import pytest
from pyspark.sql import functions as F

from lanewise.operators import by_date, count_over, first_per_key, join_groups, lookup, trailing_stats, value_domains
from lanewise.operators.joins import _copies, hot_keys
from lanewise.sources import stage
from shipment_checks import view
from shipment_checks.catalog import QUERIES
from tests.conftest import SF_DIR
from tests.helpers import count_of, final_plan, plan, rows

@pytest.fixture
def hot(spark, conf):
    """Facts of which one key has a third, and settings under which nothing is small enough to broadcast."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__shuffle__partitions="16",
    )
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
    return spark.range(0, 90_000, 1, 8).select(key.alias("key"), F.col("id").alias("n"), F.xxhash64("id").alias("pad"))


@pytest.mark.parametrize("on_duplicate", ["allow", "first"])
def test_hot_lookup_key_is_split(spark, hot, on_duplicate):
    dim = spark.range(0, 90_000, 1, 8).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    out = lookup(hot, dim, ["key"], ["v"], on_duplicate=on_duplicate)
    assert "SortMergeJoin(skew=true)" in final_plan(out)
    assert out.agg(F.count("*"), F.sum("v") - 2 * F.sum("key")).first() == (90_000, 0)


def test_hot_null_group_is_split(spark, hot):
    """Packages of one order are counted without any task holding them all; here the order is unknown."""
    df = hot.withColumn("key", F.when(F.col("key") != 7, F.col("key")))
    out = count_over(df, ["key"], "n", "group_size")
    assert "SortMergeJoin(skew=true)" in final_plan(out)
    assert "Window" not in plan(out)
    assert out.filter("key is null").select("group_size").distinct().collect() == [(30_001,)]


def test_spread_divides_a_hot_key_over_tasks(spark, hot, conf):
    conf(spark__sql__adaptive__enabled="false")
    dim = spark.range(0, 90_000, 1, 8).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    out = lookup(hot, dim, ["key"], ["v"], spread=8)
    per_task = out.groupBy(F.spark_partition_id()).agg(F.count_if(F.col("key") == 7).alias("hot"))
    assert per_task.agg(F.max("hot")).first()[0] < 30_000 / 2
    assert out.agg(F.count("*"), F.sum("v") - 2 * F.sum("key")).first() == (90_000, 0)


def test_hot_keys_are_found_and_only_their_rows_copied(spark, hot, conf):
    """A third of the rows has one key that nobody named; copies of the lookup are made of its rows alone."""
    conf(spark__sql__adaptive__enabled="false")
    dim = spark.range(0, 90_000, 1, 8).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    found = hot_keys(hot, ["key"], 0.02)
    assert list(found.values()) == [17] and found == hot_keys(hot.repartition(3), ["key"], 0.02)
    out = lookup(hot, dim, ["key"], ["v"], hot_share=0.02)
    per_task = out.groupBy(F.spark_partition_id()).agg(F.count_if(F.col("key") == 7).alias("hot"))
    assert per_task.agg(F.max("hot")).first()[0] < 30_000 / 3
    assert out.agg(F.count("*"), F.sum("v") - 2 * F.sum("key")).first() == (90_000, 0)
    copies = dim.withColumn("n", _copies(F.xxhash64("key"), found)).agg(F.sum("n")).first()
    assert copies == (90_000 + 16,)


def test_hot_null_and_double_keys_join_as_a_plain_lookup(spark):
    df = spark.range(0, 6_000, 1, 3).select(F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, 5).otherwise(F.col("id")).alias("a"), (F.col("id") % 2).alias("b"), "id")
    dim = spark.createDataFrame([(5, 0, "x"), (5, 0, "y"), (5, 1, None), (None, 0, "z"), (2, 0, "w")], "a long, b long, v string")
    for how in ("left", "inner"):
        plain = lookup(df, dim, ["a", "b"], ["v"], how)
        assert rows(lookup(df, dim, ["a", "b"], ["v"], how, hot_share=0.1)) == rows(plain)
    assert lookup(df.limit(0), dim, ["a", "b"], ["v"], hot_share=0.1).count() == 0
    assert hot_keys(spark.range(100).toDF("a"), ["a"], 0.05) == {}
    with pytest.raises(ValueError, match="not both"):
        lookup(df, dim, ["a", "b"], ["v"], spread=2, hot_share=0.1)


def test_rows_are_joined_with_small_summaries_without_a_shuffle(spark):
    df = stage(
        spark.range(0, 20_000, 1, 8).select(
            F.expr("date_add(date'2023-01-01', cast(id % 60 as int))").alias("d"),
            (F.col("id") % 4).alias("g"),
            (F.col("id") % 9).alias("v"),
        )
    )
    text = final_plan(trailing_stats(df, ["v"], [["g"]], [(-7, -1)], "d"))
    assert count_of(text, "BroadcastHashJoin") == 2
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text and "Window" not in text


def test_rows_are_joined_with_large_summaries_by_shuffle(spark, hot):
    """Beyond the broadcast threshold the same result comes by a join that splits hot groups."""
    df = stage(
        hot.select(F.expr("date_add(date'2023-01-01', cast(n % 2 as int))").alias("d"), "key", "pad", F.col("n").alias("v"))
    )
    out = trailing_stats(df, ["v"], [["key"]], [(-1, -1)], "d", stat="count")
    text = final_plan(out)
    assert "SortMergeJoin(skew=true)" in text
    assert out.filter("key = 7").groupBy("index", "`count_-1_-1_v_key`").count().orderBy("index").collect() == [
        (1, 0, 15_000), (2, 15_000, 15_001),
    ]


def test_first_row_is_picked_before_the_shuffle(spark):
    df = spark.range(0, 1000, 1, 8).select((F.col("id") % 3).alias("k"), "id")
    text = plan(first_per_key(df, ["k"], [F.col("id").asc()], [F.col("id").asc()]))
    before_exchange = text[text.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_exchange and "Partial" in before_exchange


def test_date_ranges_and_columns_reach_the_scan(spark):
    df = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    part = by_date(df, "o_orderdate", {"train": ("1996-01-01", "1997-01-01")})["train"].select("o_orderkey")
    text = plan(part)
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_domains_bring_few_rows_to_the_driver(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    sizes, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: sizes.append(len(found := collect(self))) or found)
    with pytest.raises(ValueError):
        value_domains(spark.range(10_000).selectExpr("id", "id % 3 as k"), ["id", "k"], max_values=20)
    assert sizes == [21 + 3]


def test_joined_groups_match_null_keys(spark):
    df = spark.createDataFrame([(None, 1), ("a", None), (None, None)], "g string, h int")
    groups = df.withColumn("x", F.lit(1)).groupBy("g", "h").agg(F.sum("x").alias("x"))
    assert len(rows(join_groups(df, groups, ["g", "h"]).filter("x = 1"))) == 3


def test_lines_lie_by_product_before_the_lookup(spark, conf):
    """The part is joined by the text of its key, so the lookup of product flags shuffles its own side only."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    tables = view.tables(spark, SF_DIR, (view.shipment_lines, view.product_flags))
    lines = tables["shipment_lines"]
    text = plan(lookup(lines, tables["product_flags"], {"PRODUCT_KEY": "product_key"}, ["PRODUCT_SHIPPABLE_UOM"]))
    assert count_of(text, r"Exchange hashpartitioning\(PRODUCT_KEY") == 0
    assert count_of(plan(lines), r"Exchange hashpartitioning\(.*(l_orderkey|l_partkey)") == 2  # the items: by order and by part


def test_single_split_trains_on_a_staged_table(spark):
    assert count_of(plan(QUERIES["single_split_predictions"](spark, SF_DIR)), "Join") == 0
