"""The input tables of the shipment job, derived from the driver's tables by Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewise.config import PipelineConfig
from lanewise.sources import TABLES, conform, read, stage_all

# What the star schema calls a site, and the dates it covers.
CORE_SITES = tuple(f"FC{number:02d}" for number in range(20))
LATE_PULL_SITES = ("FC01", "FC07", "FC12", "FC18")
DATE_RANGES = {"train_val": ("1995-06-01", "2000-01-01"), "test": ("2000-01-01", "2001-01-01")}


def config(**changes) -> PipelineConfig:
    return PipelineConfig(
        **{
            "core_sites": CORE_SITES,
            "late_pull_sites": LATE_PULL_SITES,
            "date_ranges": DATE_RANGES,
            "encoded_domain": {"ffmcenter_name": CORE_SITES},
            **changes,
        }
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read(spark, f"{sf_dir}/{name}.parquet")


def plus_seconds(timestamp: Column, seconds: Column) -> Column:
    return timestamp + F.make_dt_interval(secs=seconds)


def transit() -> Column:
    return F.pmod(F.datediff("l_shipdate", "o_orderdate"), F.lit(16))


def shipped_at() -> Column:
    return plus_seconds(
        F.col("l_shipdate"), F.pmod(F.expr("l_orderkey * 7919 + l_linenumber * 3571 + l_partkey"), F.lit(86400))
    )


def zip5() -> Column:
    return F.lpad((F.col("o_custkey") % 100000).cast("string"), 5, "0")


def site() -> Column:
    return F.concat(F.lit("FC"), F.lpad(F.col("s_nationkey").cast("string"), 2, "0"))


def star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order, customer, nation, supplier and part, joined one after the other.

    Training draws rows by where they lie, so the models of the shipment view rest on this order.
    """
    item = table(spark, sf_dir, "lineitem")
    order = table(spark, sf_dir, "orders")
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    supplier, part = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part")
    return (
        item.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
    )


def star_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of `star` with less to shuffle, for the tables of the job.

    Orders take on their customer before they meet the items, so the items are shuffled by order and by part only. The part is
    met last, by the text that stands for it in the shipment tables: a lookup of products then finds the rows where they lie.
    """
    item = table(spark, sf_dir, "lineitem")
    order = table(spark, sf_dir, "orders")
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    supplier, part = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part")
    order = order.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return (
        item.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(part, F.col("l_partkey").cast("string") == F.col("p_partkey").cast("string"))
    )


def shipment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped, days = shipped_at(), transit()
    delivered = shipped + F.make_dt_interval(days=days)
    attempted = F.when(
        F.col("l_returnflag") != "N", F.when(F.col("l_discount") > 0.05, delivered - F.expr("interval 6 hours")).otherwise(delivered)
    )
    columns = {
        "ORDER_ID": F.col("l_orderkey").cast("string"),
        "SHIPMENT_TRACKING_NUMBER": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "PRODUCT_KEY": F.col("l_partkey").cast("string"),
        "SHIPMENT_COUNT_OF_ITEMS_IN_BOX": F.col("l_quantity").cast("int"),
        "CARRIER_CODE": F.col("l_returnflag"),
        "FFMCENTER_NAME": site(),
        "RELEASE_DTTM_EST": plus_seconds(F.col("o_orderdate"), F.expr("o_orderkey * 37 % 86400")),
        "SHIPMENT_SHIPPED_DTTM_EST": shipped,
        "SHIPMENT_SHIPPED_DATE": F.to_date("l_shipdate"),
        "SHIPMENT_DELIVERY_DTTM_EST": delivered,
        "SHIPMENT_DELIVERY_DATE": F.to_date(delivered),
        "CUSTOMER_POSTCODE": zip5(),
        "SHIPMENT_SHIP_ROUTE": F.col("p_brand"),
        "SHIPMENT_ESTIMATED_DELIVERY_DATE": F.date_add(F.to_date("l_shipdate"), days + 1),
        "STD_ACTUAL": days,
        "STD_V0": F.when(F.col("l_linestatus") != "F", F.col("l_partkey") % 5),
        "ACTUAL_ZONE": F.when(F.col("c_mktsegment") != "MACHINERY", F.col("n_regionkey")),
        "INITIAL_DELIVERY_ATTEMPT_DTTM_EST": attempted,
        "INITIAL_SHIPMENT_DELIVERY_ATTEMPT_DATE": F.to_date(attempted),
        "WAREHOUSE_EXPECTED_WEIGHT": F.col("l_quantity"),
        "WAREHOUSE_EXPECTED_HEIGHT": F.col("p_size").cast("double"),
        "WAREHOUSE_EXPECTED_LENGTH": F.when(F.col("l_tax") > 0, F.col("l_quantity")),
        "WAREHOUSE_EXPECTED_WIDTH": F.col("l_linenumber").cast("double"),
    }
    lines = star_by_product(spark, sf_dir).select(*[column.alias(name) for name, column in columns.items()])
    return conform(lines, TABLES["shipment_lines"])


def product_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .filter("p_type <> 'PROMO'")
        .select(
            F.col("p_partkey").cast("string").alias("product_key"),
            F.expr("if(p_size % 5 = 0, null, p_size % 2 = 0)").alias("PRODUCT_SHIPPABLE_UOM"),
        )
    )


def zip_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    nation = table(spark, sf_dir, "nation").filter("n_regionkey <> 0")
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(zip5().alias("zip"))
        .agg(F.min("n_name").alias("state_id"))
    )


def route_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    second = F.expr("l_partkey * 617 % 90000")
    code = F.expr("floor(s / 3600) * 10000 + floor(s / 60) % 60 * 100 + s % 60")
    days = F.col("l_quantity").cast("int") % 7
    return (
        star_by_product(spark, sf_dir)
        .filter("l_linestatus = 'O'")
        .withColumn("s", second)
        .select(
            F.to_date("o_orderdate").alias("DATE"),
            site().alias("FCName"),
            F.col("p_brand").alias("RouteID"),
            zip5().alias("Zip5"),
            F.col("l_returnflag").alias("MODE"),
            code.cast("int").alias("Cutoff"),
            days.alias("AdjTNT"),
            (days + 1 + F.col("l_linenumber") % 2).alias("NextAdjTNT"),
        )
    )


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last holidays of each month that has orders then, with text dates."""
    day = F.dayofmonth("o_orderdate")
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderdate")
        .filter(day.isin(1, 24, 25))
        .distinct()
        .select(
            F.date_format("o_orderdate", "M/d/yy").alias("Date"),
            F.when(day != 24, "day off").alias("Holiday"),
            F.when((day == 24) | (F.month("o_orderdate") == 12), "short day").alias("Note"),
        )
    )


def geo_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        star_by_product(spark, sf_dir)
        .filter("l_returnflag <> 'R'")
        .select(
            (F.col("o_custkey") % 100000).cast("string").alias("dest_zip"),
            site().alias("fc_code"),
            F.expr("(o_custkey % 100000 * 131 + s_nationkey * 977) % 35000 / 10.0d").alias("distance_mi"),
        )
        .distinct()
    )


def route_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        star_by_product(spark, sf_dir)
        .filter("p_size > 45")
        .select(site().alias("FFMCENTER_NAME"), F.col("p_brand").alias("SHIPMENT_SHIP_ROUTE"), F.col("p_type").alias("RouteType"))
        .distinct()
    )


FOR_ENRICH = (shipment_lines, product_flags, zip_state, route_history)
FOR_FEATURES = (holidays, geo_distance, route_types)
# Small lookups that are groups of large tables here: written first, as they would be tables elsewhere.
GROUPED = (zip_state, holidays, geo_distance, route_types)


def tables(spark: SparkSession, sf_dir: str, makers=(*FOR_ENRICH, *FOR_FEATURES)) -> dict[str, DataFrame]:
    made = {make.__name__: make(spark, sf_dir) for make in makers}
    return made | stage_all({make.__name__: made[make.__name__] for make in makers if make in GROUPED})
