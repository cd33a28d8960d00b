"""Every query, next to its SQL. Outputs hold dates and timestamps as text and nullable whole numbers as doubles,
which both engines write alike."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewise import sources
from lanewise.config import ENCODED_COLUMNS, WEEKEND_LABELS, WIDE_GRID, BoostParams, PipelineConfig
from lanewise.functions import calendars, clock, labels
from lanewise.models import boosting
from lanewise.operators import encoding
from lanewise.operators import (
    calendar_index,
    count_over,
    drop_duplicates,
    first_per_key,
    keep_between,
    keep_in,
    keep_present,
    lookup,
    lowercase_columns,
    metrics,
    one_hot,
    quality,
    report,
    roll_up,
    select_columns,
    select_features,
    tag_by_date,
    trailing_stats,
)
from lanewise.operators import by_date as split_by_date
from lanewise.operators.dictionary import dictionary, with_codes
from lanewise.plans import shipments as plan
from lanewise.plans.training import train_and_report
from lanewise.session import staging_path
from shipment_checks import view
from shipment_checks.sql import BANDS, after, clock_text, hours_to, quoted, seconds_of, trailing, with_parts
from shipment_checks.view import CORE_SITES, DATE_RANGES, LATE_PULL_SITES, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if it has one."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = with_parts(sql)
        return function

    return register


def plain(df: DataFrame, doubles: tuple[str, ...] = ()) -> DataFrame:
    """Dates and timestamps as text, the named columns as doubles."""

    def simple(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string")
        elif field.name in doubles:
            column = column.cast("double")
        return column.alias(field.name)

    return df.select(*[simple(field) for field in df.schema.fields])


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items as shipments with the columns the trailing statistics need; the state is null in one region."""
    return view.star(spark, sf_dir).select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("tracking"),
        view.site().alias("site"),
        F.when(F.col("n_regionkey") != 0, F.col("n_name")).alias("state"),
        F.col("p_brand").alias("route"),
        F.col("n_regionkey").alias("zone"),
        F.to_date("l_shipdate").alias("ship_date"),
        calendars.weekday0(F.col("l_shipdate")).alias("dow"),
        view.transit().alias("days"),
        F.col("l_quantity").alias("weight"),
    )


def staged_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`shipments` written once, as trailing statistics read their input several times."""
    return sources.stage(shipments(spark, sf_dir), name="shipments")


GROUPS = [["dow", "site", "state"], ["dow", "route"], ["dow", "zone"]]
RANGES = [(-28, -1), (-7, -1)]
SHIPMENT_COLUMNS = "order_id, tracking, site, state, route, zone, cast(ship_date as varchar) as ship_date, dow, days, weight"


def trailing_sql(stats: list[str], value: str, groups: list[list[str]], ranges: list[tuple[int, int]]) -> str:
    kinds = {"count": "{}", "sum": "cast(coalesce({}, 1) as bigint)" if value == "days" else "coalesce({}, 1)", "min": "coalesce({}, 1)", "max": "coalesce({}, 1)"}
    columns = [
        kinds.get(stat, "coalesce({}, 1.0)").format(trailing(stat, value, days, group))
        + f' as "{stat}_{days[0]}_{days[1]}_{value}_{"_".join(group)}"'
        for group in groups
        for days in ranges
        for stat in stats
    ]
    return f"select {SHIPMENT_COLUMNS}, idx as index, {', '.join(columns)} from indexed"


# --- scans and sinks -------------------------------------------------------------------------------------------


@query("select l_orderkey, l_linenumber, l_returnflag, cast(l_shipdate as varchar) as l_shipdate from lineitem")
def table_scan(spark, sf_dir):
    """A table by its catalog name, brought into a declared schema."""
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("shipment_facts")
    schema = T.StructType(
        [
            T.StructField("l_orderkey", T.LongType()),
            T.StructField("l_linenumber", T.IntegerType()),
            T.StructField("l_returnflag", T.StringType()),
            T.StructField("l_shipdate", T.TimestampNTZType()),
        ]
    )
    return plain(sources.read_table(spark, "shipment_facts", schema))


@query("select p_partkey, p_brand, p_type, p_size, p_retailprice from part")
def parquet_round_trip(spark, sf_dir):
    """Written evenly over 20 files and read back."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    return sources.stage(part, partitions=20, name="parts")


@query("select lpad(cast(c_custkey as varchar), 9, '0') as zip, c_name as name, c_acctbal as balance from customer")
def csv_round_trip(spark, sf_dir):
    """Written as CSV with a header and read back into a schema; codes keep their leading zeros."""
    customer = table(spark, sf_dir, "customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("zip"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
    )
    path = sources.write(customer, staging_path(spark, "csv"), format="csv")
    return sources.read(spark, path, "csv", customer.schema)


_RECORD = "c_custkey || ',' || case when c_custkey % 7 = 0 then c_name else c_nationkey::varchar end || case when c_custkey % 11 = 0 then ',more' else '' end"


@query(
    f"""select cast(c_custkey as double) as key, cast(c_nationkey as double) as nation, null as record, null as reason from customer
      where c_custkey % 7 <> 0 and c_custkey % 11 <> 0
    union all select null, null, {_RECORD}, case when c_custkey % 11 = 0 then 'number of fields' else 'does not parse: nation' end
    from customer where c_custkey % 7 = 0 or c_custkey % 11 = 0"""
)
def csv_bad_records(spark, sf_dir):
    """Records that do not parse go to a table of their own, with text and reason; the others go on."""
    field = F.when(F.col("c_custkey") % 7 == 0, F.col("c_name")).otherwise(F.col("c_nationkey").cast("string"))
    more = F.when(F.col("c_custkey") % 11 == 0, ",more").otherwise("")
    record = F.concat(F.col("c_custkey").cast("string"), F.lit(","), field, more)
    lines = table(spark, sf_dir, "customer").select(record.alias("value")).sortWithinPartitions("value")
    header = spark.createDataFrame([("key,nation",)], "value string")
    path = staging_path(spark, "records")
    header.unionByName(lines).coalesce(1).write.text(path)
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("nation", T.IntegerType())])
    rows, rejected = sources.read_checked(spark, path, schema)
    return plain(report.append(rows, rejected.drop("file")), doubles=("key", "nation"))


# --- lookups ---------------------------------------------------------------------------------------------------


@query(
    """select l_orderkey, l_linenumber, l_partkey, case when PRODUCT_SHIPPABLE_UOM then 1 else 0 end as uom_flag
    from lineitem left join flags on cast(l_partkey as varchar) = product_key"""
)
def product_flag(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_partkey").cast("string").alias("PRODUCT_KEY")
    )
    flags = view.product_flags(spark, sf_dir)
    items = lookup(items, flags, {"PRODUCT_KEY": "product_key"}, ["PRODUCT_SHIPPABLE_UOM"])
    uom_flag = labels.flag(F.col("PRODUCT_SHIPPABLE_UOM")).alias("uom_flag")
    return items.select("l_orderkey", "l_linenumber", "l_partkey", uom_flag)


@query(
    """select c_custkey, c_name, n_name as state from customer
    left join (select * from nation where n_regionkey <> 0) on c_nationkey = n_nationkey"""
)
def lookup_state(spark, sf_dir):
    """Customers keep their row when the state is not in the lookup."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, sf_dir, "nation").filter("n_regionkey <> 0")
    return lookup(customer, nation, {"c_nationkey": "n_nationkey"}, {"n_name": "state"}, on_duplicate="error").drop(
        "c_nationkey"
    )


@query(
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, lowest_price from lineitem
    left join (select l_partkey as p, l_suppkey as s, min(l_extendedprice) as lowest_price from lineitem group by 1, 2)
    on l_partkey = p and l_suppkey = s"""
)
def lookup_first_of_duplicates(spark, sf_dir):
    """Of several rows for a key the lowest value is taken."""
    items = table(spark, sf_dir, "lineitem")
    rows = items.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    prices = {"l_extendedprice": "lowest_price"}
    return lookup(rows, items, ["l_partkey", "l_suppkey"], prices, on_duplicate="first")


@query(
    """select l_orderkey, l_linenumber, l_extendedprice, cast(part as double) as part, p_brand as brand, cast(p_size as double) as size
    from (select *, case when l_orderkey % 3 = 0 then 1 when l_orderkey % 7 = 0 then null else l_partkey end as part from lineitem)
    left join part on part = p_partkey"""
)
def lookup_hot_keys(spark, sf_dir):
    """A third of the rows has one key and a tenth none; both are found on the way and dealt out over several tasks."""
    key = F.when(F.col("l_orderkey") % 3 == 0, 1).when(F.col("l_orderkey") % 7 != 0, F.col("l_partkey"))
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", key.cast("double").alias("part"))
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("double").alias("p_partkey"), "p_brand", "p_size")
    found = lookup(items, parts, {"part": "p_partkey"}, {"p_brand": "brand", "p_size": "size"}, hot_share=0.05)
    return found.withColumn("size", F.col("size").cast("double"))


@query(
    f"""select ORDER_ID as order_id, SHIPMENT_TRACKING_NUMBER as tracking, l.FFMCENTER_NAME as site,
      o.Cutoff as cutoff, o.AdjTNT as adjtnt, cast(o.NextAdjTNT as integer) as nextadjtnt
    from lines l join offers o on cast(RELEASE_DTTM_EST as date) = o."DATE" and FFMCENTER_NAME = o.FCName
      and CUSTOMER_POSTCODE = o.Zip5 and SHIPMENT_SHIP_ROUTE = o.RouteID and CARRIER_CODE = o.MODE
    where o.Cutoff is not null"""
)
def lookup_multi_key_inner(spark, sf_dir):
    """The fastest service offer by five keys; shipments without one drop out."""
    lines = view.shipment_lines(spark, sf_dir).withColumn("day", F.to_date("RELEASE_DTTM_EST"))
    offers = plan.service_offers(view.route_history(spark, sf_dir), view.config())
    offers = sources.stage(keep_present(offers, "Cutoff"), name="offers")
    keys = {
        "day": "DATE",
        "FFMCENTER_NAME": "FCName",
        "CUSTOMER_POSTCODE": "Zip5",
        "SHIPMENT_SHIP_ROUTE": "RouteID",
        "CARRIER_CODE": "MODE",
    }
    found = lookup(lines, offers, keys, {"Cutoff": "cutoff", "AdjTNT": "adjtnt", "NextAdjTNT": "nextadjtnt"}, "inner")
    return found.select(
        F.col("ORDER_ID").alias("order_id"),
        F.col("SHIPMENT_TRACKING_NUMBER").alias("tracking"),
        F.col("FFMCENTER_NAME").alias("site"),
        "cutoff",
        "adjtnt",
        "nextadjtnt",
    )


@query(
    """select l_orderkey, l_linenumber, coalesce(RouteType, 'Others') as routetype
    from star left join routes
    on 'FC' || lpad(cast(s_nationkey as varchar), 2, '0') = routes.fc and p_brand = routes.route"""
)
def route_type_default(spark, sf_dir):
    items = view.star(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", view.site().alias("FFMCENTER_NAME"), F.col("p_brand").alias("SHIPMENT_SHIP_ROUTE")
    )
    types = view.route_types(spark, sf_dir)
    items = lookup(items, types, ["FFMCENTER_NAME", "SHIPMENT_SHIP_ROUTE"], ["RouteType"], on_duplicate="first")
    return items.select(
        "l_orderkey", "l_linenumber", labels.fallback(F.col("RouteType"), "Others").alias("routetype")
    )


@query(
    """select o_orderkey, cast(o_orderdate as varchar) as o_orderdate, Holiday as holiday, Note as note,
      case when Note is not null then 'before_holiday' when Holiday is not null then 'holiday' else 'regular' end
        as holiday_flag
    from orders left join holidays on cast(o_orderdate as date) = day"""
)
def holiday_flag(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.to_date("o_orderdate").alias("day"))
    flagged = plan.with_holidays(orders, view.holidays(spark, sf_dir), "day", out="holiday_flag")
    return lowercase_columns(plain(flagged.drop("day")))


# --- groups, windows, distinct ---------------------------------------------------------------------------------


@query(
    """select l_orderkey, l_linenumber, max(case when p_size % 5 = 0 then 0 when p_size % 2 = 0 then 1 else 0 end) as uom_flag,
      max(l_quantity * p_size * case when l_tax > 0 then l_linenumber end) as package_size
    from lineitem join part on l_partkey = p_partkey group by 1, 2"""
)
def package_roll_up(spark, sf_dir):
    item, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    lines = lookup(item, part, {"l_partkey": "p_partkey"}, ["p_size"], how="inner")
    width = F.when(F.col("l_tax") > 0, F.col("l_linenumber"))
    shippable = F.expr("if(p_size % 5 = 0, null, p_size % 2 = 0)")
    return roll_up(
        lines,
        ["l_orderkey", "l_linenumber"],
        {
            "uom_flag": F.max(labels.flag(shippable)),
            "package_size": F.max(labels.volume(F.col("l_quantity"), F.col("p_size"), width)),
        },
    )


@query(
    """select l_orderkey, l_linenumber, l_partkey,
      count(case when l_returnflag <> 'R' then l_linenumber end) over (partition by l_orderkey) as package_count_by_order
    from lineitem"""
)
def packages_per_order(spark, sf_dir):
    """Packages without a number are not counted."""
    number = F.when(F.col("l_returnflag") != "R", F.col("l_linenumber"))
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", number.alias("tracking")
    )
    return count_over(items, ["l_orderkey"], "tracking", "package_count_by_order").drop("tracking")


@query(
    """select l_suppkey, l_returnflag, l_orderkey, l_linenumber, l_partkey, l_extendedprice from lineitem
    qualify row_number() over (partition by l_suppkey, l_returnflag
      order by nullif(l_discount, 0.05) nulls first, l_extendedprice, l_orderkey, l_linenumber, l_partkey) = 1"""
)
def first_row_per_key(spark, sf_dir):
    """Nulls of the order column come first; the tiebreak settles the rest."""
    order = F.nullif(F.col("l_discount"), F.lit(0.05)).asc_nulls_first()
    tiebreak = [F.col(name).asc() for name in ("l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey")]
    columns = ["l_suppkey", "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    items = table(spark, sf_dir, "lineitem")
    return first_per_key(items, ["l_suppkey", "l_returnflag"], [order], tiebreak).select(*columns)


@query("select distinct l_suppkey, l_returnflag, l_linestatus from lineitem")
def distinct_rows(spark, sf_dir):
    return drop_duplicates(table(spark, sf_dir, "lineitem"), ["l_suppkey", "l_returnflag", "l_linestatus"])


@query(
    """select cast(d as varchar) as ship_date, row_number() over (order by d nulls first) as index
    from (select distinct case when l_linestatus = 'O' then cast(l_shipdate as date) end as d from lineitem)"""
)
def shipping_calendar(spark, sf_dir):
    """Positions of the days on which open lines ship; no date is position 1."""
    day = F.when(F.col("l_linestatus") == "O", F.to_date("l_shipdate"))
    calendar = calendar_index(table(spark, sf_dir, "lineitem").select(day.alias("ship_date")), "ship_date")
    return plain(calendar.withColumn("index", F.col("index").cast("long")))


@query(trailing_sql(["avg"], "days", GROUPS, RANGES))
def trailing_avg(spark, sf_dir):
    return plain(trailing_stats(staged_shipments(spark, sf_dir), ["days"], GROUPS, RANGES, "ship_date"))


@query(trailing_sql(["sum", "count", "min", "max"], "weight", GROUPS[1:], RANGES))
def trailing_sum_count_min_max(spark, sf_dir):
    stats = ["sum", "count", "min", "max"]
    return plain(trailing_stats(staged_shipments(spark, sf_dir), ["weight"], GROUPS[1:], RANGES, "ship_date", stat=stats))


WIDE_STATS, WIDE_RANGES = ["avg", "count", "min", "max"], [(-365, -1)]


@query(trailing_sql(WIDE_STATS, "days", [["zone"], ["dow", "route"]], WIDE_RANGES))
def trailing_wide(spark, sf_dir):
    """Ranges of a year of days, from prefix sums and from a table of ranges whose lengths are powers of two."""
    df = staged_shipments(spark, sf_dir)
    return plain(trailing_stats(df, ["days"], [["zone"], ["dow", "route"]], WIDE_RANGES, "ship_date", stat=WIDE_STATS))


def _known(stat: str, days: tuple[int, int], group: list[str]) -> str:
    """The statistic of shipments delivered by the row's own day."""
    same = " and ".join(f"o.{name} = s.{name}" for name in group)
    found = f"""(select {stat}(o.days) from indexed o where {same} and o.idx between s.idx - {-days[0]} and s.idx - {-days[1]}
      and o.ship_date + o.days <= s.ship_date)"""
    other = {"avg": "1.0", "sum": "1", "count": "0"}[stat]
    kind = "double" if stat == "avg" else "bigint"
    return f'cast(coalesce({found}, {other}) as {kind}) as "{stat}_{days[0]}_{days[1]}_days_{"_".join(group)}"'


_KNOWN = ", ".join(_known(stat, days, group) for group in GROUPS[1:] for days in RANGES for stat in ("avg", "sum", "count"))


@query(f"select tracking, cast(ship_date as varchar) as ship_date, dow, route, zone, days, idx as index, {_KNOWN} from indexed s")
def trailing_known(spark, sf_dir):
    """Trailing statistics over shipments that had been delivered by the row's day: nothing is known before its time."""
    df = shipments(spark, sf_dir).select("tracking", "ship_date", "dow", "route", "zone", "days")
    df = sources.stage(df.withColumn("delivered", F.expr("date_add(ship_date, days)")), name="shipments")
    stats = ["avg", "sum", "count"]
    return plain(trailing_stats(df, ["days"], GROUPS[1:], RANGES, "ship_date", stat=stats, known_by="delivered").drop("delivered"))


@query(
    f"""select tracking, cast(ship_date as varchar) as ship_date, route,
      round(coalesce({trailing("stddev", "weight", (-28, -1), ["dow", "route"])}, 1.0), 6) as spread_28
    from indexed"""
)
def trailing_stddev(spark, sf_dir):
    df = trailing_stats(staged_shipments(spark, sf_dir), ["weight"], [["dow", "route"]], [(-28, -1)], "ship_date", "stddev")
    spread = F.round("`stddev_-28_-1_weight_dow_route`", 6).alias("spread_28")
    return plain(df.select("tracking", "ship_date", "route", spread))


@query(
    """select count(*) as row_count, (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem))
        as key_count,
      count(*) filter (where l_orderkey is null) as nulls_l_orderkey,
      count(*) filter (where l_linenumber is null) as nulls_l_linenumber,
      count(*) filter (where nullif(l_tax, 0) is null) as nulls_l_tax, 3 as column_count
    from lineitem"""
)
def dataset_profile(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif(F.col("l_tax"), F.lit(0.0)).alias("l_tax")
    )
    return quality.profile(items, ["l_orderkey", "l_linenumber"])


# --- columns ---------------------------------------------------------------------------------------------------


@query(
    """select l_orderkey, l_linenumber, l_partkey, cast(coalesce(
      datediff('day', case when l_returnflag <> 'R' then o_orderdate end, l_shipdate), l_linenumber) as integer) as days
    from lineitem join orders on l_orderkey = o_orderkey"""
)
def transit_days_with_fallback(spark, sf_dir):
    item, order = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    df = lookup(item, order, {"l_orderkey": "o_orderkey"}, ["o_orderdate"], how="inner")
    start = F.when(F.col("l_returnflag") != "R", F.col("o_orderdate"))
    days = labels.fallback(calendars.days_between(F.col("l_shipdate"), start), F.col("l_linenumber"))
    return df.select("l_orderkey", "l_linenumber", "l_partkey", days.alias("days"))


_CODE = "(event_id * 617 % 90000 // 3600 * 10000 + event_id * 617 % 90000 // 60 % 60 * 100 + event_id * 617 % 60)"


@query(
    f"""select event_id, cast(code as double) as code, {clock_text("pull")} as pull_time, {clock_text("ship")} as ship_time,
      {after("ship", "pull")} as is_after_cpt, {hours_to("pull", "ship")} as hours_till_cpt
    from (select *, ({seconds_of("code")} + 3600 * case when event_type = 'click' then 5 else 3 end) % 86400 as pull
      from (select *, event_id * 617 % 90000 as s, hour(ts) * 3600 + minute(ts) * 60 + second(ts) as ship,
        case when event_type <> 'error' then s // 3600 * 10000 + s // 60 % 60 * 100 + s % 60 end as code from events))"""
)
def clock_features(spark, sf_dir):
    """Cutoffs are numbers such as 153000; some are missing and some are past midnight, which is no time of day."""
    code = F.expr("floor(s / 3600) * 10000 + floor(s / 60) % 60 * 100 + s % 60")
    events = table(spark, sf_dir, "events").withColumn("s", F.expr("event_id * 617 % 90000"))
    events = events.withColumn("code", F.when(F.col("event_type") != "error", code).cast("int"))
    hours = labels.flag_in(F.col("event_type"), ["click"], 5, 3)
    events = events.withColumn("ship", clock.seconds_of_day(F.col("ts")))
    events = events.withColumn("pull", clock.shift(clock.from_hhmmss(F.col("code")), hours))
    ship, pull = F.col("ship"), F.col("pull")
    return events.select(
        "event_id",
        F.col("code").cast("double").alias("code"),
        clock.format_clock(pull).alias("pull_time"),
        clock.format_clock(ship).alias("ship_time"),
        clock.is_after(ship, pull).alias("is_after_cpt"),
        clock.hours_until(pull, ship).alias("hours_till_cpt"),
    )


@query(
    """select l_orderkey, l_linenumber, l_partkey, cast(dayofweek(l_shipdate) as integer) as shipped_dow,
      case dayofweek(l_shipdate) when 5 then 'friday' when 6 then 'saturday' else 'regular' end as shipped_fri_sat_tag
    from lineitem"""
)
def weekday_and_tag(spark, sf_dir):
    weekday = calendars.weekday0(F.col("l_shipdate"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        weekday.alias("shipped_dow"),
        labels.label_values(weekday, WEEKEND_LABELS, "regular").alias("shipped_fri_sat_tag"),
    )


@query(
    f"""select o_orderkey, cast(o_orderdate as varchar) as day, strftime(o_orderdate, '%-m/%-d/%y') as text
    from orders"""
)
def parsed_dates(spark, sf_dir):
    """Dates from text such as 7/4/95, and the text they came from."""
    text = F.date_format("o_orderdate", "M/d/yy").alias("text")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", text)
    day = F.date_format(calendars.parse_mdy(F.col("text")), "yyyy-MM-dd HH:mm:ss")
    return orders.withColumn("day", day)


@query(
    f"""select l_orderkey, l_linenumber, l_partkey, distance as distance_mi, {BANDS.format("distance")} as arc_range
    from (select *, case when l_returnflag <> 'R' then (l_partkey * 131 + l_suppkey * 977) % 35000 / 10.0::double end
      as distance from lineitem)"""
)
def distance_band(spark, sf_dir):
    """Without a distance the last band is taken."""
    distance = F.expr("if(l_returnflag <> 'R', (l_partkey * 131 + l_suppkey * 977) % 35000 / 10.0d, null)")
    items = table(spark, sf_dir, "lineitem").withColumn("distance_mi", distance)
    band = labels.band(F.col("distance_mi"), view.config().distance_bounds)
    return items.select("l_orderkey", "l_linenumber", "l_partkey", "distance_mi", band.alias("arc_range"))


@query(
    """select c_custkey, lpad(cast(c_custkey * 37 as varchar), 5, '0') as zip,
      substring(lpad(cast(c_custkey * 37 as varchar), 5, '0'), 1, 3) as zip3 from customer"""
)
def zip_pad_prefix(spark, sf_dir):
    padded = labels.pad_zip(F.col("c_custkey") * 37)
    return table(spark, sf_dir, "customer").select(
        "c_custkey", padded.alias("zip"), labels.prefix(padded, 3).alias("zip3")
    )


@query(
    f"""select s_suppkey, fc, case when fc in ({quoted(LATE_PULL_SITES)}) then 'G2' else 'G1' end as fc_type
    from (select s_suppkey, 'FC' || lpad(cast(s_nationkey as varchar), 2, '0') as fc from supplier)
    where fc in ({quoted(CORE_SITES)})"""
)
def fc_class(spark, sf_dir):
    """Core sites and their class."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", view.site().alias("fc"))
    return keep_in(suppliers, "fc", CORE_SITES).withColumn(
        "fc_type", labels.flag_in(F.col("fc"), LATE_PULL_SITES, "G2", "G1")
    )


@query("select order_id, tracking, days, zone from shipments where days >= 0 and days < 11 and state is not null")
def outlier_filter(spark, sf_dir):
    df = keep_between(keep_present(shipments(spark, sf_dir), "state"), "days", 0, 11)
    return df.select("order_id", "tracking", "days", "zone")


@query(
    """select o_orderkey,
      cast(substring(o_orderpriority, 1, 1) as double) as level,
      try_cast(o_orderpriority as double) as level_of_all,
      try_cast(cast(o_totalprice as varchar) as double) as price
    from orders"""
)
def typed_casts(spark, sf_dir):
    """Text that is no number becomes null."""
    priority = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        labels.to_int(labels.prefix(priority, 1)).cast("double").alias("level"),
        labels.to_int(priority).cast("double").alias("level_of_all"),
        labels.to_double(F.col("o_totalprice").cast("string")).alias("price"),
    )


@query("select o_orderkey, o_custkey, o_orderpriority from orders")
def lower_case_select(spark, sf_dir):
    """Upper-case columns, lowered, and all but some of them taken."""
    orders = table(spark, sf_dir, "orders")
    orders = lowercase_columns(orders.toDF(*[name.upper() for name in orders.columns]))
    kept = select_features(orders.columns, ["o_orderstatus", "o_totalprice", "o_orderdate"])
    return select_columns(orders, kept)


@query(
    """select o_orderkey, o_orderpriority, dow,
      case when o_orderpriority = '1-URGENT' then 1 else 0 end as "o_orderpriority_1-URGENT",
      case when o_orderpriority = '2-HIGH' then 1 else 0 end as "o_orderpriority_2-HIGH",
      case when o_orderpriority = '3-MEDIUM' then 1 else 0 end as "o_orderpriority_3-MEDIUM",
      case when o_orderpriority = '4-NOT SPECIFIED' then 1 else 0 end as "o_orderpriority_4-NOT SPECIFIED",
      case when o_orderpriority = '5-LOW' then 1 else 0 end as "o_orderpriority_5-LOW","""
    + ", ".join(f"case when dow = {day} then 1 else 0 end as dow_{day}" for day in range(7))
    + """ from (select *, cast(dayofweek(o_orderdate) as integer) as dow from orders)"""
)
def one_hot_columns(spark, sf_dir):
    dow = calendars.weekday0(F.col("o_orderdate")).alias("dow")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", dow)
    return one_hot(orders, ["o_orderpriority", "dow"])[0]


@query(
    """select distinct 'p_brand' as col, p_brand as value from part
    union all select distinct 'p_type', p_type from part"""
)
def encoded_values(spark, sf_dir):
    """The values one-hot encoding finds, as rows."""
    return encoding.encoded_values(table(spark, sf_dir, "part"), ["p_brand", "p_type"])


@query(
    """select p_partkey, cast(dense_rank() over (order by p_name) - 1 as double) as p_name_code,
      case when p_size % 5 > 0 then cast(b.code as double) end as brand_code
    from part left join (select p_brand, row_number() over (order by p_brand) - 1 as code
      from (select distinct p_brand from part where p_size % 5 > 0)) b using (p_brand)"""
)
def category_codes(spark, sf_dir):
    """Dense codes of a column with a value for nearly each row, and of one with nulls, from a dictionary that is a table."""
    brand = F.when(F.col("p_size") % 5 > 0, F.col("p_brand")).alias("brand")
    part = sources.stage(table(spark, sf_dir, "part").select("p_partkey", "p_name", brand), name="parts")
    known = dictionary(part, ["p_name", "brand"])
    return plain(with_codes(part, known, ["p_name", "brand"]).drop("p_name", "brand"), doubles=("p_name_code", "brand_code"))


_TAGS = " ".join(
    f"when o_orderdate >= date '{start}' and o_orderdate < date '{end}' then '{name}'"
    for name, (start, end) in DATE_RANGES.items()
)


@query(
    f"""select o_orderkey, cast(o_orderdate as varchar) as o_orderdate, tag
    from (select *, case {_TAGS} end as tag from orders) where tag is not null"""
)
def date_split(spark, sf_dir):
    """The rows of all date ranges with the range's name, from one scan each."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    parts = split_by_date(orders, "o_orderdate", DATE_RANGES)
    return plain(report.append(*[df.withColumn("tag", F.lit(name)) for name, df in parts.items()]))


@query(f"select tag, count(*) as row_count from (select case {_TAGS} end as tag from orders) where tag is not null group by tag")
def date_split_counts(spark, sf_dir):
    """Rows per date range, from one scan."""
    return tag_by_date(table(spark, sf_dir, "orders"), "o_orderdate", DATE_RANGES).groupBy("tag").agg(
        F.count("*").alias("row_count")
    )


# --- scores and report -----------------------------------------------------------------------------------------

_MEAN = trailing("avg", "days", (-28, -1), ["dow", "zone"])
_SPLIT = " ".join(
    f"when ship_date >= date '{start}' and ship_date < date '{end}' then '{name}'"
    for name, (start, end) in DATE_RANGES.items()
)
_EPSILON = "2.220446049250313e-16"


def with_trailing_mean(spark, sf_dir) -> DataFrame:
    df = trailing_stats(staged_shipments(spark, sf_dir), ["days"], [["dow", "zone"]], [(-28, -1)], "ship_date")
    return df.withColumnRenamed("avg_-28_-1_days_dow_zone", "ml_pred")


@query(
    f"""select tag, count(*) as row_count, round(avg(case when round_even(pred, 0) = days then 1.0 else 0.0 end), 9)
        as exact_match,
      round(avg(abs(days - pred)), 9) as mae,
      round(avg(abs((days + 0.01::double) - (pred + 0.01::double))
        / greatest(abs(days + 0.01::double), {_EPSILON}::double)), 6) as mape
    from (select *, case {_SPLIT} end as tag, coalesce({_MEAN}, 1.0) as pred from indexed)
    where tag is not null group by tag"""
)
def exact_match_and_mape(spark, sf_dir):
    """How well the trailing mean alone predicts transit days, per date range."""
    df = tag_by_date(with_trailing_mean(spark, sf_dir), "ship_date", DATE_RANGES)
    rows = metrics.scores(df, "days", "ml_pred", ["tag"])
    return rows.select(
        "tag",
        "row_count",
        F.round("exact_match", 9).alias("exact_match"),
        F.round("mae", 9).alias("mae"),
        F.round("mape", 6).alias("mape"),
    )


@query(
    f"""select order_id, tracking, site, cast(ship_date as varchar) as ship_date, days, tag, pred as ml_pred,
      round_even(pred, 0) as ml_pred_rounded
    from (select *, case {_SPLIT} end as tag, coalesce({_MEAN}, 1.0) as pred from indexed) where tag is not null"""
)
def prediction_report(spark, sf_dir):
    """The trailing mean as prediction, train and test rows under each other."""
    df = with_trailing_mean(spark, sf_dir)
    df = df.withColumn("ml_pred_rounded", labels.round_half_even(F.col("ml_pred")))
    columns = ["order_id", "tracking", "site", "ship_date", "days", "tag", "ml_pred", "ml_pred_rounded"]
    return plain(report.build(split_by_date(df, "ship_date", DATE_RANGES), columns))


# --- the whole job ---------------------------------------------------------------------------------------------

_ENRICHED_TEXT = """order_id shipment_tracking_number carrier_code ffmcenter_name release_dttm_est
  shipment_shipped_dttm_est shipment_shipped_date shipment_delivery_dttm_est shipment_delivery_date customer_postcode
  shipment_ship_route shipment_estimated_delivery_date initial_delivery_attempt_dttm_est
  initial_shipment_delivery_attempt_date customer_state release_date cutoff_timestamp fc_type""".split()
_ENRICHED_NUMBERS = """shipment_count_of_items_in_box std_actual std_v0 actual_zone warehouse_expected_weight
  uom_flag package_size shipped_dow std_actual_vattempted cutoff adjtnt nextadjtnt""".split()
_FEATURE_TEXT = "cpt shipment_shipped_ts holiday note holiday_flag shipped_fri_sat_tag customer_zip3 routetype".split()
_FEATURE_NUMBERS = "package_count_by_order is_after_cpt hours_till_cpt distance_mi arc_range".split()
_AVERAGES = [name for name in view.config().model_columns if name.startswith("avg_")]
_ENRICHED_SQL = ", ".join(
    [f"cast({name} as varchar) as {name}" for name in _ENRICHED_TEXT]
    + [f"cast({name} as double) as {name}" for name in _ENRICHED_NUMBERS]
    + [f'"{name}"' for name in _AVERAGES]
)
_FEATURE_SQL = ", ".join(
    [f"{name} as {name}" for name in _FEATURE_TEXT] + [f"cast({name} as double) as {name}" for name in _FEATURE_NUMBERS]
)


@query(f"select {_ENRICHED_SQL}, cast(idx as double) as index from enriched")
def enriched_shipments(spark, sf_dir):
    """Shipment lines to packages with state, trailing averages and service offer."""
    df = plan.enrich(view.tables(spark, sf_dir, view.FOR_ENRICH), view.config())
    return plain(lowercase_columns(df), doubles=(*_ENRICHED_NUMBERS, "index"))


@query(f"select {_ENRICHED_SQL}, cast(idx as double) as index, {_FEATURE_SQL} from featured")
def shipment_features(spark, sf_dir):
    """Enriched packages with clock, holiday, distance and route features."""
    tables, cfg = view.tables(spark, sf_dir), view.config()
    df = plan.features(sources.stage(plan.enrich(tables, cfg), name="reporting"), tables, cfg)
    return plain(lowercase_columns(df), doubles=(*_ENRICHED_NUMBERS, "index", *_FEATURE_NUMBERS))


def model_sets_of(spark, sf_dir) -> dict[str, DataFrame]:
    tables, cfg = view.tables(spark, sf_dir), view.config()
    reporting = sources.stage(plan.enrich(tables, cfg), name="reporting")
    return plan.model_sets(sources.stage(plan.features(reporting, tables, cfg), name="enriched"), cfg)


_TEXT_OUT = set(_ENRICHED_TEXT + _FEATURE_TEXT)
_MODEL_SQL = ", ".join(
    f'cast("{name}" as varchar) as "{name}"' if name in _TEXT_OUT else f'cast("{name}" as double) as "{name}"'
    for name in view.config().model_columns
)
_DELIVERED = _SPLIT.replace("ship_date", "shipment_delivery_date")
_INDICATORS = {
    "ffmcenter_name": CORE_SITES,
    "fc_type": ("G1", "G2"),
    "holiday_flag": ("before_holiday", "holiday", "regular"),
    "shipped_fri_sat_tag": ("friday", "regular", "saturday"),
    "carrier_code": ("A", "N", "R"),
    "shipped_dow": tuple(range(7)),
    "routetype": ("ECONOMY", "LARGE", "MEDIUM", "Others", "PROMO", "SMALL", "STANDARD"),
}
_INDICATOR_SQL = ", ".join(
    f"case when cast({col} as varchar) = '{value}' then 1.0 else 0.0 end::double as \"{col}_{value}\""
    for col in ENCODED_COLUMNS
    for value in _INDICATORS[col]
)


@query(
    f"""select {_MODEL_SQL}, {_INDICATOR_SQL}, case {_DELIVERED} end as tag from featured
    where std_actual_vattempted >= 0 and std_actual_vattempted < 11 and case {_DELIVERED} end is not null"""
)
def model_sets(spark, sf_dir):
    """Encoded train and test sets by delivery date, tagged."""
    parts = [df.withColumn("tag", F.lit(name)) for name, df in model_sets_of(spark, sf_dir).items()]
    df = report.append(*parts)
    numbers = [name for name, kind in df.dtypes if kind in ("int", "bigint")]
    return plain(df, doubles=tuple(numbers))


# --- models -----------------------------------------------------------------------------------------

MODEL_FEATURES = ["state", "weight", "zone", "dow", *[f"avg_{lo}_{hi}_days_dow_zone" for lo, hi in RANGES]]


def model_input(spark, sf_dir) -> DataFrame:
    """Shipments with trailing means, staged because training reads them many times."""
    df = trailing_stats(staged_shipments(spark, sf_dir), ["days"], [["dow", "zone"]], RANGES, "ship_date")
    return sources.stage(keep_between(df, "days", 0, 11), name="model-input")


_TRAINED = {}


def base_model(spark, sf_dir):
    """The staged input and the model with the standard parameters, trained once per application for all queries that use it."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _TRAINED:
        df = model_input(spark, sf_dir)
        _TRAINED[at] = df, boosting.fit(df, MODEL_FEATURES, "days", ["state"], PipelineConfig().boost)
    return _TRAINED[at]


_CUTS = " union all ".join(
    f"""select '{name}' as name, {name} as cut, sum(count(*)) over w as n, sum(sum(days)) over w as s
    from shipments where days >= 0 and days < 11 group by {name} window w as (order by {name})"""
    for name in ("dow", "zone")
)


@query(
    f"""with_totals as (select count(*) as n, sum(days) as s from shipments where days >= 0 and days < 11),
    cuts as ({_CUTS}),
    best as (select name, cut, c.s / c.n::double as low, (t.s - c.s) / (t.n - c.n)::double as high
      from cuts c, with_totals t where c.n < t.n
      order by c.s * c.s / c.n::double + (t.s - c.s) * (t.s - c.s) / (t.n - c.n)::double desc limit 1)
    select tracking, dow, zone, days,
      round(case when (case name when 'dow' then dow else zone end) <= cut then low else high end, 9) as ml_pred
    from shipments, best where days >= 0 and days < 11"""
)
def single_split_predictions(spark, sf_dir):
    """One tree of one split on all rows and features, whose best split SQL can find as well."""
    df = stump_input(spark, sf_dir)
    stump = BoostParams(rounds=1, max_depth=1, step_size=1.0, row_fraction=1.0, column_fraction=1.0)
    scored = boosting.predict(boosting.fit(df, ["dow", "zone"], "days", [], stump), df, "ml_pred")
    return scored.withColumn("ml_pred", F.round("ml_pred", 9))


STUMPS = BoostParams(rounds=3, max_depth=1, step_size=0.5, row_fraction=1.0, column_fraction=1.0)


def _stump(at: str, rows: str, features: dict[str, str], residual: str) -> str:
    """The split of `rows` with the largest gain for a residual, as CTE `at`; features are given with their SQL."""
    cuts = " union all ".join(
        f"""select '{name}' as name, {value} as cut, sum(count(*)) over w as n, sum(sum({residual})) over w as s
        from {rows} group by {value} window w as (order by {value})"""
        for name, value in features.items()
    )
    return f"""{at} as (select name, cut, c.s / c.n::double as low, (t.s - c.s) / (t.n - c.n)::double as high,
      c.s * c.s / c.n::double + (t.s - c.s) * (t.s - c.s) / (t.n - c.n)::double - t.s * t.s / t.n::double as gain
      from ({cuts}) c, (select count(*) as n, sum({residual}) as s from {rows}) t where c.n < t.n
      order by gain desc limit 1)"""


_ROWS = """with_rows as (select tracking, dow, zone, days, cast(order_id as integer) % 3 as part, 0.0::double as pred
  from shipments where days >= 0 and days < 11)"""


def _boosted_stumps(mark: str = "", learn: str = "true", score: str = "true") -> str:
    """CTEs round0 to round3, with the predictions after so many trees, and best1 to best3, their splits.

    Splits are found in the rows that `learn` picks; rounds hold those and the rows that `score` picks. `mark` is put behind
    the names.
    """
    parts = [f"round0{mark} as (select *, {learn} as learn from with_rows where {learn} or {score})"]
    for i in range(1, STUMPS.rounds + 1):
        weight = 1.0 if i == 1 else STUMPS.step_size
        rows = f"(select * from round{i - 1}{mark} where learn)"
        parts.append(_stump(f"best{i}{mark}", rows, {"dow": "dow", "zone": "zone"}, "(days - pred)"))
        parts.append(f"""round{i}{mark} as (select tracking, dow, zone, days, part, pred + {weight}::double *
          case when (case name when 'dow' then dow else zone end) <= cut then low else high end as pred, learn
          from round{i - 1}{mark}, best{i}{mark})""")
    return ", ".join(parts if mark else [_ROWS, *parts])


def stump_input(spark, sf_dir) -> DataFrame:
    df = keep_between(shipments(spark, sf_dir), "days", 0, 11).select("tracking", "dow", "zone", "days")
    return sources.stage(df, name="stump-input")


def boosted_stumps_of(df: DataFrame):
    return boosting.fit(df, ["dow", "zone"], "days", [], STUMPS)


@query(f"{_boosted_stumps()} select tracking, dow, zone, days, round(pred, 9) as ml_pred from round3")
def boosted_stumps(spark, sf_dir):
    """Three trees of one split on all rows: the size is the query's definition, since SQL can find each split as well."""
    df = stump_input(spark, sf_dir)
    scored = boosting.predict(boosted_stumps_of(df), df, "ml_pred")
    return scored.withColumn("ml_pred", F.round("ml_pred", 9))


_BEST = " union all ".join(f"select name, {1 if i == 1 else 4} * gain as gain from best{i}" for i in range(1, STUMPS.rounds + 1))


@query(f"{_boosted_stumps()} select name as feature, count(*) as importance from ({_BEST}) group by name")
def stump_split_counts(spark, sf_dir):
    """How many of the three splits use each feature."""
    return boosting.split_counts(boosted_stumps_of(stump_input(spark, sf_dir)))


@query(
    f"""{_boosted_stumps()} select f.feature, round(coalesce(sum(b.gain), 0) / (select sum(gain) from ({_BEST})), 9) as importance
    from (values ('dow'), ('zone')) f(feature) left join ({_BEST}) b on b.name = f.feature group by f.feature"""
)
def stump_gain_importances(spark, sf_dir):
    """Share of each feature in the gain of the three splits; later trees are fitted to twice the residual."""
    shares = boosting.importances(boosted_stumps_of(stump_input(spark, sf_dir)))
    return shares.withColumn("importance", F.round("importance", 9))


@query(
    f"""{_boosted_stumps()}, first_model as (select *, round_even(pred, 0) as ml_model from round3),
    {_stump("second", "first_model", {"dow": "dow", "ml_model": "ml_model"}, "days::double")}
    select tracking, days, round(pred, 9) as ml_pred, ml_model as ml_pred_rounded,
      round(case when (case name when 'dow' then dow::double else ml_model end) <= cut then low else high end, 9) as ensemble_pred
    from first_model, second"""
)
def stacked_stumps(spark, sf_dir):
    """A second model of one split, on the weekday and the rounded predictions of the first."""
    df = stump_input(spark, sf_dir)
    base = boosted_stumps_of(df)
    one = BoostParams(rounds=1, max_depth=1, step_size=1.0, row_fraction=1.0, column_fraction=1.0)
    scored = boosting.with_predictions(df, base, boosting.stack(df, base, ["dow"], "days", [], one))
    rounded = [F.round(name, 9).alias(name) for name in ("ml_pred", "ensemble_pred")]
    return scored.select("tracking", "days", "ml_pred_rounded", *rounded)


_PARTS = range(3)
_UNSEEN = " union all ".join(f"select * from round3_{k} where not learn" for k in _PARTS)


@query(
    f"""{_boosted_stumps()}, {", ".join(_boosted_stumps(f"_{k}", f"part <> {k}") for k in _PARTS)},
    unseen as (select *, round_even(pred, 0) as ml_model from ({_UNSEEN})),
    {_stump("second", "unseen", {"dow": "dow", "ml_model": "ml_model"}, "days::double")}
    select r.tracking, r.days, r.part, round(r.pred, 9) as ml_pred, round(u.pred, 9) as unseen_pred, round(case when
      (case name when 'dow' then r.dow::double else round_even(r.pred, 0) end) <= cut then low else high end, 9) as ensemble_pred
    from (select *, row_number() over (partition by tracking, dow, zone, days order by pred) as copy from round3) r
    join (select *, row_number() over (partition by tracking, dow, zone, days order by pred) as copy from unseen) u
      on r.tracking = u.tracking and r.dow = u.dow and r.zone = u.zone and r.days = u.days and r.copy = u.copy, second"""
)
def stacked_out_of_fold(spark, sf_dir):
    """A second model that learns from predictions of models which had not seen the row: parts by order number."""
    part = (F.col("order_id").cast("int") % 3).alias("part")
    df = keep_between(shipments(spark, sf_dir), "days", 0, 11).select("tracking", "dow", "zone", "days", part)
    df = sources.stage(df, name="stump-input")
    base = boosted_stumps_of(df)
    unseen = boosting.cross_fit(df, boosting.recipe(base), 3, "part", "unseen_pred").drop("fold")
    one = BoostParams(rounds=1, max_depth=1, step_size=1.0, row_fraction=1.0, column_fraction=1.0)
    stacked = boosting.stack(df, base, ["dow"], "days", [], one, out_of_fold=3, fold_col="part", unseen=unseen)
    scored = boosting.with_predictions(unseen, base, stacked)
    rounded = [F.round(name, 9).alias(name) for name in ("ml_pred", "unseen_pred", "ensemble_pred")]
    return scored.select("tracking", "days", "part", *rounded)


@query()
def gbt_predictions(spark, sf_dir):
    df, base = base_model(spark, sf_dir)
    return plain(boosting.predict(base, boosting.spread(df), "ml_pred").select("tracking", "ship_date", "days", "ml_pred"))


@query()
def gbt_tuned(spark, sf_dir):
    """Mean error of each point of the wide grid over three folds, with the standard parameters besides."""
    model = boosting.tune(model_input(spark, sf_dir), MODEL_FEATURES, "days", ["state"], WIDE_GRID, PipelineConfig().boost)
    return boosting.grid_scores(model, WIDE_GRID)


@query()
def stacked_predictions(spark, sf_dir):
    """The standard second model, on few features and the first one's rounded predictions."""
    df, base = base_model(spark, sf_dir)
    stacked = boosting.stack(df, base, ["state", "weight", "dow"], "days", ["state"], PipelineConfig().stack_boost)
    scored = boosting.with_predictions(boosting.spread(df), base, stacked)
    names = ["ml_pred", "ml_pred_rounded", "ensemble_pred", "ensemble_pred_rounded"]
    return plain(scored.select("tracking", "ship_date", "days", *names))


@query()
def split_counts(spark, sf_dir):
    return boosting.split_counts(base_model(spark, sf_dir)[1])


@query()
def gain_importances(spark, sf_dir):
    return boosting.importances(base_model(spark, sf_dir)[1])


@query()
def training_report(spark, sf_dir):
    """The whole job: shipment lines to the report of both models' predictions, with the standard parameters."""
    sets = {name: sources.stage(df, name=name) for name, df in model_sets_of(spark, sf_dir).items()}
    return plain(train_and_report(sets["train_val"], sets["test"], view.config()).report)
