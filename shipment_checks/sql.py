"""SQL for DuckDB: the derived tables as named parts, and a helper that puts the needed ones before a query."""

from __future__ import annotations

import re

from lanewise.config import TRAILING_GROUPS, TRAILING_RANGES
from lanewise.operators import trailing_name
from shipment_checks.view import CORE_SITES, LATE_PULL_SITES


def quoted(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


TRANSIT = "((datediff('day', o_orderdate, l_shipdate) % 16) + 16) % 16"
SITE = "'FC' || lpad(cast(s_nationkey as varchar), 2, '0')"
ZIP = "lpad(cast(o_custkey % 100000 as varchar), 5, '0')"
SHIPPED = "l_shipdate + to_seconds((l_orderkey * 7919 + l_linenumber * 3571 + l_partkey) % 86400)"


def seconds_of(code: str) -> str:
    """Seconds of day of an HHMMSS number."""
    return (
        f"case when {code} between 0 and 235959 and ({code} // 100) % 100 < 60 and {code} % 100 < 60 "
        f"then ({code} // 10000) * 3600 + (({code} // 100) % 100) * 60 + {code} % 100 end"
    )


def clock_text(seconds: str) -> str:
    return (
        f"lpad(cast({seconds} // 3600 as varchar), 2, '0') || ':' || "
        f"lpad(cast({seconds} // 60 % 60 as varchar), 2, '0') || ':' || lpad(cast({seconds} % 60 as varchar), 2, '0')"
    )


def after(ship: str, pull: str) -> str:
    return (
        f"case when {pull} < 14400 and {ship} > 14400 then 0 when {ship} > {pull} then 1 else 0 end"
    )


def hours_to(pull: str, ship: str) -> str:
    gap = f"(coalesce({pull}, 0) - {ship})"
    signed = f"(sign({gap}) * ((abs({gap}) * 100 + 1800) // 3600))"
    return f"cast(case when {signed} < 0 then {signed} + 2400 else {signed} end as double) / 100"


def trailing(stat: str, value: str, days: tuple[int, int], group, order: str = "idx") -> str:
    """A window over positions, both ends before the current one."""
    frame = f"range between {-days[0]} preceding and {-days[1]} preceding"
    return f"{stat}({value}) over (partition by {', '.join(group)} order by {order} {frame})"


def trailing_averages(table_groups=TRAILING_GROUPS, value="STD_ACTUAL_VATTEMPTED") -> str:
    return ",\n".join(
        f'coalesce({trailing("avg", value, days, group)}, 1.0) as "{trailing_name("avg", days, value, group).lower()}"'
        for group in table_groups
        for days in TRAILING_RANGES
    )


BANDS = (
    "case when {0} <= 250 then 1 when {0} <= 500 then 2 when {0} <= 1000 then 3 when {0} <= 1500 then 4 "
    "when {0} <= 2000 then 5 when {0} <= 3000 then 6 else 7 end"
)
PULL = f"((({seconds_of('CUTOFF')}) + 3600 * case when FFMCENTER_NAME in ({quoted(LATE_PULL_SITES)}) then 5 else 3 end) % 86400)"
PACKAGE_KEYS = """ORDER_ID, SHIPMENT_TRACKING_NUMBER, SHIPMENT_COUNT_OF_ITEMS_IN_BOX, CARRIER_CODE, FFMCENTER_NAME,
  RELEASE_DTTM_EST, SHIPMENT_SHIPPED_DTTM_EST, SHIPMENT_SHIPPED_DATE, SHIPMENT_DELIVERY_DTTM_EST,
  SHIPMENT_DELIVERY_DATE, CUSTOMER_POSTCODE, SHIPMENT_SHIP_ROUTE, SHIPMENT_ESTIMATED_DELIVERY_DATE, STD_ACTUAL,
  STD_V0, ACTUAL_ZONE, INITIAL_DELIVERY_ATTEMPT_DTTM_EST, INITIAL_SHIPMENT_DELIVERY_ATTEMPT_DATE,
  WAREHOUSE_EXPECTED_WEIGHT"""

PARTS = {
    "star": """
select * from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey join supplier on l_suppkey = s_suppkey join part on l_partkey = p_partkey""",
    "shipments": f"""
select cast(l_orderkey as varchar) as order_id, l_orderkey || '-' || l_linenumber as tracking,
  {SITE} as site, case when n_regionkey <> 0 then n_name end as state, p_brand as route, n_regionkey as zone,
  cast(l_shipdate as date) as ship_date, cast(dayofweek(l_shipdate) as integer) as dow,
  cast({TRANSIT} as integer) as days, l_quantity as weight
from star""",
    "indexed": """
select s.*, c.idx from shipments s join
  (select ship_date, cast(row_number() over (order by ship_date nulls first) as integer) as idx
   from (select distinct ship_date from shipments)) c using (ship_date)""",
    "lines0": f"""
select *, {TRANSIT} as t, {SHIPPED} as shipped,
  {SHIPPED} + to_days(cast({TRANSIT} as integer)) as delivered
from star""",
    "lines1": """
select *, case when l_returnflag <> 'N' then
  case when l_discount > 0.05 then delivered - interval 6 hours else delivered end end as attempted
from lines0""",
    "lines": f"""
select cast(l_orderkey as varchar) as ORDER_ID, l_orderkey || '-' || l_linenumber as SHIPMENT_TRACKING_NUMBER,
  cast(l_partkey as varchar) as PRODUCT_KEY, cast(l_quantity as integer) as SHIPMENT_COUNT_OF_ITEMS_IN_BOX,
  l_returnflag as CARRIER_CODE, {SITE} as FFMCENTER_NAME,
  o_orderdate + to_seconds(o_orderkey * 37 % 86400) as RELEASE_DTTM_EST,
  shipped as SHIPMENT_SHIPPED_DTTM_EST, cast(l_shipdate as date) as SHIPMENT_SHIPPED_DATE,
  delivered as SHIPMENT_DELIVERY_DTTM_EST, cast(delivered as date) as SHIPMENT_DELIVERY_DATE,
  {ZIP} as CUSTOMER_POSTCODE, p_brand as SHIPMENT_SHIP_ROUTE,
  cast(l_shipdate + to_days(cast(t + 1 as integer)) as date) as SHIPMENT_ESTIMATED_DELIVERY_DATE,
  t as STD_ACTUAL, case when l_linestatus <> 'F' then l_partkey % 5 end as STD_V0,
  case when c_mktsegment <> 'MACHINERY' then n_regionkey end as ACTUAL_ZONE,
  attempted as INITIAL_DELIVERY_ATTEMPT_DTTM_EST, cast(attempted as date) as INITIAL_SHIPMENT_DELIVERY_ATTEMPT_DATE,
  l_quantity as WAREHOUSE_EXPECTED_WEIGHT, cast(p_size as double) as WAREHOUSE_EXPECTED_HEIGHT,
  case when l_tax > 0 then l_quantity end as WAREHOUSE_EXPECTED_LENGTH,
  cast(l_linenumber as double) as WAREHOUSE_EXPECTED_WIDTH
from lines1""",
    "flags": """
select cast(p_partkey as varchar) as product_key,
  case when p_size % 5 = 0 then null else p_size % 2 = 0 end as PRODUCT_SHIPPABLE_UOM
from part where p_type <> 'PROMO'""",
    "packages": f"""
select {PACKAGE_KEYS},
  max(case when PRODUCT_SHIPPABLE_UOM then 1 else 0 end) as UOM_flag,
  max(WAREHOUSE_EXPECTED_HEIGHT * WAREHOUSE_EXPECTED_LENGTH * WAREHOUSE_EXPECTED_WIDTH) as package_size
from lines left join flags on lines.PRODUCT_KEY = flags.product_key group by {PACKAGE_KEYS}""",
    "zips": f"""
select {ZIP.replace("o_custkey", "c_custkey")} as zip, min(n_name) as state_id
from customer join nation on c_nationkey = n_nationkey where n_regionkey <> 0 group by 1""",
    "timed": """
select p.* exclude (STD_V0), coalesce(STD_V0, 1) as STD_V0, state_id as CUSTOMER_STATE,
  dayofweek(SHIPMENT_SHIPPED_DATE) as SHIPPED_DOW,
  coalesce(datediff('day', SHIPMENT_SHIPPED_DTTM_EST, INITIAL_DELIVERY_ATTEMPT_DTTM_EST), STD_ACTUAL)
    as STD_ACTUAL_VATTEMPTED
from packages p left join zips on CUSTOMER_POSTCODE = zip where ACTUAL_ZONE is not null""",
    "averaged": f"""
select *, {trailing_averages()}
from timed join
  (select SHIPMENT_SHIPPED_DATE, row_number() over (order by SHIPMENT_SHIPPED_DATE nulls first) as idx
   from (select distinct SHIPMENT_SHIPPED_DATE from timed)) c using (SHIPMENT_SHIPPED_DATE)""",
    "history": f"""
select cast(o_orderdate as date) as "DATE", {SITE} as FCName, p_brand as RouteID, {ZIP} as Zip5, l_returnflag as MODE,
  cast(s // 3600 * 10000 + s // 60 % 60 * 100 + s % 60 as integer) as Cutoff,
  cast(l_quantity as integer) % 7 as AdjTNT, cast(l_quantity as integer) % 7 + 1 + l_linenumber % 2 as NextAdjTNT
from (select *, l_partkey * 617 % 90000 as s from star where l_linestatus = 'O')""",
    "offers": f"""
select * from history where FCName in ({quoted(CORE_SITES)})
qualify row_number() over (partition by "DATE", FCName, RouteID, Zip5, MODE
  order by AdjTNT nulls first, Cutoff nulls first, NextAdjTNT nulls first) = 1""",
    "enriched": f"""
select a.*, cast(RELEASE_DTTM_EST as date) as RELEASE_DATE, Cutoff as CUTOFF, AdjTNT as ADJTNT,
  NextAdjTNT as NEXTADJTNT, {clock_text("(" + seconds_of("Cutoff") + ")")} as CUTOFF_TIMESTAMP,
  case when FFMCENTER_NAME in ({quoted(LATE_PULL_SITES)}) then 'G2' else 'G1' end as FC_TYPE
from averaged a join offers on cast(RELEASE_DTTM_EST as date) = "DATE" and FFMCENTER_NAME = FCName
  and CUSTOMER_POSTCODE = Zip5 and SHIPMENT_SHIP_ROUTE = RouteID and CARRIER_CODE = MODE
where Cutoff is not null""",
    "holidays": """
select distinct cast(o_orderdate as date) as day, case when day(o_orderdate) <> 24 then 'day off' end as Holiday,
  case when day(o_orderdate) = 24 or month(o_orderdate) = 12 then 'short day' end as Note
from orders where day(o_orderdate) in (1, 24, 25)""",
    "geo": f"""
select distinct {ZIP} as dest_zip, {SITE} as fc_code,
  (o_custkey % 100000 * 131 + s_nationkey * 977) % 35000 / 10.0::double as distance_mi
from star where l_returnflag <> 'R'""",
    "routes": f"""
select {SITE} as fc, p_brand as route, min(p_type) as RouteType from star where p_size > 45 group by 1, 2""",
    "clocked": f"""
select *, {PULL} as pull, hour(SHIPMENT_SHIPPED_DTTM_EST) * 3600 + minute(SHIPMENT_SHIPPED_DTTM_EST) * 60
  + second(SHIPMENT_SHIPPED_DTTM_EST) as ship,
  count(SHIPMENT_TRACKING_NUMBER) over (partition by ORDER_ID) as PACKAGE_COUNT_BY_ORDER
from enriched""",
    "featured": f"""
select c.*, {clock_text("coalesce(pull, 0)")} as CPT, {clock_text("ship")} as SHIPMENT_SHIPPED_TS,
  {after("ship", "pull")} as IS_AFTER_CPT, {hours_to("pull", "ship")} as HOURS_TILL_CPT, Holiday, Note,
  case when Note is not null then 'before_holiday' when Holiday is not null then 'holiday' else 'regular' end
    as HOLIDAY_FLAG,
  case SHIPPED_DOW when 5 then 'friday' when 6 then 'saturday' else 'regular' end as SHIPPED_FRI_SAT_TAG,
  distance_mi as DISTANCE_MI, {BANDS.format("distance_mi")} as ARC_RANGE,
  substring(CUSTOMER_POSTCODE, 1, 3) as CUSTOMER_ZIP3, coalesce(RouteType, 'Others') as RouteType
from clocked c left join holidays on SHIPMENT_SHIPPED_DATE = day
  left join geo on CUSTOMER_POSTCODE = dest_zip and FFMCENTER_NAME = fc_code
  left join routes on FFMCENTER_NAME = fc and SHIPMENT_SHIP_ROUTE = route""",
}


def with_parts(query: str) -> str:
    """Put the parts a query names, and those they name, in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in PARTS:
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b", text):
                visit(PARTS[name])
                needed.append(name)

    visit(query)
    if not needed:
        return query.strip()
    if re.match(r"\s*\w+ as \(", query):  # goes on with parts of its own
        query = "," + query.strip()
    return "with " + ",\n".join(f"{name} as ({PARTS[name].strip()})" for name in needed) + "\n" + query.strip()
