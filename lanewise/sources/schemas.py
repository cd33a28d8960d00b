"""Schemas of the input tables, and the checks that bring a table into its schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names of the input tables.
SHIPMENT_LINES = T.StructType(
    [
        T.StructField("ORDER_ID", T.StringType()),
        T.StructField("SHIPMENT_TRACKING_NUMBER", T.StringType()),
        T.StructField("PRODUCT_KEY", T.StringType()),
        T.StructField("SHIPMENT_COUNT_OF_ITEMS_IN_BOX", T.IntegerType()),
        T.StructField("CARRIER_CODE", T.StringType()),
        T.StructField("FFMCENTER_NAME", T.StringType()),
        T.StructField("RELEASE_DTTM_EST", T.TimestampNTZType()),
        T.StructField("SHIPMENT_SHIPPED_DTTM_EST", T.TimestampNTZType()),
        T.StructField("SHIPMENT_SHIPPED_DATE", T.DateType()),
        T.StructField("SHIPMENT_DELIVERY_DTTM_EST", T.TimestampNTZType()),
        T.StructField("SHIPMENT_DELIVERY_DATE", T.DateType()),
        T.StructField("CUSTOMER_POSTCODE", T.StringType()),
        T.StructField("SHIPMENT_SHIP_ROUTE", T.StringType()),
        T.StructField("SHIPMENT_ESTIMATED_DELIVERY_DATE", T.DateType()),
        T.StructField("STD_ACTUAL", T.IntegerType()),
        T.StructField("STD_V0", T.IntegerType()),
        T.StructField("ACTUAL_ZONE", T.IntegerType()),
        T.StructField("INITIAL_DELIVERY_ATTEMPT_DTTM_EST", T.TimestampNTZType()),
        T.StructField("INITIAL_SHIPMENT_DELIVERY_ATTEMPT_DATE", T.DateType()),
        T.StructField("WAREHOUSE_EXPECTED_WEIGHT", T.DoubleType()),
        T.StructField("WAREHOUSE_EXPECTED_HEIGHT", T.DoubleType()),
        T.StructField("WAREHOUSE_EXPECTED_LENGTH", T.DoubleType()),
        T.StructField("WAREHOUSE_EXPECTED_WIDTH", T.DoubleType()),
    ]
)
PRODUCT_FLAGS = T.StructType(
    [
        T.StructField("product_key", T.StringType()),
        T.StructField("PRODUCT_SHIPPABLE_UOM", T.BooleanType()),
    ]
)
ZIP_STATE = T.StructType([T.StructField("zip", T.StringType()), T.StructField("state_id", T.StringType())])
ROUTE_HISTORY = T.StructType(
    [
        T.StructField("DATE", T.DateType()),
        T.StructField("FCName", T.StringType()),
        T.StructField("RouteID", T.StringType()),
        T.StructField("Zip5", T.StringType()),
        T.StructField("MODE", T.StringType()),
        T.StructField("Cutoff", T.IntegerType()),
        T.StructField("AdjTNT", T.IntegerType()),
        T.StructField("NextAdjTNT", T.IntegerType()),
    ]
)
HOLIDAYS = T.StructType(
    [
        T.StructField("Date", T.StringType()),
        T.StructField("Holiday", T.StringType()),
        T.StructField("Note", T.StringType()),
    ]
)
GEO_DISTANCE = T.StructType(
    [
        T.StructField("dest_zip", T.StringType()),
        T.StructField("fc_code", T.StringType()),
        T.StructField("distance_mi", T.DoubleType()),
    ]
)
ROUTE_TYPES = T.StructType(
    [
        T.StructField("FFMCENTER_NAME", T.StringType()),
        T.StructField("SHIPMENT_SHIP_ROUTE", T.StringType()),
        T.StructField("RouteType", T.StringType()),
    ]
)

TABLES = {
    "shipment_lines": SHIPMENT_LINES,
    "product_flags": PRODUCT_FLAGS,
    "zip_state": ZIP_STATE,
    "route_history": ROUTE_HISTORY,
    "holidays": HOLIDAYS,
    "geo_distance": GEO_DISTANCE,
    "route_types": ROUTE_TYPES,
}


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fail at plan time, with all missing names at once."""
    present = {name.lower() for name in df.columns}
    missing = [name for name in columns if name.lower() not in present]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}; present: {', '.join(df.columns)}")
    return df


def lost_values(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: per column of `schema`, how many values are there but become null in `conform`."""
    require_columns(df, schema.names)
    kept = {field.name: F.col(field.name).try_cast(field.dataType) for field in schema.fields}
    return df.agg(*[F.count_if(F.col(name).isNotNull() & cast.isNull()).alias(name) for name, cast in kept.items()])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of `schema` by name and cast them; text that does not parse becomes null."""
    require_columns(df, schema.names)
    types = {name.lower(): field.dataType for name, field in zip(df.columns, df.schema.fields)}

    def as_declared(field: T.StructField):
        column = F.col(field.name)
        if types[field.name.lower()] != field.dataType:
            column = column.try_cast(field.dataType)
        return column.alias(field.name)

    return df.select(*[as_declared(field) for field in schema.fields])
