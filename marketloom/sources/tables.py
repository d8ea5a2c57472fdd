"""The five marketplace tables: schemas, checks, loading and quarantine of bad rows."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Required columns per table and columns a customer table must not hold.
REQUIRED_COLUMNS = {
    "customers": ["customer_id", "customer_type", "postcode_area"],
    "producers": ["producer_id", "producer_name", "postcode_area"],
    "products": [
        "product_id",
        "product_name",
        "category",
        "producer_id",
        "seasonal_start_month",
        "seasonal_end_month",
        "base_price",
    ],
    "orders": ["order_id", "customer_id", "order_date", "total_amount"],
    "order_items": ["order_id", "product_id", "quantity", "unit_price"],
}
PERSONAL_COLUMNS = [
    "name",
    "first_name",
    "last_name",
    "email",
    "phone",
    "telephone",
    "address",
    "full_address",
    "delivery_address",
]

#: Columns read as text and cast afterwards, so that one bad value costs a null and not the load.
COERCED = {
    "products": {"seasonal_start_month": "int", "seasonal_end_month": "int", "base_price": "double", "stock_quantity": "double"},
    "orders": {"order_date": "date", "total_amount": "double"},
    "order_items": {"quantity": "double", "unit_price": "double"},
}
OPTIONAL_COLUMNS = {
    "products": ["description", "unit", "allergen_info", "stock_quantity", "availability_status"],
}


class TableError(ValueError):
    """A table is missing, lacks a column, or holds personal data."""


@dataclass(frozen=True)
class Tables:
    """The five tables as lazy DataFrames."""

    customers: DataFrame
    producers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_items: DataFrame

    def with_(self, **changed: DataFrame) -> "Tables":
        return replace(self, **changed)


def check_columns(name: str, df: DataFrame) -> DataFrame:
    missing = sorted(set(REQUIRED_COLUMNS[name]) - set(df.columns))
    if missing:
        raise TableError(f"{name} is missing required columns: {missing}")
    return df


def personal_columns(df: DataFrame) -> list[str]:
    """Personal columns present in ``df``; looks at names only and runs no job."""
    present = {c.lower() for c in df.columns}
    return sorted(c for c in PERSONAL_COLUMNS if c in present)


def privacy_guard(customers: DataFrame) -> DataFrame:
    found = personal_columns(customers)
    if found:
        raise TableError("customers holds personal columns: " + ", ".join(found))
    return customers


def _cast(column: str, kind: str) -> Column:
    raw = F.col(column).cast("string")
    if kind == "date":
        return F.to_date(F.try_to_timestamp(raw))
    number = F.expr(f"try_cast(`{column}` as double)")
    number = F.when(~F.isnan(number), number)
    # Months must be whole numbers to be months at all.
    return F.when(number == F.floor(number), number).try_cast("int") if kind == "int" else number


def coerce(name: str, df: DataFrame) -> DataFrame:
    """Cast the coerced columns of a table; what cannot be read becomes null."""
    for column, kind in COERCED.get(name, {}).items():
        if column in df.columns:
            df = df.withColumn(column, _cast(column, kind))
    return df


def coerce_and_quarantine(name: str, raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) rows of a table; only an unreadable order date rejects a row.

    Both come from the same narrow plan over the same scan, each with its own filter.
    """
    casted = coerce(name, raw)
    if name != "orders":
        return casted, casted.filter(F.lit(False)).withColumn("reject_reason", F.lit(None).cast("string"))
    bad = F.col("order_date").isNull()
    rejected = raw.withColumn("_parsed", _cast("order_date", "date")).filter(F.col("_parsed").isNull()).drop("_parsed")
    return casted.filter(~bad), rejected.withColumn("reject_reason", F.lit("invalid order_date"))


def read_table(spark: SparkSession, path: str, name: str, fmt: str) -> DataFrame:
    location = f"{path.rstrip('/')}/{name}.{fmt}"
    if fmt == "parquet":
        return check_columns(name, spark.read.parquet(location))
    # The header gives names only: every column is read as text and cast by name, so there is
    # no inference pass over the data.
    return check_columns(name, spark.read.option("header", True).csv(location))


def load_tables(spark: SparkSession, path: str, fmt: str = "csv", strict: bool = False) -> tuple[Tables, DataFrame]:
    """Load, check and cast the five tables; returns them with the quarantined order rows.

    ``strict`` raises when an order date cannot be read, instead of setting the row aside.
    """
    raw = {name: read_table(spark, path, name, fmt) for name in REQUIRED_COLUMNS}
    privacy_guard(raw["customers"])
    orders, rejects = coerce_and_quarantine("orders", raw["orders"])
    if strict and not rejects.isEmpty():
        raise TableError("orders holds invalid order_date values")
    tables = Tables(
        customers=raw["customers"],
        producers=raw["producers"],
        products=coerce("products", raw["products"]),
        orders=orders,
        order_items=coerce("order_items", raw["order_items"]),
    )
    return tables, rejects


def table_schema(name: str, id_type: T.DataType = T.StringType()) -> T.StructType:
    """Schema of a table for callers that build it from rows."""
    kinds = {"int": T.IntegerType(), "double": T.DoubleType(), "date": T.DateType()}
    fields = []
    for column in REQUIRED_COLUMNS[name]:
        kind = COERCED.get(name, {}).get(column)
        fields.append(T.StructField(column, kinds[kind] if kind else (id_type if column.endswith("_id") else T.StringType())))
    return T.StructType(fields)
