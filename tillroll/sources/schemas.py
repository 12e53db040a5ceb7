"""Declared schemas of the raw lines, the star tables and the mart files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(10,2)": T.DecimalType(10, 2),
}


def _schema(columns: str, required: tuple[str, ...] = ()) -> T.StructType:
    pairs = [column.split() for column in columns.split(", ")]
    return T.StructType(
        [T.StructField(name, _TYPES[kind], name not in required) for name, kind in pairs]
    )


RAW_COLUMNS = [
    "invoice_number",
    "stock_code",
    "description",
    "quantity",
    "invoice_date",
    "unit_price",
    "customer_id",
    "country",
]

STAR_SCHEMAS = {
    "dim_country": _schema(
        "country_id int, country_name string", required=("country_id", "country_name")
    ),
    "dim_customer": _schema("customer_id bigint", required=("customer_id",)),
    "dim_product": _schema(
        "stock_code string, description string, unit_price_reference decimal(10,2)",
        required=("stock_code",),
    ),
    "fact_sales": _schema(
        "sale_id bigint, invoice_number string, stock_code string, customer_id bigint, "
        "country_id int, quantity int, invoice_date timestamp_ntz, "
        "unit_price decimal(10,2), is_return boolean",
        required=("sale_id",),
    ),
}

# Load order: dimensions first, then the fact that refers to them.
STAR_TABLES = ["dim_country", "dim_customer", "dim_product", "fact_sales"]

ENRICHED_COLUMNS = [
    "sale_id",
    "invoice_number",
    "stock_code",
    "customer_id",
    "quantity",
    "invoice_date",
    "unit_price",
    "is_return",
    "line_revenue",
    "country_name",
    "product_name",
]

MART_SCHEMAS = {
    "mart_executive_kpis": _schema(
        "total_revenue double, total_invoices bigint, total_customers bigint, aov double, "
        "repeat_purchase_rate double, total_quantity_sold bigint"
    ),
    "mart_customer_lifetime_value": _schema(
        "customer_id bigint, total_revenue double, order_count bigint, "
        "first_order_date timestamp_ntz, last_order_date timestamp_ntz, "
        "customer_lifetime_value double"
    ),
    "mart_repeat_purchase_metrics": _schema(
        "repeat_customers bigint, total_customers bigint, repeat_purchase_rate double"
    ),
    "mart_country_revenue": _schema(
        "country_name string, total_revenue double, invoice_count bigint, "
        "customer_count bigint, aov double"
    ),
    "mart_sales_monthly": _schema(
        "month date, revenue double, invoice_count bigint, quantity_sold bigint"
    ),
}


def string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def conform_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a declared schema; a missing nullable column is null."""
    missing = [f.name for f in schema if f.name not in df.columns and not f.nullable]
    if missing:
        raise ValueError(f"missing required column: {missing[0]}")
    return df.select(
        [
            (F.col(f.name) if f.name in df.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema
        ]
    )
