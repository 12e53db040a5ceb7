"""Staging, intermediate and mart models over the star tables.

Money stays decimal through all layers; ratios are doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.scalars import month_of, ratio

# --- staging ---------------------------------------------------------------


def stg_sales(fact_sales: DataFrame) -> DataFrame:
    """Typed lines. A stored return flag, also a false one, wins over the quantity's sign."""
    typed = fact_sales.select(
        F.col("sale_id").cast("bigint").alias("sale_id"),
        F.col("invoice_number").cast("string").alias("invoice_number"),
        F.col("stock_code").cast("string").alias("stock_code"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        F.col("country_id").cast("int").alias("country_id"),
        F.col("quantity").cast("int").alias("quantity"),
        F.col("invoice_date").cast(T.TimestampNTZType()).alias("invoice_date"),
        F.col("unit_price").cast("decimal(10,2)").alias("unit_price"),
        F.col("is_return").cast("boolean").alias("is_return"),
    )
    quantity, price = F.col("quantity"), F.col("unit_price")
    return typed.withColumns(
        {
            "is_return": F.coalesce(F.col("is_return"), quantity < 0, F.lit(False)),
            "line_revenue": quantity * price,
            "is_positive_sale": (quantity > 0) & (price >= 0),
        }
    )


def stg_customers(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.select(F.col("customer_id").cast("bigint").alias("customer_id"))


def stg_products(dim_product: DataFrame) -> DataFrame:
    return dim_product.select(
        F.col("stock_code").cast("string").alias("stock_code"),
        F.col("description").cast("string").alias("product_name"),
        F.col("unit_price_reference").cast("decimal(10,2)").alias("unit_price_reference"),
    )


def stg_countries(dim_country: DataFrame) -> DataFrame:
    return dim_country.select(
        F.col("country_id").cast("int").alias("country_id"),
        F.col("country_name").cast("string").alias("country_name"),
    )


# --- intermediate ----------------------------------------------------------


def _positive_revenue() -> Column:
    return F.sum(F.when(F.col("is_positive_sale"), F.col("line_revenue")).otherwise(F.lit(0)))


def _positive_units() -> Column:
    return F.sum(F.when(F.col("is_positive_sale"), F.col("quantity")).otherwise(F.lit(0)))


def int_sales_enriched(sales: DataFrame, products: DataFrame, countries: DataFrame) -> DataFrame:
    """Lines with product and country names.

    Customers add no column and are unique, so that lookup is not made.
    """
    return (
        sales.join(products, "stock_code", "left")
        .join(countries, "country_id", "left")
        .select(
            "sale_id",
            "invoice_number",
            "stock_code",
            "customer_id",
            "country_id",
            "quantity",
            "invoice_date",
            month_of(F.col("invoice_date")).alias("sales_month"),
            "unit_price",
            "is_return",
            "line_revenue",
            "is_positive_sale",
            "product_name",
            "unit_price_reference",
            "country_name",
        )
    )


def int_order_metrics(sales: DataFrame) -> DataFrame:
    return sales.groupBy("invoice_number").agg(
        F.min("invoice_date").alias("first_invoice_date"),
        F.max("invoice_date").alias("last_invoice_date"),
        F.count("*").alias("line_count"),
        _positive_revenue().alias("order_revenue"),
        _positive_units().alias("quantity_sold"),
        F.bool_or("is_return").alias("includes_return"),
        F.count_distinct("customer_id").alias("known_customer_count"),
    )


def int_customer_orders(sales: DataFrame) -> DataFrame:
    known = sales.where("customer_id IS NOT NULL").groupBy("customer_id")
    return known.agg(
        F.min("invoice_date").alias("first_order_date"),
        F.max("invoice_date").alias("last_order_date"),
        F.count_distinct("invoice_number").alias("order_count"),
        _positive_revenue().alias("total_revenue"),
    ).withColumn("is_repeat_customer", F.col("order_count") > 1)


def int_customer_lifetime_value(customer_orders: DataFrame) -> DataFrame:
    return customer_orders.select(
        "customer_id",
        "first_order_date",
        "last_order_date",
        "order_count",
        "total_revenue",
        F.col("total_revenue").alias("customer_lifetime_value"),
    )


def int_country_metrics(sales: DataFrame, countries: DataFrame) -> DataFrame:
    """Per country; lines without a country form a group of their own."""
    grouped = sales.join(countries, "country_id", "left")
    # A key without a row in the dimension counts as no country.
    known_id = F.when(F.col("country_name").isNotNull(), F.col("country_id"))
    return (
        grouped.groupBy(known_id.alias("country_id"), "country_name")
        .agg(
            _positive_revenue().alias("total_revenue"),
            F.count_distinct("invoice_number").alias("invoice_count"),
            F.count_distinct("customer_id").alias("customer_count"),
            _positive_units().alias("quantity_sold"),
        )
        .withColumn("aov", ratio(F.col("total_revenue"), F.col("invoice_count")))
    )


# --- marts -----------------------------------------------------------------


def mart_executive_kpis(order_metrics: DataFrame, customer_orders: DataFrame) -> DataFrame:
    """One row. The customer side is one row too and is read as a scalar."""
    customers = customer_orders.agg(
        F.struct(
            F.count("*").alias("total"), F.count_if("is_repeat_customer").alias("repeat")
        ).alias("customers")
    )
    orders = order_metrics.agg(
        F.sum("order_revenue").alias("total_revenue"),
        F.count("*").alias("total_invoices"),
        F.sum("quantity_sold").alias("total_quantity_sold"),
    ).withColumn("customers", customers.scalar())
    return orders.select(
        "total_revenue",
        "total_invoices",
        F.col("customers.total").alias("total_customers"),
        ratio(F.col("total_revenue"), F.col("total_invoices")).alias("aov"),
        ratio(F.col("customers.repeat"), F.col("customers.total")).alias("repeat_purchase_rate"),
        "total_quantity_sold",
    )


def mart_customer_lifetime_value(lifetime_value: DataFrame) -> DataFrame:
    return lifetime_value.select(
        "customer_id",
        "total_revenue",
        "order_count",
        "first_order_date",
        "last_order_date",
        "customer_lifetime_value",
    )


def mart_repeat_purchase_metrics(customer_orders: DataFrame) -> DataFrame:
    counts = customer_orders.agg(
        F.count_if("is_repeat_customer").alias("repeat_customers"),
        F.count("*").alias("total_customers"),
    )
    rate = ratio(F.col("repeat_customers"), F.col("total_customers"))
    return counts.withColumn("repeat_purchase_rate", rate)


def mart_country_revenue(country_metrics: DataFrame) -> DataFrame:
    return country_metrics.select(
        "country_name", "total_revenue", "invoice_count", "customer_count", "aov"
    ).orderBy(F.desc_nulls_first("total_revenue"))


def mart_sales_monthly(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(month_of(F.col("invoice_date")).alias("month"))
        .agg(
            _positive_revenue().alias("revenue"),
            F.count_distinct("invoice_number").alias("invoice_count"),
            _positive_units().alias("quantity_sold"),
        )
        .orderBy(F.asc_nulls_last("month"))
    )
