"""Ad-hoc analyses and the extracts for reporting tools, over the star tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.scalars import month_of


def _amount() -> Column:
    return F.col("quantity") * F.col("unit_price")


def _rounded(amount: Column) -> Column:
    return F.round(amount, 2)


def _rounded_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient of exact numbers, rounded to 2 decimals; null on a zero divisor."""
    exact = numerator.cast("decimal(28,2)") / F.nullif(
        denominator.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)")
    )
    return _rounded(exact)


def avg_order_value(fact: DataFrame) -> DataFrame:
    """Mean of the invoice totals over positive lines."""
    totals = fact.where("quantity > 0").groupBy("invoice_number").agg(F.sum(_amount()).alias("total"))
    return totals.agg(
        _rounded_ratio(F.sum("total"), F.count("total")).alias("avg_order_value")
    )


def customer_retention(fact: DataFrame) -> DataFrame:
    """Customers per month of their first order."""
    first = (
        fact.where("customer_id IS NOT NULL")
        .groupBy("customer_id")
        .agg(F.min("invoice_date").alias("first_order"))
    )
    return (
        first.groupBy(month_of(F.col("first_order")).alias("cohort_month"))
        .agg(F.count("*").alias("cohort_size"))
        .orderBy(F.asc_nulls_last("cohort_month"))
    )


def monthly_revenue(fact: DataFrame) -> DataFrame:
    return (
        fact.where("quantity > 0")
        .groupBy(month_of(F.col("invoice_date")).alias("month"))
        .agg(_rounded(F.sum(_amount())).alias("revenue"))
        .orderBy(F.asc_nulls_last("month"))
    )


def repeat_purchase_rate(fact: DataFrame) -> DataFrame:
    """Percent of known customers with more than one invoice."""
    orders = (
        fact.where("customer_id IS NOT NULL")
        .groupBy("customer_id")
        .agg(F.count_distinct("invoice_number").alias("order_count"))
    )
    repeat = F.count_if(F.col("order_count") > 1)
    return orders.agg(_rounded_ratio(repeat * 100, F.count("*")).alias("repeat_purchase_rate_pct"))


def _customer_value(positive: DataFrame) -> DataFrame:
    return positive.groupBy("customer_id").agg(
        _rounded(F.sum(_amount())).alias("lifetime_value"),
        F.count_distinct("invoice_number").alias("total_orders"),
    )


def _best_customers(values: DataFrame, n: int) -> DataFrame:
    return values.orderBy(F.desc_nulls_first("lifetime_value"), "customer_id").limit(n)


def top_customers(fact: DataFrame, dim_customer: DataFrame, n: int = 20) -> DataFrame:
    """Best known customers.

    Values are summed first and then joined to the (unique) customers, so the
    join sees one row per customer and a busy customer is no hot key in it.
    """
    values = _customer_value(fact.where("quantity > 0 AND customer_id IS NOT NULL"))
    return _best_customers(values.join(dim_customer.select("customer_id"), "customer_id"), n)


def fact_sales_enriched(
    fact: DataFrame, dim_country: DataFrame, dim_product: DataFrame
) -> DataFrame:
    """Lines with names; here a return is a negative quantity, whatever the stored flag.

    Countries come last, so that their names are not shuffled with the lines.
    """
    names = dim_product.select("stock_code", F.col("description").alias("product_name"))
    return (
        fact.join(names, "stock_code", "left")
        .join(dim_country, "country_id", "left")
        .select(
            "sale_id",
            "invoice_number",
            "stock_code",
            "customer_id",
            "quantity",
            "invoice_date",
            "unit_price",
            F.coalesce(F.col("quantity") < 0, F.lit(False)).alias("is_return"),
            _rounded(_amount()).alias("line_revenue"),
            "country_name",
            "product_name",
        )
    )


def extract_monthly_revenue(fact: DataFrame) -> DataFrame:
    return monthly_revenue(fact)


def extract_top_customers(fact: DataFrame, n: int = 50) -> DataFrame:
    return _best_customers(
        _customer_value(fact.where("quantity > 0 AND customer_id IS NOT NULL")), n
    )


def extract_country_revenue(fact: DataFrame, dim_country: DataFrame) -> DataFrame:
    return (
        fact.where("quantity > 0")
        .join(dim_country, "country_id", "left")
        .groupBy("country_name")
        .agg(
            _rounded(F.sum(_amount())).alias("revenue"),
            F.count_distinct("invoice_number").alias("order_count"),
        )
        .orderBy(F.desc_nulls_first("revenue"), F.asc_nulls_last("country_name"))
    )


def extract_top_products(fact: DataFrame, dim_product: DataFrame, n: int = 50) -> DataFrame:
    """Best products by positive revenue, with mean line price and return-line percent.

    Lines are summed per code before the name lookup: codes are unique in the
    dimension, so the groups are the same and the fact is not shuffled to join.
    """
    sold = F.col("quantity") > 0
    by_code = fact.groupBy("stock_code").agg(
        F.sum(F.when(sold, _amount()).otherwise(F.lit(0))).alias("amount"),
        F.sum(F.when(sold, F.col("quantity")).otherwise(F.lit(0))).alias("units_sold"),
        F.sum("unit_price").alias("price_sum"),
        F.count("unit_price").alias("priced"),
        F.count_if(F.col("quantity") < 0).alias("returned"),
        F.count("*").alias("lines"),
    )
    names = dim_product.select("stock_code", F.col("description").alias("product_name"))
    return (
        by_code.join(names, "stock_code", "left")
        .select(
            "product_name",
            "stock_code",
            _rounded(F.col("amount")).alias("revenue"),
            "units_sold",
            _rounded_ratio(F.col("price_sum"), F.col("priced")).alias("avg_price"),
            _rounded_ratio(F.col("returned") * 100, F.col("lines")).alias("return_rate_percentage"),
        )
        .orderBy(F.desc_nulls_first("revenue"), "stock_code")
        .limit(n)
    )


def build_extracts(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The five extracts by file name."""
    fact = star["fact_sales"]
    return {
        "fact_sales_enriched": fact_sales_enriched(fact, star["dim_country"], star["dim_product"]),
        "monthly_revenue": extract_monthly_revenue(fact),
        "top_customers": extract_top_customers(fact),
        "country_revenue": extract_country_revenue(fact, star["dim_country"]),
        "top_products": extract_top_products(fact, star["dim_product"]),
    }
