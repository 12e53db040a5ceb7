"""Dashboard metrics over the enriched line table.

Here a return is a negative quantity and a positive sale a positive one.
Rates are 0 where there is nothing to divide by.

Every metric also takes lines that ``reduce_to_orders`` or ``reduce_to_products``
has summed up, as far as it needs no other columns; their results are the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import fixed_values as fixed
from tillroll.functions.percentiles import Percentile, percentile_columns
from tillroll.functions.scalars import (
    is_operational,
    lenient_bigint,
    lenient_price,
    month_of,
    read_timestamp,
    recency_bucket,
    risk_label,
    safe_divide,
    whole_days_between,
)
from tillroll.sources.workspace import land

_LINE_LABELS = ["country_name", "stock_code", "product_name"]


def clean_dashboard_fact(df: DataFrame) -> DataFrame:
    """Lenient types and the reusable metric columns. Narrow: no shuffle."""
    if isinstance(df.schema["quantity"].dataType, T.IntegralType):
        quantity = F.col("quantity").cast("bigint")
    else:
        quantity = lenient_bigint(df, "quantity")
    date = F.col("invoice_date")
    if isinstance(df.schema["invoice_date"].dataType, T.StringType):
        date = read_timestamp(date)
    typed = df.withColumns(
        {
            "invoice_date": date.try_cast(T.TimestampNTZType()),
            "customer_id": lenient_bigint(df, "customer_id"),
            "quantity": F.coalesce(quantity, F.lit(0)),
            "unit_price": F.coalesce(lenient_price(df, "unit_price"), F.lit(0)),
            **{c: F.coalesce(F.col(c).cast("string"), F.lit("Unknown")) for c in _LINE_LABELS},
        }
    )
    units, revenue = F.col("quantity"), F.col("line_revenue")
    sold, returned = units > 0, units < 0
    zero = F.lit(0)
    cancelled = F.startswith(F.col("invoice_number").cast("string"), F.lit("C"))
    return typed.withColumn("line_revenue", units * F.col("unit_price")).withColumns(
        {
            "month": month_of(F.col("invoice_date")),
            "is_return": returned,
            "is_positive_sale": sold,
            "gross_revenue": F.when(sold, revenue).otherwise(zero),
            "return_value": F.when(returned, -revenue).otherwise(zero),
            "positive_units": F.when(sold, units).otherwise(zero),
            "returned_units": F.when(returned, -units).otherwise(zero),
            "is_cancel_invoice": F.coalesce(cancelled, F.lit(False)),
            "is_operational_code": is_operational(F.col("stock_code"), F.col("product_name")),
        }
    )


def filter_operational_codes(df: DataFrame, include_operational: bool = False) -> DataFrame:
    return df if include_operational else df.where(~F.col("is_operational_code"))


def filter_fact(
    df: DataFrame,
    start_date: str | None = None,
    end_date: str | None = None,
    countries: list[str] | None = None,
) -> DataFrame:
    """Optional filters; the end date takes in midnight of the day after."""
    if start_date:
        df = df.where(F.col("invoice_date") >= F.lit(start_date).cast("timestamp_ntz"))
    if end_date:
        last = F.lit(end_date).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
        df = df.where(F.col("invoice_date") <= last)
    if countries:
        df = df.where(F.col("country_name").isin(countries))
    return df


def reduce_to_orders(df: DataFrame) -> DataFrame:
    """Lines summed per customer, invoice, country and month, under the names of the line columns."""
    return df.groupBy("customer_id", "invoice_number", "country_name", "month").agg(
        *[F.sum(c).alias(c) for c in ("gross_revenue", "line_revenue", "return_value", "positive_units")],
        F.bool_or("is_positive_sale").alias("is_positive_sale"),
        F.max("invoice_date").alias("invoice_date"),
        F.count("*").alias("line_count"),
    )


def reduce_to_products(df: DataFrame) -> DataFrame:
    """Lines summed per code and name, under the names of the line columns, with counts of odd lines."""
    sums = ("gross_revenue", "line_revenue", "return_value", "positive_units", "returned_units", "quantity")
    return df.groupBy("stock_code", "product_name", "is_operational_code").agg(
        *[F.sum(c).alias(c) for c in sums],
        F.count("sale_id").alias("sale_count"),
        F.count("*").alias("line_count"),
        *[F.count_if(F.expr(when)).alias(name) for name, when in _ODD_LINES.items()],
    )


_ODD_LINES = {
    "null_customer_rows": "customer_id IS NULL",
    "return_rows": "is_return",
    "cancel_invoice_rows": "is_cancel_invoice",
    "zero_price_rows": "unit_price = 0",
    "outlier_rows": f"unit_price > {fixed.OUTLIER_PRICE} OR abs(quantity) > {fixed.OUTLIER_QUANTITY}",
}


def _lines(df: DataFrame) -> Column:
    """Number of lines, also of reduced ones."""
    return F.coalesce(F.sum("line_count"), F.lit(0)) if "line_count" in df.columns else F.count("*")


def _sales(df: DataFrame) -> Column:
    return F.coalesce(F.sum("sale_count"), F.lit(0)) if "sale_count" in df.columns else F.count("sale_id")


def _odd(df: DataFrame, name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0)) if name in df.columns else F.count_if(F.expr(_ODD_LINES[name]))


def customer_order_counts(df: DataFrame) -> DataFrame:
    """Distinct invoices per known customer."""
    known = df.where("customer_id IS NOT NULL")
    return known.groupBy("customer_id").agg(F.count_distinct("invoice_number").alias("order_count"))


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).alias(column)


def _one_row(df: DataFrame, *columns: Column) -> Column:
    """A one-row aggregate as a struct that other rows can read as a constant."""
    return df.agg(F.struct(*columns).alias("row")).scalar()


def executive_metrics(df: DataFrame) -> DataFrame:
    """Eight KPIs in one row.

    Lines are first reduced to invoices and to customers, so no distinct count
    runs over the lines of the whole table at once.
    """
    invoices = df.groupBy("invoice_number").agg(
        F.sum("gross_revenue").alias("gross_revenue"),
        F.sum("line_revenue").alias("net_revenue"),
        F.sum("return_value").alias("return_value"),
        F.sum("positive_units").alias("total_units_sold"),
        F.bool_or("is_positive_sale").alias("sold"),
    )
    named = F.col("invoice_number").isNotNull()
    customers = _one_row(
        customer_order_counts(df),
        F.count("*").alias("active"),
        F.count_if(F.col("order_count") > 1).alias("repeat"),
    )
    totals = invoices.agg(
        _total("gross_revenue"),
        _total("net_revenue"),
        _total("return_value"),
        _total("total_units_sold"),
        F.count("invoice_number").alias("total_transactions"),
        F.count_if(F.col("sold") & named).alias("sold_invoices"),
    ).withColumn("customers", customers)
    return totals.select(
        "gross_revenue",
        "net_revenue",
        "return_value",
        "total_units_sold",
        F.col("customers.active").alias("active_customers"),
        "total_transactions",
        safe_divide(F.col("gross_revenue"), F.col("sold_invoices")).alias("average_order_value"),
        safe_divide(F.col("customers.repeat"), F.col("customers.active")).alias(
            "repeat_purchase_rate"
        ),
    )


def monthly_gross_net(df: DataFrame) -> DataFrame:
    return (
        df.where("month IS NOT NULL")
        .groupBy("month")
        .agg(
            F.sum("gross_revenue").alias("gross_revenue"), F.sum("line_revenue").alias("net_revenue")
        )
        .orderBy("month")
    )


def _newest_known(df: DataFrame) -> Column:
    return df.where("customer_id IS NOT NULL").agg(F.max("invoice_date")).scalar()


def _summarize_customers(lines: DataFrame, newest: Column) -> DataFrame:
    """Lines are shuffled once, summed per customer, country and invoice.

    An invoice counts in the first of its countries, so that the sums per customer and
    country, of which there are few, hold all that is asked of a customer.
    """
    orders = (
        lines.where("customer_id IS NOT NULL")
        .groupBy("customer_id", "invoice_number", "country_name")
        .agg(
            _lines(lines).alias("lines"),
            F.sum("gross_revenue").alias("value"),
            F.max("invoice_date").alias("latest"),
        )
    )
    nth = F.row_number().over(Window.partitionBy("customer_id", "invoice_number").orderBy("country_name"))
    counted = (F.col("nth") == 1) & F.col("invoice_number").isNotNull()
    countries = (
        orders.withColumn("nth", nth)
        .groupBy("customer_id", "country_name")
        .agg(
            F.sum("lines").alias("lines"),
            F.sum("value").alias("value"),
            F.max("latest").alias("latest"),
            F.count_if(counted).alias("orders"),
        )
    )
    most = F.when(F.col("country_name").isNotNull(), F.struct(-F.col("lines"), "country_name"))
    values = countries.groupBy("customer_id").agg(
        F.sum("value").alias("lifetime_value"),
        F.sum("orders").alias("order_count"),
        F.max("latest").alias("last_order_date"),
        F.min_by("country_name", most).alias("main_country"),
    )
    days = whole_days_between(F.col("last_order_date"), newest).cast("bigint")
    return values.withColumn("recency_days", days).select(
        F.col("customer_id").cast("string").alias("customer_id"),
        "lifetime_value",
        "order_count",
        "last_order_date",
        "recency_days",
        recency_bucket(F.col("recency_days")).alias("recency_bucket"),
        F.coalesce("main_country", F.lit("Unknown")).alias("primary_country"),
    )


def customer_summary(df: DataFrame) -> DataFrame:
    """Value, orders, recency and main country of each known customer.

    The main country is the one with most lines (the first by name on ties). It
    is found from line counts per customer and country, so no task ever holds
    the lines of a customer.
    """
    return _summarize_customers(df, _newest_known(df))


def customer_lifetime(df: DataFrame) -> DataFrame:
    """Value of each known customer."""
    return (
        df.where("customer_id IS NOT NULL")
        .groupBy("customer_id")
        .agg(F.sum("gross_revenue").alias("lifetime_value"))
        .withColumn("customer_id", F.col("customer_id").cast("string"))
    )


def customer_values(df: DataFrame) -> DataFrame:
    """Value and orders of each known customer, without the other summary columns."""
    return (
        df.where("customer_id IS NOT NULL")
        .groupBy("customer_id")
        .agg(
            F.sum("gross_revenue").alias("lifetime_value"),
            F.count_distinct("invoice_number").alias("order_count"),
        )
        .withColumn("customer_id", F.col("customer_id").cast("string"))
    )


def customer_metrics(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Five customer KPIs in one row; the median is exact unless asked otherwise."""
    if approximate:
        values = customer_values(df)
        median = values.agg(F.percentile_approx("lifetime_value", 0.5, 10000)).scalar()
    else:
        # Written once: the median takes several looks at the customers.
        values = land(customer_values(df), "customer-values")
        median = percentile_columns(values, {"median": Percentile("lifetime_value", "0.5")})["median"]
    known = F.col("customer_id").isNotNull()
    size = F.col("line_count") if "line_count" in df.columns else F.lit(1)
    lines = df.agg(
        _lines(df).alias("lines"), F.coalesce(F.sum(F.when(known, size)), F.lit(0)).alias("known_lines")
    )
    customers = _one_row(
        values,
        F.count("*").alias("known"),
        F.count_if(F.col("order_count") > 1).alias("repeat"),
        F.sum("order_count").alias("orders"),
    )
    return lines.withColumn("c", customers).select(
        F.col("c.known").alias("known_customers"),
        safe_divide(F.col("lines") - F.col("known_lines"), F.col("lines")).alias("guest_row_rate"),
        safe_divide(F.col("c.repeat"), F.col("c.known")).alias("repeat_purchase_rate"),
        F.coalesce(median.cast("double"), F.lit(0.0)).alias("median_ltv"),
        safe_divide(F.col("c.orders"), F.col("c.known")).alias("avg_order_frequency"),
    )


def top_customers_by_ltv(df: DataFrame, n: int = 15) -> DataFrame:
    """The best customers of the summary.

    The n ids are found by value alone; only their lines are then summarized.
    """
    order = [F.desc("lifetime_value"), F.asc("customer_id")]
    best = customer_lifetime(df).orderBy(*order).limit(n)
    ids = best.select(F.col("customer_id").cast("bigint").alias("customer_id"))
    lines = df.join(ids, "customer_id", "left_semi")
    return _summarize_customers(lines, _newest_known(df)).orderBy(*order).limit(n)


def product_metrics(df: DataFrame, include_operational: bool = False) -> DataFrame:
    """Six product KPIs in one row; lines are first reduced to product codes."""
    by_code = (
        filter_operational_codes(df, include_operational)
        .groupBy("stock_code")
        .agg(
            F.sum("positive_units").alias("units_sold"),
            F.sum("returned_units").alias("returned_units"),
            F.sum("return_value").alias("return_value"),
            _odd(df, "return_rows").alias("return_lines"),
            _lines(df).alias("lines"),
        )
    )
    totals = by_code.agg(
        F.count("stock_code").alias("product_count"),
        _total("units_sold"),
        _total("returned_units"),
        _total("return_value"),
        F.sum("return_lines").alias("return_lines"),
        F.sum("lines").alias("lines"),
    )
    return totals.select(
        "product_count",
        "units_sold",
        "returned_units",
        "return_value",
        safe_divide(F.col("return_lines"), F.col("lines")).alias("return_line_rate"),
        safe_divide(F.col("returned_units"), F.col("units_sold")).alias("returned_unit_rate"),
    )


def product_totals(df: DataFrame, min_units: int = 1, include_operational: bool = False) -> DataFrame:
    """Sums and return rates per product with enough units sold."""
    return (
        filter_operational_codes(df, include_operational)
        .groupBy("stock_code", "product_name")
        .agg(
            F.sum("gross_revenue").alias("gross_revenue"),
            F.sum("line_revenue").alias("net_revenue"),
            F.sum("positive_units").alias("units_sold"),
            F.sum("returned_units").alias("returned_units"),
            F.sum("return_value").alias("return_value"),
            _odd(df, "return_rows").alias("return_lines"),
            _sales(df).alias("line_count"),
        )
        .where(F.col("units_sold") >= min_units)
        .withColumns(
            {
                "return_line_rate": safe_divide(F.col("return_lines"), F.col("line_count")),
                "returned_unit_rate": safe_divide(F.col("returned_units"), F.col("units_sold")),
            }
        )
    )


_HIGH = Percentile("gross_revenue", fixed.HIGH_REVENUE_PERCENTILE)


def with_risk_label(totals: DataFrame, high: Column) -> DataFrame:
    """Add the risk label, given the revenue from which it is high."""
    label = risk_label(
        F.col("gross_revenue"), high, F.col("return_line_rate"), F.col("returned_unit_rate")
    )
    return totals.withColumn("risk_label", label)


def label_products(totals: DataFrame) -> DataFrame:
    """Add the risk label; high revenue is the upper quarter of these products.

    The totals are written once, as they are looked at several times.
    """
    totals = land(totals, "product-totals")
    return with_risk_label(totals, percentile_columns(totals, {"high": _HIGH})["high"])


def audit_order() -> list[Column]:
    """Best revenue first, then the higher return rate; code and name settle ties."""
    return [
        F.desc("gross_revenue"),
        F.desc("return_line_rate"),
        F.asc("stock_code"),
        F.asc("product_name"),
    ]


def product_return_audit(
    df: DataFrame, min_units: int = 1, include_operational: bool = False
) -> DataFrame:
    return label_products(product_totals(df, min_units, include_operational)).orderBy(*audit_order())


def country_totals(df: DataFrame) -> DataFrame:
    return (
        df.where("country_name IS NOT NULL")
        .groupBy("country_name")
        .agg(
            F.sum("gross_revenue").alias("gross_revenue"),
            F.sum("line_revenue").alias("net_revenue"),
            F.count_distinct("invoice_number").alias("order_count"),
            F.count_distinct("customer_id").alias("customer_count"),
            F.sum("positive_units").alias("units_sold"),
        )
        .withColumn("aov", safe_divide(F.col("gross_revenue"), F.col("order_count")))
    )


def country_metrics(df: DataFrame) -> DataFrame:
    """Sums, average order and share of the total per country, best first."""
    total = df.where("country_name IS NOT NULL").agg(F.sum("gross_revenue")).scalar()
    return (
        country_totals(df)
        .withColumn("revenue_share", safe_divide(F.col("gross_revenue"), total))
        .orderBy(F.desc("gross_revenue"), "country_name")
    )


def data_quality_metrics(df: DataFrame) -> DataFrame:
    """Row counts and rates in one row.

    Lines are counted per product code and flag first; the number of codes then
    comes from those groups.
    """
    groups = df.groupBy("is_operational_code", "stock_code").agg(
        _lines(df).alias("processed_fact_rows"), *[_odd(df, name).alias(name) for name in _ODD_LINES]
    )
    flagged = F.col("is_operational_code")
    counted = [c for c in groups.columns if c not in ("is_operational_code", "stock_code")]
    return groups.agg(
        *[_total(c) for c in counted],
        F.coalesce(F.sum(F.when(flagged, F.col("processed_fact_rows"))), F.lit(0)).alias(
            "operational_rows"
        ),
        F.count(F.when(flagged, F.col("stock_code"))).alias("operational_stock_codes"),
    ).withColumn(
        "null_customer_rate",
        safe_divide(F.col("null_customer_rows"), F.col("processed_fact_rows")),
    )


def country_exceptions(df: DataFrame) -> DataFrame:
    """Countries that need a manual mapping, among those present."""
    listed = df.select("country_name").where(F.col("country_name").isin(fixed.COUNTRY_EXCEPTIONS))
    return listed.distinct().orderBy("country_name")


def operational_code_summary(df: DataFrame, n: int = 25) -> DataFrame:
    return (
        df.where("is_operational_code")
        .groupBy("stock_code", "product_name")
        .agg(
            _sales(df).alias("rows"),
            F.sum("gross_revenue").alias("gross_revenue"),
            F.sum("return_value").alias("return_value"),
            F.sum("quantity").alias("units"),
        )
        .orderBy(F.desc("rows"), "stock_code", "product_name")
        .limit(n)
    )
