"""Named measures and report tables of the semantic layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.functions.scalars import month_of, ratio
from tillroll.plans.metrics import customer_order_counts

# --- measures over the marts -------------------------------------------------


def _exact_sum(column: str) -> Column:
    """Sum of money that may have been read back as double, without rounding drift."""
    return F.sum(F.col(column).cast("decimal(28,2)"))


def measures_executive(mart: DataFrame) -> DataFrame:
    totals = mart.agg(
        _exact_sum("total_revenue").alias("total_revenue"),
        F.sum("total_customers").alias("total_customers"),
        F.sum("total_invoices").alias("total_invoices"),
        F.avg("repeat_purchase_rate").alias("repeat_purchase_rate"),
        F.sum("total_quantity_sold").alias("quantity_sold"),
    )
    value = ratio(F.col("total_revenue"), F.col("total_invoices"))
    return totals.withColumn("average_order_value", value)


def measures_customer(mart: DataFrame) -> DataFrame:
    totals = mart.agg(
        _exact_sum("customer_lifetime_value").alias("customer_lifetime_value"),
        F.count("customer_lifetime_value").alias("customers"),
        F.sum("order_count").alias("customer_order_count"),
    )
    return totals.select(
        "customer_lifetime_value",
        ratio(F.col("customer_lifetime_value"), F.col("customers")).alias(
            "average_customer_lifetime_value"
        ),
        "customer_order_count",
    )


def measures_repeat(mart: DataFrame) -> DataFrame:
    totals = mart.agg(
        F.sum("repeat_customers").alias("repeat_customers"),
        F.sum("total_customers").alias("total_customers"),
    )
    rate = ratio(F.col("repeat_customers"), F.col("total_customers"))
    return totals.withColumn("repeat_purchase_rate", rate)


def measures_monthly(
    mart: DataFrame, calendar: DataFrame | None = None, by: list[str] | None = None
) -> DataFrame:
    """Monthly measures, in total or by date parts of the calendar."""
    rows = monthly_with_calendar(calendar, mart) if calendar is not None else mart
    return rows.groupBy(*(by or [])).agg(
        _exact_sum("revenue").alias("monthly_revenue"),
        F.sum("invoice_count").alias("monthly_invoice_count"),
        F.sum("quantity_sold").alias("monthly_quantity_sold"),
    )


def measures_country(mart: DataFrame) -> DataFrame:
    by_country = mart.groupBy("country_name").agg(
        _exact_sum("total_revenue").alias("revenue"),
        F.sum("invoice_count").alias("invoice_count"),
        F.sum("customer_count").alias("customer_count"),
    )
    return by_country.withColumn(
        "average_order_value", ratio(F.col("revenue"), F.col("invoice_count"))
    )


# --- calendar ----------------------------------------------------------------


def date_dimension(bounds: DataFrame) -> DataFrame:
    """One row per day from ``first_day`` to ``last_day``, given as one row of dates."""
    days = bounds.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))).alias("date")
    )
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month_number"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.date_format("date", "yyyy-MM").alias("year_month"),
    )


def calendar_bounds(monthly: DataFrame) -> DataFrame:
    """From the first day of the first month to the last day of the last one."""
    return monthly.agg(
        F.min("month").alias("first_day"), F.last_day(F.max("month")).alias("last_day")
    ).where("first_day IS NOT NULL")


def monthly_with_calendar(calendar: DataFrame, monthly: DataFrame) -> DataFrame:
    """Months with their calendar attributes, one day to many rows."""
    return calendar.join(monthly, calendar["date"] == monthly["month"]).drop("date")


# --- measures over the fact, by its own return flag ---------------------------


def _revenue() -> Column:
    """Revenue of the lines that are not flagged as returns."""
    kept = F.when(~F.col("is_return"), F.col("quantity") * F.col("unit_price"))
    return F.coalesce(F.sum(kept), F.lit(0))


def measures_fact(sales: DataFrame) -> DataFrame:
    """Six measures in one row, from invoice and customer grains."""
    invoices = sales.groupBy("invoice_number").agg(
        _revenue().alias("revenue"),
        F.count_if("is_return").alias("returned"),
        F.count("*").alias("lines"),
    )
    customers = customer_order_counts(sales).agg(
        F.struct(
            F.count("*").alias("known"), F.count_if(F.col("order_count") > 1).alias("repeat")
        ).alias("c")
    )
    totals = invoices.agg(
        F.coalesce(F.sum("revenue"), F.lit(0)).alias("total_revenue"),
        F.count("invoice_number").alias("total_orders"),
        F.sum("returned").alias("returned"),
        F.sum("lines").alias("lines"),
    ).withColumn("c", customers.scalar())
    return totals.select(
        "total_revenue",
        "total_orders",
        F.col("c.known").alias("total_customers"),
        ratio(F.col("returned"), F.col("lines")).alias("return_rate"),
        ratio(F.col("total_revenue"), F.col("total_orders")).alias("average_order_value"),
        ratio(F.col("c.repeat"), F.col("c.known")).alias("repeat_purchase_rate"),
    )


def slicers(
    enriched: DataFrame,
    start_date: str | None = None,
    end_date: str | None = None,
    countries: list[str] | None = None,
    is_return: bool | None = None,
) -> DataFrame:
    """Date range (whole days), country and return-flag filters of every page."""
    if start_date:
        enriched = enriched.where(F.col("invoice_date") >= F.lit(start_date).cast("timestamp_ntz"))
    if end_date:
        after = F.lit(end_date).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
        enriched = enriched.where(F.col("invoice_date") < after)
    if countries:
        enriched = enriched.where(F.col("country_name").isin(countries))
    if is_return is not None:
        enriched = enriched.where(F.col("is_return") == is_return)
    return enriched


def monthly_trend(sales: DataFrame) -> DataFrame:
    by_month = sales.groupBy(month_of(F.col("invoice_date")).alias("month"))
    return by_month.agg(_revenue().alias("total_revenue")).orderBy(F.asc_nulls_last("month"))


def _with_country(sales: DataFrame, countries: DataFrame) -> DataFrame:
    return sales.join(countries, "country_id", "left")


def top10_countries(sales: DataFrame, countries: DataFrame, n: int = 10) -> DataFrame:
    revenue = sales.groupBy("country_id").agg(_revenue().alias("total_revenue"))
    return (
        _with_country(revenue, countries)
        .select("country_name", "total_revenue")
        .orderBy(F.desc("total_revenue"), F.asc_nulls_last("country_name"))
        .limit(n)
    )


def top20_customers(sales: DataFrame, n: int = 20) -> DataFrame:
    known = sales.where("customer_id IS NOT NULL").groupBy("customer_id")
    return (
        known.agg(
            _revenue().alias("lifetime_value"),
            F.count_distinct("invoice_number").alias("total_orders"),
        )
        .orderBy(F.desc("lifetime_value"), "customer_id")
        .limit(n)
    )


# --- retention ---------------------------------------------------------------


def _active_months(sales: DataFrame) -> DataFrame:
    """Known customers and the months they have a line in, with their first month.

    Lines are reduced to distinct months before the window, which then holds at
    most one row per calendar month for a customer.
    """
    months = (
        sales.where("customer_id IS NOT NULL AND invoice_date IS NOT NULL")
        .select("customer_id", month_of(F.col("invoice_date")).alias("month"))
        .distinct()
    )
    first = F.min("month").over(Window.partitionBy("customer_id"))
    return months.withColumn("cohort_month", first)


def cohort_retention(sales: DataFrame) -> DataFrame:
    """Share of a first-order month's customers active so many months later."""
    months_since = (F.year("month") - F.year("cohort_month")) * 12 + (
        F.month("month") - F.month("cohort_month")
    )
    active = (
        _active_months(sales)
        .groupBy("cohort_month", months_since.cast("bigint").alias("months_since_first"))
        .agg(F.count("*").alias("active_customers"))
    )
    # Every customer is active in its own first month.
    size = active.where("months_since_first = 0").select(
        "cohort_month", F.col("active_customers").alias("cohort_size")
    )
    return (
        active.join(size, "cohort_month")
        .select(
            "cohort_month",
            "months_since_first",
            "cohort_size",
            "active_customers",
            (ratio(F.col("active_customers"), F.col("cohort_size")) * 100).alias("retention_pct"),
        )
        .orderBy("cohort_month", "months_since_first")
    )


def cohort_matrix(retention: DataFrame, months: int) -> DataFrame:
    """Retention as a matrix: one row per cohort, one column per month since the first."""
    return (
        retention.groupBy("cohort_month")
        .pivot("months_since_first", list(range(months)))
        .agg(F.first("retention_pct"))
        .orderBy("cohort_month")
    )


def new_vs_returning(sales: DataFrame) -> DataFrame:
    is_new = F.col("month") == F.col("cohort_month")
    return (
        _active_months(sales)
        .groupBy("month")
        .agg(
            F.count_if(is_new).alias("new_customers"), F.count_if(~is_new).alias("returning_customers")
        )
        .orderBy("month")
    )


# --- products and countries ----------------------------------------------------


def _product_totals(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Sums per code, with the product name looked up afterwards."""
    by_code = sales.groupBy("stock_code").agg(
        _revenue().alias("revenue"),
        F.sum(F.when(~F.col("is_return"), F.col("quantity")).otherwise(F.lit(0))).alias("quantity"),
        F.sum("unit_price").alias("price_sum"),
        F.count("unit_price").alias("priced"),
        F.count_if("is_return").alias("returned"),
        F.count("*").alias("lines"),
    )
    return by_code.join(products.select("stock_code", "product_name"), "stock_code", "left")


def _best_products(sales: DataFrame, products: DataFrame, by: str, n: int) -> DataFrame:
    totals = _product_totals(sales, products).select("stock_code", "product_name", by)
    return totals.orderBy(F.desc(by), "stock_code").limit(n)


def top20_products_revenue(sales: DataFrame, products: DataFrame, n: int = 20) -> DataFrame:
    return _best_products(sales, products, "revenue", n)


def top20_products_quantity(sales: DataFrame, products: DataFrame, n: int = 20) -> DataFrame:
    return _best_products(sales, products, "quantity", n)


def avg_price_by_product(sales: DataFrame, products: DataFrame) -> DataFrame:
    return _product_totals(sales, products).select(
        "stock_code",
        "product_name",
        ratio(F.col("price_sum"), F.col("priced")).alias("avg_unit_price"),
        "quantity",
        "revenue",
    )


def product_return_rate(sales: DataFrame, products: DataFrame) -> DataFrame:
    rate = ratio(F.col("returned"), F.col("lines"))
    return (
        _product_totals(sales, products)
        .select("stock_code", "product_name", rate.alias("return_rate"), "revenue", "quantity")
        .orderBy(F.desc("return_rate"), "stock_code")
    )


def country_contribution(sales: DataFrame, countries: DataFrame) -> DataFrame:
    """Orders, revenue and share of the total per country."""
    total = sales.agg(_revenue()).scalar()
    by_country = sales.groupBy("country_id").agg(
        F.count_distinct("invoice_number").alias("order_count"), _revenue().alias("revenue")
    )
    return (
        _with_country(by_country, countries)
        .select(
            "country_name",
            "order_count",
            "revenue",
            ratio(F.col("revenue"), total).alias("revenue_share"),
        )
        .orderBy(F.desc("revenue"), F.asc_nulls_last("country_name"))
    )
