"""Tables behind the dashboard pages, derived from the dashboard metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import fixed_values as fixed
from tillroll.functions.percentiles import Percentile, percentile_columns
from tillroll.functions.scalars import count_text, money_text, pct_text, safe_divide
from tillroll.plans import metrics
from tillroll.sources.workspace import land


def filter_domain(df: DataFrame) -> DataFrame:
    """Choices of the filters as rows: first date, last date and every country."""
    dates = df.agg(
        F.min("invoice_date").cast("date").cast("string").alias("min_date"),
        F.max("invoice_date").cast("date").cast("string").alias("max_date"),
    ).select(F.inline(F.array(
        F.struct(F.lit("min_date").alias("item"), F.col("min_date").alias("value")),
        F.struct(F.lit("max_date").alias("item"), F.col("max_date").alias("value")),
    )))
    countries = (
        df.where("country_name IS NOT NULL")
        .select("country_name")
        .distinct()
        .select(F.lit("country").alias("item"), F.col("country_name").alias("value"))
    )
    return dates.unionByName(countries).orderBy("item", "value")


_CUSTOMER, _PRODUCT, _TOTAL = "customer", "product", "total"


def _shares(revenues: DataFrame) -> DataFrame:
    """Shares from rows (kind, revenue, home): customers, products and one total.

    Only the ten best rows of a kind leave a task.
    """
    place = F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("revenue")))
    best = revenues.withColumn("place", place).where("place <= 10")

    def first(kind: str, n: int) -> Column:
        return F.sum(F.when((F.col("kind") == kind) & (F.col("place") <= n), F.col("revenue")))

    sums = best.agg(
        first(_CUSTOMER, 1).alias("customer"),
        first(_CUSTOMER, 10).alias("customers"),
        first(_PRODUCT, 10).alias("products"),
        first(_TOTAL, 1).alias("total"),
        F.max("home").alias("home"),
    )
    total = F.col("total")
    return sums.select(
        safe_divide(F.col("customer"), total).alias("top_customer_share"),
        safe_divide(F.col("customers"), total).alias("top10_customer_share"),
        safe_divide(F.col("products"), total).alias("top10_product_share"),
        safe_divide(F.col("home"), total).alias("uk_share"),
    )


def _home_revenue() -> Column:
    return F.sum(F.when(F.col("country_name") == fixed.HOME_COUNTRY, F.col("gross_revenue")))


def concentration_shares(df: DataFrame, include_operational: bool = False) -> DataFrame:
    """Shares of gross revenue of the best customers and products and of the home country.

    Charges are left out of the products, but not out of the revenue they are
    compared with. A product needs one sold unit, as in the audit. Lines are read once,
    for sums per customer, per product and in all.
    """
    product = ["stock_code", "product_name", "is_operational_code"]
    sums = df.groupingSets([["customer_id"], product, []], "customer_id", *product).agg(
        F.expr("grouping_id()").alias("set"),
        F.sum("gross_revenue").alias("revenue"),
        F.sum("positive_units").alias("units"),
        _home_revenue().alias("home"),
    )
    # A bit for each column that a row is not grouped by, the customer's first.
    sold = F.col("units") >= 1
    if not include_operational:
        sold &= ~F.col("is_operational_code")
    kind = (
        F.when((F.col("set") == 7) & F.col("customer_id").isNotNull(), _CUSTOMER)
        .when((F.col("set") == 8) & sold, _PRODUCT)
        .when(F.col("set") == 15, _TOTAL)
    )
    home = F.when(F.col("set") == 15, F.col("home")).alias("home")
    return _shares(sums.select(kind.alias("kind"), "revenue", home).where("kind IS NOT NULL"))


def _shares_of_reduced(orders: DataFrame, products: DataFrame, include_operational: bool) -> DataFrame:
    """``concentration_shares`` from reduced lines."""
    home = F.lit(None).cast(orders.schema["gross_revenue"].dataType).alias("home")
    customers = metrics.customer_lifetime(orders).select(
        F.lit(_CUSTOMER).alias("kind"), F.col("lifetime_value").alias("revenue"), home
    )
    sold = metrics.product_totals(products, include_operational=include_operational).select(
        F.lit(_PRODUCT).alias("kind"), F.col("gross_revenue").alias("revenue"), home
    )
    total = orders.agg(F.sum("gross_revenue").alias("revenue"), _home_revenue().alias("home")).select(
        F.lit(_TOTAL).alias("kind"), "revenue", "home"
    )
    return _shares(customers.unionByName(sold).unionByName(total))


def top_countries(df: DataFrame, n: int = 10) -> DataFrame:
    return metrics.country_metrics(df).orderBy(F.desc("gross_revenue"), "country_name").limit(n)


def order_frequency_histogram(df: DataFrame, bins: int = 40) -> DataFrame:
    """Customers per bin of order counts: equal bins over [min, max], the last one closed.

    Customers are first counted per order count. Empty bins are left out.
    """
    counts = (
        metrics.customer_order_counts(df)
        .groupBy("order_count")
        .agg(F.count("*").alias("customers"))
    )
    edges = counts.agg(
        F.struct(F.min("order_count").alias("low"), F.max("order_count").alias("high")).alias("e")
    ).scalar()
    placed = counts.withColumn("e", edges)
    span = F.col("e.high") - F.col("e.low")
    # Whole-number arithmetic, so that edges fall on the same side everywhere.
    bin_number = F.when(span == 0, F.lit(0)).otherwise(
        F.least(
            F.expr(f"((order_count - e.low) * {int(bins)}) DIV nullif(e.high - e.low, 0)"),
            F.lit(bins - 1),
        )
    )
    return (
        placed.groupBy(bin_number.cast("bigint").alias("bin"))
        .agg(
            F.min("order_count").alias("min_orders"),
            F.max("order_count").alias("max_orders"),
            F.sum("customers").alias("customer_count"),
        )
        .orderBy("bin")
    )


def ltv_vs_frequency(df: DataFrame) -> DataFrame:
    return metrics.customer_summary(df).select(
        "customer_id",
        "order_count",
        "lifetime_value",
        "recency_bucket",
        "primary_country",
        "recency_days",
    )


def customer_table(df: DataFrame, n: int = 50) -> DataFrame:
    """The best customers; ``format_customer_table`` makes the display texts."""
    return metrics.top_customers_by_ltv(df, n).select(
        "customer_id",
        "lifetime_value",
        "order_count",
        "recency_days",
        "recency_bucket",
        "primary_country",
        "last_order_date",
    )


def format_customer_table(table: DataFrame) -> DataFrame:
    return table.withColumns(
        {
            "lifetime_value": money_text(F.col("lifetime_value")),
            "last_order_date": F.date_format("last_order_date", "yyyy-MM-dd"),
        }
    )


def top_products(
    df: DataFrame, mode: str = "gross", n: int = 15, include_operational: bool = False
) -> DataFrame:
    """Best products by gross or by net revenue."""
    column = "net_revenue" if mode == "net" else "gross_revenue"
    totals = metrics.product_totals(df, include_operational=include_operational)
    return totals.select(
        "stock_code", "product_name", "gross_revenue", "net_revenue", "units_sold", "returned_units"
    ).orderBy(F.desc(column), "stock_code", "product_name").limit(n)


def return_risk_matrix(df: DataFrame, include_operational: bool = False) -> DataFrame:
    """Audited products with revenue: bubble size and the guide lines of both charts.

    The totals are written once; one pass finds the three percentiles.
    """
    totals = land(metrics.product_totals(df, include_operational=include_operational), "product-totals")
    earning = "gross_revenue > 0"
    found = percentile_columns(
        totals,
        {
            "high": Percentile("gross_revenue", fixed.HIGH_REVENUE_PERCENTILE),
            "guide": Percentile("gross_revenue", fixed.HIGH_REVENUE_PERCENTILE, earning),
            "cap": Percentile("units_sold", fixed.BUBBLE_PERCENTILE, earning),
        },
    )
    sold = metrics.with_risk_label(totals, found["high"]).where(earning)
    cap, guide = found["cap"], found["guide"]
    units = F.col("units_sold").cast("double")
    return sold.select(
        "stock_code",
        "product_name",
        "gross_revenue",
        "units_sold",
        "returned_units",
        "return_line_rate",
        "returned_unit_rate",
        "risk_label",
        F.least(F.greatest(units, F.lit(1.0)), cap.cast("double")).alias("bubble_units"),
        guide.cast("double").alias("high_revenue_guide"),
        F.lit(fixed.HIGH_REVENUE_LINE_RATE).alias("line_rate_guide"),
        F.lit(fixed.HIGH_UNIT_RATE).alias("unit_rate_guide"),
    )


def product_audit_table(
    df: DataFrame, n: int = 75, include_operational: bool = False
) -> DataFrame:
    """First rows of the audit; ``format_product_table`` makes the display texts."""
    audit = metrics.product_return_audit(df, include_operational=include_operational)
    return (
        audit.orderBy(*metrics.audit_order())
        .limit(n)
        .select(
            "product_name",
            "stock_code",
            "gross_revenue",
            "units_sold",
            "returned_units",
            "return_line_rate",
            "returned_unit_rate",
            "risk_label",
        )
    )


def format_product_table(table: DataFrame) -> DataFrame:
    return table.withColumns(
        {
            "gross_revenue": money_text(F.col("gross_revenue")),
            "units_sold": count_text(F.col("units_sold")),
            "returned_units": count_text(F.col("returned_units")),
            "return_line_rate": pct_text(F.col("return_line_rate")),
            "returned_unit_rate": pct_text(F.col("returned_unit_rate")),
        }
    )


def geography_kpis(df: DataFrame) -> DataFrame:
    """Five country KPIs in one row; an order in two abroad countries counts twice."""
    home = F.col("country_name") == fixed.HOME_COUNTRY
    gross, orders = F.col("gross_revenue"), F.col("order_count")
    totals = metrics.country_totals(df).agg(
        F.count("*").alias("country_count"),
        F.min_by("country_name", F.struct(-gross, "country_name")).alias("top_country"),
        F.sum(gross).alias("total"),
        F.sum(F.when(home, gross)).alias("home"),
        F.coalesce(F.sum(F.when(~home, gross)), F.lit(0)).alias("international_revenue"),
        F.coalesce(F.sum(F.when(~home, orders)), F.lit(0)).alias("international_order_count"),
    )
    return totals.select(
        "country_count",
        F.coalesce("top_country", F.lit("N/A")).alias("top_country"),
        safe_divide(F.col("home"), F.col("total")).alias("uk_share"),
        "international_revenue",
        "international_order_count",
    )


def country_bubbles(df: DataFrame) -> DataFrame:
    """Country metrics with the customer count clipped to [1, 95th percentile]."""
    countries = metrics.country_metrics(df)
    cap = percentile_columns(countries, {"cap": Percentile("customer_count", fixed.BUBBLE_PERCENTILE)})["cap"].cast(
        "double"
    )
    # A percentile of zero falls back to one.
    top = F.when(cap == 0, F.lit(1.0)).otherwise(cap)
    customers = F.col("customer_count").cast("double")
    return countries.withColumn(
        "bubble_customers", F.least(F.greatest(customers, F.lit(1.0)), top)
    )


def aov_top_countries(df: DataFrame, n: int = 15) -> DataFrame:
    """The countries with most orders, by average order value."""
    busiest = (
        metrics.country_totals(df)
        .select("country_name", "order_count", "aov")
        .orderBy(F.desc("order_count"), "country_name")
        .limit(n)
    )
    return busiest.orderBy("aov", "country_name")


def lineage_counts(raw: DataFrame, cleaned: DataFrame, published: DataFrame) -> DataFrame:
    """Rows at the three stages from raw file to published lines."""

    def stage(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("stage"), "rows")

    return (
        stage(raw, "raw").unionByName(stage(cleaned, "cleaned")).unionByName(
            stage(published, "published")
        )
    )


@dataclass(frozen=True)
class PageFilters:
    start_date: str | None = None
    end_date: str | None = None
    countries: tuple[str, ...] = ()
    include_operational: bool = False
    revenue_mode: str = "gross"


PAGES = ["executive", "customers", "products", "geography", "quality"]


def format_operational_table(table: DataFrame) -> DataFrame:
    return table.withColumns(
        {
            "gross_revenue": money_text(F.col("gross_revenue")),
            "return_value": money_text(F.col("return_value")),
            "units": count_text(F.col("units")),
        }
    )


def shown_exceptions(df: DataFrame) -> DataFrame:
    """The countries that need a manual mapping, or one row that says that there are none."""
    found = metrics.country_exceptions(df).agg(F.sort_array(F.collect_list("country_name")).alias("names"))
    none = F.array(F.lit(fixed.NO_EXCEPTIONS))
    names = F.when(F.size("names") > 0, F.col("names")).otherwise(none)
    return found.select(F.explode(names).alias("country_name"))


def _quality_lineage(published: DataFrame, stages: dict[str, DataFrame]) -> DataFrame:
    """Rows of the earlier stages, and the filtered lines from the sums that the page has."""
    last = published.agg(F.coalesce(F.sum("line_count"), F.lit(0)).alias("rows"))
    rows = last.select(F.lit("published").alias("stage"), "rows")
    for name, table in stages.items():
        rows = rows.unionByName(table.agg(F.count("*").alias("rows")).select(F.lit(name).alias("stage"), "rows"))
    return rows


def page_view(
    fact: DataFrame,
    tab: str,
    filters: PageFilters = PageFilters(),
    stages: dict[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """The tables of one page under the shared filters; an unknown tab is the quality page.

    The filtered lines are read once for each grain that the page needs, customers'
    orders or products, and written in that grain; every table is derived from these. The
    quality page reads lines once more, for the few countries it looks for, and counts the
    rows of the earlier ``stages`` (by name) for its lineage.
    """
    df = metrics.filter_fact(
        fact, filters.start_date, filters.end_date, list(filters.countries) or None
    )
    charges = filters.include_operational
    orders = products = None
    if tab in ("executive", "customers", "geography"):
        orders = land(metrics.reduce_to_orders(df), "page-orders")
    if tab not in ("customers", "geography"):
        products = land(metrics.reduce_to_products(df), "page-products")
    if tab == "executive":
        return {
            "metrics": metrics.executive_metrics(orders),
            "monthly": metrics.monthly_gross_net(orders),
            "top_countries": top_countries(orders, 10),
            "shares": _shares_of_reduced(orders, products, charges),
        }
    if tab == "customers":
        return {
            "metrics": metrics.customer_metrics(orders),
            "top_customers": metrics.top_customers_by_ltv(orders, 15),
            "ltv_vs_frequency": ltv_vs_frequency(orders),
            "order_frequency": order_frequency_histogram(orders),
            "table": format_customer_table(customer_table(orders)),
        }
    if tab == "products":
        return {
            "metrics": metrics.product_metrics(products, charges),
            "top_products": top_products(products, filters.revenue_mode, 15, charges),
            "risk_matrix": return_risk_matrix(products, charges),
            "table": format_product_table(product_audit_table(products, 75, charges)),
        }
    if tab == "geography":
        return {
            "metrics": geography_kpis(orders),
            "top_countries": top_countries(orders, 15),
            "bubbles": country_bubbles(orders),
            "aov": aov_top_countries(orders),
        }
    return {
        "metrics": metrics.data_quality_metrics(products),
        "exceptions": shown_exceptions(df),
        "operational": format_operational_table(metrics.operational_code_summary(products)),
        "lineage": _quality_lineage(products, stages or {}),
    }
