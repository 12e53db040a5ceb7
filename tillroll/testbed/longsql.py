"""The long form of a set of tables as SQL for DuckDB, from the columns and kinds of each."""

from __future__ import annotations

#: Key columns and columns of each published table. Kinds: t text, n number, b flag, d date or time.
TABLES = {
    "dim_country": ("country_id", "country_id n, country_name t"),
    "dim_customer": ("customer_id", "customer_id n"),
    "dim_product": ("stock_code", "stock_code t, description t, unit_price_reference n"),
    "fact_sales": (
        "invoice_number",
        "invoice_number t, stock_code t, customer_id n, country_id n, quantity n, invoice_date d, unit_price n, is_return b",
    ),
    "stg_sales": (
        "invoice_number",
        "invoice_number t, stock_code t, customer_id n, country_id n, quantity n, invoice_date d, unit_price n,"
        " is_return b, line_revenue n, is_positive_sale b",
    ),
    "stg_customers": ("customer_id", "customer_id n"),
    "stg_products": ("stock_code", "stock_code t, product_name t, unit_price_reference n"),
    "stg_countries": ("country_id", "country_id n, country_name t"),
    "int_sales_enriched": (
        "invoice_number",
        "invoice_number t, stock_code t, customer_id n, country_id n, quantity n, invoice_date d, sales_month d,"
        " unit_price n, is_return b, line_revenue n, is_positive_sale b, product_name t, unit_price_reference n, country_name t",
    ),
    "int_order_metrics": (
        "invoice_number",
        "invoice_number t, first_invoice_date d, last_invoice_date d, line_count n, order_revenue n, quantity_sold n,"
        " includes_return b, known_customer_count n",
    ),
    "int_customer_orders": (
        "customer_id",
        "customer_id n, first_order_date d, last_order_date d, order_count n, total_revenue n, is_repeat_customer b",
    ),
    "int_customer_lifetime_value": (
        "customer_id",
        "customer_id n, first_order_date d, last_order_date d, order_count n, total_revenue n, customer_lifetime_value n",
    ),
    "int_country_metrics": (
        "country_id",
        "country_id n, country_name t, total_revenue n, invoice_count n, customer_count n, quantity_sold n, aov n",
    ),
    "mart_executive_kpis": (
        "",
        "total_revenue n, total_invoices n, total_customers n, aov n, repeat_purchase_rate n, total_quantity_sold n",
    ),
    "mart_customer_lifetime_value": (
        "customer_id",
        "customer_id n, total_revenue n, order_count n, first_order_date d, last_order_date d, customer_lifetime_value n",
    ),
    "mart_repeat_purchase_metrics": ("", "repeat_customers n, total_customers n, repeat_purchase_rate n"),
    "mart_country_revenue": (
        "country_name",
        "country_name t, total_revenue n, invoice_count n, customer_count n, aov n",
    ),
    "mart_sales_monthly": ("month", "month d, revenue n, invoice_count n, quantity_sold n"),
    "fact_sales_enriched": (
        "invoice_number",
        "invoice_number t, stock_code t, customer_id n, quantity n, invoice_date d, unit_price n, is_return b,"
        " line_revenue n, country_name t, product_name t",
    ),
    "monthly_revenue": ("month", "month d, revenue n"),
    "top_customers": ("customer_id", "customer_id n, lifetime_value n, total_orders n"),
    "country_revenue": ("country_name", "country_name t, revenue n, order_count n"),
    "top_products": (
        "stock_code",
        "product_name t, stock_code t, revenue n, units_sold n, avg_price n, return_rate_percentage n",
    ),
    "executive.metrics": (
        "",
        "gross_revenue n, net_revenue n, return_value n, total_units_sold n, active_customers n, total_transactions n,"
        " average_order_value n, repeat_purchase_rate n",
    ),
    "executive.monthly": ("month", "month d, gross_revenue n, net_revenue n"),
    "executive.top_countries": (
        "country_name",
        "country_name t, gross_revenue n, net_revenue n, order_count n, customer_count n, units_sold n, aov n, revenue_share n",
    ),
    "executive.shares": ("", "top_customer_share n, top10_customer_share n, top10_product_share n, uk_share n"),
    "customers.metrics": (
        "",
        "known_customers n, guest_row_rate n, repeat_purchase_rate n, median_ltv n, avg_order_frequency n",
    ),
    "customers.top_customers": (
        "customer_id",
        "customer_id t, lifetime_value n, order_count n, last_order_date d, recency_days n, recency_bucket t, primary_country t",
    ),
    "customers.ltv_vs_frequency": (
        "customer_id",
        "customer_id t, order_count n, lifetime_value n, recency_bucket t, primary_country t, recency_days n",
    ),
    "customers.order_frequency": ("bin", "bin n, min_orders n, max_orders n, customer_count n"),
    "customers.table": (
        "customer_id",
        "customer_id t, lifetime_value t, order_count n, recency_days n, recency_bucket t, primary_country t, last_order_date t",
    ),
    "products.metrics": (
        "",
        "product_count n, units_sold n, returned_units n, return_value n, return_line_rate n, returned_unit_rate n",
    ),
    "products.top_products": (
        "stock_code, product_name",
        "stock_code t, product_name t, gross_revenue n, net_revenue n, units_sold n, returned_units n",
    ),
    "products.risk_matrix": (
        "stock_code, product_name",
        "stock_code t, product_name t, gross_revenue n, units_sold n, returned_units n, return_line_rate n,"
        " returned_unit_rate n, risk_label t, bubble_units n, high_revenue_guide n, line_rate_guide n, unit_rate_guide n",
    ),
    "products.table": (
        "stock_code, product_name",
        "product_name t, stock_code t, gross_revenue t, units_sold t, returned_units t, return_line_rate t,"
        " returned_unit_rate t, risk_label t",
    ),
    "geography.metrics": (
        "",
        "country_count n, top_country t, uk_share n, international_revenue n, international_order_count n",
    ),
    "geography.top_countries": (
        "country_name",
        "country_name t, gross_revenue n, net_revenue n, order_count n, customer_count n, units_sold n, aov n, revenue_share n",
    ),
    "geography.bubbles": (
        "country_name",
        "country_name t, gross_revenue n, net_revenue n, order_count n, customer_count n, units_sold n, aov n,"
        " revenue_share n, bubble_customers n",
    ),
    "geography.aov": ("country_name", "country_name t, order_count n, aov n"),
    "quality.metrics": (
        "",
        "processed_fact_rows n, null_customer_rows n, return_rows n, cancel_invoice_rows n, zero_price_rows n,"
        " outlier_rows n, operational_rows n, operational_stock_codes n, null_customer_rate n",
    ),
    "quality.exceptions": ("country_name", "country_name t"),
    "quality.operational": (
        "stock_code, product_name",
        "stock_code t, product_name t, rows n, gross_revenue t, return_value t, units t",
    ),
    "quality.lineage": ("stage", "stage t, rows n"),
}


def key_columns(name: str) -> list[str]:
    return [c for c in TABLES[name][0].split(", ") if c]


def _long_select(name: str, source: str) -> str:
    cells = []
    for column, kind in (c.split() for c in TABLES[name][1].split(", ")):
        number = {"n": f"{column}::DOUBLE", "b": f"{column}::INT::DOUBLE"}.get(kind, "NULL::DOUBLE")
        text = f"{column}::VARCHAR" if kind == "t" else "NULL::VARCHAR"
        time = f"{column}::TIMESTAMP" if kind == "d" else "NULL::TIMESTAMP"
        cells.append(
            f"{{'measure': '{column}', 'text_value': {text}, 'number_value': {number}, 'time_value': {time}}}"
        )
    row_key = ", ".join(["'|'", *[f"{c}::VARCHAR" for c in key_columns(name)]])
    row_key = f"concat_ws({row_key})" if key_columns(name) else "''"
    return (
        f"SELECT '{name}' AS table_name, {row_key} AS row_key, unnest([{', '.join(cells)}], recursive := true)"
        f" FROM ({source})"
    )


def long_sql(sources: dict[str, str]) -> str:
    """One query over the tables' own queries."""
    return "\nUNION ALL ".join(_long_select(name, source) for name, source in sources.items())
