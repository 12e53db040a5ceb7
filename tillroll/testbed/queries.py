"""One query per operator over the given tables, under the operator's name.

Surrogate line keys are left out of published rows: they number lines in load
order. Money is published as double.
"""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.scalars import (
    compact_money_text,
    count_text,
    is_operational,
    money_text,
    pct_text,
    publish,
    recency_bucket,
)
from tillroll.operators import cleaning, quality, star
from tillroll.plans import analytics, metrics, models, pages, semantic
from tillroll.plans.layers import MARTS, MODELS, Layers, register_layers
from tillroll.sources import readers, writers
from tillroll.sources.longform import long_form
from tillroll.sources.schemas import ENRICHED_COLUMNS, STAR_SCHEMAS, conform_to_schema
from tillroll.sources.workspace import fresh_path, landed_once, landed_table
from tillroll.testbed import tables
from tillroll.testbed.longsql import key_columns

Query = Callable[[SparkSession, str], DataFrame]

_PERIOD_START = "1998-01-01"
_SLICE = {
    "start_date": "1996-03-01",
    "end_date": "1997-09-30",
    "countries": ["United Kingdom", "EIRE", "NATION_7"],
}


def _publish_lines(df: DataFrame) -> DataFrame:
    return publish(df.drop("sale_id"))


def _long(frames: dict[str, DataFrame]) -> DataFrame:
    """All values of some tables; the numbers of the lines are left out."""
    return long_form({n: df.drop("sale_id") for n, df in frames.items()}, {n: key_columns(n) for n in frames})


def _on_raw(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: publish(step(tables.raw_lines(spark, sf)))


def _on_text(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: publish(step(tables.raw_text(spark, sf)))


def _on_clean(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: publish(step(tables.clean_lines(spark, sf)))


def _on_star(step: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, sf: _publish_lines(step(tables.star(spark, sf)))


def _on_layers(step: Callable[[Layers], DataFrame]) -> Query:
    return lambda spark, sf: _publish_lines(step(Layers(tables.star(spark, sf))))


def _on_dashboard(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: _publish_lines(step(tables.dashboard_fact(spark, sf)))


def _model(name: str) -> Query:
    return _on_layers(lambda layers: layers[name])


# --- sources and sinks -----------------------------------------------------------


def _union_partitions(raw: DataFrame) -> DataFrame:
    start = F.lit(_PERIOD_START).cast("timestamp_ntz")
    early = F.coalesce(F.col("invoice_date") < start, F.lit(False))
    first = raw.where(early)
    # The second sheet has its columns in another order, and the lines without a date.
    second = raw.where(~early).select(*reversed(raw.columns))
    return cleaning.union_partitions([first, second])


def _read_raw_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "raw-csv")
    text = tables.file_headers(tables.raw_text(spark, sf))
    out = text.write.options(**writers.CSV_OPTIONS).option("encoding", "ISO-8859-1")
    out.csv(path)
    named = cleaning.normalize_headers(readers.read_raw_csv(spark, path))
    return cleaning.apply_header_aliases(named)


def _read_processed_fact(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "extract-csv")
    writers.write_csv(analytics.build_extracts(tables.star(spark, sf))["fact_sales_enriched"], path)
    return _publish_lines(readers.read_processed_fact(spark, path))


def _load_star(spark: SparkSession, sf: str) -> DataFrame:
    return _long(tables.star(spark, sf))


def _write_star(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "star")
    writers.write_star(tables.star(spark, sf), path)
    return _long(readers.load_star(spark, path, views=False))


def _conform(stars: dict[str, DataFrame]) -> DataFrame:
    return conform_to_schema(stars["fact_sales"].drop("is_return"), STAR_SCHEMAS["fact_sales"])


def _stored_layers(spark: SparkSession, sf: str) -> Layers:
    """The layers with the models that others sum up again stored once for each data set.

    All views in one plan would else hold the shuffles of these models several times.
    """
    layers = Layers(tables.star(spark, sf))
    for name in (*quality.SHARED_MODELS, "int_country_metrics"):
        model = layers[name]
        layers = layers.replaced(**{name: landed_table(spark, f"{name}:{sf}", lambda: model)})
    return layers


def _mart_schema(spark: SparkSession, sf: str) -> str:
    """A schema with the marts as tables, saved once for each data set."""

    def write(path: str) -> None:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{path}'")
        register_layers(spark, _stored_layers(spark, sf), schema)

    schema = f"analytics_marts_{crc32(f'{spark.sparkContext.applicationId} {sf}'.encode()):08x}"
    landed_once(spark, f"marts:{sf}", write)
    return schema


def _exported_marts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The marts as exported from the schema and read back."""

    def write(path: str) -> None:
        result = writers.export_marts(spark, path, _mart_schema(spark, sf))
        if not result.complete:
            raise RuntimeError(f"marts not found: {result.missing}")

    path, _ = landed_once(spark, f"marts-csv:{sf}", write)
    return readers.type_mart_exports(spark, path)


def _export_marts(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "marts-csv")
    result = writers.export_marts(spark, path, _mart_schema(spark, sf))
    read_back = readers.type_mart_exports(spark, path)
    return _long({name: read_back[name] for name in result.exported})


def _type_mart_exports(spark: SparkSession, sf: str) -> DataFrame:
    return _long(_exported_marts(spark, sf))


def _export_bi_extracts(spark: SparkSession, sf: str) -> DataFrame:
    extracts = analytics.build_extracts(tables.star(spark, sf))
    path = fresh_path(spark, "extracts-csv")
    writers.export_bi_extracts(extracts, path)
    return _long(readers.read_extracts(spark, path, {name: df.schema for name, df in extracts.items()}))


def _register_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Every model through its view, the marts as tables of their schema."""
    schema = _mart_schema(spark, sf)
    register_layers(spark, _stored_layers(spark, sf))
    return _long({name: spark.table(f"{schema}.{name}" if name in MARTS else name) for name in MODELS})


# --- cleaning ----------------------------------------------------------------------


def _old_headers(raw: DataFrame) -> DataFrame:
    return tables.file_headers(raw, tables.OLD_FILE_HEADERS)


def _named(raw: DataFrame) -> DataFrame:
    return cleaning.apply_header_aliases(cleaning.normalize_headers(_old_headers(raw)))


# --- star ----------------------------------------------------------------------------


def _dim_products(clean: DataFrame) -> DataFrame:
    return star.truncate_strings(star.build_dim_product(clean))


def _keep_known(spark: SparkSession, sf: str) -> DataFrame:
    clean = tables.clean_lines(spark, sf)
    return publish(star.keep_known_products(clean, tables.star(spark, sf)["dim_product"]))


def _build_fact(spark: SparkSession, sf: str) -> DataFrame:
    clean = tables.clean_lines(spark, sf)
    stored = tables.star(spark, sf)
    fact = star.build_fact_sales(clean, stored["dim_country"], stored["dim_product"])
    return _publish_lines(fact)


# --- checks ----------------------------------------------------------------------------


def _relationships(spark: SparkSession, sf: str) -> DataFrame:
    raw = tables.raw_lines(spark, sf)
    products = tables.star(spark, sf)["dim_product"]
    return quality.check_relationships(raw, "stock_code", products, "stock_code")


# --- dashboard ---------------------------------------------------------------------------


def _clean_dashboard(stars: dict[str, DataFrame]) -> DataFrame:
    lines = analytics.build_extracts(stars)["fact_sales_enriched"]
    return metrics.clean_dashboard_fact(lines.select(*ENRICHED_COLUMNS))


def _operational_mask(df: DataFrame) -> DataFrame:
    flag = is_operational(F.col("stock_code"), F.col("product_name")).alias("is_operational_code")
    return df.groupBy("stock_code", "product_name", flag).agg(F.count("*").alias("rows"))


def _recency(df: DataFrame) -> DataFrame:
    days = metrics.customer_summary(df).select("recency_days")
    return days.groupBy(recency_bucket(F.col("recency_days")).alias("recency_bucket")).agg(
        F.count("*").alias("customers"),
        F.min("recency_days").alias("min_days"),
        F.max("recency_days").alias("max_days"),
    )


def _risk_labels(df: DataFrame) -> DataFrame:
    return (
        metrics.label_products(metrics.product_totals(df))
        .groupBy("risk_label")
        .agg(F.count("*").alias("products"), F.sum("gross_revenue").alias("gross_revenue"))
    )


def _lineage(spark: SparkSession, sf: str) -> DataFrame:
    return pages.lineage_counts(
        tables.raw_lines(spark, sf), tables.clean_lines(spark, sf), tables.dashboard_fact(spark, sf)
    )


def _texts(layers: Layers) -> DataFrame:
    monthly = layers["mart_sales_monthly"]
    sales = layers["stg_sales"]
    total = sales.where("is_positive_sale").agg(F.sum("line_revenue")).scalar().cast("double")
    revenue = F.col("revenue").cast("double")
    return monthly.select(
        "month",
        count_text(F.col("invoice_count")).alias("count_text"),
        money_text(revenue).alias("money_text"),
        compact_money_text(revenue).alias("compact_money_text"),
        pct_text(revenue / total).alias("pct_text"),
    )


def _page_view(spark: SparkSession, sf: str) -> DataFrame:
    """All tables of all pages under one set of filters."""
    filters = pages.PageFilters("1996-03-01", "1997-09-30", ("United Kingdom", "EIRE", "NATION_7"))
    stages = {"raw": tables.raw_lines(spark, sf), "cleaned": tables.clean_lines(spark, sf)}
    fact = tables.dashboard_fact(spark, sf)
    return _long(
        {
            f"{tab}.{name}": table
            for tab in pages.PAGES
            for name, table in pages.page_view(fact, tab, filters, stages).items()
        }
    )


# --- semantic layer --------------------------------------------------------------------------


def _calendar(layers: Layers) -> DataFrame:
    return semantic.date_dimension(semantic.calendar_bounds(layers["mart_sales_monthly"]))


def _monthly_by_quarter(layers: Layers) -> DataFrame:
    return semantic.measures_monthly(
        layers["mart_sales_monthly"], _calendar(layers), ["year", "quarter"]
    )


def _monthly_with_calendar(layers: Layers) -> DataFrame:
    return semantic.monthly_with_calendar(_calendar(layers), layers["mart_sales_monthly"])


def _deduped(layers: Layers) -> DataFrame:
    mart = layers["mart_customer_lifetime_value"]
    return readers.dedupe_by_key(mart.unionByName(mart), "customer_id")


def _report(report: Callable[..., DataFrame], *needs: str) -> Query:
    return _on_layers(lambda layers: report(*[layers[n] for n in needs]))


QUERIES: dict[str, Query] = {
    # sources and sinks
    "read_raw_csv": _read_raw_csv,
    "union_partitions": _on_raw(_union_partitions),
    "read_processed_fact": _read_processed_fact,
    "load_star": _load_star,
    "write_star": _write_star,
    "conform_to_schema": _on_star(_conform),
    "export_marts": _export_marts,
    "export_bi_extracts": _export_bi_extracts,
    "register_layers": _register_layers,
    # cleaning
    "normalize_headers": _on_raw(lambda df: cleaning.normalize_headers(_old_headers(df))),
    "apply_header_aliases": _on_raw(_named),
    "ensure_customer_column": _on_raw(
        lambda df: cleaning.ensure_customer_column(df.drop("customer_id"))
    ),
    "require_columns": _on_raw(lambda df: cleaning.require_columns(_named(df))),
    "drop_incomplete": _on_raw(cleaning.drop_incomplete),
    "coerce_customer_id": _on_text(cleaning.coerce_customer_id),
    "cast_types": _on_text(cleaning.cast_types),
    "trim_country": _on_text(cleaning.trim_country),
    "drop_negative_prices": _on_raw(cleaning.drop_negative_prices),
    "flag_cancellations": _on_raw(cleaning.flag_cancellations),
    "transform": _on_raw(lambda df: cleaning.transform(tables.file_headers(df))),
    "clean_row_counts": _on_raw(cleaning.clean_row_counts),
    # star
    "build_dim_country": _on_clean(star.build_dim_country),
    "build_dim_customer": _on_clean(star.build_dim_customer),
    "build_dim_product": _on_clean(star.build_dim_product),
    "truncate_strings": _on_clean(_dim_products),
    "attach_country_key": _on_clean(
        lambda df: star.attach_country_key(df, star.build_dim_country(df))
    ),
    "keep_known_products": _keep_known,
    "build_fact_sales": _build_fact,
    # staging, intermediate, marts
    "stg_sales": _model("stg_sales"),
    "stg_customers": _model("stg_customers"),
    "stg_products": _model("stg_products"),
    "stg_countries": _model("stg_countries"),
    "int_sales_enriched": _model("int_sales_enriched"),
    "int_order_metrics": _model("int_order_metrics"),
    "int_customer_orders": _model("int_customer_orders"),
    "int_customer_lifetime_value": _model("int_customer_lifetime_value"),
    "int_country_metrics": _model("int_country_metrics"),
    **{mart: _model(mart) for mart in MARTS},
    # ad-hoc analyses
    "avg_order_value": _on_star(lambda s: analytics.avg_order_value(s["fact_sales"])),
    "customer_retention": _on_star(lambda s: analytics.customer_retention(s["fact_sales"])),
    "monthly_revenue": _on_star(lambda s: analytics.monthly_revenue(s["fact_sales"])),
    "repeat_purchase_rate": _on_star(lambda s: analytics.repeat_purchase_rate(s["fact_sales"])),
    "top_customers": _on_star(
        lambda s: analytics.top_customers(s["fact_sales"], s["dim_customer"])
    ),
    # extracts
    "fact_sales_enriched": _on_star(lambda s: analytics.build_extracts(s)["fact_sales_enriched"]),
    "extract_monthly_revenue": _on_star(
        lambda s: analytics.extract_monthly_revenue(s["fact_sales"])
    ),
    "extract_top_customers": _on_star(lambda s: analytics.extract_top_customers(s["fact_sales"])),
    "extract_country_revenue": _on_star(
        lambda s: analytics.extract_country_revenue(s["fact_sales"], s["dim_country"])
    ),
    "extract_top_products": _on_star(
        lambda s: analytics.extract_top_products(s["fact_sales"], s["dim_product"])
    ),
    # dashboard metrics
    "clean_dashboard_fact": _on_star(_clean_dashboard),
    "operational_code_mask": _on_dashboard(_operational_mask),
    "filter_operational_codes": _on_dashboard(metrics.filter_operational_codes),
    "filter_fact": _on_dashboard(lambda df: metrics.filter_fact(df, **_SLICE)),
    "executive_metrics": _on_dashboard(metrics.executive_metrics),
    "monthly_gross_net": _on_dashboard(metrics.monthly_gross_net),
    "customer_summary": _on_dashboard(metrics.customer_summary),
    "recency_bucket": _on_dashboard(_recency),
    "customer_metrics": _on_dashboard(metrics.customer_metrics),
    "top_customers_by_ltv": _on_dashboard(metrics.top_customers_by_ltv),
    "product_metrics": _on_dashboard(metrics.product_metrics),
    "product_return_audit": _on_dashboard(metrics.product_return_audit),
    "risk_label": _on_dashboard(_risk_labels),
    "country_metrics": _on_dashboard(metrics.country_metrics),
    "data_quality_metrics": _on_dashboard(metrics.data_quality_metrics),
    "country_exceptions": _on_dashboard(metrics.country_exceptions),
    "operational_code_summary": _on_dashboard(metrics.operational_code_summary),
    # page tables
    "filter_domain": _on_dashboard(pages.filter_domain),
    "concentration_shares": _on_dashboard(pages.concentration_shares),
    "top_countries": _on_dashboard(pages.top_countries),
    "order_frequency_histogram": _on_dashboard(pages.order_frequency_histogram),
    "ltv_vs_frequency": _on_dashboard(pages.ltv_vs_frequency),
    "customer_table": _on_dashboard(pages.customer_table),
    "format_customer_table": _on_dashboard(
        lambda df: pages.format_customer_table(pages.customer_table(df))
    ),
    "top_products": _on_dashboard(lambda df: pages.top_products(df, mode="net")),
    "top_products_gross": _on_dashboard(lambda df: pages.top_products(df, mode="gross")),
    "return_risk_matrix": _on_dashboard(pages.return_risk_matrix),
    "product_audit_table": _on_dashboard(pages.product_audit_table),
    "format_product_table": _on_dashboard(
        lambda df: pages.format_product_table(pages.product_audit_table(df))
    ),
    "geography_kpis": _on_dashboard(pages.geography_kpis),
    "country_bubbles": _on_dashboard(pages.country_bubbles),
    "aov_top_countries": _on_dashboard(pages.aov_top_countries),
    "lineage_counts": _lineage,
    "format_compact_money": _on_layers(_texts),
    "page_view": _page_view,
    # semantic layer
    "measures_executive": _report(semantic.measures_executive, "mart_executive_kpis"),
    "measures_customer": _report(semantic.measures_customer, "mart_customer_lifetime_value"),
    "measures_repeat": _report(semantic.measures_repeat, "mart_repeat_purchase_metrics"),
    "measures_monthly": _on_layers(_monthly_by_quarter),
    "measures_country": _report(semantic.measures_country, "mart_country_revenue"),
    "measures_fact": _report(semantic.measures_fact, "stg_sales"),
    "slicers": _on_layers(
        lambda layers: semantic.slicers(layers["int_sales_enriched"], **_SLICE, is_return=False)
    ),
    "date_dimension": _on_layers(_calendar),
    "monthly_with_calendar": _on_layers(_monthly_with_calendar),
    "type_mart_exports": _type_mart_exports,
    "readable_names": _on_layers(lambda layers: readers.readable_names(layers["mart_country_revenue"])),
    "dedupe_by_key": _on_layers(_deduped),
    "monthly_trend": _report(semantic.monthly_trend, "stg_sales"),
    "top10_countries": _report(semantic.top10_countries, "stg_sales", "stg_countries"),
    "top20_customers": _report(semantic.top20_customers, "stg_sales"),
    "cohort_retention": _report(semantic.cohort_retention, "stg_sales"),
    "cohort_matrix": _report(
        lambda sales: semantic.cohort_matrix(semantic.cohort_retention(sales), 12), "stg_sales"
    ),
    "new_vs_returning": _report(semantic.new_vs_returning, "stg_sales"),
    "top20_products_revenue": _report(semantic.top20_products_revenue, "stg_sales", "stg_products"),
    "top20_products_quantity": _report(
        semantic.top20_products_quantity, "stg_sales", "stg_products"
    ),
    "avg_price_by_product": _report(semantic.avg_price_by_product, "stg_sales", "stg_products"),
    "product_return_rate": _report(semantic.product_return_rate, "stg_sales", "stg_products"),
    "country_contribution": _report(semantic.country_contribution, "stg_sales", "stg_countries"),
    # quality
    "check_not_null": _on_raw(lambda df: quality.check_not_null(df, "description")),
    "check_unique": _on_raw(lambda df: quality.check_unique(df, "invoice_number")),
    "check_accepted_values": _on_raw(
        lambda df: quality.check_accepted_values(df, "country", ["United Kingdom", "EIRE", "USA"])
    ),
    "check_relationships": _relationships,
    "run_quality_suite": _on_layers(quality.run_quality_suite),
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The executive KPI mart, from raw lines to one row."""
    sales = models.stg_sales(tables.star(spark, sf_dir)["fact_sales"])
    return publish(
        models.mart_executive_kpis(
            models.int_order_metrics(sales), models.int_customer_orders(sales)
        )
    )
