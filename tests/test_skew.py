"""A code, customer and country that hold most lines: whole results, split joins."""

import pytest
from pyspark.sql import functions as F

from tillroll.operators import star
from tillroll.plans import analytics, metrics
from tillroll.sources.workspace import land


@pytest.fixture(scope="module")
def hot_lines(spark):
    hot = F.col("id") % 3 < 2
    lines = spark.range(0, 60_000, numPartitions=8).select(
        F.concat(F.lit("I"), (F.col("id") % 9000).cast("string")).alias("invoice_number"),
        F.when(hot, "HOT").otherwise(F.concat(F.lit("P"), (F.col("id") % 500).cast("string")))
        .alias("stock_code"),
        F.lit("thing").alias("description"),
        F.lit(1).alias("quantity"),
        F.lit("2010-01-01").cast("timestamp_ntz").alias("invoice_date"),
        F.lit(2.0).alias("unit_price"),
        F.when(hot, 1).otherwise(F.col("id") % 700).cast("bigint").alias("customer_id"),
        F.when(hot, "EIRE").otherwise("Spain").alias("country"),
        F.lit(False).alias("is_return"),
    )
    return land(lines, "hot-lines")


@pytest.fixture
def small_limits(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def test_line_lookup_of_a_hot_code_is_split(spark, hot_lines, small_limits):
    countries = star.build_dim_country(hot_lines)
    products = land(star.truncate_strings(star.build_dim_product(hot_lines)), "hot-products")
    fact = star.build_fact_sales(hot_lines, countries, products)
    lines = analytics.fact_sales_enriched(fact, countries, products)
    assert lines.where("product_name = 'thing' AND country_name IS NOT NULL").count() == 60_000
    kept = star.keep_known_products(hot_lines, products)
    assert kept.count() == 60_000
    rows = kept.select("stock_code", "invoice_number", "customer_id")
    rows.collect()
    assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()


def test_hot_customer_and_country_give_whole_sums(spark, hot_lines):
    countries = star.build_dim_country(hot_lines)
    fact = star.build_fact_sales(hot_lines, countries)
    products = star.truncate_strings(star.build_dim_product(hot_lines))
    df = metrics.clean_dashboard_fact(analytics.fact_sales_enriched(fact, countries, products))
    best = metrics.top_customers_by_ltv(df, 1).collect()[0]
    assert (best.customer_id, best.primary_country) == ("1", "EIRE")
    assert float(best.lifetime_value) == float(
        hot_lines.where("customer_id = 1").count() * 2
    )
    assert sum(r.order_count for r in metrics.country_metrics(df).collect()) == (
        hot_lines.select("country", "invoice_number").distinct().count()
    )
