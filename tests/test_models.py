from decimal import Decimal

import pytest

from frames import FACT, day, dims, fact, one
from tillroll.plans import analytics as a
from tillroll.plans import models as m
from tillroll.plans.layers import MODELS, Layers
from tillroll.testbed import tables


def test_stored_flag_wins_over_sign(spark):
    f = fact(
        spark,
        ("1", "A", 7, 1, -5, "2010-01-01", "1", False),
        ("2", "A", 7, 1, -5, "2010-01-01", "1", None),
        ("3", "A", 7, 1, 5, "2010-01-01", "1", None),
        ("4", "A", 7, 1, None, "2010-01-01", "1", None),
    )
    got = {r.invoice_number: r.is_return for r in m.stg_sales(f).collect()}
    assert got == {"1": False, "2": True, "3": False, "4": False}


def test_undecided_sale_counts_as_zero(spark):
    f = fact(spark, ("1", "A", 7, 1, 3, "2010-01-01", None, False))
    sales = m.stg_sales(f)
    assert one(sales).is_positive_sale is None
    assert one(m.int_order_metrics(sales)).order_revenue == 0


def test_country_groups_keep_lines_without_country(spark):
    f = fact(
        spark,
        ("1", "A", 7, 1, 2, "2010-01-01", "5", False),
        ("2", "A", None, None, 1, "2010-01-01", "5", False),
        ("3", "A", None, 99, 1, "2010-01-01", "5", False),
    )
    got = {
        r.country_name: (r.country_id, r.invoice_count, r.customer_count, float(r.total_revenue))
        for r in m.int_country_metrics(m.stg_sales(f), dims(spark)["dim_country"]).collect()
    }
    assert got == {"United Kingdom": (1, 1, 1, 10.0), None: (None, 2, 0, 10.0)}


def test_empty_marts(spark):
    layers = Layers({"fact_sales": fact(spark), **dims(spark)})
    kpis = one(layers["mart_executive_kpis"])
    assert (kpis.total_invoices, kpis.total_customers) == (0, 0)
    assert kpis.total_revenue is None and kpis.aov is None and kpis.repeat_purchase_rate is None
    repeat = one(layers["mart_repeat_purchase_metrics"])
    assert (repeat.repeat_customers, repeat.repeat_purchase_rate) == (0, None)


def test_null_month_is_last(spark):
    f = fact(
        spark,
        ("1", "A", 7, 1, 2, None, "5", False),
        ("2", "A", 7, 1, 2, "2010-02-03", "5", False),
    )
    months = [r.month for r in m.mart_sales_monthly(m.stg_sales(f)).collect()]
    assert months == [day("2010-02-01").date(), None]


def test_unknown_layer(spark):
    with pytest.raises(KeyError):
        Layers({})["mart_of_nothing"]


def test_marts_agree(spark, small):
    layers = Layers(tables.star(spark, small))
    kpis = one(layers["mart_executive_kpis"])
    months = layers["mart_sales_monthly"].collect()
    lands = layers["mart_country_revenue"].collect()
    assert sum(r.revenue for r in months) == kpis.total_revenue == sum(
        r.total_revenue for r in lands
    )
    repeat = one(layers["mart_repeat_purchase_metrics"])
    assert repeat.total_customers == kpis.total_customers
    assert repeat.repeat_purchase_rate == kpis.repeat_purchase_rate
    assert len(MODELS) == 14


def test_top_k_ties_are_settled(spark):
    rows = [(str(i), "A", i, 1, 1, "2010-01-01", "5", False) for i in range(30)]
    f = fact(spark, *rows)
    customers = spark.createDataFrame([(i,) for i in range(30)], "customer_id bigint")
    top = [r.customer_id for r in a.top_customers(f, customers).collect()]
    assert top == list(range(20))
    assert len(a.extract_top_customers(f).collect()) == 30


def test_rounding_is_half_up(spark):
    f = fact(
        spark,
        ("1", "A", 7, 1, 1, "2010-01-01", "1.00", False),
        ("2", "A", 7, 1, 1, "2010-01-01", "1.01", False),
    )
    assert one(a.avg_order_value(f)).avg_order_value == Decimal("1.01")
    rows = [("1", "A", 7, 1, -1 if i == 0 else 1, "2010-01-01", "1", False) for i in range(800)]
    product = one(a.extract_top_products(fact(spark, *rows), dims(spark)["dim_product"]))
    assert product.return_rate_percentage == Decimal("0.13")


def test_ad_hoc_on_nothing(spark):
    f = fact(spark)
    assert one(a.avg_order_value(f)).avg_order_value is None
    assert one(a.repeat_purchase_rate(f)).repeat_purchase_rate_pct is None
    assert a.monthly_revenue(f).collect() == []
