import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from frames import lines, one
from tillroll.functions import scalars as sc
from tillroll.plans import metrics as m
from tillroll.plans import pages as p
from tillroll.sources.schemas import ENRICHED_COLUMNS, string_schema

UK = "United Kingdom"


def test_lenient_typing_of_text(spark):
    text = spark.createDataFrame(
        [
            ("1", "C1", None, "12.0", "2.9", "2010-02-03T04:05:06", "1.50", "x", "9", None, None),
            ("2", None, "A", "abc", "many", "someday", "cheap", "x", "9", "EIRE", "Checked cloth"),
            ("3", "5", "A", None, "-3", None, "2", "x", "9", "EIRE", "cloth"),
        ],
        string_schema(ENRICHED_COLUMNS),
    )
    a, b, c = sorted(m.clean_dashboard_fact(text).collect(), key=lambda r: r.sale_id)
    assert (a.customer_id, a.quantity, float(a.unit_price)) == (12, 2, 1.5)
    assert (a.month, float(a.gross_revenue), a.is_cancel_invoice) == (dt.date(2010, 2, 1), 3.0, True)
    assert (a.country_name, a.stock_code, a.product_name) == ("Unknown",) * 3
    assert (b.customer_id, b.quantity, float(b.unit_price), b.invoice_date) == (None, 0, 0.0, None)
    assert b.is_operational_code and not b.is_cancel_invoice and b.month is None
    assert (c.is_return, c.returned_units, float(c.return_value), c.positive_units) == (True, 3, 6.0, 0)


@pytest.mark.parametrize(
    "code, name, flagged",
    [
        ("m", "x", True), (" post ", "x", True), ("POSTER", "x", True), ("MX", "x", False),
        ("10", "Lost items", True), ("10", "checked shirt", True), ("10", "shirt", False),
        ("DCGS0001", "x", True), (None, None, False), ("10", "SAMPLE", True),
    ],
)
def test_operational_codes(spark, code, name, flagged):
    df = spark.createDataFrame([(code, name)], "c string, n string")
    assert df.select(sc.is_operational(F.col("c"), F.col("n"))).collect()[0][0] is flagged


def test_end_date_takes_in_the_next_midnight(spark):
    df = lines(
        spark,
        [
            ("1", "A", 1, 1, "2010-01-31 23:59:00", "1", UK, "x"),
            ("2", "A", 1, 1, "2010-02-01 00:00:00", "1", UK, "x"),
            ("3", "A", 1, 1, "2010-02-01 00:01:00", "1", UK, "x"),
            ("4", "A", 1, 1, None, "1", UK, "x"),
        ],
    )
    got = {r.invoice_number for r in m.filter_fact(df, end_date="2010-01-31").collect()}
    assert got == {"1", "2"}
    assert m.filter_fact(df).count() == 4
    assert m.filter_fact(df, countries=["EIRE"]).count() == 0


def test_summary_ties_and_recency_edges(spark):
    df = lines(
        spark,
        [
            ("1", "A", 1, 1, "2010-03-02 12:00", "5", "Spain", "x"),
            ("2", "A", 2, 1, "2010-01-31 12:00", "5", "Spain", "x"),
            ("3", "A", 2, 1, "2010-01-30 12:00", "5", "EIRE", "x"),
            ("4", "A", 3, 1, "2010-01-30 12:00", "5", "Spain", "x"),
            ("5", "A", 4, 1, "2010-03-01 10:00", "5", "Spain", "x"),
            ("6", "A", 5, 1, None, "5", "Spain", "x"),
            ("7", "A", None, 1, "2011-01-01 10:00", "5", "Spain", "x"),
        ],
    )
    got = {r.customer_id: r for r in m.customer_summary(df).collect()}
    assert set(got) == {"1", "2", "3", "4", "5"}
    assert got["2"].primary_country == "EIRE"
    assert (got["2"].recency_days, got["2"].recency_bucket) == (30, "0-30 days")
    assert (got["3"].recency_days, got["3"].recency_bucket) == (31, "31-90 days")
    assert got["4"].recency_days == 1
    assert (got["5"].recency_days, got["5"].recency_bucket) == (None, None)


def test_top_customers_are_the_head_of_the_summary(spark):
    rows = [
        (str(i), "A", i % 7, 1 + i % 3, "2010-01-01", str(i % 5 + 1), ["EIRE", UK][i % 2], "x")
        for i in range(60)
    ]
    df = lines(spark, rows)
    order = [F.desc("lifetime_value"), F.asc("customer_id")]
    whole = m.customer_summary(df).orderBy(*order).limit(3).collect()
    assert m.top_customers_by_ltv(df, 3).collect() == whole


def test_kpis_on_nothing_are_zero(spark):
    df = lines(spark, [("1", "A", 1, 1, "2010-01-01", "1", UK, "x")]).where("false")
    e = one(m.executive_metrics(df))
    assert all(v == 0 for v in e)
    c = one(m.customer_metrics(df))
    assert all(v == 0 for v in c)
    assert all(v == 0 for v in one(m.product_metrics(df)))
    assert all(v == 0 for v in one(m.data_quality_metrics(df)))
    for table in (
        m.customer_summary, m.product_return_audit, m.country_metrics, m.country_exceptions,
        m.operational_code_summary, m.monthly_gross_net, p.order_frequency_histogram,
        p.return_risk_matrix, p.country_bubbles, p.customer_table,
    ):
        assert table(df).collect() == []
    g = one(p.geography_kpis(df))
    assert (g.country_count, g.top_country, g.uk_share) == (0, "N/A", 0.0)
    assert all(v == 0 for v in one(p.concentration_shares(df)))


def test_risk_labels_in_order(spark):
    cases = [
        (100.0, 0.08, 0.0, "High revenue / high return"),
        (99.0, 0.08, 0.0, "Normal"),
        (99.0, 0.15, 0.5, "High return rate"),
        (99.0, 0.14, 0.10, "Unit return risk"),
    ]
    df = spark.createDataFrame([c[:3] for c in cases], "g double, l double, u double")
    label = sc.risk_label(F.col("g"), F.lit(100.0), F.col("l"), F.col("u"))
    assert [r[0] for r in df.select(label).collect()] == [c[3] for c in cases]


def test_audit_filters_before_the_percentile(spark):
    rows = [(str(i), f"P{i}", 1, 10, "2010-01-01", str(i), UK, "x") for i in range(1, 5)]
    rows += [("C9", f"R{i}", 1, -1, "2010-01-01", "1", UK, "x") for i in range(20)]
    got = m.product_return_audit(lines(spark, rows)).collect()
    assert [r.stock_code for r in got] == ["P4", "P3", "P2", "P1"]


def test_metric_cross_checks(spark, small):
    from tillroll.testbed import tables

    df = tables.dashboard_fact(spark, small)
    shares = m.country_metrics(df).agg(F.sum("revenue_share")).collect()[0][0]
    assert shares == pytest.approx(1.0)
    exact = one(m.customer_metrics(df)).median_ltv
    assert one(m.customer_metrics(df, approximate=True)).median_ltv == pytest.approx(exact, rel=0.01)
    histogram = p.order_frequency_histogram(df)
    counted = histogram.agg(F.sum("customer_count")).collect()[0][0]
    assert counted == one(m.customer_metrics(df)).known_customers


def test_histogram_edges(spark):
    one_value = lines(spark, [("1", "A", 1, 1, "2010-01-01", "1", UK, "x")])
    assert one(p.order_frequency_histogram(one_value)).asDict() == {
        "bin": 0, "min_orders": 1, "max_orders": 1, "customer_count": 1,
    }
    rows = [(f"{c}-{i}", "A", c, 1, "2010-01-01", "1", UK, "x") for c in (1, 2, 3) for i in range(c)]
    got = [(r.bin, r.customer_count) for r in p.order_frequency_histogram(lines(spark, rows), 2).collect()]
    assert got == [(0, 1), (1, 2)]


def test_display_texts(spark):
    df = spark.createDataFrame(
        [(1234567.0,), (1234.0,), (999.5,), (-2500.0,), (0.0,)], "v double"
    )
    v = F.col("v")
    got = [
        tuple(r)
        for r in df.select(
            sc.money_text(v), sc.count_text(v), sc.compact_money_text(v), sc.pct_text(v / 1000)
        ).collect()
    ]
    assert got == [
        ("£1,234,567", "1,234,567", "£1.23M", "123456.7%"),
        ("£1,234", "1,234", "£1.2K", "123.4%"),
        ("£1,000", "1,000", "£1,000", "100.0%"),
        ("£-2,500", "-2,500", "£-2.5K", "-250.0%"),
        ("£0", "0", "£0", "0.0%"),
    ]


def test_pages(spark, small):
    from tillroll.testbed import tables

    df = tables.dashboard_fact(spark, small)
    assert {tab: sorted(p.page_view(df, tab)) for tab in p.PAGES}["geography"] == [
        "aov", "bubbles", "metrics", "top_countries",
    ]
    assert sorted(p.page_view(df, "anything")) == sorted(p.page_view(df, "quality"))
    net = p.page_view(df, "products", p.PageFilters(revenue_mode="net", include_operational=True))
    values = [r.net_revenue for r in net["top_products"].collect()]
    assert values == sorted(values, reverse=True) and len(values) == 15
    table = p.format_customer_table(p.customer_table(df, 3)).collect()
    assert all(r.lifetime_value.startswith("£") and len(r.last_order_date) == 10 for r in table)


def test_money_stays_exact(spark):
    df = lines(spark, [(str(i), "A", 1, 1, "2010-01-01", "0.10", UK, "x") for i in range(1000)])
    assert one(m.executive_metrics(df)).gross_revenue == Decimal("100.00")


def test_no_readable_number_is_lost(spark):
    rows = [("1", "3000000000", "1.23456", "12/1/2010 8:26"), ("2", "2", "1e17", "2010-12-01"), ("3", "x", "y", "z")]
    text = spark.createDataFrame(
        [(int(i), f"i{i}", "A", "7", q, d, p, "UK", "thing") for i, q, p, d in rows],
        "sale_id bigint, invoice_number string, stock_code string, customer_id string, quantity string,"
        " invoice_date string, unit_price string, country_name string, product_name string",
    )
    a, b, c = sorted(m.clean_dashboard_fact(text).collect(), key=lambda r: r.sale_id)
    assert a.quantity == 3_000_000_000 and float(a.unit_price) == 1.23456
    assert float(a.line_revenue) == 3703680000.0 and a.invoice_date.day == 1
    assert float(b.unit_price) == 1e17 and b.month.isoformat() == "2010-12-01"
    assert c.quantity == 0 and c.unit_price == 0 and c.invoice_date is None
