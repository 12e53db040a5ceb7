import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from frames import dims, fact, one
from tillroll.plans import models as m
from tillroll.plans import semantic as s
from tillroll.plans.layers import Layers
from tillroll.testbed import tables


def test_cohorts_by_hand(spark):
    f = fact(
        spark,
        ("1", "A", 7, 1, 1, "2010-01-05", "1", False),
        ("2", "A", 7, 1, 1, "2010-03-05", "1", False),
        ("3", "A", 8, 1, 1, "2010-01-09", "1", False),
        ("4", "A", 9, 1, -1, "2010-12-31", "1", True),
        ("5", "A", 9, 1, 1, "2011-01-01", "1", False),
        ("6", "A", None, 1, 1, "2010-01-01", "1", False),
        ("7", "A", 9, 1, 1, None, "1", False),
    )
    sales = m.stg_sales(f)
    got = {
        (r.cohort_month.isoformat(), r.months_since_first): (r.cohort_size, r.retention_pct)
        for r in s.cohort_retention(sales).collect()
    }
    assert got == {
        ("2010-01-01", 0): (2, 100.0), ("2010-01-01", 2): (2, 50.0),
        ("2010-12-01", 0): (1, 100.0), ("2010-12-01", 1): (1, 100.0),
    }
    matrix = {r.cohort_month.month: r for r in s.cohort_matrix(s.cohort_retention(sales), 3).collect()}
    assert (matrix[1]["0"], matrix[1]["1"], matrix[1]["2"]) == (100.0, None, 50.0)
    flow = {
        r.month.isoformat(): (r.new_customers, r.returning_customers)
        for r in s.new_vs_returning(sales).collect()
    }
    assert flow == {
        "2010-01-01": (2, 0), "2010-03-01": (0, 1), "2010-12-01": (1, 0), "2011-01-01": (0, 1),
    }


def test_new_customers_add_up(spark, small):
    sales = Layers(tables.star(spark, small))["stg_sales"]
    new = s.new_vs_returning(sales).agg(F.sum("new_customers")).collect()[0][0]
    assert new == one(s.measures_fact(sales)).total_customers


def test_fact_measures_ignore_returns_and_guests(spark):
    f = fact(
        spark,
        ("1", "A", 7, 1, 2, "2010-01-01", "5", False),
        ("C2", "A", 7, 1, -2, "2010-01-01", "5", True),
        ("3", "A", None, 1, 1, "2010-01-01", "5", False),
        ("4", "A", None, 1, -1, "2010-01-01", "5", False),
    )
    r = one(s.measures_fact(m.stg_sales(f)))
    assert r.total_revenue == Decimal("10.00")
    assert (r.total_orders, r.total_customers, r.return_rate) == (4, 1, 0.25)
    assert r.repeat_purchase_rate == 1.0


def test_calendar(spark):
    bounds = spark.createDataFrame(
        [(dt.date(2011, 12, 30), dt.date(2012, 1, 2))], "first_day date, last_day date"
    )
    rows = s.date_dimension(bounds).orderBy("date").collect()
    assert [tuple(r) for r in rows][1:3] == [
        (dt.date(2011, 12, 31), 2011, 4, 12, "December", "2011-12"),
        (dt.date(2012, 1, 1), 2012, 1, 1, "January", "2012-01"),
    ]
    empty = spark.createDataFrame([], "month date")
    assert s.date_dimension(s.calendar_bounds(empty)).collect() == []


def test_slicers(spark):
    layers = Layers({
        "fact_sales": fact(
            spark,
            ("1", "A", 7, 1, 2, "2010-01-31 23:59", "5", False),
            ("2", "A", 7, 1, 2, "2010-02-01 00:00", "5", False),
            ("3", "A", 7, 2, -2, "2010-01-01", "5", True),
        ),
        **dims(spark),
    })
    lines = layers["int_sales_enriched"]
    ends = {r.invoice_number for r in s.slicers(lines, end_date="2010-01-31").collect()}
    assert ends == {"1", "3"}
    returns = s.slicers(lines, countries=["EIRE"], is_return=True).collect()
    assert [r.invoice_number for r in returns] == ["3"]
    assert s.slicers(lines).count() == 3


def test_active_months_of_any_year(spark):
    """Months far apart, on both sides of a block's border and before the epoch."""
    from tillroll.plans import semantic

    days = ["1887-05-09", "1969-12-31", "1970-01-01", "2010-11-30", "2010-12-01", "2010-12-31", "2016-03-01"]
    rows = [(1, d) for d in days] + [(2, "2010-12-05"), (None, "2010-12-05"), (3, None)]
    sales = spark.createDataFrame(rows, "customer_id bigint, d string").selectExpr("customer_id", "CAST(d AS timestamp_ntz) AS invoice_date")
    found = {(r.customer_id, str(r.month), str(r.cohort_month)) for r in semantic._active_months(sales).collect()}
    months = {d[:8] + "01" for d in days}
    assert found == {(1, m, "1887-05-01") for m in months} | {(2, "2010-12-01", "2010-12-01")}
