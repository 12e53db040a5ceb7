"""What the physical plans must and must not contain."""

import pytest

from tillroll.testbed.queries import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join_and_no_python(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval", "InArrow", "InPandas"):
        assert bad not in text


def test_filters_and_columns_reach_the_scan(spark, small):
    from tillroll.plans import metrics
    from tillroll.testbed import tables

    df = metrics.filter_fact(
        tables.dashboard_fact(spark, small), "1996-01-01", "1996-12-31", ["EIRE"]
    )
    text = plan(metrics.monthly_gross_net(df))
    scan = text[text.index("FileScan"):]
    assert "GreaterThanOrEqual(invoice_date" in scan and "EqualTo(country_name" in scan
    columns = scan[scan.index("ReadSchema"):]
    assert "product_name" not in columns and "stock_code" not in columns


def test_dim_product_is_combined_before_the_shuffle(spark, small):
    text = plan(QUERIES["build_dim_product"](spark, small))
    assert text.count("Exchange hashpartitioning") == 1


def test_fact_build_has_no_hash_shuffle_of_lines(spark, small):
    from tillroll.operators import star
    from tillroll.testbed import tables

    clean = tables.clean_lines(spark, small)
    countries = tables.star(spark, small)["dim_country"]
    keyed = star.attach_country_key(star._known_by_length(clean), countries)
    assert "Exchange hashpartitioning" not in plan(star.fact_columns(keyed))


def scans(text):
    return text.count("FileScan")


def test_risk_matrix_is_one_scan_of_stored_totals(spark, small):
    text = plan(QUERIES["return_risk_matrix"](spark, small))
    assert scans(text) == 1 and "Exchange" not in text


def test_shares_read_lines_once(spark, small):
    text = plan(QUERIES["concentration_shares"](spark, small))
    assert scans(text) == 1 and text.count("WindowGroupLimit") >= 1


def test_customer_summary_shuffles_lines_once(spark, small):
    text = plan(QUERIES["customer_summary"](spark, small))
    assert scans(text) <= 2  # the lines, and their newest date
    assert text.count("Exchange hashpartitioning(customer_id#") == 4
    assert "Join" not in text


@pytest.mark.parametrize("tab, most", [("executive", 2), ("customers", 1), ("products", 1), ("geography", 1), ("quality", 2)])
def test_pages_read_lines_once_for_each_grain(spark, small, tab, most):
    """What is landed are sums; only the landing and the exceptions read lines."""
    from tillroll.plans import pages
    from tillroll.testbed import tables

    fact = tables.dashboard_fact(spark, small)
    lines = fact.inputFiles()[0].rsplit("/", 1)[0].replace("file://", "")
    read = [lines in plan(df) for df in pages.page_view(fact, tab).values()]
    assert sum(read) == (1 if tab == "quality" else 0)
