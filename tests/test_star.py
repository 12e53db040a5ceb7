from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from frames import CLEAN, day
from tillroll.operators import star as s


def clean(spark, *rows):
    return spark.createDataFrame(list(rows), CLEAN)


def line(inv="1", code="A", name="x", qty=1, ts="2010-01-01", price=1.0, cust=1, land="UK"):
    return (inv, code, name, qty, day(ts) if ts else None, price, cust, land, inv.startswith("C"))


def test_countries_are_numbered_by_name_without_null(spark):
    df = clean(spark, line(land="Spain"), line(land="EIRE"), line(land=None), line(land="Spain"))
    got = sorted(map(tuple, s.build_dim_country(df).collect()))
    assert got == [(1, "EIRE"), (2, "Spain")]


def test_countries_over_many_partitions_keep_name_order(spark):
    names = [f"country {i:04d}" for i in range(500)]
    df = clean(spark, *[line(land=n) for n in names * 2]).repartition(7)
    got = [r.country_name for r in s.build_dim_country(df).orderBy("country_id").collect()]
    assert got == names


def test_latest_line_gives_the_product(spark):
    df = clean(
        spark,
        line("1", name="old", ts="2010-01-01", price=1.0),
        line("2", name="new", ts="2010-03-01", price=2.345),
        line("3", name="mid", ts="2010-02-01", price=3.0),
    )
    r = s.build_dim_product(df).collect()[0]
    assert (r.description, r.unit_price_reference) == ("new", Decimal("2.35"))


def test_undated_line_wins_and_ties_are_settled(spark):
    df = clean(spark, line("1", name="dated", ts="2011-01-01"), line("2", name="undated", ts=None))
    assert s.build_dim_product(df).collect()[0].description == "undated"
    tied = clean(spark, line("1", name="a"), line("1", name="b"), line("0", name="z"))
    assert s.build_dim_product(tied).collect()[0].description == "b"


def test_long_codes(spark):
    long_a, long_b = "X" * 30 + "A", "X" * 30 + "B"
    df = clean(
        spark, line(code=long_a, name="first"), line(code=long_b, name="second"),
        line(code="Y" * 30, name="n" * 300),
    )
    dim = s.truncate_strings(s.build_dim_product(df))
    got = {r.stock_code: r.description for r in dim.collect()}
    assert got == {"X" * 30: "first", "Y" * 30: "n" * 255}
    joined = s.build_fact_sales(df, s.build_dim_country(df), dim)
    by_length = s.build_fact_sales(df, s.build_dim_country(df))
    assert [r.stock_code for r in joined.collect()] == ["Y" * 30]
    assert [r.stock_code for r in by_length.collect()] == ["Y" * 30]


def test_known_products_by_join_and_by_length_agree(spark):
    codes = ["A", "B" * 30, "B" * 31, "B" * 32, "", " ", "C" * 29]
    df = clean(spark, *[line(inv=str(i), code=code) for i, code in enumerate(codes)])
    dim = s.truncate_strings(s.build_dim_product(df))
    by_join = {r.invoice_number for r in s.keep_known_products(df, dim).collect()}
    by_length = {r.invoice_number for r in s._known_by_length(df).collect()}
    assert by_join == by_length == {"0", "1", "4", "5", "6"}


def test_sale_id_is_unique_and_stable(spark):
    df = clean(spark, *[line(inv=str(i % 3)) for i in range(1000)]).repartition(9)
    fact = s.build_fact_sales(df, s.build_dim_country(df))
    ids = {r.sale_id for r in fact.collect()}
    assert len(ids) == 1000 and min(ids) > 0
    again = {(r.sale_id, r.invoice_number) for r in fact.collect()}
    assert again == {(r.sale_id, r.invoice_number) for r in fact.collect()}


def test_numbers_need_no_shuffle_and_no_join(spark):
    df = clean(spark, *[line(inv=str(i)) for i in range(100)])
    plan = s.number_rows(df, "n")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and "Window" not in plan


def test_null_country_and_guest(spark):
    df = clean(spark, line(land=None, cust=None))
    r = s.build_fact_sales(df, s.build_dim_country(df)).collect()[0]
    assert r.country_id is None and r.customer_id is None
    assert s.build_dim_customer(df).count() == 0


def test_invoice_number_is_cut(spark):
    df = clean(spark, line(inv="9" * 25))
    fact = s.build_fact_sales(df, s.build_dim_country(df))
    assert fact.select(F.length("invoice_number")).collect()[0][0] == 20


def test_empty_star(spark):
    df = clean(spark)
    assert s.build_fact_sales(df, s.build_dim_country(df)).count() == 0
    assert s.truncate_strings(s.build_dim_product(df)).count() == 0


@pytest.mark.parametrize("step", [s.build_dim_customer, s.build_dim_product])
def test_dimensions_combine_before_the_shuffle(spark, step):
    plan = step(clean(spark, line()))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Aggregate") < plan.index("Exchange")


def test_keys_never_run_into_each_other(spark, monkeypatch):
    """More rows in a file than a key has room for are an error, not equal keys."""
    from tillroll.operators import star

    assert star.number_rows(spark.range(100).coalesce(1), "key").select("key").distinct().count() == 100
    monkeypatch.setattr(star, "_PLACE_BITS", 4)
    with pytest.raises(Exception, match="line keys"):
        star.number_rows(spark.range(100).coalesce(1), "key").collect()
