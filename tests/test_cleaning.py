import datetime as dt

import pytest

from frames import RAW
from tillroll.operators import cleaning as c


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW)


def row(invoice="1", code="A", name="x", qty="1", ts="2010-01-01 00:00:00", price="1", cust="1",
        land="UK"):
    return (invoice, code, name, qty, ts, price, cust, land)


def test_header_variants_map_to_one_schema(spark):
    old = spark.createDataFrame(
        [("1", "A", "x", "1", "2010-01-01", "2.5", "7", "UK")],
        ["InvoiceNo", "Stock Code", " Description", "quantity", "Invoice_Date", "Unit Price",
         "CustomerID", "COUNTRY"],
    )
    found = c.transform(old).collect()[0]
    assert (found.invoice_number, found.unit_price, found.customer_id) == ("1", 2.5, 7)


def test_customer_ids(spark):
    values = {
        "12345.0": 12345, "12345": 12345, " 77 ": 77, "abc": None, "": None, None: None,
        "GUEST": None, "1e400": None, "nan": None, "12d": None, "1e3": 1000,
        "9007199254740993": 9007199254740993, "99999999999999999999": None,
    }
    df = raw(spark, *[row(invoice=str(i), cust=v) for i, v in enumerate(values)])
    got = {int(r.invoice_number): r.customer_id for r in c.transform(df).collect()}
    assert got == dict(enumerate(values.values()))


def test_missing_customer_column_makes_guests(spark):
    df = raw(spark, row()).drop("Customer ID")
    assert c.transform(df).collect()[0].customer_id is None


@pytest.mark.parametrize("gone", ["Quantity", "Country", "Price", "Invoice"])
def test_missing_required_column_is_named(spark, gone):
    name = {"Quantity": "quantity", "Country": "country", "Price": "unit_price",
            "Invoice": "invoice_number"}[gone]
    with pytest.raises(KeyError, match=name):
        c.transform(raw(spark, row()).drop(gone))


def test_incomplete_and_bad_prices_are_dropped_and_counted(spark):
    df = raw(
        spark,
        row("1"), row("2", code=None), row("3", name=None), row("4", price="-1"),
        row("5", price="0"), row("6", price=None), row("7", price="NaN"), row("8", price="-0.001"),
    )
    kept = {r.invoice_number for r in c.transform(df).collect()}
    assert kept == {"1", "5"}
    counts = c.clean_row_counts(c.apply_header_aliases(c.normalize_headers(df))).collect()[0]
    assert counts.asDict() == {
        "rows_in": 8, "dropped_incomplete": 2, "dropped_price": 4, "rows_out": 2,
    }


@pytest.mark.parametrize(
    "bad", [{"qty": "many"}, {"qty": None}, {"price": "cheap"}, {"ts": "someday"}]
)
def test_bad_values_fail_the_job(spark, bad):
    with pytest.raises(Exception):
        c.transform(raw(spark, row(**bad))).collect()


def test_null_date_is_kept(spark):
    assert c.transform(raw(spark, row(ts=None))).collect()[0].invoice_date is None


def test_cancel_flag_is_case_sensitive(spark):
    df = raw(spark, row("C1"), row("c2"), row("3"), row(None))
    flags = {r.invoice_number: r.is_return for r in c.transform(df).collect()}
    assert flags == {"C1": True, "c2": False, "3": False, None: False}


def test_country_loses_all_outer_whitespace(spark):
    df = raw(spark, row(land="\t United  Kingdom \n"))
    assert c.transform(df).collect()[0].country == "United  Kingdom"


def test_union_matches_names_and_fills_missing(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2)], "b string, a int")
    only_a = spark.createDataFrame([(3,)], "a int")
    got = {(r.a, r.b) for r in c.union_partitions([a, b, only_a]).collect()}
    assert got == {(1, "x"), (2, "y"), (3, None)}


def test_no_rows(spark):
    assert c.transform(raw(spark)).collect() == []


def test_cleaning_does_not_shuffle(spark):
    plan = c.transform(raw(spark, row()))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_types(spark):
    r = c.transform(raw(spark, row(ts="2010-12-01 08:26:00", qty="-3"))).collect()[0]
    assert r.invoice_date == dt.datetime(2010, 12, 1, 8, 26) and r.quantity == -3


@pytest.mark.parametrize("text", ["12/1/2010 8:26", "2010-12-01 08:26:00", "12/1/2010 8:26:00"])
def test_two_forms_of_dates(spark, text):
    got = c.transform(raw(spark, row(ts=text))).collect()[0].invoice_date
    assert got.isoformat() == "2010-12-01T08:26:00"


def test_no_break_spaces_are_stripped(spark):
    assert c.transform(raw(spark, row(land="\xa0France \xa0"))).collect()[0].country == "France"


def test_a_fraction_of_a_customer_fails(spark):
    with pytest.raises(Exception, match="fraction"):
        c.transform(raw(spark, row(cust="3.7"))).collect()
