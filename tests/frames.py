"""Hand-made edge rows."""

import datetime as dt
from decimal import Decimal

from tillroll.plans.metrics import clean_dashboard_fact

RAW = (
    "Invoice string, StockCode string, Description string, Quantity string, InvoiceDate string,"
    " Price string, `Customer ID` string, Country string"
)
CLEAN = (
    "invoice_number string, stock_code string, description string, quantity int,"
    " invoice_date timestamp_ntz, unit_price double, customer_id bigint, country string,"
    " is_return boolean"
)
FACT = (
    "sale_id bigint, invoice_number string, stock_code string, customer_id bigint,"
    " country_id int, quantity int, invoice_date timestamp_ntz, unit_price decimal(10,2),"
    " is_return boolean"
)
LINES = (
    "sale_id bigint, invoice_number string, stock_code string, customer_id bigint, quantity int,"
    " invoice_date timestamp_ntz, unit_price decimal(10,2), is_return boolean,"
    " line_revenue decimal(21,2), country_name string, product_name string"
)


def day(text):
    return dt.datetime.fromisoformat(text)


def lines(spark, rows):
    """Dashboard lines from (invoice, code, customer, quantity, date, price, country, name)."""
    data = [
        (i, inv, code, cust, qty, day(ts) if ts else None, Decimal(price), None, None, land, name)
        for i, (inv, code, cust, qty, ts, price, land, name) in enumerate(rows, 1)
    ]
    return clean_dashboard_fact(spark.createDataFrame(data, LINES))


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def fact(spark, *rows):
    data = [
        (i, inv, code, cust, land, qty, day(ts) if ts else None, Decimal(price) if price else None, flag)
        for i, (inv, code, cust, land, qty, ts, price, flag) in enumerate(rows, 1)
    ]
    return spark.createDataFrame(data, FACT)


def dims(spark):
    return {
        "dim_country": spark.createDataFrame(
            [(1, "United Kingdom"), (2, "EIRE")], "country_id int, country_name string"
        ),
        "dim_customer": spark.createDataFrame([(7,), (8,)], "customer_id bigint"),
        "dim_product": spark.createDataFrame(
            [("A", "apple", Decimal("1.00"))],
            "stock_code string, description string, unit_price_reference decimal(10,2)",
        ),
    }
