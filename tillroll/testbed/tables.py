"""Retail invoice lines derived from the given order tables, and the star on top of them.

Each table set is written once per application to the shared folder, as the raw
file, the warehouse and the line extract are stored in a real installation. A set
that only serves to build another one is deleted when that is written.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import star as star_steps
from tillroll.operators.cleaning import transform
from tillroll.plans.analytics import fact_sales_enriched
from tillroll.plans.metrics import clean_dashboard_fact
from tillroll.sources.readers import load_star
from tillroll.sources.schemas import RAW_COLUMNS
from tillroll.sources.workspace import land, landed_once, landed_table, lent, scratch
from tillroll.sources.writers import write_star

_RETURNED = "(l_returnflag = 'R' AND l_linenumber <= 2)"
_ADJUSTED = "(l_returnflag = 'A' AND l_linenumber = 7 AND l_suppkey % 20 = 0)"

_RAW_RULES = {
    "invoice_number": f"CASE WHEN {_RETURNED} THEN 'C' ELSE '' END"
    " || CAST(500000 + l_orderkey AS STRING)",
    "stock_code": "CASE l_partkey % 100 WHEN 1 THEN 'POST' WHEN 2 THEN 'm'"
    " WHEN 3 THEN 'BANK CHARGES' WHEN 4 THEN 'TEST001'"
    " ELSE CAST(10000 + l_partkey AS STRING)"
    " || CASE WHEN l_partkey % 10 = 7 THEN 'A' ELSE '' END END",
    "description": "CASE WHEN l_partkey % 97 = 0 THEN NULL"
    " WHEN l_partkey % 100 = 5 THEN 'Damaged ' || p_name ELSE p_name END",
    "quantity": f"CASE WHEN {_RETURNED} OR {_ADJUSTED} THEN -1 ELSE 1 END"
    " * CAST(l_quantity AS INT) * CASE WHEN l_suppkey % 25 = 24 THEN 40 ELSE 1 END",
    "invoice_date": "timestampadd(MINUTE, CAST(l_orderkey % 1440 AS INT), o_orderdate)",
    "unit_price": "CAST(CAST(CASE WHEN l_suppkey % 50 = 0 THEN 0"
    " WHEN l_suppkey % 50 = 1 AND l_linenumber = 3 THEN -1 ELSE 1 END"
    " * (CAST(round(l_extendedprice * 100) AS BIGINT) % 110000) AS DECIMAL(10,0))"
    " * 0.01 AS DECIMAL(10,2))",
    "customer_id": "CASE WHEN l_orderkey % 5 = 0 THEN NULL"
    " WHEN o_custkey % 3 = 0 THEN 100000 + l_orderkey ELSE 12000 + o_custkey END",
    "country": "CASE n_nationkey WHEN 0 THEN 'United Kingdom' WHEN 1 THEN 'EIRE'"
    " WHEN 2 THEN 'USA' WHEN 3 THEN 'Unspecified' ELSE n_name END",
}

FILE_HEADERS = {
    "invoice_number": "Invoice",
    "stock_code": "StockCode",
    "description": "Description",
    "quantity": "Quantity",
    "invoice_date": "InvoiceDate",
    "unit_price": "Price",
    "customer_id": "Customer ID",
    "country": "Country",
}

# The captions of an older file layout.
OLD_FILE_HEADERS = {
    **FILE_HEADERS,
    "invoice_number": " InvoiceNo ",
    "unit_price": "Unit_Price",
    "customer_id": "CustomerID",
}


def _given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# What the rules take from a line alone, so that only this is shuffled.
_OF_LINE = ("quantity", "unit_price")

#: Tables that take a shuffle of all lines are written in so many parts, one after the other.
PARTS = 4


def _in_part(df: DataFrame, column: str, part: int) -> DataFrame:
    """Rows of one part; a null key is in one of them too."""
    return df.where(F.expr(f"pmod(xxhash64({column}), {PARTS}) = {part}"))


def derive_raw_lines(spark: SparkSession, sf_dir: str, part: int | None = None) -> DataFrame:
    """Order headers are joined first; the lines are then shuffled by part and by order only.

    The order's join comes last: lines of an order then lie together, where they take least room.
    ``part`` takes the lines of some orders; all parts together are the table.
    """
    customer = _given(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = _given(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    headers = (
        _given(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", "o_orderdate")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.expr("(c_nationkey + o_orderkey % 3) % 25 = n_nationkey"))
        .drop("c_custkey", "c_nationkey")
    )
    parts = _given(spark, sf_dir, "part").select("p_partkey", "p_name")
    told = [F.expr(_RAW_RULES[name]).alias(name) for name in _OF_LINE]
    given = _given(spark, sf_dir, "lineitem")
    lines = (
        (given if part is None else _in_part(given, "l_orderkey", part))
        .select("l_orderkey", "l_partkey", F.expr(_RETURNED).alias("returned"), *told)
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .drop("p_partkey")
        .join(headers, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    rest = {n: rule.replace(_RETURNED, "returned") for n, rule in _RAW_RULES.items() if n not in _OF_LINE}
    return lines.select([F.expr(rest.get(name, name)).alias(name) for name in _RAW_RULES])


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [partial(derive_raw_lines, spark, sf_dir, part) for part in range(PARTS)]
    return landed_table(spark, f"raw:{sf_dir}", *parts)


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines as a text file holds them."""
    text = {name: F.col(name).cast("string") for name in RAW_COLUMNS}
    guest = F.when(F.col("invoice_number").endswith("0"), F.lit("GUEST"))
    text["customer_id"] = F.when(
        F.col("customer_id").isNotNull(), F.concat(text["customer_id"], F.lit(".0"))
    ).otherwise(guest)
    text["country"] = F.concat(F.lit(" "), F.col("country"), F.lit(" "))
    return raw_lines(spark, sf_dir).select([c.alias(n) for n, c in text.items()])


def file_headers(raw: DataFrame, headers: dict[str, str] | None = None) -> DataFrame:
    """The captions that raw files use."""
    return raw.withColumnsRenamed(headers or FILE_HEADERS)


def clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform(file_headers(raw_lines(spark, sf_dir)))


def build_star(clean: DataFrame) -> dict[str, DataFrame]:
    """The star tables; the two that are lookups of lines or shuffle them are stored at once."""
    countries = land(star_steps.build_dim_country(clean), "countries")
    products = land(star_steps.truncate_strings(star_steps.build_dim_product(clean)), "products")
    return {
        "dim_country": countries,
        "dim_customer": star_steps.build_dim_customer(clean),
        "dim_product": products,
        "fact_sales": star_steps.build_fact_sales(clean, countries),
    }


def star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    def write(path: str) -> None:
        with lent(spark, f"raw:{sf_dir}"), scratch(spark):
            write_star(build_star(clean_lines(spark, sf_dir)), path)

    path, _ = landed_once(spark, f"star:{sf_dir}", write)
    return load_star(spark, path, views=False)


def dashboard_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(part: int) -> DataFrame:
        tables = star(spark, sf_dir)
        lines = _in_part(tables["fact_sales"], "stock_code", part)
        return clean_dashboard_fact(fact_sales_enriched(lines, tables["dim_country"], tables["dim_product"]))

    with lent(spark, f"star:{sf_dir}"):
        return landed_table(spark, f"dashboard:{sf_dir}", *[partial(build, part) for part in range(PARTS)])
