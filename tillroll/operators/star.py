"""Clean lines to the star schema: three dimensions and one fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.sources.schemas import STAR_SCHEMAS, conform_to_schema
from tillroll.sources.workspace import land

INVOICE_LENGTH = 20
CODE_LENGTH = 30
DESCRIPTION_LENGTH = 255

# Bits of a line key: part number of a written file, its counter within the part, place in the file.
_COUNTER_BITS, _PLACE_BITS = 10, 29


def build_dim_country(clean: DataFrame) -> DataFrame:
    """Distinct countries, numbered in name order; a null country is left out."""
    names = clean.select(F.col("country").alias("country_name")).where("country_name IS NOT NULL")
    # One window over the distinct names: a few dozen rows.
    number = F.row_number().over(Window.orderBy("country_name")).alias("country_id")
    numbered = names.distinct().select(number, "country_name")
    return conform_to_schema(numbered, STAR_SCHEMAS["dim_country"])


def build_dim_customer(clean: DataFrame) -> DataFrame:
    return clean.select("customer_id").where("customer_id IS NOT NULL").distinct()


def build_dim_product(clean: DataFrame) -> DataFrame:
    """Description and price of the latest line of each code; lines without a date are last.

    One grouped ``max``: each task keeps one row per code before the shuffle.
    """
    latest = F.struct(
        F.col("invoice_date").isNull().alias("undated"),
        "invoice_date",
        "invoice_number",
        "description",
        "unit_price",
    )
    return (
        clean.groupBy("stock_code")
        .agg(F.max(latest).alias("last"))
        .select(
            "stock_code",
            F.col("last.description").alias("description"),
            F.col("last.unit_price").cast("decimal(10,2)").alias("unit_price_reference"),
        )
    )


def truncate_strings(products: DataFrame) -> DataFrame:
    """Cut code and description to the column sizes; of codes that then collide the
    first in order of the full code stays."""
    cut = products.select(
        F.substring("stock_code", 1, CODE_LENGTH).alias("short_code"),
        "stock_code",
        F.substring("description", 1, DESCRIPTION_LENGTH).alias("description"),
        "unit_price_reference",
    ).where("short_code IS NOT NULL")
    return (
        cut.groupBy("short_code")
        .agg(
            F.min_by(
                F.struct("description", "unit_price_reference"), F.col("stock_code")
            ).alias("kept")
        )
        .select(F.col("short_code").alias("stock_code"), "kept.*")
    )


def attach_country_key(clean: DataFrame, dim_country: DataFrame) -> DataFrame:
    lookup = dim_country.withColumnRenamed("country_name", "country")
    return clean.join(lookup, "country", "left")


def keep_known_products(clean: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Lines whose full code is in the dimension; a code above 30 characters never is.

    Pass a stored dimension: Spark then shuffles both sides for this join alone and
    can split the partition of a code that holds many lines.
    """
    return clean.join(dim_product.select("stock_code"), "stock_code", "left_semi")


def _known_by_length(clean: DataFrame) -> DataFrame:
    """What ``keep_known_products`` keeps when the dimension comes from the same lines.

    The dimension then holds every code of up to 30 characters, and cut codes
    cannot equal a longer one, so the length decides and no join is needed.
    """
    return clean.where(F.length("stock_code") <= CODE_LENGTH)


def fact_columns(keyed: DataFrame) -> DataFrame:
    return keyed.select(
        F.substring("invoice_number", 1, INVOICE_LENGTH).alias("invoice_number"),
        F.substring("stock_code", 1, CODE_LENGTH).alias("stock_code"),
        "customer_id",
        "country_id",
        "quantity",
        "invoice_date",
        F.col("unit_price").cast("decimal(10,2)").alias("unit_price"),
        "is_return",
    )


def number_rows(df: DataFrame, id_column: str) -> DataFrame:
    """Add a unique number to each row, the same whenever the result is read again.

    The rows are written once, and a row's number is made of the part number and
    counter in its file's name and of its place in the file. That needs no
    shuffle, no join and no window, and is one path at every size. Numbers rise
    within a file but have gaps. Written files do not change, so a task that runs
    again gives the same numbers.
    """
    stored = land(df, "unnumbered")
    name = F.col("_metadata.file_name")
    part = F.regexp_extract(name, r"^part-(\d+)-", 1).cast("bigint")
    counter = F.regexp_extract(name, r"-c(\d+)\.", 1).cast("bigint")
    high = F.shiftleft(F.shiftleft(part, _COUNTER_BITS).bitwiseOR(counter), _PLACE_BITS)
    place = F.col("_metadata.row_index")
    fits = (counter < 1 << _COUNTER_BITS) & (place < 1 << _PLACE_BITS)
    too_many = F.raise_error(F.lit("a part has more files or a file more rows than line keys allow")).cast("bigint")
    number = F.when(fits, (high + place + 1).cast("bigint")).otherwise(too_many).alias(id_column)
    return stored.select(number, *df.columns)


def build_fact_sales(
    clean: DataFrame, dim_country: DataFrame, dim_product: DataFrame | None = None
) -> DataFrame:
    """The fact with its surrogate key.

    Give ``dim_product`` when it was not built from the same clean lines.
    """
    known = keep_known_products(clean, dim_product) if dim_product else _known_by_length(clean)
    fact = number_rows(fact_columns(attach_country_key(known, dim_country)), "sale_id")
    return conform_to_schema(fact, STAR_SCHEMAS["fact_sales"])
