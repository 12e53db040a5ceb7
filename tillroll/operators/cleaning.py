"""Raw invoice lines to clean, typed lines. Every step is narrow: no shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.fixed_values import HEADER_ALIASES
from tillroll.functions.scalars import lenient_bigint, lenient_double, read_timestamp, strip_whitespace
from tillroll.sources.schemas import RAW_COLUMNS


def union_partitions(parts: list[DataFrame]) -> DataFrame:
    """Stack period files, matching columns by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def normalize_headers(df: DataFrame) -> DataFrame:
    names = [c.strip().lower().replace(" ", "").replace("_", "") for c in df.columns]
    return df.toDF(*names)


def apply_header_aliases(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in HEADER_ALIASES.items() if k in df.columns})


def ensure_customer_column(df: DataFrame) -> DataFrame:
    """Files without customer ids hold guest lines only."""
    if "customer_id" in df.columns:
        return df
    return df.withColumn("customer_id", F.lit(None).cast("bigint"))


def require_columns(df: DataFrame) -> DataFrame:
    for name in RAW_COLUMNS:
        if name not in df.columns:
            raise KeyError(f"missing column '{name}'; found {df.columns}")
    return df


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["stock_code", "description"])


def coerce_customer_id(df: DataFrame) -> DataFrame:
    """Ids as whole numbers; text that is no number makes a guest line, a fraction fails the job."""
    number = lenient_double(df, "customer_id")
    fraction = F.raise_error(F.lit("customer id has a fraction")).cast("bigint")
    whole = F.when(number % 1 != 0, fraction).otherwise(lenient_bigint(df, "customer_id"))
    return df.withColumn("customer_id", whole)


def cast_types(df: DataFrame) -> DataFrame:
    """Strict types: a quantity, price or date that cannot be read fails the job.

    Text dates are ISO or one of the month-first forms of ``DATE_PATTERNS``.
    """
    date = F.col("invoice_date")
    if isinstance(df.schema["invoice_date"].dataType, T.StringType):
        date = F.coalesce(read_timestamp(date), date.cast(T.TimestampNTZType()))
    no_quantity = F.raise_error(F.lit("quantity is null")).cast("int")
    return df.withColumns(
        {
            "quantity": F.coalesce(F.col("quantity").cast("int"), no_quantity),
            "unit_price": F.col("unit_price").cast("double"),
            "invoice_date": date.cast(T.TimestampNTZType()),
        }
    )


def trim_country(df: DataFrame) -> DataFrame:
    return df.withColumn("country", strip_whitespace(F.col("country")))


def drop_negative_prices(df: DataFrame) -> DataFrame:
    """Keep prices from zero up; missing prices go too (NaN sorts above all numbers)."""
    price = F.col("unit_price")
    return df.where((price >= 0) & ~F.isnan(price.cast("double")))


def flag_cancellations(df: DataFrame) -> DataFrame:
    cancelled = F.coalesce(F.startswith(F.col("invoice_number"), F.lit("C")), F.lit(False))
    return df.withColumn("is_return", cancelled)


def transform(raw: DataFrame) -> DataFrame:
    """All cleaning steps in order."""
    named = require_columns(ensure_customer_column(apply_header_aliases(normalize_headers(raw))))
    typed = trim_country(cast_types(coerce_customer_id(drop_incomplete(named))))
    clean = flag_cancellations(drop_negative_prices(typed))
    return clean.select(*RAW_COLUMNS, "is_return")


def clean_row_counts(raw: DataFrame) -> DataFrame:
    """Lines in, dropped per rule and out, in one pass over the named columns."""
    incomplete = F.col("stock_code").isNull() | F.col("description").isNull()
    price = F.col("unit_price").cast("double")
    bad_price = ~F.coalesce((price >= 0) & ~F.isnan(price), F.lit(False))
    return raw.agg(
        F.count("*").alias("rows_in"),
        F.count_if(incomplete).alias("dropped_incomplete"),
        F.count_if(~incomplete & bad_price).alias("dropped_price"),
        F.count_if(~incomplete & ~bad_price).alias("rows_out"),
    )
