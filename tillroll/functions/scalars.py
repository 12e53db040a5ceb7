"""Column expressions shared by the plans. All are built from Spark built-ins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import fixed_values as fixed

_NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# A failed cast costs far more than a pattern, so text is looked at before it is cast.
_WHOLE_PATTERN = r"^\s*[+-]?\d+\s*$"
#: Prices read from text: up to 18 digits before the point and 8 behind it.
PRICE_TYPE = "decimal(26,8)"


def month_of(ts: Column) -> Column:
    """First day of the month as a date, whatever the session time zone."""
    return F.trunc(ts.cast("date"), "month")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient, null when the divisor is zero or null."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Double quotient, 0 when there is no finite one."""
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def strip_whitespace(text: Column) -> Column:
    # U: white space of all scripts, no-break spaces too.
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def read_timestamp(text: Column) -> Column:
    """A time without zone from ISO text or from a month-first date; null for other text."""
    other = [F.try_to_timestamp(text, F.lit(p)).cast(T.TimestampNTZType()) for p in fixed.DATE_PATTERNS]
    return F.coalesce(text.try_cast(T.TimestampNTZType()), *other)


def lenient_double(df: DataFrame, name: str) -> Column:
    """A number, or null for text that is none (also for 'nan', '1d' and '1e400')."""
    kind = df.schema[name].dataType
    if not isinstance(kind, T.StringType):
        number = F.col(name).cast("double")
        return F.when(F.isnan(number), None).otherwise(number)
    number = F.when(F.col(name).rlike(_NUMBER_PATTERN), F.col(name).try_cast("double"))
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def lenient_bigint(df: DataFrame, name: str) -> Column:
    """A whole number, or null for text that is no number; '12345.0' gives 12345."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.col(name).cast("bigint")
    if isinstance(df.schema[name].dataType, T.StringType):
        exact = F.when(F.col(name).rlike(_WHOLE_PATTERN), F.col(name).try_cast("bigint"))
    else:
        exact = F.lit(None).cast("bigint")
    return F.coalesce(exact, lenient_double(df, name).try_cast("bigint"))


def lenient_price(df: DataFrame, name: str) -> Column:
    """A price as a decimal, or null for text that is no number."""
    if isinstance(df.schema[name].dataType, T.DecimalType):
        return F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.when(
            F.col(name).rlike(_NUMBER_PATTERN), F.trim(F.col(name)).try_cast(PRICE_TYPE)
        )
    return lenient_double(df, name).try_cast(PRICE_TYPE)


def is_operational(stock_code: Column, product_name: Column) -> Column:
    """Charges, fees and stock corrections by code, code prefix or description."""
    code = strip_whitespace(F.upper(F.coalesce(stock_code, F.lit(""))))
    name = F.coalesce(product_name, F.lit(""))
    return (
        code.isin(fixed.OPERATIONAL_STOCK_CODES)
        | code.rlike(fixed.OPERATIONAL_CODE_PATTERN)
        | name.rlike(fixed.OPERATIONAL_DESCRIPTION_PATTERN)
    )


def recency_bucket(days: Column) -> Column:
    """Label of the right-closed bin that holds a number of days; null days give null."""
    label = F.when(days < 0, None)
    for edge, text in zip(fixed.RECENCY_EDGES, fixed.RECENCY_LABELS):
        label = label.when(days <= edge, text)
    return label.when(days > fixed.RECENCY_EDGES[-1], fixed.RECENCY_LABELS[-1])


def whole_days_between(start: Column, end: Column) -> Column:
    """Full 24-hour days from start to end (26 hours are one day)."""
    return F.extract(F.lit("DAY"), end - start)


def risk_label(
    gross: Column, high_gross: Column, return_line_rate: Column, returned_unit_rate: Column
) -> Column:
    """First risk class that applies to a product."""
    both, lines, units, normal = fixed.RISK_LABELS
    return (
        F.when((gross >= high_gross) & (return_line_rate >= fixed.HIGH_REVENUE_LINE_RATE), both)
        .when(return_line_rate >= fixed.HIGH_LINE_RATE, lines)
        .when(returned_unit_rate >= fixed.HIGH_UNIT_RATE, units)
        .otherwise(normal)
    )


def count_text(value: Column) -> Column:
    return F.format_number(value.cast("double"), 0)


def money_text(value: Column) -> Column:
    return F.concat(F.lit("£"), count_text(value))


def pct_text(value: Column, decimals: int = 1) -> Column:
    text = F.format_number(value.cast("double") * 100, decimals)
    return F.concat(F.replace(text, F.lit(","), F.lit("")), F.lit("%"))


def compact_money_text(value: Column) -> Column:
    amount = value.cast("double")

    def scaled(divisor: int, decimals: int, suffix: str) -> Column:
        text = F.format_number(amount / divisor, decimals)
        return F.concat(F.lit("£"), F.replace(text, F.lit(","), F.lit("")), F.lit(suffix))

    return (
        F.when(F.abs(amount) >= 1_000_000, scaled(1_000_000, 2, "M"))
        .when(F.abs(amount) >= 1_000, scaled(1_000, 1, "K"))
        .otherwise(money_text(amount))
    )


def publish(df: DataFrame) -> DataFrame:
    """Decimals as doubles: money is summed exactly and only then made a double."""
    return df.select(
        [
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema
        ]
    )
