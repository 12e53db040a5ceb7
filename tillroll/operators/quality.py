"""Column checks that count failures, and the suite over all layers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillroll.plans.layers import MODELS, Layers
from tillroll.sources.workspace import land


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    kind: str
    values: tuple = ()
    parent: str = ""
    key: str = ""


def _not_null_failures(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def _outside_failures(column: str, values: tuple | list) -> Column:
    return F.count_if(~F.col(column).isin(list(values)))


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Number of rows without a value."""
    return df.agg(_not_null_failures(column).alias("failures"))


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Number of values that occur more than once; nulls are ignored."""
    repeated = df.where(F.col(column).isNotNull()).groupBy(column).count().where("count > 1")
    return repeated.agg(F.count("*").alias("failures"))


def check_accepted_values(df: DataFrame, column: str, values: tuple | list) -> DataFrame:
    """Number of rows with a value outside the list; nulls are ignored."""
    return df.agg(_outside_failures(column, values).alias("failures"))


def check_relationships(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Number of child rows whose value is not a key of the parent; nulls are ignored.

    Child rows are counted per value before the join, so a frequent value is one row in it.
    """
    keys = parent.select(F.col(key).alias(column))
    values = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    orphans = values.join(keys, column, "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))


def _checks(model: str, **columns: str) -> list[Check]:
    return [
        Check(model, column, kind) for column, kinds in columns.items() for kind in kinds.split()
    ]


def _refers(model: str, column: str, parent: str) -> Check:
    return Check(model, column, "relationships", parent=parent, key=column)


_TRUE_FALSE = (True, False)

# Models that several other models read.
SHARED_MODELS = ("int_order_metrics", "int_customer_orders")

SUITE: list[Check] = [
    *_checks(
        "stg_sales", sale_id="unique not_null", invoice_number="not_null", stock_code="not_null",
        quantity="not_null", invoice_date="not_null", unit_price="not_null",
    ),
    Check("stg_sales", "is_return", "accepted_values", values=_TRUE_FALSE),
    *_checks("stg_customers", customer_id="unique not_null"),
    *_checks("stg_products", stock_code="unique not_null"),
    *_checks("stg_countries", country_id="unique not_null", country_name="not_null"),
    *_checks(
        "int_sales_enriched", sale_id="unique not_null", invoice_number="not_null",
        stock_code="not_null",
    ),
    _refers("int_sales_enriched", "stock_code", "stg_products"),
    _refers("int_sales_enriched", "customer_id", "stg_customers"),
    _refers("int_sales_enriched", "country_id", "stg_countries"),
    Check("int_sales_enriched", "is_return", "accepted_values", values=_TRUE_FALSE),
    *_checks("int_order_metrics", invoice_number="unique not_null"),
    *_checks("int_customer_orders", customer_id="unique not_null"),
    _refers("int_customer_orders", "customer_id", "stg_customers"),
    *_checks("int_customer_lifetime_value", customer_id="unique not_null"),
    *_checks("int_country_metrics", country_id="unique"),
    _refers("int_country_metrics", "country_id", "stg_countries"),
    *_checks("mart_executive_kpis", total_invoices="not_null", total_customers="not_null"),
    *_checks("mart_customer_lifetime_value", customer_id="unique not_null"),
    *_checks(
        "mart_repeat_purchase_metrics", repeat_customers="not_null", total_customers="not_null"
    ),
    *_checks("mart_country_revenue", country_name="not_null"),
    *_checks("mart_sales_monthly", month="unique not_null"),
]


_KEY_KINDS = ("unique", "relationships")


def _row_failures(check: Check) -> Column:
    """Failures of a check that looks at one row at a time."""
    if check.kind == "not_null":
        return _not_null_failures(check.column)
    return _outside_failures(check.column, check.values)


def _observed(layers: Layers, names: Sequence[str], row_checks: dict[str, list[int]], suite: list[Check]):
    """The layers with some models written once, and the failures that the writes counted."""
    failures: dict[int, int] = {}
    for name in sorted(names, key=MODELS.index):
        watch = Observation()
        mine = row_checks.get(name, [])
        counts = [_row_failures(suite[i]).alias(f"c{i}") for i in mine]
        table = layers[name].observe(watch, F.count("*").alias("rows"), *counts)
        layers = layers.replaced(**{name: land(table, name)})
        if mine:
            found = watch.get
            failures |= {i: found[f"c{i}"] for i in mine}
    return layers, failures


def _value(kind: str, column: str) -> list[Column]:
    """A key as one of two columns, a number or a text."""
    number = kind in ("tinyint", "smallint", "int", "bigint")
    return [
        (F.col(column) if number else F.lit(None)).cast("bigint").alias("number"),
        (F.lit(None) if number else F.col(column)).cast("string").alias("text"),
    ]


def _stacked(
    model: str, df: DataFrame, suite: list[Check], row_checks: list[int], keys: dict[tuple[str, str], int]
) -> DataFrame:
    """One scan of a model as rows (item, number, text, rows, known, failed).

    A key column is an item with all its values; as a parent's key it is also a
    row of each item that refers to it. Row checks have a row where they fail.
    """
    kinds = dict(df.dtypes)

    def row(item: int, value: list[Column], rows: int, known: bool, failed: int) -> Column:
        rest = {"rows": F.lit(rows).cast("bigint"), "known": F.lit(known), "failed": F.lit(failed).cast("bigint")}
        return F.struct(F.lit(item).alias("item"), *value, *[c.alias(n) for n, c in rest.items()])

    rows = [row(item, _value(kinds[c], c), 1, False, 0) for (m, c), item in keys.items() if m == model]
    for check in suite:
        if check.kind == "relationships" and check.parent == model:
            item = keys[check.model, check.column]
            rows.append(row(item, _value(kinds[check.key], check.key), 0, True, 0))
    none = [F.lit(None).cast("bigint").alias("number"), F.lit(None).cast("string").alias("text")]
    for i in row_checks:
        c = suite[i]
        bad = F.col(c.column).isNull() if c.kind == "not_null" else ~F.col(c.column).isin(list(c.values))
        rows.append(F.when(bad, row(-1 - i, none, 0, False, 1)))
    every = F.array(*rows)
    return df.select(F.inline(F.filter(every, lambda r: r.isNotNull()) if row_checks else every))


def run_quality_suite(
    layers: Layers, suite: list[Check] | None = None, store: Sequence[str] = SHARED_MODELS
) -> DataFrame:
    """All checks as rows: model, column_name, check_name, failures, passed.

    The models named in ``store`` are written when the suite is called, so that they are
    built once; their row checks are counted by that write. Each model is then
    scanned once, for all its key columns and its other row checks. Keys and the keys
    they refer to meet in one shuffle on (column, value), which counts how often a
    value occurs and whether the parent knows it: no joins, whatever the number of
    checks. A frequent value is one row of each task. Pass an empty ``store`` for a plan that
    runs nothing before its action.
    """
    suite = SUITE if suite is None else suite
    key_columns = dict.fromkeys((c.model, c.column) for c in suite if c.kind in _KEY_KINDS)
    keys = {at: item for item, at in enumerate(key_columns)}
    row_checks: dict[str, list[int]] = {}
    for i, c in enumerate(suite):
        if c.kind not in _KEY_KINDS and not (c.kind == "not_null" and (c.model, c.column) in keys):
            row_checks.setdefault(c.model, []).append(i)
    layers, seen = _observed(layers, store, row_checks, suite)
    scans = []
    for model in MODELS:
        left = [i for i in row_checks.get(model, []) if i not in seen]
        parent = any(c.parent == model for c in suite)
        if left or parent or any(m == model for m, _ in keys):
            scans.append(_stacked(model, layers[model], suite, left, keys))
    spark = layers.spark
    if scans:
        values = reduce(DataFrame.unionByName, scans).groupBy("item", "number", "text").agg(
            F.sum("rows").alias("n"), F.max("known").alias("known"), F.sum("failed").alias("failed")
        )
        missing = F.col("number").isNull() & F.col("text").isNull()
        per_item = values.groupBy("item").agg(
            F.count_if(~missing & (F.col("n") > 1)).alias("unique"),
            F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("not_null"),
            F.coalesce(F.sum(F.when(~missing & ~F.col("known"), F.col("n"))), F.lit(0)).alias("relationships"),
            F.sum("failed").alias("failed"),
        )
    else:
        per_item = spark.createDataFrame([], "item int, unique long, not_null long, relationships long, failed long")
    by_row = {i for found in row_checks.values() for i in found}
    plan = [
        (c.model, c.column, c.kind, -1 - i if i in by_row else keys[c.model, c.column], seen.get(i))
        for i, c in enumerate(suite)
    ]
    # One row for each check.
    listed = spark.createDataFrame(
        plan, "model string, column_name string, check_name string, item int, seen long"
    )
    by_kind = F.coalesce(
        F.when(F.col("item") < 0, F.col("failed")),
        F.when(F.col("item") >= 0, F.expr("CASE check_name WHEN 'unique' THEN unique WHEN 'not_null' THEN not_null ELSE relationships END")),
        F.lit(0),
    )
    return listed.join(per_item, "item", "left").select(
        "model",
        "column_name",
        "check_name",
        F.coalesce("seen", by_kind).cast("bigint").alias("failures"),
        (F.coalesce("seen", by_kind) == 0).alias("passed"),
    )
