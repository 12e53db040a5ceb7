"""Exact percentiles of any number of columns in one pass, without holding all values anywhere.

Equal values are counted and written once, for all columns together. A histogram
then tells which cell holds each wanted rank, a finer histogram of that cell's own
range which part of it does, and so on, until the part has few enough distinct
values to be looked at. Each step is one job whose result has a bounded number of
rows; ranks are never found by sorting a column.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import ROUND_CEILING, ROUND_HALF_UP, Decimal, localcontext

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tillroll.sources.workspace import land, scratch

#: Distinct values of a part that are looked at, and cells of a part's histogram.
FEW_VALUES = 4096
CELLS = 128

# A cell number that never falls as the value grows: 64 cells per factor e of the
# value, so that a decimal of 38 digits has 11,300 at most.
_FIRST_CELL = "CAST(signum(v) * ceil(ln(abs(CAST(v AS DOUBLE)) * 100 + 1) * 64) AS BIGINT)"


@dataclass(frozen=True)
class Percentile:
    """A fraction (as text, for example ``"0.5"``) of a column's values, of the rows where ``where`` is true."""

    value: str
    fraction: str
    where: str = "true"


@dataclass(frozen=True)
class _Part:
    """Values from ``low`` to ``high`` of a measure: ``distinct`` ones, and ``before`` rows below them."""

    measure: int
    low: Decimal
    high: Decimal
    before: int
    distinct: int


def _scale(df: DataFrame, column: str) -> int:
    kind = df.schema[column].dataType
    return kind.scale if isinstance(kind, DecimalType) else 0


def _counted(df: DataFrame, measures: list[tuple[str, str]], scale: int) -> DataFrame:
    """(m, v, n): how often each measure has each value."""
    stacked = ", ".join(
        f"struct({i} AS m, CASE WHEN {where} THEN CAST({value} AS DECIMAL(38,{scale})) END AS v)"
        for i, (value, where) in enumerate(measures)
    )
    long = df.selectExpr(f"inline(array({stacked}))").where("v IS NOT NULL")
    return land(long.groupBy("m", "v").agg(F.expr("count(*) AS n")), "value-counts")


def _histogram(cells: DataFrame, part: str) -> dict[int, list]:
    """The cells of each part in rising order."""
    counted = cells.groupBy(part, "cell").agg(
        F.expr("sum(n) AS n"), F.expr("count(*) AS distinct"), F.expr("min(v) AS low"), F.expr("max(v) AS high")
    )
    found: dict[int, list] = {}
    for row in sorted(counted.collect(), key=lambda r: (r[part], r["cell"])):
        found.setdefault(row[part], []).append(row)
    return found


def _hit(cells: list, measure: int, before: int, rank: int) -> _Part:
    for cell in cells:
        if rank < before + cell["n"]:
            return _Part(measure, cell["low"], cell["high"], before, cell["distinct"])
        before += cell["n"]
    raise ValueError("a rank outside the counted values")


def _inside(part: _Part, scale: int) -> str:
    low, high = (f"CAST('{v:f}' AS DECIMAL(38,{scale}))" for v in (part.low, part.high))
    return f"m = {part.measure} AND v BETWEEN {low} AND {high}"


def _parts_of(counted: DataFrame, parts: list[_Part], scale: int, cell: dict[_Part, str]) -> DataFrame:
    """The values of each part as rows (part, cell, v, n)."""
    tagged = [
        f"CASE WHEN {_inside(p, scale)} THEN struct({i} AS part, {cell.get(p, '0L')} AS cell) END"
        for i, p in enumerate(parts)
    ]
    hit = " OR ".join(f"({_inside(p, scale)})" for p in parts)
    rows = counted.where(hit).selectExpr("v", "n", f"inline(filter(array({', '.join(tagged)}), p -> p IS NOT NULL))")
    return rows.select("part", "cell", "v", "n")


def _finer(part: _Part, scale: int) -> str:
    """SQL: the cell of a value among CELLS of equal width that span the part.

    It is found by comparisons, as differences of long decimals would lose digits. Its
    lowest and highest value are in different cells, so each step leaves fewer values.
    """
    with localcontext() as exact:
        exact.prec = 80
        unit = Decimal(1).scaleb(-scale)
        width = ((part.high - part.low + unit) / CELLS).quantize(unit, rounding=ROUND_CEILING)
        starts = [v for v in (part.low + i * width for i in range(1, CELLS)) if v <= part.high]
    bounds = ", ".join(f"CAST('{v:f}' AS DECIMAL(38,{scale}))" for v in starts)
    return f"CAST(size(filter(array({bounds}), b -> b <= v)) AS BIGINT)"


def find_percentiles(df: DataFrame, wanted: dict[str, Percentile]) -> dict[str, Decimal | None]:
    """The linearly interpolated percentiles by name; None where there is no value.

    Columns must be integers or decimals; nulls are left out. Values are exact, and
    results have six digits more than the column with most digits behind the point, rounded half up.
    All percentiles share the jobs: one that counts equal values, one histogram, and
    one for each further step and for the values looked at last.
    """
    measures = sorted({(p.value, p.where) for p in wanted.values()})
    scale = max(_scale(df, value) for value, _ in measures)
    counted = _counted(df, measures, scale)
    coarse = _histogram(counted.withColumn("cell", F.expr(_FIRST_CELL)), "m")
    places = {}
    parts: dict[tuple[str, int], _Part] = {}
    for name, p in wanted.items():
        m = measures.index((p.value, p.where))
        if m not in coarse:
            continue
        with localcontext() as exact:
            exact.prec = 80
            place = (sum(c["n"] for c in coarse[m]) - 1) * Decimal(p.fraction)
        places[name] = place
        for rank in {int(place), int(place.to_integral_value(ROUND_CEILING))}:
            parts[name, rank] = _hit(coarse[m], m, 0, rank)
    while large := sorted({p for p in parts.values() if p.distinct > FEW_VALUES}, key=repr):
        finer = _parts_of(counted, large, scale, {p: _finer(p, scale) for p in large})
        cells = _histogram(finer, "part")
        parts = {
            at: _hit(cells[large.index(p)], p.measure, p.before, at[1]) if p in large else p for at, p in parts.items()
        }
    small = sorted(set(parts.values()), key=repr)
    values: dict[int, list] = {}
    if small:
        for row in _parts_of(counted, small, scale, {}).collect():
            values.setdefault(row["part"], []).append((row["v"], row["n"]))
    at_rank = {}
    for at, p in parts.items():
        upto = p.before
        for v, n in sorted(values[small.index(p)]):
            upto += n
            if at[1] < upto:
                at_rank[at] = v
                break
    found: dict[str, Decimal | None] = dict.fromkeys(wanted)
    with localcontext() as exact:
        exact.prec = 80
        for name, place in places.items():
            low = at_rank[name, int(place)]
            high = at_rank[name, int(place.to_integral_value(ROUND_CEILING))]
            between = low + (high - low) * (place - int(place))
            found[name] = between.quantize(Decimal(1).scaleb(-scale - 6), rounding=ROUND_HALF_UP)
    return found


def percentile_columns(df: DataFrame, wanted: dict[str, Percentile]) -> dict[str, Column]:
    """``find_percentiles`` as decimal constants."""
    digits = max(_scale(df, p.value) for p in wanted.values()) + 6
    with scratch(df.sparkSession):
        found = find_percentiles(df, wanted)
    return {name: F.lit(None if v is None else format(v, "f")).cast(f"decimal(38,{digits})") for name, v in found.items()}


def exact_percentiles(df: DataFrame, value: str, at: dict[str, str]) -> DataFrame:
    """One row with percentiles of one column; ``at`` maps names to fractions."""
    found = percentile_columns(df, {name: Percentile(value, fraction) for name, fraction in at.items()})
    return df.sparkSession.range(1).select(*[column.alias(name) for name, column in found.items()])
