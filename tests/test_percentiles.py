from decimal import Decimal

import numpy as np
import pytest

from tillroll.functions.percentiles import exact_percentiles


def check(spark, cents, fractions):
    df = spark.createDataFrame([(Decimal(c).scaleb(-2),) for c in cents], "v decimal(20,2)")
    row = exact_percentiles(df, "v", {f"p{i}": f for i, f in enumerate(fractions)}).collect()[0]
    for i, f in enumerate(fractions):
        expected = np.quantile(np.array(cents, dtype=float), float(f)) / 100
        assert float(row[f"p{i}"]) == pytest.approx(expected, rel=1e-12, abs=1e-6)


FRACTIONS = ["0", "0.5", "0.75", "0.95", "1"]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 101, 3000])
def test_random_values(spark, n):
    rng = np.random.default_rng(n)
    check(spark, [int(x) for x in rng.lognormal(8, 3, n)], FRACTIONS)


def test_signs_zeros_and_one_hot_value(spark):
    rng = np.random.default_rng(5)
    values = [int(x) for x in rng.normal(0, 500, 700)] + [0] * 50 + [777] * 500
    check(spark, values, FRACTIONS)


def test_all_equal(spark):
    check(spark, [1234] * 40, FRACTIONS)


def test_neighbours_in_one_cell(spark):
    check(spark, list(range(10_000_000, 10_000_400)), FRACTIONS)


def test_nulls_are_ignored_and_empty_is_null(spark):
    df = spark.createDataFrame([(None,), (3,), (5,)], "v bigint")
    assert float(exact_percentiles(df, "v", {"m": "0.5"}).collect()[0].m) == 4.0
    empty = spark.createDataFrame([(None,)], "v bigint")
    assert exact_percentiles(empty, "v", {"m": "0.5"}).collect()[0].m is None


def test_small_values_keep_their_digits(spark):
    df = spark.sql("SELECT CAST(v AS DECIMAL(18,8)) AS v FROM VALUES (0.00001), (0.00002) AS t(v)")
    assert float(exact_percentiles(df, "v", {"m": "0.5"}).first()["m"]) == 0.000015


def test_many_values_in_one_coarse_cell(spark, monkeypatch):
    """200,000 distinct values within 0.2 %: the cell is refined until few values are left to look at."""
    from tillroll.functions import percentiles

    seen = []
    looked_at = percentiles._parts_of

    def watched(counted, parts, scale, cell):
        rows = looked_at(counted, parts, scale, cell)
        if not cell:
            seen.append(rows.count())
        return rows

    monkeypatch.setattr(percentiles, "_parts_of", watched)
    df = spark.range(200_000).selectExpr("CAST(1000000000 + id * 10 + id % 3 AS DECIMAL(20,0)) * 0.01 AS v")
    row = exact_percentiles(df, "v", {"p0": "0.5", "p1": "0.75", "p2": "0.999"}).first()
    values = np.sort(np.array([1000000000 + i * 10 + i % 3 for i in range(200_000)], float))
    for name, f in (("p0", 0.5), ("p1", 0.75), ("p2", 0.999)):
        assert float(row[name]) == pytest.approx(np.quantile(values, f) / 100, rel=1e-14)
    assert seen and max(seen) <= 6 * percentiles.FEW_VALUES


def test_refinement_ends_on_any_spread(spark, monkeypatch):
    """Values from 1e-8 to 1e29 and a crowd of neighbours, with parts of three values at most."""
    from tillroll.functions import percentiles

    monkeypatch.setattr(percentiles, "FEW_VALUES", 3)
    monkeypatch.setattr(percentiles, "CELLS", 4)
    numbers = [Decimal(10) ** e for e in range(-8, 30)] + [Decimal(1000) + Decimal(i).scaleb(-8) for i in range(60)]
    numbers += [-n for n in numbers[5:40]] + [Decimal(0)] * 9
    df = spark.createDataFrame([(n,) for n in numbers], "v decimal(38,8)")
    ordered = sorted(numbers)
    fractions = {f"p{i}": str(Decimal(i) / (len(ordered) - 1)) for i in range(0, len(ordered), 7)}
    found = percentiles.find_percentiles(df, {n: percentiles.Percentile("v", f) for n, f in fractions.items()})
    for i in range(0, len(ordered), 7):
        near = ordered[max(0, i - 1) : i + 2]
        assert min(near) <= found[f"p{i}"] <= max(near)


def test_several_columns_and_filters_share_the_pass(spark):
    from tillroll.functions.percentiles import Percentile, find_percentiles

    rows = [(i, Decimal(i * i).scaleb(-2), i % 4) for i in range(500)] + [(None, None, 1)]
    df = spark.createDataFrame(rows, "a bigint, b decimal(12,2), c int")
    found = find_percentiles(
        df,
        {"x": Percentile("a", "0.5"), "y": Percentile("b", "0.75"), "z": Percentile("b", "0.75", "c = 2"), "none": Percentile("a", "0.5", "c = 9")},
    )
    assert float(found["x"]) == 249.5 and found["none"] is None
    assert float(found["y"]) == pytest.approx(np.quantile([i * i / 100 for i in range(500)], 0.75), rel=1e-12)
    assert float(found["z"]) == pytest.approx(np.quantile([i * i / 100 for i in range(2, 500, 4)], 0.75), rel=1e-12)
