"""What stays on disk: no shuffle files of written tables, no table that only served to build another."""

import os
import time

import pytest
from pyspark.sql import functions as F

from tillroll.plans.layers import register_layers
from tillroll.sources import workspace
from tillroll.testbed import queries, tables


@pytest.fixture
def own_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "_ROOTS", {spark.sparkContext.applicationId: str(tmp_path / "own")})
    monkeypatch.setattr(workspace, "_LANDED", {})
    return tmp_path / "own"


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark, own_folder):
    before = shuffle_files(spark)
    sums = spark.range(10_000).groupBy((F.col("id") % 700).alias("k")).agg(F.sum("id").alias("s"))
    assert workspace.land(sums, "sums").count() == 700
    until = time.time() + 20
    while time.time() < until and [n for n in shuffle_files(spark) - before if n.endswith(".data")]:
        time.sleep(0.2)
    # The count after the write is a job of its own: one row of each of its few tasks.
    left = [n for n in shuffle_files(spark) - before if n.endswith(".data")]
    assert len(left) <= 8
    assert sums.count() == 700 and spark.conf.get(workspace._FREE_SHUFFLES) == "false"


def test_scratch_tables_are_deleted(spark, own_folder):
    kept = workspace.land(spark.range(3), "kept")
    with workspace.scratch(spark):
        assert workspace.land(spark.range(4), "gone").count() == 4
        with workspace.scratch(spark):
            workspace.land(spark.range(5), "inner")
        assert [n.split("-")[0] for n in sorted(os.listdir(own_folder))] == ["gone", "kept"]
    assert [n.split("-")[0] for n in os.listdir(own_folder)] == ["kept"] and kept.count() == 3


def test_lent_tables_are_deleted_and_stored_again(spark, own_folder):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    with workspace.lent(spark, "k"):
        assert workspace.landed_table(spark, "k", build).count() == 3
    assert os.listdir(own_folder) == []
    assert workspace.landed_table(spark, "k", build).count() == 3
    with workspace.lent(spark, "k"):
        again = workspace.landed_table(spark, "k", build)
    assert again.count() == 3 and len(calls) == 2


def test_dashboard_lines_leave_nothing_that_they_were_built_from(spark, small, own_folder):
    lines = tables.dashboard_fact(spark, small).count()
    assert len(os.listdir(own_folder)) == 1
    raw = tables.raw_lines(spark, small)
    stars = tables.star(spark, small)
    assert len(os.listdir(own_folder)) == 3
    assert raw.count() >= lines == stars["fact_sales"].count()


def given(spark, folder):
    """Order tables of a few rows: keys that are null or have no partner, a repeated line, a null flag."""
    day = F.lit("1997-05-06").cast("timestamp_ntz")
    rows = {
        "nation": spark.createDataFrame([(n, f"NATION_{n}") for n in range(25)], "n_nationkey int, n_name string"),
        "customer": spark.createDataFrame([(1, 3), (2, 4), (3, None)], "c_custkey long, c_nationkey int"),
        "orders": spark.createDataFrame(
            [(n, n % 3 + 1 if n else None) for n in [*range(40), None]], "o_orderkey long, o_custkey long"
        ).withColumn("o_orderdate", day),
        "part": spark.createDataFrame([(n, f"part {n}") for n in range(90, 110)], "p_partkey long, p_name string"),
        "lineitem": spark.createDataFrame(
            [
                (o, p, 7 * (o or 1), n, 2.0, 12.34 * (n + 1), flag)
                for o in [*range(45), None]
                for p, n, flag in [(97, 1, "R"), (98, 3, "A"), (98, 3, "A"), (None, 2, "N"), (99, 7, None), (200, 2, "R")]
            ],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
            " l_extendedprice double, l_returnflag string",
        ),
    }
    for name, df in rows.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_parts_of_raw_lines_are_the_whole(spark, tmp_path, own_folder):
    sf = given(spark, tmp_path / "given")
    whole = sorted(map(str, tables.derive_raw_lines(spark, sf).collect()))
    stored = tables.raw_lines(spark, sf)
    assert sorted(map(str, stored.collect())) == whole and len(whole) == 4 * 26
    assert all(f.endswith(".zstd.parquet") for f in stored.inputFiles())
    # By the rules, line by line: a null flag is no return.
    odd = stored.where("invoice_number = '500001'")
    assert sorted((r.stock_code, r.quantity, float(r.unit_price)) for r in odd.collect()) == [
        ("10098", 2, 49.36), ("10098", 2, 49.36), ("10099", 2, 98.72),
    ]
    returned = stored.where("invoice_number = 'C500001'").first()
    assert (returned.stock_code, returned.description, returned.quantity) == ("10097A", None, -2)


def test_each_part_shuffles_its_own_lines_only(spark, small):
    counts = [tables.derive_raw_lines(spark, small, part).count() for part in range(tables.PARTS)]
    assert min(counts) > 0 and sum(counts) == tables.derive_raw_lines(spark, small).count()
    assert max(counts) < 0.5 * sum(counts)


def test_views_read_stored_models(spark, small, own_folder):
    layers = register_layers(spark, queries._stored_layers(spark, small))
    for name in ("int_order_metrics", "int_customer_orders", "int_country_metrics", "int_customer_lifetime_value"):
        plan = spark.table(name)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "FileScan" in plan
        fresh = register_layers(spark, tables.star(spark, small))[name]
        assert sorted(map(str, fresh.collect())) == sorted(map(str, layers[name].collect()))
        register_layers(spark, layers)
