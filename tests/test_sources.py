import pytest

from pyspark.sql import functions as F

from frames import day, dims, fact, one
from tillroll.operators.cleaning import transform
from tillroll.plans.analytics import build_extracts
from tillroll.plans.layers import MARTS, register_layers
from tillroll.sources import readers, workspace, writers
from tillroll.sources.schemas import STAR_SCHEMAS, conform_to_schema


def make_star(spark):
    rows = [
        ("1", "A", 7, 1, 2, "2010-01-01 10:30", "5.25", False),
        ("C2", "A", None, 2, -2, "2010-02-01", "5", True),
    ]
    return {"fact_sales": fact(spark, *rows), **dims(spark)}


def test_star_round_trip_and_full_refresh(spark, tmp_path):
    folder = str(tmp_path / "star")
    star = make_star(spark)
    writers.write_star(star, folder)
    writers.write_star(star, folder)
    loaded = readers.load_star(spark, folder)
    assert loaded["fact_sales"].count() == 2
    assert sorted(loaded["fact_sales"].collect()) == sorted(star["fact_sales"].collect())
    assert spark.table("dim_country").count() == 2


def test_schema_fills_is_return_and_names_missing_keys(spark):
    df = make_star(spark)["fact_sales"]
    assert conform_to_schema(df.drop("is_return"), STAR_SCHEMAS["fact_sales"]).where(
        "is_return IS NOT NULL"
    ).count() == 0
    with pytest.raises(ValueError, match="sale_id"):
        conform_to_schema(df.drop("sale_id"), STAR_SCHEMAS["fact_sales"])


def test_raw_csv_in_latin1(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_bytes(
        (
            "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
            '1,A,"café, ""grand""",2,2010-12-01 08:26:00,2.55,17850,United Kingdom\n'
            "2,A,NA,2,2010-12-01 08:26:00,2.55,,United Kingdom\n"
            "3,B, tea ,1,2010-12-01 08:26:00,1,nan,EIRE \n"
        ).encode("ISO-8859-1")
    )
    got = {r.invoice_number: r for r in transform(readers.read_raw_csv(spark, str(path))).collect()}
    assert set(got) == {"1", "3"}
    assert got["1"].description == 'café, "grand"' and got["1"].customer_id == 17850
    assert got["3"].description == " tea " and got["3"].country == "EIRE"


def test_files_with_other_headers_are_refused_together_but_stack_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Invoice,StockCode\n1,A\n")
    (tmp_path / "b.csv").write_text("StockCode,Invoice\nB,2\n")
    paths = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    with pytest.raises(Exception):
        readers.read_raw_csv(spark, paths).collect()
    stacked = readers.read_raw_periods(spark, paths)
    assert {(r.Invoice, r.StockCode) for r in stacked.collect()} == {("1", "A"), ("2", "B")}


def test_extract_round_trip_through_csv(spark, tmp_path):
    folder = str(tmp_path / "extracts")
    extracts = build_extracts(make_star(spark))
    writers.export_bi_extracts(extracts, folder)
    lines = readers.read_processed_fact(spark, f"{folder}/fact_sales_enriched")
    back = {r.sale_id: r for r in lines.collect()}
    assert len(back) == 2
    assert back["1"].invoice_date == day("2010-01-01 10:30") and float(back["1"].gross_revenue) == 10.5
    returned = back["2"]
    assert returned.customer_id is None and returned.is_return and returned.is_cancel_invoice
    assert back["1"].is_operational_code is False


def test_mart_export_reports_what_is_missing(spark, tmp_path):
    register_layers(spark, make_star(spark), mart_schema="analytics_marts")
    spark.sql("DROP TABLE analytics_marts.mart_country_revenue")
    folder = str(tmp_path / "marts")
    result = writers.export_marts(spark, folder)
    assert result.missing == ["mart_country_revenue"] and not result.complete
    views = writers.export_marts(spark, folder, mart_schema=None)
    assert views.exported == MARTS and views.complete
    typed = readers.type_mart_exports(spark, folder)
    kpis = one(typed["mart_executive_kpis"])
    assert (kpis.total_revenue, kpis.total_invoices) == (10.5, 2)
    first = one(typed["mart_customer_lifetime_value"])
    assert first.first_order_date == day("2010-01-01 10:30")
    assert "Total Revenue" in readers.readable_names(typed["mart_executive_kpis"]).columns
    spark.sql("DROP SCHEMA analytics_marts CASCADE")


def test_dedupe(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    assert sorted(map(tuple, readers.dedupe_by_key(df, "k").collect())) == [(1, "a"), (2, "b")]


def test_work_folder_is_below_the_configured_one(spark):
    assert workspace.work_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    calls = []
    for _ in range(2):
        workspace.landed_once(spark, "test-key", lambda p: calls.append(p))
    assert len(calls) == 1


def test_work_folder_is_removed_with_its_tables(spark, tmp_path, monkeypatch):
    from tillroll.sources import workspace

    app, root, other = spark.sparkContext.applicationId, tmp_path / "own", tmp_path / "other"
    other.mkdir()
    monkeypatch.setattr(workspace, "_ROOTS", {app: str(root)})
    monkeypatch.setattr(workspace, "_LANDED", {(app, "k"): ("p", None), ("another", "k"): ("p", None)})
    assert workspace.land(spark.range(3), "numbers").count() == 3 and root.exists()
    workspace.clean_work_folder(spark)
    assert not root.exists() and other.exists()
    assert workspace._ROOTS == {} and list(workspace._LANDED) == [("another", "k")]


def test_failed_refresh_leaves_the_old_star(spark, tmp_path):
    import pytest

    from tillroll.sources import versions

    folder = str(tmp_path / "star")
    old = make_star(spark)
    writers.write_star(old, folder)
    broken = {**old, "fact_sales": old["fact_sales"].withColumn("quantity", F.raise_error(F.lit("lost")).cast("int"))}
    with pytest.raises(Exception, match="lost"):
        writers.write_star(broken, folder)
    assert len(versions.published_versions(spark, folder)) == 1
    assert readers.load_star(spark, folder, views=False)["fact_sales"].count() == old["fact_sales"].count()
    new = {**old, "fact_sales": old["fact_sales"].limit(1)}
    reading = readers.load_star(spark, folder, views=False)["fact_sales"]
    writers.write_star(new, folder)
    assert readers.load_star(spark, folder, views=False)["fact_sales"].count() == 1
    assert reading.count() == old["fact_sales"].count()  # the version before stays for its readers
    writers.write_star(old, folder)
    assert len(versions.published_versions(spark, folder)) == 2


def test_star_is_not_written_over_its_own_input(spark, tmp_path):
    import pytest

    folder = str(tmp_path / "star")
    writers.write_star(make_star(spark), folder)
    own = readers.load_star(spark, folder, views=False)
    with pytest.raises(ValueError, match="is read from"):
        writers.write_star(own, folder)
    writers.write_star(own, str(tmp_path / "star-of-another-name"))
    with pytest.raises(FileNotFoundError):
        readers.load_star(spark, str(tmp_path / "nothing"), views=False)


def test_long_form(spark):
    from tillroll.sources.longform import long_form

    df = spark.createDataFrame([(1, "a", True, day("2010-01-01")), (None, None, None, None)], "k int, `odd name` string, f boolean, d timestamp_ntz")
    rows = {tuple(r) for r in long_form({"t": df, "u": df.select("k")}, {"t": ["k", "odd name"]}).collect()}
    assert ("t", "1|a", "odd name", "a", None, None) in rows and ("t", "1|a", "f", None, 1.0, None) in rows
    assert ("t", "1|a", "d", None, None, day("2010-01-01")) in rows and ("t", "", "f", None, None, None) in rows
    assert ("u", "", "k", None, 1.0, None) in rows and len(rows) == 10
