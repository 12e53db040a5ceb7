from decimal import Decimal

from frames import dims, fact, one
from tillroll.operators import quality as q
from tillroll.plans.layers import MODELS, Layers
from test_plans import plan


def test_each_check_finds_a_seeded_row(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "z"), (2, "a")], "k int, v string")
    parent = spark.createDataFrame([(1,), (1,)], "id int")
    assert one(q.check_not_null(df, "v")).failures == 1
    assert one(q.check_unique(df, "k")).failures == 1
    assert one(q.check_accepted_values(df, "v", ["a"])).failures == 1
    assert one(q.check_relationships(df, "k", parent, "id")).failures == 1


def test_checks_pass_on_good_and_on_no_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a")], "k int, v string")
    for rows in (df, df.where("false")):
        assert one(q.check_not_null(rows, "k")).failures == 0
        assert one(q.check_unique(rows, "k")).failures == 0
        assert one(q.check_accepted_values(rows, "v", ["a"])).failures == 0
        assert one(q.check_relationships(rows, "k", df, "k")).failures == 0


def test_suite_has_41_checks_and_finds_bad_star_rows(spark):
    f = fact(
        spark,
        ("1", "A", 7, 1, 1, "2010-01-01", "5", False),
        (None, "B", 9, 3, 1, None, None, False),
        ("3", None, None, None, None, "2010-01-01", "5", None),
    )
    star = {"fact_sales": f.unionByName(f.limit(1)), **dims(spark)}
    star["dim_product"] = star["dim_product"].unionByName(
        spark.createDataFrame(
            [("A", "twin", Decimal("2.00"))], star["dim_product"].schema
        )
    )
    rows = q.run_quality_suite(Layers(star)).collect()
    assert len(rows) == 41 == len({(r.model, r.column_name, r.check_name) for r in rows})
    failed = {(r.model, r.column_name, r.check_name): r.failures for r in rows if not r.passed}
    assert failed[("stg_sales", "sale_id", "unique")] == 1
    assert failed[("stg_sales", "invoice_number", "not_null")] == 1
    assert failed[("stg_sales", "quantity", "not_null")] == 1
    assert failed[("stg_sales", "unit_price", "not_null")] == 1
    assert failed[("stg_products", "stock_code", "unique")] == 1
    assert failed[("int_sales_enriched", "stock_code", "relationships")] == 1
    assert failed[("int_sales_enriched", "customer_id", "relationships")] == 1
    assert failed[("int_sales_enriched", "country_id", "relationships")] == 1
    assert failed[("int_customer_orders", "customer_id", "relationships")] == 1
    assert failed[("mart_country_revenue", "country_name", "not_null")] == 1
    assert failed[("mart_sales_monthly", "month", "not_null")] == 1
    assert ("stg_sales", "is_return", "accepted_values") not in failed


def test_suite_reads_each_model_once_and_shuffles_keys_once(spark, small):
    from tillroll.testbed import tables

    layers = Layers(tables.star(spark, small)).stored(*MODELS)
    text = plan(q.run_quality_suite(layers, store=()))
    assert text.count("FileScan") == len({c.model for c in q.SUITE} | {c.parent for c in q.SUITE if c.parent})
    assert text.count("Exchange hashpartitioning(item") == 2 and "SortMergeJoin" not in text


def test_observed_and_planned_checks_agree(spark):
    f = fact(spark, ("1", "A", 7, 1, 1, "2010-01-01", "5", False), (None, "B", 9, 3, 1, None, None, False))
    layers = Layers({"fact_sales": f, **dims(spark)})
    found = [sorted(map(tuple, q.run_quality_suite(layers, store=s).collect())) for s in ((), q.SHARED_MODELS, MODELS)]
    assert found[0] == found[1] == found[2] and len(found[0]) == 41
    some = [c for c in q.SUITE if c.model == "mart_executive_kpis"]
    assert q.run_quality_suite(layers, some).count() == 2
