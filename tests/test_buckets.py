"""Order-grain tables that share a bucketing: no shuffle by order, reopening, hot orders."""

import re

import pytest
import registry
from armazem.plans import checks, facts, load
from armazem.sources import buckets
from armazem.sources.binding import Source
from pyspark.sql import functions as F


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rows_of(tables, names):
    return {n: sorted(map(str, tables[n].collect())) for n in names}


def test_orders_and_items_meet_without_a_shuffle(spark, folder, no_broadcast):
    stg, warehouse, _ = registry.loaded(spark, folder)
    both = checks._both_facts(warehouse["fato_pedido"], warehouse["fato_vendas"])
    assert "Exchange" not in plan_of(both) and "SortMergeJoin" in plan_of(both)
    for rows in (facts.item_fact(stg, warehouse, warehouse["fato_pedido"]), facts.order_fact(stg, warehouse),
                 checks.reconciliation(stg, warehouse), facts.item_totals(stg), facts.payment_totals(stg), facts.review_scores(stg)):
        assert not re.search(r"hashpartitioning\(order_id#", plan_of(rows))


def test_tables_are_opened_by_their_buckets_in_another_session(spark, folder, no_broadcast):
    target = registry.loaded_folder(spark, folder)
    stg, warehouse = load.open_staging(spark, target), load.open_warehouse(spark, target)
    names = load.FACTS
    before = rows_of(warehouse, names)
    staged = rows_of(stg, load.ORDER_TABLES)
    for t in spark.catalog.listTables():  # as a session that has not seen them
        if t.name.startswith("armazem_"):
            spark.sql(f"DROP TABLE {t.name}")
    spark.conf.set("spark.sql.shuffle.partitions", "5")  # with other settings
    try:
        again, reopened = load.open_staging(spark, target), load.open_warehouse(spark, target)
        assert rows_of(again, load.ORDER_TABLES) == staged
        assert rows_of(reopened, names) == before
        both = checks._both_facts(reopened["fato_pedido"], reopened["fato_vendas"])
        assert "Exchange" not in plan_of(both)
        files = spark.read.parquet(f"{load.current(spark, target)}/fato_vendas")
        assert sorted(map(str, files.select(reopened["fato_vendas"].columns).collect())) == before["fato_vendas"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_a_hot_order_makes_the_set_be_read_by_files(spark, folder, tmp_path, monkeypatch, no_broadcast):
    """A third of all items in one order: buckets are left, so that Spark can split the order."""
    monkeypatch.setattr(buckets, "LARGE", 1000)
    source = Source(spark, folder)
    raw = dict(source.staging)
    third = F.when(F.pmod(F.xxhash64("order_id", "order_item_id", "product_id"), F.lit(3)) == 0, F.lit(7)).otherwise(F.col("order_id"))
    raw["order_items"] = raw["order_items"].withColumn("order_id", third.cast("bigint"))
    stg, _ = load.stage(spark, raw, str(tmp_path))
    assert buckets.Buckets.of(spark, str(tmp_path)).number == 0
    tables = load.build(stg, source.states, str(tmp_path), registry.p.RECURRING_ABOVE)
    assert re.search(r"hashpartitioning\(order_id#", plan_of(facts.item_fact(stg, tables, tables["fato_pedido"])))
    assert tables["fato_vendas"].count() == raw["order_items"].count()
    opened = load.open_warehouse(spark, str(tmp_path))
    assert opened["fato_vendas"].where("order_id = 7").count() >= raw["order_items"].count() // 4
    plain, _ = load.stage(spark, dict(source.staging), str(tmp_path / "even"))
    assert buckets.Buckets.of(spark, str(tmp_path / "even")).number == 8


def test_null_keys_and_empty_tables(spark, tmp_path):
    dealt = buckets.Buckets.begin(spark, str(tmp_path), "order_id")
    rows = spark.createDataFrame([(None, 1, 2020), ("a", 2, 2021), ("a", 2, 2021), ("b", None, None)], "order_id string, n int, y int")
    written = dealt.write(rows, f"{tmp_path}/t", ["y"])
    assert sorted(map(str, written.collect())) == sorted(map(str, rows.collect()))
    assert dealt.write(rows.limit(0), f"{tmp_path}/e").collect() == []
    assert dealt.settle([written]).number == 8
    assert buckets.Buckets.of(spark, str(tmp_path / "none")) is None
    assert dealt.write(rows.where("n = 2"), f"{tmp_path}/t", ["y"]).count() == 2  # a full reload
