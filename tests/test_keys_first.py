"""Facts whose keys are resolved on narrow rows: same rows, narrow shuffles, files written as they come."""

import os
import re

import registry
from armazem.plans import facts, load
from pyspark.sql import functions as F


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def sorted_rows(frame):
    return sorted(map(str, frame.collect()))


def repeated(tables, name, key):
    """The table with repeated rows and rows without a key beside its own."""
    own = tables[name]
    bare = own.limit(3).withColumn(key, F.lit(None).cast(own.schema[key].dataType))
    return dict(tables) | {name: own.unionByName(own.limit(5)).unionByName(bare)}


def test_keys_first_gives_the_same_facts(spark, folder):
    stg, warehouse, _ = registry.loaded(spark, folder)
    heads = repeated(stg, "orders", "customer_id")
    assert sorted_rows(facts.order_fact(heads, warehouse, keys_first=True)) == sorted_rows(facts.order_fact(heads, warehouse))
    items, orders = repeated(stg, "order_items", "product_id"), warehouse["fato_pedido"]
    first, last = (facts.item_fact(items, warehouse, orders, keys_first=k) for k in (True, False))
    assert sorted_rows(first) == sorted_rows(last)


def depths(rows, key):
    """How deep in the plan the joins by a key are."""
    tree = rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
    return [len(line) - len(line.lstrip(" :+-")) for line in tree if re.search(rf"Join .*\({key}#", line)]


def test_keys_are_resolved_before_rows_meet_their_order(spark, folder):
    stg, warehouse, _ = registry.loaded(spark, folder)
    items = facts.item_fact(stg, warehouse, warehouse["fato_pedido"], keys_first=True)
    orders = facts.order_fact(stg, warehouse, keys_first=True)
    for rows, keys in ((items, ("product_id", "seller_id")), (orders, ("customer_id", "status_original"))):
        last = min(depths(rows, "order_id"))
        assert all(min(depths(rows, key)) > last for key in keys)


def test_facts_are_written_as_they_come(spark, folder):
    """A bucket is one file in each year, and tables are written with the compression named."""
    home = load.current(spark, registry.loaded_folder(spark, folder)).removeprefix("file:")
    for name in load.FACTS:
        for year in (y for y in os.listdir(f"{home}/{name}") if y.startswith("particao_ano=")):
            files = [f for f in os.listdir(f"{home}/{name}/{year}") if f.endswith(".parquet")]
            buckets = [re.search(r"_(\d{5})\.", f).group(1) for f in files]
            assert len(set(buckets)) == len(buckets) <= 8
            assert all(".zstd." in f for f in files)


def test_the_order_fact_reads_the_staged_tables(spark, folder):
    """As a load does; the provided lines are not summed by order again."""
    assert "l_orderkey" not in plan_of(registry.f01_order_fact(spark, folder))
