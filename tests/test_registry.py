"""Every registered query against its SQL, and reports on written tables against the source."""

import __spark_entry__ as entry
import oracles
import pytest
import registry
from armazem.plans import olap
from compare import difference


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(oracles.all_queries())
    assert set(registry.QUERIES) <= set(entry.queries()) and set(oracles.all_queries()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_matches_sql(spark, con, folder, name):
    assert difference(spark, con, folder, name) == ""
    assert con.execute(f"SELECT COUNT(*) FROM ({oracles.all_queries()[name]}) q").fetchone()[0] > 0, "nothing compared"


@pytest.mark.parametrize("code", sorted(olap.REPORTS))
def test_written_warehouse_gives_the_same_report(spark, folder, code):
    direct = registry.report(code, registry.star(spark, folder)).collect()
    stored = registry.report(code, registry.stored_star(spark, folder)).collect()
    key = lambda row: tuple(str(x) for x in row)
    assert direct
    assert sorted(map(key, direct)) == sorted(map(key, stored))


def test_flagship(spark):
    rows = entry.entry(spark)
    assert rows.columns[:3] == ["ano", "trimestre", "mes"]
    assert rows.count() > 0


def test_invariants_across_reports(spark, folder):
    star = registry.stored_star(spark, folder)
    o01 = registry.report("O01", star).collect()
    grand = next(r for r in o01 if r.nivel == "Geral")
    months = [r for r in o01 if r.nivel == "Mês"]
    assert sum(r.faturamento for r in months) == grand.faturamento
    assert sum(r.pedidos for r in months) == grand.pedidos
    o02 = registry.report("O02", star).collect()
    leaves = [r for r in o02 if r.estado != "(subtotal)"]
    assert sum(r.faturamento for r in leaves) == grand.faturamento
    o06 = registry.report("O06", star).collect()
    assert sum(r.fat_total for r in o06) == grand.faturamento
    o15 = registry.report("O15", star).collect()
    cells = [r for r in o15 if r.regiao != "Todas as regiões" and r.tipo_pagamento != "Todos os tipos"]
    assert sum(r.pedidos for r in cells) == grand.pedidos
    o17 = registry.report("O17", star).collect()
    assert sum(r.faturamento for r in o17) == grand.faturamento
    assert sum(r.pedidos for r in o17) >= grand.pedidos
    orders = star.orders("order_id").count()
    assert sum(r.pedidos for r in registry.report("O11", star).collect()) == orders
    assert sum(r.pedidos for r in registry.report("O14", star).collect()) == orders


def test_sql_parameters_are_the_registered_ones():
    assert registry.REPORT_PARAMETERS["O03"]["estado"] == oracles.STATE
