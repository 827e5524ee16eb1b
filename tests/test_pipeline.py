"""The whole pipeline on nine small hand-made CSV files."""

import csv
import os
from decimal import Decimal as D

import pytest
from armazem.plans import load
from armazem.plans.star import StoredStar
from armazem.plans import kpis, olap
from armazem.sources import rawfiles
from armazem.sources.catalog import RAW_TABLES
from pyspark.sql import functions as F

ROWS = {
    "orders": [
        ("o1", "c1", "delivered", "2017-01-10 10:00:00", "2017-01-10 11:00:00", "", "2017-01-20 09:00:00", "2017-01-25 00:00:00"),
        ("o2", "c2", "canceled", "2017-02-10 10:00:00", "", "", "", "2017-02-25 00:00:00"),
        ("o3", "c3", "delivered", "2018-03-10 10:00:00", "2018-03-10 11:00:00", "", "2018-03-30 09:00:00", "2018-03-25 00:00:00"),
        ("o4", "c4", "on_hold", "2018-03-11 10:00:00", "", "", "", "2018-03-25 00:00:00"),
    ],
    "order_items": [
        ("o1", "1", "p1", "s1", "2017-01-12 00:00:00", "100.00", "10.00"),
        ("o1", "2", "p2", "s2", "2017-01-12 00:00:00", "50.00", "5.50"),
        ("o2", "1", "p1", "s1", "2017-02-12 00:00:00", "100.00", "10.00"),
        ("o3", "1", "p2", "s1", "2018-03-12 00:00:00", "70.00", "0.00"),
    ],
    "order_payments": [
        ("o1", "1", "credit_card", "3", "100.00"), ("o1", "2", "voucher", "1", "65.50"),
        ("o2", "1", "boleto", "1", "110.00"), ("o3", "1", "boleto", "1", "70.00"),
    ],
    "order_reviews": [
        ("r1", "o1", "5", "", 'said "fine",\nand left', "2017-01-21 00:00:00", "2017-01-22 00:00:00"),
        ("r2", "o3", "2", "late", "", "2018-03-31 00:00:00", "2018-04-01 00:00:00"),
    ],
    "customers": [
        ("c1", "u1", "1001", "são paulo", "SP"), ("c2", "u1", "1001", "sao  paulo", "SP"),
        ("c3", "u1", "20000", "RIO DE JANEIRO", "rj"), ("c4", "u2", "1001", "sao paulo", "SP"),
    ],
    "products": [
        ("p1", "beleza_saude", "10", "20", "1", "500", "10", "10", "2.5"),
        ("p2", "", "", "", "", "", "", "", ""),
    ],
    "sellers": [("s1", "1001", "sao paulo", "SP"), ("s2", "99999", "porto alegre", "RS")],
    "geolocation": [
        ("1001", "-23.50", "-46.60", "sao paulo", "SP"), ("01001", "-23.60", "-46.70", "são paulo", "SP"),
        ("1001", "48.85", "2.35", "paris", "SP"), ("30000", "-19.90", "-43.90", "belo horizonte", "MG"),
    ],
    "category_translation": [("beleza_saude", "health_beauty")],
}
VOLUMES = tuple((name, len(rows)) for name, rows in ROWS.items())


def write(folder, skip=(), headers=None):
    for name, table in RAW_TABLES.items():
        if name in skip:
            continue
        columns = (headers or {}).get(name, table.columns)
        with open(os.path.join(folder, f"shop_{table.file_ending}"), "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f)
            out.writerow(columns)
            for row in ROWS[name]:
                named = dict(zip(table.columns, row))
                out.writerow([named.get(c, "") for c in columns])


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory):
    raw, out = tmp_path_factory.mktemp("raw"), tmp_path_factory.mktemp("out")
    write(raw, headers={"order_items": tuple(reversed(RAW_TABLES["order_items"].columns))})
    return load.run_pipeline(spark, str(raw), str(out), VOLUMES), str(out)


def test_audit_and_validations(result):
    done, _ = result
    assert {r.situacao for r in done.audit.collect()} == {"CONCLUIDA"}
    assert done.audit.where("registros_lidos = registros_carregados").count() == 9
    bad = [r for r in done.validations["V03"].collect() if r.situacao != "OK"]
    assert bad == [] and len(done.validations["V03"].collect()) == 26
    assert (done.failures, done.exit_code) == (0, 0)


def test_order_fact(result):
    done, _ = result
    orders = {r.order_id: r for r in done.warehouse["fato_pedido"].collect()}
    o1, o2, o3, o4 = (orders[k] for k in ("o1", "o2", "o3", "o4"))
    assert (o1.qtd_itens, o1.qtd_vendedores, o1.valor_total, o1.valor_pago) == (2, 2, D("165.50"), D("165.50"))
    assert (o1.prazo_entrega_dias, o1.atraso_entrega_dias, o1.flag_entregue_com_atraso) == (10, -5, False)
    assert o1.participacao_frete == D("0.0937")
    assert (o2.prazo_entrega_dias, o2.flag_entregue_com_atraso, o2.nota_avaliacao) == (None, None, None)
    assert (o3.atraso_entrega_dias, o3.flag_entregue_com_atraso, o3.nota_avaliacao) == (5, True, 2)
    assert (o4.qtd_itens, o4.valor_total, o4.valor_pago, o4.sk_pagamento) == (0, D("0.00"), None, 0)


def test_dimensions(result):
    done, _ = result
    w = done.warehouse
    person = w["dim_cliente"].where("customer_unique_id = 'u1'").first()
    assert (person.cidade, person.estado, person.regiao) == ("Rio de Janeiro", "RJ", "Sudeste")
    assert (person.qtd_pedidos, person.flag_recorrente) == (3, True)
    places = {r.cep_prefixo: r for r in w["dim_geografia"].collect()}
    assert (places["01001"].latitude_media, places["01001"].qtd_registros_origem) == (D("-23.550000"), 2)
    assert (places["99999"].origem, places["99999"].latitude_media) == ("clientes/vendedores", None)
    assert places["30000"].origem == "geolocation"
    products = {r.product_id: r for r in w["dim_produto"].collect()}
    assert (products["p1"].categoria, products["p1"].categoria_en) == ("Beleza Saude", "Health Beauty")
    assert (products["p1"].volume_cm3, products["p1"].faixa_peso) == (250, "Até 500 g")
    assert (products["p2"].categoria, products["p2"].categoria_en) == ("Não informado", "Not informed")
    status = {r.status_original: r for r in w["dim_status"].collect()}
    assert (status["on_hold"].status_descricao, status["on_hold"].ordem_ciclo) == ("On_Hold", 99)


def test_reports_with_original_parameters(result):
    done, _ = result
    star = StoredStar(done.warehouse)
    cities = olap.o03(star).collect()
    assert [(r.cidade, r.faturamento) for r in cities] == [("Sao Paulo", D("150.00"))]
    dice = [tuple(r) for r in olap.o05(star).collect()]
    assert dice == [
        (2017, "Sudeste", "Cartão de crédito", D("150.00"), 1, D("150.00")),
        (2018, "Sudeste", "Boleto", D("70.00"), 1, D("70.00")),
    ]
    matrix = {r.regiao_vendedor: r for r in olap.o16(star).collect()}
    assert matrix["Sul"].para_sudeste == D("10.0") and matrix["Sul"].para_norte is None
    assert matrix["Todas as regiões"].pedidos_entregues == 3
    figures = {r.kpi: r.valor for r in kpis.kpis(star).collect()}
    assert (figures["faturamento"], figures["pedidos"]) == (D("220.00"), D("2.00"))


def test_reports_are_exported(spark, result):
    _, out = result
    home = load.current(spark, out)
    back = spark.read.option("header", True).csv(f"{home}/reports/O01_rollup_calendar")
    total = back.where("nivel = 'Geral'").first()
    assert (total.ano, total.trimestre, total.faturamento) == ("Total geral", None, "220.00")
    assert len(os.listdir(f"{home}/reports")) == 17


def test_quoted_line_break_survives(spark, result):
    done, out = result
    text = load.open_staging(spark, out)["order_reviews"].where("review_id = 'r1'").first()
    assert text.review_comment_message == 'said "fine",\nand left'
    assert text.review_comment_title is None


def test_rerun_gives_the_same_keys(spark, result, tmp_path):
    done, out = result
    again = load.build(load.open_staging(spark, out), load.dims.default_states(spark), str(tmp_path))
    for name in load.DIMENSIONS + load.FACTS:
        assert sorted(map(str, again[name].collect())) == sorted(map(str, done.warehouse[name].collect()))


def test_missing_file_and_wrong_header(spark, tmp_path):
    write(tmp_path, skip=("sellers",))
    with pytest.raises(rawfiles.MissingInput, match="sellers_dataset"):
        rawfiles.read_all(spark, str(tmp_path))
    write(tmp_path, headers={"sellers": ("seller_id", "seller_city", "seller_state", "other")})
    with pytest.raises(rawfiles.HeaderMismatch):
        rawfiles.read_all(spark, str(tmp_path))
    report = rawfiles.header_report(
        spark, rawfiles.raw_path(str(tmp_path), "sellers"), RAW_TABLES["sellers"])
    assert report.where("situacao = 'FALHA'").count() == 2


def test_line_break_in_a_split_file_stops_the_load(spark, tmp_path):
    """Only files with free text may hold quoted line breaks; elsewhere they are an error."""
    write(tmp_path)
    path = tmp_path / f"shop_{RAW_TABLES['sellers'].file_ending}"
    path.write_text('seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1001,"sao\npaulo",SP\n')
    rows = rawfiles.read_raw(spark, str(path), RAW_TABLES["sellers"])
    with pytest.raises(Exception, match="(?i)malformed"):
        rows.collect()


def test_parts_with_their_own_headers(spark, tmp_path):
    """Every part file is read by its own header, blanks around its names included."""
    write(tmp_path, skip=("sellers",))
    ending = RAW_TABLES["sellers"].file_ending
    (tmp_path / f"a_{ending}").write_text("seller_id, seller_zip_code_prefix,seller_city,seller_state\ns1,1001,sao paulo,SP\n")
    (tmp_path / f"b_{ending}").write_text("seller_id,seller_city,seller_zip_code_prefix,seller_state\ns2,rio,20000,RJ\n")
    rows = {r.seller_id: r for r in rawfiles.read_all(spark, str(tmp_path))["sellers"].collect()}
    assert (rows["s2"].seller_zip_code_prefix, rows["s2"].seller_city) == ("20000", "rio")
    assert (rows["s1"].seller_zip_code_prefix, rows["s1"].seller_city) == ("1001", "sao paulo")
    (tmp_path / f"c_{ending}").write_text("seller_id,seller_city,seller_state\ns3,rio,RJ\n")
    with pytest.raises(rawfiles.HeaderMismatch, match="c_"):
        rawfiles.read_all(spark, str(tmp_path))


def changed(folder, table, rows):
    """The raw files with one table's rows replaced."""
    own = ROWS[table]
    ROWS[table] = rows
    try:
        write(folder)
    finally:
        ROWS[table] = own


def tables_of(spark, folder):
    return {n: sorted(map(str, t.collect())) for n, t in load.open_warehouse(spark, folder).items()}


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    """A sound warehouse that later loads are tried on."""
    raw, out = tmp_path_factory.mktemp("raw"), str(tmp_path_factory.mktemp("out"))
    write(raw)
    first = load.run_pipeline(spark, str(raw), out, VOLUMES)
    assert first.published and first.exit_code == 0
    return out


@pytest.mark.parametrize(("table", "rows", "broken"), [
    ("order_items", [*ROWS["order_items"], ROWS["order_items"][0]], "unique fato_vendas (order_id, order_item_id)"),
    ("orders", [*ROWS["orders"][:3], (*ROWS["orders"][3][:7], "")], "not null fato_pedido"),
])
def test_broken_constraint_sets_the_exit_code_and_is_not_published(spark, warehouse, tmp_path, table, rows, broken):
    before = tables_of(spark, warehouse)
    changed(tmp_path, table, rows)
    volumes = [(n, len(rows) if n == table else k) for n, k in VOLUMES]
    done = load.run_pipeline(spark, str(tmp_path), warehouse, volumes)
    assert (done.exit_code, done.published) == (1, False)
    assert broken in {r.restricao for r in done.validations["V06"].where("situacao = 'FALHA'").collect()}
    assert tables_of(spark, warehouse) == before


def test_failed_load_leaves_the_warehouse_and_names_the_table(spark, warehouse, tmp_path):
    before = tables_of(spark, warehouse)
    write(tmp_path)
    path = tmp_path / f"shop_{RAW_TABLES['sellers'].file_ending}"
    path.write_text('seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1001,"sao\npaulo",SP\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        load.run_pipeline(spark, str(tmp_path), warehouse, VOLUMES)
    assert tables_of(spark, warehouse) == before
    audit = {r.tabela_destino: r for r in load.open_audit(spark, warehouse).collect()}
    assert audit["sellers"].situacao == "ERRO" and audit["sellers"].registros_carregados is None
    assert all(r.situacao in ("CONCLUIDA", "ERRO", "EM ANDAMENTO") for r in audit.values())
    assert all(r.inicio_carga <= r.fim_carga for r in audit.values() if r.fim_carga)


def test_bad_number_stops_a_load(spark, warehouse, tmp_path):
    """Strict casts: text that is no number or no date is an error, not a missing value."""
    before = tables_of(spark, warehouse)
    for table, column, bad in (("order_items", 5, "12,50"), ("orders", 3, "2017-13-01")):
        rows = [list(r) for r in ROWS[table]]
        rows[0][column] = bad
        changed(tmp_path, table, rows)
        with pytest.raises(Exception, match="(?i)cast|invalid"):
            load.run_pipeline(spark, str(tmp_path), warehouse, VOLUMES)
    assert tables_of(spark, warehouse) == before


def test_revenue_depends_on_both_facts_agreeing(spark, warehouse):
    """Reports take an order's sums from the order fact; reconciliation reports it if they lie."""
    tables = dict(load.open_warehouse(spark, warehouse))
    orders = tables["fato_pedido"]
    wrong = F.when(F.col("order_id") == "o1", F.col("valor_itens") + 1).otherwise(F.col("valor_itens"))
    lying = {**tables, "fato_pedido": orders.withColumn("valor_itens", wrong.cast("decimal(12,2)"))}
    assert olap.o01(StoredStar(lying)).where("nivel = 'Geral'").first().faturamento == D("221.00")
    found = load.checks.reconciliation(load.open_staging(spark, warehouse), lying)
    assert {r.ordem for r in found.where("situacao = 'FALHA'").collect()} == {7}


def test_slices_open_only_their_years(spark, warehouse):
    star = StoredStar(load.open_warehouse(spark, warehouse))
    for rows in (olap.o04(star, 2018), olap.o05(star, anos=(2018,))):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "particao_ano" in plan[plan.index("PartitionFilters: [isnotnull(particao_ano"):][:200]
    plan = olap.o01(star)._jdf.queryExecution().executedPlan().toString()
    assert "order_id" not in plan and "fato_vendas" not in plan


def test_order_of_details_subtotals_and_missing_values(spark, warehouse):
    star = StoredStar(load.open_warehouse(spark, warehouse))
    levels = [r.nivel for r in olap.o01(star).collect()]
    assert levels[-1] == "Geral" and levels.index("Mês") < levels.index("Trimestre") < levels.index("Ano")
    regions = [(r.regiao, r.estado) for r in olap.o02(star).collect()]
    assert regions[-1][0] == "Total geral" and regions[-2][1] == "(subtotal)"
    cube = [(r.regiao, r.tipo_pagamento) for r in olap.o15(star).collect()]
    assert cube[-1] == ("Todas as regiões", "Todos os tipos")
