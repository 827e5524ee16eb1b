"""Loads that set bad rows aside: what is rejected, what is loaded, and when a load fails all the same."""

import json

import pytest
from armazem import vocabulary as v
from armazem.plans import load
from armazem.plans.quarantine import Quarantine, TooManyRejects
from armazem.sources.catalog import RAW_TABLES
from test_pipeline import ROWS, VOLUMES, tables_of, write

BAD = {
    "order_items": [("o1", "3", "p1", "s1", "2017-01-12 00:00:00", "12,50", "free"), ("o1", "x", "p1", "s1", "", "1.00", "1.00")],
    "orders": [("o9", "c1", "delivered", "2017-13-01", "", "", "", "2017-02-25 00:00:00")],
    "products": [("p9", "toys", "ten", "", " ", "1.5", "1", "1", "1")],
    "order_reviews": [("r9", "o1", "five", "", "line\nbreak", "2017-01-21 00:00:00", "yesterday")],
    "geolocation": [("1001", "north", "-46.60", "sao paulo", "SP")],
}


@pytest.fixture
def raw(tmp_path, monkeypatch):
    """The raw files with bad rows in five tables, and a row of a wrong width in two."""
    folder = tmp_path / "raw"
    folder.mkdir()
    for name, rows in BAD.items():
        monkeypatch.setitem(ROWS, name, [*ROWS[name], *rows])
    write(folder)
    for name, line in (("sellers", "s9,1001,too few\n"), ("order_reviews", "r8,o1,5,a,b,c,d,too many\n")):
        with open(folder / f"shop_{RAW_TABLES[name].file_ending}", "a") as f:
            f.write(line)
    return str(folder)


def test_bad_rows_are_set_aside_with_their_reasons(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    done = load.run_pipeline(spark, raw, out, VOLUMES, Quarantine(most_rows=2))
    assert (done.published, done.exit_code) == (True, 0)
    found = load.open_rejects(spark, out).collect()
    assert sorted((r.tabela, r.coluna or "", r.texto, r.motivo) for r in found) == sorted([
        ("order_items", "price", "12,50", v.BAD_NUMBER), ("order_items", "freight_value", "free", v.BAD_NUMBER),
        ("order_items", "order_item_id", "x", v.BAD_NUMBER), ("orders", "order_purchase_timestamp", "2017-13-01", v.BAD_DATE),
        ("products", "product_name_lenght", "ten", v.BAD_NUMBER), ("order_reviews", "review_score", "five", v.BAD_NUMBER),
        ("order_reviews", "review_answer_timestamp", "yesterday", v.BAD_DATE), ("geolocation", "geolocation_lat", "north", v.BAD_NUMBER),
        ("sellers", "", "s9,1001,too few", v.BAD_WIDTH), ("order_reviews", "", "r8,o1,5,a,b,c,d,too many", v.BAD_WIDTH)])
    row = json.loads(next(r.linha for r in found if r.coluna == "review_score"))
    assert (row["review_id"], row["review_comment_message"]) == ("r9", "line\nbreak")
    audit = {r.tabela_destino: r for r in done.audit.collect()}
    for name, n in VOLUMES:
        bad = len(BAD.get(name, ())) + (name in ("sellers", "order_reviews"))
        r = audit[name]
        assert (r.registros_lidos, r.registros_carregados, r.registros_rejeitados) == (n + bad, n, bad)
        assert r.situacao == v.LOAD_DONE
    staged = load.open_staging(spark, out)
    assert {n: staged[n].count() for n, _ in VOLUMES} == dict(VOLUMES)
    assert staged["orders"].columns == list(RAW_TABLES["orders"].columns)


def test_the_warehouse_is_that_of_the_good_rows(spark, raw, tmp_path, monkeypatch):
    load.run_pipeline(spark, raw, str(tmp_path / "a"), VOLUMES, Quarantine(most_share=0.5))
    monkeypatch.undo()
    clean = tmp_path / "clean"
    clean.mkdir()
    write(clean)
    load.run_pipeline(spark, str(clean), str(tmp_path / "b"), VOLUMES)
    assert tables_of(spark, str(tmp_path / "a")) == tables_of(spark, str(tmp_path / "b"))
    assert load.open_rejects(spark, str(tmp_path / "b")).collect() == []


@pytest.mark.parametrize("limit", [Quarantine(most_rows=1), Quarantine(most_share=0.1)])
def test_too_many_bad_rows_fail_the_load(spark, raw, tmp_path, limit):
    out = str(tmp_path / "out")
    with pytest.raises(TooManyRejects):
        load.run_pipeline(spark, raw, out, VOLUMES, limit)
    assert load.published(spark, out) == []
    audit = {r.tabela_destino: r for r in load.open_audit(spark, out).collect()}
    failed = audit["order_items"]
    assert (failed.situacao, failed.registros_lidos, failed.registros_rejeitados) == (v.LOAD_FAILED, 6, 2)


def test_a_load_stays_strict_without_a_quarantine(spark, raw, tmp_path):
    with pytest.raises(Exception, match="(?i)malformed|cast|invalid"):
        load.run_pipeline(spark, raw, str(tmp_path / "out"), VOLUMES)
    assert load.published(spark, str(tmp_path / "out")) == []
