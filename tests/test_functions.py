"""Hand-made rows for the text, number and ordering rules."""

from decimal import Decimal as D

import pytest
from armazem.functions import dates, numbers, text
from armazem.operators import grouping, keys, modes, pick
from armazem.plans import dims, facts
from pyspark.sql import functions as F


def one(spark, value, build, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(build(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(("raw", "expected"), [
    ("  são bernardo do campo ", "Sao Bernardo do Campo"),
    ("SANTA BÁRBARA D'OESTE", "Santa Barbara D'Oeste"),
    ("embu-guaçu", "Embu-Guacu"),
    ("mogi  das\tcruzes e do sul", "Mogi das Cruzes e do Sul"),
    ("rio de de janeiro", "Rio de De Janeiro"),
    ("1st avenue (norte)", "1st Avenue (Norte)"),
    ("ßa strasse", "ßa Strasse"),
    ("   ", None),
    (None, None),
])
def test_normalize_label(spark, raw, expected):
    assert one(spark, raw, text.normalize_label) == expected


def test_zip_prefix(spark):
    assert one(spark, "9790", text.zip_prefix) == "09790"
    assert one(spark, " 123456 ", text.zip_prefix) == "12345"


@pytest.mark.parametrize(("raw", "expected"), [("2.5", 3), ("-2.5", -3), ("2.4", 2), (" ", None), (None, None)])
def test_whole_rounds(spark, raw, expected):
    assert one(spark, raw, lambda c: numbers.whole(numbers.number(c))) == expected


@pytest.mark.parametrize(("amount", "count", "expected"), [
    ("1.01", 2, D("0.51")), ("-1.01", 2, D("-0.51")), ("1.00", 3, D("0.33")), ("1.00", 0, None),
])
def test_quotient_half_up(spark, amount, count, expected):
    row = spark.createDataFrame([(D(amount), count)], "a decimal(10,2), n bigint")
    assert row.select(numbers.quotient(F.col("a"), F.col("n")).alias("y")).first().y == expected


@pytest.mark.parametrize(("weight", "label"), [
    (500, "Até 500 g"), (501, "501 g a 2 kg"), (2000, "501 g a 2 kg"), (2001, "2 kg a 10 kg"),
    (10000, "2 kg a 10 kg"), (10001, "Acima de 10 kg"),
])
def test_weight_bands(spark, weight, label):
    from armazem import vocabulary as v

    build = lambda c: numbers.band(c, v.WEIGHT_BANDS, v.WEIGHT_ABOVE)
    assert one(spark, weight, build, "x int") == label


def test_sunday_is_zero(spark):
    assert one(spark, "2016-09-04", lambda c: dates.weekday_number(c.cast("date"))) == 0
    assert one(spark, "2016-09-10", lambda c: dates.weekday_number(c.cast("date"))) == 6


def test_days_ignore_the_time(spark):
    row = spark.sql("SELECT timestamp_ntz'2017-01-01 23:59:59' a, timestamp_ntz'2017-01-02 00:00:01' b")
    assert row.select(dates.days_between(F.col("a"), F.col("b")).alias("y")).first().y == 1


def test_calendar_covers_whole_years(spark):
    orders = spark.createDataFrame(
        [("2016-09-04 21:15:19", "2016-10-20 00:00:00", None),
         ("2018-08-01 00:00:00", "2018-11-12 00:00:00", "2018-10-17 13:22:46")],
        "order_purchase_timestamp string, order_estimated_delivery_date string,"
        " order_delivered_customer_date string")
    days = dims.calendar({"orders": orders})
    ends = days.agg(F.min("sk_tempo").alias("a"), F.max("sk_tempo").alias("b"), F.count("*").alias("n"))
    assert tuple(ends.first()) == (20160101, 20181231, 1096)
    day = days.where("sk_tempo = 20170304").first()
    assert (day.nome_mes, day.nome_trimestre, day.semestre, day.nome_dia_semana, day.fim_de_semana) == (
        "Março", "1T2017", 1, "Sábado", True)


def test_mode_prefers_the_smallest_and_skips_null(spark):
    rows = spark.createDataFrame(
        [("a", "y", 1), ("a", "x", 2), ("a", None, 4), ("a", None, 8), ("a", None, 16), ("b", None, 1)],
        "k string, m string, w int")
    got = {r.k: (r.m, r.n, r.w) for r in modes.profile_per_key(rows, "k", ["m"], ["w"]).collect()}
    assert got == {"a": ("x", 5, 31), "b": (None, 1, 1)}


def test_dense_keys_do_not_depend_on_partitioning(spark):
    rows = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"))
    first = keys.with_dense_key(rows.repartition(7), "k", "sk")
    again = keys.with_dense_key(rows.repartition(2).orderBy(F.col("k").desc()), "k", "sk")
    a = {r.k: r.sk for r in first.collect()}
    assert a == {r.k: r.sk for r in again.collect()}
    assert sorted(a.values()) == list(range(1, 5001))


def test_keep_first_drops_null_keys_and_breaks_ties(spark):
    rows = spark.createDataFrame([("a", 2, "p"), ("a", 1, "z"), ("a", 1, "q"), (None, 0, "x")], "k string, n int, t string")
    assert [tuple(r) for r in pick.smallest_per_key(rows, "k").collect()] == [("a", 1, "q")]


def test_main_payment_and_latest_review(spark):
    payments = spark.createDataFrame(
        [("o1", "1", " Voucher ", "1", "10.00"), ("o1", "2", "boleto", "1", "20.00"),
         ("o1", "3", "credit_card", "3", "20.00"), ("o2", "1", "boleto", "1", "1.00")],
        "order_id string, payment_sequential string, payment_type string,"
        " payment_installments string, payment_value string")
    got = {r.order_id: r for r in facts.payment_totals({"order_payments": payments}).collect()}
    assert (got["o1"].tipo_pagamento_original, got["o1"].num_parcelas) == ("boleto", 1)
    assert (got["o1"].valor_pago, got["o1"].qtd_pagamentos) == (D("50.00"), 3)
    reviews = spark.createDataFrame(
        [("r1", "o1", "5", "2018-01-01 00:00:00", "2018-01-02 00:00:00"),
         ("r2", "o1", "1", "2018-01-05 00:00:00", None),
         ("r3", "o1", None, "2018-02-01 00:00:00", "2018-02-02 00:00:00"),
         ("r4", "o2", None, "2018-02-01 00:00:00", "2018-02-02 00:00:00")],
        "review_id string, order_id string, review_score string, review_creation_date string,"
        " review_answer_timestamp string")
    got = [tuple(r) for r in facts.review_scores({"order_reviews": reviews}).collect()]
    assert got == [("o1", 5)]


def test_payment_labels(spark):
    rows = spark.createDataFrame(
        [("o", "1", t, n, "1.00") for t, n in (
            ("credit_card", "1"), ("boleto", "0"), ("debit_card", "3"), ("gift_card", "13"),
            ("not_defined", "6"), ("voucher", "12"))],
        "order_id string, payment_sequential string, payment_type string,"
        " payment_installments string, payment_value string")
    table = dims.keyed("dim_pagamento", dims.payments({"order_payments": rows}))
    got = {r.tipo_pagamento_original: (r.tipo_pagamento, r.faixa_parcelas) for r in table.collect()}
    assert got["credit_card"] == ("Cartão de crédito", "À vista")
    assert got["boleto"] == ("Boleto", "À vista")
    assert got["debit_card"] == ("Cartão de débito", "2 a 3 parcelas")
    assert got["gift_card"] == ("Gift Card", "Acima de 12 parcelas")
    assert got["nao_informado"] == ("Não informado", "Não informado")
    assert table.where("sk_pagamento = 0").count() == 1


def test_rollup_tells_null_groups_from_totals(spark):
    rows = spark.createDataFrame([(None, 1), ("a", 2)], "g string, x int")
    out = grouping.grouped_totals(rows, grouping.rollup_sets("g"), {"x": F.sum("x")})
    got = {(r.g, r.x) for r in out.select(grouping.labelled("g", "all").alias("g"), "x").collect()}
    assert got == {(None, 1), ("a", 2), ("all", 3)}
    assert grouping.rollup_sets("a", ("b", "c")) == [["a", "b", "c"], ["a"], []]
    assert len(grouping.cube_sets("a", "b", "c")) == 8
