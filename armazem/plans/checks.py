"""Validations of a load: volumes, row counts, reconciliation, coverage and constraints."""

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armazem import vocabulary as v
from armazem.functions import numbers, text
from armazem.functions.numbers import count_where, percent
from armazem.plans.dims import DENSE_KEYS, Tables
from armazem.sources.literals import literal_rows
from armazem.sources.sinks import row_counts

_DIM_KEYS = {
    "dim_tempo": "sk_tempo", "dim_pagamento": "sk_pagamento", "dim_status": "sk_status",
} | {name: key for name, (_, key) in DENSE_KEYS.items()}


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _verdict(passed: Column) -> Column:
    """A comparison with a missing side is a failure."""
    return F.when(passed, v.OK).otherwise(v.FAILED)


def volumes(audit: DataFrame, expected: Iterable[tuple[str, int]]) -> DataFrame:
    """Loaded rows of each raw table against the expected volume."""
    wanted = literal_rows(audit.sparkSession, expected, "tabela string, esperado bigint")
    loaded = audit.select(
        "id_carga",
        F.col("tabela_destino").alias("tabela"),
        F.col("registros_carregados").alias("carregados"),
    )
    return (
        loaded.join(wanted, "tabela")
        .orderBy("id_carga")
        .select(
            "tabela", "carregados", "esperado",
            _verdict(F.col("carregados") == F.col("esperado")).alias("situacao"),
        )
    )


def table_counts(warehouse: Tables) -> DataFrame:
    names = (
        "dim_tempo", "dim_cliente", "dim_produto", "dim_vendedor", "dim_geografia",
        "dim_pagamento", "dim_status", "fato_pedido", "fato_vendas",
    )
    return row_counts({n: warehouse[n] for n in names}).orderBy("ordem").drop("ordem")


# --- reconciliation --------------------------------------------------------------------------

EXPECTED, OBTAINED = "esperado", "obtido"
ZERO_EXPECTED = range(7, 25)


def _figures(rows: DataFrame, figures: Mapping[tuple[int, str], Column]) -> DataFrame:
    """One aggregation pass over a table, giving one row per (check, side)."""
    row = rows.agg(*[c.alias(f"{side}_{n}") for (n, side), c in figures.items()])
    cells = [
        F.struct(
            F.lit(n).alias("ordem"),
            F.lit(side).alias("lado"),
            F.col(f"{side}_{n}").cast("string").alias("valor"),
        )
        for n, side in figures
    ]
    return row.select(F.inline(F.array(*cells)))


def _amount(c: Column) -> Column:
    return F.sum(c).cast("decimal(28,2)")


def orphans(fact: DataFrame, key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Number of fact rows whose key is not in the dimension.

    The fact is counted per key before the shuffle, so the anti-join sees each key once and
    a key shared by a large part of the rows is one row.
    """
    per_key = fact.groupBy(key).agg(F.count("*").alias("n"))
    lost = per_key.join(
        dim.select(F.col(dim_key).alias("known")), F.col(key) == F.col("known"), "left_anti"
    )
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def _date_orphans(orders: DataFrame, calendar: DataFrame) -> DataFrame:
    """Orders whose purchase date or due date is not in the calendar."""
    pairs = orders.groupBy("sk_tempo_compra", "sk_tempo_estimada").agg(F.count("*").alias("n"))
    bought = calendar.select(F.col("sk_tempo").alias("bought"))
    due = calendar.select(F.col("sk_tempo").alias("due"))
    roles = pairs.join(bought, F.col("sk_tempo_compra") == F.col("bought"), "left").join(
        due, F.col("sk_tempo_estimada") == F.col("due"), "left"
    )
    lost = roles.where(F.col("bought").isNull() | F.col("due").isNull())
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def _both_facts(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders beside the sums of their items: the one shuffle of items by order that every
    check on the two facts shares."""
    value = F.col("valor_item")
    per_order = items.groupBy("order_id").agg(
        F.count("*").alias("items"),
        F.sum(value).alias("items_value"),
        F.sum("valor_frete").alias("items_freight"),
        count_where(value.isNull() | (value < 0)).alias("bad_items"),
    )
    measures = orders.select(
        F.col("order_id").alias("known"), "valor_itens", "valor_pago", "prazo_entrega_dias",
        "nota_avaliacao", "sk_tempo_entrega",
    )
    return measures.join(per_order, F.col("known") == F.col("order_id"), "full")


def _small_orphans(items: DataFrame, warehouse: Tables, names: Iterable[str]) -> DataFrame:
    """Item rows without a row in dimensions of a bounded number of rows, from one scan: items are
    counted per combination of those keys first."""
    keys = [_DIM_KEYS[n] for n in names]
    rows = items.groupBy(*keys).agg(F.count("*").alias("n"))
    for name, key in zip(names, keys):
        known = warehouse[name].select(F.col(key).alias(f"known_{key}"))
        rows = rows.join(known, F.col(key) == F.col(f"known_{key}"), "left")
    return rows.agg(*[
        F.coalesce(F.sum(F.when(F.col(f"known_{key}").isNull(), F.col("n"))), F.lit(0)).alias(name)
        for name, key in zip(names, keys)
    ])


def reconciliation(stg: Tables, warehouse: Tables) -> DataFrame:
    """The 26 checks. Every table is read once for its totals; keys of large dimensions are
    checked separately on single columns."""
    items, orders = warehouse["fato_vendas"], warehouse["fato_pedido"]
    lead, score = F.col("prazo_entrega_dias"), F.col("nota_avaliacao")
    no_category = text.blank_to_null(F.col("product_category_name")).isNull()
    n = F.count("*")
    parts = [
        _figures(stg["order_items"], {
            (1, EXPECTED): n,
            (3, EXPECTED): _amount(numbers.money(F.col("price"))),
            (4, EXPECTED): _amount(numbers.money(F.col("freight_value"))),
            (6, EXPECTED): F.countDistinct("order_id"),
        }),
        _figures(stg["orders"], {(2, EXPECTED): n}),
        _figures(stg["order_payments"], {
            (5, EXPECTED): _amount(numbers.money(F.col("payment_value"))),
        }),
        _figures(_both_facts(orders, items), {
            (1, OBTAINED): F.coalesce(F.sum("items"), F.lit(0)),
            (2, OBTAINED): F.count("known"),
            (3, OBTAINED): _amount(F.col("items_value")),
            (4, OBTAINED): _amount(F.col("items_freight")),
            (5, OBTAINED): _amount(F.col("valor_pago")),
            (6, OBTAINED): F.count("order_id"),
            (7, OBTAINED): count_where(F.col("items_value") != F.col("valor_itens")),
            (21, OBTAINED): F.coalesce(F.sum("bad_items"), F.lit(0)),
            (22, OBTAINED): count_where(lead < 0),
            (23, OBTAINED): count_where(~score.between(1, 5)),
            (24, OBTAINED): count_where(F.col("sk_tempo_entrega").isNull() & lead.isNotNull()),
        }),
        _figures(stg["products"], {(25, EXPECTED): count_where(no_category)}),
        _figures(warehouse["dim_produto"], {
            (25, OBTAINED): count_where(F.col("categoria") == v.NOT_INFORMED),
        }),
        _figures(warehouse["dim_geografia"], {
            (26, EXPECTED): count_where(F.col("origem") == v.ORIGIN_TRANSACTIONS),
            (26, OBTAINED): count_where(F.col("latitude_media").isNull()),
        }),
        _figures(_date_orphans(orders, warehouse["dim_tempo"]), {(15, OBTAINED): F.sum("n")}),
    ]
    referenced = (
        "dim_tempo", "dim_cliente", "dim_produto", "dim_vendedor", "dim_geografia",
        "dim_pagamento", "dim_status",
    )
    small = ("dim_tempo", "dim_pagamento", "dim_status")
    parts.append(_figures(_small_orphans(items, warehouse, small), {
        (8 + referenced.index(name), OBTAINED): F.max(name) for name in small
    }))
    for check, name in enumerate(referenced, 8):
        if name in small:
            continue
        key = _DIM_KEYS[name]
        lost = orphans(items, key, warehouse[name], key)
        parts.append(_figures(lost, {(check, OBTAINED): F.sum("n")}))
    unique = (
        ("dim_produto", "product_id"), ("dim_vendedor", "seller_id"),
        ("dim_cliente", "customer_unique_id"), ("dim_geografia", "cep_prefixo"),
        ("dim_tempo", "data"),
    )
    for check, (name, key) in enumerate(unique, 16):
        parts.append(_figures(warehouse[name], {(check, OBTAINED): n - F.countDistinct(key)}))

    def side(name: str) -> Column:
        return F.max(F.when(F.col("lado") == name, F.col("valor")))

    titles = literal_rows(
        items.sparkSession,
        [(k, t, "0" if k in ZERO_EXPECTED else None) for k, t in v.CHECK_TITLES.items()],
        "ordem int, verificacao string, zero string",
    )
    sides = _union(parts).groupBy("ordem").agg(
        side(EXPECTED).alias("found"), side(OBTAINED).alias("obtido")
    )
    return (
        sides.join(titles, "ordem")
        .withColumn("esperado", F.coalesce("zero", "found"))
        .orderBy("ordem")
        .select(
            "ordem", "verificacao", "esperado", "obtido",
            _verdict(F.col("esperado") == F.col("obtido")).alias("situacao"),
        )
    )


# --- coverage ----------------------------------------------------------------------------------


def coverage(warehouse: Tables) -> DataFrame:
    """How many orders each measure can see, as a count and a share."""
    located = warehouse["dim_geografia"].select("sk_geografia", "latitude_media")
    rows = warehouse["fato_pedido"].join(located, "sk_geografia")
    seen = (
        F.col("qtd_itens") > 0,
        F.col("sk_pagamento") != 0,
        F.col("nota_avaliacao").isNotNull(),
        F.col("prazo_entrega_dias").isNotNull(),
        F.col("latitude_media").isNotNull(),
    )
    row = rows.agg(
        F.count("*").alias("all"), *[count_where(c).alias(f"c{i}") for i, c in enumerate(seen)]
    )
    cells = [
        F.struct(
            F.lit(i).alias("ordem"), F.lit(title).alias("cobertura"), F.col(f"c{i}").alias("pedidos")
        )
        for i, title in enumerate(v.COVERAGE_TITLES)
    ]
    return (
        row.select("all", F.inline(F.array(*cells)))
        .orderBy("ordem")
        .select("cobertura", "pedidos", percent(F.col("pedidos"), F.col("all")).alias("percentual"))
    )


# --- constraints -----------------------------------------------------------------------------------

# The declared keys and mandatory columns of the model.
UNIQUE_KEYS = (
    ("fato_vendas", ("order_id", "order_item_id")),
    ("fato_pedido", ("order_id",)),
    ("dim_tempo", ("sk_tempo",)),
    ("dim_tempo", ("data",)),
    ("dim_cliente", ("sk_cliente",)),
    ("dim_cliente", ("customer_unique_id",)),
    ("dim_produto", ("sk_produto",)),
    ("dim_produto", ("product_id",)),
    ("dim_vendedor", ("sk_vendedor",)),
    ("dim_vendedor", ("seller_id",)),
    ("dim_geografia", ("sk_geografia",)),
    ("dim_geografia", ("cep_prefixo",)),
    ("dim_pagamento", ("sk_pagamento",)),
    ("dim_pagamento", ("tipo_pagamento_original", "num_parcelas")),
    ("dim_status", ("sk_status",)),
    ("dim_status", ("status_original",)),
)
MANDATORY = {
    "fato_vendas": (
        "sk_tempo", "sk_cliente", "sk_produto", "sk_vendedor", "sk_geografia", "sk_pagamento",
        "sk_status", "order_id", "order_item_id", "valor_item", "valor_frete", "valor_total_item",
    ),
    "fato_pedido": (
        "order_id", "sk_tempo_compra", "sk_tempo_estimada", "sk_cliente", "sk_geografia",
        "sk_pagamento", "sk_status", "qtd_itens", "qtd_produtos_distintos", "qtd_vendedores",
        "valor_itens", "valor_frete", "valor_total", "qtd_pagamentos", "prazo_estimado_dias",
    ),
    "dim_cliente": ("sk_cliente", "customer_unique_id", "qtd_pedidos", "flag_recorrente"),
    "dim_produto": ("sk_produto", "product_id", "categoria_original", "categoria", "categoria_en",
                    "faixa_peso"),
    "dim_vendedor": ("sk_vendedor", "seller_id"),
    "dim_geografia": ("sk_geografia", "cep_prefixo", "qtd_registros_origem", "origem"),
    "dim_pagamento": ("sk_pagamento", "tipo_pagamento_original", "tipo_pagamento", "num_parcelas",
                      "faixa_parcelas"),
    "dim_status": ("sk_status", "status_original", "status_descricao", "flag_entregue",
                   "flag_cancelado", "ordem_ciclo"),
}
ORDER_REFERENCES = (
    ("sk_tempo_aprovacao", "dim_tempo"),
    ("sk_tempo_entrega", "dim_tempo"),
    ("sk_cliente", "dim_cliente"),
    ("sk_geografia", "dim_geografia"),
    ("sk_pagamento", "dim_pagamento"),
    ("sk_status", "dim_status"),
)


def _repeated(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    per_key = rows.groupBy(*key).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violacoes"))


def _missing(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    any_missing = reduce(Column.__or__, [F.col(c).isNull() for c in columns])
    return rows.agg(count_where(any_missing).alias("violacoes"))


def constraints(warehouse: Tables) -> DataFrame:
    """Rows that break a declared key, mandatory column or reference of the model."""
    parts = [
        (f"unique {name} ({', '.join(key)})", _repeated(warehouse[name], key))
        for name, key in UNIQUE_KEYS
    ]
    parts += [
        (f"not null {name}", _missing(warehouse[name], columns))
        for name, columns in MANDATORY.items()
    ]
    orders = warehouse["fato_pedido"]
    for key, name in ORDER_REFERENCES:
        lost = orphans(orders.where(F.col(key).isNotNull()), key, warehouse[name], _DIM_KEYS[name])
        parts.append((f"foreign key fato_pedido ({key})", lost.withColumnRenamed("n", "violacoes")))
    named = [
        rows.select(F.lit(title).alias("restricao"), F.col("violacoes").cast("bigint").alias("violacoes"))
        for title, rows in parts
    ]
    return _union(named).select(
        "restricao", "violacoes", _verdict(F.col("violacoes") == 0).alias("situacao")
    )


# --- gate ---------------------------------------------------------------------------------------------


def gate(reports: Iterable[DataFrame]) -> DataFrame:
    """Number of failed rows over all reports that carry a verdict, and the exit code."""
    verdicts = _union(r.select("situacao") for r in reports if "situacao" in r.columns)
    return verdicts.agg(count_where(F.col("situacao") == v.FAILED).alias("falhas")).select(
        "falhas", F.when(F.col("falhas") > 0, 1).otherwise(0).alias("codigo_saida")
    )


def all_validations(
    stg: Tables, warehouse: Tables, audit: DataFrame, expected: Iterable[tuple[str, int]]
) -> dict[str, DataFrame]:
    return {
        "V01": volumes(audit, expected),
        "V02": table_counts(warehouse),
        "V03": reconciliation(stg, warehouse),
        "V04": coverage(warehouse),
        "V06": constraints(warehouse),
    }


def failures(validations: Mapping[str, DataFrame]) -> int:
    return gate(validations.values()).first()["falhas"]
