"""The nine headline figures."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armazem.functions.numbers import count_where, percent, quotient
from armazem.plans.star import Star


def _rows(row: DataFrame, figures: dict[str, Column]) -> DataFrame:
    cells = [
        F.struct(F.lit(k).alias("kpi"), c.cast("decimal(28,2)").alias("valor"))
        for k, c in figures.items()
    ]
    return row.select(F.inline(F.array(*cells)))


def kpis(star: Star) -> DataFrame:
    """One row per figure, from one pass over sales, one over orders and one over customers."""
    sales = star.sales_totals(
        {"revenue": F.sum("valor_item"), "freight": F.sum("valor_frete"), "orders": F.count("*")},
        (),
    )
    score, lead = F.col("nota_avaliacao"), F.col("prazo_entrega_dias")
    orders = star.orders(
        "prazo_entrega_dias", "flag_entregue_com_atraso", "nota_avaliacao",
        "status.flag_cancelado",
    ).agg(
        F.count("*").alias("all"),
        F.sum(lead).alias("days"),
        F.count(lead).alias("delivered"),
        count_where(F.col("flag_entregue_com_atraso")).alias("late"),
        F.sum(score).alias("points"),
        F.count(score).alias("rated"),
        count_where(F.col("flag_cancelado")).alias("cancelled"),
    )
    people = star.dim("cliente", "flag_recorrente").agg(
        F.count("*").alias("all"), count_where(F.col("flag_recorrente")).alias("recurring")
    )
    c = F.col
    parts = [
        _rows(sales, {
            "faturamento": c("revenue"),
            "pedidos": c("orders"),
            "ticket_medio": quotient(c("revenue"), c("orders")),
            "participacao_frete_pct": percent(c("freight"), c("revenue") + c("freight")),
        }),
        _rows(orders, {
            "prazo_medio_dias": quotient(c("days"), c("delivered"), 1),
            "taxa_atraso_pct": percent(c("late"), c("delivered")),
            "nota_media": quotient(c("points"), c("rated")),
            "taxa_cancelamento_pct": percent(c("cancelled"), c("all")),
        }),
        _rows(people, {"clientes_recorrentes_pct": percent(c("recurring"), c("all"))}),
    ]
    return reduce(DataFrame.unionByName, parts)
