"""Plot-ready shapes of the reports: short results in, short results out."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from armazem import vocabulary as v
from armazem.operators.ranking import asc, desc
from armazem.plans.olap import region_column

MIN_ORDERS_PER_MONTH = 100  # default of the feeds by month


def _peak(measure: str, position: str) -> Column:
    """True on the first row with the largest value."""
    best = F.row_number().over(W.orderBy(desc(measure), asc(position)))
    return (best == 1).alias("pico")


def monthly_revenue(o01: DataFrame, min_pedidos: int = MIN_ORDERS_PER_MONTH) -> DataFrame:
    months = o01.where((F.col("nivel") == v.LEVELS[-1]) & (F.col("pedidos") >= min_pedidos))
    return months.select(
        "ano_mes", "faturamento", "pedidos", _peak("faturamento", "ano_mes")
    ).orderBy("ano_mes")


def state_revenue(o02: DataFrame) -> DataFrame:
    states = o02.where(F.col("estado") != v.SUBTOTAL)
    return states.select("estado", "faturamento").orderBy(desc("faturamento"), asc("estado"))


def category_revenue(o04: DataFrame) -> DataFrame:
    return o04.select("categoria", "faturamento").orderBy(desc("faturamento"), asc("categoria"))


def stacked_payments(o06: DataFrame, anos: Sequence[int] = (2016, 2017, 2018)) -> DataFrame:
    """One row per year and payment type with the height it stacks on and the year's total."""
    bars = o06.where(F.col("tipo_pagamento") != v.NOT_INFORMED).unpivot(
        ["tipo_pagamento", "fat_total"], [f"fat_{a}" for a in anos], "coluna", "valor"
    )
    year = W.partitionBy("coluna")
    below = year.orderBy(desc("fat_total"), asc("tipo_pagamento")).rowsBetween(
        W.unboundedPreceding, -1
    )
    return bars.select(
        F.substring("coluna", 5, 4).cast("int").alias("ano"),
        "tipo_pagamento",
        "valor",
        F.coalesce(F.sum("valor").over(below), F.lit(0)).cast("decimal(28,2)").alias("base"),
        F.sum("valor").over(year).cast("decimal(28,2)").alias("total_ano"),
    ).orderBy("ano", "base")


def seller_labels(o07: DataFrame) -> DataFrame:
    label = F.concat(
        F.substring(F.col("seller_id").cast("string"), 1, 8), F.lit("  ("), F.col("cidade"),
        F.lit("/"), F.col("estado"), F.lit(")"),
    )
    return o07.select("posicao", label.alias("rotulo"), "faturamento").orderBy(
        desc("faturamento"), asc("rotulo")
    )


def regional_delivery(o08: DataFrame) -> DataFrame:
    regions = o08.where((F.col("estado") == v.SUBTOTAL) & (F.col("regiao") != v.GRAND_TOTAL))
    return regions.select("regiao", "prazo_medio_dias", "taxa_atraso_pct").orderBy(
        desc("prazo_medio_dias"), asc("regiao")
    )


def delivery_ratings(o11: DataFrame) -> DataFrame:
    plain = F.regexp_replace("situacao_entrega", r"^\d+\. ", "")
    return o11.orderBy("situacao_entrega").select(
        plain.alias("rotulo"), "pedidos", "nota_media"
    )


def rated_categories(o12: DataFrame) -> DataFrame:
    """Position from the top of the chart, within the common scale and within the group."""
    order = (desc("nota_media"), desc("avaliacoes"), asc("categoria"))
    return o12.select(
        "grupo", "categoria", "nota_media",
        F.row_number().over(W.orderBy(*order)).alias("linha"),
        F.row_number().over(W.partitionBy("grupo").orderBy(*order)).alias("linha_no_grupo"),
    )


def recurring_by_region(o13: DataFrame) -> DataFrame:
    """Regions with the overall percentage beside them as the reference line."""
    overall = F.max(F.when(F.col("regiao") == v.GRAND_TOTAL, F.col("pct_recorrentes")))
    return (
        o13.withColumn("referencia_pct", overall.over(W.partitionBy()))
        .where(F.col("regiao") != v.GRAND_TOTAL)
        .select("regiao", "pct_recorrentes", "referencia_pct")
        .orderBy(desc("pct_recorrentes"), asc("regiao"))
    )


def monthly_cancellation(o14: DataFrame, min_pedidos: int = MIN_ORDERS_PER_MONTH) -> DataFrame:
    months = o14.where(F.col("pedidos") >= min_pedidos)
    return months.select(
        "ano_mes", "taxa_cancelamento_pct", _peak("taxa_cancelamento_pct", "ano_mes")
    ).orderBy("ano_mes")


def lead_cells(o16: DataFrame, regioes: Sequence[str] = v.REGIONS) -> DataFrame:
    """One row per cell of the matrix, under the names of the regions; empty cells stay and are
    labelled."""
    named = o16.where(F.col("regiao_vendedor") != v.ALL_REGIONS).select(
        "regiao_vendedor", *[F.col(region_column(r)).alias(r) for r in regioes]
    )
    cells = named.unpivot(["regiao_vendedor"], list(regioes), "destino", "prazo_dias")
    return cells.select(
        "regiao_vendedor", "destino", "prazo_dias",
        F.coalesce(F.col("prazo_dias").cast("string"), F.lit("n/d")).alias("rotulo"),
        (F.col("prazo_dias") == F.max("prazo_dias").over(W.partitionBy())).alias("maior"),
    )


def leading_states(o17: DataFrame, n: int = 10) -> DataFrame:
    label = F.concat(F.col("estado"), F.lit(" ("), F.col("regiao"), F.lit(")"))
    return (
        o17.orderBy(desc("vendedores"), desc("faturamento"), asc("estado"))
        .limit(n)
        .select(label.alias("rotulo"), "vendedores")
    )


# code of the report -> (shape, title)
FEEDS = {
    "O01": (monthly_revenue, "monthly_revenue"),
    "O02": (state_revenue, "state_revenue"),
    "O04": (category_revenue, "category_revenue"),
    "O06": (stacked_payments, "stacked_payments"),
    "O07": (seller_labels, "seller_labels"),
    "O08": (regional_delivery, "regional_delivery"),
    "O11": (delivery_ratings, "delivery_ratings"),
    "O12": (rated_categories, "rated_categories"),
    "O13": (recurring_by_region, "recurring_by_region"),
    "O14": (monthly_cancellation, "monthly_cancellation"),
    "O16": (lead_cells, "lead_cells"),
    "O17": (leading_states, "leading_states"),
}
