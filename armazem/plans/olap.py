"""The seventeen reports.

Revenue counts the items of orders that were not cancelled, without freight; an order
counts once wherever one of its items does. Reports grouped by attributes that an order
has only one of (date, place, payment) work on one row per order, so their order counts add
up and need no distinct count.
"""

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from armazem import vocabulary as v
from armazem.functions.numbers import band, count_where, percent, quotient, total
from armazem.operators.grouping import (
    added_up, cube_sets, grouped_totals, labelled, rollup_sets, total_flag,
)
from armazem.operators.ranking import asc, desc, ordered, share_of_all, top
from armazem.plans.star import Slices, Star

TOP = 10


def _revenue() -> dict[str, Column]:
    """Revenue and orders over rows of one order each."""
    return {"faturamento": F.sum("valor_item"), "pedidos": F.count("*")}


def _summed(rows: DataFrame, keys: Iterable[str], *names: str) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])


def sold_by(
    star: Star, *attributes: str, years: Iterable[int] = (), only: Slices | None = None
) -> DataFrame:
    """Revenue and orders of non-cancelled orders with items, partly summed by attributes;
    ``only`` names attributes and the values kept of them."""
    return star.sales_totals(_revenue(), attributes, years, only or {})


def _sales(ticket: bool = True) -> list[Column]:
    columns = [total(F.col("faturamento")).alias("faturamento"), F.col("pedidos")]
    if ticket:
        columns.append(quotient(F.col("faturamento"), F.col("pedidos")).alias("ticket_medio"))
    return columns


_REVENUE = ("faturamento", "pedidos")


def o01(star: Star) -> DataFrame:
    """Revenue, orders and mean ticket by year, quarter and month, with all totals."""
    rows = sold_by(
        star, "tempo.ano", "tempo.trimestre", "tempo.mes", "tempo.nome_mes", "tempo.ano_mes"
    )
    sets = rollup_sets("ano", "trimestre", ("mes", "nome_mes", "ano_mes"))
    year, quarter = F.col("ano").cast("string"), F.col("trimestre").cast("string")
    no_year, no_quarter, no_month = (
        F.col(total_flag(c)) == 1 for c in ("ano", "trimestre", "mes")
    )
    overall, by_year, by_quarter, by_month = v.LEVELS
    return (
        added_up(rows, sets, _REVENUE)
        .transform(ordered, asc("ano"), asc("trimestre"), asc("mes"))
        .select(
            F.when(no_year, v.GRAND_TOTAL)
            .when(no_quarter, F.concat(F.lit("Total "), year))
            .when(no_month, F.concat(F.lit("Total "), quarter, F.lit("T"), year))
            .otherwise(year)
            .alias("ano"),
            F.when(~no_quarter, F.concat(quarter, F.lit("T"))).alias("trimestre"),
            F.col("nome_mes").alias("mes"),
            F.when(no_year, overall)
            .when(no_quarter, by_year)
            .when(no_month, by_quarter)
            .otherwise(by_month)
            .alias("nivel"),
            "ano_mes",
            *_sales(),
        )
    )


def o02(star: Star) -> DataFrame:
    """Revenue by customer region and state, with the share of the grand total."""
    rows = sold_by(star, "geografia.regiao", "geografia.estado")
    grand = F.max(F.when(F.col(total_flag("regiao")) == 1, F.col("faturamento"))).over(W.partitionBy())
    return (
        added_up(rows, rollup_sets("regiao", "estado"), _REVENUE)
        .withColumn("participacao_pct", percent(F.col("faturamento"), grand))
        .transform(ordered, total_flag("regiao"), asc("regiao"), total_flag("estado"), desc("faturamento"), asc("estado"))
        .select(
            labelled("regiao", v.GRAND_TOTAL).alias("regiao"),
            labelled("estado", v.SUBTOTAL).alias("estado"),
            *_sales(),
            "participacao_pct",
        )
    )


def o03(star: Star, estado: str = "SP") -> DataFrame:
    """The ten cities of a state with most revenue and their share of the state."""
    rows = sold_by(
        star, "geografia.cidade", "geografia.estado", only={"geografia.estado": (estado,)}
    )
    cities = _summed(rows, ["cidade"], *_REVENUE)
    shared = cities.withColumn("participacao_no_estado_pct", share_of_all(F.col("faturamento")))
    best = top(shared, TOP, desc("faturamento"), asc("cidade"))
    return best.select("cidade", *_sales(), "participacao_no_estado_pct")


def o04(star: Star, ano: int = 2018) -> DataFrame:
    """The ten best-selling categories of a year and their share of the year."""
    rows = star.pair_sales("sk_produto", ("tempo.ano",), years=(ano,))
    products = star.dim("produto", "sk_produto", "categoria", "categoria_en")
    categories = (
        rows.where(F.col("ano") == ano)
        .join(products, "sk_produto")
        .groupBy("categoria", "categoria_en")
        .agg(
            F.sum("valor_item").alias("faturamento"),
            F.sum("itens").alias("itens_vendidos"),
            F.countDistinct("order_id").alias("pedidos"),
        )
        .withColumn("participacao_pct", share_of_all(F.col("faturamento")))
    )
    revenue, orders, ticket = _sales()
    return top(
        categories, TOP, desc("faturamento"), asc("categoria"), asc("categoria_en")
    ).select("categoria", "categoria_en", revenue, "itens_vendidos", orders, ticket,
             "participacao_pct")


def o05(
    star: Star,
    anos: Iterable[int] = (2017, 2018),
    regioes: Iterable[str] = ("Sul", "Sudeste"),
    tipos: Iterable[str] = ("Boleto", "Cartão de crédito"),
) -> DataFrame:
    """Mean ticket by year, region and payment type inside a dice of the cube."""
    anos = tuple(anos)
    slices = {
        "tempo.ano": anos, "geografia.regiao": tuple(regioes),
        "pagamento.tipo_pagamento": tuple(tipos),
    }
    rows = sold_by(star, *slices, years=anos, only=slices)
    keys = ("ano", "regiao", "tipo_pagamento")
    dice = _summed(rows, keys, *_REVENUE)
    return ordered(dice, *keys).select(*keys, *_sales())


def o06(star: Star, anos: Iterable[int] = (2016, 2017, 2018)) -> DataFrame:
    """Revenue by payment type in rows and year in columns, with total and share."""
    rows = sold_by(star, "tempo.ano", "pagamento.tipo_pagamento")
    by_year = [
        F.sum(F.when(F.col("ano") == ano, F.col("faturamento"))).alias(f"fat_{ano}")
        for ano in anos
    ]
    years = [
        total(F.coalesce(f"fat_{ano}", F.lit(0))).alias(f"fat_{ano}") for ano in anos
    ]
    return (
        rows.groupBy("tipo_pagamento")
        .agg(*by_year, F.sum("faturamento").alias("fat_total"))
        .select(
            "tipo_pagamento",
            *years,
            total(F.col("fat_total")).alias("fat_total"),
            share_of_all(F.col("fat_total")).alias("participacao_pct"),
        )
        .transform(ordered, desc("fat_total"), asc("tipo_pagamento"))
    )


def o07(star: Star) -> DataFrame:
    """The ten sellers with most revenue: rank, share and cumulative share.

    There may be very many sellers, so nothing but the leaders goes through one task. The
    grand total travels as one more row that ranks before all sellers, which saves a second
    pass over the facts; a cumulative sum only needs the rows ranked above or tied.
    """
    sellers = (
        star.pair_sales("sk_vendedor", ())
        .groupBy("sk_vendedor")
        .agg(
            F.sum("valor_item").alias("faturamento"),
            F.count("*").alias("pedidos"),
            F.sum("itens").alias("itens"),
        )
    )
    is_total = F.col(total_flag("sk_vendedor")) == 1
    by_revenue = W.orderBy(F.col(total_flag("sk_vendedor")).desc(), desc("faturamento"))
    revenue_of_seller = F.when(~is_total, F.col("faturamento"))
    leaders = (
        added_up(sellers, rollup_sets("sk_vendedor"), ("faturamento", "pedidos", "itens"))
        .withColumn("place", F.rank().over(by_revenue))
        .where(F.col("place") <= TOP + 1)
        .withColumn("all", F.max(F.when(is_total, F.col("faturamento"))).over(W.partitionBy()))
        .withColumn("acumulado", F.sum(revenue_of_seller).over(by_revenue))
        .where(~is_total)
        .withColumn("posicao", F.col("place") - 1)
        .join(star.dim("vendedor", "sk_vendedor", "seller_id", "cidade", "estado"), "sk_vendedor")
    )
    revenue, orders, ticket = _sales()
    return top(leaders, TOP, desc("faturamento"), asc("seller_id")).select(
        "posicao", "seller_id", "cidade", "estado", revenue, orders, "itens", ticket,
        percent(F.col("faturamento"), F.col("all")).alias("participacao_pct"),
        percent(F.col("acumulado"), F.col("all")).alias("participacao_acumulada_pct"),
    )


def o08(star: Star) -> DataFrame:
    """Mean lead, estimate and deviation in days and late share by region and state."""
    lead = F.col("prazo_entrega_dias")
    delivered = lead.isNotNull()
    measures = {
        "pedidos_entregues": count_where(delivered),
        "lead": F.sum(lead),
        "estimate": F.sum(F.when(delivered, F.col("prazo_estimado_dias"))),
        "deviation": F.sum("atraso_entrega_dias"),
        "late": count_where(F.col("flag_entregue_com_atraso")),
    }
    rows = star.order_totals(
        measures,
        ("geografia.regiao", "geografia.estado"),
        ("prazo_entrega_dias", "prazo_estimado_dias", "atraso_entrega_dias",
         "flag_entregue_com_atraso"),
    ).where(F.col("pedidos_entregues") > 0)
    n = F.col("pedidos_entregues")
    return (
        added_up(rows, rollup_sets("regiao", "estado"), measures)
        .withColumn("prazo_medio_dias", quotient(F.col("lead"), n, 1))
        .transform(
            ordered, total_flag("regiao"), asc("regiao"), total_flag("estado"), desc("prazo_medio_dias"),
            asc("estado"),
        )
        .select(
            labelled("regiao", v.GRAND_TOTAL).alias("regiao"),
            labelled("estado", v.SUBTOTAL).alias("estado"),
            "pedidos_entregues",
            "prazo_medio_dias",
            quotient(F.col("estimate"), n, 1).alias("prazo_estimado_medio_dias"),
            quotient(F.col("deviation"), n, 1).alias("desvio_medio_vs_estimado_dias"),
            percent(F.col("late"), n).alias("taxa_atraso_pct"),
        )
    )


def o09(star: Star, min_pedidos: int = 200) -> DataFrame:
    """The ten sellers with the highest late share among those with enough deliveries."""
    deliveries = star.pair_sales(
        "sk_vendedor", ("prazo_entrega_dias", "atraso_entrega_dias"), sold=False
    ).where(F.col("prazo_entrega_dias").isNotNull())
    n = F.col("pedidos_entregues")
    rated = (
        deliveries.groupBy("sk_vendedor")
        .agg(
            F.count("*").alias("pedidos_entregues"),
            F.sum("prazo_entrega_dias").alias("lead"),
            count_where(F.col("atraso_entrega_dias") > 0).alias("late"),
        )
        .where(n >= min_pedidos)
        .join(star.dim("vendedor", "sk_vendedor", "seller_id", "cidade", "estado"), "sk_vendedor")
        .select(
            "seller_id", "cidade", "estado", "pedidos_entregues",
            quotient(F.col("lead"), n, 1).alias("prazo_medio_dias"),
            percent(F.col("late"), n).alias("taxa_atraso_pct"),
        )
    )
    return top(rated, TOP, desc("taxa_atraso_pct"), desc("pedidos_entregues"), asc("seller_id"))


def o10(star: Star, min_itens: int = 500) -> DataFrame:
    """The ten categories where freight weighs most, among those with enough items."""
    per_product = (
        star.sold_items("sk_produto", "valor_item", "valor_frete", "valor_total_item")
        .groupBy("sk_produto")
        .agg(
            F.count("*").alias("itens"),
            *[F.sum(c).alias(c) for c in ("valor_item", "valor_frete", "valor_total_item")],
        )
    )
    categories = (
        per_product.join(star.dim("produto", "sk_produto", "categoria"), "sk_produto")
        .groupBy("categoria")
        .agg(*[F.sum(c).alias(c)
               for c in ("itens", "valor_item", "valor_frete", "valor_total_item")])
        .where(F.col("itens") >= min_itens)
        .select(
            "categoria",
            "itens",
            total(F.col("valor_item")).alias("valor_itens"),
            total(F.col("valor_frete")).alias("valor_frete"),
            percent(F.col("valor_frete"), F.col("valor_total_item")).alias("participacao_frete_pct"),
            quotient(F.col("valor_frete"), F.col("itens")).alias("frete_medio_por_item"),
        )
    )
    return top(categories, TOP, desc("participacao_frete_pct"), asc("categoria"))


def o11(star: Star) -> DataFrame:
    """Rating by delivery band."""
    delay = F.col("atraso_entrega_dias")
    situation = (
        F.when(F.col("prazo_entrega_dias").isNull(), v.DELIVERY_MISSING)
        .when(delay < 0, v.DELIVERY_EARLY)
        .when(delay == 0, v.DELIVERY_ON_TIME)
        .otherwise(band(delay, v.DELIVERY_LATE_BANDS, v.DELIVERY_LATE_ABOVE))
    )
    score, rated = F.col("nota_avaliacao"), F.col("pedidos_avaliados")
    return (
        star.orders("prazo_entrega_dias", "atraso_entrega_dias", "nota_avaliacao")
        .groupBy(situation.alias("situacao_entrega"))
        .agg(
            F.count("*").alias("pedidos"),
            F.count(score).alias("pedidos_avaliados"),
            F.sum(score).alias("points"),
            count_where(score <= 2).alias("low"),
            count_where(score == 5).alias("five"),
        )
        .select(
            "situacao_entrega", "pedidos", "pedidos_avaliados",
            quotient(F.col("points"), rated).alias("nota_media"),
            percent(F.col("low"), rated).alias("pct_notas_1_e_2"),
            percent(F.col("five"), rated).alias("pct_nota_5"),
        )
        .transform(ordered, "situacao_entrega")
    )


def o12(star: Star, min_avaliacoes: int = 300, k: int = 5) -> DataFrame:
    """The k best and k worst rated categories; ties may add rows."""
    score, items, n = F.col("nota_avaliacao"), F.col("itens"), F.col("avaliacoes")
    categories = (
        star.rated_items("sk_produto")
        .join(star.dim("produto", "sk_produto", "categoria"), "sk_produto")
        .groupBy("categoria")
        .agg(
            F.sum(items).alias("avaliacoes"),
            F.sum(items * score).alias("points"),
            F.sum(F.when(score <= 2, items).otherwise(0)).alias("low"),
        )
        .where(n >= min_avaliacoes)
        .select(
            "categoria", "avaliacoes",
            quotient(F.col("points"), n).alias("nota_media"),
            percent(F.col("low"), n).alias("pct_notas_1_e_2"),
        )
    )
    from_top = F.rank().over(W.orderBy(desc("nota_media"), desc("avaliacoes")))
    from_bottom = F.rank().over(W.orderBy(asc("nota_media"), desc("avaliacoes")))
    return (
        categories.withColumn("best", from_top)
        .withColumn("worst", from_bottom)
        .where((F.col("best") <= k) | (F.col("worst") <= k))
        .transform(ordered, desc("nota_media"), desc("avaliacoes"), asc("categoria"))
        .select(
            F.when(F.col("best") <= k, v.BEST).otherwise(v.WORST).alias("grupo"),
            "categoria", "avaliacoes", "nota_media", "pct_notas_1_e_2",
        )
    )


def o13(star: Star) -> DataFrame:
    """Recurring customers by region, with the total."""
    rows = star.dim("cliente", "regiao", "qtd_pedidos", "flag_recorrente")
    measures = {
        "clientes": F.count("*"),
        "clientes_recorrentes": count_where(F.col("flag_recorrente")),
        "orders": F.sum("qtd_pedidos"),
    }
    n = F.col("clientes")
    return (
        grouped_totals(rows, rollup_sets("regiao"), measures)
        .withColumn("pct_recorrentes", percent(F.col("clientes_recorrentes"), n))
        .transform(ordered, total_flag("regiao"), desc("pct_recorrentes"), asc("regiao"))
        .select(
            labelled("regiao", v.GRAND_TOTAL).alias("regiao"),
            "clientes", "clientes_recorrentes", "pct_recorrentes",
            quotient(F.col("orders"), n, 3).alias("pedidos_por_cliente"),
        )
    )


def o14(star: Star) -> DataFrame:
    """Cancellation rate by month; months without orders do not appear."""
    rows = star.order_totals(
        {"n": F.count("*")},
        ("tempo.ano_mes", "status.flag_cancelado", "status.status_original"),
    )

    def orders(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    return (
        rows.groupBy("ano_mes")
        .agg(
            F.sum("n").alias("pedidos"),
            orders(F.col("flag_cancelado")).alias("pedidos_cancelados"),
            orders(F.col("status_original") == "unavailable").alias("pedidos_indisponiveis"),
        )
        .select(
            "ano_mes", "pedidos", "pedidos_cancelados",
            percent(F.col("pedidos_cancelados"), F.col("pedidos")).alias("taxa_cancelamento_pct"),
            "pedidos_indisponiveis",
        )
        .transform(ordered, "ano_mes")
    )


def o15(star: Star) -> DataFrame:
    """Revenue by customer region and payment type with every subtotal."""
    rows = sold_by(star, "geografia.regiao", "pagamento.tipo_pagamento")
    return (
        added_up(rows, cube_sets("regiao", "tipo_pagamento"), _REVENUE)
        .transform(
            ordered, total_flag("regiao"), asc("regiao"), total_flag("tipo_pagamento"), desc("faturamento"),
            asc("tipo_pagamento"),
        )
        .select(
            labelled("regiao", v.ALL_REGIONS).alias("regiao"),
            labelled("tipo_pagamento", v.ALL_PAYMENTS).alias("tipo_pagamento"),
            *_sales(ticket=False),
        )
    )


def region_column(regiao: str) -> str:
    return "para_" + re.sub(r"[^a-z0-9]+", "_", regiao.lower())


def o16(star: Star, regioes: Iterable[str] = v.REGIONS) -> DataFrame:
    """Mean lead by seller region in rows and customer region in columns.

    An order counts once per seller region it was served from.
    """
    regioes = tuple(regioes)
    lead = F.col("prazo_entrega_dias")
    sellers = star.dim("vendedor", "sk_vendedor", F.col("regiao").alias("regiao_vendedor"))
    rows = (
        star.pair_sales("sk_vendedor", ("prazo_entrega_dias", "geografia.regiao"), sold=False)
        .where(lead.isNotNull())
        .join(sellers, "sk_vendedor")
        .select("order_id", "regiao_vendedor", F.col("regiao").alias("regiao_cliente"), lead)
        .distinct()
    )
    measures = {"pedidos_entregues": F.count("*"), "days": F.sum(lead)}
    for regiao in regioes:
        here = F.col("regiao_cliente") == regiao
        measures[f"n_{region_column(regiao)}"] = count_where(here)
        measures[f"days_{region_column(regiao)}"] = F.sum(F.when(here, lead))
    return (
        grouped_totals(rows, rollup_sets("regiao_vendedor"), measures)
        .transform(
            ordered, total_flag("regiao_vendedor"), desc("pedidos_entregues"), asc("regiao_vendedor")
        )
        .select(
            labelled("regiao_vendedor", v.ALL_REGIONS).alias("regiao_vendedor"),
            "pedidos_entregues",
            *[
                quotient(F.col(f"days_{c}"), F.col(f"n_{c}"), 1).alias(c)
                for c in map(region_column, regioes)
            ],
            quotient(F.col("days"), F.col("pedidos_entregues"), 1).alias("prazo_medio_geral"),
        )
    )


def o17(star: Star) -> DataFrame:
    """Sellers per state with their share of sellers and of revenue.

    Orders are counted per seller and then added up, so an order of two sellers counts twice.
    """
    sales = (
        star.pair_sales("sk_vendedor", ())
        .groupBy("sk_vendedor")
        .agg(F.sum("valor_item").alias("valor"), F.count("*").alias("orders"))
    )
    sellers = star.dim("vendedor", "sk_vendedor", "estado", "regiao")
    states = (
        sellers.join(sales, "sk_vendedor", "left")
        .groupBy("estado", "regiao")
        .agg(
            F.count("*").alias("vendedores"),
            F.coalesce(F.sum("valor"), F.lit(0)).alias("revenue"),
            F.coalesce(F.sum("orders"), F.lit(0)).alias("pedidos"),
        )
    )
    return states.select(
        "estado", "regiao", "vendedores",
        share_of_all(F.col("vendedores")).alias("pct_vendedores"),
        total(F.col("revenue")).alias("faturamento"),
        share_of_all(F.col("revenue")).alias("pct_faturamento"),
        "pedidos",
    ).transform(ordered, desc("vendedores"), desc("faturamento"), asc("estado"))


# code -> (report, title used for exported files)
REPORTS = {
    "O01": (o01, "rollup_calendar"),
    "O02": (o02, "region_state"),
    "O03": (o03, "top_cities"),
    "O04": (o04, "top_categories"),
    "O05": (o05, "dice_ticket"),
    "O06": (o06, "payment_by_year"),
    "O07": (o07, "top_sellers"),
    "O08": (o08, "delivery_by_state"),
    "O09": (o09, "late_sellers"),
    "O10": (o10, "freight_share"),
    "O11": (o11, "rating_by_delivery"),
    "O12": (o12, "category_ratings"),
    "O13": (o13, "recurring_customers"),
    "O14": (o14, "cancellation_by_month"),
    "O15": (o15, "region_payment_cube"),
    "O16": (o16, "lead_matrix"),
    "O17": (o17, "sellers_by_state"),
}
