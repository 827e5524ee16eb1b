"""The order fact and the order-item fact."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armazem.functions import dates, numbers, text
from armazem.operators.pick import last_by
from armazem.plans.dims import Tables


def _ts(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz")


# --- aggregates to the order grain ------------------------------------------------------------


def item_totals(stg: Tables) -> DataFrame:
    """Counts and sums of the items of each order.

    Two distinct counts in one aggregation would triple the rows before the shuffle. Here
    items are first reduced per product and per seller, which also spreads a very large order
    over many tasks; both results end up partitioned by order, so joining them is local.
    """
    items = stg["order_items"]
    price, freight = numbers.money(F.col("price")), numbers.money(F.col("freight_value"))
    per_product = items.groupBy("order_id", "product_id").agg(
        F.count("*").alias("items"),
        F.sum(price).alias("price"),
        F.sum(freight).alias("freight"),
    )
    sums = per_product.groupBy("order_id").agg(
        F.sum("items").alias("qtd_itens"),
        F.count("product_id").alias("qtd_produtos_distintos"),
        F.sum("price").alias("valor_itens"),
        F.sum("freight").alias("valor_frete"),
    )
    per_seller = items.select("order_id", "seller_id").distinct()
    sellers = per_seller.groupBy("order_id").agg(F.count("seller_id").alias("qtd_vendedores"))
    return sums.join(sellers, "order_id").select(
        "order_id", "qtd_itens", "qtd_produtos_distintos", "qtd_vendedores",
        "valor_itens", "valor_frete",
    )


def main_payment(value: Column, sequence: Column, kind: Column, instalments: Column) -> Column:
    """Aggregate: type and instalments of the largest payment, then of the lowest sequence.

    A payment without a value counts as the largest; type and instalments settle full ties.
    """
    return last_by(
        (kind.alias("tipo_pagamento_original"), instalments.alias("num_parcelas")),
        (value.isNull(), value, -sequence, kind, instalments),
    )


def payment_totals(stg: Tables) -> DataFrame:
    """Paid amount, number of payments and main payment of each order, in one pass."""
    value = numbers.money(F.col("payment_value"))
    return (
        stg["order_payments"]
        .groupBy("order_id")
        .agg(
            F.sum(value).alias("valor_pago"),
            F.count("*").alias("qtd_pagamentos"),
            main_payment(
                value,
                F.col("payment_sequential").cast("int"),
                text.code(F.col("payment_type")),
                F.col("payment_installments").cast("int"),
            ).alias("main"),
        )
        .select("order_id", "valor_pago", "qtd_pagamentos", "main.*")
    )


def latest_review(score: Column, answered: Column, created: Column, review: Column) -> Column:
    """Aggregate: score of the latest answered, then latest created review that has a score.

    Missing times come last; the review id settles ties.
    """
    recency = F.struct(answered, created, review, score)
    return F.max_by(score, F.when(score.isNotNull(), recency))


def review_scores(stg: Tables) -> DataFrame:
    score = F.col("review_score").cast("int")
    return (
        stg["order_reviews"]
        .where(F.col("review_score").isNotNull())
        .groupBy("order_id")
        .agg(
            latest_review(
                score,
                _ts("review_answer_timestamp"),
                _ts("review_creation_date"),
                F.col("review_id"),
            ).alias("nota_avaliacao")
        )
    )


# --- delivery measures ------------------------------------------------------------------------


def delivery_measures(purchase: Column, due: Column, delivered: Column) -> list[Column]:
    """Lead, estimate and lateness in calendar days; what has not happened stays NULL."""
    late = dates.days_between(due, delivered)
    return [
        dates.days_between(purchase, delivered).alias("prazo_entrega_dias"),
        dates.days_between(purchase, due).alias("prazo_estimado_dias"),
        late.alias("atraso_entrega_dias"),
        (late > 0).alias("flag_entregue_com_atraso"),
    ]


def freight_share(items: Column, freight: Column) -> Column:
    """Freight over item value plus freight, 4 places; NULL when nothing was charged."""
    charged = items + freight
    exact = freight.cast("decimal(18,2)") / charged.cast("decimal(18,2)")
    return F.when(charged > 0, F.round(exact, 4).cast("decimal(6,4)"))


# --- facts --------------------------------------------------------------------------------------


def _beside(rows: DataFrame, dealt: bool) -> DataFrame:
    """A side of a join by order. Where the tables are dealt by it, a merge of their buckets keeps the
    result dealt alike, so that it is written as it comes."""
    return rows.hint("merge") if dealt else rows


def order_fact(stg: Tables, dims: Tables, keys_first: bool = False) -> DataFrame:
    """One row per order.

    Every 1:n side is reduced to the order first, so the joins on ``order_id`` add columns
    and never rows. Customer keys are resolved once per account and joined last, or with
    ``keys_first`` while the rows are still narrow: for tables dealt by order, which the rows
    return to and are left in.
    """
    heads = stg["orders"].select(
        "order_id",
        "customer_id",
        text.code(F.col("order_status")).alias("status_original"),
        _ts("order_purchase_timestamp").alias("purchase"),
        _ts("order_approved_at").alias("approved"),
        _ts("order_delivered_customer_date").alias("delivered"),
        _ts("order_estimated_delivery_date").alias("due"),
    )
    accounts = (
        stg["customers"]
        .select(
            "customer_id",
            "customer_unique_id",
            text.zip_prefix(F.col("customer_zip_code_prefix")).alias("cep_prefixo"),
        )
        .join(dims["dim_cliente"].select("customer_unique_id", "sk_cliente"), "customer_unique_id")
        .join(dims["dim_geografia"].select("cep_prefixo", "sk_geografia"), "cep_prefixo")
        .select("customer_id", "sk_cliente", "sk_geografia")
    )

    def keyed(rows: DataFrame) -> DataFrame:
        known = dims["dim_status"].select("status_original", "sk_status")
        return rows.join(known, "status_original").join(accounts, "customer_id")

    def widened(rows: DataFrame) -> DataFrame:
        for totals in (item_totals(stg), payment_totals(stg), review_scores(stg)):
            rows = rows.join(_beside(totals, keys_first), "order_id", "left")
        return rows.join(
            dims["dim_pagamento"].select("tipo_pagamento_original", "num_parcelas", "sk_pagamento"),
            ["tipo_pagamento_original", "num_parcelas"],
            "left",
        )

    joined = widened(keyed(heads)) if keys_first else keyed(widened(heads))
    zero = F.lit(0).cast(numbers.MONEY)
    items = F.coalesce("valor_itens", zero)
    freight = F.coalesce("valor_frete", zero)

    def count(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).cast("int").alias(name)

    return joined.select(
        "order_id",
        dates.date_key(F.col("purchase")).alias("sk_tempo_compra"),
        dates.date_key(F.col("approved")).alias("sk_tempo_aprovacao"),
        dates.date_key(F.col("delivered")).alias("sk_tempo_entrega"),
        dates.date_key(F.col("due")).alias("sk_tempo_estimada"),
        "sk_cliente",
        "sk_geografia",
        F.coalesce("sk_pagamento", F.lit(0)).alias("sk_pagamento"),
        "sk_status",
        count("qtd_itens"),
        count("qtd_produtos_distintos"),
        count("qtd_vendedores"),
        items.cast("decimal(18,2)").alias("valor_itens"),
        freight.cast("decimal(18,2)").alias("valor_frete"),
        (items + freight).cast("decimal(18,2)").alias("valor_total"),
        F.col("valor_pago").cast("decimal(18,2)").alias("valor_pago"),
        count("qtd_pagamentos"),
        freight_share(items, freight).alias("participacao_frete"),
        *delivery_measures(F.col("purchase"), F.col("due"), F.col("delivered")),
        "nota_avaliacao",
    )


def item_fact(stg: Tables, dims: Tables, orders: DataFrame, keys_first: bool = False) -> DataFrame:
    """One row per order item, with the keys and the replicated measures of its order.

    With ``keys_first`` the keys of product and seller are resolved before the items take on what
    their order has: for tables dealt by order, see ``order_fact``.
    """
    price, freight = numbers.money(F.col("price")), numbers.money(F.col("freight_value"))
    inherited = orders.select(
        "order_id",
        F.col("sk_tempo_compra").alias("sk_tempo"),
        "sk_cliente", "sk_geografia", "sk_pagamento", "sk_status",
        "prazo_entrega_dias", "atraso_entrega_dias", "nota_avaliacao",
    )

    def keyed(rows: DataFrame) -> DataFrame:
        return rows.join(dims["dim_produto"].select("product_id", "sk_produto"), "product_id").join(
            dims["dim_vendedor"].select("seller_id", "sk_vendedor"), "seller_id"
        )

    def widened(rows: DataFrame) -> DataFrame:
        return rows.join(_beside(inherited, keys_first), "order_id")

    items = stg["order_items"]
    joined = widened(keyed(items)) if keys_first else keyed(widened(items))
    return joined.select(
        "sk_tempo", "sk_cliente", "sk_produto", "sk_vendedor", "sk_geografia",
        "sk_pagamento", "sk_status", "order_id",
        F.col("order_item_id").cast("int").alias("order_item_id"),
        price.alias("valor_item"),
        freight.alias("valor_frete"),
        numbers.money(price + freight).alias("valor_total_item"),
        "prazo_entrega_dias", "atraso_entrega_dias", "nota_avaliacao",
    )
