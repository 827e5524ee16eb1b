"""The seven dimensions, built from the raw tables.

Each function returns the dimension with its natural key only; ``keyed`` adds the surrogate
keys, so a plan that does not need them does not pay for them.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from armazem import vocabulary as v
from armazem.functions import dates, numbers, text
from armazem.operators.keys import with_dense_key, with_ordered_key
from armazem.operators.modes import profile_per_key
from armazem.operators.pick import last_by, smallest_per_key
from armazem.sources.literals import literal_rows

Tables = Mapping[str, DataFrame]


def default_states(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, v.STATES, "uf string, nome_estado string, regiao string")


def _with_region(rows: DataFrame, states: DataFrame) -> DataFrame:
    """Add the state name and region; unknown states keep NULL."""
    lookup = states.select(F.col("uf").alias("estado"), "nome_estado", "regiao")
    return rows.join(lookup, "estado", "left")


# --- tempo -------------------------------------------------------------------------------


def calendar(stg: Tables) -> DataFrame:
    """One row per day, whole years, from the first purchase to the last due or delivery."""
    orders = stg["orders"]

    def when(name: str) -> Column:
        return F.col(name).cast("timestamp_ntz")

    limits = orders.agg(
        F.min(when("order_purchase_timestamp")).alias("first"),
        F.max(when("order_estimated_delivery_date")).alias("due"),
        F.max(when("order_delivered_customer_date")).alias("delivered"),
    ).select(
        F.trunc(F.col("first").cast("date"), "year").alias("start"),
        F.make_date(F.year(F.greatest("due", "delivered")), F.lit(12), F.lit(31)).alias("end"),
    )
    days = limits.select(F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("data"))
    return calendar_attributes(days)


def calendar_attributes(days: DataFrame) -> DataFrame:
    d = F.col("data")
    weekday = dates.weekday_number(d)
    quarter = F.quarter(d).cast("string")
    return days.select(
        dates.date_key(d).alias("sk_tempo"),
        d,
        F.dayofmonth(d).alias("dia"),
        F.month(d).alias("mes"),
        dates.pick_name(v.MONTH_NAMES, F.month(d)).alias("nome_mes"),
        dates.pick_name(v.MONTH_SHORT, F.month(d)).alias("mes_abrev"),
        F.quarter(d).alias("trimestre"),
        F.concat(quarter, F.lit("T"), F.year(d).cast("string")).alias("nome_trimestre"),
        F.ceil(F.month(d) / 6).cast("int").alias("semestre"),
        F.year(d).alias("ano"),
        dates.year_month(d).alias("ano_mes"),
        weekday.alias("dia_semana"),
        dates.pick_name(v.WEEKDAY_NAMES, weekday + 1).alias("nome_dia_semana"),
        weekday.isin(0, 6).alias("fim_de_semana"),
    )


# --- status ------------------------------------------------------------------------------


def statuses(stg: Tables) -> DataFrame:
    """Statuses in use; those without an entry in the life cycle come last."""
    orders = stg["orders"]
    used = orders.select(text.code(F.col("order_status")).alias("status_original"))
    used = used.where(F.col("status_original").isNotNull()).distinct()
    known = literal_rows(
        orders.sparkSession,
        v.ORDER_STATUS,
        "status_original string, descricao string, entregue boolean, cancelado boolean, ordem int",
    )
    return used.join(known, "status_original", "left").select(
        "status_original",
        F.coalesce("descricao", text.capitalize_words(F.col("status_original"))).alias(
            "status_descricao"
        ),
        F.coalesce("entregue", F.lit(False)).alias("flag_entregue"),
        F.coalesce("cancelado", F.lit(False)).alias("flag_cancelado"),
        F.coalesce("ordem", F.lit(v.UNLISTED_STATUS_POSITION)).alias("ordem_ciclo"),
    )


# --- pagamento ------------------------------------------------------------------------------


def payment_label(raw: Column) -> Column:
    """Display name of a payment type; unlisted codes are spelled out."""
    (first, label), *rest = v.PAYMENT_LABELS
    chain = F.when(text.code(raw) == first, label)
    for known, label in rest:
        chain = chain.when(text.code(raw) == known, label)
    spelled = F.replace(F.trim(raw), F.lit("_"), F.lit(" "))
    return chain.otherwise(text.capitalize_words(spelled))


def payments(stg: Tables) -> DataFrame:
    """Combinations of payment type and instalments in use, without the unknown member."""
    used = (
        stg["order_payments"]
        .where(F.col("payment_type").isNotNull())
        .select(
            text.code(F.col("payment_type")).alias("tipo_pagamento_original"),
            F.col("payment_installments").cast("int").alias("num_parcelas"),
        )
        .distinct()
    )
    return used.select(
        "tipo_pagamento_original",
        payment_label(F.col("tipo_pagamento_original")).alias("tipo_pagamento"),
        "num_parcelas",
        numbers.band(F.col("num_parcelas"), v.INSTALMENT_BANDS, v.INSTALMENTS_ABOVE).alias(
            "faixa_parcelas"
        ),
    )


def _unknown_payment(spark: SparkSession) -> DataFrame:
    row = (0, v.UNKNOWN_PAYMENT_CODE, v.NOT_INFORMED, 0, v.NOT_INFORMED)
    return literal_rows(
        spark,
        [row],
        "sk_pagamento bigint, tipo_pagamento_original string, tipo_pagamento string,"
        " num_parcelas int, faixa_parcelas string",
    )


# --- produto -----------------------------------------------------------------------------------


def products(stg: Tables) -> DataFrame:
    kept = smallest_per_key(stg["products"], "product_id")
    names = stg["category_translation"].select(
        "product_category_name", F.col("product_category_name_english").alias("english")
    )
    original = F.col("product_category_name")
    label = text.category_label(original)
    weight, length, height, width = (
        numbers.number(F.col(c))
        for c in ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
    )

    def measure(name: str) -> Column:
        return numbers.whole(numbers.number(F.col(name)))

    return kept.join(names, "product_category_name", "left").select(
        "product_id",
        F.coalesce(text.blank_to_null(original), F.lit(v.UNKNOWN_CATEGORY_CODE)).alias(
            "categoria_original"
        ),
        F.coalesce(label, F.lit(v.NOT_INFORMED)).alias("categoria"),
        F.coalesce(text.category_label(F.col("english")), label, F.lit(v.NOT_INFORMED_EN)).alias(
            "categoria_en"
        ),
        numbers.whole(weight).alias("peso_g"),
        numbers.whole(length).alias("comprimento_cm"),
        numbers.whole(height).alias("altura_cm"),
        numbers.whole(width).alias("largura_cm"),
        numbers.whole(length * height * width).alias("volume_cm3"),
        F.when(weight.isNull(), v.NOT_INFORMED)
        .otherwise(numbers.band(weight, v.WEIGHT_BANDS, v.WEIGHT_ABOVE))
        .alias("faixa_peso"),
        measure("product_photos_qty").alias("qtd_fotos"),
        measure("product_name_lenght").alias("tamanho_nome"),
        measure("product_description_lenght").alias("tamanho_descricao"),
    )


# --- vendedor -------------------------------------------------------------------------------------


def sellers(stg: Tables, states: DataFrame) -> DataFrame:
    rows = smallest_per_key(stg["sellers"], "seller_id").select(
        "seller_id",
        text.zip_prefix(F.col("seller_zip_code_prefix")).alias("cep_prefixo"),
        text.normalize_label(F.col("seller_city")).alias("cidade"),
        text.state_code(F.col("seller_state")).alias("estado"),
    )
    return _with_region(rows, states).select(
        "seller_id", "cep_prefixo", "cidade", "estado", "nome_estado", "regiao"
    )


# --- cliente --------------------------------------------------------------------------------------


def customers(stg: Tables, states: DataFrame, recurring_above: int = 1) -> DataFrame:
    """One row per person: the address of the latest order and the number of orders.

    Orders are reduced to one row per account before they meet the accounts, so an account
    with very many orders does not weigh on the join.
    """
    purchase = F.col("order_purchase_timestamp").cast("timestamp_ntz")
    activity = stg["orders"].groupBy("customer_id").agg(
        F.max(purchase).alias("last_purchase"), F.count(purchase).alias("orders")
    )
    address = ("customer_zip_code_prefix", "customer_city", "customer_state")
    people = (
        stg["customers"]
        .join(activity, "customer_id", "left")
        .groupBy("customer_unique_id")
        .agg(
            last_by(address, ("last_purchase", "customer_id", *address)).alias("last"),
            F.coalesce(F.sum("orders"), F.lit(0)).alias("qtd_pedidos"),
        )
        .select("customer_unique_id", "last.*", "qtd_pedidos")
    )
    rows = people.select(
        "customer_unique_id",
        text.zip_prefix(F.col("customer_zip_code_prefix")).alias("cep_prefixo"),
        text.normalize_label(F.col("customer_city")).alias("cidade"),
        text.state_code(F.col("customer_state")).alias("estado"),
        "qtd_pedidos",
    )
    return _with_region(rows, states).select(
        "customer_unique_id", "cep_prefixo", "cidade", "estado", "nome_estado", "regiao",
        "qtd_pedidos", (F.col("qtd_pedidos") > recurring_above).alias("flag_recorrente"),
    )


# --- geografia ------------------------------------------------------------------------------------


def _places(rows: DataFrame, prefix: str, *extra: Column) -> DataFrame:
    return rows.select(
        text.zip_prefix(F.col(f"{prefix}_zip_code_prefix")).alias("cep_prefixo"),
        text.normalize_label(F.col(f"{prefix}_city")).alias("cidade"),
        text.state_code(F.col(f"{prefix}_state")).alias("estado"),
        *extra,
    )


def geography(stg: Tables, states: DataFrame) -> DataFrame:
    """One row per zip prefix: mean position inside the territory, usual city and state.

    Places of customers and sellers win over the position file. Raw places are counted per
    distinct spelling before the label function runs on them.
    """
    lat = F.col("geolocation_lat").cast("decimal(24,18)")
    lng = F.col("geolocation_lng").cast("decimal(24,18)")
    inside = lat.between(*(F.lit(x).cast("decimal(9,6)") for x in v.LATITUDE_RANGE)) & (
        lng.between(*(F.lit(x).cast("decimal(9,6)") for x in v.LONGITUDE_RANGE))
    )
    located = _places(
        stg["geolocation"].where(inside), "geolocation", lat.alias("lat"), lng.alias("lng")
    )
    positions = profile_per_key(located, "cep_prefixo", ("cidade", "estado"), ("lat", "lng"))
    used = _places(stg["customers"], "customer").unionByName(_places(stg["sellers"], "seller"))
    addresses = profile_per_key(used, "cep_prefixo", ("cidade", "estado"))

    g, t = positions.alias("g"), addresses.alias("t")
    joined = g.join(t, F.col("g.cep_prefixo") == F.col("t.cep_prefixo"), "full")

    def mean(name: str) -> Column:
        return F.round(F.col(name) / F.col("g.n").cast("decimal(13,0)"), 6).cast("decimal(9,6)")

    rows = joined.select(
        F.coalesce("t.cep_prefixo", "g.cep_prefixo").alias("cep_prefixo"),
        F.coalesce("t.cidade", "g.cidade").alias("cidade"),
        F.coalesce("t.estado", "g.estado").alias("estado"),
        mean("lat").alias("latitude_media"),
        mean("lng").alias("longitude_media"),
        F.coalesce("g.n", F.lit(0)).alias("qtd_registros_origem"),
        F.when(F.col("g.cep_prefixo").isNotNull(), v.ORIGIN_GEOLOCATION)
        .otherwise(v.ORIGIN_TRANSACTIONS)
        .alias("origem"),
    )
    return _with_region(rows, states).select(
        "cep_prefixo", "cidade", "estado", "nome_estado", "regiao",
        "latitude_media", "longitude_media", "qtd_registros_origem", "origem",
    )


# --- surrogate keys -----------------------------------------------------------------------------------


def keyed(name: str, rows: DataFrame, through: str | None = None) -> DataFrame:
    """Add the surrogate key of a dimension to its natural rows; see ``with_dense_key``."""
    if name == "dim_tempo":
        return rows
    if name == "dim_status":
        return with_ordered_key(rows, "sk_status", "ordem_ciclo", "status_original")
    if name == "dim_pagamento":
        numbered = with_ordered_key(
            rows, "sk_pagamento", "tipo_pagamento_original", "num_parcelas"
        )
        return _unknown_payment(rows.sparkSession).unionByName(numbered)
    natural, key = DENSE_KEYS[name]
    return with_dense_key(rows, natural, key, through)


DENSE_KEYS = {
    "dim_cliente": ("customer_unique_id", "sk_cliente"),
    "dim_produto": ("product_id", "sk_produto"),
    "dim_vendedor": ("seller_id", "sk_vendedor"),
    "dim_geografia": ("cep_prefixo", "sk_geografia"),
}


def dimension(
    name: str, stg: Tables, states: DataFrame, recurring_above: int = 1, through: str | None = None
) -> DataFrame:
    """A dimension with its surrogate key; ``through``: where its natural rows are written."""
    natural = {
        "dim_tempo": lambda: calendar(stg),
        "dim_cliente": lambda: customers(stg, states, recurring_above),
        "dim_produto": lambda: products(stg),
        "dim_vendedor": lambda: sellers(stg, states),
        "dim_geografia": lambda: geography(stg, states),
        "dim_pagamento": lambda: payments(stg),
        "dim_status": lambda: statuses(stg),
    }
    return keyed(name, natural[name](), through)
