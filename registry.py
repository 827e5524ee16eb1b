"""Every registered query: (spark, folder of the provided tables) -> DataFrame."""

import hashlib
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

import oracles as p
from armazem.functions import numbers, text
from armazem.operators import grouping, keys, modes, pick, ranking
from armazem.plans import checks, dims, facts, feeds, kpis, load, olap, quarantine
from armazem.plans.star import SourceStar, Star, StoredStar
from armazem.sources import rawfiles, sinks
from armazem.sources.binding import NAMES, Source
from armazem.sources.catalog import RAW_TABLES, RawTable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the reports on the test tables; the defaults of the reports are the originals.
REPORT_PARAMETERS = {
    "O03": {"estado": p.STATE},
    "O04": {"ano": p.YEAR},
    "O05": {"anos": p.DICE_YEARS, "regioes": p.DICE_REGIONS, "tipos": p.DICE_PAYMENTS},
    "O06": {"anos": p.PIVOT_YEARS},
    "O09": {"min_pedidos": p.MIN_ORDERS},
    "O10": {"min_itens": p.MIN_ITEMS},
    "O12": {"min_avaliacoes": p.MIN_RATINGS},
    "O16": {"regioes": p.REGIONS},
}
FEED_PARAMETERS = {
    "O01": {"min_pedidos": p.MIN_MONTH},
    "O06": {"anos": p.PIVOT_YEARS},
    "O14": {"min_pedidos": p.MIN_MONTH},
    "O16": {"regioes": p.REGIONS},
}


def query(build: Query) -> Query:
    """Register a function under its own name."""
    QUERIES[build.__name__] = build
    return build


# --- reports, feeds and headline figures, on the loaded warehouse -----------------------------


def star(spark: SparkSession, folder: str) -> SourceStar:
    """The same reports straight from the provided tables, as a cross-check."""
    return SourceStar(Source(spark, folder), p.RECURRING_ABOVE)


def report(code: str, where: Star) -> DataFrame:
    build, _ = olap.REPORTS[code]
    return build(where, **REPORT_PARAMETERS.get(code, {}))


def feed(code: str, where: Star) -> DataFrame:
    shape, _ = feeds.FEEDS[code]
    return shape(report(code, where), **FEED_PARAMETERS.get(code, {}))


for _code, (_, _title) in olap.REPORTS.items():
    QUERIES[f"{_code.lower()}_{_title}"] = lambda spark, folder, code=_code: report(
        code, stored_star(spark, folder)
    )
for _code, (_, _title) in feeds.FEEDS.items():
    QUERIES[f"g{_code[1:]}_{_title}"] = lambda spark, folder, code=_code: feed(
        code, stored_star(spark, folder)
    )


@query
def k01_kpis(spark, folder):
    return kpis.kpis(stored_star(spark, folder))


# --- dimensions ------------------------------------------------------------------------------


def dimension(spark: SparkSession, folder: str, name: str) -> DataFrame:
    source = Source(spark, folder)
    through = f"{sinks.shared_folder(spark)}/naturais-{uuid.uuid4().hex}"
    return dims.dimension(name, source.staging, source.states, p.RECURRING_ABOVE, through)


@query
def d01_calendar(spark, folder):
    return dimension(spark, folder, "dim_tempo")


@query
def d02_status(spark, folder):
    return dimension(spark, folder, "dim_status")


@query
def d03_payment(spark, folder):
    return dimension(spark, folder, "dim_pagamento")


@query
def d04_product(spark, folder):
    return dimension(spark, folder, "dim_produto")


@query
def d05_seller(spark, folder):
    return dimension(spark, folder, "dim_vendedor")


@query
def d06_customer(spark, folder):
    return dimension(spark, folder, "dim_cliente")


@query
def d07_geography(spark, folder):
    return dimension(spark, folder, "dim_geografia")


@query
def d08_dense_keys(spark, folder):
    orders = Source(spark, folder)["orders"].select("o_orderkey", "o_orderpriority")
    through = f"{sinks.shared_folder(spark)}/naturais-{uuid.uuid4().hex}"
    return keys.with_dense_key(orders, "o_orderkey", "sk", through)


@query
def d09_region_lookup(spark, folder):
    """Customers per state, with name and region from the lookup."""
    source = Source(spark, folder)
    per_state = source.staging["customers"].groupBy(
        text.state_code(F.col("customer_state")).alias("uf")
    ).agg(F.count("*").alias("clientes"))
    return source.states.join(per_state, "uf", "left")


# --- facts -----------------------------------------------------------------------------------


@query
def f01_order_fact(spark, folder):
    """The order fact over the staged tables and the written dimensions, as a load builds it."""
    staged, keyed, _ = loaded(spark, folder)
    return facts.order_fact(staged, keyed, keys_first=True)


@query
def f02_item_fact(spark, folder):
    """The item fact over the staged items and the written order fact, which are dealt alike."""
    staged, keyed, _ = loaded(spark, folder)
    return facts.item_fact(staged, keyed, keyed["fato_pedido"])


@query
def f03_main_payment(spark, folder):
    return facts.payment_totals(Source(spark, folder).staging).select(
        "order_id", "tipo_pagamento_original", "num_parcelas"
    )


@query
def f04_latest_review(spark, folder):
    return facts.review_scores(Source(spark, folder).staging)


@query
def f05_item_rollup(spark, folder):
    return facts.item_totals(Source(spark, folder).staging).withColumns({
        "valor_itens": numbers.total(F.col("valor_itens")),
        "valor_frete": numbers.total(F.col("valor_frete")),
    })


@query
def f06_payment_rollup(spark, folder):
    return facts.payment_totals(Source(spark, folder).staging).select(
        "order_id", numbers.total(F.col("valor_pago")).alias("valor_pago"), "qtd_pagamentos"
    )


@query
def f07_delivery_measures(spark, folder):
    orders = Source(spark, folder).staging["orders"]
    return orders.select("order_id", *facts.delivery_measures(
        F.col("order_purchase_timestamp"),
        F.col("order_estimated_delivery_date"),
        F.col("order_delivered_customer_date"),
    ))


# --- loaded warehouse: validations -----------------------------------------------------------

_loads: dict[tuple, str] = {}
_load_lock = threading.Lock()


def state_of(spark: SparkSession, folder: str) -> tuple:
    """What the files of a source folder are now; another state asks for another load."""
    # Only the files are listed: their contents are not among the columns asked for.
    files = spark.read.format("binaryFile").load([f"{folder}/{n}.parquet" for n in NAMES])
    return tuple(sorted(tuple(r) for r in files.select("path", "length", "modificationTime").collect()))


def loaded_folder(spark: SparkSession, folder: str) -> str:
    """Folder with the staged tables and the warehouse of one source folder.

    Reports and validations read a written load, not a plan. It is made once per application
    and state of the source files, in the shared folder the session names.
    """
    with _load_lock:
        key = (spark.sparkContext.applicationId, folder, state_of(spark, folder))
        if key not in _loads:
            target = f"{sinks.shared_folder(spark)}/warehouse-{uuid.uuid4().hex}"
            source = Source(spark, folder)
            version, own = load.new_version(target)
            stg, _ = load.stage(spark, source.staging, own, load.Audit(spark, target, version))
            load.build(stg, source.states, own, p.RECURRING_ABOVE)
            load.publish(spark, target, version)
            _loads[key] = target
        return _loads[key]


def loaded(spark: SparkSession, folder: str):
    target = loaded_folder(spark, folder)
    return (
        load.open_staging(spark, target),
        load.open_warehouse(spark, target),
        load.open_audit(spark, target),
    )


def expected_volumes(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Rows the raw tables should have: those of the source, counted before staging."""
    staging = Source(spark, folder).staging
    counts = sinks.row_counts({name: staging[name] for name in RAW_TABLES})
    return [(r.tabela, r.registros) for r in counts.orderBy("ordem").collect()]


def stored_star(spark: SparkSession, folder: str) -> StoredStar:
    return StoredStar(loaded(spark, folder)[1])


@query
def v01_staging_volume(spark, folder):
    return checks.volumes(loaded(spark, folder)[2], expected_volumes(spark, folder))


@query
def v02_table_counts(spark, folder):
    return checks.table_counts(loaded(spark, folder)[1])


@query
def v03_reconciliation(spark, folder):
    stg, warehouse, _ = loaded(spark, folder)
    return checks.reconciliation(stg, warehouse)


@query
def v04_coverage(spark, folder):
    return checks.coverage(loaded(spark, folder)[1])


@query
def v05_gate(spark, folder):
    stg, warehouse, audit = loaded(spark, folder)
    return checks.gate(
        checks.all_validations(stg, warehouse, audit, expected_volumes(spark, folder)).values()
    )


@query
def v06_constraints(spark, folder):
    return checks.constraints(loaded(spark, folder)[1])


# --- sources and sinks -----------------------------------------------------------------------


def _scratch(spark: SparkSession, folder: str, name: str) -> str:
    tag = hashlib.md5(folder.encode()).hexdigest()[:8]
    return f"{sinks.shared_folder(spark)}/{name}-{spark.sparkContext.applicationId}-{tag}"


def _through_csv(spark, folder, rows: DataFrame, name: str) -> str:
    path = _scratch(spark, folder, name)
    text_rows = rows.select(*[F.col(c).cast("string") for c in rows.columns])
    text_rows.write.mode("overwrite").option("header", True).options(**sinks.CSV_WRITE).csv(path)
    return path


@query
def s01_csv_roundtrip(spark, folder):
    """Conversations written as CSV and read back as a raw table with free text."""
    rows = spark.read.parquet(f"{folder}/conversations.parquet")
    table = RawTable(tuple(rows.columns), "", free_text=True)
    back = rawfiles.read_raw(spark, _through_csv(spark, folder, rows, "conversations"), table)
    return back.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"), "role", "text",
    )


@query
def s01_split_csv(spark, folder):
    """Whole documents written as CSV and read back by blocks, records put together by quotes."""
    rows = spark.read.parquet(f"{folder}/documents.parquet")
    table = RawTable(tuple(rows.columns), "", free_text=True)
    back = rawfiles.read_raw(spark, _through_csv(spark, folder, rows, "documents"), table, split=True)
    return back.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang", "source",
        F.col("n_chars").cast("bigint").alias("n_chars"))


@query
def s02_header_check(spark, folder):
    """Lines filed with their columns in another order come back in the table's order."""
    rows = Source(spark, folder).staging["order_items"]
    table = RAW_TABLES["order_items"]
    filed = rows.select(*reversed(table.columns))
    back = rawfiles.read_raw(spark, _through_csv(spark, folder, filed, "order_items"), table)
    return back.select(
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("order_item_id").cast("int").alias("order_item_id"),
        F.col("product_id").cast("bigint").alias("product_id"),
        F.col("seller_id").cast("bigint").alias("seller_id"),
        numbers.money(F.col("price")).alias("price"),
        numbers.money(F.col("freight_value")).alias("freight_value"),
    )


@query
def s03_required_inputs(spark, folder):
    """Which of the nine raw files are there, when only two have been delivered."""
    raw = _scratch(spark, folder, "delivered")
    for name in ("sellers", "category_translation"):
        rows = Source(spark, folder).staging[name]
        as_text = rows.select(*[F.col(c).cast("string") for c in RAW_TABLES[name].columns])
        as_text.write.mode("overwrite").option("header", True).options(**sinks.CSV_WRITE).csv(
            f"{raw}/shop_{RAW_TABLES[name].file_ending}")
    return rawfiles.input_report(spark, raw)


@query
def s05_load_audit(spark, folder):
    return loaded(spark, folder)[2].select(
        F.col("tabela_destino").alias("tabela"), "registros_lidos", "registros_carregados",
        (F.col("inicio_carga") <= F.col("fim_carga")).alias("em_ordem"), "situacao",
    )


@query
def s07_series(spark, folder):
    """Days per month of the generated calendar."""
    days = dims.calendar(Source(spark, folder).staging)
    return days.groupBy("ano_mes").agg(
        F.count("*").alias("dias"), F.sum("sk_tempo").alias("soma_chaves")
    )


@query
def s09_export(spark, folder):
    """A report exported as CSV and read back as text."""
    path = _scratch(spark, folder, "export")
    sinks.export_report(report("O01", star(spark, folder)), path)
    return spark.read.option("header", True).csv(path)


# --- text and numbers ------------------------------------------------------------------------


@query
def n01_normalize_label(spark, folder):
    """Whole document texts as normalised labels."""
    rows = spark.read.parquet(f"{folder}/documents.parquet")
    return rows.select("doc_id", text.normalize_label(F.col("text")).alias("label"))


@query
def x03_zip_prefix(spark, folder):
    rows = Source(spark, folder).staging["customers"]
    return rows.select(
        "customer_id", text.zip_prefix(F.col("customer_zip_code_prefix")).alias("cep_prefixo")
    )


@query
def x07_capitalize_words(spark, folder):
    rows = spark.read.parquet(f"{folder}/pages.parquet")
    return rows.select("page_id", text.capitalize_words(F.col("url")).alias("words"))


@query
def x13_date_parts(spark, folder):
    """Parts, keys, labels and names of the purchase date of every order."""
    orders = Source(spark, folder)["orders"].select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("data")
    )
    parts = dims.calendar_attributes(orders.select("data").distinct())
    return orders.join(parts, "data")


@query
def x19_quarantine(spark, folder):
    """Items and orders with bad prices, freights and dates among them, staged with a quarantine:
    what was set aside and why, beside the figures of the audit."""
    staging, order = Source(spark, folder).staging, F.col("order_id")
    items, heads = ({c: F.col(c).cast("string") for c in RAW_TABLES[n].columns} for n in ("order_items", "orders"))
    item = F.col("order_item_id")
    items["price"] = F.when((order * 7 + item) % 101 == 0, F.concat(items["price"], F.lit(" BRL"))).otherwise(items["price"])
    items["freight_value"] = F.when((order + item) % 103 == 0, "free").otherwise(items["freight_value"])
    bought = heads["order_purchase_timestamp"]
    heads["order_purchase_timestamp"] = F.when(order % 97 == 0, "1997-02-30 00:00:00").otherwise(bought)
    raw = {"order_items": staging["order_items"].select(*[c.alias(n) for n, c in items.items()]),
           "orders": staging["orders"].select(*[c.alias(n) for n, c in heads.items()])}
    target = f"{sinks.shared_folder(spark)}/quarantine-{uuid.uuid4().hex}"
    _, audit = load.stage(spark, raw, target, quarantine=quarantine.Quarantine(most_share=0.1))
    found = load.open_rejects(spark, target, raw).groupBy("tabela", "coluna", "motivo").agg(F.count("*").alias("registros"))
    return found.join(audit.withColumnRenamed("tabela_destino", "tabela"), "tabela").select(
        "tabela", "coluna", "motivo", "registros", "registros_lidos", "registros_carregados", "registros_rejeitados")


@query
def x20_rounding_cast(spark, folder):
    products = Source(spark, folder).staging["products"]
    weight = numbers.number(F.col("product_weight_g"))
    return products.select(
        "product_id", numbers.whole(weight).alias("arredondado"),
        numbers.whole(-weight).alias("negativo"), weight.cast("int").alias("truncado"),
    )


# --- aggregation, join and window operators --------------------------------------------------


@query
def a07_mode(spark, folder):
    """Usual priority and status of the orders of each customer."""
    orders = Source(spark, folder)["orders"]
    return modes.profile_per_key(orders, "o_custkey", ("o_orderpriority", "o_orderstatus"))


def _line_sums() -> dict:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    return {"valor": F.sum(price), "linhas": F.count("*")}


@query
def a09_composite_rollup(spark, folder):
    lines = Source(spark, folder)["lineitem"].withColumn("ano", F.year("l_shipdate"))
    sets = grouping.rollup_sets("ano", ("l_returnflag", "l_linestatus"))
    return grouping.grouped_totals(lines, sets, _line_sums()).select(
        "ano", "l_returnflag", "l_linestatus",
        numbers.total(F.col("valor")).alias("valor"), "linhas",
        F.col(grouping.total_flag("ano")).cast("int").alias("total_ano"),
    )


@query
def a10_cube(spark, folder):
    lines = Source(spark, folder)["lineitem"]
    sets = grouping.cube_sets("l_returnflag", "l_linestatus", "l_linenumber")
    return grouping.grouped_totals(lines, sets, _line_sums()).select(
        "l_returnflag", "l_linestatus", "l_linenumber",
        numbers.total(F.col("valor")).alias("valor"), "linhas",
    )


@query
def a15_first_per_key(spark, folder):
    """The smallest line of every order."""
    lines = Source(spark, folder)["lineitem"].select(
        "l_orderkey", "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"
    )
    return pick.smallest_per_key(lines, "l_orderkey")


@query
def a16_nested_aggregate(spark, folder):
    """Mean over suppliers of their distinct orders, per nation."""
    source = Source(spark, folder)
    per_seller = source["lineitem"].groupBy("l_suppkey").agg(
        F.countDistinct("l_orderkey").alias("orders")
    )
    return (
        source["supplier"].join(per_seller, F.col("s_suppkey") == F.col("l_suppkey"), "left")
        .groupBy("s_nationkey")
        .agg(F.count("*").alias("sellers"), F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"))
        .select("s_nationkey", "sellers", "orders",
                numbers.quotient(F.col("orders"), F.col("sellers")).alias("per_seller"))
    )


@query
def j03_full_join(spark, folder):
    """Zip prefixes of customers and sellers, whichever side has them."""
    staging = Source(spark, folder).staging
    c = staging["customers"].groupBy(F.col("customer_zip_code_prefix").alias("zip")).agg(
        F.count("*").alias("customers"))
    s = staging["sellers"].groupBy(F.col("seller_zip_code_prefix").alias("zip")).agg(
        F.count("*").alias("sellers"))
    return c.join(s, "zip", "full").select(
        "zip", F.coalesce("customers", F.lit(0)).alias("customers"),
        F.coalesce("sellers", F.lit(0)).alias("sellers"))


@query
def j06_orphans(spark, folder):
    """Orders without lines, per status: an anti-join on pre-counted keys."""
    source = Source(spark, folder)
    with_lines = source["lineitem"].select("l_orderkey").distinct()
    lost = source["orders"].join(
        with_lines, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")
    return lost.groupBy("o_orderstatus").agg(F.count("*").alias("orders"))


@query
def u01_union_all(spark, folder):
    """Accounts of customers and suppliers per nation, duplicates kept."""
    source = Source(spark, folder)
    both = source["customer"].select(
        F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")
    ).unionByName(source["supplier"].select(
        F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance")))
    amount = F.col("balance").cast("decimal(12,2)")
    return both.groupBy("nation").agg(
        F.count("*").alias("accounts"), numbers.total(F.sum(amount)).alias("balance"))


def _revenue_by(spark, folder, key: str) -> DataFrame:
    amount = F.col("l_extendedprice").cast("decimal(12,2)")
    return Source(spark, folder)["lineitem"].groupBy(key).agg(F.sum(amount).alias("revenue"))


@query
def w02_rank(spark, folder):
    """The fifty suppliers ranked highest by revenue, ties kept."""
    rank = F.rank().over(W.orderBy(ranking.desc("revenue")))
    ranked = _revenue_by(spark, folder, "l_suppkey").withColumn("rank", rank)
    return ranked.where(F.col("rank") <= 50).select(
        "rank", "l_suppkey", numbers.total(F.col("revenue")).alias("revenue"))


@query
def w03_running_sum(spark, folder):
    """Running number of lines by line number and quantity, largest first. Many groups have the
    same number of lines; such peers share the value."""
    rows = Source(spark, folder)["lineitem"].groupBy("l_linenumber", "l_quantity").agg(
        F.count("*").alias("lines"))
    running = F.sum("lines").over(W.orderBy(ranking.desc("lines")))
    return rows.select("l_linenumber", "l_quantity", "lines", running.alias("running"))


def _positions(rows: DataFrame) -> DataFrame:
    """Place of each row of a report, which comes in one sorted partition."""
    return rows.withColumn("posicao", F.monotonically_increasing_id() + 1)


@query
def l01_report_order(spark, folder):
    """Order of details, subtotals and grand total, with a sort key that is not shown."""
    rows = report("O02", stored_star(spark, folder))
    return _positions(rows).select("posicao", "regiao", "estado")


@query
def l03_cube_order(spark, folder):
    rows = report("O15", stored_star(spark, folder))
    return _positions(rows).select("posicao", "regiao", "tipo_pagamento")


@query
def l02_missing_last(spark, folder):
    """All products by weight: ranked ascending with missing ones last, and the first of them
    descending with missing ones first. Ranks come from the products of each weight, summed up."""
    products = Source(spark, folder).staging["products"].select(
        "product_id", F.col("product_weight_g").cast("decimal(12,1)").alias("weight"))
    heavy = ranking.top(products, 150, ranking.desc("weight"), ranking.asc("product_id"))
    before = W.orderBy(ranking.asc("weight")).rowsBetween(W.unboundedPreceding, -1)
    places = products.groupBy("weight").agg(F.count("*").alias("n")).select(
        F.col("weight").alias("of"), (F.coalesce(F.sum("n").over(before), F.lit(0)) + 1).alias("place"))
    ranked = products.join(places, F.col("weight").eqNullSafe(F.col("of")))
    return heavy.select(F.lit("first").alias("side"), "product_id", "weight", F.lit(0).cast("long").alias("place")).unionByName(
        ranked.select(F.lit("last").alias("side"), "product_id", "weight", "place"))


@query
def w04_two_rankings(spark, folder):
    """Brands in the best or the worst three by revenue."""
    source = Source(spark, folder)
    per_part = _revenue_by(spark, folder, "l_partkey")
    brands = source["part"].join(per_part, F.col("p_partkey") == F.col("l_partkey")).groupBy(
        "p_brand").agg(F.sum("revenue").alias("revenue"))
    best = F.rank().over(W.orderBy(ranking.desc("revenue")))
    worst = F.rank().over(W.orderBy(ranking.asc("revenue")))
    both = brands.withColumn("best", best).withColumn("worst", worst)
    return both.where((F.col("best") <= 3) | (F.col("worst") <= 3)).select(
        "p_brand", numbers.total(F.col("revenue")).alias("revenue"),
        F.when(F.col("best") <= 3, "best").otherwise("worst").alias("side"))
