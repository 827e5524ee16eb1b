"""How reports see the warehouse.

A report names fact columns and dimension attributes such as ``geografia.regiao`` and gets
rows, or additive totals, that carry them. ``StoredStar`` answers from written tables and
joins only the dimensions named. ``SourceStar`` answers straight from the provided test
tables. Reports are written once and run on both.

Totals are grouped by dimension key before the dimension is joined: the facts are combined
on the map side, so neither the join nor a key that holds much of the data sees raw rows.
"""

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armazem import vocabulary as v
from armazem.functions import dates, text
from armazem.plans import dims as dim_jobs
from armazem.plans import facts
from armazem.sources import binding as b

Measures = Mapping[str, Column]
Slices = Mapping[str, Iterable]  # attribute -> values kept

# Facts are written to one folder per year of purchase.
YEAR_FOLDER = "particao_ano"

# Sums and count of the items of one order, or of one order and product or seller.
SALES = ("valor_item", "valor_frete", "itens")


def _outputs(columns: Iterable[str]) -> dict[str, str]:
    """Output name -> column; an attribute is named without its dimension."""
    return {c.split(".")[-1]: c for c in columns}


def _sales_sums() -> list[Column]:
    first, second, count = SALES
    return [F.sum(first).alias(first), F.sum(second).alias(second), F.count("*").alias(count)]


def _of_years(rows: DataFrame, years: Iterable[int]) -> DataFrame:
    """Fact rows of the span of whole years: by the folders facts are written to where they
    have any, and by the YYYYMMDD key within them."""
    years = sorted(years)
    if not years:
        return rows
    if YEAR_FOLDER in rows.columns:
        rows = rows.where(F.col(YEAR_FOLDER).between(years[0], years[-1]))
    first, last = years[0] * 10000 + 101, years[-1] * 10000 + 1231
    return rows.where(F.col("sk_tempo").between(first, last))


class StoredStar:
    """Written dimensions and facts."""

    KEYS = {
        "tempo": "sk_tempo", "cliente": "sk_cliente", "produto": "sk_produto",
        "vendedor": "sk_vendedor", "geografia": "sk_geografia",
        "pagamento": "sk_pagamento", "status": "sk_status",
    }

    def __init__(self, tables: Mapping[str, DataFrame]):
        self.tables = tables

    def sold_items(self, *columns: str) -> DataFrame:
        """Fact columns of the items of orders that were not cancelled."""
        return self._sold().select(*columns)

    def rated_items(self, key: str) -> DataFrame:
        """Number of items by product or seller and rating of their order."""
        rated = self._items().where(F.col("nota_avaliacao").isNotNull())
        return rated.groupBy(key, "nota_avaliacao").agg(F.count("*").alias("itens"))

    def orders(self, *columns: str) -> DataFrame:
        """Order rows."""
        return self._widen(self._order_rows(), columns)

    def order_totals(
        self, measures: Measures, attributes: Sequence[str], columns: Sequence[str] = ()
    ) -> DataFrame:
        """Measures of the order fact by attributes; ``columns`` are the fact columns used."""
        return self._totals(self._order_rows(), measures, attributes)

    def sales_totals(
        self,
        measures: Measures,
        attributes: Sequence[str],
        years: Iterable[int] = (),
        only: Slices | None = None,
    ) -> DataFrame:
        """Measures over one row per order with items that was not cancelled, by attributes
        an order has one of.

        The order fact holds the item sums of each order, so no item is read and nothing is
        shuffled by order; reconciliation reports when the two facts disagree. Slices reach the
        fact as keys of the small dimensions before anything is grouped.
        """
        rows = _of_years(self._order_rows(), years).where(F.col("qtd_itens") > 0)
        rows = self._kept(rows)
        for attribute, values in (only or {}).items():
            name, column = attribute.split(".")
            key = self.KEYS[name]
            inside = self.tables[f"dim_{name}"].where(F.col(column).isin(*values)).select(key)
            rows = rows.join(inside, key, "left_semi")
        first, second, count = SALES
        per_order = rows.select(
            *self._keys(attributes), F.col("valor_itens").alias(first), F.col(second),
            F.col("qtd_itens").alias(count),
        )
        return self._totals(per_order, measures, attributes)

    def pair_sales(
        self, key: str, attributes: Sequence[str], years: Iterable[int] = (), sold: bool = True
    ) -> DataFrame:
        """One row per order and product or seller, with attributes of the order."""
        keys = self._keys(c for c in attributes if "." in c)
        own = [c for c in attributes if "." not in c]
        rows = self._sold(years) if sold else self._items(years)
        pairs = rows.groupBy("order_id", key, *own, *keys).agg(*_sales_sums())
        return self._widen(pairs, ("order_id", key, *SALES, *attributes))

    def dim(self, name: str, *columns: str) -> DataFrame:
        return self.tables[f"dim_{name}"].select(*columns)

    def _order_rows(self) -> DataFrame:
        return self.tables["fato_pedido"].withColumnRenamed("sk_tempo_compra", "sk_tempo")

    def _items(self, years: Iterable[int] = ()) -> DataFrame:
        """Item rows of whole years."""
        return _of_years(self.tables["fato_vendas"], years)

    def _sold(self, years: Iterable[int] = ()) -> DataFrame:
        """Item rows of orders that were not cancelled."""
        return self._kept(self._items(years))

    def _kept(self, rows: DataFrame) -> DataFrame:
        """Rows whose status is not a cancellation."""
        kept = self.tables["dim_status"].where(~F.col("flag_cancelado")).select("sk_status")
        return rows.join(kept, "sk_status", "left_semi")

    def _keys(self, attributes: Iterable[str]) -> list[str]:
        return list(dict.fromkeys(self.KEYS[a.split(".")[0]] for a in attributes))

    def _totals(
        self, rows: DataFrame, measures: Measures, attributes: Sequence[str]
    ) -> DataFrame:
        reduced = rows.groupBy(*self._keys(attributes)).agg(
            *[m.alias(n) for n, m in measures.items()]
        )
        return self._widen(reduced, (*attributes, *measures))

    def _widen(self, rows: DataFrame, columns: Iterable[str]) -> DataFrame:
        """Join the dimensions that the columns name."""
        wanted: dict[str, list[str]] = {}
        for column in columns:
            if "." in column:
                name, attribute = column.split(".")
                wanted.setdefault(name, []).append(attribute)
        for name, attributes in wanted.items():
            key = self.KEYS[name]
            rows = rows.join(self.tables[f"dim_{name}"].select(key, *attributes), key)
        return rows.select(*_outputs(columns))


class SourceStar:
    """The same rows straight from the provided tables, with natural keys.

    Relies on the foreign keys of those tables: a table none of whose columns is asked for
    is not joined. The checks on the written warehouse report rows that break this.
    """

    def __init__(self, source: b.Source, recurring_above: int = 1):
        self.source = source
        self.recurring_above = recurring_above

    # Attributes that the row of an order holds itself.
    HEAD: dict[str, Callable[[], Column]] = {
        "order_id": lambda: F.col("o_orderkey"),
        "status.status_original": b.status,
        "status.flag_cancelado": lambda: F.col("o_orderstatus") == "P",
        "tempo.ano": lambda: F.year(b.purchase()),
        "tempo.trimestre": lambda: F.quarter(b.purchase()),
        "tempo.mes": lambda: F.month(b.purchase()),
        "tempo.nome_mes": lambda: dates.pick_name(v.MONTH_NAMES, F.month(b.purchase())),
        "tempo.ano_mes": lambda: dates.year_month(b.purchase()),
        "prazo_estimado_dias": lambda: dates.days_between(b.purchase(), b.due()),
    }
    # Attributes of the delivery address.
    PLACE: dict[str, Callable[[], Column]] = {
        "geografia.cidade": lambda: text.normalize_label(b.city("c_custkey")),
        "geografia.estado": lambda: text.state_code(F.col("n_name")),
        "geografia.regiao": lambda: F.col("r_name"),
    }
    # Aggregates of the lines of an order, and the attributes made of them.
    LINES: dict[str, Callable[[], Column]] = {
        "valor_item": lambda: F.sum(b.price()),
        "valor_frete": lambda: F.sum(b.freight()),
        "itens": lambda: F.count("*"),
        "shipped": lambda: F.max("l_shipdate"),
        "payment": lambda: facts.main_payment(
            b.payment_value(), F.col("l_linenumber"), text.code(b.payment_type()), b.instalments()
        ),
        "review": lambda: facts.latest_review(
            b.score(), b.answered(), F.col("l_shipdate"), b.review_id()
        ),
    }
    SUMMARY: dict[str, tuple[str, Callable[[], Column]]] = {
        **{name: (name, lambda name=name: F.col(name)) for name in SALES},
        "prazo_entrega_dias": ("shipped", lambda: SourceStar._delivery(0)),
        "atraso_entrega_dias": ("shipped", lambda: SourceStar._delivery(2)),
        "flag_entregue_com_atraso": ("shipped", lambda: SourceStar._delivery(3)),
        "nota_avaliacao": ("review", lambda: F.col("review")),
        "pagamento.tipo_pagamento": ("payment", lambda: SourceStar._payment_label()),
    }
    ITEM: dict[str, Callable[[], Column]] = {
        "order_id": lambda: F.col("l_orderkey"),
        "sk_produto": lambda: F.col("l_partkey"),
        "sk_vendedor": lambda: F.col("l_suppkey"),
        "valor_item": b.price,
        "valor_frete": b.freight,
        "valor_total_item": lambda: (b.price() + b.freight()).cast("decimal(10,2)"),
    }

    @staticmethod
    def _delivery(position: int) -> Column:
        arrived = b.delivered(F.col("shipped"))
        return facts.delivery_measures(b.purchase(), b.due(), arrived)[position]

    @staticmethod
    def _payment_label() -> Column:
        label = dim_jobs.payment_label(F.col("payment.tipo_pagamento_original"))
        return F.when(F.col("payment").isNotNull(), label).otherwise(v.NOT_INFORMED)

    def sold_items(self, *columns: str) -> DataFrame:
        rows = self.source["lineitem"].select(
            F.col("l_orderkey").alias("parent"), *[self.ITEM[c]().alias(c) for c in columns]
        )
        return self._inherit(rows, (), sold=True).select(*columns)

    def rated_items(self, key: str) -> DataFrame:
        pairs = self.pair_sales(key, ("nota_avaliacao",), sold=False)
        rated = pairs.where(F.col("nota_avaliacao").isNotNull())
        return rated.groupBy(key, "nota_avaliacao").agg(F.sum("itens").alias("itens"))

    def orders(self, *columns: str) -> DataFrame:
        return self._order_rows(columns).select(
            *[self._attribute(c).alias(out) for out, c in _outputs(columns).items()]
        )

    def order_totals(
        self, measures: Measures, attributes: Sequence[str], columns: Sequence[str] = ()
    ) -> DataFrame:
        return self._totals(measures, attributes, columns, sold=False)

    def sales_totals(
        self,
        measures: Measures,
        attributes: Sequence[str],
        years: Iterable[int] = (),
        only: Slices | None = None,
    ) -> DataFrame:
        rows = self._totals(measures, attributes, SALES, sold=True)
        for attribute, values in (only or {}).items():
            rows = rows.where(F.col(attribute.split(".")[1]).isin(*values))
        return rows

    def pair_sales(
        self, key: str, attributes: Sequence[str], years: Iterable[int] = (), sold: bool = True
    ) -> DataFrame:
        """Lines are reduced to the pair before they meet the order, so an order with very
        many lines brings one row per product or seller to the join."""
        lines = self.source["lineitem"].select(
            F.col("l_orderkey").alias("parent"),
            *[self.ITEM[c]().alias(c) for c in (key, "valor_item", "valor_frete")],
        )
        pairs = lines.groupBy("parent", key).agg(*_sales_sums())
        return self._inherit(pairs, attributes, sold).select(
            F.col("parent").alias("order_id"), key, *SALES, *_outputs(attributes)
        )

    def dim(self, name: str, *columns: str) -> DataFrame:
        stg = self.source.staging
        if name == "produto":
            rows = dim_jobs.products(stg).withColumn("sk_produto", F.col("product_id"))
        elif name == "vendedor":
            rows = dim_jobs.sellers(stg, self.source.states)
            rows = rows.withColumn("sk_vendedor", F.col("seller_id"))
        else:
            rows = dim_jobs.customers(stg, self.source.states, self.recurring_above)
        return rows.select(*columns)

    def _attribute(self, name: str) -> Column:
        if name in self.SUMMARY:
            return self.SUMMARY[name][1]()
        return (self.HEAD | self.PLACE)[name]()

    def _order_rows(
        self, columns: Iterable[str], sold: bool = False, how: str = "left"
    ) -> DataFrame:
        """Orders with the aggregates of their lines and the address the columns need."""
        columns = set(columns)
        rows = self.source["orders"]
        if sold:
            rows = rows.where(~self.HEAD["status.flag_cancelado"]())
        aggregates = sorted({self.SUMMARY[c][0] for c in columns if c in self.SUMMARY})
        if aggregates:
            lines = self.source["lineitem"].groupBy("l_orderkey").agg(
                *[self.LINES[a]().alias(a) for a in aggregates]
            )
            rows = rows.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), how)
        return self._place(rows, columns)

    def _place(self, rows: DataFrame, columns: Iterable[str]) -> DataFrame:
        places = [c for c in columns if c in self.PLACE]
        if not places:
            return rows
        homes = self.source.located("customer", "c_nationkey")
        if "geografia.regiao" in places:
            homes = self.source.in_region(homes)
        return rows.join(homes, F.col("o_custkey") == F.col("c_custkey"))

    def _totals(
        self, measures: Measures, attributes: Sequence[str], columns: Sequence[str], sold: bool
    ) -> DataFrame:
        places = [c for c in attributes if c in self.PLACE]
        held = [c for c in attributes if c not in self.PLACE]
        rows = self._order_rows((*held, *columns), sold, "inner" if sold else "left")
        reduced = (
            rows.select(
                *[self._attribute(c).alias(out) for out, c in _outputs((*held, *columns)).items()],
                *(["o_custkey"] if places else []),
            )
            .groupBy(*_outputs(held), *(["o_custkey"] if places else []))
            .agg(*[m.alias(n) for n, m in measures.items()])
        )
        return self._place(reduced, places).select(
            *_outputs(held),
            *[self.PLACE[c]().alias(out) for out, c in _outputs(places).items()],
            *measures,
        )

    def _inherit(self, rows: DataFrame, columns: Sequence[str], sold: bool) -> DataFrame:
        """Add attributes of the order to rows that know their order as ``parent``; only
        orders that were not cancelled when ``sold``."""
        if not columns and not sold:
            return rows
        heads = self._order_rows(columns, sold).select(
            F.col("o_orderkey").alias("parent"),
            *[self._attribute(c).alias(out) for out, c in _outputs(columns).items()],
        )
        return rows.join(heads, "parent")


Star = StoredStar | SourceStar
