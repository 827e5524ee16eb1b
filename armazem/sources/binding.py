"""The provided test tables in the shape of the raw tables.

Orders, lines, customers, suppliers and parts become orders, items, payments, reviews,
customers, sellers, products and positions. Columns keep their types instead of going
through text; the jobs accept both.
"""

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from armazem.functions import text
from armazem.sources.lazy import LazyTables

NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
DUE_DAYS = 730

# Fixed values of the binding: source code -> code used by the raw tables.
STATUS_CODES = (("F", "delivered"), ("O", "unavailable"), ("P", "canceled"))
PAYMENT_CODES = (
    ("AF", "credit_card"),
    ("AO", "boleto"),
    ("NF", "voucher"),
    ("NO", "debit_card"),
    ("RF", "not_defined"),
    ("RO", "gift_card"),
)


def _decode(c: Column, codes: tuple[tuple[str, str], ...]) -> Column:
    (first, label), *rest = codes
    chain = F.when(c == first, label)
    for code, label in rest:
        chain = chain.when(c == code, label)
    return chain


# --- expressions over the source columns, shared with the direct star -------------------------



def purchase() -> Column:
    return F.col("o_orderdate")


def due() -> Column:
    return purchase() + F.expr(f"interval {DUE_DAYS} days")


def approved() -> Column:
    return F.when(
        F.col("o_orderpriority") != "4-NOT SPECIFIED", purchase() + F.expr("interval 1 day")
    )


def status() -> Column:
    return _decode(F.col("o_orderstatus"), STATUS_CODES)


def price() -> Column:
    return F.col("l_extendedprice").cast("decimal(12,2)").cast("decimal(10,2)")


def freight() -> Column:
    return F.round(price() * F.col("l_tax").cast("decimal(4,2)"), 2).cast("decimal(10,2)")


def payment_type() -> Column:
    return _decode(F.concat("l_returnflag", "l_linestatus"), PAYMENT_CODES)


def instalments() -> Column:
    return F.col("l_quantity").cast("int") % 14 + 1


def payment_value() -> Column:
    return (price() + freight()).cast("decimal(10,2)")


def score() -> Column:
    quantity = F.col("l_quantity").cast("int")
    return F.when(quantity % 7 != 0, quantity % 5 + 1)


def answered() -> Column:
    line = F.col("l_linenumber")
    return F.when(line % 3 != 0, F.col("l_shipdate") + F.make_dt_interval(days=line))


def review_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def delivered(last_shipment: Column) -> Column:
    """The last shipment counts as delivery unless it lies before the purchase."""
    return F.when(last_shipment >= purchase(), last_shipment)


def city(key: str) -> Column:
    return F.concat_ws(" ", F.col("n_name"), (F.col(key) % 40).cast("string"))


def zip_code(nation: str, key: str) -> Column:
    """Unpadded zip prefix; it settles nation and city, as in a real address list."""
    return (F.col(nation) * 1000 + F.col(key) % 1000).cast("string")


class Source:
    """The provided tables of one folder and their raw-table views."""

    def __init__(self, spark: SparkSession, folder: str):
        self._tables = LazyTables({
            n: lambda n=n: spark.read.parquet(f"{folder}/{n}.parquet") for n in NAMES
        })

    def __getitem__(self, name: str) -> DataFrame:
        return self._tables[name]

    def located(self, name: str, nation: str) -> DataFrame:
        """Customers or suppliers with their nation, a table of 25 rows."""
        return self[name].join(self["nation"], F.col(nation) == F.col("n_nationkey"))

    def in_region(self, rows: DataFrame) -> DataFrame:
        return rows.join(self["region"], F.col("n_regionkey") == F.col("r_regionkey"))

    @cached_property
    def states(self) -> DataFrame:
        return self.in_region(self["nation"]).select(
            text.state_code(F.col("n_name")).alias("uf"),
            text.category_label(F.col("n_name")).alias("nome_estado"),
            F.col("r_name").alias("regiao"),
        )

    @cached_property
    def staging(self) -> Mapping[str, DataFrame]:
        return LazyTables({
            "orders": self._orders,
            "order_items": self._items,
            "order_payments": self._payments,
            "order_reviews": self._reviews,
            "customers": self._customers,
            "products": self._products,
            "sellers": self._sellers,
            "geolocation": self._positions,
            "category_translation": self._translation,
        })

    def _orders(self) -> DataFrame:
        shipped = self["lineitem"].groupBy("l_orderkey").agg(F.max("l_shipdate").alias("shipped"))
        return (
            self["orders"]
            .join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .select(
                F.col("o_orderkey").alias("order_id"),
                F.col("o_custkey").alias("customer_id"),
                status().alias("order_status"),
                purchase().alias("order_purchase_timestamp"),
                approved().alias("order_approved_at"),
                F.lit(None).cast("timestamp_ntz").alias("order_delivered_carrier_date"),
                delivered(F.col("shipped")).alias("order_delivered_customer_date"),
                due().alias("order_estimated_delivery_date"),
            )
        )

    def _items(self) -> DataFrame:
        return self["lineitem"].select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            price().alias("price"),
            freight().alias("freight_value"),
        )

    def _payments(self) -> DataFrame:
        return self["lineitem"].select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("payment_sequential"),
            payment_type().alias("payment_type"),
            instalments().alias("payment_installments"),
            payment_value().alias("payment_value"),
        )

    def _reviews(self) -> DataFrame:
        return self["lineitem"].select(
            review_id().alias("review_id"),
            F.col("l_orderkey").alias("order_id"),
            score().alias("review_score"),
            F.lit(None).cast("string").alias("review_comment_title"),
            F.lit(None).cast("string").alias("review_comment_message"),
            F.col("l_shipdate").alias("review_creation_date"),
            answered().alias("review_answer_timestamp"),
        )

    def _customers(self) -> DataFrame:
        return self.located("customer", "c_nationkey").select(
            F.col("c_custkey").alias("customer_id"),
            F.expr("c_custkey div 2").alias("customer_unique_id"),
            zip_code("c_nationkey", "c_custkey").alias("customer_zip_code_prefix"),
            city("c_custkey").alias("customer_city"),
            F.col("n_name").alias("customer_state"),
        )

    def _sellers(self) -> DataFrame:
        return self.located("supplier", "s_nationkey").select(
            F.col("s_suppkey").alias("seller_id"),
            zip_code("s_nationkey", "s_suppkey").alias("seller_zip_code_prefix"),
            city("s_suppkey").alias("seller_city"),
            F.col("n_name").alias("seller_state"),
        )

    def _positions(self) -> DataFrame:
        def place(balance: str, zip_prefix: Column, town: Column) -> list[Column]:
            amount = F.col(balance).cast("decimal(12,2)")
            return [
                zip_prefix.alias("geolocation_zip_code_prefix"),
                (amount * F.expr("0.001BD")).alias("geolocation_lat"),
                (F.expr("-35BD") - amount * F.expr("0.002BD")).alias("geolocation_lng"),
                town.alias("geolocation_city"),
                F.col("n_name").alias("geolocation_state"),
            ]

        homes = self.located("customer", "c_nationkey").select(
            *place("c_acctbal", zip_code("c_nationkey", "c_custkey"), F.col("c_mktsegment"))
        )
        depots = self.located("supplier", "s_nationkey").select(
            *place(
                "s_acctbal",
                (F.col("s_nationkey") + 50000).cast("string"),
                F.concat(F.lit("depot "), (F.col("s_suppkey") % 3).cast("string")),
            )
        )
        return homes.unionByName(depots)

    def _products(self) -> DataFrame:
        size = F.col("p_size")
        return self["part"].select(
            F.col("p_partkey").alias("product_id"),
            F.when(F.col("p_partkey") % 97 != 0, F.replace(F.lower("p_brand"), F.lit("#"), F.lit("_")))
            .alias("product_category_name"),
            F.length("p_name").alias("product_name_lenght"),
            F.length(F.concat("p_name", "p_type")).alias("product_description_lenght"),
            (size % 7).alias("product_photos_qty"),
            F.when(size % 13 != 0, size * F.expr("250.5BD")).alias("product_weight_g"),
            size.alias("product_length_cm"),
            (size % 20 + 1).alias("product_height_cm"),
            (size * F.expr("0.5BD") + 1).alias("product_width_cm"),
        )

    def _translation(self) -> DataFrame:
        brands = self["part"].where(~F.col("p_brand").endswith("5")).select("p_brand").distinct()
        return brands.select(
            F.replace(F.lower("p_brand"), F.lit("#"), F.lit("_")).alias("product_category_name"),
            F.replace(F.lower("p_brand"), F.lit("brand#"), F.lit("label_")).alias(
                "product_category_name_english"
            ),
        )
