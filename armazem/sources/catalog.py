"""The nine raw tables: column names, file name ending and whether text may hold line breaks."""

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class RawTable:
    columns: tuple[str, ...]
    file_ending: str
    free_text: bool = False

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


# The column names are the headers of the files ("lenght" included).
RAW_TABLES = {
    "orders": RawTable(
        (
            "order_id", "customer_id", "order_status", "order_purchase_timestamp",
            "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date",
        ),
        "orders_dataset.csv",
    ),
    "order_items": RawTable(
        (
            "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
            "price", "freight_value",
        ),
        "order_items_dataset.csv",
    ),
    "order_payments": RawTable(
        (
            "order_id", "payment_sequential", "payment_type", "payment_installments",
            "payment_value",
        ),
        "order_payments_dataset.csv",
    ),
    "order_reviews": RawTable(
        (
            "review_id", "order_id", "review_score", "review_comment_title",
            "review_comment_message", "review_creation_date", "review_answer_timestamp",
        ),
        "order_reviews_dataset.csv",
        free_text=True,
    ),
    "customers": RawTable(
        (
            "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
            "customer_state",
        ),
        "customers_dataset.csv",
    ),
    "products": RawTable(
        (
            "product_id", "product_category_name", "product_name_lenght",
            "product_description_lenght", "product_photos_qty", "product_weight_g",
            "product_length_cm", "product_height_cm", "product_width_cm",
        ),
        "products_dataset.csv",
    ),
    "sellers": RawTable(
        ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
        "sellers_dataset.csv",
    ),
    "geolocation": RawTable(
        (
            "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
            "geolocation_city", "geolocation_state",
        ),
        "geolocation_dataset.csv",
    ),
    "category_translation": RawTable(
        ("product_category_name", "product_category_name_english"),
        "product_category_name_translation.csv",
    ),
}
