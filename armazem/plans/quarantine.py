"""Raw rows on which strict casts would stop a load, set aside with the reason.

A load is strict unless it is given a quarantine: a bad number or date is an error then. With one, a
row that holds a value its table's load could not cast, or that has too few or too many fields, is
kept out of staging and listed with the column, the text and the reason; past a limit the load
fails all the same.
"""

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armazem import vocabulary as v
from armazem.functions import numbers
from armazem.functions.text import blank_to_null
from armazem.sources.rawfiles import MALFORMED

#: Columns that staged tables carry in a load with a quarantine.
REJECTED, FAULTS = "rejeitada", "falhas"
_FAULT = "array<struct<coluna:string,texto:string,motivo:string>>"


class TooManyRejects(ValueError):
    """A raw table has more bad rows than its load may leave out."""


@dataclass(frozen=True)
class Quarantine:
    """How many rows of a table may be left out: a number, a share of the rows read, or both."""

    most_rows: int | None = None
    most_share: float | None = None

    def exceeded(self, rejected: int, read: int) -> bool:
        return (self.most_rows is not None and rejected > self.most_rows) or (
            self.most_share is not None and rejected > self.most_share * read)


def _fails(kind: str, blank_is_missing: bool = False):
    def test(c: Column) -> Column:
        text = blank_to_null(c.cast("string")) if blank_is_missing else c
        return text.isNotNull() & text.try_cast(kind).isNull()

    return test


_WHEN, _WHOLE, _MONEY = _fails("timestamp_ntz"), _fails("int"), _fails(numbers.MONEY)
_MEASURE, _PLACE = _fails("decimal(12,4)", blank_is_missing=True), _fails("decimal(24,18)")

#: What the load casts: column, test of a value it could not cast, reason.
TYPED: Mapping[str, tuple] = {
    "orders": tuple((c, _WHEN, v.BAD_DATE) for c in (
        "order_purchase_timestamp", "order_approved_at", "order_delivered_customer_date", "order_estimated_delivery_date")),
    "order_items": (("order_item_id", _WHOLE, v.BAD_NUMBER), ("price", _MONEY, v.BAD_NUMBER), ("freight_value", _MONEY, v.BAD_NUMBER)),
    "order_payments": (("payment_sequential", _WHOLE, v.BAD_NUMBER), ("payment_installments", _WHOLE, v.BAD_NUMBER),
                       ("payment_value", _MONEY, v.BAD_NUMBER)),
    "order_reviews": (("review_score", _WHOLE, v.BAD_NUMBER), ("review_creation_date", _WHEN, v.BAD_DATE),
                      ("review_answer_timestamp", _WHEN, v.BAD_DATE)),
    "products": tuple((c, _MEASURE, v.BAD_NUMBER) for c in (
        "product_name_lenght", "product_description_lenght", "product_photos_qty", "product_weight_g", "product_length_cm",
        "product_height_cm", "product_width_cm")),
    "geolocation": (("geolocation_lat", _PLACE, v.BAD_NUMBER), ("geolocation_lng", _PLACE, v.BAD_NUMBER)),
}


def judged(rows: DataFrame, table: str) -> DataFrame:
    """The rows with what is wrong with them: `falhas` (column, text, reason each) and `rejeitada`."""
    def fault(column: Column, text: Column, reason: str) -> Column:
        return F.struct(column.alias("coluna"), text.cast("string").alias("texto"), F.lit(reason).alias("motivo"))

    found = [F.when(bad(F.col(c)), fault(F.lit(c), F.col(c), reason)) for c, bad, reason in TYPED.get(table, ())]
    if MALFORMED in rows.columns:
        # the fields of a malformed row are not to be trusted: its width is the one fault
        width = fault(F.lit(None).cast("string"), F.col(MALFORMED), v.BAD_WIDTH)
        found = [F.when(F.col(MALFORMED).isNotNull(), width)] + [
            F.when(F.col(MALFORMED).isNull(), f) for f in found]
    faults = F.array_compact(F.array(*found)) if found else F.array()
    return rows.withColumn(FAULTS, faults.cast(_FAULT)).withColumn(REJECTED, F.size(FAULTS) > 0).drop(MALFORMED)


def accepted(staged: DataFrame) -> DataFrame:
    """A staged table without its rejected rows; one staged strictly, as it is."""
    return staged.where(~F.col(REJECTED)).drop(REJECTED, FAULTS) if REJECTED in staged.columns else staged


def rejects(staged: DataFrame, table: str) -> DataFrame:
    """One row per fault of a staged table: tabela, linha (the whole raw row as JSON), coluna, texto,
    motivo."""
    columns = [c for c in staged.columns if c not in (REJECTED, FAULTS)]
    return staged.where(REJECTED).select(
        F.lit(table).alias("tabela"), F.to_json(F.struct(*columns)).alias("linha"), F.inline(FAULTS))
