"""Keep one row per key without sending the whole group to one task.

An aggregate over a struct combines on the map side, so a key that holds a large part of
the rows reaches the reducer as one candidate per task.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def smallest_per_key(rows: DataFrame, key: str) -> DataFrame:
    """One row per non-null key; equal keys resolve to the smallest row, column by column."""
    others = [c for c in rows.columns if c != key]
    picked = (
        rows.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(F.struct(*others)).alias("row"))
    )
    return picked.select(key, "row.*").select(*rows.columns)


def last_by(values: Sequence[Column], ordering: Sequence[Column]) -> Column:
    """Aggregate: the values at the largest ordering; NULL sorts lowest, i.e. last in a
    descending list."""
    return F.max_by(F.struct(*values), F.struct(*ordering))
