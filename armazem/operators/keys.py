"""Dense surrogate keys."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from armazem.sources.sinks import write_table

# Three hex digits: 4,096 evenly filled buckets, whatever the keys look like.
_BUCKET_DIGITS = 3


def key_bucket(key: Column) -> Column:
    return F.substring(F.md5(key.cast("string")), 1, _BUCKET_DIGITS)


def with_dense_key(rows: DataFrame, natural: str, name: str, through: str | None = None) -> DataFrame:
    """Number the rows 1..n by (hash bucket, natural key).

    The number depends on the set of natural keys only, so a re-run gives the same keys
    on any partitioning. Rows are numbered inside their bucket in parallel; only the
    per-bucket counts (at most 4,096 rows) meet in one task to become offsets.

    The rows are needed twice, for the counts and for the numbers. With ``through``, a new
    folder all executors share, they are written there first, so that what makes them runs once.
    """
    bucket = key_bucket(F.col(natural))
    tagged = rows.withColumn("bucket", bucket)
    if through:
        tagged = write_table(tagged, through)
    sizes = tagged.groupBy("bucket").agg(F.count("*").alias("size"))
    before = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset")
    )
    inside = W.partitionBy("bucket").orderBy(F.col(natural))
    return (
        tagged.withColumn("position", F.row_number().over(inside))
        .join(F.broadcast(offsets), "bucket")
        .select((F.col("offset") + F.col("position")).alias(name), *rows.columns)
    )


def with_ordered_key(rows: DataFrame, name: str, *order: str) -> DataFrame:
    """Number a handful of domain values in the given order (one task, code lists only)."""
    numbered = F.row_number().over(W.orderBy(*order)).cast("bigint")
    return rows.select(numbered.alias(name), *rows.columns)
