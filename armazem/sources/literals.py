"""Literal relations: short fixed lists as one-partition DataFrames."""

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_rows(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """Rows written in the plan itself: no Python serialisation, one partition, and a size
    estimate small enough for the optimizer to broadcast."""
    fields = T.StructType.fromDDL(schema).fields
    structs = [
        F.struct(*[F.lit(x).cast(f.dataType).alias(f.name) for x, f in zip(row, fields)])
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))
