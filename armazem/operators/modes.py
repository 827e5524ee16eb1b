"""Most frequent values per key, in two counting rounds."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile_per_key(
    rows: DataFrame, key: str, modes: Sequence[str], sums: Sequence[str] = ()
) -> DataFrame:
    """Per key: row count, the mode of each listed column and the sums of others.

    Ties go to the smallest value and NULLs never win. Combinations are counted first, then
    each value, then the best value per key is taken, so no aggregation buffer grows with
    the number of distinct values of a key and a hot key is combined on the map side.
    """
    combos = rows.groupBy(key, *modes).agg(
        F.count("*").alias("n"), *[F.sum(s).alias(s) for s in sums]
    )
    slots = F.array(*[
        F.struct(
            F.lit(i).alias("slot"),
            F.col(m).alias("value"),
            *[(F.col(s) if i == 0 else F.lit(None)).alias(s) for s in sums],
        )
        for i, m in enumerate(modes)
    ])
    counted = (
        combos.select(key, "n", F.inline(slots))
        .groupBy(key, "slot", "value")
        .agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in sums])
    )
    picks = []
    for i, m in enumerate(modes):
        candidate = F.when(
            (F.col("slot") == i) & F.col("value").isNotNull(), F.struct(-F.col("n"), F.col("value"))
        )
        picks.append(F.min_by("value", candidate).alias(m))
    return counted.groupBy(key).agg(
        F.sum(F.when(F.col("slot") == 0, F.col("n"))).alias("n"),
        *picks,
        *[F.sum(s).alias(s) for s in sums],
    )
