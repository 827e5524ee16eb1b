"""Table and report sinks, and the shared folder for written intermediate tables."""

import tempfile
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_folders: dict[str, str] = {}

# Of written tables: they hold many alike texts and keys, and writing them is much of a load.
COMPRESSION = "zstd"

# Quotes doubled inside quotes, blanks kept, NULL and empty text both as an empty field.
CSV_WRITE = {
    "emptyValue": "",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as the session names it.

    Only a local session (tests) falls back to a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="armazem-")
    return _own_folders[context.applicationId]


def write_table(rows: DataFrame, path: str) -> DataFrame:
    """Full reload of a table; returns the written table."""
    rows.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
    return rows.sparkSession.read.parquet(path)


def export_report(report: DataFrame, path: str) -> None:
    """One headered CSV file; reports are short, so a single writer is enough. NULL is
    written as an empty field."""
    (
        report.coalesce(1)
        .write.mode("overwrite")
        .option("header", True)
        .options(**CSV_WRITE)
        .csv(path)
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows, in the given order."""
    counted = [
        t.agg(F.count("*").alias("registros")).select(
            F.lit(i).alias("ordem"), F.lit(name).alias("tabela"), "registros"
        )
        for i, (name, t) in enumerate(tables.items(), 1)
    ]
    return reduce(DataFrame.unionByName, counted)
