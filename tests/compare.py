"""Run registered queries against their SQL on DuckDB and compare as unordered rows.

    python tests/compare.py [folder] [name-prefix ...]
"""

import os
import sys
import time
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import oracles  # noqa: E402
import registry  # noqa: E402

NAMES_OF_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def local_session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(folder: str, parts: str = "") -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in NAMES_OF_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet{parts}'")
    return con


def difference(spark: SparkSession, con, folder: str, name: str) -> str:
    """Empty when both sides have the same columns and rows."""
    result = registry.QUERIES[name](spark, folder)
    columns = sorted(result.columns)
    rows = Counter(tuple(r[c] for c in columns) for r in result.collect())
    cursor = con.execute(oracles.all_queries()[name])
    names = [d[0] for d in cursor.description]
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    types = {d[0]: str(d[1]) for d in cursor.description}
    order = [names.index(c) for c in columns]
    expected = Counter(tuple(r[i] for i in order) for r in cursor.fetchall())
    spark_types = {f.name: f.dataType.simpleString() for f in result.schema}
    pairs = {c: (spark_types[c], types[c]) for c in columns}
    odd = {c: p for c, p in pairs.items() if not same_type(*p)}
    if rows != expected:
        extra, lacking = list((rows - expected).items())[:3], list((expected - rows).items())[:3]
        return f"{sum(rows.values())} vs {sum(expected.values())} rows; {columns}; +{extra} -{lacking}"
    return f"types {odd}" if odd else ""


def same_type(spark_type: str, duck_type: str) -> bool:
    names = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN",
             "date": "DATE", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}
    return names.get(spark_type, spark_type).upper() == duck_type.upper()


if __name__ == "__main__":
    where = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:]) or ("",)
    spark, con = local_session(), duck(where)
    bad = 0
    for name in registry.QUERIES:
        if not name.startswith(prefixes):
            continue
        start = time.time()
        if name not in oracles.all_queries():
            n = registry.QUERIES[name](spark, where).count()
            print(f"{name:32s} rows only: {n} ({time.time() - start:.1f}s)", flush=True)
            continue
        problem = difference(spark, con, where, name)
        bad += bool(problem)
        print(f"{name:32s} {problem or 'ok'} ({time.time() - start:.1f}s)", flush=True)
    print("different:", bad)
