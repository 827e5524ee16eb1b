"""What the operators share: the shared folder, written intermediate tables, input columns."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armazem.sources.sinks import shared_folder

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver imported it.

    On a cluster the package is installed or sent with the application as usual; this only
    helps sessions whose workers start in another folder.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder of this run inside the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back, so that later steps survive lost executors."""
    rows.write.mode("error").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, as doc_id long and text string (null: empty).

    Every other column is left out here, so none can clash with columns made later.
    """
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def parts(spark: SparkSession, least: int = 1) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def crc(column) -> "F.Column":
    """crc32 of an id written as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def batch(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)],
        schema=schema)


def give_back() -> None:
    """Return freed memory to the system. Arrow and the C library keep it otherwise, and a worker
    goes on to further tasks and queries with what it needed most for any of them."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
        trim(0)


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in runs of at most `most` bytes of text, one row at least."""
    for rows in batches:
        yield from cut(rows, column, most)
        del rows
        give_back()


def cut(rows: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The same of one batch."""
    import numpy as np

    if not rows.num_rows:
        return
    ends = byte_offsets(rows.column(column))[0][1:]
    at = 0
    while at < rows.num_rows:
        floor = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, floor + most, side="right")))
        yield rows.slice(at, upto - at)
        at = upto


def byte_offsets(column: pa.Array):
    """(offsets from 0, bytes) of a string or binary column without nulls, not copied."""
    import numpy as np

    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[
        column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0]:offsets[-1]]
