"""Large CSV files with quoted line breaks, read by many tasks.

A line break ends a record unless it stands inside quotes, which a task that starts in the middle of
a file cannot see. In a file as RFC 4180 has it, a quote only opens, closes or doubles inside quotes,
so a break is real exactly when an even number of quotes stands before it. One scan counts the
quotes of every block of a file; a running sum over a file's blocks (one row each) tells whether a
block begins inside quotes; then all blocks put their lines together to records side by side. A
record that crosses blocks leaves a fragment in each of them, and fragments are joined by file.
Spark's own CSV parser reads the finished records, so quotes, missing values and errors are those
of its reader.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Blocks that begin inside quotes are sent to all tasks up to this number (a short row each);
#: more of them are joined, and the lines of a block brought back into order.
MOST_SENT = 100_000

_PIECES = "file string, first boolean, record string, block long, part int, opens boolean"


def lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, block, line, value): every line up to its line feed, in blocks as Spark splits files.

    line grows inside a block and means nothing beyond it. A line belongs to the block it begins in.
    """
    rows = spark.read.option("lineSep", "\n").text(paths)
    return rows.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value")


def quotes(value: Column) -> Column:
    return F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))


def survey(rows: DataFrame) -> DataFrame:
    """One row per block of lines(): file, block, header (of a file's first block), n_lines, n_quotes."""
    return rows.groupBy("file", "block").agg(
        F.min_by(F.when(F.col("block") == 0, F.col("value")), "line").alias("header"),
        F.count("*").alias("n_lines"), F.sum(quotes(F.col("value"))).alias("n_quotes"))


def inside_quotes(blocks: DataFrame) -> DataFrame:
    """(file, block) of the blocks that begin inside quotes."""
    before = F.sum("n_quotes").over(W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    return blocks.withColumn("before", before).where("before % 2 = 1").select("file", "block")


def pieces(rows: DataFrame, inside: DataFrame, fragments: bool) -> DataFrame:
    """Whole records of every block, or the fragments at its ends.

    rows: as lines() gives them; inside: blocks that begin inside quotes. A record: file, whether it
    is its file's first, record. A fragment also has its block, its part (0 at the beginning of the
    block, 1 at the end) and whether a record begins with it.
    """
    marked = inside.withColumn("open", F.lit(True))
    if inside.count() <= MOST_SENT:
        rows = rows.join(F.broadcast(marked), ["file", "block"], "left")
    else:
        rows = rows.join(marked, ["file", "block"], "left").repartition("file", "block").sortWithinPartitions("file", "block", "line")
    rows = rows.select("file", "block", F.col("open").isNotNull().alias("open"), "value")
    return rows.mapInArrow(lambda batches: _grouped(batches, fragments), _PIECES)


def _grouped(batches: Iterator, fragments: bool) -> Iterator:
    import numpy as np
    import pyarrow as pa

    schema = pa.schema([("file", pa.string()), ("first", pa.bool_()), ("record", pa.string()), ("block", pa.int64()),
                        ("part", pa.int32()), ("opens", pa.bool_())])

    def batch(file: str, records: pa.Array, block: int, first: bool = False, part: int | None = None, opens: bool | None = None):
        n = len(records)
        return pa.RecordBatch.from_arrays([
            pa.array([file] * n, pa.string()), pa.array([first] + [False] * (n - 1), pa.bool_()), records,
            pa.array([block] * n, pa.int64()), pa.array([part] * n, pa.int32()), pa.array([opens] * n, pa.bool_())], schema=schema)

    def texts(ends, body: bytes) -> pa.Array:
        return pa.StringArray.from_buffers(len(ends), pa.py_buffer(np.append(0, ends).astype(np.int32).tobytes()), pa.py_buffer(body))

    def text(rows: list[bytes]) -> pa.Array:
        body = b"\n".join(rows)
        return texts([len(body)], body)

    now, held, head, odd, started = None, [], False, 0, False

    def end():
        """What is left when a block ends: the fragment that the next block goes on with."""
        if fragments and now and held:
            yield batch(now[0], text(held), now[1], part=0 if head else 1, opens=not head)

    for rows in batches:
        files, blocks = rows.column("file"), rows.column("block").to_numpy(zero_copy_only=False)
        n = rows.num_rows
        if not n:
            continue
        names = files.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(names) != 0)) + 1
        for s, e in zip([0, *edges.tolist()], [*edges.tolist(), n]):
            key = (files[s].as_py(), int(blocks[s]))
            if key != now:
                yield from end()
                now, held, started = key, [], False
                head = rows.column("open")[s].as_py()
                odd = int(head)
            offsets, data = _bytes(rows.column("value").slice(s, e - s))
            marks = np.concatenate([[0], np.cumsum(data == 34)])
            after = (odd + marks[offsets[1:]]) % 2
            odd = int(after[-1])
            closing = np.flatnonzero(after == 0)
            if not len(closing):
                held.append(_broken(offsets, data, 0, e - s))
                continue
            at = 0
            if held or head:  # the open record ends here
                at = int(closing[0]) + 1
                held.append(_broken(offsets, data, 0, at))
                if head and fragments:
                    yield batch(now[0], text(held), now[1], part=0, opens=False)
                elif not head and not fragments:
                    yield batch(now[0], text(held), now[1], first=not started and now[1] == 0)
                started, head, held = True, False, []
                closing = closing[1:]
            if len(closing) and not fragments:
                stop = int(closing[-1]) + 1
                body = data[offsets[at]:offsets[stop]]
                ends = offsets[at + 1:stop + 1] - offsets[at]
                inner = np.flatnonzero(after[at:stop] == 1)
                body = np.insert(body, ends[inner], 10)
                shift = np.concatenate([[0], np.cumsum(after[at:stop] == 1)])
                records = texts((ends + shift[:-1])[closing - at], body.tobytes())
                yield batch(now[0], records, now[1], first=not started and now[1] == 0)
            if len(closing):
                started, at = True, int(closing[-1]) + 1
            if at < e - s:
                held.append(_broken(offsets, data, at, e - s))
    yield from end()


def _bytes(column):
    import numpy as np
    import pyarrow as pa

    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0]:offsets[-1]]


def _broken(offsets, data, first: int, stop: int) -> bytes:
    """Lines first..stop-1 of a column, joined by line feeds."""
    import numpy as np

    return np.insert(data[offsets[first]:offsets[stop]], offsets[first + 1:stop] - offsets[first], 10).tobytes()


def joined(fragments: DataFrame) -> DataFrame:
    """(file, record) of the records that cross blocks."""
    chain = F.sum(F.col("opens").cast("int")).over(W.partitionBy("file").orderBy("block", "part"))
    each = F.array_sort(F.collect_list(F.struct("block", "part", "record")))
    return fragments.withColumn("chain", chain).groupBy("file", "chain").agg(
        F.array_join(F.transform(each, lambda x: x["record"]), "\n").alias("record")).select("file", "record")


def records(spark: SparkSession, paths: str | Sequence[str], blocks: DataFrame) -> DataFrame:
    """(file, record) of every record below its file's header; blocks: survey() of the same paths,
    written, as it is read more than once.

    Empty lines are no records, and a carriage return before a record's line feed is not part of it.
    Files that end inside quotes end with an unfinished record. A header stands in one line.
    """
    rows = lines(spark, paths)
    inside = inside_quotes(blocks)
    whole = pieces(rows, inside, fragments=False).where("not first").select("file", "record")
    crossing = joined(pieces(rows, inside, fragments=True)).select("file", "record")
    every = whole.unionByName(crossing)
    return every.select("file", F.regexp_replace("record", "\r$", "").alias("record")).where("record != ''")


def parsed(rows: DataFrame, columns: Sequence[str], options: Mapping[str, str], *also: str) -> DataFrame:
    """Records by Spark's CSV parser: one text column each, and other columns of the rows."""
    ddl = ", ".join(f"`{c}` string" for c in columns)
    return rows.select(*also, F.from_csv("record", ddl, {k: str(v) for k, v in options.items()}).alias("r")).select(*also, "r.*")
