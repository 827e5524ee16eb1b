"""Vector codes: product quantisation whose Lloyd rounds compare a tree of parts with a tree of entries.

A vector becomes integers and is cut into equal parts; every part position has a codebook. Rows are
gathered into blocks of bounded size, and for each part position a block holds its parts in the
order of a balanced tree (widest dimension halved, down to leaves). The order is found once and
written; each pass over the blocks then walks the tree of parts and the tree of the codebook's
entries level by level, as pairs of nodes. A pair is dropped when the boxes' least distance exceeds
the smallest greatest distance that the part node has to any entry node. A part node left with one
entry is assigned whole, by its cached sums; leaves that stay uncertain compare integers with the
entries they have left. Ties go to the lower entry, so a pair goes only when it is strictly farther.

Only codebooks travel to the driver and back: parts x entries x components, a fixed size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from armazem.llm.runtime import batch, run_folder, ship, written

BLOCK, LEAF = 4096, 32
#: Integers up to this size keep distances and their tie-breaking inside 64 bits.
NARROW = 1 << 23
#: As many labels with their sums are broadcast at most; more are joined.
LABELS = 10_000


# Trees ------------------------------------------------------------------------------------------

def bounds(n: int, level: int) -> np.ndarray:
    """Where the 2^level nodes of a balanced tree over n sorted items begin, and the end."""
    return (np.arange((1 << level) + 1) * n) >> level


def ordered(x: np.ndarray, levels: int) -> np.ndarray:
    """Order of the rows of x in a tree of so many levels: each node halves its widest dimension."""
    order = np.arange(len(x))
    for level in range(levels):
        at = bounds(len(x), level)
        full = at[:-1][np.diff(at) > 0]
        own = x[order]
        wide = (np.maximum.reduceat(own, full) - np.minimum.reduceat(own, full)).argmax(1)
        node = np.repeat(np.arange(len(full)), np.diff(np.append(full, len(x))))
        order = order[np.lexsort((own[np.arange(len(x)), wide[node]], node))]
    return order


def depth(n: int, leaf: int) -> int:
    return max(0, (n // leaf).bit_length() - 1) if leaf > 1 else max(0, (n - 1).bit_length())


class Boxes:
    """Least and greatest corner of every node, by level; empty nodes are marked."""

    def __init__(self, x: np.ndarray, levels: int):
        self.at = [bounds(len(x), level) for level in range(levels + 1)]
        self.low, self.high = [], []
        for at in self.at:
            some = np.diff(at) > 0
            low, high = np.zeros((2, len(some), x.shape[1]), x.dtype)
            low[some] = np.minimum.reduceat(x, at[:-1][some])
            high[some] = np.maximum.reduceat(x, at[:-1][some])
            self.low.append(low)
            self.high.append(high)

    def full(self, level: int) -> np.ndarray:
        return np.diff(self.at[level]) > 0


def assigned(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(entry of each part, sums by entry, count by entry, parts whose distances were computed).

    x: parts in the order of their tree; entries: the codebook, in its own order.
    """
    n, k = len(x), len(entries)
    out = np.full(n, -1, np.int64)
    sums, counts = np.zeros((k, x.shape[1]), x.dtype), np.zeros(k, np.int64)
    running = np.zeros((n + 1, x.shape[1]), x.dtype)  # the cached sums: a node is the difference of two
    np.cumsum(x, axis=0, out=running[1:])
    shuffled = ordered(entries, depth(k, 1))
    parts, books = Boxes(x, depth(n, LEAF)), Boxes(entries[shuffled], depth(k, 1))
    last_p, last_e = len(parts.at) - 1, len(books.at) - 1
    p_level = e_level = 0
    pn, en = np.zeros(1, np.int64), np.zeros(1, np.int64)
    reach = np.full(1, np.iinfo(np.int64).max)
    while True:
        low = np.maximum(books.low[e_level][en] - parts.high[p_level][pn], parts.low[p_level][pn] - books.high[e_level][en])
        low = np.maximum(low, 0)
        far = np.maximum(parts.high[p_level][pn] - books.low[e_level][en], books.high[e_level][en] - parts.low[p_level][pn])
        least, most = (low * low).sum(1), (far * far).sum(1)
        np.minimum.at(reach, pn, most)
        near = least <= reach[pn]
        pn, en = pn[near], en[near]
        left = np.bincount(pn, minlength=len(reach))
        single = (np.diff(books.at[e_level])[en] == 1) & (left[pn] == 1)
        for node, e in zip(pn[single].tolist(), shuffled[books.at[e_level][en[single]]].tolist()):
            s, t = parts.at[p_level][node], parts.at[p_level][node + 1]
            out[s:t] = e
            sums[e] += running[t] - running[s]
            counts[e] += t - s
        pn, en = pn[~single], en[~single]
        if not len(pn) or (p_level == last_p and e_level == last_e):
            break
        if p_level < last_p:
            p_level += 1
            reach = np.repeat(reach, 2)
            pn, en = (np.repeat(pn * 2, 2) + np.tile([0, 1], len(pn))), np.repeat(en, 2)
        if e_level < last_e:
            e_level += 1
            pn, en = np.repeat(pn, 2), (np.repeat(en * 2, 2) + np.tile([0, 1], len(en)))
            some = books.full(e_level)[en]
            pn, en = pn[some], en[some]
    if not len(pn):
        return out, sums, counts, 0
    begin, size = parts.at[-1][pn], np.diff(parts.at[-1])[pn]
    point = np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)
    entry = np.repeat(shuffled[books.at[-1][en]], size)
    gap = x[point] - entries[entry]
    best = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(best, point, (gap * gap).sum(1) * k + entry)
    open_ = np.unique(point)
    out[open_] = best[open_] % k
    np.add.at(sums, out[open_], x[open_])
    counts += np.bincount(out[open_], minlength=k)
    return out, sums, counts, len(open_)


def plain(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The same entries by comparing all, in Python's integers: for values beyond NARROW."""
    gap = [((x - e) ** 2).sum(1) for e in entries]
    return np.array([min(range(len(entries)), key=lambda e: (gap[e][i], e)) for i in range(len(x))], np.int64)


# Blocks -----------------------------------------------------------------------------------------

def kept(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label and the vector's integers, of rows whose components are all finite."""
    vector = F.col(vector_col).cast("array<double>")
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), vector.alias("v"), good.alias("good"))
    return rows.where("good and size(v) > 0").select("vec_id", "label", F.transform(
        "v", lambda x: F.floor(x * 256).cast("long")).alias("v"))


def blocks(rows: DataFrame, parts: int, size: int) -> DataFrame:
    """Blocks of at most BLOCK vectors: ids, labels, integers, and the tree order of each part."""
    label = rows.schema["label"].dataType
    schema = pa.schema([("vec_id", pa.list_(pa.int64())), ("label", pa.list_(to_arrow_type(label))), ("v", pa.binary()), ("tree", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for at in range(0, rows.num_rows, BLOCK):
                own = rows.slice(at, BLOCK)
                n = own.num_rows
                v = own.column("v").flatten().to_numpy(zero_copy_only=False).reshape(n, parts, size)
                tree = np.stack([ordered(v[:, p], depth(n, LEAF)) for p in range(parts)]).astype(np.uint16)
                ends = pa.array([0, n], pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(ends, own.column("vec_id")), pa.ListArray.from_arrays(ends, own.column("label").cast(schema[1].type.value_type)),
                    pa.array([v.astype(np.int64).tobytes()], pa.binary()), pa.array([tree.tobytes()], pa.binary())], schema=schema)

    return rows.mapInArrow(run, f"vec_id array<long>, label array<{label.simpleString()}>, v binary, tree binary")


def unpacked(row: dict, parts: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    v = np.frombuffer(row["v"], np.int64).reshape(-1, parts, size)
    return v, np.frombuffer(row["tree"], np.uint16).reshape(parts, -1).astype(np.int64)


def nearest(v: np.ndarray, tree: np.ndarray, books: np.ndarray, p: int):
    """(entry of each row, sums, counts) of part p of a block."""
    widest = max(int(np.abs(v[:, p]).max()), int(np.abs(books[p]).max()))
    if widest > NARROW or v.shape[2] * len(books[p]) > 1 << 12:
        x, e = v[:, p].astype(object), books[p].astype(object)
        own = plain(x, e)
        sums = np.zeros(e.shape, object)
        np.add.at(sums, own, x)
        return own, sums, np.bincount(own, minlength=len(e))
    order = tree[p]
    found, sums, counts, _ = assigned(v[order, p], books[p])
    own = np.empty(len(v), np.int64)
    own[order] = found
    return own, sums, counts


def moved(packed: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one Lloyd round: each entry the floor of the mean of its parts."""
    parts, k, size = books.shape
    schema = pa.schema([("cell", pa.int32()), ("total", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((parts, k, size), object), np.zeros((parts, k), np.int64)
        for rows in batches:
            for row in rows.to_pylist():
                v, tree = unpacked(row, parts, size)
                for p in range(parts):
                    _, sums, counts = nearest(v, tree, books, p)
                    total[p] += sums
                    n[p] += counts
        some = np.flatnonzero(n.ravel())
        if len(some):
            cells = (some[:, None] * size + np.arange(size)).ravel()
            yield batch(schema, [cells.astype(np.int32), [str(t) for t in total.ravel()[cells]], n.ravel()[cells // size]])

    sums = packed.select("v", "tree").mapInArrow(run, "cell int, total string, n long").groupBy("cell").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    out = books.copy().reshape(-1)
    for cell, total, n in sums.collect():  # parts x entries x components rows
        out[cell] = int(total) // n
    return out.reshape(books.shape)


def coded(packed: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code and error of each vector."""
    parts, k, size = books.shape
    label = packed.schema["label"].dataType.elementType
    schema = pa.schema([("vec_id", pa.int64()), ("label", to_arrow_type(label)), ("code", pa.string()), ("error", pa.int64())])
    digits = np.array([f"{i:02x}" for i in range(k)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for i in range(rows.num_rows):
                v, tree = unpacked(rows.slice(i, 1).to_pylist()[0], parts, size)
                own = np.stack([nearest(v, tree, books, p)[0] for p in range(parts)], 1)
                entry = books[np.arange(parts), own]
                if max(int(np.abs(v).max()), int(np.abs(entry).max())) > NARROW:
                    v, entry = v.astype(object), entry.astype(object)
                error = ((v - entry) ** 2).sum((1, 2))
                yield pa.RecordBatch.from_arrays([
                    rows.column("vec_id")[i].values, rows.column("label")[i].values,
                    pa.array(["".join(r) for r in digits[own]], pa.string()),
                    pa.array([int(e) if e < 1 << 63 else None for e in error.tolist()], pa.int64())], schema=schema)

    return packed.mapInArrow(run, f"vec_id long, label {label.simpleString()}, code string, error long")


def quantised(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, id_col: str = "vec_id",
              vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error of each vector; codebooks as parts x entries x components).

    Rows whose vector is null or empty or holds null or non-finite components are left out. The
    first kept vector, by vec_id, whose length is a multiple of `parts` sets the length: vectors of
    another length are left out, too. A component is floor(256 x), held to the range of a long. Codebooks begin as the parts of
    the vectors with the smallest vec_ids (equal ids: by the vector; missing ids last); fewer
    vectors than entries make smaller codebooks. Repeated rows count and are returned each; a
    missing label or id is kept. An error (or sum of errors) beyond a long is null. No vector at all: no rows. Other
    columns are not read, so their names don't matter.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries: 1 to 256, as an index has two hex digits")
    spark = vectors.sparkSession
    ship(spark)
    rows = kept(vectors, id_col, vector_col, label_col).where(F.size("v") % parts == 0)
    first = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    lead = rows.select("vec_id", "v").orderBy(*first).limit(1).collect()
    length = len(lead[0].v) if lead else parts
    rows = rows.where(F.size("v") == length)
    seeds = rows.select("vec_id", "v").orderBy(*first).limit(entries).collect()
    size = length // parts
    books = np.array([r.v for r in seeds], np.int64).reshape(len(seeds), parts, size).swapaxes(0, 1).copy()
    packed = written(blocks(rows, parts, size), run_folder(spark, "codes"))
    if len(seeds):
        for _ in range(rounds):
            books = moved(packed, books)
    return coded(packed, books), books


def fingerprint(books: np.ndarray) -> str:
    """SHA-256 of all entries' components, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def judged(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """The contract's columns: errors also summed by label, and the codebooks' digest."""
    rows = written(rows, run_folder(rows.sparkSession, "codes-rows"))
    total = F.when(F.count("error") == F.count("*"), F.sum(F.col("error").cast("decimal(38,0)")))
    totals = written(rows.groupBy(F.col("label").alias("same")).agg(total.alias("label_error")),
                     run_folder(rows.sparkSession, "codes-labels"))
    if totals.count() <= LABELS:  # else a join that AQE may split
        totals = F.broadcast(totals)
    return rows.join(totals, F.col("label").eqNullSafe(F.col("same"))).select(
        "vec_id", "code", "error", F.col("label_error").try_cast("long").alias("label_error"),
        F.lit(fingerprint(books)).alias("codebooks_sha256"))
