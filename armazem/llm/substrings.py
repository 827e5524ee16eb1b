"""Removal of long repeated passages, by suffix trees partitioned by variable-length prefixes.

Every word of every document begins a suffix. Suffixes are dealt into groups by their first
words: by the first word where few enough suffixes share it, else by more words (`DEPTHS`), so
that a group fits into a task's memory. Of a group's suffix tree only the internal nodes at
least `window` words deep matter: the suffixes below one begin with the same `window` words. A
node is known by the fingerprint of its path label, so a suffix travels as 8 bytes and its
place, packed by block of documents. Suffixes below a node that also leads to a smaller document
are repeats; runs of them are the maximal repeated passages.

A node met more often than a group may hold (a passage in a large part of all documents) is left
out of the groups: its smallest document comes from a Spark aggregation that combines on the map
side. Counts of prefixes are kept in tables of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armazem.llm import words
from armazem.llm.runtime import batch, byte_offsets, parts, run_folder, ship, slices, written

CELLS = 1 << 16
_SLICE = 4 << 20
_LEAST = np.iinfo(np.int64).min  # sorts where a null id does: first


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and a hash of the text, so that rows that share an id are told apart."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tkey"))


def depths(window: int) -> list[int]:
    return [d for d in (1, 2, 4) if d < window] + [window]


def suffixes(rows: pa.RecordBatch, window: int):
    """(words, first word of each window, window hash, cell of its prefix at each depth)."""
    w = words.words(*byte_offsets(rows.column("text")))
    h = w.hashes()[0]
    begin, label = words.windows(h, w.first, window)
    cells = [(words.run_hash(h, begin, d) >> np.uint64(48)).astype(np.int64) for d in depths(window)[:-1]]
    return w, begin, label, [*cells, (label >> np.uint64(48)).astype(np.int64)]


def prefix_counts(docs: DataFrame, window: int) -> np.ndarray:
    """Suffixes by cell of their prefix, one row a depth; at most 4 x 65536 figures."""
    schema = pa.schema([("cell", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(depths(window)), CELLS), np.int64)
        for rows in slices(batches, "text", _SLICE):
            for k, c in enumerate(suffixes(rows, window)[3]):
                total[k] += np.bincount(c, minlength=CELLS)
        flat = total.ravel()
        some = np.flatnonzero(flat)
        if len(some):
            yield batch(schema, [some.astype(np.int32), flat[some]])

    out = np.zeros(len(depths(window)) * CELLS, np.int64)
    for cell, n in docs.select("text").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toLocalIterator():
        out[cell] = n
    return out.reshape(-1, CELLS)


def narrow(values: np.ndarray) -> bytes:
    """Integers as byte planes, packed."""
    import zstandard

    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return zstandard.compress(planes.tobytes(), 1)


def widen(packed: bytes, kind) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def ids_of(rows: pa.RecordBatch) -> np.ndarray:
    return rows.column("doc_id").fill_null(_LEAST).to_numpy(zero_copy_only=False)


def repeats(docs: DataFrame, window: int = 13, most: int = 2_000_000) -> tuple[DataFrame, int]:
    """Windows whose words also start in a smaller doc_id, as marked() packs them, and the number
    of buckets of documents.

    docs: as keyed() gives them.
    """
    spark = docs.sparkSession
    ship(spark)
    counts = prefix_counts(docs, window)
    groups = max(parts(spark), int(-(-counts[0].sum() // most)))
    fine = counts <= most
    depth_n = len(depths(window))
    hot_any = bool((~fine[-1]).any())

    def grouped(cells: list[np.ndarray]) -> np.ndarray:
        """Group of each suffix: by the shortest prefix that few enough share; -1: hot node."""
        part = np.full(len(cells[0]), -1, np.int64)
        for k in range(depth_n):
            free = (part < 0) & fine[k][cells[k]]
            label = words.mixed(cells[k][free].astype(np.uint64) + np.uint64(k * CELLS + 1))
            part[free] = (label % np.uint64(groups)).astype(np.int64)
        return part

    packed = pa.schema([("part", pa.int32()), ("label", pa.binary()), ("place", pa.binary()), ("n", pa.binary()),
                        ("ids", pa.binary()), ("keys", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text", _SLICE):
            w, begin, label, cells = suffixes(rows, window)
            if not len(begin):
                continue
            part = grouped(cells)
            order = np.argsort(part.astype(np.int16 if groups < 1 << 15 else np.int64), kind="stable")
            order = order[np.searchsorted(part[order], 0):]
            text = np.searchsorted(w.first, begin, side="right") - 1
            place = (begin - w.first[text]).astype(np.uint32)
            edges = np.flatnonzero(np.diff(part[order], prepend=-2))
            ids, keys = ids_of(rows), rows.column("tkey").to_numpy(zero_copy_only=False)
            out = []
            for s, e in zip(edges.tolist(), [*edges[1:].tolist(), len(order)]):
                own = order[s:e]
                which, n = np.unique(text[own], return_counts=True)
                out.append((int(part[own[0]]), label[own].tobytes(), narrow(place[own]), narrow(n.astype(np.uint32)),
                            narrow(ids[which]), narrow(keys[which])))
            for s in range(0, len(out), 64):
                yield batch(packed, zip(*out[s:s + 64]))

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for rows in batches:
            for r in rows.to_pylist():
                if r["part"] != now and held:
                    yield from deep(held)
                    held = []
                now = r["part"]
                held.append((np.frombuffer(r["label"], np.uint64), widen(r["place"], np.uint32), widen(r["n"], np.uint32),
                             widen(r["ids"], np.int64), widen(r["keys"], np.int64)))
        if held:
            yield from deep(held)

    def deep(held: list) -> Iterator[pa.RecordBatch]:
        """Suffixes of a group below a node of depth `window` that leads to a smaller document."""
        label, place, n, ids, keys = (np.concatenate(x) for x in zip(*held))
        held.clear()
        row = np.repeat(np.arange(len(n)), n)
        order = np.argsort(label)
        sorted_label = label[order]
        new = np.flatnonzero(np.concatenate([[True], sorted_label[1:] != sorted_label[:-1]]))
        least = np.minimum.reduceat(ids[row[order]], new)
        repeated = np.zeros(len(label), bool)
        repeated[order] = ids[row[order]] > np.repeat(least, np.diff(np.append(new, len(label))))
        some = np.flatnonzero(repeated)
        if len(some):
            yield from marked(ids[row[some]], keys[row[some]], place[some], groups)

    dealt = docs.mapInArrow(pack, "part int, label binary, place binary, n binary, ids binary, keys binary").repartition(
        groups, "part").sortWithinPartitions("part")
    found = dealt.mapInArrow(nodes, MARKS_DDL)
    return (found.unionByName(hot_repeats(docs, window, grouped, groups)) if hot_any else found), groups


MARKS = pa.schema([("bucket", pa.int32()), ("ids", pa.binary()), ("keys", pa.binary()), ("places", pa.binary())])
MARKS_DDL = "bucket int, ids binary, keys binary, places binary"


def buckets_of(ids: np.ndarray, keys: np.ndarray, buckets: int) -> np.ndarray:
    return (words.mixed(ids.view(np.uint64) * np.uint64(31) ^ keys.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)


def marked(ids: np.ndarray, keys: np.ndarray, places: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Marks (document, its text's hash, word number) by bucket of documents: one packed row a
    bucket, however many documents and marks it has."""
    bucket = buckets_of(ids, keys, buckets)
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for s, e in zip(edges.tolist(), [*edges[1:].tolist(), len(order)]):
        own = order[s:e]
        yield batch(MARKS, [[int(bucket[own[0]])], [narrow(ids[own])], [narrow(keys[own])], [narrow(places[own].astype(np.uint32))]])


def hot_repeats(docs: DataFrame, window: int, grouped, buckets: int) -> DataFrame:
    """The same for nodes met too often for one group: smallest document by aggregation."""
    single = pa.schema([("label", pa.int64()), ("doc_id", pa.int64()), ("tkey", pa.int64()), ("place", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text", _SLICE):
            w, begin, label, cells = suffixes(rows, window)
            hot = np.flatnonzero(grouped(cells) < 0) if len(begin) else []
            if len(hot):
                text = np.searchsorted(w.first, begin[hot], side="right") - 1
                yield batch(single, [label[hot].view(np.int64), ids_of(rows)[text],
                                     rows.column("tkey").to_numpy(zero_copy_only=False)[text],
                                     (begin[hot] - w.first[text]).astype(np.int32)])

    rows = written(docs.mapInArrow(run, "label long, doc_id long, tkey long, place int"), run_folder(docs.sparkSession, "substrings"))
    least = rows.groupBy("label").agg(F.min("doc_id").alias("least"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield from marked(*(b.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "tkey", "place")), buckets)

    return rows.join(least, "label").where("doc_id > least").select("doc_id", "tkey", "place").distinct().mapInArrow(pack, MARKS_DDL)


def cleaned(docs: DataFrame, window: int = 13, most: int = 2_000_000,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, text (kept words, one blank between),
    spans (array of begin and end of each removed passage, in words).

    Words are runs without blanks, unchanged. A word goes if a window of `window` words that
    covers it also starts in a document with a smaller doc_id; windows are judged on the input.
    The first document of equal ones so keeps its words; rows that share a doc_id do not count as
    smaller than each other; a missing doc_id counts as the smallest. Null and empty texts, and
    texts of fewer words than a window, keep what they have. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = keyed(docs, id_col, text_col)
    found, buckets = repeats(rows, window, most)
    found = written(found, run_folder(spark, "substrings"))
    plain = pa.schema([("bucket", pa.int32()), ("doc_id", pa.int64()), ("tkey", pa.int64()), ("body", pa.binary())])

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(3).compress
        for b in slices(batches, "text", _SLICE):
            ids, keys = ids_of(b), b.column("tkey").to_numpy(zero_copy_only=False)
            yield batch(plain, [buckets_of(ids, keys, buckets), ids, keys, [pack(x.as_py().encode()) for x in b.column("text")]])

    bodies = rows.mapInArrow(shrink, "bucket int, doc_id long, tkey long, body binary")
    both = found.unionByName(bodies, allowMissingColumns=True).repartition(buckets, "bucket").sortWithinPartitions(
        "bucket", F.col("body").isNotNull())
    result = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string()),
                        ("spans", pa.list_(pa.int32()))])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        now, held, places, out, size = None, [], None, [], 0
        for b in batches:
            for r in b.to_pylist():
                if r["bucket"] != now:
                    now, held, places = r["bucket"], [], None
                if r["body"] is None:
                    held.append((widen(r["ids"], np.int64), widen(r["keys"], np.int64), widen(r["places"], np.uint32)))
                    continue
                if places is None:
                    places = by_document(held)
                    held = []
                text = unpack(r["body"])
                marks = places.get((r["doc_id"], r["tkey"]))
                out.append((None if r["doc_id"] == _LEAST else r["doc_id"], *without(text, marks, window)))
                size += len(text)
                if size > _SLICE:
                    yield batch(result, zip(*out))
                    out, size = [], 0
        if out:
            yield batch(result, zip(*out))

    return both.mapInArrow(remove, "doc_id long, n_words long, n_removed long, text string, spans array<int>")


def by_document(held: list) -> dict[tuple[int, int], np.ndarray]:
    """Word numbers of each marked document of a bucket."""
    if not held:
        return {}
    ids, keys, places = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((keys, ids))
    ids, keys, places = ids[order], keys[order], places[order]
    edges = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])]))
    return {(int(ids[s]), int(keys[s])): places[s:e] for s, e in zip(edges.tolist(), [*edges[1:].tolist(), len(ids)])}


def without(text: bytes, places: np.ndarray | None, window: int) -> tuple[int, int, str, list[int]]:
    if places is None:
        kept = text.split()  # bytes split at exactly the six blanks
        return len(kept), 0, b" ".join(kept).decode(), []
    w = words.words(np.array([0, len(text)]), np.frombuffer(text, np.uint8))
    change = np.zeros(len(w) + 1, np.int64)
    begin = np.unique(places).astype(np.int64)
    change[begin] += 1
    np.subtract.at(change, begin + window, 1)
    gone = np.cumsum(change[:-1]) > 0
    data, _, end = words.joined(w, lower=False, keep=np.flatnonzero(~gone))
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    return len(w), int(gone.sum()), data[:end[-1] if len(end) else 0].tobytes().decode(), edges.tolist()


def digest(rows: DataFrame) -> DataFrame:
    """The contract's columns."""
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
                       F.size("spans").alias("n_edges"))
