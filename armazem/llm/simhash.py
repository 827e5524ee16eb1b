"""SimHash near-duplicates, linked through pivot distance tables.

Fingerprints are 64-bit majority votes over the XXH64 hashes of word shingles. Distinct
fingerprints within `max_bits` of each other are linked, and documents get the component.

Candidate pairs. Every distinct fingerprint is given its row of the pivot table once: its Hamming
distances to fixed reference fingerprints, a byte each in one long. By the triangle inequality two
fingerprints within max_bits differ by no more than that in any coordinate, so a pair is discarded
by its largest coordinate difference (all bytes at once), and only survivors are verified.

A coordinate of uniform 64-bit fingerprints has a standard deviation of 4 bits, so a join on the
table alone would look at nearly all pairs. Fingerprints are therefore first dealt into groups by
equal bit blocks (max_bits + 2 blocks: two fingerprints within max_bits agree on two blocks at
least, so every link falls into a group), and the table works inside each group. There, members
close to one another are gathered into balls around one of them; links within a ball go through it,
so a group of n copies around one text costs n, not n^2, and gives a spanning forest. Groups of more
than `most` rows are dealt into blocks of rows, each pair of blocks in its own task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armazem.llm import words
from armazem.llm.components import components
from armazem.llm.runtime import batch, byte_offsets, parts, run_folder, ship, slices, texts, written

_SLICE = 1 << 20
#: References of the pivot table; a distance of up to 64 leaves the top bit of its byte free.
REFERENCES = np.random.default_rng(64).integers(0, 1 << 63, 8, np.uint64) * np.uint64(2) + np.arange(8, dtype=np.uint64) % np.uint64(2)
_TOPS, _ONES = np.uint64(0x8080808080808080), np.uint64(0x0101010101010101)


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long) of every row; whole texts, A-Z lower-cased.

    Shingles count as often as they occur. A text of fewer words is one shingle; one without
    words, an empty or a null text, gets 0. A bit is set if it is set in over half the hashes.
    """
    ship(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text", _SLICE):
            yield batch(schema, [rows.column("doc_id"), fingerprint(*byte_offsets(rows.column("text")), shingle)])

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def fingerprint(offsets: np.ndarray, data: np.ndarray, shingle: int) -> np.ndarray:
    import xxhash

    w = words.words(offsets, data)
    plain, start, end = words.joined(w, lower=True)
    counts = w.counts
    n = np.where(counts == 0, 0, np.maximum(counts - shingle + 1, 1))
    total = int(n.sum())
    begin = np.arange(total) + np.repeat(w.first[:-1] - (np.cumsum(n) - n), n)
    last = begin + np.minimum(shingle, np.repeat(counts, n)) - 1
    raw, h = plain.tobytes(), xxhash.xxh64_intdigest
    hashes = np.array([h(raw[a:b], 42) for a, b in zip(start[begin].tolist(), end[last].tolist())], np.uint64)
    out = np.zeros(len(counts), np.uint64)
    has = np.flatnonzero(n)
    if len(has):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes = np.add.reduceat(bits, (np.cumsum(n) - n)[has], axis=0, dtype=np.int32)
        major = votes * 2 > n[has][:, None]
        out[has] = np.packbits(major, axis=1, bitorder="little").view(np.uint64).ravel()
    return out.view(np.int64)


def blocks(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of max_bits + 2 blocks of the 64 bits."""
    edges = [64 * i // (max_bits + 2) for i in range(max_bits + 3)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def pivot_table(fp: F.Column) -> F.Column:
    """Distances to the references, a byte each."""
    table = F.lit(0).cast("long")
    for k, reference in enumerate(REFERENCES.view(np.int64).tolist()):
        table = table.bitwiseOR(F.shiftleft(F.bit_count(fp.bitwiseXOR(F.lit(reference))).cast("long"), 8 * k))
    return table


def possible(table: np.ndarray, one: np.ndarray | np.uint64, r: int) -> np.ndarray:
    """Whether no coordinate differs by more than r (below 64)."""
    slack = _ONES * np.uint64(r)
    above, below = (table | _TOPS) - one + slack, (one | _TOPS) - table + slack
    return (above & below & _TOPS) == _TOPS


def similar(prints: DataFrame, max_bits: int = 4, most: int = 20_000) -> DataFrame:
    """Links (a, b) between nodes of (node, fp), fingerprints being distinct.

    Not all pairs within max_bits are listed, but enough that nodes joined by any chain of such
    pairs are joined by a chain of links.
    """
    spark = prints.sparkSession
    ship(spark)
    if not 0 <= max_bits <= 14:
        raise ValueError("max_bits must lie between 0 and 14")
    cuts = blocks(max_bits)

    def block(k: int) -> F.Column:
        first, width = cuts[k]
        return F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1))

    keys = [F.struct(F.lit(t).cast("short").alias("t"), F.shiftleft(block(i), cuts[j][1]).bitwiseOR(block(j)).alias("key"))
            for t, (i, j) in enumerate(combinations(range(len(cuts)), 2))]
    rows = prints.select("node", "fp", pivot_table(F.col("fp")).alias("pivots"))
    dealt = rows.select("node", "fp", "pivots", F.explode(F.array(*keys)).alias("g")).select("g.t", "g.key", "node", "fp", "pivots")
    large = dealt.groupBy("t", "key").count().where(F.col("count") > most).select(
        "t", "key", F.ceil(F.col("count") / most).cast("int").alias("n"))
    mine = F.expr("pmod(xxhash64(node), n)").cast("int")
    pairs = F.when(F.col("n").isNull(), F.array(F.lit(0))).otherwise(F.transform(
        F.sequence(F.lit(0), F.col("n") - 1), lambda o: F.least(mine, o) * F.col("n") + F.greatest(mine, o)))
    dealt = dealt.join(large, ["t", "key"], "left").select(
        "t", "key", F.explode(pairs).alias("part"), "node", "fp", "pivots")
    dealt = dealt.repartition(parts(spark), "t", "key", "part").sortWithinPartitions("t", "key", "part", "node")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for rows in batches:
            if not rows.num_rows:
                continue
            now = np.stack([rows.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("t", "key", "part", "node", "fp", "pivots")])
            held.append(now)
            changes = np.flatnonzero((now[:3, 1:] != now[:3, :-1]).any(0))
            if len(changes) or (len(held) > 1 and (held[-2][:3, -1] != now[:3, 0]).any()):
                whole = np.concatenate(held, axis=1)
                edge = np.flatnonzero((whole[:3, 1:] != whole[:3, :-1]).any(0)) + 1
                yield from linked(whole[:, :edge[-1]], schema, max_bits)
                held = [whole[:, edge[-1]:]]
        if held:
            yield from linked(np.concatenate(held, axis=1), schema, max_bits)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def linked(rows: np.ndarray, schema: pa.Schema, max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links within each group of sorted rows (t, key, part, node, fp, pivots)."""
    edge = np.flatnonzero((rows[:3, 1:] != rows[:3, :-1]).any(0)) + 1
    start, end = np.concatenate([[0], edge]), np.concatenate([edge, [rows.shape[1]]])
    node, fp, table = rows[3], rows[4].view(np.uint64), rows[5].view(np.uint64)
    two = start[end - start == 2]
    two = two[possible(table[two], table[two + 1], max_bits)]
    near = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= max_bits]
    a, b = [node[near]], [node[near + 1]]
    for s, e in zip(start[end - start > 2].tolist(), end[end - start > 2].tolist()):
        x, y = forest(fp[s:e], table[s:e], max_bits)
        a.append(node[s:e][x])
        b.append(node[s:e][y])
    a, b = np.concatenate(a), np.concatenate(b)
    if len(a):
        yield batch(schema, [a, b])


def forest(fp: np.ndarray, table: np.ndarray, r: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join exactly the members joined by pairs within r bits, by the pivot table."""
    n = len(fp)
    root = np.arange(n)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out: list[tuple[int, int]] = []

    def join(i: int, j: int) -> None:
        p, q = find(i), find(j)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((i, j))

    def within(rows: np.ndarray, i: int, bits: int) -> np.ndarray:
        """Of the rows, those within so many bits of i: discarded by the table, then verified."""
        rows = rows[possible(table[rows], table[i], bits)]
        return rows[np.bitwise_count(fp[rows] ^ fp[i]) <= bits]

    every, ball, centres = np.arange(n), np.full(n, -1), []
    for i in range(n):
        if ball[i] >= 0:
            continue
        near = within(every, i, r)
        for j in near.tolist():
            join(i, j)
        mine = near[ball[near] < 0]
        ball[mine] = i
        if len(mine) > 1:
            centres.append(i)
    for p in centres:  # members of two balls may be linked if one lies within 2 r of the other's centre
        inner = np.flatnonzero(ball == p)
        for j in within(every[ball != p], p, 2 * r).tolist():
            if find(j) != find(p):
                hit = within(inner, j, r)
                if len(hit):
                    join(int(hit[0]), j)
    links = np.array(out, np.int64).reshape(-1, 2)
    return links[:, 0], links[:, 1]


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, most: int = 20_000,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long, component_id, n_links) for every row.

    component_id is the smallest doc_id reachable over links, itself included; rows of equal
    fingerprint are linked. Rows without an id get their fingerprint's component too, and null
    if no row of it has an id. n_links counts the links of the row's fingerprint. An empty table
    gives no rows, repeated rows give one row each.
    """
    spark = docs.sparkSession
    prints = written(fingerprints(docs, shingle, id_col, text_col), run_folder(spark, "simhash"))
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    # A fingerprint stands under its own value: unique even where ids repeat or are missing.
    links = similar(distinct.select(F.col("fp").alias("node"), "fp"), max_bits, most)
    links = written(links, run_folder(spark, "simhash"))
    joined = components(links)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    known = distinct.join(joined, distinct.fp == joined.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    first = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = written(
        known.join(first, "component").join(degree, known.fp == degree.node, "left").select(
            known.fp, "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links")),
        run_folder(spark, "simhash"))
    return prints.join(known, "fp").select("doc_id", "fp", "component_id", "n_links")
