"""Which keys of many slices of a corpus reach a total, answered to the slices that hold them.

A slice is a run of documents that one task reads at once. It counts its own keys first, so that a
key met everywhere is one record a slice, and sends them, sorted and packed, to the groups of keys.
A group adds up its slices and answers each of them with one bit a key, in the order the slice
sent. No dictionary of keys is broadcast or collected, whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armazem.llm.runtime import batch, parts

#: Records a group may hold, as an average.
GROUP = 4_000_000
SENT = pa.schema([("part", pa.int32()), ("slice", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
SENT_DDL = "part int, slice long, keys binary, counts binary"
ANSWERS = pa.schema([("slice", pa.int64()), ("part", pa.int32()), ("n_hits", pa.int64()), ("hits", pa.binary()), ("hot", pa.binary()),
                     ("first", pa.binary()), ("totals", pa.binary())])
ANSWERS_DDL = "slice long, part int, n_hits long, hits binary, hot binary, first binary, totals binary"


def narrow(values: np.ndarray) -> bytes:
    """Integers as byte planes, packed."""
    import zstandard

    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.compress(planes.tobytes(), 1)


def widen(packed: bytes, kind) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def groups(spark, records: int) -> int:
    """Number of groups for so many records."""
    return max(parts(spark), -(-records // GROUP))


def dealt(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of the keys by group and key, where each group's keys end in it)."""
    part = (keys % np.uint64(n)).astype(np.uint16 if n < 1 << 16 else np.int64)
    order = np.argsort(keys)
    order = order[np.argsort(part[order], kind="stable")]
    return order, np.cumsum(np.bincount(part, minlength=n))


def sent(slice_id: int, keys: np.ndarray, counts: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
    """A slice's distinct keys, dealt into n groups."""
    order, ends = dealt(keys, n)
    keys, counts, at = keys[order], counts[order].astype(np.uint32), 0
    rows = []
    for p, end in enumerate(ends.tolist()):
        if end > at:
            rows.append((p, slice_id, narrow(np.diff(keys[at:end], prepend=np.uint64(0))), narrow(counts[at:end])))
            at = end
    for s in range(0, len(rows), 256):
        yield batch(SENT, zip(*rows[s:s + 256]))


def answers(records: DataFrame, n: int, least: int, hot: int | None = None) -> DataFrame:
    """For each slice and group: which keys total at least `least`, and which at least `hot`; if
    that is not asked, of which frequent keys the slice is the first that holds them, and their
    totals."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for rows in batches:
            for r in rows.to_pylist():
                if r["part"] != now and held:
                    yield from summed(now, held, least, hot)
                    held = []
                now = r["part"]
                held.append((r["slice"], np.cumsum(widen(r["keys"], np.uint64)), widen(r["counts"], np.uint32)))
        if held:
            yield from summed(now, held, least, hot)

    return records.repartition(n, "part").sortWithinPartitions("part", "slice").mapInArrow(run, ANSWERS_DDL)


def summed(part: int, held: list, least: int, hot: int | None) -> Iterator[pa.RecordBatch]:
    keys = np.concatenate([k for _, k, _ in held])
    counts = np.concatenate([c for _, _, c in held]).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    own = keys[order]
    edge = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    totals = np.add.reduceat(counts[order], edge)
    size = np.diff(np.append(edge, len(keys)))

    def reach(bound: int) -> np.ndarray:
        out = np.empty(len(keys), bool)
        out[order] = np.repeat(totals >= bound, size)
        return out

    hit, first = reach(least), np.zeros(len(keys), bool)
    often = reach(hot) if hot else None
    if not hot:
        first[order[edge]] = totals >= least  # the sort is stable and slices come in their order
        total = np.empty(len(keys), np.int64)
        total[order[edge]] = totals
    at, out = 0, []
    for slice_id, k, _ in held:
        mine = slice(at, at + len(k))
        at += len(k)
        more = (np.packbits(often[mine]).tobytes(), None, None) if hot else (
            None, np.packbits(first[mine]).tobytes(), narrow(total[mine][first[mine]]))
        out.append((slice_id, part, int(hit[mine].sum()), np.packbits(hit[mine]).tobytes(), *more))
        if len(out) == 256:
            yield batch(ANSWERS, zip(*out))
            out = []
    if out:
        yield batch(ANSWERS, zip(*out))


def received(rows: list[dict], keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(frequent, hot, total or 0 where the slice isn't the first) of each key, from a slice's answers."""
    order, ends = dealt(keys, n)
    hit, hot, total = np.zeros(len(keys), bool), np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)

    def bits(packed: bytes, size: int) -> np.ndarray:
        return np.unpackbits(np.frombuffer(packed, np.uint8), count=size).astype(bool)

    for r in rows:
        mine = order[ends[r["part"] - 1] if r["part"] else 0:ends[r["part"]]]
        hit[mine] = bits(r["hits"], len(mine))
        if r["hot"] is not None:
            hot[mine] = bits(r["hot"], len(mine))
        else:
            total[mine[bits(r["first"], len(mine))]] = widen(r["totals"], np.int64)
    return hit, hot, total


def together(states: DataFrame, answered: DataFrame, n: int, payload: str) -> DataFrame:
    """States and their answers by slice, the answers first. payload: a column only states have."""
    return states.unionByName(answered, allowMissingColumns=True).repartition(n, "slice").sortWithinPartitions(
        "slice", F.col(payload).isNotNull(), "part")


def by_slice(batches: Iterator[pa.RecordBatch], payload: str) -> Iterator[tuple[dict, list[dict]]]:
    """(state, its answers) of each slice, of rows as together() gives them."""
    now, held = None, []
    for rows in batches:
        for i in range(rows.num_rows):
            r = rows.slice(i, 1).to_pylist()[0]
            if r["slice"] != now:
                now, held = r["slice"], []
            if r[payload] is None:
                held.append(r)
            else:
                yield r, held
