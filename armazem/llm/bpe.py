"""Byte-level BPE: encoding of overlapping chunks, decoding by concatenation of raw bytes.

Long texts are cut into overlapping chunks that tasks pre-tokenise on their own. A chunk begins
somewhere inside a pre-token, so its first borders may be wrong; from the first border inside
the overlap that the chunk before it has too, both agree, as the pattern never looks back. There
the chunks are stitched. The pieces between borders are encoded by merging the pair of least
rank, each distinct piece once. Texts of one chunk are encoded where they are read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armazem.llm.runtime import batch, parts, ship, slices, texts

_KEPT = 120_000
_NO_RANK = 1 << 62
_SLICE = 2 << 20
# Borders nearer to a cut than the longest fixed alternative of the pattern are not trusted.
_GUARD = 4


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Codec:
    """Pre-tokenising, encoding and decoding with one rank file and pattern."""

    _known: dict[tuple[str, str], Codec] = {}

    def __init__(self, path: str, pattern: str):
        import regex

        self.ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.pieces = _Pieces(self.ranks)
        top = max(self.ranks.values(), default=-1) + 1
        self.bytes_of = np.full(top, b"", object)
        for token, i in self.ranks.items():
            self.bytes_of[i] = token

    @classmethod
    def open(cls, path: str, pattern: str) -> Codec:
        if (path, pattern) not in cls._known:
            cls._known[path, pattern] = cls(path, pattern)
        return cls._known[path, pattern]

    def split(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def encode(self, pieces: list[str]) -> bytes:
        """Ids of the pieces as little-endian unsigned 32-bit integers."""
        self.pieces.age()
        return b"".join(map(self.pieces.__getitem__, pieces))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(self.bytes_of[np.frombuffer(ids, "<u4")].tolist())


class _Pieces(dict):
    """Encoded ids by piece; a missing one is encoded and kept.

    Past _KEPT pieces a new generation begins; of the one before, what is met again is taken over.
    """

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks, self.before = ranks, {}

    def age(self) -> None:
        if len(self) > _KEPT:
            self.before = dict(self)
            self.clear()

    def __missing__(self, piece: str) -> bytes:
        if (known := self.before.get(piece)) is not None:
            self[piece] = known
            return known
        raw = piece.encode()
        whole = self.ranks.get(raw)
        ids = [whole] if whole is not None else merge(raw, self.ranks)
        out = np.array(ids, "<u4").tobytes()
        if len(raw) < 256:
            self[piece] = out
        return out


def merge(raw: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the leftmost pair of least rank until no pair has one."""
    if len(raw) > 100:
        return merge_long(raw, ranks)
    find = ranks.get
    part = [raw[i:i + 1] for i in range(len(raw))]
    rank = [find(raw[i:i + 2], _NO_RANK) for i in range(len(raw) - 1)]
    while rank and (best := min(rank)) != _NO_RANK:
        i = rank.index(best)
        part[i] += part.pop(i + 1)
        del rank[i]
        if i:
            rank[i - 1] = find(part[i - 1] + part[i], _NO_RANK)
        if i < len(rank):
            rank[i] = find(part[i] + part[i + 1], _NO_RANK)
    return [ranks[p] for p in part]


def merge_long(raw: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same by a heap over linked parts, in n log n steps."""
    n = len(raw)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(raw[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not end[i] or end[i] >= n or end[end[i]] != stop:
            continue
        j = end[i]
        end[i], end[j] = stop, 0
        if stop < n:
            before[stop] = i
            r = ranks.get(raw[i:end[stop]])
            if r is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if before[i] >= 0:
            r = ranks.get(raw[before[i]:stop])
            if r is not None:
                heapq.heappush(heap, (r, before[i], stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[raw[i:end[i]]])
        i = end[i]
    return out


def borders(pieces: list[str]) -> np.ndarray:
    return np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))


class Stitcher:
    """Puts the chunks of one text together, in order, and hands out true pieces."""

    def __init__(self, codec: Codec, chunk: int):
        self.codec, self.chunk = codec, chunk
        self.rest = None  # text from the last true border on, and its borders

    def add(self, text: str, ends: np.ndarray, last: bool) -> list[str]:
        """Pieces that became certain. text: the chunk with its overlap; ends: its own borders."""
        if self.rest is None:
            joined, marks, shift = text, ends, 0
        else:
            held, own, reach = self.rest  # own: trusted borders of held; reach: where text begins in it
            common = np.intersect1d(own[own >= reach], np.concatenate([[0], ends]) + reach)
            if len(common):
                at = int(common[0])
                joined = held[:reach] + text
                marks = np.concatenate([own[own <= at], ends[ends + reach > at] + reach])
            else:  # no border in the overlap: pre-tokenise on from the last true border
                joined = held[:reach] + text
                marks = borders(self.codec.split(joined))
        if last:
            self.rest, upto = None, marks
        else:
            reach = len(joined) - (len(text) - self.chunk)
            marks = marks[marks <= len(joined) - _GUARD]
            upto = marks[marks <= reach]
            cut = int(upto[-1]) if len(upto) else 0
            self.rest = (joined[cut:], marks[marks > cut] - cut, reach - cut)
        edges = [0, *upto.tolist()]
        return [joined[a:b] for a, b in zip(edges, edges[1:])]


def coded(docs: DataFrame, ranks: str, pattern: str, chunk: int = 16_384, overlap: int = 256,
          id_col: str = "doc_id", text_col: str = "text", payload: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256; with payload also ids
    (binary, little-endian unsigned 32-bit) and decoded (the bytes read back from them).

    ranks: path of a rank file every worker can read. Null and empty texts have no ids. Rows are
    kept as they are, repeated ones and missing ids too. A piece longer than an overlap is met
    by going on from the last true border.
    """
    spark = docs.sparkSession
    ship(spark)
    if not 2 * _GUARD <= overlap <= chunk:
        raise ValueError("overlap must lie between 8 and chunk")
    rows = texts(docs, id_col, text_col)
    short = F.length("text") <= chunk
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if payload:
        fields += [("ids", pa.binary()), ("decoded", pa.binary())]
        ddl += ", ids binary, decoded binary"
    schema = pa.schema(fields)

    def at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.open(ranks, pattern)
        for b in slices(batches, "text", _SLICE):
            out = []
            for d, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                ids = codec.encode(codec.split(text))
                back = codec.decode(ids)
                row = (d, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest())
                out.append((*row, ids, back) if payload else row)
            yield batch(schema, zip(*out))

    cut = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("seq", pa.int64()), ("last", pa.bool_()), ("text", pa.string()),
                     ("ends", pa.binary())])
    cut_ddl = "row long, doc_id long, seq long, last boolean, text string, ends binary"

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, d, text in zip(*(b.column(c).to_pylist() for c in ("row", "doc_id", "text"))):
                for s in range(0, max(len(text) - overlap, 1), chunk):
                    yield batch(cut, [[row], [d], [s // chunk], [s + chunk + overlap >= len(text)], [text[s:s + chunk + overlap]], [None]])

    def pretokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.open(ranks, pattern)
        for b in batches:
            ends = [borders(codec.split(t)).astype(np.int32).tobytes() for t in b.column("text").to_pylist()]
            yield batch(cut, [*(b.column(i) for i in range(5)), ends])

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.open(ranks, pattern)
        state = None
        for b in batches:
            for r in b.to_pylist():
                if r["seq"] == 0:
                    state = [Stitcher(codec, chunk), 0, hashlib.sha256(), hashlib.sha256(), [], []]
                ends = np.frombuffer(r["ends"], np.int32).astype(np.int64)
                ids = codec.encode(state[0].add(r["text"], ends, r["last"]))
                back = codec.decode(ids)
                state[1] += len(ids) // 4
                state[2].update(ids)
                state[3].update(back)
                if payload:
                    state[4].append(ids)
                    state[5].append(back)
                if r["last"]:
                    row = [[r["doc_id"]], [state[1]], [state[2].hexdigest()], [state[3].hexdigest()]]
                    yield batch(schema, [*row, [b"".join(state[4])], [b"".join(state[5])]] if payload else row)

    n = parts(spark)
    long = rows.where(~short).withColumn("row", F.monotonically_increasing_id()).mapInArrow(chunks, cut_ddl)
    long = long.repartition(n, "row", "seq").mapInArrow(pretokenise, cut_ddl)
    long = long.repartition(n, "row").sortWithinPartitions("row", "seq").mapInArrow(stitch, ddl)
    return rows.where(short).mapInArrow(at_once, ddl).unionByName(long)
