"""Token ids in a succinct file format: one wavelet matrix per segment.

A segment holds the ids of some thousand consecutive documents. Its wavelet matrix stores one
bit plane per bit of an id; each plane is stably sorted by the plane above it. Ranks over a plane
come from counts per 64-bit word, so token access, counting and occurrence lookup need nothing
but the file. Planes are packed with zstandard.

Layout of a file (little endian): magic, version, bits, documents, tokens; then the packed document
ids (int64, with a null mask), document lengths (int64), zeros per plane (int64) and planes, each
with its length in front. Files are the rows of a Parquet table, so that they reach any store
Spark can write.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from armazem.llm import words
from armazem.llm.runtime import batch, byte_offsets, parts, run_folder, ship, slices, texts

MAGIC = b"WVM1"
_HEAD = struct.Struct("<4sIIQQ")
_KEPT = 3_000_000  # units remembered
_KEPT_IDS = 16_000_000
_JOINED = 2000  # units encoded by one call of the library
_SLICE = 4 << 20
_BLANK, _LETTER, _MARK = 1, 2, 3
_KINDS = bytes(_BLANK if words.BLANKS[b] else _LETTER if b < 128 and chr(b).isalpha() else _MARK if b in b'.,;:!?"()' else 0 for b in range(256))
# Bytes of units cut without the library, 0: others. Letters are ASCII, U+00C0 to U+023F and U+0400 to U+047F; no
# apostrophe, as it may open a contraction.
_SPACE = 4
_CUTS = np.zeros(256, np.uint8)
_CUTS[33:127] = 3
_CUTS[48:58] = 2
_CUTS[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), *range(0xC3, 0xC9), 0xD0, 0xD1]] = 1
_CUTS[39], _CUTS[32] = 0, _SPACE
# Printable stand-ins of the bytes, as byte-level vocabularies spell them.
_SPELLED = np.arange(256, dtype="<u4")
_SPELLED[[*range(33), *range(127, 161), 173]] = np.arange(256, 256 + 33 + 34 + 1)
# White space beside the six blanks that separate words, in UTF-8.
_WIDE_SPACE = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


class WaveletMatrix:
    """Access, rank and select over a sequence of small integers."""

    def __init__(self, planes: list[np.ndarray], zeros: list[int], n: int):
        self.planes, self.zeros, self.n = planes, zeros, n
        self.before = [np.concatenate([[0], np.cumsum(np.bitwise_count(p.view(np.uint64)), dtype=np.int64)]) for p in planes]

    @classmethod
    def build(cls, values: np.ndarray, bits: int) -> WaveletMatrix:
        planes, zeros, now = [], [], values
        for k in range(bits - 1, -1, -1):
            one = (now & now.dtype.type(1 << k)) != 0
            plane = np.zeros(-(-len(one) // 64) * 8, np.uint8)
            plane[:-(-len(one) // 8)] = np.packbits(one, bitorder="little")
            planes.append(plane)
            # Places first, then take: several times as fast as now[~one] where bits are mixed.
            low, high = np.flatnonzero(~one), np.flatnonzero(one)
            zeros.append(len(low))
            then = np.empty_like(now)
            now.take(low, out=then[:len(low)], mode="clip")
            now.take(high, out=then[len(low):], mode="clip")
            now = then
        return cls(planes, zeros, len(values))

    def _bit(self, k: int, at: np.ndarray) -> np.ndarray:
        return (self.planes[k][at >> 3] >> (at & 7).astype(np.uint8)) & 1

    def _ones(self, k: int, at: np.ndarray) -> np.ndarray:
        """Ones of plane k before each place."""
        word = at >> 6
        inside = self.planes[k].view(np.uint64)
        part = inside[np.minimum(word, max(len(inside) - 1, 0))] if len(inside) else np.zeros(len(at), np.uint64)
        rest = (at & 63).astype(np.uint64)
        part = part & ((np.uint64(1) << rest) - np.uint64(1))
        return self.before[k][word] + np.bitwise_count(part)

    def access(self, at) -> np.ndarray:
        """Values at the given places."""
        at = np.atleast_1d(np.asarray(at, np.int64)).copy()
        out = np.zeros(len(at), np.int64)
        for k in range(len(self.planes)):
            bit, ones = self._bit(k, at).astype(np.int64), self._ones(k, at)
            out = out * 2 + bit
            at = np.where(bit == 1, self.zeros[k] + ones, at - ones)
        return out

    def _range(self, value: int) -> tuple[int, int]:
        lo, hi = 0, self.n
        for k in range(len(self.planes)):
            ones = self._ones(k, np.array([lo, hi]))
            if value >> (len(self.planes) - 1 - k) & 1:
                lo, hi = (self.zeros[k] + ones).tolist()
            else:
                lo, hi = lo - int(ones[0]), hi - int(ones[1])
        return lo, hi

    def count(self, value: int) -> int:
        """How often a value occurs."""
        if value < 0 or value >> len(self.planes):
            return 0
        lo, hi = self._range(value)
        return hi - lo

    def occurrences(self, value: int) -> np.ndarray:
        """All places of a value, ascending: select on each plane, from the last to the first."""
        if value < 0 or value >> len(self.planes):
            return np.zeros(0, np.int64)
        lo, hi = self._range(value)
        at = np.arange(lo, hi)
        for k in range(len(self.planes) - 1, -1, -1):
            bits = np.unpackbits(self.planes[k], bitorder="little")[:self.n]
            if value >> (len(self.planes) - 1 - k) & 1:
                at = np.flatnonzero(bits)[at - self.zeros[k]]
            else:
                at = np.flatnonzero(bits == 0)[at]
        return np.sort(at)

    def values(self) -> np.ndarray:
        """The whole sequence: the sorting steps undone, from the last plane to the first."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        out = np.zeros(self.n, kind)
        for k in range(len(self.planes) - 1, -1, -1):
            bit = np.unpackbits(self.planes[k], bitorder="little")[:self.n].view(bool)
            back = np.empty(self.n, kind)
            back[np.flatnonzero(~bit)] = out[:self.zeros[k]]
            back[np.flatnonzero(bit)] = out[self.zeros[k]:] | kind(1 << (len(self.planes) - 1 - k))
            out = back
        return out


def to_file(doc_ids: list, lengths: np.ndarray, ids: np.ndarray, bits: int) -> bytes:
    import zstandard

    pack = zstandard.ZstdCompressor(1).compress
    matrix = WaveletMatrix.build(ids, bits)
    null = np.array([d is None for d in doc_ids], np.uint8)
    whole = np.array([0 if d is None else d for d in doc_ids], np.int64)
    sections = [whole.tobytes(), null.tobytes(), lengths.astype(np.int64).tobytes(), np.array(matrix.zeros, np.int64).tobytes(),
                *(p.tobytes() for p in matrix.planes)]
    out = [_HEAD.pack(MAGIC, 1, bits, len(doc_ids), len(ids))]
    for s in map(pack, sections):
        out += [struct.pack("<Q", len(s)), s]
    return b"".join(out)


def from_file(data: bytes) -> tuple[list, np.ndarray, WaveletMatrix]:
    """(document ids, lengths, matrix) of a file."""
    import zstandard

    magic, version, bits, _, n = _HEAD.unpack_from(data)
    if (magic, version) != (MAGIC, 1):
        raise ValueError("not a token file")
    at, sections, unpack = _HEAD.size, [], zstandard.ZstdDecompressor().decompress
    for _ in range(4 + bits):
        (size,) = struct.unpack_from("<Q", data, at)
        sections.append(unpack(data[at + 8:at + 8 + size]))
        at += 8 + size
    whole, null = np.frombuffer(sections[0], np.int64).tolist(), np.frombuffer(sections[1], np.uint8)
    doc_ids = [None if x else d for d, x in zip(whole, null)]
    planes = [np.frombuffer(s, np.uint8) for s in sections[4:]]
    return doc_ids, np.frombuffer(sections[2], np.int64), WaveletMatrix(planes, np.frombuffer(sections[3], np.int64).tolist(), n)


class Known:
    """Ids of units by 64-bit hash: two sorted runs of hashes, and the ids one after another.

    The short run takes what is added and joins the long one when it has grown. About 20 bytes a
    unit; all is forgotten once the units or their ids pass a bound.
    """

    def __init__(self, kind: type):
        self.kind = kind
        self.clear()

    def __len__(self) -> int:
        return sum(len(keys) for keys, _, _ in self.runs)

    def clear(self) -> None:
        self.runs = [(np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint32))] * 2  # hash, first id, number of ids
        self.ids, self.n = np.zeros(1 << 16, self.kind), 0

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first id, number of ids, whether known) of each hash."""
        first, size, known = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        order = np.argsort(keys)
        for run, firsts, sizes in self.runs:
            if len(run):
                at = np.minimum(np.searchsorted(run, keys[order]), len(run) - 1)
                same = run[at] == keys[order]
                hit, at = order[same], at[same]
                first[hit], size[hit], known[hit] = firsts[at], sizes[at], True
        return first, size, known

    def add(self, keys: np.ndarray, first: np.ndarray, size: np.ndarray, ids: np.ndarray) -> int:
        """Take new hashes and their ids, first counted within ids; returns the place of the first id."""
        at, self.n = self.n, self.n + len(ids)
        if self.n > len(self.ids):
            grown = np.empty(max(self.n, len(self.ids) * 3 // 2), self.kind)
            grown[:at] = self.ids[:at]
            self.ids = grown
        self.ids[at:self.n] = ids
        if self.n < 1 << 32:  # beyond it, all is forgotten before the next use
            self.runs[1] = self.merged(self.runs[1], (keys, (first + at).astype(np.uint32), size.astype(np.uint32)))
            if len(self.runs[1][0]) > 100_000 + len(self.runs[0][0]) // 4:
                self.runs = [self.merged(*self.runs), self.merged()]
        return at

    @staticmethod
    def merged(*runs: tuple) -> tuple:
        whole = [np.concatenate(c) for c in zip(*runs)] or [np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint32)]
        order = np.argsort(whole[0], kind="stable")
        return tuple(c[order] for c in whole)


class Encoder:
    """Ids of texts by a byte-level tokenizer of the tokenizers library.

    A text is cut into units, before white space and between a letter and a mark after it: no
    pre-token of a byte-level tokenizer reaches over the border between two units. The library encodes the units met first,
    many at a time, one after another as a text would hold them; the bytes each id stands for tell
    where a unit's ids end. Units of letters, digits and marks that every Unicode version classes alike are
    cut into their pre-tokens here and given to the library's model without its own cutting. Texts
    with other kinds of white space, and tokenizers with other steps than a plain byte-level one,
    are encoded whole. Units are told apart by 64-bit hash. The memory of units is bounded.
    """

    _known: dict[str, Encoder] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cut = Tokenizer(self.tokenizer.model)  # takes pre-tokens, spelled as the vocabulary spells bytes, by line
        self.cut.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        top = self.tokenizer.get_vocab_size()
        self.bits = max(1, (top - 1).bit_length())
        self.kind = np.uint16 if top <= 1 << 16 else np.uint32
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.plain = (
            self.tokenizer.normalizer is None and all(t.special for t in added)
            and re.match(r"ByteLevel\(add_prefix_space=False, .*use_regex=True\)", str(self.tokenizer.pre_tokenizer)) is not None)
        self.units = Known(self.kind)
        vocabulary = self.tokenizer.get_vocab()
        self.n_bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():  # byte-level vocabularies spell every byte as one character
            self.n_bytes[i] = len(token)

    @classmethod
    def open(cls, path: str) -> Encoder:
        if path not in cls._known:
            cls._known[path] = cls(path)
        return cls._known[path]

    def packed(self, ids: list[int]) -> bytes:
        return array("H" if self.kind is np.uint16 else "I", ids).tobytes()

    def whole(self, text: str) -> bytes:
        return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, offsets: np.ndarray, data: np.ndarray) -> list[bytes]:
        """Packed ids of each text; texts as their joined bytes and offsets."""
        raw = data.tobytes()
        texts_of = list(zip(offsets[:-1].tolist(), offsets[1:].tolist()))
        if not self.plain:
            return [self.whole(raw[a:b].decode()) for a, b in texts_of]
        # A unit begins with a text, with white space after a word, and with a mark after an ASCII letter.
        kind = np.frombuffer(raw.translate(_KINDS), np.uint8)
        begins = np.zeros(len(data), bool)
        begins[1:] = ((kind[1:] == _BLANK) & (kind[:-1] != _BLANK)) | ((kind[1:] == _MARK) & (kind[:-1] == _LETTER))
        begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        start = np.flatnonzero(begins)
        until = np.searchsorted(start, offsets)
        units = words.Words(data, start, np.append(start[1:], len(data))[:len(start)], until)
        coded = pa.array(units.hashes()[0]).dictionary_encode()
        which = coded.indices.to_numpy()
        keys = coded.dictionary.to_numpy()
        place = np.empty(len(keys), np.int64)
        place[which[::-1]] = np.arange(len(which))[::-1]
        if len(self.units) > _KEPT or self.units.n > _KEPT_IDS:
            self.units.clear()
        first, size, known = self.units.find(keys)
        new = np.flatnonzero(~known)
        if len(new):
            ids, first[new], size[new] = self.fresh(data, units.start[place[new]], units.end[place[new]])
            first[new] += self.units.add(keys[new], first[new], size[new], ids)
        n = size[which]
        ends = np.cumsum(n)
        source = np.repeat(first[which] - (ends - n), n)
        source += np.arange(len(source))
        body, width = self.units.ids.take(source).tobytes(), np.dtype(self.kind).itemsize
        border = (np.append(0, ends)[until] * width).tolist()
        out = [body[a:b] for a, b in zip(border[:-1], border[1:])]
        odd = np.flatnonzero(n == 0)  # units with other white space
        for i in set((np.searchsorted(until, odd, side="right") - 1).tolist()):
            out[i] = self.whole(raw[offsets[i]:offsets[i + 1]].decode())
        return out

    def fresh(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first id and number of ids of each unit) of units, by their first byte and end; none for a unit with other white space."""
        body, begin, stop = gathered(data, start, end)
        kind, opens = _CUTS[body], np.zeros(len(body), bool)
        opens[begin] = True
        left = (kind == 0) | ((kind == _SPACE) & ~opens)
        left[1:] |= (body[:-1] == 0xC3) & ((body[1:] == 0x97) | (body[1:] == 0xB7))  # the signs among Latin-1's letters
        simple = ~np.logical_or.reduceat(left, begin) & ((kind[begin] != _SPACE) | (stop - begin > 1))
        wide = np.zeros(len(start), bool)
        wide[np.searchsorted(stop, [m.start() for m in _WIDE_SPACE.finditer(body.tobytes())], side="right")] = True
        # A unit without white space before its word, or without a word, might merge with its neighbour.
        joins = words.BLANKS[body[begin]] & ~words.BLANKS[body[stop - 1]] & ~simple & ~wide
        alone = np.flatnonzero(~(simple | joins | wide))
        first, size = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        out, n = [], 0

        def take(own: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
            nonlocal n
            first[own], size[own] = n + np.cumsum(sizes) - sizes, sizes
            out.append(ids)
            n += len(ids)

        def shared(tokenizer, own: np.ndarray, text: str, border: np.ndarray) -> None:
            """Units encoded by one call, and where their bytes end."""
            ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)
            until = np.cumsum(self.n_bytes[ids])
            last = np.searchsorted(until, border)
            if not len(ids) or last[-1] != len(ids) - 1 or (until[last] != border).any():  # a vocabulary that spells bytes otherwise
                single(own, [self.whole(body[begin[i]:stop[i]].tobytes().decode()) for i in own.tolist()])
            else:
                take(own, ids, np.diff(last, prepend=-1))

        def single(own: np.ndarray, packed: list[bytes]) -> None:
            ids = np.frombuffer(b"".join(packed), self.kind)
            take(own, ids, np.array([len(x) for x in packed]) // ids.itemsize)

        if len(alone):
            texts_of = [body[begin[i]:stop[i]].tobytes().decode() for i in alone.tolist()]
            single(alone, [self.packed(x.ids) for x in self.tokenizer.encode_batch_fast(texts_of, add_special_tokens=False)])
        for own in runs_of(np.flatnonzero(joins)):
            some, _, border = gathered(body, begin[own], stop[own])
            shared(self.tokenizer, own, some.tobytes().decode(), border)
        for own in runs_of(np.flatnonzero(simple)):
            some, opening, border = gathered(body, begin[own], stop[own])
            kind = _CUTS[some]
            cuts = np.zeros(len(some), bool)
            cuts[1:] = (kind[1:] != kind[:-1]) & (kind[:-1] != _SPACE)
            cuts[opening] = True
            text = np.insert(_SPELLED[some], np.flatnonzero(cuts), 10).tobytes().decode("utf-32-le")
            shared(self.cut, own, text, border)
        return np.concatenate(out) if out else np.zeros(0, self.kind), first, size


def gathered(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start, end) of the pieces of data from each start to its end, one after another."""
    size = end - start
    stop = np.cumsum(size)
    source = np.repeat(start - (stop - size), size)
    source += np.arange(len(source))
    return data.take(source), stop - size, stop


def runs_of(numbers: np.ndarray) -> list[np.ndarray]:
    return [numbers[at:at + _JOINED] for at in range(0, len(numbers), _JOINED)]


def write(docs: DataFrame, tokenizer: str, path: str, end_id: int = 0, docs_per_shard: int = 8192,
          segment_tokens: int = 2_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode documents and write them as token files; returns the written table.

    Rows: shard, segment, n_docs, n_tokens, file. Files are in ascending order of doc_id by
    (shard, segment); within a file documents ascend too. Missing ids come first, rows of one
    id are ordered by their ids. Null and empty texts hold the end id only. Shards are ranges of
    doc_id; a shard whose documents are many or long gets more segments. An empty table gives an
    empty one.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = texts(docs, id_col, text_col)
    n = rows.count()
    shards = max(parts(spark), -(-n // docs_per_shard))
    cuts = []
    if n:
        found = rows.select(F.percentile_approx("doc_id", [i / shards for i in range(1, shards)], 100 * shards)).first()[0] if shards > 1 else []
        cuts = sorted(set(found or []))
    cuts = np.array(cuts, np.int64)
    packed = pa.schema([("shard", pa.int32()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("body", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encoder, pack = Encoder.open(tokenizer), zstandard.ZstdCompressor(1).compress
        end = np.array([end_id], encoder.kind).tobytes()
        for b in slices(batches, "text", _SLICE):
            bodies = [x + end for x in encoder.encode(*byte_offsets(b.column("text")))]
            ids = b.column("doc_id").to_pylist()
            shard = np.searchsorted(cuts, np.array([0 if d is None else d for d in ids], np.int64), side="right")
            shard[[i for i, d in enumerate(ids) if d is None]] = 0
            order, out = np.argsort(shard, kind="stable"), []
            for own in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                s, own = int(shard[own[0]]), own.tolist()
                out.append((s, [ids[i] for i in own], [len(bodies[i]) for i in own], pack(b"".join(bodies[i] for i in own))))
            yield batch(packed, zip(*out))

    dealt = rows.mapInArrow(encode, "shard int, ids array<long>, sizes array<long>, body binary").repartition(
        shards, "shard").sortWithinPartitions("shard")
    files = pa.schema([("shard", pa.int32()), ("segment", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()),
                       ("file", pa.binary())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.open(tokenizer)
        now, held = None, []
        for b in batches:
            for r in b.to_pylist():
                if held and r["shard"] != now:
                    yield from segments(now, held, encoder)
                    held = []
                now = r["shard"]
                held.append(r)
        if held:
            yield from segments(now, held, encoder)

    def segments(shard: int, held: list, encoder: Encoder) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack, docs_of = zstandard.ZstdDecompressor().decompress, []
        for r in held:
            body, at = unpack(r["body"]), 0
            for d, size in zip(r["ids"], r["sizes"]):
                docs_of.append((d is not None, d or 0, body[at:at + size]))
                at += size
        docs_of.sort()
        width, at, segment = np.dtype(encoder.kind).itemsize, 0, 0
        while at < len(docs_of):
            upto, total = at, 0
            while upto < len(docs_of) and (upto == at or total + len(docs_of[upto][2]) // width <= segment_tokens):
                total += len(docs_of[upto][2]) // width
                upto += 1
            own = docs_of[at:upto]
            ids = np.frombuffer(b"".join(x[2] for x in own), encoder.kind)
            data = to_file([x[1] if x[0] else None for x in own], np.array([len(x[2]) // width for x in own]), ids, encoder.bits)
            yield batch(files, zip(*[(shard, segment, len(own), len(ids), data)]))
            at, segment = upto, segment + 1

    dealt.mapInArrow(build, "shard int, segment int, n_docs long, n_tokens long, file binary").write.option(
        "compression", "uncompressed").mode("error").parquet(path)
    return spark.read.schema("shard int, segment int, n_docs long, n_tokens long, file binary").parquet(path)


def read(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone.

    start counts the ids of all documents before it. ids_crc32: of the ids as little-endian
    unsigned 32-bit integers.
    """
    ship(files.sparkSession)
    # Totals in two levels: shards in one task, the segments of a shard in another.
    shard = files.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    shard = shard.select("shard", (F.sum("n").over(W.orderBy("shard")) - F.col("n")).alias("shard_start"))
    within = F.sum("n_tokens").over(W.partitionBy("shard").orderBy("segment")) - F.col("n_tokens")
    starts = files.select("shard", "segment", within.alias("inner")).join(shard, "shard").select(
        "shard", "segment", (F.col("shard_start") + F.col("inner")).alias("file_start"))
    schema = pa.schema([("shard", pa.int32()), ("segment", pa.int32()), ("doc_id", pa.int64()), ("offset", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                doc_ids, lengths, matrix = from_file(b.column("file")[i].as_py())
                body, end = matrix.values().astype("<u4").tobytes(), np.cumsum(lengths)
                crcs = [zlib.crc32(body[4 * (e - n):4 * e]) for n, e in zip(lengths.tolist(), end.tolist())]
                k = len(doc_ids)
                yield batch(schema, [[b.column("shard")[i].as_py()] * k, [b.column("segment")[i].as_py()] * k, doc_ids, end - lengths, lengths, crcs])

    docs = files.select("shard", "segment", "file").mapInArrow(run, "shard int, segment int, doc_id long, offset long, n_tokens long, ids_crc32 long")
    return docs.join(starts, ["shard", "segment"]).select(
        "doc_id", (F.col("file_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def token_ids(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write token files into a new folder of the shared folder and read the documents back."""
    return read(write(docs, tokenizer, run_folder(docs.sparkSession, "tokens"), end_id))
