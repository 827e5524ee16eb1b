"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit distance.

Texts are sequences of words (runs of letters and digits, A-Z lower-cased). A document is
contaminated by an item if some stretch of it is within max_edits(len(item)) word edits of the
whole item: a similarity of 0.8 or more.

Windows of an item's size begin at every word. Sizes are rounded down to a geometric scale of
at most LONGEST words; an item's window is its first `size` words. A longer item is cut into k
nearly equal pieces that cover it whole, each with a window like an item of its own: of E edits
some piece has E // k at most, which is no more than an item of the piece's length may have.
The whole item is verified around that piece.
A document stands between as many end marks as an item can lose words: windows reach over both
its ends, so that texts shorter than an item have windows, too.
A window is embedded if it can hold an item at all: each edit spoils at most two of an item's
word pairs, so a window with fewer known pairs is dismissed without loss. The CGK walk writes
the current word at each of 3 x size steps and moves on by a random bit of (step, word): two
texts a few edits apart soon walk in step again. Each repetition samples a few steps as a
key; the number of repetitions comes from the target recall at the most edits allowed.
Keys of items and windows meet in a join; each candidate stretch is verified by exact edit
distance over the whole item. Tables of fixed size hold known pairs and keys on the workers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armazem.llm import words
from armazem.llm.runtime import batch, byte_offsets, cut, run_folder, ship, slices, texts, written

STEPS_PER_WORD = 3
SAMPLED = 3
LONGEST = 51  # a step of scale(): longer windows would need too many repetitions
_CELLS = 1 << 22
_SLICE = 4 << 20
_TOKENS = 1 << 20  # bytes of text taken for words at a time
_SEED = 77
_TURN = np.uint64(0xD1342543DE82EF95)
_PAD = np.uint64(1)  # no word has this hash; walks() ends with it, too


def max_edits(size: int) -> int:
    """A fifth of the words, rounded down: similarity 0.8."""
    return size // 5


def scale(size: int) -> int:
    """The largest step of 1, 2, 3, ... 8, then by a quarter more each, up to size."""
    now = 1
    while (more := max(now + 1, now * 5 // 4)) <= min(size, LONGEST):
        now = more
    return now


def above(size: int) -> int:
    """The longest item whose windows have this size."""
    return max(size + 1, size * 5 // 4) - 1


def pieces(n: int) -> list[int]:
    """Borders of an item's pieces: one piece, or nearly equal ones of at most LONGEST words."""
    k = -(-n // LONGEST) if n > above(LONGEST) else 1
    return [j * n // k for j in range(k + 1)]


def walks(x: np.ndarray, reps: range) -> np.ndarray:
    """Keys of word windows x (rows of `size` hashes), one column a repetition."""
    n, size = x.shape
    flat = np.concatenate([x, np.full((n, 1), _PAD)], axis=1).ravel()
    total, begin = STEPS_PER_WORD * size, np.arange(n) * (size + 1)
    end = begin + size
    out = np.empty((n, len(reps)), np.uint64)
    for column, rep in enumerate(reps):
        chance = np.random.default_rng([_SEED, size, rep])
        salts = chance.integers(1, 1 << 63, total, np.uint64)
        # The walk stands on a word up to about 2 x size steps; later ones only see the end.
        sampled = set(chance.choice(max(1, 2 * size), min(SAMPLED, 2 * size), replace=False).tolist())
        place = begin.copy()
        key = np.full(n, words.mixed(np.array([size * 1000 + rep], np.uint64))[0])
        last = max(sampled)
        for step in range(last + 1):
            now = flat.take(place)
            if step in sampled:
                key = words.mixed(key ^ now)
            if step < last:  # the top bit of a product tells whether the walk goes on to the next word
                now ^= salts[step]
                now *= _TURN
                now >>= np.uint64(63)
                place += now.view(np.int64)
                np.minimum(place, end, out=place)
        out[:, column] = key
    return out


def repetitions(size: int, recall: float, trials: int = 400) -> int:
    """Repetitions until an item with the most edits allowed is found with the target recall.

    The chance of one repetition is measured on random windows; windows around the best one
    add chances that are not counted here.
    """
    edits, chance = max_edits(above(size)), np.random.default_rng([_SEED, size])
    if not edits:
        return 1
    items = chance.integers(2, 1 << 63, (trials, size + edits), np.uint64)
    other = np.empty((trials, size), np.uint64)
    for row in range(trials):
        seq = items[row].tolist()
        for _ in range(edits):
            i, kind = int(chance.integers(0, size)), int(chance.integers(0, 3))
            if kind == 0:
                seq[i] = int(chance.integers(2, 1 << 62))
            elif kind == 1:
                seq.insert(i, int(chance.integers(2, 1 << 62)))
            else:
                del seq[i]
                seq.append(int(chance.integers(2, 1 << 62)))
        other[row] = seq[:size]
    reps = range(64)
    hit = (walks(items[:, :size].copy(), reps) == walks(other, reps)).mean(1)
    # Windows differ in their own chance: the mean over them of missing R times.
    for r in range(1, 400):
        if ((1 - hit) ** r).mean() <= 1 - recall:
            return r
    return 400


def tokens(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, index of each text's first word)."""
    hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for part in cut(rows, "text", _TOKENS):
        w = words.words(*byte_offsets(part.column("text")), words.MARKS)
        hashes.append(w.hashes(lower=True)[0])
        counts.append(w.counts)
    h = np.concatenate(hashes)
    h |= np.uint64(2)
    return h, np.cumsum(np.concatenate(counts))


def items_of(benchmark: DataFrame, recall: float, id_col: str, text_col: str) -> DataFrame:
    """(item_id, at, n_words, size, words, keys, pairs): each item with words, by its windows; the
    words stand in the row of the first one."""
    schema = pa.schema([("item_id", pa.int64()), ("at", pa.int32()), ("n_words", pa.int32()), ("size", pa.int32()), ("words", pa.list_(pa.int64())),
                        ("keys", pa.list_(pa.int64())), ("pairs", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reps: dict[int, int] = {}
        for b in slices(batches, "text", _SLICE):
            h, first = tokens(b)
            out = []
            for i, item in enumerate(b.column("doc_id").to_pylist()):
                own = h[first[i]:first[i + 1]]
                if not len(own):
                    continue
                edges = pieces(len(own))
                for at, end in zip(edges, edges[1:]):
                    size = scale(end - at)
                    if size not in reps:
                        reps[size] = repetitions(size, recall)
                    key = walks(own[None, at:at + size], range(reps[size]))[0]
                    out.append((item, at, len(own), size, [] if at else own.view(np.int64).tolist(), key.view(np.int64).tolist(),
                                pairs(own[at:at + size]).tolist()))
            if out:
                yield batch(schema, zip(*out))

    return texts(benchmark, id_col, text_col).mapInArrow(
        run, "item_id long, at int, n_words int, size int, words array<long>, keys array<long>, pairs array<int>")


def ended(h: np.ndarray, first: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text between `pad` end marks, shared with the next: (word hashes, index of each text's first word)."""
    return np.insert(h, np.repeat(first, pad), _PAD), first + pad * np.arange(1, len(first) + 1)


def pairs(h: np.ndarray) -> np.ndarray:
    """Cell of each word and the word after it."""
    if len(h) < 2:
        return np.zeros(0, np.int32)
    return (words.mixed(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) >> np.uint64(42)).astype(np.int32)


def cells(rows: DataFrame) -> np.ndarray:
    """Which cells of a fixed table occur; at most 4 million figures reach the driver."""
    out = np.zeros(_CELLS, bool)
    found = rows.distinct().toPandas().iloc[:, 0].to_numpy()
    out[found.astype(np.int64)] = True
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, recall: float = 0.95, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and item found in it: doc_id, tkey, item_id, start, edits, n_words.

    tkey: hash of the document's text, which tells rows of one id apart. start: the word at
    which the best window begins (the first of equals); edits: least edit distance between the
    whole item and a stretch there; n_words: words of the item. Items of fewer than 5 words must
    occur unchanged. Null and empty texts have no words and match nothing; repeated documents
    are reported once. An empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    items = written(items_of(benchmark, recall, item_col, item_text_col), run_folder(spark, "decontamination"))
    sizes = sorted((r["size"], r["reps"]) for r in items.groupBy("size").agg(F.max(F.size("keys")).alias("reps")).collect())
    known_pairs = cells(items.select(F.explode("pairs").alias("cell")))
    keys = items.select("item_id", "at", "n_words", F.explode("keys").alias("key")).distinct()
    # Two tables of the same keys, by different bits: a window is a candidate if both know a key.
    known_keys = [cells(keys.select(F.shiftrightunsigned("key", shift).bitwiseAND(F.lit(_CELLS - 1)).cast("int").alias("cell"))) for shift in (42, 20)]
    single = cells(items.where("size = 1 and at = 0").select(F.shiftrightunsigned(F.get("words", F.lit(0)), 42).cast("int").alias("cell")))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tkey"))
    schema = pa.schema([("doc_id", pa.int64()), ("tkey", pa.int64()), ("start", pa.int32()), ("size", pa.int32()), ("label", pa.int64()),
                        ("keys", pa.list_(pa.int64())), ("near", pa.list_(pa.int64()))])
    tables = spark.sparkContext.broadcast([np.packbits(t) for t in (known_pairs, single, *known_keys)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair_cells, word_cells, *key_cells = (np.unpackbits(t).view(bool) for t in tables.value)
        pad = max((max_edits(above(size)) for size, _ in sizes), default=0)
        for b in slices(batches, "text", _SLICE):
            h, first = tokens(b)
            if not len(h):
                continue
            n_words = np.diff(first)
            h, first = ended(h, first, pad)
            last = first[:-1] + n_words
            known = np.concatenate([[0], np.cumsum(pair_cells[pairs(h)])])
            ids, tkeys = b.column("doc_id").to_pylist(), b.column("tkey").to_numpy(zero_copy_only=False)
            for size, reps in sizes:
                over = max_edits(above(size))
                fits = np.maximum(n_words + 2 * over - size + 1, 0)
                begin = np.arange(int(fits.sum())) + np.repeat(first[:-1] - over - (np.cumsum(fits) - fits), fits)
                if size == 1:
                    begin = begin[word_cells[(h[begin] >> np.uint64(42)).astype(np.int64)]]
                else:
                    begin = begin[known[begin + size - 1] - known[begin] >= size - 1 - 2 * over]
                for s in range(0, len(begin), 20_000):
                    yield from candidates(h, first, last, begin[s:s + 20_000], size, reps, ids, tkeys, key_cells)

    def candidates(h, first, last, begin, size, reps, ids, tkeys, key_cells) -> Iterator[pa.RecordBatch]:
        x = h[begin[:, None] + np.arange(size)]
        found = walks(x, range(reps))
        hit = key_cells[0][(found >> np.uint64(42)).astype(np.int64)]
        hit &= key_cells[1][(found >> np.uint64(20) & np.uint64(_CELLS - 1)).astype(np.int64)]
        some = np.flatnonzero(hit.any(1))
        if not len(some):
            return
        label = words.run_hash(h, begin[some], size).view(np.int64)
        slack = max_edits(above(size))
        text = np.searchsorted(first - slack, begin[some], side="right") - 1
        out = []
        for row, t, i, mark in zip(some.tolist(), text.tolist(), begin[some].tolist(), label.tolist()):
            near = h[max(i - slack, first[t]):min(i + above(size) + slack, last[t])]
            out.append((ids[t], int(tkeys[t]), max(i - int(first[t]), 0), size, mark, found[row][hit[row]].view(np.int64).tolist(), near.view(np.int64).tolist()))
        yield batch(schema, zip(*out))

    seen = written(rows.mapInArrow(run, "doc_id long, tkey long, start int, size int, label long, keys array<long>, near array<long>"),
                   run_folder(spark, "decontamination"))
    # Copies of one window meet the items once.
    windows = seen.groupBy("label", "size").agg(F.first("keys").alias("keys"))
    met = windows.select("label", "size", F.explode("keys").alias("key")).join(keys, "key").select(
        "label", "size", "item_id", "at", "n_words").distinct()
    whole = items.where("at = 0").select("item_id", "words")
    found = seen.select("doc_id", "tkey", "start", "size", "label", "near").join(met, ["label", "size"])
    one_window = F.col("n_words") <= above(LONGEST)
    exact = verified(found.where(one_window).select("doc_id", "tkey", "item_id", "start", "near").join(whole, "item_id"))
    if items.where(~one_window).limit(1).count():
        exact = exact.unionByName(verified(around(rows, found.where(~one_window)).join(whole, "item_id")))
    return exact.groupBy("doc_id", "tkey", "item_id", "n_words").agg(F.min(F.struct("edits", "start")).alias("best")).select(
        "doc_id", "tkey", "item_id", F.col("best.start").alias("start"), F.col("best.edits").alias("edits"), "n_words")


def around(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, tkey, item_id, start, near) for items of several windows: the stretch of the
    document that can hold the whole item, read from its text again."""
    spots = found.groupBy("doc_id", "tkey", "item_id", "n_words", (F.col("start") - F.col("at")).alias("start")).agg(F.lit(1).alias("one"))
    spots = spots.groupBy("doc_id", "tkey").agg(F.collect_list(F.struct("item_id", "n_words", "start")).alias("spots"))
    same = rows.doc_id.eqNullSafe(spots.doc_id) & (rows.tkey == spots.tkey)
    both = rows.join(spots, same).select(rows.doc_id, rows.tkey, rows.text, "spots")
    schema = pa.schema([("doc_id", pa.int64()), ("tkey", pa.int64()), ("item_id", pa.int64()), ("start", pa.int32()), ("near", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", _SLICE):
            h, first = tokens(b)
            for t, spots_of in enumerate(b.column("spots").to_pylist()):
                for s in spots_of:
                    slack, start = max_edits(s["n_words"]) + LONGEST, max(s["start"], 0)
                    near = h[max(first[t] + s["start"] - slack, first[t]):min(first[t] + s["start"] + s["n_words"] + slack, first[t + 1])]
                    yield batch(schema, [[b.column("doc_id")[t].as_py()], [b.column("tkey")[t].as_py()], [s["item_id"]], [start],
                                         [near.view(np.int64).tolist()]])

    return both.mapInArrow(run, "doc_id long, tkey long, item_id long, start int, near array<long>")


def verified(spots: DataFrame) -> DataFrame:
    """(doc_id, tkey, item_id, start, edits, n_words) of the spots within the edits allowed."""
    result = pa.schema([("doc_id", pa.int64()), ("tkey", pa.int64()), ("item_id", pa.int64()), ("start", pa.int32()), ("edits", pa.int32()),
                        ("n_words", pa.int32())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[tuple, int | None] = {}
        for b in batches:
            out = []
            for r in b.to_pylist():
                key = (tuple(r["words"]), tuple(r["near"]))
                if key not in memory:
                    if len(memory) > 20_000:
                        memory.clear()
                    memory[key] = best_edits(*key, max_edits(len(r["words"])))
                if memory[key] is not None:
                    out.append((r["doc_id"], r["tkey"], r["item_id"], r["start"], memory[key], len(r["words"])))
            if out:
                yield batch(result, zip(*out))

    # Each edit takes away one of an item's distinct words at most: a loss-free check before the exact one.
    shared = F.size(F.array_intersect("words", "near")) >= F.size(F.array_distinct("words")) - F.floor(F.size("words") / 5)
    return spots.where(shared).select("doc_id", "tkey", "item_id", "start", "near", "words").mapInArrow(
        verify, "doc_id long, tkey long, item_id long, start int, edits int, n_words int")


def best_edits(item: tuple, near: tuple, most: int) -> int | None:
    """Least edit distance between the item and any stretch of near; None if above most.

    Myers' bit-parallel matching: bit i of the two masks says whether the distance rises or
    falls from the first i to the first i + 1 words of the item, and each word of near takes a
    few operations on whole masks.
    """
    m = len(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    places: dict[int, int] = {}
    for i, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << i
    rises, falls, now, least = full, 0, m, m
    for word in near:
        same = places.get(word, 0)
        level = (((same & rises) + rises) ^ rises) | same | falls
        up = falls | (full & ~(level | rises))
        down = level & rises
        if up & top:
            now += 1
        elif down & top:
            now -= 1
        up, down = up << 1 & full, down << 1 & full
        rises = down | (full & ~(level | up))
        falls = up & level
        least = min(least, now)
    return least if least <= most else None


def clean(docs: DataFrame, benchmark: DataFrame, recall: float = 0.95, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents in which no item was found, with all their columns, whatever their names."""
    found = leaks(docs, benchmark, recall, id_col, text_col).select(
        F.col("doc_id").alias("found_id"), F.col("tkey").alias("found_key")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"),
                       F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("key"))
    return rows.join(found, F.col("id").eqNullSafe(F.col("found_id")) & (F.col("key") == F.col("found_key")), "left_anti").select("row.*")
