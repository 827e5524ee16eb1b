"""Phrases whose words stand together more often than their parts suggest.

The corpus is cut into slices of one language. In a slice words get ids by frequency rank, and
phrases of k + 1 words are pairs of a frequent phrase of k words and the word after it. Pairs of
ids are split into square tiles: a well-filled tile, as those of low ids are, is counted by direct
address (one bincount over its cells), the pairs of the other tiles as sorted coordinates. Counts
of all slices meet by key (tally.py), which answers each slice which of its phrases are frequent;
these are ranked again by frequency and paired anew, up to the longest phrases. A phrase can only
be frequent if both its shorter ends are, so a slice's state shrinks at each length.

Words and phrases are told apart by 64-bit hashes in the counts (see words.py); the phrases
returned carry their words, and scoring joins on these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armazem.llm import tally, words
from armazem.llm.runtime import batch, byte_offsets, parts, run_folder, ship, written
from armazem.llm.tally import narrow, widen

SLICE, BUFFER = 8 << 20, 24 << 20
#: Bits of a tile's side, and how many pairs make counting its cells cheaper than sorting.
SIDE, FULL = 10, 1 << 16
# The bytes that end a piece (. , ; : ! ? and \n \v \f \r); blanks and tabs part words.
ENDS = np.isin(np.arange(256), [46, 44, 59, 58, 33, 63, 10, 11, 12, 13])
GAPS = ENDS | np.isin(np.arange(256), [32, 9])
_STEP = np.uint64(0xD6E8FEB86659FD93)

STATE = pa.schema([("slice", pa.int64()), ("lang", pa.string()), ("n_words", pa.int64()), ("n_units", pa.int64()),
                   ("words", pa.binary()), ("tok", pa.binary()), ("unit", pa.binary()), ("k", pa.int32()), ("phrase", pa.string()), ("a", pa.int64())])
STATE_DDL = "slice long, lang string, n_words long, n_units long, words binary, tok binary, unit binary, k int, phrase string, a long"


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of a first occurrence, count, id of each item); ids by falling count."""
    _, first, inverse, count = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    order = np.argsort(-count, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return first[order], count[order], rank[inverse]


def paired(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, int]:
    """(id of each pair, by falling count; number of different pairs), counted tile by tile."""
    if not len(left):
        return np.zeros(0, np.int64), 0
    wide = (int(right.max()) >> SIDE) + 1
    tile = (left >> SIDE) * wide + (right >> SIDE)
    number, load = np.unique(tile, return_counts=True)
    ids, counts, n = np.empty(len(left), np.int64), [], 0
    dense = number[load >= FULL]
    sparse = np.flatnonzero(~np.isin(tile, dense))
    for t in dense.tolist():
        own = np.flatnonzero(tile == t)
        mask = (1 << SIDE) - 1
        cell = (left[own] & mask) << SIDE | (right[own] & mask)
        count = np.bincount(cell, minlength=1 << 2 * SIDE)
        some = np.flatnonzero(count)
        place = np.zeros(1 << 2 * SIDE, np.int64)
        place[some] = np.arange(n, n + len(some))
        ids[own] = place[cell]
        counts.append(count[some])
        n += len(some)
    if len(sparse):
        key = left[sparse] * (int(right.max()) + 1) + right[sparse]
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        ids[sparse] = inverse + n
        counts.append(count)
        n += len(count)
    order = np.argsort(-np.concatenate(counts), kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    return rank[ids], n


def tokens(data: np.ndarray) -> tuple[words.Words, np.ndarray]:
    """(words of the lower-cased bytes, whether a piece ends before each)."""
    w = words.words(np.array([0, len(data)]), data, GAPS)
    ends = np.cumsum(ENDS[data], dtype=np.int64)
    after = np.zeros(len(w), bool)
    if len(w):
        after[1:] = ends[w.start[1:]] != ends[w.end[:-1] - 1]
    return w, after


def encoded(lang: str, text: bytes) -> tuple[int, int, bytes, np.ndarray] | None:
    """(words, different words, these joined by line breaks, ids of all words with -1 between pieces)."""
    data = words.LOWER[np.frombuffer(text, np.uint8)]
    w, after = tokens(data)
    if not len(w):
        return None
    first, _, ids = ranked(w.hashes()[0])
    raw = data.tobytes()
    different = b"\n".join(raw[a:b] for a, b in zip(w.start[first].tolist(), w.end[first].tolist()))
    return len(w), len(first), different, np.insert(ids, np.flatnonzero(after), -1).astype(np.int32)


def chunks(text: bytes) -> Iterator[bytes]:
    """A long text in parts of about a slice, cut where pieces end (a longer piece stays whole)."""
    at = 0
    while len(text) - at > SLICE:
        cuts = np.flatnonzero(ENDS[np.frombuffer(text, np.uint8, SLICE, at)])
        if len(cuts):
            end = at + int(cuts[-1]) + 1
        else:
            later = [x for x in (text.find(bytes([e]), at + SLICE) for e in np.flatnonzero(ENDS).tolist()) if x >= 0]
            end = min(later) + 1 if later else len(text)
        yield text[at:end]
        at = end
    if at < len(text):
        yield text[at:]


def sliced(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """Slices of one language: their words, and the id of each word of the text in order."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}
        number = TaskContext.get().partitionId() << 32

        def row(lang: str) -> pa.RecordBatch | None:
            nonlocal number
            size.pop(lang)
            made = encoded(lang, b"\n".join(held.pop(lang)))
            if made is None:
                return None
            n, different, body, ids = made
            number += 1
            packed = narrow(ids)
            return batch(STATE, [[number], [lang], [n], [different], [zstandard.compress(body, 1)], [packed], [packed], [1], [None], [None]])

        for rows in batches:
            langs, texts = rows.column("lang").to_pylist(), rows.column("text")
            offsets, data = byte_offsets(texts)
            for i, lang in enumerate(langs):
                for part in chunks(data[offsets[i]:offsets[i + 1]].tobytes()):
                    held.setdefault(lang, []).append(part)
                    size[lang] = size.get(lang, 0) + len(part) + 1
                    while size.get(lang, 0) >= SLICE or sum(size.values()) >= BUFFER:
                        if (out := row(lang if size.get(lang, 0) >= SLICE else max(size, key=size.get))) is not None:
                            yield out
        for lang in list(size):
            if (out := row(lang)) is not None:
                yield out

    return rows.mapInArrow(run, STATE_DDL)


class Units:
    """The phrases of k words of a slice: where each stands first, how often, and its key."""

    def __init__(self, state: dict):
        import zstandard

        self.k, self.lang = state["k"], state["lang"]
        self.body = zstandard.decompress(state["words"])
        self.tok = widen(state["tok"], np.int32).astype(np.int64)
        self.unit = self.tok if self.k == 1 else widen(state["unit"], np.int32).astype(np.int64)
        at = np.flatnonzero(self.unit >= 0)
        n = state["n_units"]
        self.count = np.bincount(self.unit[at], minlength=n)
        self.first = np.zeros(n, np.int64)
        self.first[self.unit[at][::-1]] = at[::-1]

    def keys(self) -> np.ndarray:
        import xxhash

        raw = np.frombuffer(self.body, np.uint8)
        seed = np.uint64(xxhash.xxh64_intdigest(self.lang.encode()))
        word = words.mixed(words.words(np.array([0, len(raw)]), raw, np.arange(256) == 10).hashes()[0] + seed)
        out = np.zeros(len(self.first), np.uint64)
        for j in range(self.k):
            out = out * _STEP + word[self.tok[self.first + j]]
        return words.mixed(out)

    def phrases(self, which: np.ndarray) -> list[str]:
        each = self.body.split(b"\n")
        return [b" ".join(each[t] for t in self.tok[f:f + self.k].tolist()).decode() for f in self.first[which].tolist()]

    def longer(self, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(tok, unit, number of units) for phrases of one more word, of which both ends are frequent."""
        good = np.append(frequent, False)[self.unit]  # -1 reads the last
        at = np.flatnonzero(good[:-1] & good[1:])
        ids, n = paired(self.unit[at], self.tok[at + self.k])
        unit = np.full(len(self.tok), -1, np.int64)
        unit[at] = ids
        change = np.zeros(len(self.tok) + 1, np.int64)
        change[at] += 1
        np.subtract.at(change, at + self.k + 1, 1)
        used = np.cumsum(change[:-1]) > 0
        kept = used.copy()
        kept[1:] |= used[:-1]  # one break after each run
        tok = np.where(used, self.tok, -1)
        return tok[kept].astype(np.int32), unit[kept].astype(np.int32), n


def counted(state: DataFrame, n: int) -> DataFrame:
    """Each slice's phrases and their counts, dealt by key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for i in range(rows.num_rows):
                r = rows.slice(i, 1).to_pylist()[0]
                units = Units(r)
                yield from tally.sent(r["slice"], units.keys(), units.count, n)

    return state.mapInArrow(run, tally.SENT_DDL)


def advanced(rows: DataFrame, n: int, last: bool) -> DataFrame:
    """From slices with their answers: the frequent phrases, each once, and the slices with phrases
    of one more word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        for state, found in tally.by_slice(batches, "tok"):
            units = Units(state)
            frequent, _, total = tally.received(found, units.keys(), n)
            own = np.flatnonzero(total)
            for at in range(0, len(own), 10_000):
                some = own[at:at + 10_000]
                nulls = [None] * len(some)
                yield batch(STATE, [nulls, [units.lang] * len(some), *[nulls] * 5, [units.k] * len(some), units.phrases(some), total[some].tolist()])
            if last:
                continue
            tok, unit, different = units.longer(frequent)
            if different:
                yield batch(STATE, [[state["slice"]], [units.lang], [state["n_words"]], [different], [zstandard.compress(units.body, 1)],
                                    [narrow(tok)], [narrow(unit)], [units.k + 1], [None], [None]])

    return rows.mapInArrow(run, STATE_DDL)


def frequent_phrases(docs: DataFrame, longest: int = 5, least: int = 100, lang_col: str = "lang",
                     text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """((lang, k, phrase, a) of all phrases of 1 to `longest` words met at least `least` times in
    their language, (lang, n) of all languages with words)."""
    spark = docs.sparkSession
    ship(spark)
    folder = run_folder(spark, "collocations")
    state = written(sliced(docs, lang_col, text_col), f"{folder}/0")
    n_words = state.groupBy("lang").agg(F.sum("n_words").alias("n"))
    found = None
    for k in range(1, longest + 1):
        size, slices = state.agg(F.coalesce(F.sum("n_units"), F.lit(0)), F.count("*")).first()
        if not slices:
            break
        n = tally.groups(spark, size)
        answered = tally.answers(counted(state, n), n, least)
        rows = tally.together(state, answered, max(parts(spark), slices // 4), "tok")
        step = written(advanced(rows, n, k == longest), f"{folder}/{k}")
        state = step.where("slice is not null")
        some = step.where("slice is null").select("lang", "k", "phrase", "a")
        found = some if found is None else found.unionByName(some)
    if found is None:
        found = spark.createDataFrame([], "lang string, k int, phrase string, a long")
    return found, n_words


def part_of(split: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(split, start, size), " ")


def collocations(docs: DataFrame, longest: int = 5, least: int = 100, top: int = 2000, lang_col: str = "lang",
                 text_col: str = "text") -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score, k (its words).

    Words are runs without blanks and tabs inside pieces, and pieces are parted by . , ; : ! ? and
    line breaks; A-Z are lower-cased. a: occurrences of the phrase, overlapping ones included; n:
    all words of the language; a cut into a first and a last part with l and r occurrences scores
    floor(1000 a n / (l r)), the lowest-scoring cut counts, ties to the shortest first part. A phrase
    that lies inside a longer frequent one met as often is dropped. Missing languages are `und`,
    null texts are empty; repeated rows count; ids and other columns are not read. A language
    without phrases, and an empty table, give no rows. Very long texts are cut between pieces.
    """
    spark = docs.sparkSession
    folder = run_folder(spark, "phrases")
    found, n_words = frequent_phrases(docs, longest, least, lang_col, text_col)
    found = written(found.withColumn("w", F.split("phrase", " ")), f"{folder}/found")
    counts = found.select("lang", "phrase", "a")
    long = found.where("k > 1")
    # Phrases inside longer ones: each longer phrase names its parts, the most frequent whole counts.
    inside = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("k") - m + 1), lambda i: part_of(F.col("w"), i, m))))
    whole = long.where("k > 2").select("lang", F.explode(F.array_distinct(inside)).alias("phrase"), F.col("a").alias("over")).groupBy(
        "lang", "phrase").agg(F.max("over").alias("over"))
    left = long.join(whole, ["lang", "phrase"], "left").where("over is null or 100 * over < 100 * a").select("lang", "phrase", "k", "a", "w")
    cut = left.select("lang", "phrase", "k", "a", F.explode(F.transform(F.sequence(F.lit(1), F.col("k") - 1), lambda c: F.struct(
        c.alias("at"), part_of(F.col("w"), F.lit(1), c).alias("head"), part_of(F.col("w"), c + 1, F.col("k") - c).alias("tail")))).alias("c")).select(
        "lang", "phrase", "k", "a", "c.*")
    cut = cut.join(counts.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l")), ["lang", "head"]).join(
        counts.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r")), ["lang", "tail"])
    cut = cut.join(n_words, "lang")
    # Decimals of 38 digits hold the products of counts up to 10^14 words.
    score = F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(n as decimal(16,0)))"
                   " div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))")
    scored = cut.withColumn("score", score.cast("long"))
    lowest = scored.groupBy("lang", "phrase", "k", "a", "n").agg(F.min(F.struct("score", "at", "l", "r")).alias("m")).select(
        "lang", "phrase", "k", "a", "n", "m.score", "m.l", "m.r")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return lowest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", F.col("k").cast("long").alias("k"))
