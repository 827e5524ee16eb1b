"""Toxicity by weak supervision.

Voters are lexicon entries (words) and patterns (beginnings of words), taken from the labelled
rows: those met in clearly more toxic rows than clean ones; the given label is one voter more.
A generative label model with a latent class per row estimates each voter's hit and false-hit
rate by expectation maximisation, and the correlations that remain between voters given the
class; a voter's say is divided by the number of voters it moves with. A logistic regression
over the entries found in a text is then trained on the posterior labels and scores every text.

Fitting uses a sample of labelled rows of bounded size (`fit_rows`); scoring reads all rows and
whole texts. Words are runs of letters and digits, A-Z lower-cased; other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armazem.llm import words
from armazem.llm.runtime import batch, byte_offsets, crc, run_folder, ship, slices, texts, written

PREFIXES = (4, 5, 6)
LABELS_AT_LEAST = 0.9  # least accuracy granted to given labels
_SLICE = 1 << 20
_SALTS = [np.uint64(0x5851F42D4C957F2D * (k + 1) % (1 << 64)) for k in range(len(PREFIXES) + 1)]


def entries(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(text, entry hash) of every word and word beginning."""
    w = words.words(*byte_offsets(rows.column("text")), words.MARKS)
    whole, *starts = w.hashes(lower=True, prefixes=PREFIXES)
    size, text = w.end - w.start, w.text
    found = [(text, whole ^ _SALTS[0])]
    for k, h, salt in zip(PREFIXES, starts, _SALTS[1:]):
        long = size > k
        found.append((text[long], h[long] ^ salt))
    return np.concatenate([t for t, _ in found]), np.concatenate([h for _, h in found])


class Lexicon:
    """Chosen entries, looked up by hash through a table of their leading bits."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes.astype(np.uint64))
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def found(self, rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, entry number), sorted."""
        text, h = entries(rows)
        maybe = self.bits[(h >> np.uint64(44)).astype(np.int64)]
        text, h = text[maybe], h[maybe]
        if not len(self.hashes) or not len(h):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        hit = self.hashes[at] == h
        both = np.unique(text[hit] * len(self.hashes) + at[hit])
        return both // len(self.hashes), both % len(self.hashes)


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float

    def scores(self, rows: pa.RecordBatch) -> np.ndarray:
        text, entry = self.lexicon.found(rows)
        total = np.bincount(text, self.weights[entry], rows.num_rows) if len(text) else np.zeros(rows.num_rows)
        return 1 / (1 + np.exp(-(total + self.bias)))


def held_out(doc_id: Column, folds: int) -> Column:
    return crc(doc_id) % folds == 0


def sample(docs: DataFrame, labels: DataFrame, folds: int, fit_rows: int) -> DataFrame:
    """(text, toxic) of at most fit_rows labelled documents outside the held-out fold."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic")).where(~held_out(F.col("doc_id"), folds))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    # At most fit_rows rows of 12 bytes: the bound is the parameter.
    return docs.join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def entry_counts(rows: DataFrame, toxic: int, least: int, among: np.ndarray | None = None) -> DataFrame:
    """(entry, n): in how many texts of one label each entry occurs."""
    schema = pa.schema([("entry", pa.int64()), ("n", pa.int64())])
    lexicon = None if among is None else Lexicon(among)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", _SLICE):
            if lexicon is None:
                text, h = entries(b)
                order = np.lexsort((text, h))
                text, h = text[order], h[order]
                new = np.concatenate([[True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])]) if len(h) else np.zeros(0, bool)
                entry, n = np.unique(h[new], return_counts=True)
            else:
                at, n = np.unique(lexicon.found(b)[1], return_counts=True)
                entry = lexicon.hashes[at]
            yield batch(schema, [entry.view(np.int64), n.astype(np.int64)])

    return rows.where(F.col("toxic") == toxic).select("text").mapInArrow(run, "entry long, n long").groupBy("entry").agg(
        F.sum("n").alias("n")).where(F.col("n") >= least)


def label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Posterior of the latent class of each row from its votes (rows x voters, 0 or 1).

    A voter speaks where its entry is found and abstains elsewhere; one more voter speaks where
    nothing is found. The given labels are a voter too, of an accuracy that is estimated and at
    least LABELS_AT_LEAST. Hit rates, false-hit rates, accuracies and the prior are re-estimated
    in turn; every few rounds the correlations of the voters within the classes are, too, and
    each voter's log-odds are divided by the voters it moves with.
    """
    v = np.concatenate([votes, votes.sum(1, keepdims=True) == 0], axis=1).astype(np.float64)
    post, share = 0.02 + 0.96 * labels, np.ones(v.shape[1])
    for turn in range(rounds):
        up, down = post.sum(), (1 - post).sum()
        hit = np.clip((post @ v + 0.1) / (up + 1), 1e-4, 1 - 1e-4)
        false = np.clip(((1 - post) @ v + 0.1) / (down + 1), 1e-5, 1 - 1e-4)
        right = [np.clip(x, LABELS_AT_LEAST, 0.999) for x in (post @ labels / up, (1 - post) @ (1 - labels) / down)]
        if turn % 5 == 0:  # from the start: else copies of one voter become the class
            rest = v - (post[:, None] * hit + (1 - post)[:, None] * false)
            spread = np.sqrt((rest ** 2).mean(0)) + 1e-9
            moves = np.abs(rest.T @ rest / len(v) / np.outer(spread, spread))
            np.fill_diagonal(moves, 0)
            moves[-1] = 0  # silence is the voters' absence, not a copy of one
            share = 1 / (1 + np.where(moves > 0.3, moves, 0).sum(1))
        told = np.where(labels == 1, np.log(right[0] / (1 - right[1])), np.log((1 - right[0]) / right[1]))
        odds = np.log(up / down) + v @ (share * np.log(hit / false)) + told
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - post).max() < 1e-4 and turn > 5:
            break
        post = new
    return post


def regression(row: np.ndarray, entry: np.ndarray, n: int, size: int, target: np.ndarray, ridge: float, steps: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression over sparse 0/1 features, by gradient steps with momentum (Adam)."""
    rate = np.clip(target.mean(), 1e-4, 1 - 1e-4)
    w = np.zeros(size + 1)
    w[-1] = np.log(rate / (1 - rate))
    m, s = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-(np.bincount(row, w[entry], n) + w[-1])))
        off = p - target
        g = np.append(np.bincount(entry, off[row], size) / n + ridge * w[:-1], off.mean())
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.999 ** t)) + 1e-8)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, fit_rows: int = 20_000, lexicon_size: int = 2048,
        voters: int = 256, least: int = 5) -> Model:
    """Fit on labelled rows outside the held-out fold; docs: doc_id and text.

    Without labelled toxic rows, or without any entry that tells them apart, every score is the
    smoothed share of toxic labels.
    """
    rows = written(sample(docs, labels, folds, fit_rows), run_folder(docs.sparkSession, "toxicity"))
    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    yes, no = sizes.get(1, 0), sizes.get(0, 0)
    none = Model(Lexicon(np.zeros(0, np.uint64)), np.zeros(0), float(np.log((yes + 0.5) / (no + 0.5)) if yes else -10.0))
    if not yes:
        return none
    # The sample is bounded, and so is what its texts hold.
    hits = entry_counts(rows, 1, least).toPandas()
    if not len(hits):
        return none
    names = hits.entry.to_numpy().view(np.uint64)
    misses = entry_counts(rows, 0, 1, names).toPandas()
    false = dict(zip(misses.entry.tolist(), misses.n.tolist()))
    a = hits.n.to_numpy().astype(float)
    b = np.array([false.get(e, 0) for e in hits.entry.tolist()], float)
    odds = np.log((a + 0.5) / (yes - a + 0.5)) - np.log((b + 0.5) / (no - b + 0.5))
    z = odds / np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    best = np.lexsort((names, -z))
    best = best[(odds[best] > 2) & (z[best] > 3.5)][:lexicon_size]
    if not len(best):
        return none
    lexicon = Lexicon(names[best])
    place = np.argsort(np.argsort(names[best]))  # entry numbers follow the hashes
    schema = pa.schema([("toxic", pa.int32()), ("found", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", _SLICE):
            text, entry = lexicon.found(b)
            edges = np.searchsorted(text, np.arange(b.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(entry, pa.int32()))
            yield batch(schema, [b.column("toxic"), lists])

    seen = rows.mapInArrow(run, "toxic int, found array<int>").collect()  # at most fit_rows short lists
    seen = sorted((r.toxic, tuple(r.found)) for r in seen)  # the order of rows must not matter
    row = np.repeat(np.arange(len(seen)), [len(s) for _, s in seen])
    entry = np.array([e for _, s in seen for e in s], np.int64)
    n = min(voters, len(best))
    chosen = np.full(len(best), -1)
    chosen[place[:n]] = np.arange(n)
    votes = np.zeros((len(seen), n), np.uint8)
    mine = chosen[entry] >= 0
    votes[row[mine], chosen[entry[mine]]] = 1
    posterior = label_model(votes, np.array([t for t, _ in seen], float))
    weights, bias = regression(row, entry, len(seen), len(best), posterior, 1e-4)
    return Model(lexicon, weights, bias)


def scored(docs: DataFrame, labels: DataFrame, folds: int = 5, fit_rows: int = 20_000,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    held_out: crc32 of the doc_id as text divisible by folds (a missing id counts as empty
    text); labels of such rows are never read. score lies between 0 and 1, higher where toxic is
    likelier; empty and null texts get the score of a text without any entry. predicted is 1
    from 0.5 on. Repeated rows give one row each; an empty table gives none.
    """
    rows = texts(docs, id_col, text_col)
    ship(docs.sparkSession)
    model = fit(rows, labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic"), folds, fit_rows)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", _SLICE):
            yield batch(schema, [b.column("doc_id"), model.scores(b)])

    return rows.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, folds: int = 5, fit_rows: int = 20_000,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents the classifier does not call toxic, with all their columns."""
    ship(docs.sparkSession)
    rows = texts(docs, id_col, text_col)
    model = fit(rows, labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic"), folds, fit_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # Only the text is handed on, so no other column's name matters.
            plain = b.column(b.schema.names.index(text_col)).cast(pa.string()).fill_null("")
            at = 0
            for s in slices([pa.RecordBatch.from_arrays([plain], ["text"])], "text", _SLICE):
                yield b.slice(at, s.num_rows).filter(pa.array(model.scores(s) < 0.5))
                at += s.num_rows

    return docs.mapInArrow(run, docs.schema)
