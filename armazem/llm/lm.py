"""Language-model scores: a gated recurrent network with a class-factored output.

Words are dealt into classes: the most frequent ones and the end of a text stand alone, all
others follow the class of their ending, and endings are clustered by the words they stand next
to. The network reads a text's classes and predicts the next one; a word's share of its class
comes from counts over the whole training corpus. So the probability of a text is the product
over its words of P(class | what came before) x P(word | class), and the end counts as a word.

The network (one GRU layer, in numpy) is trained by truncated backpropagation on every word of
every training document, the state carried from window to window: each partition trains its own
copy and Spark averages the copies, in two rounds. For scores the state is carried across windows, so the whole document counts.
Words met rarely are counted in Spark tables and joined; the words sent to every worker are those
with more than 1/HEADS of all tokens, of which there are at most HEADS.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armazem.llm import words
from armazem.llm.runtime import batch, byte_offsets, crc, run_folder, ship, slices, texts, written

HEADS = 100_000
CELLS, CONTEXTS = 1024, 64
ALONE, CLUSTERS = 15, 32
CLASSES = ALONE + 1 + CLUSTERS
END = ALONE  # class of the end of a text
END_HASH = np.uint64(0)
HIDDEN, WINDOW, LANES = 16, 32, 256
SHARE = 64  # lanes from which on a window counts in full
_SLICE = 4 << 20
_HELD_WORDS = 1_000_000


def held_out(doc_id, folds: int):
    return crc(doc_id) % folds == 0


@dataclass
class Tokens:
    """Words of the texts, A-Z lower-cased: each different word's hash and cell of its ending, and
    the number of the word at each place; first: index of each text's first place."""

    keys: np.ndarray
    cells: np.ndarray
    which: np.ndarray
    first: np.ndarray

    def with_ends(self) -> tuple[np.ndarray, np.ndarray]:
        """(numbers with the end, numbered after all words, after each text, index of each text's first)."""
        return np.insert(self.which, self.first[1:], len(self.keys)), self.first + np.arange(len(self.first))


def tokens(rows: pa.RecordBatch) -> Tokens:
    w = words.words(*byte_offsets(rows.column("text")))
    h = w.hashes(lower=True)[0]
    h[h == END_HASH] = np.uint64(1)
    coded = pa.array(h).dictionary_encode()
    which, keys = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_numpy()
    at = np.empty(len(keys), np.int64)
    at[which[::-1]] = np.arange(len(which))[::-1]  # where each word stands first
    start, end = w.start[at], w.end[at]
    ending = np.zeros(len(keys), np.uint64)
    for k in (1, 2, 3):
        byte = np.where(end - k >= start, words.LOWER[w.data[np.maximum(end - k, 0)]], 0) if len(w) else np.zeros(0, np.uint8)
        ending = ending * np.uint64(256) + byte.astype(np.uint64)
    return Tokens(keys, (words.mixed(ending) % np.uint64(CELLS)).astype(np.int64), which, w.first)


def statistics(rows: DataFrame) -> DataFrame:
    """(kind, key, cell, n): 0 word counts by hash and cell, 1 cells by the cells beside them."""
    schema = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("cell", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(CELLS * CELLS, np.int64)  # cells by the cells after them
        held, size = [], 0

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            h, n, c = (np.concatenate(x) for x in zip(*held))
            keys, first, back = np.unique(h, return_index=True, return_inverse=True)
            return keys, np.bincount(back, n).astype(np.int64), c[first]

        def out() -> pa.RecordBatch:
            h, n, c = held[0]
            return batch(schema, [np.zeros(len(h), np.int32), h.view(np.int64), c.astype(np.int32), n])

        for b in slices(batches, "text", _SLICE):
            t = tokens(b)
            if len(t.which):
                same = np.ones(len(t.which), bool)
                same[t.first[:-1][t.first[:-1] < len(same)]] = False  # no word before it in its text
                cell = t.cells[t.which]
                pairs += np.bincount((cell[:-1] * CELLS + cell[1:])[same[1:]], minlength=len(pairs))
                held.append((t.keys, np.bincount(t.which, minlength=len(t.keys)), t.cells))
                size += len(t.keys)
            held.append((np.array([END_HASH]), np.array([b.num_rows]), np.array([-1])))
            if size > _HELD_WORDS:
                held = [merged()]
                size = len(held[0][0])
                if size > _HELD_WORDS // 2:
                    yield out()
                    held, size = [], 0
        if held:
            held = [merged()]
            yield out()
        pairs = pairs.reshape(CELLS, -1, CONTEXTS)
        beside = (pairs.sum(1) + pairs.reshape(CELLS, CELLS).T.reshape(CELLS, -1, CONTEXTS).sum(1)).ravel()
        some = np.flatnonzero(beside)
        if len(some):
            yield batch(schema, [np.ones(len(some), np.int32), some, np.zeros(len(some), np.int32), beside[some]])

    return rows.select("text").mapInArrow(run, "kind int, key long, cell int, n long").groupBy("kind", "key", "cell").agg(
        F.sum("n").alias("n"))


def clusters(beside: np.ndarray) -> np.ndarray:
    """Class of each cell: k-means over what stands beside it, weighted by how often."""
    weight = beside.sum(1) + 1e-9
    x = np.sqrt((beside + 0.01) / (beside + 0.01).sum(1, keepdims=True))
    chance = np.random.default_rng(5)
    centres = x[chance.choice(len(x), CLUSTERS, replace=False, p=weight / weight.sum() * 0.9 + 0.1 / len(x))]
    own = np.zeros(len(x), np.int64)
    for _ in range(25):
        own = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        for k in range(CLUSTERS):
            mine = own == k
            if mine.any():
                centres[k] = np.average(x[mine], axis=0, weights=weight[mine])
    return own + ALONE + 1


class Words:
    """What workers know of words: classes, and counts of the frequent ones."""

    def __init__(self, alone: np.ndarray, classes: np.ndarray, heads: np.ndarray, counts: np.ndarray, log_class: np.ndarray, n: int, v: int):
        self.alone, self.classes, self.heads, self.counts = alone, classes, heads, counts
        self.log_class, self.n, self.v = log_class, n, v  # log10 of each class's counts and smoothing

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of each frequent word, -1 for others."""
        if not len(self.heads):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.heads, h), len(self.heads) - 1)
        return np.where(self.heads[at] == h, at, -1)

    def classify(self, t: Tokens) -> np.ndarray:
        """Class of each different word, and of the end."""
        own = self.classes[t.cells]
        if len(self.alone):
            order = np.argsort(self.alone)
            at = np.minimum(np.searchsorted(self.alone[order], t.keys), len(self.alone) - 1)
            own = np.where(self.alone[order][at] == t.keys, order[at], own)
        return np.append(own, END)


def vocabulary(stats: DataFrame) -> Words:
    n, v = stats.where("kind = 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    heads = stats.where("kind = 0").where(F.col("n") > n / HEADS).select("key", "n").toPandas()
    keys = heads.key.to_numpy().view(np.uint64)
    order = np.argsort(keys)
    keys, counts = keys[order], heads.n.to_numpy()[order]
    beside = np.zeros(CELLS * CONTEXTS)
    near = stats.where("kind = 1").select("key", "n").toPandas()
    beside[near.key.to_numpy()] = near.n.to_numpy()
    words_only = keys != END_HASH
    by = np.lexsort((keys, -np.where(words_only, counts, -1)))
    alone = keys[by][:min(ALONE, int(words_only.sum()))]
    classes = clusters(beside.reshape(CELLS, CONTEXTS))
    # Words of a class that do not stand alone: all their counts, each smoothed, and one unknown.
    rest = stats.where("kind = 0 and cell >= 0").where(~F.col("key").isin([int(k) for k in alone.view(np.int64)]))
    total, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in rest.groupBy("cell").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        total[classes[r.cell]] += r.n
        kinds[classes[r.cell]] += r.v
    return Words(alone, classes, keys, counts, np.log10(total + 0.1 * (kinds + 1)), int(n), int(v))


# --- the network ---------------------------------------------------------------------------

SHAPES = ((CLASSES, 3 * HIDDEN), (HIDDEN, 3 * HIDDEN), (HIDDEN, CLASSES), (CLASSES,))


def parameters(share: np.ndarray) -> np.ndarray:
    """A start: small random weights, and each class's share of the corpus as the output's bias."""
    chance = np.random.default_rng(9)
    drawn = [chance.normal(0, 0.3, SHAPES[0]), chance.normal(0, 0.25, SHAPES[1]), chance.normal(0, 0.1, SHAPES[2]), np.log(share)]
    return np.concatenate([p.ravel() for p in drawn]).astype(np.float32)


def unpacked(flat: np.ndarray) -> list[np.ndarray]:
    out, at = [], 0
    for shape in SHAPES:
        size = int(np.prod(shape))
        out.append(flat[at:at + size].reshape(shape))
        at += size
    return out


def advance(x: np.ndarray, h: np.ndarray, u: np.ndarray, inner: np.ndarray, out: np.ndarray) -> None:
    """One step of the gated unit, units x texts: x, its input part, turns into the gates and the
    inner part, inner into what the state adds to them, out into the new state."""
    np.matmul(u, h, out=inner)
    gates, new = x[:2 * HIDDEN], x[2 * HIDDEN:]
    gates += inner[:2 * HIDDEN]
    gates *= 0.5
    np.tanh(gates, out=gates)  # the sigmoid
    gates *= 0.5
    gates += 0.5
    np.multiply(gates[HIDDEN:], inner[2 * HIDDEN:], out=out)
    new += out
    np.tanh(new, out=new)
    np.subtract(h, new, out=out)
    out *= gates[:HIDDEN]
    out += new


def step(x: np.ndarray, h: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step for texts as rows: (new state, gates, inner part)."""
    x, h = x.T.copy(), h.T.copy()
    inner, out = np.empty_like(x), np.empty_like(h)
    advance(x, h, u.T.copy(), inner, out)
    return tuple(a.T for a in (out, *np.split(x, 3), inner[2 * HIDDEN:]))


_rooms: dict[tuple, np.ndarray] = {}


def room(name: str, shape: tuple[int, ...], kind: np.dtype) -> np.ndarray:
    """An array used again by every window: fresh memory costs more than the work done in it."""
    size, held = math.prod(shape), _rooms.get((name, kind))
    if held is None or len(held) < size:
        held = _rooms[name, kind] = np.empty(size, kind)
    return held[:size].reshape(shape)


def exponents(wo: np.ndarray, bo: np.ndarray, states: np.ndarray, goal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(exponentials of the logits, time x classes x texts, the goals' logits); less the largest where they might overflow."""
    p = np.matmul(wo.T.copy(), states, out=room("p", (len(states), CLASSES, states.shape[2]), states.dtype))
    p += bo[:, None]
    if np.abs(bo).max() + np.abs(wo).sum(0).max() * max(1.0, np.abs(states[0]).max()) > 80:  # a state stays within 1 or its start
        p -= p.max(1, keepdims=True)
    chosen = p[np.arange(len(p))[:, None], goal, np.arange(p.shape[2])]
    return np.exp(p, out=p), chosen


def learn(flat: np.ndarray, seen: np.ndarray, goal: np.ndarray, mask: np.ndarray, h: np.ndarray,
          goes_on: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of the mean loss over one window (time x texts) and the state after it.

    goes_on: 0 where a new text begins, which starts without a state; 1 elsewhere. Arrays are laid
    out time x units x texts, so that each operation of a step runs over one piece of memory.
    """
    wx, u, wo, bo = unpacked(flat)
    (span, n), kind = seen.shape, flat.dtype
    act, inner = room("act", (span, 3 * HIDDEN, n), kind), room("inner", (span, 3 * HIDDEN, n), kind)
    before, states = room("before", (span, HIDDEN, n), kind), room("states", (span, HIDDEN, n), kind)
    now, from_class, from_state = h.T, wx.T.copy(), u.T.copy()
    for t in range(span):
        np.multiply(now, 1 if goes_on is None else goes_on[t], out=before[t])
        from_class.take(seen[t], axis=1, out=act[t], mode="clip")
        advance(act[t], before[t], from_state, inner[t], states[t])
        now = states[t]
    p, _ = exponents(wo, bo, states, goal)
    p *= (mask / (max(mask.sum(), 1) * p.sum(1)))[:, None]
    p[np.arange(span)[:, None], goal, np.arange(n)] -= mask / max(mask.sum(), 1)
    g_wo, g_bo = np.matmul(states, p.transpose(0, 2, 1)).sum(0), p.sum((0, 2))
    back = np.matmul(wo, p, out=room("back", (span, HIDDEN, n), kind))
    # Gradients of each step: at the new part, both gates, and the new part's share from the state.
    g_step, some, g_h = room("g_step", (span, 4 * HIDDEN, n), kind), np.empty((HIDDEN, n), kind), np.zeros((HIDDEN, n), kind)
    for t in range(span - 1, -1, -1):
        g, z, r, new = back[t], act[t, :HIDDEN], act[t, HIDDEN:2 * HIDDEN], act[t, 2 * HIDDEN:]
        g_new, g_z, g_r, g_inner = g_step[t].reshape(4, HIDDEN, n)
        g += g_h
        np.subtract(1, z, out=some)
        np.multiply(g, some, out=g_new)
        np.subtract(before[t], new, out=g_z)
        g_z *= g_new
        g_z *= z
        np.multiply(new, new, out=some)
        np.subtract(1, some, out=some)
        g_new *= some
        np.multiply(g_new, r, out=g_inner)
        np.subtract(1, r, out=some)
        np.multiply(g_inner, inner[t, 2 * HIDDEN:], out=g_r)
        g_r *= some
        np.matmul(u, g_step[t, HIDDEN:], out=g_h)
        g *= z
        g_h += g
        if goes_on is not None:
            g_h *= goes_on[t]
    turned = g_step.transpose(0, 2, 1)
    g_u = np.matmul(before, turned[:, :, HIDDEN:]).sum(0)
    one = room("one", (span, CLASSES, n), kind)
    one[:] = seen.astype(np.uint8)[:, None] == np.arange(CLASSES, dtype=np.uint8)[:, None]
    g_wx = np.matmul(one, turned[:, :, :3 * HIDDEN]).sum(0)
    g_wx = np.concatenate([g_wx[:, HIDDEN:], g_wx[:, :HIDDEN]], axis=1)
    return np.concatenate([g_wx.ravel(), g_u.ravel(), g_wo.ravel(), g_bo]), states[-1].T.copy()


class Trainer:
    """Adam over windows of LANES lanes: each lane reads whole texts one after another, the state
    carried on within a text."""

    def __init__(self, flat: np.ndarray, rate: float):
        self.flat, self.rate, self.turn = flat.copy(), rate, 0
        self.m, self.s = np.zeros_like(flat), np.zeros_like(flat)
        self.h, self.last = np.zeros((LANES, HIDDEN), np.float32), np.full(LANES, END)
        self.lanes: list[list[np.ndarray]] = [[] for _ in range(LANES)]
        self.waiting = [(0, k) for k in range(LANES)]  # heap of (words waiting, lane)

    def take(self, goals: list[np.ndarray]) -> None:
        """Deal texts (their classes, up to the end), longest first, to the lane with the fewest words."""
        for goal in sorted(goals, key=len, reverse=True):
            n, k = self.waiting[0]
            self.lanes[k].append(goal)
            heapq.heapreplace(self.waiting, (n + len(goal), k))
        self.train(self.waiting[0][0] // WINDOW * WINDOW)

    def finish(self) -> None:
        self.train(max(n for n, _ in self.waiting))

    def train(self, length: int) -> None:
        """Learn from the next words of every lane; lanes that run out are left out."""
        for a in range(0, length, WINDOW * 32):
            self.stretch(min(WINDOW * 32, length - a))

    def stretch(self, length: int) -> None:
        goal, seen = np.full((2, length, LANES), END)
        mask, goes_on = np.zeros((length, LANES), np.float32), np.ones((length, LANES), np.float32)
        for k, lane in enumerate(self.lanes):
            if not lane:
                continue
            line = lane[0] if len(lane) == 1 else np.concatenate(lane)
            now, n = line[:length], min(len(line), length)
            goal[:n, k], mask[:n, k] = now, 1
            seen[1:n, k] = now[:-1]
            # A text begins after an end; the class before a lane's first word is kept in front of it.
            seen[0, k] = self.last[k]
            goes_on[:n, k] = seen[:n, k] != END
            self.last[k] = now[-1]
            self.lanes[k] = [line[length:]] if len(line) > length else []
        self.waiting = [(max(n - length, 0), k) for n, k in self.waiting]
        heapq.heapify(self.waiting)
        for a in range(0, length, WINDOW):
            part = slice(a, a + WINDOW)
            live = mask[a] > 0
            self.step(seen[part, live], goal[part, live], mask[part, live], goes_on[part, live], live)

    def step(self, seen: np.ndarray, goal: np.ndarray, mask: np.ndarray, goes_on: np.ndarray, live: np.ndarray) -> None:
        g, self.h[live] = learn(self.flat, seen, goal, mask, self.h[live], goes_on)
        g *= min(1.0, 1.0 / (float(np.sqrt((g * g).sum())) + 1e-9))
        self.turn += 1
        self.m += 0.1 * (g - self.m)
        self.s += 0.001 * (g * g - self.s)
        # A window with few words, as in the last lanes of a partition, moves the weights less.
        rate = self.rate * min(1.0, float(mask.sum()) / (WINDOW * SHARE)) ** 0.5
        self.flat -= (rate * (self.m / (1 - 0.9 ** self.turn)) / (np.sqrt(self.s / (1 - 0.999 ** self.turn)) + 1e-8)).astype(np.float32)


def trained(rows: DataFrame, known: Words, flat: np.ndarray, turn: int) -> np.ndarray:
    """One round: a copy of the network per partition, averaged by the texts it saw."""
    shared = rows.sparkSession.sparkContext.broadcast(known)  # at most HEADS words
    schema = pa.schema([("values", pa.list_(pa.float32())), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, total = Trainer(flat, 0.02 / turn), 0
        for b in slices(batches, "text", _SLICE):
            t = tokens(b)
            numbers, starts = t.with_ends()
            classes = shared.value.classify(t)[numbers]
            trainer.take([classes[s:e] for s, e in zip(starts[:-1].tolist(), starts[1:].tolist())])
            total += b.num_rows
        trainer.finish()
        if total:
            yield batch(schema, [pa.array([trainer.flat.tolist()], pa.list_(pa.float32())), [total]])

    copies = rows.select("text").mapInArrow(run, "values array<float>, n long")
    mean = copies.select("n", F.posexplode("values")).groupBy("pos").agg((F.sum(F.col("col") * F.col("n")) / F.sum("n")).alias("v"))
    out = flat.copy()
    for r in mean.collect():  # as many rows as the network has weights
        out[r.pos] = r.v
    return out


def class_scores(flat: np.ndarray, classes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """log10 probability of each text's classes; the state goes on from window to window."""
    wx, u, wo, bo = unpacked(flat)
    size = np.diff(starts)
    order = np.argsort(-size, kind="stable")
    begin, size = starts[:-1][order], size[order]
    total = np.zeros(len(size))
    now, last = np.zeros((HIDDEN, len(size)), np.float32), np.full(len(size), END)
    from_class, from_state = wx.T.copy(), u.T.copy()
    at = 0
    while len(size) and at < size[0]:
        live = int(np.searchsorted(-size, -at, side="left"))
        span = min(WINDOW, int(size[0]) - at)
        place = np.minimum(begin[:live] + at + np.arange(span)[:, None], len(classes) - 1)
        goal = classes[place]
        seen = np.concatenate([last[None, :live], goal[:-1]])
        now, loss = now[:, :live], np.empty((span, live))
        states = room("states", (span, HIDDEN, live), flat.dtype)
        act, inner = (room(name, (3 * HIDDEN, live), flat.dtype) for name in ("act", "inner"))
        for t in range(span):
            from_class.take(seen[t], axis=1, out=act, mode="clip")
            advance(act, now, from_state, inner, states[t])
            now = states[t]
        now, few = now.copy(), max(1, WINDOW * LANES // live)
        for a in range(0, span, few):  # as many logits at a time as stay near the processor
            p, chosen = exponents(wo, bo, states[a:a + few], goal[a:a + few])
            loss[a:a + few] = chosen - np.log(p.sum(1))
        loss[at + np.arange(span)[:, None] >= size[:live]] = 0
        total[:live] += loss.sum(0)
        last[:live] = goal[-1]
        at += span
    out = np.zeros(len(size))
    out[order] = total / np.log(10)
    return out


def scored(docs: DataFrame, folds: int = 10, rounds: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from rows whose crc32 of the doc_id as text (a missing id: empty text) is not
    divisible by folds. base_score: add-0.1 unigram model; score: log10 probability by the
    network, unknown words sharing one place in each class. Null and empty texts consist of the
    end alone. Repeated rows give one row each; an empty table gives none; without training rows
    every word is unknown.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = texts(docs, id_col, text_col)
    training = rows.where(~held_out(F.col("doc_id"), folds))
    stats = written(statistics(training), run_folder(spark, "lm-words"))
    known = vocabulary(stats)
    share = np.full(CLASSES, 1.0)
    place = {int(h): k for k, h in enumerate(known.alone)}
    for h, c in zip(known.heads.tolist(), known.counts.tolist()):
        if h in place:
            share[place[h]] += c
        elif h == int(END_HASH):
            share[END] += c
    share[ALONE + 1:] += np.maximum(10 ** known.log_class[ALONE + 1:], 0)
    flat = parameters(share / share.sum())
    for turn in range(1, rounds + 1):
        flat = trained(training, known, flat, turn)
    shared = spark.sparkContext.broadcast(known)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()),
                        ("rare", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = shared.value
        for b in slices(batches, "text", _SLICE):
            t = tokens(b)
            numbers, starts = t.with_ends()
            keys, classes = np.append(t.keys, END_HASH), k.classify(t)
            text = np.repeat(np.arange(b.num_rows), np.diff(starts))
            at = k.find(keys)
            frequent = at >= 0
            log_n = np.where(frequent, np.log10(k.counts[at] + 0.1) if len(k.counts) else 0.0, 0.0)
            inside = np.where(classes > ALONE, log_n - k.log_class[classes], 0.0)

            def by_text(x):
                return np.bincount(text, x[numbers], b.num_rows)

            rare = np.flatnonzero(~frequent[numbers])
            new, times = np.unique(text[rare] * len(keys) + numbers[rare], return_counts=True)
            edges = np.searchsorted(new, np.arange(b.num_rows + 1) * len(keys)).astype(np.int32)
            rare, times = keys[new % len(keys)].view(np.int64), times.astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(edges), pa.array(x)) for x in (rare, times)]
            yield batch(schema, [b.column("doc_id"), np.diff(starts), by_text(frequent).astype(np.int64), by_text(log_n),
                                 class_scores(flat, classes[numbers], starts) + by_text(inside), *lists])

    first = written(rows.mapInArrow(run, "doc_id long, n_tokens long, n_known long, base double, score double, rare array<long>, times array<int>")
                    .withColumn("row", F.monotonically_increasing_id()), run_folder(spark, "lm-scores"))
    rare = first.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", F.col("w.rare").alias("key"), F.col("w.times").alias("times"))
    counts = stats.where("kind = 0").where(F.col("n") <= known.n / HEADS).select("key", "n")
    added = rare.join(counts, "key", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.1)).alias("more"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known"))
    even = float(np.log10(known.n + 0.1 * (known.v + 1)))
    more = F.coalesce("more", F.lit(0.0))
    return first.drop("rare", "times").join(added, "row", "left").select(
        "doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(known.n).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * even).alias("base_score"), (F.col("score") + more).alias("score"))
