"""Vector codes against plain Lloyd rounds over all entries."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from armazem.llm import codes, queries

NAN, INF = float("nan"), float("inf")


def brute(rows, parts, entries, rounds):
    """{row number: (code, error, label_error)}, digest; rows: (vec_id, vector, label)."""
    good = [(i, r) for i, r in enumerate(rows) if r[1] and all(x is not None and np.isfinite(x) for x in r[1])]
    whole = {i: [int(np.floor(256 * float(x))) for x in r[1]] for i, r in good}
    rank = sorted((i for i, _ in good if len(whole[i]) % parts == 0), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, whole[i]))
    length = len(whole[rank[0]])
    rank = [i for i in rank if len(whole[i]) == length]
    size = length // parts
    cut = {i: [whole[i][p * size:(p + 1) * size] for p in range(parts)] for i in rank}
    books = [[list(cut[i][p]) for i in rank[:entries]] for p in range(parts)]

    def assign():
        return {i: [min((sum((a - b) ** 2 for a, b in zip(cut[i][p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)] for i in rank}

    for _ in range(rounds):
        own = assign()
        for p in range(parts):
            of = defaultdict(list)
            for i in rank:
                of[own[i][p][1]].append(cut[i][p])
            for k, xs in of.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
    own = assign()
    total = Counter()
    for i in rank:
        total[rows[i][2]] += sum(d for d, _ in own[i])
    return {i: ("".join(f"{k:02x}" for _, k in own[i]), sum(d for d, _ in own[i]), total[rows[i][2]]) for i in rank}, hashlib.sha256(
        ",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()


def run(spark, rows, parts=4, entries=8, rounds=2):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns(
        {c: queries.F.lit(1) for c in ("v", "tree", "code", "error", "same", "good")})
    return codes.judged(*codes.quantised(frame, parts, entries, rounds))


def agrees(spark, rows, parts=4, entries=8, rounds=2):
    want, digest = brute(rows, parts, entries, rounds)
    got = run(spark, rows, parts, entries, rounds).collect()
    assert Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got) == Counter(
        (rows[i][0], *w, digest) for i, w in want.items())


def vectors(n, dims=16, spread=1.0, seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, dims)) * spread
    return [(i, (centres[rng.integers(20)] + rng.normal(size=dims) * 0.1).tolist(), int(rng.integers(4))) for i in range(n)]


def test_codes_of_clusters_equal_plain_rounds(spark):
    agrees(spark, vectors(900))


def test_ties_repeats_and_odd_rows(spark):
    rows = [(i, [float(i % 3)] * 8, None if i % 5 == 0 else i % 2) for i in range(120)]
    rows += [(3, [1.0] * 8, 1), (3, [0.5] * 8, 1), (None, [2.0] * 8, 2), (200, None, 1), (201, [], 1), (202, [1.0, None] * 4, 1),
             (203, [NAN] * 8, 1), (204, [INF] * 8, 1), (205, [1.0] * 12, 1), (206, [1.0] * 7, 1), (-1, [1.0] * 7, 1)]
    agrees(spark, rows, parts=2, entries=5)


def test_fewer_vectors_than_entries(spark):
    agrees(spark, vectors(5), entries=64)


def test_values_beyond_the_narrow_range(spark):
    agrees(spark, [(i, [float(i * 30_000)] * 4 + [float(-i) * 2e4] * 4, i % 2) for i in range(40)], parts=2, entries=6)
    far = run(spark, [(i, [1e12 * i] * 4, 1) for i in range(9)], parts=2, entries=2).collect()
    assert len(far) == 9 and {r.label_error for r in far} == {None}


def test_empty_table(spark):
    assert run(spark, []).collect() == []
    assert run(spark, [(1, None, 1)]).collect() == []


def test_trees_find_the_nearest_entry_and_spare_distances():
    rng = np.random.default_rng(1)
    for n, k, wide in ((1, 1, 9), (3, 2, 3), (700, 64, 4), (4096, 64, 400), (4096, 37, 2)):
        x, e = rng.integers(-wide, wide, (n, 4)), rng.integers(-wide, wide, (k, 4))
        x = x[codes.ordered(x, codes.depth(n, codes.LEAF))]
        own, sums, counts, _ = codes.assigned(x, e)
        assert (own == ((x[:, None] - e[None]) ** 2).sum(2).argmin(1)).all()
        for j in range(k):
            assert counts[j] == (own == j).sum() and (sums[j] == x[own == j].sum(0)).all()
    centres = rng.integers(-1000, 1000, (64, 4)) * 100
    x = centres[rng.integers(64, size=4096)] + rng.integers(-9, 9, (4096, 4))
    x = x[codes.ordered(x, codes.depth(4096, codes.LEAF))]
    assert codes.assigned(x, centres)[3] < 4096 * 0.9  # whole nodes were assigned


@pytest.mark.parametrize("name", ["op12_vector_codes"])
def test_query_on_the_given_table(spark, folder, con, name):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want, digest = brute(rows, 16, 64, 2)
    got = queries.QUERIES[name](spark, folder).collect()
    sql = con.execute(f"SELECT vec_id, code, error, label_error, codebooks_sha256 FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert Counter(sql) == Counter(map(tuple, got))
    assert sorted((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got) == sorted(
        (rows[i][0], *w, digest) for i, w in want.items())
