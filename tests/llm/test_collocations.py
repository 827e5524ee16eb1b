"""Phrase collocations against counting by hand."""

import random
import re
from collections import Counter

import numpy as np
from armazem.llm import collocations, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, longest, least, top):
    """rows: (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    often = {p: a for p, a in f.items() if a >= least}
    inside = Counter()
    for (lang, w), a in often.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                inside[lang, w[i:i + k]] = max(inside[lang, w[i:i + k]], a)
    found = {}
    for (lang, w), a in often.items():
        if len(w) > 1 and not inside[lang, w] >= a:
            score, at = min((1000 * a * n[lang] // (often[lang, w[:k]] * often[lang, w[k:]]), k) for k in range(1, len(w)))
            found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), often[lang, w[:at]], often[lang, w[at:]]))
    return sorted((lang, i + 1, p.decode(), -a, left, r, n[lang], -score)
                  for lang, all_ in found.items() for i, (score, a, p, left, r) in enumerate(sorted(all_)[:top]))


def run(frame, **parameters):
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in collocations.collocations(frame, **parameters).collect())


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string").withColumns(
        {c: queries.F.lit(1) for c in ("slice", "words", "tok", "unit", "k", "phrase", "a", "n", "part")})


def made(n, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["Über", "naïve", "\U0001f600", "\x00z"]
    out = []
    for i in range(n):
        w = rng.choices(vocabulary, weights=[1 / (j + 1) for j in range(len(vocabulary))], k=rng.randrange(60))
        if i % 3 == 0:
            w += ["A", "fixed", "Phrase", "of", "six", "words"]
        text = "".join(x + rng.choice([" "] * 12 + ["\t", "  ", ". ", "\n", ",", "! "]) for x in w)
        out.append((rng.choice(["en", "en", "de", None, "und"]), text))
    return out


def test_phrases_equal_counting_by_hand(spark):
    rows = made(400) + [("en", None), ("en", ""), (None, " \t. "), ("xx", "one"), ("fr", "la la la la la la " * 30), ("fr", "x" * 30_000)]
    frame = frame_of(spark, rows).repartition(5)
    for least, longest, top in ((8, 5, 2000), (20, 3, 7)):
        assert run(frame, least=least, longest=longest, top=top) == brute(rows, longest, least, top)


def test_slices_cut_long_texts_between_pieces(spark, monkeypatch):
    rows = made(30, seed=9) + [("de", "".join(t + "." for _, t in made(60, seed=4))), ("de", "no end here " * 400)]
    monkeypatch.setattr(collocations, "SLICE", 600)
    for _, text in rows:
        text = text.encode()
        parts = list(collocations.chunks(text))
        assert b"".join(parts) == text
        assert all(p[-1:] in b".,;:!?\n\v\f\r" for p in parts[:-1])


def test_tiles_count_pairs_as_sorting_does():
    rng = np.random.default_rng(2)
    left, right = rng.zipf(1.3, 400_000) % 5000, rng.zipf(1.3, 400_000) % 7000
    ids, n = collocations.paired(left, right)
    key = left * 7000 + right
    assert n == len(np.unique(key)) == len(np.unique(ids))
    count = np.bincount(ids)
    assert (np.diff(count) <= 0).all()
    assert (np.bincount(np.unique(key, return_inverse=True)[1])[np.unique(key, return_inverse=True)[1]] == count[ids]).all()
    assert collocations.paired(left[:0], right[:0])[1] == 0


def test_no_rows(spark, nothing):
    assert run(frame_of(spark, [])) == []
    assert run(frame_of(spark, [("en", None), (None, "")])) == []


def test_counts_beyond_64_bits(spark):
    frame = spark.createDataFrame([(4 * 10 ** 12, 5 * 10 ** 12, 4 * 10 ** 12, 10 ** 13)], "a long, l long, r long, n long")
    assert 1000 * 4 * 10 ** 12 * 10 ** 13 > 1 << 64
    score = frame.selectExpr("(cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(n as decimal(16,0)))"
                             " div (cast(l as decimal(16,0)) * cast(r as decimal(16,0))) AS s").first().s
    assert score == 1000 * 4 * 10 ** 12 * 10 ** 13 // (5 * 10 ** 12 * 4 * 10 ** 12)


def test_query_on_the_given_table(spark, con, folder):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("lang", "text").collect()]
    got = queries.op13_phrase_collocations(spark, folder).collect()
    assert sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == brute(rows, 5, 100, 2000)
    sql = con.execute(f"SELECT lang, rank, phrase, a, l, r, n, score, k FROM ({queries.ORACLE_SQL['op13_phrase_collocations']})").fetchall()
    assert sorted(map(tuple, got)) == sorted(sql)
