"""Operators whose results are fixed by their contracts, against brute force."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from armazem.llm import bpe, components, digests, queries, runtime, simhash, substrings, tokenids

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts_of(frame):
    return [(r.doc_id, r.text or "") for r in frame.select("doc_id", "text").collect()]


def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


# --- words ---


def shingle_print(text):
    w = WORD.findall(text.translate(LOWER))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 4]) for i in range(max(len(w) - 3, 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(prints):
    """Component of each fingerprint by all pairs."""
    fps = sorted(set(prints))
    x, root = np.array(fps, np.uint64), list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(x[i + 1:] ^ x[i]) <= 4).tolist():
            a, b = find(i), find(i + 1 + j)
            root[max(a, b)] = min(a, b)
    return {f: find(i) for i, f in enumerate(fps)}


def check_simhash(frame, found):
    docs = texts_of(frame)
    prints = [(d, shingle_print(t)) for d, t in docs]
    group = brute_components([p for _, p in prints])
    least = {}
    for d, p in prints:
        if d is not None:
            least[group[p]] = min(d, least.get(group[p], d))
    expected = Counter((d, f"{p:016x}", least.get(group[p])) for d, p in prints)
    assert found == expected


def simhash_rows(result):
    from pyspark.sql import functions as F

    hexed = result.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id")
    return Counter(tuple(r) for r in hexed.collect())


def test_simhash_query(spark, folder):
    result = queries.QUERIES["op3_simhash_near_dedup"](spark, folder)
    found = Counter((r.doc_id, r.fingerprint, r.component_id) for r in result.collect())
    check_simhash(documents(spark, folder), found)
    assert max(Counter(k[2] for k in found).values()) > 1


def test_simhash_odd_rows(odd, nothing):
    check_simhash(odd, simhash_rows(simhash.near_duplicates(odd)))
    assert simhash.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("most", [7, 20_000])
def test_links_keep_every_component(spark, most):
    """Chains, one large cloud around a centre and lone rows; small groups force split groups."""
    chance = np.random.default_rng(3)
    lone = chance.integers(0, 1 << 63, 150, np.uint64)
    cloud = np.uint64(0x0123456789ABCDEF) ^ np.bitwise_or.reduce(np.uint64(1) << chance.integers(0, 64, (200, 3), np.uint64), axis=1)
    chain = np.bitwise_xor.accumulate(np.uint64(7) << (np.arange(20, dtype=np.uint64) * np.uint64(3)))
    fps = np.unique(np.concatenate([lone, cloud, chain]))
    frame = spark.createDataFrame([(int(f), int(f)) for f in fps.view(np.int64)], "node long, fp long")
    links = simhash.similar(frame, 4, most)
    pairs = [(a & (1 << 64) - 1, b & (1 << 64) - 1) for a, b in map(tuple, links.collect())]
    assert all((a ^ b).bit_count() <= 4 for a, b in pairs)
    expected = brute_components([int(f) for f in fps])
    label = {int(f): int(f) for f in fps}
    rows = components.components(links).collect()
    for r in rows:
        label[r.node & (1 << 64) - 1] = r.component & (1 << 64) - 1
    groups = defaultdict(set)
    wanted = defaultdict(set)
    for f in label:
        groups[label[f]].add(f)
        wanted[expected[f]].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, 1001 + i) for i in range(300)] + [(5, 5), (None, 3), (1, 0)]
    found = dict(tuple(r) for r in components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(1000, 1301), 1000)}


# --- exact copies ---


def test_digests_odd_rows(spark, odd, nothing):
    index = digests.DigestIndex(spark, runtime.run_folder(spark, "index"), 4)
    found = [tuple(r) for r in digests.deduplicated(odd, index).collect()]
    groups = defaultdict(list)
    for d, t in texts_of(odd):
        groups[hashlib.sha256(t.translate(LOWER).encode()).hexdigest()].append(d)
    expected = []
    for digest, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        expected += [(i, keep, len(ids), i == keep, digest) for i in ids]
    assert Counter(found) == Counter(expected)
    assert digests.deduplicated(nothing, index).count() == 0
    index.close()


def test_index_stays_and_takes_in_new_data(spark):
    path = runtime.run_folder(spark, "index")
    first = spark.createDataFrame([(1, "a"), (2, "A"), (3, "b")], "doc_id long, text string")
    then = spark.createDataFrame([(9, "B"), (7, "c"), (8, "c"), (6, "É"), (5, "é")], "doc_id long, text string")
    index = digests.DigestIndex(spark, path, 4)
    assert {r.doc_id for r in digests.deduplicated(first, index).where("kept").collect()} == {2, 3}
    index.close()
    index = digests.DigestIndex(spark, path, 4)  # as a later run opens it
    rows = {r.doc_id: r for r in digests.deduplicated(then, index).collect()}
    assert {d for d, r in rows.items() if r.kept} == {8, 6, 5}
    assert rows[9].keep_id == 3 and rows[9].group_size == 1
    assert index.rows().count() == 5
    plan = spark.table(index.table).hint("merge").join(spark.table(index.table).hint("merge"), "text_sha256")
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    index.close()


def test_index_opened_with_other_settings_stays_right(spark):
    """Three batches with 4, 8 and 3 buckets asked for, then compacted, against brute force."""
    path, seen, doc = runtime.run_folder(spark, "index"), {}, 0
    for batch, asked in enumerate((4, 8, 3, 5)):
        texts = [f"text {i}" for i in range(batch * 60, batch * 60 + 130)] + ["same"] * 40
        rows = [(doc + i, t) for i, t in enumerate(texts)]
        doc += len(rows)
        index = digests.DigestIndex(spark, path, asked)
        assert index.buckets == (4 if batch < 3 else 6)
        found = {r.doc_id: r for r in digests.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), index).collect()}
        own = defaultdict(list)
        for d, t in rows:
            own[t].append(d)
        new = {t: (max(ids), len(ids)) for t, ids in own.items() if t not in seen}
        seen |= new
        assert len(found) == len(rows)
        for d, t in rows:
            keep, size = seen[t]
            assert (found[d].keep_id, found[d].group_size, found[d].kept) == (keep, size, t in new and d == keep)
        stored = Counter(r.text_sha256 for r in index.rows().collect())
        assert stored == Counter({hashlib.sha256(t.encode()).hexdigest(): 1 for t in seen})
        if batch == 2:
            index.compact(6)
            assert Counter(r.text_sha256 for r in index.rows().collect()) == stored
        index.close()


def test_a_batch_shuffles_its_own_digests_only(spark):
    index = digests.DigestIndex(spark, runtime.run_folder(spark, "index"), 3)
    rows = spark.range(400).selectExpr("id AS doc_id", "cast(id % 300 AS string) AS text")
    digests.deduplicated(rows, index)
    plan = index.met(digests.digested(rows))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and "LeftAnti" in plan
    for side in plan.split("SortMergeJoin")[1:]:  # the index is the second child: from scan to join without an exchange
        scan = side.index("Bucketed: true")
        assert "Exchange" not in side[side.rindex("+- Sort", 0, scan):scan]
    index.close()


def test_an_index_of_another_version_is_refused(spark):
    path = runtime.run_folder(spark, "index")
    spark.createDataFrame([(99, 0, 4)], digests.DigestIndex.SPEC).write.parquet(f"{path}/spec/0")
    with pytest.raises(ValueError, match="version 99"):
        digests.DigestIndex(spark, path)


# --- long repeats ---


def brute_removed(docs, window=13):
    words = [(d, WORD.findall(t)) for d, t in docs]
    least = {}
    rank = lambda d: (0, 0) if d is None else (1, d)
    for d, w in words:
        for i in range(len(w) - window + 1):
            g = tuple(w[i:i + window])
            least[g] = min(least.get(g, rank(d)), rank(d))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i:i + window])] < rank(d):
                gone.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return Counter(out)


def removed(frame):
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.digest(frame).collect())


def test_substrings_query(spark, folder):
    result = queries.QUERIES["op10_substring_dedup"](spark, folder)
    found = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in result.collect())
    assert found == brute_removed(texts_of(documents(spark, folder)))
    assert sum(k[2] for k in found) > 0


@pytest.mark.parametrize("most", [20, 200, 2_000_000])
def test_substrings_with_hot_nodes(spark, odd, most):
    """Small groups: long prefixes, and nodes met too often for any group."""
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(100 + i, f"own{i} text {passage} end{i}") for i in range(40)] + [(99, passage), (98, passage[3:])]
    few = odd.where("doc_id is null or doc_id not in (4, 9)") if most < 1000 else odd
    frame = few.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    assert removed(substrings.cleaned(frame, 13, most)) == brute_removed(texts_of(frame))


def test_substrings_spans_and_empty_table(spark, nothing):
    a = " ".join(f"a{i}" for i in range(20))
    frame = spark.createDataFrame([(1, a), (2, f"x {a} y {a} z")], "doc_id long, text string")
    rows = {r.doc_id: r for r in substrings.cleaned(frame).collect()}
    assert rows[2].spans == [1, 21, 22, 42] and rows[2].text == "x y z" and rows[1].spans == []
    assert substrings.cleaned(nothing).count() == 0


# --- token files ---


def test_wavelet_matrix():
    values = np.random.default_rng(1).zipf(1.3, 5000) % 600
    matrix = tokenids.WaveletMatrix.build(values.astype(np.uint16), 10)
    assert (matrix.values() == values).all()
    at = np.array([0, 4999, 64, 63, 100])
    assert (matrix.access(at) == values[at]).all()
    for v in (0, 1, 2, 599, 600, 5000, -1):
        assert matrix.count(v) == (values == v).sum()
        assert (matrix.occurrences(v) == np.flatnonzero(values == v)).all()
    empty = tokenids.WaveletMatrix.build(np.zeros(0, np.uint16), 4)
    assert empty.count(1) == 0 and len(empty.values()) == 0 and len(empty.occurrences(0)) == 0


def test_file_round_trip():
    ids = np.array([5, 1, 0, 5, 5], np.uint16)
    data = tokenids.to_file([None, 3], np.array([3, 2]), ids, 3)
    doc_ids, lengths, matrix = tokenids.from_file(data)
    assert doc_ids == [None, 3] and lengths.tolist() == [3, 2] and matrix.values().tolist() == ids.tolist()
    with pytest.raises(ValueError):
        tokenids.from_file(b"x" * 64)


def plain_tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def brute_tokens(docs):
    t, at, out = plain_tokenizer(), 0, []
    coded = [(d, t.encode(x, add_special_tokens=False).ids + [0]) for d, x in docs]
    for d, ids in sorted(coded, key=lambda x: (x[0] is not None, x[0] or 0, np.array(x[1], "<u2").tobytes())):
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_query(spark, folder):
    result = queries.QUERIES["op4_token_id_output"](spark, folder)
    found = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in result.collect())
    assert found == brute_tokens(texts_of(documents(spark, folder)))


def test_tokens_odd_rows(spark, odd, nothing):
    path = public_tokenizers.path("byte_bpe_50k.json")
    frame = odd.unionByName(spark.createDataFrame([(20, "<|endoftext|> a  b  c \x85 d")], "doc_id long, text string"), allowMissingColumns=True)
    written = tokenids.write(frame, path, runtime.run_folder(spark, "t"), docs_per_shard=3, segment_tokens=50)
    assert written.count() > 5
    found = [tuple(r) for r in tokenids.read(written).collect()]
    assert Counter(found) == Counter(brute_tokens(texts_of(frame)))
    assert tokenids.token_ids(nothing, path).count() == 0


def test_new_units_share_calls_of_the_library():
    """Units met first are encoded many by one call, and each keeps its ids when it is met again."""
    import random

    calls = Counter()

    class Watched:
        def __init__(self, inner):
            self.inner = inner

        def __getattr__(self, name):
            calls[name] += 1
            return getattr(self.inner, name)

    chance, whole = random.Random(5), plain_tokenizer()
    encoder = tokenids.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    encoder.tokenizer, encoder.model = Watched(encoder.tokenizer), None
    spelt = ["a", "b ", "  ", "\n", "'re", "'", "1", "22", "!?", "é", "ǆ", "中", "ɐ", "😀", "\u00a0", "\u3000", "\x1c", " \u2009 ", "<|endoftext|>", "Zz"]
    odd = ["", " ", "\u00a0", *("".join(chance.choice(spelt) for _ in range(chance.randrange(1, 60))) for _ in range(400)), "x" * 700 + " " + "y" * 300]
    long = [" ".join(f"w{k}x{chance.randrange(10**6)}" for k in range(3000 * i, 3000 * i + 3000)) for i in range(3)]
    for some in (long, long, odd, odd[::-1]):
        before = sum(calls.values())
        ends = np.cumsum([0, *(len(x.encode()) for x in some)])
        found = encoder.encode(ends, np.frombuffer("".join(some).encode(), np.uint8))
        assert [np.frombuffer(x, encoder.kind).tolist() for x in found] == [whole.encode(x, add_special_tokens=False).ids for x in some]
        if some is long:  # 9,000 units: five calls and one for the texts' first words, then none but an empty one
            assert sum(calls.values()) - before <= (8 if not before else 1)


def ids_of(encoder, some):
    ends = np.cumsum([0, *(len(x.encode()) for x in some)])
    found = encoder.encode(ends, np.frombuffer("".join(some).encode(), np.uint8))
    return [np.frombuffer(x, encoder.kind).tolist() for x in found]


def test_plain_units_go_to_the_model_without_the_librarys_cutting():
    import random

    chance, whole = random.Random(6), plain_tokenizer()
    points = [*range(0x21, 0x27), *range(0x28, 0x7F), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x240), *range(0x400, 0x480)]
    some = [" ".join("".join(map(chr, chance.choices(points, k=chance.randrange(1, 9)))) for _ in range(200)) for _ in range(30)]
    some += ["a" + chr(p) + "1" + chr(p) + " " + chr(p) for p in points]
    encoder = tokenids.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    encoder.tokenizer = None  # any call of it fails
    assert ids_of(encoder, some) == [whole.encode(x, add_special_tokens=False).ids for x in some]


def test_units_beside_every_character():
    """Characters of other classes, and apostrophes, keep the library's own cutting."""
    whole, encoder = plain_tokenizer(), tokenids.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    points = [*range(0x600), *range(0x2000, 0x2070), *range(0x3000, 0x3010), 0xFFFD, 0x1F600]
    some = [x for c in map(chr, points) for x in (f"a{c}s {c}1 ", f"{c}", f" b'll{c} {c}{c}'s", f"1{c}x  {c}")]
    assert ids_of(encoder, some) == [whole.encode(x, add_special_tokens=False).ids for x in some]


def test_remembered_units_take_few_bytes(monkeypatch):
    slices_of = [[" ".join(f"{chr(97 + i)}{k * 7919:06d}" for k in range(30_000))] for i in range(8)]
    encoder = tokenids.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    first = [ids_of(encoder, some) for some in slices_of]
    units = encoder.units
    assert len(units) == 8 * 30_000
    held = units.ids.nbytes + sum(column.nbytes for run in units.runs for column in run)
    assert held < 40 * len(units)
    monkeypatch.setattr(encoder, "fresh", None)  # all are known now
    assert [ids_of(encoder, some) for some in slices_of] == first
    monkeypatch.undo()
    monkeypatch.setattr(tokenids, "_KEPT", 50_000)  # forgets again and again
    assert [ids_of(encoder, some) for some in slices_of] == first
    assert len(encoder.units) <= 80_000


# --- byte-level BPE ---


def brute_bpe(docs):
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for d, t in docs:
        ids = coder.encode_ordinary(t)
        out.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    return Counter(out)


def test_bpe_query(spark, folder):
    found = Counter(tuple(r) for r in queries.QUERIES["op6_byte_level_bpe"](spark, folder).collect())
    assert found == brute_bpe(texts_of(documents(spark, folder)))


@pytest.mark.parametrize(("chunk", "overlap"), [(16_384, 256), (500, 64), (40, 8)])
def test_bpe_chunks(odd, chunk, overlap):
    """Chunks so small that words, runs of blanks and marks reach over several of them."""
    frame = odd.where("doc_id is null or doc_id != 4") if chunk < 100 else odd
    found = Counter(tuple(r) for r in bpe.coded(frame, **queries.bpe_parameters(), chunk=chunk, overlap=overlap).collect())
    assert found == brute_bpe(texts_of(frame))


def test_stitching_everywhere():
    import random

    chance, codec = random.Random(4), bpe.Codec.open(**{"path": queries.bpe_parameters()["ranks"], "pattern": public_tokenizers.PATTERN})
    for _ in range(300):
        text = "".join(chance.choice(["a", "b ", "  ", "\n", "'re", "'", "1", "22", "!?", "é", " 　", "Zz"]) for _ in range(chance.randrange(1, 80)))
        chunk, overlap = chance.choice([(8, 8), (16, 8), (20, 12)])
        stitcher, out = bpe.Stitcher(codec, chunk), []
        for s in range(0, max(len(text) - overlap, 1), chunk):
            part = text[s:s + chunk + overlap]
            out += stitcher.add(part, bpe.borders(codec.split(part)), s + chunk + overlap >= len(text))
        assert out == codec.split(text), repr(text)


def test_merging_long_pieces():
    ranks = bpe.read_ranks(queries.bpe_parameters()["ranks"])
    for raw in (b"a" * 300, b"abcab" * 60, bytes(range(256)), "éè".encode() * 70):
        part = [raw[i:i + 1] for i in range(len(raw))]
        while True:
            best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(part, part[1:])) if a + b in ranks), default=None)
            if best is None:
                break
            part[best[1]:best[1] + 2] = [part[best[1]] + part[best[1] + 1]]
        assert bpe.merge_long(raw, ranks) == [ranks[p] for p in part]


def test_bpe_payload_and_empty_table(spark, nothing):
    frame = spark.createDataFrame([(1, "café au lait"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in bpe.coded(frame, **queries.bpe_parameters(), payload=True).collect()}
    assert bytes(rows[1].decoded).decode() == "café au lait" and len(rows[1].ids) == 4 * rows[1].n_tokens
    assert rows[2].n_tokens == 0 and bytes(rows[2].ids) == b""
    assert bpe.coded(nothing, **queries.bpe_parameters()).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_sql(spark, con, folder, name):
    result = queries.QUERIES[name](spark, folder)
    columns = sorted(result.columns)
    cursor = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    expected = Counter(tuple(dict(zip(names, r))[c] for c in columns) for r in cursor.fetchall())
    assert Counter(tuple(r[c] for c in columns) for r in result.collect()) == expected
