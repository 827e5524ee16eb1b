"""Operators with a model or a search in them, and the pipeline."""

import random
import re
import tracemalloc
from collections import Counter

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from armazem.llm import decontamination, lm, pii, queries, runtime, toxicity, urls, words
from pyspark.sql import functions as F
from test_exact import LOWER, WORD, brute_bpe, brute_components, shingle_print


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def crc(doc_id, n):
    import zlib

    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


def hash_words(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text.translate(LOWER))


# --- benchmark decontamination ---


def brute_leaks(docs, items):
    """Least edit distance of each item to any stretch of each document, if it is allowed."""
    out = {}
    for d, text in docs:
        near = hash_words(text)
        for i, passage in items:
            item = hash_words(passage)
            if not item or not near:
                continue
            row = [0] * (len(near) + 1)
            for n, a in enumerate(item, 1):
                new = [n]
                for j, b in enumerate(near):
                    new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
                row = new
            if min(row) <= decontamination.max_edits(len(item)):
                out[d, i] = min(row)
    return out


def test_decontamination_query(spark, folder):
    found = {(r.doc_id, r.item_id): r.edits for r in queries.QUERIES["op1_benchmark_decontamination"](spark, folder).collect()}
    docs = [(r.doc_id, r.text) for r in table(spark, folder, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, folder, "benchmark").collect()]
    # Brute force where a document shares a run of three words with an item: no other can match.
    grams = {tuple(w[k:k + 3]) for w in (hash_words(t) for _, t in items) for k in range(len(w) - 2)}
    close = [(d, t) for d, t in docs if any(tuple(w[k:k + 3]) in grams for w in [hash_words(t)] for k in range(len(w) - 2))]
    assert close and len(found) > 0
    close = close[:25]
    wanted = brute_leaks(close, items)
    assert {k: v for k, v in found.items() if k[0] in {d for d, _ in close}} == wanted


def test_decontamination_finds_edited_passages(spark):
    """Passages with as many edits as are allowed, among clean text: recall and no false alarm."""
    chance = random.Random(8)
    vocabulary = [f"v{i}" for i in range(400)]
    draw = lambda n: [chance.choice(vocabulary) for _ in range(n)]
    items = [(i, draw(chance.choice([5, 9, 15, 24, 40, 62, 63, 160]))) for i in range(40)] + [(90, ["lone"]), (91, draw(3)), (92, [])]
    docs, planted = [], set()
    for k in range(160):
        i, passage = items[k % 40]
        seq = list(passage)
        for _ in range(decontamination.max_edits(len(seq)) * (k % 4) // 3):
            at = chance.randrange(len(seq))
            kind = chance.randrange(3)
            if kind == 0:
                seq[at] = "changed"
            elif kind == 1:
                seq.insert(at, "added")
            else:
                del seq[at]
        docs.append((k, " ".join([*draw(60), *seq, *draw(60)]).upper().replace("V3 ", "V3, ")))
        planted.add((k, i))
    docs += [(1000 + k, " ".join(draw(300))) for k in range(40)] + [(2000, "a Lone, word"), (2001, None), (2002, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in items] + [(93, None)], "item_id long, text string")
    rows = decontamination.leaks(frame, benchmark).collect()
    found = {(r.doc_id, r.item_id): r.edits for r in rows}
    wanted = brute_leaks([(d, t or "") for d, t in docs], [(i, " ".join(w)) for i, w in items])
    assert planted <= set(wanted)
    assert set(found) <= set(wanted) and all(found[k] >= wanted[k] for k in found)
    assert len(found) >= 0.95 * len(wanted)
    assert (2000, 90) in found and not any(d >= 1000 for d, _ in found if d < 2000)


def decontamination_recall(spark, items, docs):
    """Share of the planted (document, item) that is found; docs: (doc_id, item_id, words)."""
    frame = spark.createDataFrame([(d, " ".join(seq)) for d, _, seq in docs], "doc_id long, text string")
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.leaks(frame, benchmark).collect()}
    return np.mean([(d, i) in found for d, i, _ in docs])


def test_decontamination_at_both_ends_and_as_whole_documents(spark):
    """Leaks that lost words where the document ends, starts or is nothing else."""
    chance = random.Random(9)
    draw = lambda n: [f"v{chance.randrange(5000)}" for _ in range(n)]
    items = [draw(n) for n in (15, 18, 22, 27, 33, 41, 51, 60) for _ in range(5)]
    for place in ("whole", "one word less", "start", "end"):
        docs = []
        for i, item in enumerate(items):
            for _ in range(3):
                seq = list(item)
                for _ in range(1 if place == "one word less" else decontamination.max_edits(len(item))):
                    del seq[chance.randrange(len(seq))]
                docs.append((len(docs), i, [*draw(60 * (place == "end")), *seq, *draw(60 * (place == "start"))]))
        assert decontamination_recall(spark, items, docs) >= 0.95, place


def test_decontamination_of_long_items_with_edits_in_one_part(spark):
    """Long items with all the edits allowed in their first, middle or last words."""
    for n in range(1, 700):
        edges = decontamination.pieces(n)
        sizes = np.diff(edges)
        assert edges[0] == 0 and edges[-1] == n and sizes.max() - sizes.min() <= 1 and sizes.max() <= decontamination.above(decontamination.LONGEST)
        # The edits that some piece is bound to stay within are those its window is searched with.
        assert decontamination.max_edits(n) // len(sizes) <= min(decontamination.max_edits(int(m)) for m in sizes)
    chance = random.Random(10)
    draw = lambda n: [f"v{chance.randrange(5000)}" for _ in range(n)]
    items = [draw(n) for n in (63, 80, 101, 102, 130, 160) for _ in range(4)]
    docs = []
    for i, item in enumerate(items):
        edits = decontamination.max_edits(len(item))
        for begin in (0, (len(item) - 51) // 2, len(item) - 51):
            for kinds in ((0,), (0, 1, 2)):
                seq = list(item)
                for at in sorted(chance.sample(range(begin, begin + 51), min(edits, 51)), reverse=True):
                    kind = chance.choice(kinds)
                    seq[at:at + 1] = [["changed"], ["added", seq[at]], []][kind]
                docs.append((len(docs), i, [*draw(40), *seq, *draw(40)]))
    assert decontamination_recall(spark, items, docs) >= 0.95


def test_decontamination_odd_rows(spark, odd, nothing):
    benchmark = spark.createDataFrame([(1, "no id here at all"), (2, None), (None, "zero byte")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.leaks(odd, benchmark).collect()}
    assert found == {(None, 1)}
    kept = decontamination.clean(odd, benchmark)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 1
    assert decontamination.leaks(nothing, benchmark).count() == 0
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.leaks(odd, empty).count() == 0
    assert decontamination.clean(odd, empty).count() == odd.count()


# --- URLs ---


def brute_rule(url):
    url = url or ""
    at = url.find("://")
    rest = url[at + 3:] if at >= 0 else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = host.translate(LOWER)
    best = (None, None)
    for verdict, rule in sorted(queries.URL_RULES, key=lambda r: len(r[1])):
        domain, _, tail = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + tail):
            best = (rule, verdict)
    return host, path, *best


ODD_URLS = [
    None, "", "no scheme", "://", "http://", "https://COM/", "http://com", "http://a.com?x/", "http://xexample.com/en/", "http://EXAMPLE.com/en/a://b",
    "http://www.example.com/en/?q#f", "http://a.www.example.com/en/", "ftp://net/es/", "http://x.net/fr#/", "http://x.net/en/", "http://exámple.org/ñ", "http://h.org/" + "a" * 5000,
]


def test_rules_and_odd_urls(spark):
    rows = [(i, u, 1.0) for i, u in enumerate(ODD_URLS)] + [(3, ODD_URLS[3], 2.0), (None, "http://com/", 0.0)]
    frame = spark.createDataFrame(rows, "page_id long, url string, score double")
    found = urls.judged(frame, queries.URL_RULES).collect()
    assert len(found) == len(rows) and all(r.verdict in ("allow", "block") for r in found)
    by_id = {r.page_id: r for r in found}
    for i, u, _ in rows:
        host, path, rule, verdict = brute_rule(u)
        assert (by_id[i].host, by_id[i].path, by_id[i].rule) == (host, path, rule), u
        assert verdict is None or by_id[i].verdict == verdict
    assert urls.judged(frame.limit(0), queries.URL_RULES).count() == 0
    assert urls.judged(frame, []).where("rule is not null").count() == 0


def brute_scores(train, held, order):
    """Witten-Bell models of accepted and rejected texts, character by character."""
    counts = {True: Counter(), False: Counter()}
    for text, accepted in train:
        for i in range(1, len(text)):
            for k in range(min(order, i) + 1):
                counts[accepted][text[i - k:i], text[i]] += 1
    total, kinds = {}, {}
    for side, c in counts.items():
        total[side], kinds[side] = Counter(), Counter()
        for (context, _), n in c.items():
            total[side][context] += n
            kinds[side][context] += 1
    out = {}
    for text in held:
        score = 0
        for i in range(1, len(text)):
            p = {}
            for side in (True, False):
                p[side] = 1 / urls.ALPHABET
                for k in range(min(order, i) + 1):
                    context = text[i - k:i]
                    if total[side][context]:
                        p[side] = (counts[side][context, text[i]] + kinds[side][context] * p[side]) / (total[side][context] + kinds[side][context])
            score += np.log(p[True]) - np.log(p[False])
        out[text] = score / (len(text) - 1)
    return out


def test_markov_scores(spark, folder):
    pages = [r.url for r in table(spark, folder, "pages").collect()]
    train = [(f"\x02{u}\x03", i % 3 == 0) for i, u in enumerate(pages[:30])]
    held = [f"\x02{u}\x03" for u in pages[20:40]] + ["\x02new\x03"]
    pair = urls.MarkovPair(spark.createDataFrame(train, "text string, accepted boolean"), 3)
    found = {r.text: r.score for r in pair.scores(spark.createDataFrame([(h,) for h in held], "text string")).collect()}
    wanted = brute_scores(train, held, 3)
    assert set(found) == set(wanted)
    assert all(abs(found[t] - wanted[t]) < 1e-9 for t in wanted)


def test_url_query_separates_what_rules_would(spark):
    """Hosts no rule names, spelled like accepted or rejected ones, get the matching verdict."""
    chance = random.Random(2)
    good = [f"http://{chance.choice('abc')}shop{i}.com/fr/item{i}" for i in range(300)]
    bad = [f"http://casino{i}.x.net/es/win{i}" for i in range(300)]
    new = [(1, "http://ashop7.org/fr/item9"), (0, "http://casino9.x.org/es/win8")]
    rows = [(i, u) for i, u in enumerate(good + bad)] + [(1000 + k, u) for k, u in new]
    found = {r.page_id: r.verdict for r in urls.judged(spark.createDataFrame(rows, "page_id long, url string"), queries.URL_RULES).collect()}
    assert found[1001] == "allow" and found[1000] == "block"


def test_url_query(spark, folder):
    rows = queries.QUERIES["op2_url_filter"](spark, folder).collect()
    urls_of = {r.page_id: r.url for r in table(spark, folder, "pages").collect()}
    assert len(rows) == len(urls_of)
    for r in rows:
        host, path, rule, verdict = brute_rule(urls_of[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and (verdict is None or r.verdict == verdict)


@pytest.fixture
def no_broadcast(spark):
    """A broadcast of more than 1 KB is an error."""
    spark.conf.set("spark.sql.maxBroadcastTableSize", "1k")
    yield
    spark.conf.unset("spark.sql.maxBroadcastTableSize")


def test_url_tables_stay_off_the_driver(spark, no_broadcast):
    """Two hundred URLs have about 36,000 grams; planned by the size of their file, the driver would get them all."""
    chance = random.Random(4)
    tail = lambda: "".join(chance.choices("abcdefghij0123456789", k=170))
    texts = [f"\x02{chance.choice(['shop.com', 'x.net/es', 'new.org'])}/{tail()}\x03" for _ in range(200)] + ["\x02" + "a" * 500 + "\x03", "\x02\x03"]
    train = [(t, i % 3 == 0) for i, t in enumerate(texts[:90])]
    frame = spark.createDataFrame([(t,) for t in texts[60:] + texts[190:]], "text string").repartition(3)
    found = urls.MarkovPair(spark.createDataFrame(train, "text string, accepted boolean"), 4).scores(frame).collect()
    wanted = brute_scores(train, texts[60:-1], 4)
    assert len(found) == len(wanted) and all(abs(r.score - wanted[r.text]) < 1e-9 for r in found)
    rows = spark.createDataFrame([(i, f"http://{t[1:-1]}") for i, t in enumerate(texts)], "page_id long, url string")
    assert sorted(r.page_id for r in urls.judged(rows, queries.URL_RULES).collect()) == list(range(len(texts)))


# --- personal data ---


def luhn_ok(number):
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def iban_ok(number):
    plain = number.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


VALUES = {
    "card": ["4111 1111 1111 1111", "5500-0000-0000-0004", "378282246310005"],
    "iban": ["DE89 3704 0044 0532 0130 00", "GB29NWBK60161331926819"],
    "ip": ["192.168.1.77", "8.8.8.8"],
    "date": ["1987-02-28", "01.03.2020", "12/31/1999"],
    "ssn": ["123-45-6789"],
    "phone": ["+1 (988) 555-2485", "+49 171 2345678", "(456) 555-2186"],
    "email": ["loogm.24@mail6.example.com", "A.b-c@x.org"],
}
NOT_VALID = ["4111 1111 1111 1112", "DE88 3704 0044 0532 0130 00", "999.1.1.1", "1987-02-30", "000-45-6789", "2.5", "12345"]


def test_pseudonyms(spark):
    rows = [(i, f"See {v}, or {v}.", kind) for i, (kind, v) in enumerate((k, v) for k, vs in VALUES.items() for v in vs)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, matches string")
    found = {r.doc_id: r for r in pii.pseudonymised(frame, "key").collect()}
    again = {r.doc_id: r.text for r in pii.pseudonymised(frame, "another key").collect()}
    for i, text, kind in rows:
        value, r = text[4:text.index(", or")], found[i]
        assert [(f.kind, f.value) for f in r.found] == [(kind, value)] * 2, (value, r.found)
        new = r.found[0].pseudonym
        assert r.text == f"See {new}, or {new}." and new != value
        assert again[i] != r.text
        if kind not in ("ip", "email"):
            assert re.sub(r"\d", "9", re.sub("[A-Z]", "A", new))[4 * (kind == "iban"):] == re.sub(r"\d", "9", re.sub("[A-Z]", "A", value))[4 * (kind == "iban"):]
        check = {"card": luhn_ok, "iban": iban_ok, "ip": lambda v: all(int(o) < 256 for o in v.split(".")),
                 "email": lambda v: v.split("@")[1] == value.split("@")[1]}.get(kind, bool)
        assert check(new)


SWOLLEN = [
    ("card", "4111 1111 1111 1111", " 05/27"), ("card", "4111 1111 1111 1111", " 123"), ("card", "4111-1111-1111-1111", "-123, ok"),
    ("card", "4111 1111 1111 1111", " 05 27"), ("card", "378282246310005", " 05/27"), ("card", "3782 822463 10005", " 1234"),
    ("card", "4111111111111111", " 12"), ("iban", "BE68 5390 0754 7034", " BIC"), ("iban", "BE68539007547034", " GEBABEBB"),
    ("iban", "AT61 1904 3002 3457 3201", " BANK 12"), ("iban", "NO93 8601 1117 947", " X"),
]


def test_values_end_before_what_follows(spark):
    """Digits after a card and capitals after an IBAN are not part of it."""
    rows = [(i, f"See {v}{after}") for i, (_, v, after) in enumerate(SWOLLEN)]
    rows += [(100, "4111 1111 1111 1111 12/31/1999"), (101, "4111 1111 1111 1111 192.168.1.77"), (102, "4111 1111 1111 1111 123-45-6789"),
             (103, "BE68 5390 0754 7034 BE68 5390 0754 7034"), (104, "4111 1111 1111 1111 4111 1111 1111 1111"), (105, "6304 0000 0000 0000 125")]
    found = {r.doc_id: r for r in pii.pseudonymised(spark.createDataFrame(rows, "doc_id long, text string"), "key").collect()}
    for i, (kind, value, after) in enumerate(SWOLLEN):
        assert [(f.kind, f.value) for f in found[i].found] == [(kind, value)], (value, after, found[i])
        assert found[i].text == f"See {found[i].found[0].pseudonym}{after}" and found[i].found[0].pseudonym != value
    assert [[f.kind for f in found[k].found] for k in range(100, 105)] == [["card", "date"], ["card", "ip"], ["card", "ssn"], ["iban", "iban"], ["card", "card"]]
    whole = rows[-1][1]
    assert luhn_ok(whole) and [f.value for f in found[105].found] == [whole]


def test_values_that_fail_their_check_stay(spark):
    frame = spark.createDataFrame([(i, f"a {v} b") for i, v in enumerate(NOT_VALID)], "doc_id long, text string")
    for r in pii.pseudonymised(frame, "key").collect():
        assert r.text == f"a {NOT_VALID[r.doc_id]} b" and r.found == []


def test_pseudonyms_are_permutations(spark):
    """Every value of a format meets exactly one pseudonym of that format."""
    pairs = spark.range(1000).select(F.format_string("%03d", "id").alias("v")).select("v", pii.permuted(F.col("v"), "k", "x").alias("w")).collect()
    assert sorted(r.w for r in pairs) == sorted(r.v for r in pairs)
    days = spark.range(pii.DAY_RADICES[0] * pii.DAY_RADICES[1]).select(pii.permuted_number(F.col("id"), pii.DAY_RADICES, "k", "d").alias("w"))
    assert days.distinct().count() == pii.DAY_RADICES[0] * pii.DAY_RADICES[1]
    assert days.agg(F.min("w"), F.max("w")).first() == (0, pii.DAY_RADICES[0] * pii.DAY_RADICES[1] - 1)
    letters = spark.createDataFrame([(a + b,) for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"], "v string")
    assert letters.select(pii.permuted(F.col("v"), "k", "y").alias("w")).distinct().count() == 676


def test_pii_odd_rows_and_query(spark, odd, nothing, folder):
    rows = pii.pseudonymised(odd, "key").collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in odd.collect())
    assert pii.pseudonymised(nothing, "key").count() == 0
    result = queries.QUERIES["op5_pii_pseudonyms"](spark, folder)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert result.count() == table(spark, folder, "documents").count() and result.agg(F.sum("n_found")).first()[0] > 0


# --- toxicity ---


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in table(spark, folder, "labels").collect()}
    rows = queries.QUERIES["op8_toxicity"](spark, folder).collect()
    assert len(rows) == table(spark, folder, "documents").count()
    assert all(r.held_out == (crc(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    hits = sum(a and b for a, b in held)
    assert hits >= 0.95 * sum(b for _, b in held) and hits >= 0.8 * sum(a for a, _ in held)


def test_toxicity_never_reads_held_out_labels(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held = toxicity.held_out(F.col("doc_id"), 5)
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = sorted(tuple(r) for r in toxicity.scored(docs, labels).collect())
    assert a == sorted(tuple(r) for r in toxicity.scored(docs, turned).collect())


def test_toxicity_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (4, 1), (5, 0), (6, 1), (7, 0), (None, 1), (9, None)], "doc_id long, toxic int")
    rows = toxicity.scored(odd, labels).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in odd.collect())
    none = labels.limit(0)
    assert {r.predicted for r in toxicity.scored(odd, none).collect()} == {0}
    assert toxicity.scored(nothing, labels).count() == 0
    assert toxicity.accepted(odd, none).collect() == odd.collect()


def test_label_model_with_copied_voters():
    """Six copies of one weak voter must not outvote the labels and five good voters."""
    chance = np.random.default_rng(1)
    truth = chance.random(4000) < 0.2
    good = [chance.random(4000) < np.where(truth, 0.6, 0.001) for _ in range(5)]
    weak = chance.random(4000) < np.where(truth, 0.3, 0.2)
    labels = np.where(truth & (chance.random(4000) < 0.05), False, truth)
    votes = np.stack([*good, *[weak] * 6], axis=1).astype(np.uint8)
    post = toxicity.label_model(votes, labels.astype(float))
    assert ((post > 0.5) == truth).mean() > (labels == truth).mean()


# --- language model ---


def test_lm_base_scores_and_gain(spark, folder):
    rows = {r.doc_id: r for r in queries.QUERIES["op9_lm_scoring"](spark, folder).collect()}
    docs = [(r.doc_id, WORD.findall((r.text or "").translate(LOWER)) + [None]) for r in table(spark, folder, "documents").collect()]
    counts = Counter(w for d, ws in docs if crc(d, 10) for w in ws)
    n, v = sum(counts.values()), len(counts)
    for d, ws in docs:
        r = rows[d]
        base = sum(np.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (crc(d, 10) == 0, len(ws), sum(counts[w] > 0 for w in ws), n)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base)) and r.score < 0
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_probabilities_sum_to_one(spark, folder):
    """Over all known words, the end and one unknown word a class, from any state."""
    docs = runtime.texts(table(spark, folder, "documents"))
    stats = runtime.written(lm.statistics(docs), runtime.run_folder(spark, "test"))
    known = lm.vocabulary(stats)
    flat = lm.parameters(np.full(lm.CLASSES, 1 / lm.CLASSES))
    for classes in ([3], [lm.END, 20, 21]):
        p = [lm.class_scores(flat, np.array([*classes, k]), np.array([0, len(classes) + 1]))[0] for k in range(lm.CLASSES)]
        prior = lm.class_scores(flat, np.array(classes), np.array([0, len(classes)]))[0]
        assert abs(sum(10 ** (x - prior) for x in p) - 1) < 1e-3
    rows = stats.where("kind = 0 and cell >= 0").collect()
    alone = set(known.alone.view(np.int64).tolist())
    inside = Counter()
    for r in rows:
        if r.key not in alone:
            inside[known.classes[r.cell]] += r.n + 0.1
    for k in range(lm.ALONE + 1, lm.CLASSES):
        assert abs((inside[k] + 0.1) / 10 ** known.log_class[k] - 1) < 1e-9


def test_gradient_matches_differences():
    chance = np.random.default_rng(0)
    flat = lm.parameters(np.full(lm.CLASSES, 1 / lm.CLASSES)).astype(np.float64)
    seen, goal = chance.integers(0, lm.CLASSES, (5, 3)), chance.integers(0, lm.CLASSES, (5, 3))
    mask, h = np.ones((5, 3)), chance.normal(0, 0.3, (3, lm.HIDDEN))

    def loss(p):
        wx, u, wo, bo = lm.unpacked(p)
        state, total = h, 0
        for t in range(5):
            state = lm.step(wx[seen[t]], state, u)[0]
            logits = state @ wo + bo
            total -= (logits[np.arange(3), goal[t]] - np.log(np.exp(logits).sum(1))).sum() / mask.sum()
        return total

    lm_float = np.float32
    g, _ = lm.learn(flat, seen, goal, mask, h)
    for i in [*np.flatnonzero(np.abs(g) > 1e-3)[::97], len(flat) - 1]:
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-5
        down[i] -= 1e-5
        assert abs((loss(up) - loss(down)) / 2e-5 - g[i]) < 1e-4, (i, lm_float)


def test_training_reads_every_word_of_every_text(monkeypatch):
    chance = np.random.default_rng(1)
    texts = [np.append(chance.integers(lm.ALONE + 1, lm.CLASSES, n), lm.END) for n in (0, 1, 31, 32, 33, 64, 700, 5000, *[40] * 600)]
    read, states = Counter(), []
    learn = lm.learn

    def watched(flat, seen, goal, mask, h, goes_on):
        assert ((seen == lm.END) == (goes_on == 0))[mask > 0].all()  # a text begins without a state, and only there
        read.update(goal[mask > 0].tolist())
        states.append(np.abs(h).sum(1) > 0)
        return learn(flat, seen, goal, mask, h, goes_on)

    monkeypatch.setattr(lm, "learn", watched)
    trainer = lm.Trainer(lm.parameters(np.full(lm.CLASSES, 1 / lm.CLASSES)), 0.01)
    for some in (texts[:300], texts[300:]):
        trainer.take(some)
    trainer.finish()
    assert read == Counter(np.concatenate(texts).tolist())
    assert all(s.all() for s in states[1:])  # the state goes on from window to window


def test_gradient_of_texts_in_one_lane():
    """Two texts one after the other give the gradients of both."""
    chance = np.random.default_rng(2)
    flat = lm.parameters(np.full(lm.CLASSES, 1 / lm.CLASSES))
    goals = [np.append(chance.integers(lm.ALONE + 1, lm.CLASSES, n), lm.END)[:, None] for n in (6, 9)]
    seens = [np.concatenate([[[lm.END]], g[:-1]]) for g in goals]
    none = np.zeros((1, lm.HIDDEN), np.float32)
    apart = sum(len(g) * lm.learn(flat, s, g, np.ones(g.shape, np.float32), none)[0] for s, g in zip(seens, goals))
    seen, goal = np.concatenate(seens), np.concatenate(goals)
    both = lm.learn(flat, seen, goal, np.ones(goal.shape, np.float32), none, (seen != lm.END).astype(np.float32))[0]
    assert np.allclose(both * len(goal), apart, atol=1e-4)


def test_windows_use_their_arrays_again():
    """A window needs hardly any new memory, and what it returns outlives the next one, of another shape, too."""
    chance = np.random.default_rng(6)
    flat = lm.parameters(np.full(lm.CLASSES, 1 / lm.CLASSES))

    def window(n):
        seen, goal = chance.integers(0, lm.CLASSES, (2, lm.WINDOW, n))
        h = chance.normal(0, 0.3, (n, lm.HIDDEN)).astype(np.float32)
        return seen, goal, np.ones(seen.shape, np.float32), h, (seen != lm.END).astype(np.float32)

    some, few, one = window(lm.LANES), window(7), window(1)
    first = {id(w): [x.copy() for x in lm.learn(flat, *w)] for w in (some, few, one)}
    held = {id(w): lm.learn(flat, *w) for w in (one, some, few)}
    for w in (some, few, one):
        assert all((a == b).all() for a, b in zip(first[id(w)], held[id(w)]))
    tracemalloc.start()
    lm.learn(flat, *some)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3e6, peak


def test_scores_of_large_weights():
    """Logits beyond what an exponential holds give finite scores."""
    flat = lm.parameters(np.full(lm.CLASSES, 1 / lm.CLASSES)) * 1000
    found = lm.class_scores(flat, np.array([3, 20, lm.END]), np.array([0, 3]))
    assert np.isfinite(found).all() and found[0] < 0


def test_each_different_word_is_looked_up_once():
    rows = pa.RecordBatch.from_pydict({"text": ["Ab ab  aB\tc", "", "c abcd"]})
    t = lm.tokens(rows)
    assert len(t.keys) == len(set(t.keys.tolist())) == 3 and t.which.tolist() == [0, 0, 0, 1, 1, 2] and t.first.tolist() == [0, 4, 4, 6]
    numbers, starts = t.with_ends()
    assert numbers.tolist() == [0, 0, 0, 1, 3, 3, 1, 2, 3] and starts.tolist() == [0, 5, 6, 9]


def test_class_scores_carry_the_state():
    """Texts scored together equal texts scored alone, over many windows."""
    chance = np.random.default_rng(4)
    flat = lm.parameters(np.full(lm.CLASSES, 1 / lm.CLASSES))
    sizes = [1, 200, 33, 64, 65, 1, 150]
    classes = chance.integers(0, lm.CLASSES, sum(sizes))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    together = lm.class_scores(flat, classes, starts)
    for k, (a, b) in enumerate(zip(starts[:-1], starts[1:])):
        wx, u, wo, bo = lm.unpacked(flat)
        h, last, total = np.zeros((1, lm.HIDDEN), np.float32), lm.END, 0.0
        for c in classes[a:b]:
            h = lm.step(wx[[last]], h, u)[0]
            logits = (h @ wo + bo)[0].astype(float)
            total += logits[c] - np.log(np.exp(logits).sum())
            last = c
        assert abs(total / np.log(10) - together[k]) < 1e-3


def test_lm_odd_rows(spark, odd, nothing):
    rows = lm.scored(odd).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in odd.collect())
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert lm.scored(nothing).count() == 0
    alone = lm.scored(odd.where("doc_id is null or doc_id = 5"), folds=1).collect()
    assert {r.train_tokens for r in alone} == {0} and {r.n_known for r in alone} == {0}


# --- words ---


def test_words_and_hashes():
    texts = ["", "  ", "Ab ab AB", "x\x0by\x1cz é\u00a0ü", "same same", "same"]
    offsets, data = runtime.byte_offsets(pa.array(texts))
    w = words.words(offsets, data)
    raw = data.tobytes()
    split = [WORD.findall(t) for t in texts]
    assert [raw[a:b].decode() for a, b in zip(w.start, w.end)] == [x for s in split for x in s]
    assert w.counts.tolist() == [len(s) for s in split]
    exact, lower = w.hashes()[0], w.hashes(lower=True)[0]
    flat = [x for s in split for x in s]
    for h, key in ((exact, flat), (lower, [x.translate(LOWER) for x in flat])):
        assert len(set(h.tolist())) == len(set(key)) and len(set(zip(h.tolist(), key))) == len(set(key))


def test_slices_keep_every_row():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (0, 3, 50, 1, 1, 0)], "k": list(range(6))})
    found = list(runtime.slices([batch.slice(1), batch.slice(0, 1)], "text", 4))
    assert [x for b in found for x in b.column("k").to_pylist()] == [1, 2, 3, 4, 5, 0]
    assert all(sum(map(len, b.column("text").to_pylist())) <= 4 or b.num_rows == 1 for b in found)


# --- pipeline ---


@pytest.fixture(scope="module")
def folder():
    """Large enough for the classifier to reject documents."""
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, folder):
    """Documents before the first stage and after each."""
    docs = table(spark, folder, "documents")
    out, home = [docs], runtime.run_folder(spark, "pipeline-test")
    for name, stage in corpus_pipeline.STAGES:
        docs = runtime.written(stage(spark, docs, folder), f"{home}/{name}")
        out.append(docs)
    return out


def ids(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


def test_pipeline_stages(spark, folder, stages):
    start, toxic, exact, near, clean, coded = stages
    assert start.count() > toxic.count() > exact.count() > near.count() > clean.count() > 0
    assert all(s.columns == start.columns for s in stages[1:5])
    scores = {r.doc_id: r.predicted for r in queries.QUERIES["op8_toxicity"](spark, folder).collect()}
    assert ids(toxic) == sorted(d for d, p in scores.items() if not p)
    rows = [(r.doc_id, r.text) for r in toxic.collect()]
    keep = {}
    for d, t in rows:
        key = t.translate(LOWER)
        keep[key] = max(d, keep.get(key, d))
    assert ids(exact) == sorted(keep.values())
    prints = [(r.doc_id, shingle_print(r.text)) for r in exact.collect()]
    group = brute_components([p for _, p in prints])
    least = {}
    for d, p in prints:
        least[group[p]] = min(d, least.get(group[p], d))
    assert ids(near) == sorted(least.values())
    leaks = brute_leaks([(r.doc_id, r.text) for r in near.collect() if len(r.text) < 4000][:40], [(r.item_id, r.text) for r in table(spark, folder, "benchmark").collect()])
    assert not {d for d, _ in leaks} & set(ids(clean)) and set(ids(clean)) <= set(ids(near))
    found = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in coded.collect())
    assert found == brute_bpe([(r.doc_id, r.text) for r in clean.collect()])
    assert ids(corpus_pipeline.run(spark, folder)) == ids(clean)


def test_pipeline_stages_on_odd_rows(spark, folder, odd):
    docs = spark.createDataFrame(odd.select("doc_id", "text").rdd.map(tuple), "doc_id long, text string").withColumns(
        {"lang": F.lit(None).cast("string"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    for empty in (False, True):
        now = docs.limit(0) if empty else docs
        for _, stage in corpus_pipeline.STAGES:
            now = runtime.written(stage(spark, now, folder), runtime.run_folder(spark, "odd"))
        assert (now.count() == 0) == empty
