"""Pseudonyms against a plain restatement of the networks; valid results; long runs."""

import datetime
import hashlib
import time

import regex
from armazem.llm import pii, queries
from pyspark.sql import functions as F


def digest(*parts):
    return hashlib.sha256("\x1f".join(map(str, parts)).encode()).hexdigest()


def shift(text, key, label, turn, other):
    hexes = "".join(digest(key, label, turn, b, len(text), other) for b in range(len(text) // 16 + 1))
    out = []
    for j, c in enumerate(text):
        k = int(hexes[4 * j:4 * j + 4], 16)
        for first, n in (("0", 10), ("a", 26), ("A", 26)):
            if ord(first) <= ord(c) < ord(first) + n:
                c = chr((ord(c) - ord(first) + k) % n + ord(first))
                break
        out.append(c)
    return "".join(out)


def permute(text, key, label):
    left, right = text[:len(text) // 2], text[len(text) // 2:]
    for turn in range(8):
        if turn % 2 == 0:
            left = shift(left, key, label, turn, right)
        else:
            right = shift(right, key, label, turn, left)
    return left + right


def permute_number(n, radices, key, label):
    a, b = radices
    left, right = divmod(n, b)
    for turn in range(8):
        if turn % 2 == 0:
            left = (left + int(digest(key, label, turn, right)[:12], 16)) % a
        else:
            right = (right + int(digest(key, label, turn, left)[:12], 16)) % b
    return left * b + right


def fill(shape, filling):
    rest = iter(filling)
    return "".join(next(rest) if c.isascii() and c.isalnum() else c for c in shape)


def luhn(digits):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10


def mod97(text):
    return int("".join(str(int(c, 36)) for c in text)) % 97


def check(kind, value):
    """Whether a value of a kind is valid, and what it is made of."""
    digits = regex.sub("[^0-9]", "", value)
    if kind == "card":
        return luhn(digits) == 0
    if kind == "iban":
        plain = value.replace(" ", "")
        return 15 <= len(plain) <= 34 and mod97(plain[4:] + plain[:4]) == 1
    if kind == "ip":
        return all(int(o) <= 255 for o in value.split("."))
    if kind == "date":
        return day_of(value) is not None
    if kind == "ssn":
        area, group, serial = value.split("-")
        return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"
    if kind == "phone":
        return 7 <= len(digits) <= 15
    return True


FORMATS = (("-", "%Y-%m-%d"), (".", "%d.%m.%Y"), ("/", "%m/%d/%Y"))
FIRST = datetime.date(1900, 1, 1)


def day_of(value):
    shape = next(s for mark, s in FORMATS if mark in value)
    try:
        day = (datetime.datetime.strptime(value, shape).date() - FIRST).days
    except ValueError:
        return None
    return day if 0 <= day < 229 * 319 else None


def pseudonym(kind, value, key):
    digits = regex.sub("[^0-9]", "", value)
    if kind == "card":
        body = permute(digits[:-1], key, "card")
        return fill(value, body + str(-luhn(body + "0") % 10))
    if kind == "iban":
        plain = value.replace(" ", "")
        made = permute(plain[4:], key, "iban")
        return fill(value, f"{plain[:2]}{98 - mod97(made + plain[:2] + '00'):02d}{made}")
    if kind == "ip":
        n = permute_number(int.from_bytes(bytes(map(int, value.split(".")))), (65536, 65536), key, "ip")
        return ".".join(map(str, n.to_bytes(4)))
    if kind == "date":
        made = FIRST + datetime.timedelta(permute_number(day_of(value), (229, 319), key, "date"))
        return made.strftime(next(s for mark, s in FORMATS if mark in value))
    if kind == "ssn":
        area, group, serial = map(int, value.split("-"))
        valid = [a for a in range(1, 900) if a != 666]
        n = permute_number((valid.index(area) * 99 + group - 1) * 9999 + serial - 1, (898 * 33, 3 * 9999), key, "ssn")
        return f"{valid[n // 9999 // 99]:03d}-{n // 9999 % 99 + 1:02d}-{n % 9999 + 1:04d}"
    if kind == "phone":
        code = regex.match(r"\+\d{1,3}(?=\D)|\+\d|", value).group()
        tail = value[len(code):]
        return code + fill(tail, permute(regex.sub("[^0-9]", "", tail), key, "phone"))
    name, _, host = value.partition("@")
    return f"{permute(name.lower(), key, 'email')}@{host}"


def compiled(pattern):
    return regex.compile(regex.sub(r"\\k<(\w+)>", r"(?P=\1)", pattern), regex.ASCII)


ANY = compiled(pii.ANY)
WHOLE = {k: compiled(p) for k, p in pii.PATTERNS.items()}


def restated(text, key):
    """(text with pseudonyms, [(kind, value, pseudonym)])."""
    out, at, found = [], 0, []
    for m in ANY.finditer(text):
        value = m.group()
        short = regex.match(r"(\d{4}([ \-])\d{4}\2\d{4}\2\d{4})\2\d{1,3}$", value)
        if short and luhn(regex.sub(r"\D", "", value)) and not luhn(regex.sub(r"\D", "", short.group(1))):
            value = short.group(1)
        kind = next((k for k in pii.KINDS if WHOLE[k].fullmatch(value) and check(k, value)), None)
        made = pseudonym(kind, value, key) if kind else value
        if kind:
            found.append((kind, value, made))
        out += [text[at:m.start()], made]
        at = m.start() + len(value)
    return "".join(out) + text[at:], found


def test_query_equals_the_restatement(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    n = 0
    for r in queries.op5_pii_pseudonyms(spark, folder).collect():
        text, found = restated(texts[r.doc_id], queries.PII_KEY)
        assert r.text == text
        assert {k: r[f"n_{k}"] for k in pii.KINDS} == {k: sum(f[0] == k for f in found) for k in pii.KINDS}
        n += len(found)
    assert n > 20


def test_values_of_every_kind_equal_the_restatement_and_stay_valid(spark):
    rows = [
        "mail Jo.Doe+x@mail.example.org, x_1@a-b.co.", "a@b.cd.e@f.gh and @x.yz", "4111 1111 1111 1111 or 378282246310005",
        "DE89 3702 0044 0532 0130 00 and BE68539007547034", "10.0.0.1 255.255.255.255 1.2.3.4", "1999-12-31 01.02.2003 02/29/2004 1900-01-01 2099-12-30",
        "123-45-6789 899-99-9999 001-01-0001 665-12-3456 667-12-3456", "+49 30 1234 5678 (030) 123 4567 +1 (212) 555 0100",
    ]
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    kinds = set()
    for r in pii.pseudonymised(frame, "key").collect():
        text, found = restated(rows[r.doc_id], "key")
        assert (r.text, [tuple(f) for f in r.found]) == (text, found)
        assert all(check(k, made) and WHOLE[k].fullmatch(made) for k, _, made in found)
        kinds |= {k for k, _, _ in found}
    assert kinds == set(pii.KINDS)


def test_social_security_numbers_stay_valid_over_all_areas_and_groups(spark):
    values = spark.range(899 * 99).selectExpr(
        "concat_ws('-', lpad(cast(id div 99 + 1 as string), 3, '0'), lpad(cast(id % 99 + 1 as string), 2, '0'),"
        " lpad(cast(id * 7919 % 9999 + 1 as string), 4, '0')) AS m").where("m not like '666%'")
    valid, made = pii.ssn(F.col("m"), "key")
    rows = values.select("m", valid.alias("ok"), made.alias("made")).collect()
    assert len(rows) == 898 * 99 and all(r.ok for r in rows)
    assert all(check("ssn", r.made) for r in rows)
    assert len({r.made for r in rows}) == len(rows)
    assert all(r.made == pseudonym("ssn", r.m, "key") for r in rows[::997])


def test_long_runs_take_time_by_their_length(spark):
    """A million characters without a blank, of every kind a pattern could start on; and ten thousand
    candidates in one run, each of which is checked."""
    runs = ["a" * 10 ** 6, "A1" * 500_000, "x." * 500_000, "a@" * 500_000, "x@" + "a." * 500_000, "1-" * 100_000]
    for run in runs:
        frame = spark.createDataFrame([(1, run)], "doc_id long, text string")
        began = time.time()
        row = pii.pseudonymised(frame, "key").collect()[0]
        assert time.time() - began < 60, run[:10]
        assert row.text == run or row.found
    assert pii.pseudonymised(spark.createDataFrame([(1, "b" * 300 + "@mail.org")], "doc_id long, text string"), "k").first().found == []
