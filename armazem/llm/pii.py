"""Personal data replaced by format-preserving pseudonyms.

Card numbers, account numbers (IBAN), social security numbers, phone numbers, IPv4 addresses,
dates and the names in e-mail addresses are found by pattern, validated (Luhn, mod 97, ranges,
calendar) and permuted by a keyed Feistel network inside their own format: digits stay digits,
letters keep their case, separators stay, check digits are made anew, a date becomes another
date. A permutation maps equal values to equal pseudonyms in every document and different ones
to different ones. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
# Days of 1900-01-01 to 2099-12-31, as a product of two radices: a Feistel network over them
# stays inside the calendar without any further walking.
FIRST_DAY, DAY_RADICES = "1900-01-01", (229, 319)
# Social security numbers: areas 001 to 899 but 666, groups 01 to 99, serials 0001 to 9999. All of
# them are the numbers below the product of two radices, as days are.
SSN_GROUPS, SSN_SERIALS, SSN_RADICES = 99, 9999, (898 * 33, 3 * 9999)

# Characters of an IBAN by country; those of other countries may have any length.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV",
    22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _own_length(n: int) -> str:
    groups, rest = divmod(n - 4, 4)
    return rf"(?:{'|'.join(IBAN_LENGTHS[n].split())})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}" + rf" ?[A-Z0-9]{{{rest}}}" * (rest > 0)


# Patterns in order of precedence; the first that fits at a place takes it. An IBAN ends at its
# country's length, a card at its own grouping: an unbroken run, 4-6-5 (or 4) and 4-4-4-4, after
# which up to three digits may belong to the card (see kept()) if nothing else begins with them. The
# name of an e-mail address begins where its run of characters does, or where the match before
# ended: a run is read once, however long, and names of more than 256 characters are none.
_NAME = r"[A-Za-z0-9._%+\-]"
PATTERNS = {
    "email": rf"(?:(?<!{_NAME})|\G){_NAME}{{1,256}}+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+){{0,126}}\.[A-Za-z]{{2,}}",
    "iban": r"(?<![A-Za-z0-9])(?:(?:" + "|".join(map(_own_length, IBAN_LENGTHS)) + r")(?![A-Za-z0-9])"
            r"|[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))",
    "ip": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)",
    "date": r"(?<![\d.\-/])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\d\-/])",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "phone": r"(?:\+\d{1,3}[ .\-]?)?\(\d{2,4}\)[ .\-]?\d{3,4}[ .\-]?\d{4}(?!\d)|\+\d{1,3}(?:[ .\-]?\d{2,4}){2,4}(?!\d)",
    "card": r"(?<!\d)(?:\d{13,19}|\d{4}(?<six>[ \-])\d{6}\k<six>\d{4,5}"
            r"|\d{4}(?<four>[ \-])\d{4}\k<four>\d{4}\k<four>\d{4}(?:\k<four>\d{1,3}(?![\w@]|[./\-%+]\w))?"
            r"|\d(?:[ \-]?\d){12,18})(?!\d)",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
KINDS = tuple(PATTERNS)


def chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def number(hex_digits: Column) -> Column:
    return F.conv(hex_digits, 16, 10).cast("long")


def shifted(s: Column, stream: Column) -> Column:
    """Each letter and digit moved on within its kind by four hex digits of the stream."""
    def one(c: Column, j: Column) -> Column:
        k, code = number(F.substr(stream, j * 4 + 1, F.lit(4))), F.ascii(c)

        def turn(first: int, n: int) -> Column:
            return F.char((code - first + k) % n + first)

        return F.when(c.between("0", "9"), turn(48, 10)).when(c.between("a", "z"), turn(97, 26)).when(
            c.between("A", "Z"), turn(65, 26)).otherwise(c)

    return F.array_join(F.transform(chars(s), one), "")


def stream(key: str, label: str, turn: Column, other: Column, size: Column) -> Column:
    """At least four hex digits for each of `size` characters."""
    blocks = F.sequence(F.lit(0), F.floor(size / 16).cast("int"))
    return F.array_join(F.transform(blocks, lambda b: F.sha2(F.concat_ws(
        "\x1f", F.lit(key), F.lit(label), turn.cast("string"), b.cast("string"), size.cast("string"), other).cast("binary"), 256)), "")


def permuted(s: Column, key: str, label: str) -> Column:
    """Feistel network over a text's letters and digits: the halves shift each other in turn."""
    half = F.floor(F.length(s) / 2).cast("int")
    start = F.struct(F.substr(s, F.lit(1), half).alias("l"), F.substr(s, half + 1, F.length(s)).alias("r"))

    def step(h: Column, i: Column) -> Column:
        left = F.struct(shifted(h["l"], stream(key, label, i, h["r"], F.length(h["l"]))).alias("l"), h["r"].alias("r"))
        right = F.struct(h["l"].alias("l"), shifted(h["r"], stream(key, label, i, h["l"], F.length(h["r"]))).alias("r"))
        return F.when(i % 2 == 0, left).otherwise(right)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda h: F.concat(h["l"], h["r"]))


def permuted_number(n: Column, radices: tuple[int, int], key: str, label: str) -> Column:
    """Feistel network over 0 .. a*b - 1 as pairs of a digit of radix a and one of radix b."""
    a, b = radices
    start = F.struct(F.floor(n / b).cast("long").alias("l"), (n % b).cast("long").alias("r"))

    def keyed(i: Column, other: Column) -> Column:
        return number(F.substr(F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit(label), i.cast("string"), other.cast("string")).cast("binary"), 256), F.lit(1), F.lit(12)))

    def step(h: Column, i: Column) -> Column:
        left = F.struct(((h["l"] + keyed(i, h["r"])) % a).alias("l"), h["r"].alias("r"))
        right = F.struct(h["l"].alias("l"), ((h["r"] + keyed(i, h["l"])) % b).alias("r"))
        return F.when(i % 2 == 0, left).otherwise(right)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda h: h["l"] * b + h["r"])


def only(s: Column, kind: str) -> Column:
    return F.regexp_replace(s, kind, "")


def reshaped(shape: Column, filling: Column) -> Column:
    """The letters and digits of `shape` replaced, in order, by the characters of `filling`."""
    start = F.struct(F.lit("").alias("done"), F.lit(1).alias("at"))

    def step(a: Column, c: Column) -> Column:
        return F.when(c.rlike("[A-Za-z0-9]"), F.struct(
            F.concat(a["done"], F.substr(filling, a["at"], F.lit(1))).alias("done"), (a["at"] + 1).alias("at"))).otherwise(
            F.struct(F.concat(a["done"], c).alias("done"), a["at"].alias("at")))

    return F.aggregate(chars(shape), start, step, lambda a: a["done"])


def luhn(digits: Column) -> Column:
    """Sum of a number's digits, every second one from the right (but the last) doubled."""
    def worth(c: Column, j: Column) -> Column:
        d = c.cast("int")
        twice = d * 2
        return F.when(j % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.transform(chars(F.reverse(digits)), worth), F.lit(0), lambda a, x: a + x)


def mod97(s: Column) -> Column:
    """The number that letters (A: 10 to Z: 35) and digits spell, modulo 97."""
    def step(a: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(chars(s), F.lit(0), step)


def card(m: Column, key: str) -> tuple[Column, Column]:
    digits = only(m, r"\D")
    n = F.length(digits)
    body = permuted(F.substr(digits, F.lit(1), n - 1), key, "card")
    check = (F.lit(10) - luhn(F.concat(body, F.lit("0"))) % 10) % 10
    return luhn(digits) % 10 == 0, reshaped(m, F.concat(body, check.cast("string")))


def kept(m: Column) -> Column:
    """The value in a match: its first four groups of four digits if only they are a valid card."""
    short = F.regexp_extract(m, r"^(\d{4}([ \-])\d{4}\2\d{4}\2\d{4})\2\d{1,3}$", 1)
    swollen = (short != "") & (luhn(only(m, r"\D")) % 10 != 0) & (luhn(only(short, r"\D")) % 10 == 0)
    return F.when(swollen, short).otherwise(m)


def iban(m: Column, key: str) -> tuple[Column, Column]:
    plain = only(m, " ")
    country, body = F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(5), F.length(plain))
    made = permuted(body, key, "iban")
    check = F.lit(98) - mod97(F.concat(made, country, F.lit("00")))
    return (mod97(F.concat(body, F.substr(plain, F.lit(1), F.lit(4)))) == 1) & F.length(plain).between(15, 34), reshaped(
        m, F.concat(country, F.lpad(check.cast("string"), 2, "0"), made))


def ip(m: Column, key: str) -> tuple[Column, Column]:
    octets = F.transform(F.split(m, r"\."), lambda o: o.cast("long"))
    n = F.aggregate(octets, F.lit(0).cast("long"), lambda a, o: a * 256 + o)
    made = permuted_number(n, (65536, 65536), key, "ip")
    out = F.concat_ws(".", *(F.floor(made / 256 ** k).cast("long") % 256 for k in (3, 2, 1, 0)))
    return F.forall(octets, lambda o: o <= 255), out


def date(m: Column, key: str) -> tuple[Column, Column]:
    formats = (("-", "yyyy-MM-dd"), (".", "dd.MM.yyyy"), ("/", "MM/dd/yyyy"))
    day, out = F.lit(None).cast("date"), m
    for mark, shape in formats:
        day = F.when(F.contains(m, F.lit(mark)), F.try_to_date(m, shape)).otherwise(day)
    number_of_day = F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("long")
    made = F.date_add(F.lit(FIRST_DAY).cast("date"), permuted_number(number_of_day, DAY_RADICES, key, "date").cast("int"))
    for mark, shape in formats:
        out = F.when(F.contains(m, F.lit(mark)), F.date_format(made, shape)).otherwise(out)
    return number_of_day.between(0, DAY_RADICES[0] * DAY_RADICES[1] - 1), out


def ssn(m: Column, key: str) -> tuple[Column, Column]:
    area, group, serial = (F.split_part(m, F.lit("-"), F.lit(i)).try_cast("long") for i in (1, 2, 3))
    rank = ((area - F.when(area > 666, 2).otherwise(1)) * SSN_GROUPS + group - 1) * SSN_SERIALS + serial - 1
    made = permuted_number(rank, SSN_RADICES, key, "ssn")
    upper = F.floor(made / SSN_SERIALS).cast("long")
    place = F.floor(upper / SSN_GROUPS).cast("long")
    parts = (place + F.when(place >= 665, 2).otherwise(1), 3), (upper % SSN_GROUPS + 1, 2), (made % SSN_SERIALS + 1, 4)
    return ~m.rlike("^(000|666|9)|-00-|-0000$"), F.concat_ws("-", *(F.lpad(n.cast("string"), width, "0") for n, width in parts))


def phone(m: Column, key: str) -> tuple[Column, Column]:
    code = F.regexp_extract(m, r"^\+\d{1,3}(?=\D)|^\+\d", 0)
    tail = F.substr(m, F.length(code) + 1, F.length(m))
    return F.length(only(m, r"\D")).between(7, 15), F.concat(code, reshaped(tail, permuted(only(tail, r"\D"), key, "phone")))


def email(m: Column, key: str) -> tuple[Column, Column]:
    name = F.substring_index(m, "@", 1)
    return F.length(name) > 0, F.concat(permuted(F.lower(name), key, "email"), F.lit("@"), F.substring_index(m, "@", -1))


MAKERS = {"email": email, "iban": iban, "ip": ip, "date": date, "ssn": ssn, "phone": phone, "card": card}


def pseudonym(m: Column, key: str) -> Column:
    """struct(kind, value, pseudonym) of a match; kind null and the value itself if it is not valid."""
    kind, made = F.lit(None).cast("string"), m
    for name in reversed(KINDS):
        valid, new = MAKERS[name](m, key)
        whole = m.rlike(f"^(?:{PATTERNS[name]})$")
        made = F.when(whole & valid, new).otherwise(made)
        kind = F.when(whole & valid, name).otherwise(kind)
    return F.struct(kind.alias("kind"), m.alias("value"), made.alias("pseudonym"))


def pseudonymised(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text with pseudonyms, found (array of kind, value and
    pseudonym, in order).

    Values that look like a kind but fail its check stay as they are and are not listed. A pseudonym
    passes the check of its kind. A null text stays null, with nothing found; empty texts, repeated
    rows and missing ids pass through, and an empty table gives no rows. Very long texts are read
    once from end to end, in time that grows with their length. Other columns are not read, so their
    names don't matter.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("matches", F.coalesce(F.regexp_extract_all("text", F.lit(ANY), F.lit(0)), F.array().cast("array<string>")))
    rows = rows.withColumn("values", F.transform("matches", kept))
    rows = rows.withColumn("made", F.transform("values", lambda m: pseudonym(m, key)))
    between = F.split("text", ANY, -1)
    # Arrays are paired, not indexed: an array behind an index would be made anew for every match.
    tails = F.zip_with("matches", "values", lambda m, v: F.substr(m, F.length(v) + 1))
    new = F.zip_with("made", tails, lambda p, t: F.concat(p["pseudonym"], t))
    glued = F.array_join(F.zip_with(between, new, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return rows.select("doc_id", F.when(F.size("made") > 0, glued).otherwise(F.col("text")).alias("text"),
                       F.filter("made", lambda x: x["kind"].isNotNull()).alias("found"))


def counted(rows: DataFrame) -> DataFrame:
    """doc_id, text and how many values of each kind were replaced."""
    def of(kind: str) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).alias(f"n_{kind}")

    return rows.select("doc_id", "text", F.size("found").alias("n_found"), *map(of, KINDS))
