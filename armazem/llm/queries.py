"""The operators as registered queries: (spark, folder of the provided tables) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armazem.llm import bpe, codes, collocations, decontamination, digests, lm, pii, runindex, runtime, simhash, substrings, tokenids, toxicity, urls

# Rules of the URL filter: verdict, then host and path prefix.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
PII_KEY = "pseudonyms of the registered query"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def bpe_parameters() -> dict:
    import public_tokenizers

    return {"ranks": vocabulary("byte_bpe_multi_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}


def op1_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a benchmark item in them: doc_id, item_id, start, edits, n_words."""
    found = decontamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("tkey")


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judged(table(spark, folder, "pages"), URL_RULES)


def op3_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_links")


def op4_token_id_output(spark: SparkSession, folder: str) -> DataFrame:
    return tokenids.token_ids(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"), end_id=0)


def op5_pii_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    return pii.counted(pii.pseudonymised(table(spark, folder, "documents"), PII_KEY))


def op6_byte_level_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.coded(table(spark, folder, "documents"), **bpe_parameters())


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    index = digests.DigestIndex(spark, runtime.run_folder(spark, "digest-index"), buckets=runtime.parts(spark))
    try:
        return digests.deduplicated(table(spark, folder, "documents"), index)
    finally:
        index.close()


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm.scored(table(spark, folder, "documents"))


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.digest(substrings.cleaned(table(spark, folder, "documents"), window=13))


def op11_run_length_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return runindex.digest(runindex.cleaned(table(spark, folder, "documents"), length=50))


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return codes.judged(*codes.quantised(table(spark, folder, "embeddings"), parts=16, entries=64, rounds=2))


def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"), longest=5, least=100, top=2000)


QUERIES = {f.__name__: f for f in (
    op1_benchmark_decontamination, op2_url_filter, op3_simhash_near_dedup, op4_token_id_output, op5_pii_pseudonyms,
    op6_byte_level_bpe, op7_exact_dedup, op8_toxicity, op9_lm_scoring, op10_substring_dedup, op11_run_length_dedup,
    op12_vector_codes, op13_phrase_collocations)}

# One Lloyd assignment and one move of the codebooks, numbered; entries no part chose stay.
_ASSIGNED = """
        d{r} AS (
            SELECT rn, part, entry, sum((x - c) * (x - c))::BIGINT AS d FROM p JOIN c{r} USING (part, pos) GROUP BY ALL),
        a{r} AS (SELECT rn, part, min_by(entry, d * 64 + entry) AS entry, min(d) AS d FROM d{r} GROUP BY ALL)"""
_MOVED = """
        m{r} AS (
            SELECT part, entry, pos, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM p JOIN a{r} USING (rn, part) GROUP BY ALL),
        c{s} AS (
            SELECT part, entry, pos, CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END::BIGINT AS c
            FROM c{r} LEFT JOIN m{r} USING (part, entry, pos))"""
_CODES = f"""
        WITH kept AS (
            SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS rn, list_transform(embedding, lambda x: floor(256 * x)::BIGINT) AS v
            FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
        l AS (SELECT rn, unnest(v) AS x, unnest(range(len(v))) AS j, len(v) // 16 AS w FROM kept),
        p AS (SELECT rn, j // w AS part, j % w AS pos, x FROM l),
        c0 AS (SELECT part, rn - 1 AS entry, pos, x AS c FROM p WHERE rn <= 64),
        {_ASSIGNED.format(r=0)}, {_MOVED.format(r=0, s=1)}, {_ASSIGNED.format(r=1)}, {_MOVED.format(r=1, s=2)}, {_ASSIGNED.format(r=2)},
        book AS (SELECT sha256(string_agg(c, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM c2),
        g AS (SELECT rn, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY rn)
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
        FROM kept JOIN g USING (rn), book
    """

# Two hexadecimal digits a byte; windows as strings of 100 digits.
_RUNS = """
        WITH d AS (SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        p AS (SELECT row, doc_id, unnest(range(length(h) // 2)) AS i, h FROM d),
        g AS (SELECT row, doc_id, i, CASE WHEN 2 * i + 100 <= length(h) THEN substr(h, (2 * i + 1)::INTEGER, 100) END AS gram,
                     substr(h, (2 * i + 1)::INTEGER, 2) AS byte FROM p),
        s AS (SELECT row, i, byte, gram IS NOT NULL AND min(doc_id) OVER (PARTITION BY gram) < doc_id AS again FROM g),
        c AS (SELECT row, i, byte, max(again::INT) OVER (PARTITION BY row ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM s),
        e AS (SELECT *, lag(gone, 1, 0) OVER (PARTITION BY row ORDER BY i) AS before FROM c),
        r AS (SELECT row, sum(gone)::BIGINT AS n_removed, sum((gone = 1 AND before = 0)::INT)::BIGINT AS n_spans,
                     sha256(unhex(coalesce(string_agg(byte, '' ORDER BY i) FILTER (gone = 0), ''))) AS kept_sha256 FROM e GROUP BY row)
        SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               coalesce(kept_sha256, sha256('')) AS kept_sha256
        FROM d LEFT JOIN r USING (row)
    """
_COLLOCATIONS = """
        WITH d AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(
                coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents),
        s AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM d),
        g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: list_slice(ws, i, i + k - 1))) AS w FROM s, range(1, 6) t(k)),
        f AS (SELECT lang, k, w, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
        n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM s GROUP BY lang),
        whole AS (
            SELECT DISTINCT lang, a AS over, list_slice(w, i, i + m - 1) AS w
            FROM (SELECT lang, w, a, k, m, unnest(range(1, k - m + 2)) AS i FROM f, range(2, 5) t(m) WHERE m < k)),
        c AS (SELECT * FROM f WHERE k > 1 AND NOT EXISTS (FROM whole WHERE whole.lang = f.lang AND whole.w = f.w AND 100 * over >= 100 * f.a)),
        cut AS (SELECT c.*, unnest(range(1, k)) AS place FROM c),
        scored AS (
            SELECT cut.lang, cut.w, cut.k, cut.a, place, h.a AS l, t.a AS r, n.n, (1000::HUGEINT * cut.a * n.n) // (h.a::HUGEINT * t.a) AS score
            FROM cut JOIN f h ON h.lang = cut.lang AND h.w = list_slice(cut.w, 1, place)
            JOIN f t ON t.lang = cut.lang AND t.w = list_slice(cut.w, place + 1, cut.k) JOIN n ON n.lang = cut.lang),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, place) = 1),
        r AS (SELECT *, array_to_string(w, ' ') AS phrase FROM best)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score, k
        FROM r QUALIFY rank <= 2000
    """

ORACLE_SQL = {
    "op11_run_length_dedup": _RUNS,
    "op13_phrase_collocations": _COLLOCATIONS,
    "op12_vector_codes": _CODES,
    "op7_exact_dedup": """
        WITH d AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)
    """,
    "op10_substring_dedup": """
        WITH d AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
        s AS (SELECT doc_id, unnest(range(1, greatest(len(ws) - 12, 0) + 1)) AS i, ws FROM d),
        g AS (SELECT doc_id, i, list_slice(ws, i, i + 12) AS gram FROM s),
        r AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY gram) AS least FROM g),
        gone AS (SELECT DISTINCT doc_id, i + k AS pos FROM r, range(13) t(k) WHERE least < doc_id),
        each AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS pos, unnest(ws) AS word FROM d),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS body, count(*) AS n
            FROM each ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id),
        inner_words AS (SELECT doc_id, pos + 1 AS pos FROM gone),
        edges AS (SELECT doc_id, 2 * count(*) AS n_edges FROM gone ANTI JOIN inner_words USING (doc_id, pos) GROUP BY doc_id)
        SELECT d.doc_id, len(ws)::BIGINT AS n_words, len(ws)::BIGINT - coalesce(n, 0) AS n_removed,
               sha256(coalesce(body, '')) AS kept_sha256, coalesce(n_edges, 0)::INTEGER AS n_edges
        FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN edges USING (doc_id)
    """,
}
