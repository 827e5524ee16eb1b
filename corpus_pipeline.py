"""A corpus pipeline of five operators, each stage written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept; all but
the last return the columns of documents, further columns too, whatever their names. A null text
counts as an empty one; empty texts are alike, so of them one is left by the second stage. Very long
texts are read whole. A document without an id is one like any other; of rows that share id and text
one is kept. An empty table goes through every stage.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armazem.llm import bpe, decontamination, digests, queries, runtime, simhash, toxicity

# The toxicity and SimHash stages cannot be written in SQL; the tests check the whole pipeline
# against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity classifier accepts."""
    return toxicity.accepted(docs, queries.table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z, the document with the largest doc_id; of rows that
    share it, one."""
    index = digests.DigestIndex(spark, runtime.run_folder(spark, "pipeline-index"), buckets=runtime.parts(spark))
    try:
        judged = digests.deduplicated(docs, index)
        kept = judged.where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_digest")).distinct()
    finally:
        index.close()
    text = F.sha2(digests.ascii_lower(F.coalesce(F.col("text"), F.lit(""))).cast("binary"), 256)
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), text.alias("digest"))
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("digest") == F.col("kept_digest"))
    return rows.join(kept, same, "left_semi").dropDuplicates(["id", "digest"]).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the one with the smallest doc_id."""
    found = simhash.near_duplicates(docs, shingle=4, max_bits=4)
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("first_id")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"))
    return rows.join(first, F.col("id").eqNullSafe(F.col("first_id")), "left_semi").select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontamination.clean(docs, queries.table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of them and of the bytes they decode to."""
    return bpe.coded(docs, **queries.bpe_parameters(), payload=True).drop("decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("byte_level_bpe", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn, over the documents of sf_dir."""
    folder = runtime.run_folder(spark, "pipeline")
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = runtime.written(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return docs
