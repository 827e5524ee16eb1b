"""Exact deduplication against a persistent digest index.

The index is a table of one row per distinct normalised text: SHA-256, the kept doc_id and the
number of rows seen. It is bucketed and sorted by digest, so that new data meets it in a
sort-merge anti-join that shuffles only the new data's digests, and what is new is appended.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from armazem.llm.runtime import run_folder, written

# The letters that normalisation lower-cases.
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; plain lower() where a text has no other letters."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, CAPITALS, SMALL))


def digested(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_sha256); a null text counts as empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.sha2(ascii_lower(text).cast("binary"), 256).alias("text_sha256"))


class DigestIndex:
    """Digests of all data taken in so far, in a folder that stays.

    The folder holds generations of the index, each bucketed and sorted by digest, and one row for
    each generation that says into how many buckets. Whoever opens the index later reads it as it
    was written, whatever the settings of that session.
    """

    SCHEMA = "text_sha256 string, keep_id bigint, group_size bigint"
    SPEC, VERSION = "version int, generation int, buckets int", 1

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        """Open the index in `path`, or begin one there with so many buckets."""
        self.spark, self.path = spark, path.rstrip("/")
        known = self._spec()
        if known is None:
            self._begin(0, buckets)
            known = self._spec()
        if known.version != self.VERSION:
            raise ValueError(f"{path}: a digest index of version {known.version}, not {self.VERSION}")
        self._open(known.generation, known.buckets)

    def _spec(self):
        try:
            found = self.spark.read.schema(self.SPEC).option("recursiveFileLookup", True).parquet(f"{self.path}/spec")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return found.orderBy(F.desc("generation")).first()

    def _begin(self, generation: int, buckets: int, rows: DataFrame | None = None) -> None:
        """Write a generation; it counts once its row of the spec is there."""
        self._open(generation, buckets)
        # Made from a range: rows handed over from here would start Python on the executors.
        one = self.spark.range(0, 1, 1, 1)
        none = one.where("false").selectExpr(*(f"cast(null as {kind}) as {name}" for name, kind in map(str.split, self.SCHEMA.split(","))))
        self._append(none if rows is None else rows)
        spec = one.select(*(F.lit(v).cast("int").alias(name) for v, name in zip(
            (self.VERSION, generation, buckets), ("version", "generation", "buckets"))))
        spec.write.mode("error").parquet(f"{self.path}/spec/{generation}")

    def _open(self, generation: int, buckets: int) -> None:
        self.generation, self.buckets = generation, buckets
        self.files = f"{self.path}/generation-{generation}"
        self.table = f"digest_index_{uuid.uuid5(uuid.NAMESPACE_URL, self.files).hex}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({self.SCHEMA}) USING parquet"
            f" CLUSTERED BY (text_sha256) SORTED BY (text_sha256) INTO {buckets} BUCKETS LOCATION '{self.files}'")

    def _append(self, rows: DataFrame) -> None:
        dealt = rows.repartition(self.buckets, "text_sha256")
        dealt.write.format("parquet").bucketBy(self.buckets, "text_sha256").sortBy("text_sha256").mode("append").saveAsTable(self.table)

    def rows(self) -> DataFrame:
        """The index, by its buckets."""
        return self.spark.table(self.table)

    def met(self, digests: DataFrame) -> DataFrame:
        """Each different digest of (doc_id, text_sha256) beside the index, not written yet:
        text_sha256, keep_id, group_size and whether it is new.

        Of new equal texts the largest doc_id is kept. A digest of the index keeps its row: what came
        earlier stays, whatever the ids. Digests are counted before the shuffle, so a text with a
        third of all rows is one row a task; they are dealt as the index is, which itself is read by
        its buckets and not shuffled.
        """
        groups = digests.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        groups = groups.repartition(self.buckets, "text_sha256")  # one exchange for both joins
        index = self.rows().hint("merge")
        new = groups.join(index.select("text_sha256"), "text_sha256", "left_anti").withColumn("new", F.lit(True))
        old = groups.select("text_sha256").join(index, "text_sha256").withColumn("new", F.lit(False))
        return new.select("text_sha256", "keep_id", "group_size", "new").unionByName(old)

    def take_in(self, digests: DataFrame) -> DataFrame:
        """Append the digests not in the index yet; returns what met() tells of all of them."""
        # Written first: a table can't be appended to from a plan that reads it.
        found = written(self.met(digests), run_folder(self.spark, "digests-met"))
        self._append(found.where("new").drop("new"))
        return found

    def compact(self, buckets: int | None = None) -> None:
        """Write the index anew, one sorted file a bucket, into so many buckets as asked or as
        before. The generation before stays readable; its files are left to whoever owns the folder."""
        before = self.table
        self._begin(self.generation + 1, buckets or self.buckets, self.rows())
        self.spark.sql(f"DROP TABLE IF EXISTS {before}")

    def close(self) -> None:
        """Forget the table in this session's catalog; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def deduplicated(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Take a batch into the index; one row per input row: doc_id, keep_id, group_size, kept,
    text_sha256.

    Equal: identical after lower-casing A-Z. kept holds for the row with the largest doc_id of
    its text, if the text was not in the index before; where rows share that doc_id all of them
    hold it. A missing id is kept only where no row of its text has one. Null texts equal empty
    ones; very long texts are texts like any other. keep_id and group_size are those of the index:
    the first batch that had the text. An empty table gives no rows and leaves the index as it was.
    Other columns are not read, so their names don't matter.
    """
    rows = written(digested(docs, id_col, text_col), run_folder(docs.sparkSession, "digests"))
    found = index.take_in(rows)
    return rows.join(found, "text_sha256").select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & F.col("new")).alias("kept"),
        "text_sha256")
