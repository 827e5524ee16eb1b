"""Tables of a load that share a bucketing, so that joins and sums by their key shuffle nothing.

All tables of a set are dealt by one key into the same number of buckets and sorted by it. A bucket
is read by one task, which a key that holds a large part of the rows would make too long; Spark can
only split it where it shuffles. So the set is settled once it is written: if a bucket of any table
is far larger than the others, the whole set is read by its files from then on, as tables without
buckets are. The outcome stays beside the tables, for whoever opens them later.
"""

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from armazem.sources.literals import literal_rows
from armazem.sources.sinks import COMPRESSION

SPEC = "baldes"
#: A bucket counts as too large beyond this many times the mean, and this many rows.
UNEVEN, LARGE = 2.5, 1_000_000
_SCHEMA = "chave string, baldes int"


class Buckets:
    """A set of tables in a folder. `number` 0: they are read by their files."""

    def __init__(self, spark: SparkSession, folder: str, key: str, number: int):
        self.spark, self.folder, self.key, self.number = spark, folder, key, number

    @classmethod
    def begin(cls, spark: SparkSession, folder: str, key: str) -> "Buckets":
        """A new set, with as many buckets as the session has shuffle partitions."""
        return cls(spark, folder, key, int(spark.conf.get("spark.sql.shuffle.partitions")))

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> "Buckets | None":
        """The settled set of a folder, if there is one."""
        try:
            found = spark.read.schema(_SCHEMA).parquet(f"{folder}/{SPEC}").first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return cls(spark, folder, found.chave, found.baldes)

    def _name(self, path: str) -> str:
        return f"armazem_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"

    def _create(self, path: str, fields: Sequence[T.StructField], folders: Sequence[str]) -> str:
        name = self._name(path)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet"
            + f" OPTIONS (compression '{COMPRESSION}')"
            + (f" PARTITIONED BY ({', '.join(folders)})" if folders else "")
            + f" CLUSTERED BY ({self.key}) SORTED BY ({self.key}) INTO {self.number} BUCKETS LOCATION '{path}'")
        return name

    def write(
        self, rows: DataFrame, path: str, folders: Sequence[str] = (), gathered: bool = False
    ) -> DataFrame:
        """Full reload of a table of the set, in folders by columns if asked; returns it as written.

        The rows of a bucket are gathered before they are written, a very large one by several tasks,
        unless they come `gathered`, from a join of tables of the set by the key.
        """
        self.spark.sql(f"DROP TABLE IF EXISTS {self._name(path)}")
        columns = [c for c in rows.columns if c not in folders]
        rows = rows.select(*columns, *folders)
        name = self._create(path, rows.schema.fields, folders)
        if not gathered:
            rows = rows.hint("rebalance", self.number, self.key)
        rows.write.insertInto(name, overwrite=True)
        return self.spark.table(name)

    def open(self, path: str, folders: Sequence[str] = ()) -> DataFrame:
        """A table of the set, by its buckets or by its files."""
        if not self.number:
            return self.spark.read.parquet(path)
        name = self._name(path)
        if not self.spark.catalog.tableExists(name):
            self._create(path, self.spark.read.parquet(path).schema.fields, folders)
            if folders:
                self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        return self.spark.table(name)

    def settle(self, tables: Sequence[DataFrame]) -> "Buckets":
        """Judge the written tables by their largest bucket, and note the outcome."""
        even = True
        for rows in tables:
            bucket = F.pmod(F.hash(self.key), F.lit(self.number))
            sizes = rows.groupBy(bucket.alias("b")).count().agg(F.max("count").alias("most"), F.sum("count").alias("all")).first()
            most, total = sizes.most or 0, sizes["all"] or 0
            even = even and not (most > LARGE and most * self.number > UNEVEN * total)
        settled = Buckets(self.spark, self.folder, self.key, self.number if even else 0)
        literal_rows(self.spark, [(self.key, settled.number)], _SCHEMA).write.mode("overwrite").parquet(f"{self.folder}/{SPEC}")
        return settled
