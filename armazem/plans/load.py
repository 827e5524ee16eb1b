"""The full load: raw files -> staging tables -> dimensions -> facts, and the whole pipeline."""

import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from armazem import vocabulary as v
from armazem.plans import checks, dims, facts, olap
from armazem.plans.quarantine import REJECTED, Quarantine, TooManyRejects, accepted, judged, rejects
from armazem.plans.star import YEAR_FOLDER, StoredStar
from armazem.sources import rawfiles, sinks
from armazem.sources.buckets import Buckets
from armazem.sources.catalog import RAW_TABLES
from armazem.sources.lazy import LazyTables
from armazem.sources.literals import literal_rows

DIMENSIONS = (
    "dim_tempo", "dim_cliente", "dim_produto", "dim_vendedor", "dim_geografia", "dim_pagamento",
    "dim_status",
)
FACTS = ("fato_pedido", "fato_vendas")
# Facts and raw tables of the order's grain are dealt by the order, so they meet without a shuffle.
ORDER, ORDER_TABLES = "order_id", ("orders", "order_items", "order_payments", "order_reviews")
AUDIT = "controle_carga"
VERSIONS, POINTER = "versoes", "atual"
_EVENT_SCHEMA = (
    "versao string, id_carga int, arquivo string, tabela_destino string, registros_lidos bigint,"
    " registros_carregados bigint, registros_rejeitados bigint, situacao string"
)
# Jobs of independent tables are submitted together so that small ones fill idle cores.
_PARALLEL_WRITES = 8


def _together(work: Callable, names: Iterable[str]) -> dict:
    names = list(names)
    with ThreadPoolExecutor(_PARALLEL_WRITES) as pool:
        return dict(zip(names, pool.map(work, names)))


class Audit:
    """What happened to each raw table, as events that are appended while a load runs.

    Nothing written is changed: a load that breaks off leaves the events up to that point, and
    an earlier load's events never stand for a later one. Times are those of the event's job.
    """

    def __init__(self, spark: SparkSession, folder: str, version: str = ""):
        self.spark, self.path, self.version = spark, f"{folder}/{AUDIT}", version

    def note(
        self, number: int, name: str, situation: str,
        read: int | None = None, loaded: int | None = None, rejected: int | None = None,
    ) -> None:
        self._add([(number, name, read, loaded, rejected, situation)])

    def begin(self, numbers: Mapping[str, int]) -> None:
        """All tables of a load begin: their events are one small file."""
        self._add([(number, name, None, None, None, v.LOAD_RUNNING) for name, number in numbers.items()])

    def _add(self, events: list[tuple]) -> None:
        rows = [(self.version, number, RAW_TABLES[name].file_ending, name, *rest) for number, name, *rest in events]
        added = literal_rows(self.spark, rows, _EVENT_SCHEMA).withColumn("momento", F.current_timestamp())
        # A folder of its own each time: tables are loaded side by side, and writers of one folder meet.
        added.write.mode("error").parquet(f"{self.path}/{self.version}/{rows[0][1]}-{uuid.uuid4().hex[:8]}")

    def events(self) -> DataFrame:
        files = self.spark.read.schema(f"{_EVENT_SCHEMA}, momento timestamp").option("recursiveFileLookup", True)
        return files.parquet(self.path)

    def report(self) -> DataFrame:
        """One row per table of the load of this version: the outcome, or that there is none yet."""
        own = self.events().where(F.col("versao") == self.version)
        over = F.col("situacao") != v.LOAD_RUNNING

        def outcome(name: str) -> Column:
            return F.max(F.when(over, F.col(name))).alias(name)

        return own.groupBy("id_carga", "arquivo", "tabela_destino").agg(
            outcome("registros_lidos"), outcome("registros_carregados"), outcome("registros_rejeitados"),
            F.min("momento").alias("inicio_carga"), F.max(F.when(over, F.col("momento"))).alias("fim_carga"),
            F.coalesce(F.max(F.when(over, F.col("situacao"))), F.lit(v.LOAD_RUNNING)).alias("situacao"),
        ).orderBy("id_carga")


def stage(
    spark: SparkSession, raw: Mapping[str, DataFrame], folder: str, audit: Audit | None = None,
    quarantine: Quarantine | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Write every raw table, and note in the audit when each begins and how it ends.

    Rows read are counted while they are written; rows loaded are counted on the written
    table, so a difference between the two would show. With a quarantine, rows that could not be
    cast are written beside the others and kept out of what is returned; what was read must then
    equal what was loaded and rejected.
    """
    audit = audit or Audit(spark, folder, uuid.uuid4().hex)
    numbers = {name: i for i, name in enumerate(raw, 1)}
    dealt = Buckets.begin(spark, folder, ORDER)

    audit.begin(numbers)

    def one(name: str) -> DataFrame:
        figures = ()
        try:
            seen = Observation(f"rows read {name}")
            rows = raw[name] if quarantine is None else judged(raw[name], name)
            counted = rows.observe(seen, F.count(F.lit(1)).alias("read"))
            path = f"{folder}/staging/{name}"
            written = dealt.write(counted, path) if name in ORDER_TABLES else sinks.write_table(counted, path)
            stored = accepted(written)
            loaded, rejected = stored.count(), 0
            if quarantine is not None:
                rejected = written.where(REJECTED).count()
            figures = (seen.get["read"], loaded, rejected)
            if quarantine is not None and quarantine.exceeded(rejected, figures[0]):
                raise TooManyRejects(f"{name}: {rejected} of {figures[0]} rows rejected")
        except Exception:
            audit.note(numbers[name], name, v.LOAD_FAILED, *figures)
            raise
        outcome = v.LOAD_DONE if figures[0] == loaded + rejected else v.LOAD_DIVERGED
        audit.note(numbers[name], name, outcome, *figures)
        return stored

    stored = _together(one, raw)
    settled = dealt.settle([stored[n] for n in ORDER_TABLES if n in stored])
    for name in ORDER_TABLES:
        if name in stored and not settled.number:
            stored[name] = accepted(settled.open(f"{folder}/staging/{name}"))
    return stored, audit.report()


def build(
    stg: Mapping[str, DataFrame], states: DataFrame, folder: str, recurring_above: int = 1
) -> dict[str, DataFrame]:
    """Full reload of the dimensions, then of the order fact, then of the item fact."""
    tables = _together(
        lambda name: sinks.write_table(
            dims.dimension(name, stg, states, recurring_above, f"{folder}/naturais/{name}"),
            f"{folder}/{name}",
        ),
        DIMENSIONS,
    )
    dealt = Buckets.of(tables["dim_tempo"].sparkSession, folder)
    by_order = dealt is not None and dealt.number > 0
    orders = facts.order_fact(stg, tables, by_order)
    tables["fato_pedido"] = _write_fact(orders, "sk_tempo_compra", f"{folder}/fato_pedido", dealt)
    items = facts.item_fact(stg, tables, tables["fato_pedido"], by_order)
    tables["fato_vendas"] = _write_fact(items, "sk_tempo", f"{folder}/fato_vendas", dealt)
    return tables


def _write_fact(rows: DataFrame, day: str, path: str, dealt: Buckets | None) -> DataFrame:
    """One folder per year of purchase, which a slice of years opens alone.

    Inside, the rows are dealt by order where the staged tables are, as they come; else they are sorted by day,
    gathered in as few files as their size asks for, and a large year is split.
    """
    dated = rows.withColumn(YEAR_FOLDER, F.expr(f"{day} div 10000").cast("int"))
    if dealt is not None and dealt.number:
        return dealt.write(dated, path, [YEAR_FOLDER], gathered=True)
    gathered = dated.hint("rebalance", YEAR_FOLDER).sortWithinPartitions(YEAR_FOLDER, day)
    gathered.write.mode("overwrite").partitionBy(YEAR_FOLDER).parquet(path)
    return rows.sparkSession.read.parquet(path)


def _open(spark: SparkSession, folder: str, names: Iterable[str], home: str = "") -> LazyTables:
    """Tables of a version; `home`: where in it they are."""
    dealt = Buckets.of(spark, folder)

    def open_one(name: str) -> DataFrame:
        path = f"{folder}{home}/{name}"
        if dealt is None or name not in ORDER_TABLES + FACTS:
            return spark.read.parquet(path)
        return dealt.open(path, [YEAR_FOLDER] if name in FACTS else [])

    return LazyTables({n: lambda n=n: open_one(n) for n in names})


def published(spark: SparkSession, folder: str) -> list[str]:
    """Versions of a warehouse that were finished, oldest first."""
    try:
        found = spark.read.schema("versao string").option("recursiveFileLookup", True).parquet(f"{folder}/{POINTER}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(r.versao for r in found.distinct().collect())


def new_version(folder: str, before: Iterable[str] = ()) -> tuple[str, str]:
    """Name and folder of a version after those before it."""
    last = max((int(name.split("-")[0]) for name in before), default=0)
    version = f"{last + 1:08d}-{uuid.uuid4().hex[:8]}"
    return version, f"{folder}/{VERSIONS}/{version}"


def publish(spark: SparkSession, folder: str, version: str) -> None:
    """Make a version the one that readers open: one row is added, nothing is replaced."""
    literal_rows(spark, [(version,)], "versao string").write.mode("error").parquet(f"{folder}/{POINTER}/{version}")


def current(spark: SparkSession, folder: str) -> str:
    """Folder of the version to read: the last one published, or the folder itself where tables
    were built straight into it."""
    done = published(spark, folder)
    return f"{folder}/{VERSIONS}/{done[-1]}" if done else folder


def open_warehouse(spark: SparkSession, folder: str) -> Mapping[str, DataFrame]:
    return _open(spark, current(spark, folder), DIMENSIONS + FACTS)


def open_staging(spark: SparkSession, folder: str) -> Mapping[str, DataFrame]:
    """Staged tables, without the rows that a quarantine kept out."""
    staged = _open(spark, current(spark, folder), RAW_TABLES, "/staging")
    return LazyTables({n: lambda n=n: accepted(staged[n]) for n in RAW_TABLES})


def open_rejects(spark: SparkSession, folder: str, tables: Iterable[str] = tuple(RAW_TABLES)) -> DataFrame:
    """What a load with a quarantine kept out, one row per fault; `folder` is that of a version
    where the load was not published."""
    home = current(spark, folder)
    found = []
    for name in tables:
        staged = spark.read.parquet(f"{home}/staging/{name}")
        if REJECTED in staged.columns:
            found.append(rejects(staged, name))
    if not found:
        return literal_rows(spark, [(None,) * 5], "tabela string, linha string, coluna string, texto string, motivo string").limit(0)
    return reduce(DataFrame.unionByName, found)


def open_audit(spark: SparkSession, folder: str) -> DataFrame:
    """The audit of the last load that began, finished or not."""
    events = Audit(spark, folder).events()
    last = events.groupBy("versao").agg(F.min("momento").alias("began")).orderBy(F.desc("began"), F.desc("versao")).first()
    return Audit(spark, folder, last.versao if last else "").report()


@dataclass(frozen=True)
class PipelineResult:
    warehouse: dict[str, DataFrame]
    audit: DataFrame
    validations: dict[str, DataFrame]
    failures: int
    published: bool

    @property
    def exit_code(self) -> int:
        return 1 if self.failures else 0


def run_pipeline(
    spark: SparkSession,
    raw_dir: str,
    folder: str,
    expected: Iterable[tuple[str, int]] = v.EXPECTED_VOLUMES,
    quarantine: Quarantine | None = None,
) -> PipelineResult:
    """Raw files in, warehouse, validations and one CSV per report out.

    Every load builds a version of its own; readers see it once it is complete and breaks no
    constraint, so a load that fails leaves the warehouse before it untouched. A failed
    validation does not stop the reports; it is counted and sets the exit code. Bad values stop the
    load, unless a quarantine sets their rows aside.
    """
    raw = rawfiles.read_all(spark, raw_dir, keep_malformed=quarantine is not None)
    version, own = new_version(folder, published(spark, folder))
    stg, audit = stage(spark, raw, own, Audit(spark, folder, version), quarantine)
    warehouse = build(stg, dims.default_states(spark), own)
    validations = checks.all_validations(stg, warehouse, audit, expected)
    failures = checks.failures(validations)
    sound = not checks.failures({"V06": validations["V06"]})
    if sound:
        publish(spark, folder, version)
    star = StoredStar(warehouse)
    _together(
        lambda code: sinks.export_report(
            olap.REPORTS[code][0](star), f"{own}/reports/{code}_{olap.REPORTS[code][1]}"
        ),
        olap.REPORTS,
    )
    return PipelineResult(warehouse, audit, validations, failures, sound)
