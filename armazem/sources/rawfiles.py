"""Reading the raw CSV files as text tables."""

import csv
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from armazem import vocabulary as v
from armazem.sources import splitcsv
from armazem.sources.catalog import RAW_TABLES, RawTable
from armazem.sources.literals import literal_rows
from armazem.sources.sinks import shared_folder, write_table


class MissingInput(FileNotFoundError):
    """One or more required raw files do not exist."""


class HeaderMismatch(ValueError):
    """The columns of a raw file are not those of its table."""


def raw_path(raw_dir: str, table: str) -> str:
    """Glob for the file of a table; any prefix before the usual ending is accepted."""
    return f"{raw_dir.rstrip('/')}/*{RAW_TABLES[table].file_ending}"


#: Holds a row whose width is wrong, where such rows are kept.
MALFORMED = "linha_malformada"
_CSV = {"header": True, "encoding": "UTF-8", "quote": '"', "escape": '"'}


def survey(spark: SparkSession, path: str, quotes: bool = False) -> DataFrame:
    """What one scan tells of the files behind a path or glob: see splitcsv.survey(). Written, as
    several steps ask it; one short row for each block of a file."""
    blocks = splitcsv.survey(splitcsv.lines(spark, path))
    if not quotes:
        blocks = blocks.where("block = 0").drop("n_quotes")
    return write_table(blocks, f"{shared_folder(spark)}/survey-{uuid.uuid4().hex}")


def headers(blocks: DataFrame) -> dict[tuple[str, ...], list[str]]:
    """The surveyed files by their header, names as written. A file without any line, as a writer
    leaves for an empty task, has no header to check."""
    found: dict[tuple[str, ...], list[str]] = {}
    for file, line in blocks.where("block = 0").select("file", "header").orderBy("file").collect():
        names = next(csv.reader([line.removeprefix("\ufeff").rstrip("\r")]), [])
        found.setdefault(tuple(names), []).append(file)
    return found or {(): []}


def missing_inputs(spark: SparkSession, raw_dir: str, tables: Iterable[str] = tuple(RAW_TABLES)) -> list[str]:
    """Tables without a raw file."""
    missing = []
    for table in tables:
        try:
            spark.read.text(raw_path(raw_dir, table))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(table)
    return missing


def require_inputs(
    spark: SparkSession, raw_dir: str, tables: Iterable[str] = tuple(RAW_TABLES)
) -> None:
    """Raise before anything is written when a required file is missing."""
    missing = missing_inputs(spark, raw_dir, tables)
    if missing:
        raise MissingInput("required raw files not found: " + ", ".join(raw_path(raw_dir, t) for t in missing))


def input_report(spark: SparkSession, raw_dir: str) -> DataFrame:
    """One row per required raw table: arquivo, tabela_destino, encontrado, situacao."""
    missing = set(missing_inputs(spark, raw_dir))
    rows = [(t.file_ending, name, name not in missing) for name, t in RAW_TABLES.items()]
    report = literal_rows(spark, rows, "arquivo string, tabela_destino string, encontrado boolean")
    return report.withColumn("situacao", F.when(F.col("encontrado"), v.OK).otherwise(v.FAILED))


def check_header(names: list[str], table: RawTable, path: str) -> None:
    """The set of columns must match; their order is free."""
    if set(names) != set(table.columns) or len(names) != len(table.columns):
        raise HeaderMismatch(f"{path}: columns {names} differ from {list(table.columns)}")


def read_raw(
    spark: SparkSession, path: str, table: RawTable, split: bool | None = None, keep_malformed: bool = False
) -> DataFrame:
    """A raw table: every column text, empty fields NULL, quotes doubled inside quotes.

    One scan checks the header of every part file, whatever their number; parts may have their
    columns in different orders. FAILFAST stops on a row whose width is wrong instead of reading it
    as something else; with `keep_malformed` such a row is kept, its text in a column of its own.

    Files with free text may hold line breaks inside quotes. Where Spark would split them, their
    records are put together first (splitcsv.py); files of one block each are read whole. `split`
    forces one or the other.
    """
    blocks = survey(spark, path, quotes=table.free_text)
    found = headers(blocks)
    for filed, files in found.items():
        check_header([c.strip() for c in filed], table, files[0] if files else path)
    if table.free_text and split is None:
        split = not blocks.where("block > 0").isEmpty()
    also = [MALFORMED] if keep_malformed else []
    parse = {**_CSV, "multiLine": table.free_text, "mode": "FAILFAST"}
    if keep_malformed:
        parse |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    if table.free_text and split:
        return _in_table_order(splitcsv.records(spark, path, blocks), found, table, parse, also)
    parts = []
    for filed, files in found.items():
        as_filed = T.StructType([T.StructField(c, T.StringType()) for c in [*(x.strip() for x in filed), *also]])
        rows = (
            spark.read.schema(as_filed)
            .options(**parse)
            .csv([unquote(f) for f in files] if len(found) > 1 else path)  # file_path is an encoded URI
        )
        parts.append(rows.select(*table.columns, *also))
    return reduce(DataFrame.unionByName, parts)


def _in_table_order(
    records: DataFrame, found: dict[tuple[str, ...], list[str]], table: RawTable, parse: dict, also: list[str]
) -> DataFrame:
    """Records with the columns of the table, each by the header of its own file."""
    places = [[c.strip() for c in filed] for filed in found]
    if len(found) == 1:
        return splitcsv.parsed(records, [*places[0], *also], parse).select(*table.columns, *also)
    groups = [(file, g) for g, files in enumerate(found.values()) for file in files]
    known = records.sparkSession.createDataFrame(groups, "file string, header int")
    if len(groups) <= splitcsv.MOST_SENT:
        known = F.broadcast(known)
    by_place = [f"c{i}" for i in range(len(table.columns))]
    rows = splitcsv.parsed(records.join(known, "file"), [*by_place, *also], parse, "header")
    return rows.select(*[
        F.coalesce(*[F.when(F.col("header") == g, F.col(f"c{names.index(c)}")) for g, names in enumerate(places)]).alias(c)
        for c in table.columns], *also)


def read_all(spark: SparkSession, raw_dir: str, keep_malformed: bool = False) -> dict[str, DataFrame]:
    require_inputs(spark, raw_dir)
    with ThreadPoolExecutor(len(RAW_TABLES)) as pool:  # one scan a table, side by side
        read = pool.map(
            lambda n: read_raw(spark, raw_path(raw_dir, n), RAW_TABLES[n], keep_malformed=keep_malformed), RAW_TABLES)
        return dict(zip(RAW_TABLES, read))


def header_report(spark: SparkSession, path: str, table: RawTable) -> DataFrame:
    """One row per expected or found column and whether it is on both sides."""
    found = [c.strip() for c in next(iter(headers(survey(spark, path))))]
    names = list(dict.fromkeys([*table.columns, *found]))
    rows = [(n, n in table.columns, n in found) for n in names]
    report = literal_rows(spark, rows, "coluna string, esperada boolean, encontrada boolean")
    matched = F.col("esperada") & F.col("encontrada")
    return report.withColumn("situacao", F.when(matched, v.OK).otherwise(v.FAILED))
