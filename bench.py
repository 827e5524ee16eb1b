"""Benchmark: load the warehouse once, then time every report on it.

Prints one JSON line. ``load_*`` are the phases of the full load; ``oNN_*`` are warm times of
the reports on the written warehouse (best of two after one warm-up); ``direct_*`` are the same
reports straight from the source tables, joins included. ``pipeline_from_csv`` is the whole job:
nine raw CSV files (written beforehand, not timed) to staging, warehouse, validations and reports.

Environment: BENCH_SF_DIR, BENCH_CPUS.
"""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracles  # noqa: E402
import registry  # noqa: E402
from armazem.plans import checks, kpis, load, olap  # noqa: E402
from armazem.plans.star import StoredStar  # noqa: E402
from armazem.sources import sinks  # noqa: E402
from armazem.sources.binding import Source  # noqa: E402
from armazem.sources.catalog import RAW_TABLES  # noqa: E402

DIRECT = ("O01", "O07", "O08", "O15", "O16")


def session(cpus: str) -> SparkSession:
    """Partition and row-group sizes fit tables of a few MB, so that all cores have work."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("armazem-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.files.maxPartitionBytes", "2m")
        .config("spark.sql.files.openCostInBytes", "128k")
        .config("spark.hadoop.parquet.block.size", str(2 * 1024 * 1024))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(rows: DataFrame) -> None:
    """Compute every row and column without moving them to the driver."""
    rows.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def write_raw(source: Source, folder: str) -> None:
    """The nine raw files as folders of CSV parts, every column text."""
    for name, table in RAW_TABLES.items():
        rows = source.staging[name]
        as_text = rows.select(*[F.col(c).cast("string") for c in table.columns])
        as_text.write.mode("overwrite").option("header", True).options(**sinks.CSV_WRITE).csv(
            f"{folder}/shop_{table.file_ending}")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    target = tempfile.mkdtemp(prefix="load-", dir=sinks.shared_folder(spark)) if os.path.isdir(
        sinks.shared_folder(spark)) else sinks.shared_folder(spark) + "/load"
    times: dict[str, float] = {}

    source = Source(spark, folder)
    done: dict = {}

    def stage() -> None:
        done["stg"], done["audit"] = load.stage(spark, source.staging, target)

    def build() -> None:
        done["wh"] = load.build(done["stg"], source.states, target, oracles.RECURRING_ABOVE)

    times["load_staging"] = timed(stage)
    times["load_warehouse"] = timed(build)
    star = StoredStar(done["wh"])

    def measure(name: str, build_rows) -> None:
        run(build_rows())
        times[name] = min(timed(lambda: run(build_rows())) for _ in range(2))

    for code, (_, title) in olap.REPORTS.items():
        measure(f"{code.lower()}_{title}", lambda code=code: registry.report(code, star))
    measure("k01_kpis", lambda: kpis.kpis(star))
    measure("v03_reconciliation", lambda: checks.reconciliation(done["stg"], done["wh"]))
    for code in DIRECT:
        name = f"{code.lower()}_{olap.REPORTS[code][1]}"
        measure(f"direct_{name}", lambda code=code: registry.report(code, registry.star(spark, folder)))
    times["load_warehouse_warm"] = timed(build)
    write_raw(source, f"{target}/raw")
    volumes = registry.expected_volumes(spark, folder)
    times["pipeline_from_csv"] = timed(
        lambda: load.run_pipeline(spark, f"{target}/raw", f"{target}/warehouse", volumes))

    reports = sum(t for name, t in times.items() if name[0] == "o")
    print(json.dumps({
        "metric": "seventeen reports on the loaded warehouse",
        "value": round(reports, 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rstrip("/").split("sf")[-1],
        "cpus": int(cpus),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
