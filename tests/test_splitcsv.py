"""Large CSV files with quoted line breaks, split among tasks, against Spark's whole-file reader."""

import csv
import random
from collections import Counter

import pytest
from armazem.sources import rawfiles, splitcsv
from armazem.sources.catalog import RawTable
from pyspark.sql import functions as F

TABLE = RawTable(("id", "title", "message", "answer"), "", free_text=True)
PIECES = ["word", "said ", '"', '""', "\n", "\n\n", ",", " ", "ção", "\U0001f600", "x" * 90, "", "'", "\\", ";", "\t", "a,\"b\"\n"]


def made(n, seed, breaks=1.0):
    rng = random.Random(seed)
    pieces = [p for p in PIECES if breaks or "\n" not in p]

    def text():
        return "".join(rng.choices(pieces, k=rng.randrange(8)))

    return [[str(i), text(), text() if rng.random() < 0.7 else "", rng.choice(["", "yes", "no\nmaybe" if breaks else "no"])] for i in range(n)]


def write(path, rows, columns=TABLE.columns, end="\n", quoting=csv.QUOTE_MINIMAL):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator=end, quoting=quoting)
        out.writerow(columns)
        for r in rows:
            named = dict(zip(TABLE.columns, r))
            out.writerow([named[c] for c in columns])


@pytest.fixture
def small_blocks(spark):
    """Files split at every few hundred bytes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def split(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield split
    for k, old in before.items():
        spark.conf.set(k, old)


def both(spark, path):
    """Rows by splits, having checked them against the whole-file reader; and the number of blocks."""
    path = str(path)
    got = Counter(map(tuple, rawfiles.read_raw(spark, path, TABLE, split=True).collect()))
    whole = Counter(map(tuple, rawfiles.read_raw(spark, path, TABLE, split=False).collect()))
    assert got == whole
    return got, rawfiles.survey(spark, path, quotes=True).count()


def expected(rows):
    return Counter(tuple(x or None for x in r) for r in rows)


@pytest.mark.parametrize("size", [64, 999, 4096])
def test_records_equal_the_whole_file_reader(spark, tmp_path, small_blocks, size):
    rows = made(60 if size < 100 else 300, seed=size)
    write(tmp_path / "one.csv", rows)
    small_blocks(size)
    got, blocks = both(spark, tmp_path / "one.csv")
    assert got == expected(rows)
    assert blocks > 3


def test_every_field_quoted_and_carriage_returns(spark, tmp_path, small_blocks):
    rows = made(200, seed=1)
    write(tmp_path / "quoted.csv", rows, quoting=csv.QUOTE_ALL)
    small_blocks(900)
    assert both(spark, tmp_path / "quoted.csv")[0] == expected(rows)
    rows = made(200, seed=2, breaks=0)
    write(tmp_path / "crlf.csv", rows, end="\r\n")
    assert Counter(map(tuple, rawfiles.read_raw(spark, str(tmp_path / "crlf.csv"), TABLE, split=True).collect())) == expected(rows)


def test_one_record_over_many_blocks(spark, tmp_path, small_blocks):
    long = "\n".join(f'line {i} "quoted", here' for i in range(1200))
    rows = [["0", "a", "b", "c"], ["1", "t", long, "x"], ["2", "q\n", "", "y"], ["3", long[:500], long[:3000], "z"]]
    write(tmp_path / "one.csv", rows)
    small_blocks(1024)
    got, blocks = both(spark, tmp_path / "one.csv")
    assert got == expected(rows) and blocks > 25


def test_parts_with_their_own_headers_and_empty_parts(spark, tmp_path, small_blocks):
    folder = tmp_path / "parts with blanks"
    folder.mkdir()
    rows = made(300, seed=7)
    write(folder / "a.csv", rows[:100])
    write(folder / "b.csv", rows[100:200], columns=TABLE.columns[::-1])
    write(folder / "c.csv", rows[200:])
    write(folder / "d.csv", [])
    (folder / "e.csv").write_text("")
    small_blocks(1500)
    got, _ = both(spark, folder)
    assert got == expected(rows)


def test_more_blocks_than_are_sent(spark, tmp_path, small_blocks, monkeypatch):
    monkeypatch.setattr(splitcsv, "MOST_SENT", 0)
    rows = made(150, seed=11)
    write(tmp_path / "one.csv", rows)
    small_blocks(700)
    assert both(spark, tmp_path / "one.csv")[0] == expected(rows)


def test_rows_of_a_wrong_width_stop_the_load(spark, tmp_path, small_blocks):
    write(tmp_path / "one.csv", made(50, seed=3))
    with open(tmp_path / "one.csv", "a") as f:
        f.write("51,too,few\n")
    small_blocks(200)
    with pytest.raises(Exception, match="(?i)malformed"):
        rawfiles.read_raw(spark, str(tmp_path / "one.csv"), TABLE, split=True).collect()


def test_blocks_of_a_large_file_are_split_without_being_asked(spark, tmp_path, small_blocks):
    """The largest task is a block, however long the file is."""
    largest = []
    for n in (500, 2000):
        write(tmp_path / f"{n}.csv", made(n, seed=n))
        small_blocks(4096)
        rows = rawfiles.read_raw(spark, str(tmp_path / f"{n}.csv"), TABLE)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "FileScan csv" not in plan
        size = F.octet_length("value") + 1
        per_block = splitcsv.lines(spark, str(tmp_path / f"{n}.csv")).groupBy("block").agg(F.sum(size).alias("n"))
        largest.append(max(r.n for r in per_block.collect()))
        assert per_block.count() > n / 100
        assert rows.count() == n
    assert largest[1] < largest[0] * 1.5
    small_blocks(1 << 27)
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 22))
    write(tmp_path / "small.csv", made(20, seed=5))
    assert "MapInArrow" not in rawfiles.read_raw(spark, str(tmp_path / "small.csv"), TABLE)._jdf.queryExecution().executedPlan().toString()


def test_headers_are_read_in_one_job_whatever_the_number_of_parts(spark, tmp_path):
    table = RawTable(("id", "title", "message", "answer"), "")
    jobs = []
    for n in (2, 40):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            write(folder / f"{i}.csv", made(3, seed=i, breaks=0))
        group = f"headers-{n}"
        spark.sparkContext.setJobGroup(group, group)
        rows = rawfiles.read_raw(spark, str(folder), table)
        spark.sparkContext.setJobGroup("", "")
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
        assert rows.count() == 3 * n
    assert jobs[0] == jobs[1]
