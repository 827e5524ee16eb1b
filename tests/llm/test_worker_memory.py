"""What a worker keeps between the operators of the pipeline, and that no other is started (round 3, F1)."""

import subprocess
import sys
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from armazem.llm import bpe, decontamination, digests, runtime, words

KEPT_BY_A_WORKER = """
import re
import numpy as np, pyarrow as pa
from armazem.llm.runtime import slices

def held():
    return int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) >> 10

def batches():
    for _ in range(4):
        yield pa.RecordBatch.from_arrays([pa.array(["some text " * 100] * 30_000)], ["text"])  # 30 MB

def work(rows):
    return [np.ones(len(rows) * 50) for _ in range(2)], rows.column("text").to_pylist()

for rows in slices(batches(), "text", 1 << 20):
    work(rows)
del rows
before, small = held(), [np.ones(2_000) for _ in range(5_000)]  # 80 MB by small pieces, the last one stays
small, batch = small[-1], None
for _ in slices(batches(), "text", 1 << 20):
    pass
del _
print(held() - before)
"""


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_freed_memory_goes_back_to_the_system():
    run = subprocess.run([sys.executable, "-c", KEPT_BY_A_WORKER], capture_output=True, text=True, cwd=runtime.ROOT, timeout=120)
    assert run.returncode == 0, run.stderr
    assert int(run.stdout) < 60


def test_words_of_a_large_slice_take_bounded_memory():
    known = np.array([f"word{i}" for i in range(5000)])
    chance = np.random.default_rng(3)
    rows = pa.RecordBatch.from_arrays([pa.array([" ".join(known[chance.integers(0, 5000, 2000)]) for _ in range(250)])], ["text"])
    words._powers.clear()
    tracemalloc.start()
    try:
        h, first = decontamination.tokens(rows)
        assert tracemalloc.get_traced_memory()[1] < 50 << 20
    finally:
        tracemalloc.stop()
    w = words.words(*runtime.byte_offsets(rows.column("text")), words.MARKS)
    assert (h == w.hashes(lower=True)[0] | np.uint64(2)).all() and (first == w.first).all()


def test_words_of_no_text_and_of_empty_ones():
    rows = pa.RecordBatch.from_arrays([pa.array(["", "one two", "", "three", ""])], ["text"])
    assert decontamination.tokens(rows)[1].tolist() == [0, 0, 2, 2, 3, 3]
    assert [x.tolist() for x in decontamination.tokens(rows.slice(0, 0))] == [[], [0]]


def test_pieces_kept_are_bounded_and_met_again(monkeypatch):
    monkeypatch.setattr(bpe, "_KEPT", 100)
    pieces = bpe._Pieces({bytes([b]): b for b in range(256)})
    names = [f"p{i}" for i in range(1000)]
    for name in names:
        pieces.age()
        assert np.frombuffer(pieces[name], "<u4").tolist() == list(name.encode())
        assert np.frombuffer(pieces["often"], "<u4").tolist() == list(b"often")
        assert len(pieces) + len(pieces.before) <= 204
    merged = []
    monkeypatch.setattr(bpe, "merge", lambda raw, ranks: merged.append(raw))
    pieces.age()
    assert pieces["often"] and not merged  # taken over, not encoded again


def test_digest_index_begins_without_python_on_the_executors(spark, monkeypatch):
    def refused(*_, **__):
        raise AssertionError("rows handed over from the driver's Python")

    docs = spark.createDataFrame([(1, "a"), (2, "A"), (3, None)], "doc_id long, text string")
    monkeypatch.setattr(type(spark), "createDataFrame", refused)
    index = digests.DigestIndex(spark, runtime.run_folder(spark, "index"), 3)
    try:
        assert index.rows().schema.simpleString() == "struct<text_sha256:string,keep_id:bigint,group_size:bigint>"
        assert index.rows().count() == 0 and tuple(index._spec()) == (1, 0, 3)
        kept = digests.deduplicated(docs, index).where("kept").collect()
        assert sorted(r.doc_id for r in kept) == [2, 3]
    finally:
        index.close()
