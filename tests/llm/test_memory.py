"""What a worker holds beside its batch of texts, in the operators the pipeline runs first."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from armazem.llm import simhash, toxicity, words
from armazem.llm.runtime import byte_offsets, slices

MOST = 150 << 20


def large_batch():
    chance = np.random.default_rng(3)
    known = np.array([f"word{i}" for i in range(5000)])
    texts = [" ".join(known[chance.integers(0, 5000, 2000)]) for _ in range(600)]  # about 10 MB
    return pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])


@pytest.mark.parametrize("size, work", [
    (simhash._SLICE, lambda rows: simhash.fingerprint(*byte_offsets(rows.column("text")), 4)),
    (toxicity._SLICE, toxicity.entries),
])
def test_memory_beside_the_batch_is_bounded(size, work):
    rows = large_batch()
    words._powers.clear()
    tracemalloc.start()
    try:
        for part in slices([rows], "text", size):
            work(part)
        assert tracemalloc.get_traced_memory()[1] < MOST
    finally:
        tracemalloc.stop()


def test_slices_change_no_result():
    rows = large_batch().slice(0, 100)
    whole = simhash.fingerprint(*byte_offsets(rows.column("text")), 4)
    parts = [simhash.fingerprint(*byte_offsets(s.column("text")), 4) for s in slices([rows], "text", 1 << 18)]
    assert (np.concatenate(parts) == whole).all()
