"""A row of 60 MB: what a worker needs for it beside the text itself."""

import multiprocessing
import resource

import numpy as np
import pyarrow as pa
import pytest

from tablemill.llm import decontaminate, minhash_dedup, substring_dedup

MOST_MB = 1_150  # three times that for one executor; the interpreter and the text are 280 of it


def work(name, tell):
    rng = np.random.default_rng(1)
    letters = rng.integers(97, 123, 60_000_000, dtype=np.uint8)
    letters[rng.integers(0, 6, len(letters), dtype=np.uint8) == 0] = 32
    text = pa.array([letters.tobytes().decode()])
    del letters

    class Shared:
        value = None

    if name == "sign":
        out = minhash_dedup._signer(5, 128, 4)([pa.RecordBatch.from_arrays([pa.array([1]), text], ["id", "text"])])
    elif name == "match":
        Shared.value = decontaminate._Index([("a", "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda")], 10)
        rest = [pa.array([[]], pa.list_(pa.int32())), pa.array([[]], pa.list_(pa.string())), pa.array([0]), pa.array([-1]), pa.array([None], pa.string()), pa.array([-1])]
        out = decontaminate._scanner(Shared)([pa.RecordBatch.from_arrays([pa.array([1]), text, *rest], decontaminate._STATE[:-1])])
    else:
        rows = [pa.RecordBatch.from_arrays([pa.array([1]), pa.array([1]), text], ["id", "tie", "text"])]
        Shared.value = np.full(1 << 15, 2**64 - 1, dtype=np.uint64)  # every seed is marked
        out = substring_dedup._seed_counter(20)(rows) if name == "count" else substring_dedup._cutter(Shared, 20)(rows)
    rows = sum(batch.num_rows for batch in out)
    tell.put((rows, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024))


@pytest.mark.parametrize("name", ["sign", "match", "count", "cut"])
def test_long_text(name):
    here = multiprocessing.get_context("spawn")
    tell = here.Queue()
    process = here.Process(target=work, args=(name, tell))
    process.start()
    rows, peak = tell.get(timeout=240)
    process.join()
    assert rows > 0 and peak < MOST_MB
