"""Workers give freed memory back at the end of a task."""

import numpy as np
import pyarrow as pa

from skyfold.llm import bytekit as bk


def _resident() -> int:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4096


def test_a_task_leaves_no_freed_memory():
    def wasteful(batches):
        for batch in batches:
            some = [np.ones(2_000) for _ in range(5_000)]      # small blocks, 80 MB
            last = np.ones(2_000)                              # holds the heap's top
            del some
            yield batch
            del last

    batches = [pa.RecordBatch.from_arrays([pa.array([1])], names=["a"])] * 2
    before = _resident()
    assert len(list(bk.giving_back(wasteful)(batches))) == 2
    assert _resident() - before < 40 << 20
