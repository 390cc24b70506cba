import re
from pathlib import Path

import numpy as np
import pyarrow as pa

from avionyx.llm.text import giving_back


def resident_mb():
    return int(re.search(r"\nRssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024


def test_a_task_gives_back_what_it_freed():
    pins = []  # the C heap shrinks by itself from its end only; these lie between the chunks

    def run(batches):
        for batch in batches:
            chunks = []
            for _ in range(1500):
                chunks.append(np.ones(100_000, np.uint8))
                pins.append(np.ones(2_000, np.uint8))
            del chunks
            yield batch

    batches = [pa.RecordBatch.from_pydict({"n": [i]}) for i in range(2)]
    kept_before = resident_mb()
    plain = list(run(iter(batches)))
    kept = resident_mb() - kept_before
    assert plain == batches and kept > 75, "the test's chunks must stay in the process without it"
    assert list(giving_back(run)(iter(batches))) == batches
    assert resident_mb() - kept_before < kept - 75
    task = giving_back(run)(iter(batches))
    next(task)
    task.close()  # a task that is ended early
    assert resident_mb() - kept_before < kept - 75
