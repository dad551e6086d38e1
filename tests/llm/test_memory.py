"""What a worker keeps and what it hands back."""

import re
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from tillroll.llm import common, context_tree, simhash, weak_quality


def held_mb():
    return int(re.search(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_freed_memory_goes_back():
    common.give_back()
    before = held_mb()
    # Too small for pages of their own; the last ones keep the heap from shrinking by itself.
    arrays = [np.ones(5000) for _ in range(4000)]
    columns = [pa.array(["x" * 50_000]).cast(pa.large_string()) for _ in range(2000)]
    last = arrays[-1], columns[-1]
    assert held_mb() > before + 200
    del arrays, columns
    common.give_back()
    assert held_mb() < before + 30
    del last


def test_kept_values_are_those_of_one_stage(monkeypatch):
    monkeypatch.setattr(common, "_kept", {})
    stage, made = [1], []
    monkeypatch.setattr(common, "_stage", lambda: stage[0])

    def make():
        made.append(stage[0])
        return object()

    one = common.kept("table", make)
    common.give_back()
    assert common.kept("table", make) is one
    stage[0] = 2
    common.give_back()
    assert not common._kept
    assert common.kept("table", make) is not one
    assert made == [1, 2]


def test_operators_let_go_of_what_another_stage_kept(monkeypatch):
    texts = pa.array(["some text", "other text"])
    batch = pa.RecordBatch.from_pydict({"held_out": [False, True], "text": texts})
    cells = {c: pa.array([0, 0], pa.int64()) for c in ("t", "key", "i", "j", "fp")}
    runs = [
        lambda: weak_quality._measure_batch(texts),
        lambda: list(simhash._compare(4)([pa.RecordBatch.from_pydict(cells)])),
        lambda: list(context_tree._count_words([batch])),
        lambda: list(context_tree._count_windows([batch])),
    ]
    monkeypatch.setattr(common, "_kept", {})
    for run in runs:
        common._kept["earlier stage", "table"] = object()
        run()
        assert not common._kept
