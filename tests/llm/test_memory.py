"""Workers return what they freed, so that those that wait for the next stage stay small."""

import inspect

import pandas as pd

from leafwork.llm import common, jaccard, packing


def test_freed_memory_is_given_back(monkeypatch):
    called = []
    monkeypatch.setattr(common, "give_back", lambda: called.append(1))
    batches = [pd.DataFrame({"x": [k]}) for k in range(3)]
    double = lambda source: (b * 2 for b in source)
    assert [int(b.x[0]) for b in common.lean(double)(iter(batches))] == [0, 2, 4] and len(called) == 1
    assert [int(b.x[0]) for b in common.lean(double, True)(iter(batches))] == [0, 2, 4] and len(called) == 1 + 4


def test_what_reads_texts_gives_back_after_each_batch():
    for f in (jaccard.sketches, jaccard.classes, packing.token_pieces):
        assert "mapInPandas(lean(" in inspect.getsource(f)
    common.give_back()
