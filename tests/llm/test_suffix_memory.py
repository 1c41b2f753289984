"""Workers of op9 hold a batch of texts as it came, and what they make of it a little at a time."""

import random
import tracemalloc

import pyarrow as pa
from test_search import cover

from leafwork.llm import common, suffixes


class Batches:
    """Stands for a DataFrame whose rows are one batch; what a worker makes of it comes batch by batch."""

    def __init__(self, batch):
        self.batch = batch

    def select(self, *_):
        return self

    def mapInPandas(self, f, _):  # noqa: N802
        return f(iter([self.batch.to_pandas()]))

    def mapInArrow(self, f, _):  # noqa: N802
        return f(iter([self.batch]))


def made(texts):
    """Rows and the most MB of objects at once, beyond the batch."""
    n = len(texts)
    found = suffixes.runs(Batches(pa.RecordBatch.from_pydict({"doc": list(range(n)), "uid": list(range(n)), "text": texts})))
    tracemalloc.start()
    try:
        rows, most = 0, 0
        for out in found:
            rows, most = rows + len(out), max(most, len(out))
        return rows, most, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_many_texts_are_cut_up_a_little_at_a_time():
    r = random.Random(3)
    rows, most, mb = made([r.randbytes(1000).hex() for _ in range(5_000)])
    assert rows > 100_000 and most < 40_000 and mb < 25


def test_a_long_text_is_cut_up_a_little_at_a_time():
    rows, most, mb = made([random.Random(4).randbytes(3_000_000).hex()])
    assert rows > 80_000 and most < 40_000 and mb < 60


def test_workers_give_back(monkeypatch):
    called = []
    monkeypatch.setattr(common, "give_back", lambda: called.append(1))
    made(["a" * 300])
    assert len(called) == 2


def test_every_window_is_in_one_run(monkeypatch):
    monkeypatch.setattr(suffixes, "SLICE", 300)
    r = random.Random(5)
    texts = [r.randbytes(n) for n in (0, 199, 200, 250, 40, 299, 300, 301, 498, 499, 500, 501, 4000, 260)] + [b"ab" * 700]
    windows = [[] for _ in texts]
    for k, first, last, s, _ in suffixes.positions(texts):
        for a, b, c in zip(first.tolist(), last.tolist(), s.tolist()):
            assert b <= c <= a + suffixes.LENGTH - suffixes.GRAM
            windows[k] += range(a, b + 1)
    assert windows == [list(range(max(0, len(t) - suffixes.LENGTH + 1))) for t in texts]


def test_repeats_across_the_pieces_of_long_texts(spark):
    r = random.Random(6)
    long = r.randbytes(suffixes.SLICE).hex()  # two pieces and a border
    edge = suffixes.SLICE
    rows = [(0, long), (1, "é" + long[edge - 700 : edge + 900]), (2, long[edge - 150 : edge + 150] + "z" + long[edge - 100 : edge + 99]), (3, long[edge - 199 : edge + 1]), (4, long[:300]), (5, "ab" * edge), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in suffixes.remove(docs).collect())
    assert got == sorted(cover(rows, suffixes.LENGTH))
