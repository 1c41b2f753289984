"""Sequences of very many short pieces."""

from collections import Counter

import pytest

from leafwork.llm import packing


@pytest.mark.parametrize("counts, bins", [({1: 100_000}, 49), ({1: 90_000, 2: 20_000, 3: 5_000}, 71), ({2: 60_000}, 59), ({1: 5, 2048: 2}, 3), ({1000: 3, 1: 3_000}, 3)])
def test_many_short_pieces_fill_their_sequences(counts, bins):
    found = packing.plan_bins(counts)
    taken = Counter()
    for lengths, times in found:
        assert sum(lengths) <= packing.CAPACITY
        for x in lengths:
            taken[x] += times
    assert taken == counts
    assert sum(times for _, times in found) == bins


def test_fillings_leave_no_room_that_fits():
    left = packing._Lengths({1: 3_000, 5: 10, 700: 1})
    for f in packing.fillings(left, 2_000):
        assert sum(f) == 2_000 and all(n <= left.counts[x] for x, n in Counter(f).items())
