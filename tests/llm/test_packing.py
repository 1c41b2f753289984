import itertools
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leafwork.llm import packing


def brute_bins(items, capacity):
    """The fewest bins by trying all placements."""
    best = len(items)

    def go(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(items):
            best = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + items[k] <= capacity:
                go(k + 1, [*bins[:j], bins[j] + items[k], *bins[j + 1 :]])
        go(k + 1, [*bins, items[k]])

    go(0, [])
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=0, max_size=8))
def test_plan_is_optimal_on_small_inputs(items):
    counts = {x: items.count(x) for x in items}
    plan = packing.plan_bins(counts, 20)
    assert all(sum(b) <= 20 for b, _ in plan)
    used = {}
    for b, times in plan:
        for x in b:
            used[x] = used.get(x, 0) + times
    assert used == counts
    assert sum(t for _, t in plan) == brute_bins(sorted(items, reverse=True), 20)


def test_bound_holds():
    random.seed(3)
    items = [random.randint(1, 2048) for _ in range(3000)]
    counts = {x: items.count(x) for x in set(items)}
    bins = sum(t for _, t in packing.plan_bins(counts))
    assert packing.lower_bound(counts, 2048) <= bins <= packing.lower_bound(counts, 2048) * 1.01 + 1


def test_words_equal_whole_texts():
    t = packing.word_ids(packing.tokenizer_path())
    texts = ["", " ", "It's 2024, déjà-vu!", "A<|endoftext|>b <|startoftext|>", "ÀÉ́ ſß İI ΑΣ Σ", "x\x1cy\x1fz", "a b c\u0085d　e", "don't 'LL we'Ve", "😀 日本語 한국어 ｆｕｌｌ", "a\x00b ﬁ ǅ", "퟿", "Ünï" * 500]
    for text in texts:
        assert t.text(text) == t.whole(text), text


def check(rows):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_documents(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, None), (3, ""), (None, "x"), (1, "one two"), (4, "word " * 5000)], "doc_id long, text string").selectExpr("*", "'clash' as length", "1 as sequence_id", "'y' as piece")
    rows = packing.pack(packing.token_pieces(docs, with_ids=True)).collect()
    check(rows)
    assert [(r.piece, r.start, r.length) for r in sorted(rows, key=lambda r: r.piece) if r.doc_id == 4] == [(0, 0, 2048), (1, 2048, 2048), (2, 4096, 905)]
    assert sum(r.doc_id == 1 for r in rows) == 2
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    assert [r.length for r in rows if r.doc_id in (2, 3)] == [1, 1]
    assert packing.pack(packing.token_pieces(docs.limit(0))).count() == 0


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(k, "some words here " * (k % 7)) for k in range(40)], "doc_id long, text string")
    packed = packing.pack(packing.token_pieces(docs, with_ids=True))
    t = packing.word_ids(packing.tokenizer_path())
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids) == t.text("some words here " * (r.doc_id % 7)) + b"\0\0\0\0"
    assert list(itertools.chain(whole))


def feasible(counts, room):
    """Every multiset of lengths that fits, by brute force."""
    out = [()]
    for x, n in sorted(counts.items(), reverse=True):
        out = [(*f, *[x] * k) for f in out for k in range(n + 1) if sum(f) + k * x <= room]
    return [sorted(f, reverse=True) for f in out if f]


def into(a, b):
    """Whether b's lengths can be dealt to a's, by trying all ways."""
    return any(all(sum(x for x, to in zip(b, way) if to == k) <= a[k] for k in range(len(a))) for way in itertools.product(range(len(a)), repeat=len(b)))


@pytest.mark.parametrize("counts, room", [({9: 1, 8: 1, 5: 2, 4: 2, 3: 3, 2: 3}, 11), ({10: 1, 6: 1, 5: 1, 4: 1, 3: 1, 2: 1, 1: 1}, 9), ({7: 2, 3: 2, 2: 1}, 12), ({5: 1}, 4)])
def test_fillings_are_those_that_nothing_dominates(counts, room):
    every = feasible(counts, room)
    # What nothing else dominates; of fillings that dominate each other (equal ones only) one.
    want = [f for f in every if not any(g != f and into(g, f) for g in every)]
    got = packing.fillings(packing._Lengths(counts), room, 10**6, 10**6)
    assert sorted(got) == sorted(want or [[]])


def test_dominance():
    assert packing.dominates([9, 2], [5, 4, 2]) and packing.dominates([9, 2], [3, 3, 3, 2]) and not packing.dominates([5, 4, 2], [9, 2])
    assert not packing.dominates([6, 3], [5, 4]) and packing.dominates([4], [4])
