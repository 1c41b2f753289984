"""Groups beyond one block: every pair in different components meets, in as few cells as the blocks need."""

from itertools import combinations

from leafwork.llm import jaccard


def test_a_large_group_is_dealt_to_few_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 50)
    rows = [(7, node, 0 if node < 160 else node, 400) for node in range(200)]  # 160 in one component, 40 apart
    cells = {}
    found = jaccard._arranged(spark.createDataFrame(rows, "g long, node long, comp long, n long"), False).collect()
    # Those apart fill one block, the main component four: each is in at most five cells.
    assert len(found) <= 160 + 40 * 5
    for r in found:
        cells.setdefault((r.lo, r.hi), []).append((r.node, r.comp, r.own))
    met = set()
    for (lo, hi), members in cells.items():
        for a, b in combinations(sorted(members), 2):
            if a[1] != b[1] and (lo == hi or a[2] != b[2]):
                met.add((a[0], b[0]))
    assert met == {(a, b) for a, b in combinations(range(200), 2) if b >= 160}
