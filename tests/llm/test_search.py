"""Joins, search, language, suffixes and archives against brute force."""

import base64
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafwork.llm import jaccard, language, suffixes, topk, warc


def text(r, n, vocabulary):
    return " ".join(r.choice(vocabulary) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(11)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    rows = [(k, text(r, r.choice([0, 1, 3, 4, 12, 60, 150]), vocabulary)) for k in range(150)]
    passage = text(r, 60, vocabulary)
    for k in range(150, 220):
        words = rows[r.randrange(150)][1].split()
        for _ in range(r.choice([0, 1, 1, 2, 6])):
            if words:
                words[r.randrange(len(words))] = "edit"
        rows.append((k, " ".join(words)))
    rows += [(k, passage + " " + text(r, 40, vocabulary)) for k in range(220, 250)]
    rows += [(250, None), (251, "  \n"), (252, "A\tB  c D"), (253, "a b C d"), (0, rows[0][1]), (254, text(r, 20_000, vocabulary))]
    return rows


def groups(rows, n, num):
    sets = {}
    for k, t in rows:
        w = (t or "").encode().lower().split()
        sets[k] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    label = {k: k for k in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {k: (len(sets[k]), label[k]) for k in sets}


@pytest.mark.parametrize("n, num", [(4, 85), (5, 80)])
def test_jaccard(spark, corpus, n, num, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    docs = spark.createDataFrame(corpus, "doc_id long, text string").selectExpr("*", "1 as keys", "2 as label")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(docs, n, num).collect()}
    assert got == groups(corpus, n, num)
    kept = jaccard.keep_one(docs, n, num)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted({v[1] for v in got.values()})


def test_jaccard_of_nothing(spark):
    assert jaccard.join(spark.createDataFrame([], "doc_id long, text string"), 4, 85).count() == 0


def test_topk(spark):
    r = np.random.default_rng(4)
    rows = [(k, [float(x) for x in r.normal(0, 0.3, 8)]) for k in range(300)] + [(k, [0.25] * 8) for k in range(300, 340)]
    rows += [(400, None), (420, [float("nan")] * 8), (440, [0.5, None] * 4), (460, [1.0, 2.0]), (480, [2.0, 1.0]), (500, [1e12, 1e12]), (502, [1e12, 1.0]), (504, [1e12, 2.0]), (506, [-1e300, 3.0]), (508, [1e307, 0.0]), (540, [0.0, 2.0**50]), (542, [1.0, 2.0**50]), (544, [0.0, 2.0**50]), (None, [0.1] * 8), (520, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("part", F.lit("clash"))
    q = {k: [int(np.floor(64 * x)) for x in v] for k, v in rows if k is not None and v is not None and all(x is not None and np.isfinite(64 * x) for x in v)}
    want = []
    for a in q:
        if a % 20 == 0:
            near = sorted((-min(2**63 - 1, max(-(2**63), sum(x * y for x, y in zip(q[a], q[b])))), b) for b in q if b != a and len(q[b]) == len(q[a]))[:20]
            want += [(a, n + 1, b, -s) for n, (s, b) in enumerate(near)]
    assert sorted(map(tuple, topk.search(df).collect())) == sorted(want)
    assert topk.search(df.limit(0)).count() == 0


def cover(rows, length):
    seen = {}
    for _, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            seen[b[p : p + length]] = seen.get(b[p : p + length], 0) + 1
    out = []
    for k, t in rows:
        b = (t or "").encode()
        hit = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                hit[p : p + length] = b"\1" * length
        out.append((k, len(b), sum(hit), sum(bool(hit[i]) and (i == 0 or not hit[i - 1]) for i in range(len(b))), bytes(x for x, h in zip(b, hit) if not h)))
    return out


@pytest.mark.parametrize("limit", [200_000, 1])
def test_suffixes(spark, monkeypatch, limit):
    monkeypatch.setattr(suffixes, "GROUP_ROWS", limit)
    r = random.Random(9)
    some = lambda n: "".join(r.choice("abcdé \n") for _ in range(n))
    shared = [some(n) for n in (150, 195, 201, 260, 500)]
    rows = [(k, some(r.randrange(300)) + r.choice(shared) + some(r.randrange(300)) + r.choice(shared)[r.randrange(90) :]) for k in range(60)]
    rows += [(60, "x" * 900), (61, "y" * 200), (62, None), (63, ""), (64, rows[0][1]), (1, rows[1][1]), (65, "ab" * 150), (None, some(400)), (66, "z" * 199)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as uid", "2 as spans")
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.remove(docs).collect()), key=str)
    assert got == sorted(cover(rows, 200), key=str)
    assert suffixes.remove(docs.limit(0)).count() == 0


def test_language(spark):
    r = random.Random(1)
    sounds = {"aa": ["ka", "lo", "mi", "tan"], "bb": ["scht", "ung", "er", "pf"], "cc": ["eau", "oi", "que", "ment"]}
    make = lambda s, n: " ".join("".join(r.choice(sounds[s]) for _ in range(r.randint(1, 4))) for _ in range(n))
    train = [(k, s, make(s, 60)) for k, s in enumerate(list(sounds) * 20)] + [(900, None, "x"), (901, "aa", None)]
    docs = spark.createDataFrame(train, "doc_id long, lang string, text string")
    model = language.fit(docs)
    tests = [(k, make(s, 30), s) for k, s in enumerate(list(sounds) * 10)] + [(100, None, "und"), (101, "123 !?", "und"), (103, "½ ² ³ Ⅷ ①", "und"), (104, "\u0301 \u0301", "und"), (102, make("bb", 30_000), "bb"), (102, make("bb", 10), "bb")]
    asked = spark.createDataFrame([(a, b) for a, b, _ in tests], "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = language.identify(asked, model).collect()
    assert sorted((r.doc_id, r.lang_pred) for r in got) == sorted((a, c) for a, _, c in tests) and all(0 <= r.score <= 1 for r in got)
    none = language.fit(docs.limit(0))
    assert {r.lang_pred for r in language.identify(asked, none).collect()} == {"und"}


def test_languages_of_many_signs(spark):
    r = random.Random(2)
    signs = {s: [chr(0x4E00 + 2 * k + i) for k in range(3000)] for i, s in enumerate(("even", "odd"))}
    make = lambda s, n: "".join(r.choice(signs[s]) for _ in range(n))
    docs = spark.createDataFrame([(k, s, make(s, 2000)) for k, s in enumerate(["even", "odd"] * 10)], "doc_id long, lang string, text string")
    model = language.fit(docs)
    asked = [(k, make(s, 300), s) for k, s in enumerate(["even", "odd"] * 10)]
    got = language.identify(spark.createDataFrame([(a, b) for a, b, _ in asked], "doc_id long, text string"), model).collect()
    assert {(x.doc_id, x.lang_pred) for x in got} == {(a, c) for a, _, c in asked}


def test_training_text_comes_from_everywhere():
    text = " ".join(["front"] * 5_000 + ["back"] * 5_000)
    assert b"front" in language.pieces(text, 2_000) and b"back" in language.pieces(text, 2_000)
    assert language.shares([10, 1_000, 1_000, 5], 215) == [10, 100, 100, 5] and language.shares([3], 9) == [3] and language.shares([], 9) == []


def test_automaton_counts_phrases():
    model = language.Model({"x": b"abcabd"})
    for t in ("abcabd", "abdabc", "zz", "cabz", "a", "dd"):
        want, at = 0, 0
        while at < len(t):
            n = 1
            while at + n <= len(t) and t[at : at + n] in "abcabd":
                n += 1
            at += max(1, n - 1)
            want += 1
        assert model.phrases([t.encode()])[0][0, 0] == want, t


def test_warc_round_trip(spark):
    big = "é<p>" * 60_000
    rows = [(5, "http://a/\r\nb", "<a>"), (2, None, "<a>"), (9, "http://c", None), (3, "u", ""), (7, "v", big), (8, "w", big), (2, "again", "<a>"), (None, "x", "<only>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("chunk", F.lit("clash"))
    files = warc.archive(spark, pages)
    chunks = warc.read_chunks(files, with_data=True)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.payloads(chunks).collect()), key=str)
    first, responses = {"<a>": 2, "": 3, big: 7, "<only>": None}, set()
    want = []
    for p, _, h in rows:
        h = h or ""
        kind = ("response", None) if first[h] == p and h not in responses else ("revisit", first[h])
        responses |= {h} if kind[0] == "response" else set()
        want.append((p, len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(), *kind))
    assert got == sorted(want, key=str)
    parts = chunks.filter("page_id = 7").orderBy("chunk").collect()
    assert len(parts) == 5 and b"".join(bytes(x.data) for x in parts).decode() == big and max(x.size for x in parts) == warc.CHUNK
    assert warc.payloads(warc.read_chunks(warc.archive(spark, pages.limit(0)))).count() == 0


@pytest.mark.parametrize("least", [0, 4])
def test_warc_decides_each_row_by_its_payload(spark, least):
    rows = [(2, "<a>"), (None, "<a>"), (None, "<only>"), (None, "<only>"), (None, "<other>"), (4, "<b>"), (4, "<c>"), (5, "<c>"), (6, "<b>"), (3, "<d1>"), (3, "<d1>"), (7, "<d1>")]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    chunks = warc.read_chunks(warc.archive(spark, pages, least), with_data=True).cache()
    first, responses = {"<a>": 2, "<b>": 4, "<c>": 4, "<d1>": 3}, set()
    want = []
    for p, h in rows:
        # Of rows that repeat page_id and payload one is the response; without any page_id, one of those rows.
        again = len(h) >= least and (first.get(h) != p or h in responses)
        responses |= set() if again else {h}
        want.append((p, len(h), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(), "revisit" if again else "response", first.get(h) if again else None))
    assert sorted(map(tuple, warc.payloads(chunks).collect()), key=str) == sorted(want, key=str)
    records = chunks.collect()
    kept = {r.record_id: bytes(r.data) for r in records if r.record_type == "response"}
    assert len({r.record_id for r in records}) == len(rows) and {h.encode() for _, h in rows} == set(kept.values())
    revisits = [r for r in records if r.record_type == "revisit"]
    assert all(r.refers_to_id in kept for r in revisits) and len(revisits) == sum(w[3] == "revisit" for w in want)
    assert sorted((r.page_id or -1, r.record_type) for r in warc.plan(pages, least).collect()) == sorted((w[0] or -1, w[3]) for w in want)


def test_warc_writes_by_chunks(spark):
    texts = ["x" * 9, "ab" * 4, "", "y", "x" * 9]
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id long, html string")
    rows = warc.to_chunks(pages, chunk=4).collect()
    got = {}
    for r in rows:
        got.setdefault(r.page_id, []).append((r.chunk, bytes(r.data), r.last))
    assert got == {0: [(0, b"xxxx", False), (1, b"xxxx", False), (2, b"x", True)], 1: [(0, b"abab", False), (1, b"abab", True)], 2: [(0, b"", True)], 3: [(0, b"y", True)], 4: [(0, b"", True)]}
    same = spark.range(25_003).selectExpr("if(id < 25001, null, id) as page_id", "'same' as html")
    assert {(r.page_id, r.record_type, r.refers_to): r["count"] for r in warc.plan(same).groupBy("page_id", "record_type", "refers_to").count().collect()} == {(25001, "response", None): 1, (25002, "revisit", 25001): 1, (None, "revisit", 25001): 25_001}


@pytest.mark.parametrize("per_task", [4, 1_000])
def test_components(spark, per_task, monkeypatch):
    monkeypatch.setattr(jaccard, "LINKS_PER_TASK", per_task)
    links = [(i, i + 1) for i in range(9)] + [(20, 25), (21, 25), (30, 31), (30, 31)]
    got = jaccard.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.label for r in got} == {**dict.fromkeys(range(10), 0), 20: 20, 25: 20, 21: 20, 30: 30, 31: 30}
    assert len(got) == 15
    assert jaccard.components(spark.createDataFrame([], "a long, b long")).count() == 0
