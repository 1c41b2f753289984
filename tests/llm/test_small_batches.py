"""Workers that read texts hold few bytes of them at once, and remember a bounded number of words."""

import pandas as pd

from leafwork.llm import common, jaccard, packing

BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_a_worker_remembers_a_bounded_number_of_words(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 100)
    t = packing._WordIds(packing.tokenizer_path())
    letters = "abcdefghij"
    words = [a + b + c + d for a in letters for b in letters for c in letters for d in letters[:3]]
    text = " ".join(words + words[::-1] + ["the!", "Thé,", "x\x7fy", "a\x01b"] * 3)
    assert t.text(text) == t.whole(text)
    sizes = [len(x) for cache in (t.words, t.pieces) for x in (cache, cache.older, cache.once)]
    assert max(sizes) <= 100 and sum(sizes) > 100
    t.forget()
    assert not any(len(x) for cache in (t.words, t.pieces) for x in (cache, cache.older, cache.once))


def test_a_word_that_comes_again_stays():
    asked = []
    recent = packing._Recent(lambda k: asked.append(k) or k.encode(), 3)
    assert [recent[k] for k in "aabcdefaghia"] == [k.encode() for k in "aabcdefaghia"]
    assert asked.count("a") == 1 and len(asked) == 9


def test_batches_are_bounded_by_bytes_and_the_session_is_as_before(spark):
    docs = spark.range(24).coalesce(1).selectExpr("id", "repeat('x', 1000000) as text")
    sizes = docs.mapInPandas(lambda batches: (pd.DataFrame({"n": [int(b.text.str.len().sum())]}) for b in batches), "n long")
    before = spark.conf.get(BYTES, None)
    with common.small_batches(spark):
        found = [r.n for r in sizes.collect()]
    assert sum(found) == 24_000_000 and max(found) <= common.BATCH_BYTES + 1_000_000
    assert spark.conf.get(BYTES, None) == before


def test_what_reads_texts_runs_in_small_batches(spark, monkeypatch):
    seen = {}
    for module in (packing, jaccard):
        plain = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, name, plain=plain: (seen.setdefault(name, spark.conf.get(BYTES, None)), plain(df, name))[1])
    docs = spark.createDataFrame([(k, "one two three four five six seven eight nine " * 3 + "x" * (k % 2)) for k in range(8)], "doc_id long, text string")
    assert jaccard.keep_one(docs).count() == 1
    assert packing.pack(packing.token_pieces(docs)).count() == 8
    assert {seen[k] for k in ("pieces", "keys", "sets")} == {str(common.BATCH_BYTES)}
