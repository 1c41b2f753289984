"""Passages that can't be notices stay away from the classifier, and no notice is lost by that."""

import random

import pytest
from test_licenses import PLAIN, brute

from leafwork.llm import licenses


@pytest.fixture(scope="module")
def model():
    return licenses.Model(PLAIN * 50)


def test_passages_on_both_sides_of_the_bound(spark, model):
    dice = random.Random(5)
    near = [g for g in model.vocabulary if " " in g] + ["the", "day", "of", "and", "is", "x", "é"] * 20
    lines = [" ".join(dice.choices(near, k=dice.randint(1, 60))) for _ in range(300)]
    lines += [" ".join(dice.choices(model.telling + ["the", "of"] * 60, k=dice.randint(1, 12))) for _ in range(300)]
    judged = [model.judge(licenses.tokens(x)[: licenses.PASSAGE])[0] for x in lines]
    assert sum(p < 0.5 for p in judged) > 50 < sum(p >= 0.5 for p in judged)
    found = {r.doc_id: r.licenses for r in licenses.scan(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), model).collect()}
    for k, x in enumerate(lines):
        if abs(judged[k] - 0.5) > 1e-2:  # weights are rounded in the scan
            want = brute(model, x)
            assert {y.license for y in found[k]} == set(want), x
            assert all(abs(y.confidence - want[y.license]) < 1e-2 for y in found[k]), x


def test_ordinary_lines_with_telling_words_do_not_reach_the_classifier(spark):
    dice = random.Random(7)
    plain = [f"word{k}" for k in range(60)] + ["the", "of", "and", "is", "that", "by", "with", "this"]
    model = licenses.Model([" ".join(dice.choices(plain, k=8)) for _ in range(400)])
    lines = [" ".join(dice.choices(plain, k=40)) for _ in range(400)]
    assert sum(bool(set(x.split(" ")) & set(model.telling)) for x in lines) > 300
    docs = spark.createDataFrame([(0, "\n".join(lines)), (1, "Released under the MIT License."), (2, None)], "doc_id long, text string")
    found = {r._row.doc_id: r for r in licenses.reaching(docs, model).collect()}
    assert [(found[k].n_paragraphs, len(found[k]._p)) for k in (1, 2)] == [(1, 1), (0, 0)]
    assert found[0].n_paragraphs == 400
    assert len(found[0]._p) < 100
