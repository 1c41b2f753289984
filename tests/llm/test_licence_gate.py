"""No passage that the model judges a licence notice is kept from it."""

from leafwork.llm import licenses

PLAIN = ["the people of the country went to the hall", "a new day in the world of the software", "die rechte und der tag in dem land", "éauouè le du la mentoi"] * 50
#: Notices without a word of the cover of the training notices.
LEFT_OUT = ["GNU General Public, version 3", "CC BY-NC 4.0", "the Apache 2.0", "Mozilla Public, version 2.0", "All rights"]


def test_notices_without_a_word_of_the_cover_are_judged(spark):
    model = licenses.Model(PLAIN)
    assert all(model.judge(licenses.tokens(t))[0] >= 0.5 for t in LEFT_OUT)
    found = licenses.scan(spark.createDataFrame(list(enumerate(LEFT_OUT)), "doc_id long, text string"), model).collect()
    assert [len(r.licenses) for r in sorted(found, key=lambda r: r.doc_id)] == [1] * len(LEFT_OUT)


def test_without_a_telling_word_nothing_can_be_a_notice():
    model = licenses.Model(PLAIN)
    rest = [g for g in model.vocabulary if not set(g.split(" ")) & set(model.telling)]
    weight = model.regression.weight
    total = weight[-1] + sum((weight[model.regression.at[g]] for g in rest), 0 * weight[-1])
    gains = sum((max(0, (weight[model.regression.at[g]][1:] - weight[model.regression.at[g]][0]).max()) for g in rest), 0.0)
    assert len(rest) and len(total) == len(model.classes) + 1 and gains >= 0
    assert model.judge([x for x in dict.fromkeys(" ".join(rest).split(" ")) if x])[0] < 0.5
