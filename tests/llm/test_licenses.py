"""Licence scans: known, unknown and ordinary lines, and the native scores against the model in plain Python."""

import pytest

from leafwork.llm import licenses

PLAIN = ["the people of the country went to the hall", "a new day in the world of the software", "die rechte und der tag in dem land", "éauouè le du la mentoi"]


def test_every_query_number_is_registered():
    from leafwork.llm.registry import QUERIES

    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 11))


@pytest.fixture(scope="module")
def model():
    return licenses.Model(PLAIN * 50)


KNOWN = {
    "Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "All rights reserved.": "all-rights-reserved", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell": "MIT",
    " ".join(["the people went to the hall"] * 300) + " released under the mit license. " + " ".join(["a new day"] * 300): "MIT", "Licensed under the Foo Public License, version 7.": "unknown",
    "Licensed under the Bar Software Licence.": "unknown", "Released under the terms of the GNU GPL.": "unknown",
}
ORDINARY = ["His driver's license was suspended for a year.", "the people of the country", "", "  ", "é", "The people have the right to a license in the country."]


def brute(model, line):
    """The licences of a line, by the model in plain Python."""
    words = licenses.tokens(line)
    found = {}
    for i in range(max(0, -(-(len(words) - licenses.PASSAGE) // licenses.STEP)) + 1):
        passage = words[i * licenses.STEP : i * licenses.STEP + licenses.PASSAGE]
        if not any(t in " ".join(passage) for t in model.telling):
            continue
        p, q, best = model.judge(passage)
        if p < 0.5:
            continue
        own = set(licenses.pairs(passage))
        notices = [set(licenses.pairs(licenses.tokens(t))) for t in model.templates[best]]
        named = any(t <= own for t in notices) or q >= 0.5 and any(len(t & own) >= licenses.CONFIRMED * min(len(t), len(own)) for t in notices)
        name = best if named else "unknown"
        found[name] = max(p, found.get(name, 0))
    if len(found) > 1:
        found.pop("unknown", None)
    return found


def test_licences(spark, model):
    rows = [(k, "first line\r\n\n" + t + "\nlast line") for k, t in enumerate(KNOWN)] + [(100 + k, t) for k, t in enumerate(ORDINARY)] + [(200, None), (None, "x\nAll rights reserved."), (0, "All rights reserved.\nAll rights reserved.")]
    rows.append((300, "Released under the MIT License. " + "and more words of the day " * 30 + " Licensed under the Apache License, Version 2.0."))
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as licenses", "2 as _lines", "3 as _row")
    out = licenses.scan(docs, model)
    assert out.columns == ["doc_id", "text", "_lines", "_row", "n_paragraphs", "licenses"]
    got = out.collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in got) == sorted((a or -1, b or "") for a, b in rows)
    for r in got:
        text = r.text or ""
        assert (r._lines, r._row) == (2, 3)
        lines = text.split("\n")
        assert r.n_paragraphs == sum(1 for x in lines if licenses.tokens(x))
        want = {(k, c): p for k, x in enumerate(lines) for c, p in brute(model, x).items()}
        assert [(x.paragraph, x.license) for x in r.licenses] == sorted(want), text[:80]
        assert all(abs(x.confidence - want[x.paragraph, x.license]) < 1e-2 for x in r.licenses)
        if text.startswith("first line"):
            assert [(x.paragraph, x.license) for x in r.licenses] == [(2, KNOWN[lines[2]])], lines[2][:80]
        elif r.doc_id == 300:
            assert {x.license for x in r.licenses} == {"MIT", "Apache-2.0"}
        elif "reserved" in text:
            assert [(x.paragraph, x.license) for x in r.licenses] == [(k, "all-rights-reserved") for k, x in enumerate(lines) if "reserved" in x]
        else:
            assert r.licenses == [], text
    exact = next(r for r in got if "MIT License" in (r.text or "") and r.doc_id == 0)
    assert exact.licenses[0].similarity == 1.0 and exact.licenses[0].family == "MIT"


def test_licences_that_the_model_never_saw_are_unknown():
    templates = {c: t for c, t in licenses.TEMPLATES.items() if licenses.family(c) != "MPL"}
    model = licenses.Model(PLAIN * 50, templates)
    assert all(brute(model, t) == {} or set(brute(model, t)) == {"unknown"} for t in licenses.TEMPLATES["MPL-2.0"][:10])


def test_every_notice_is_found(model):
    right = [(c, brute(model, t)) for c, texts in licenses.TEMPLATES.items() for t in texts]
    assert all(found for _, found in right)
    assert sum(c in found for c, found in right) >= 0.97 * len(right)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.scan(none).count() == 0
