"""Secrets that stand in one run with what a pattern finds."""

import random
import string

from leafwork.llm import secrets


def test_the_rest_of_a_run_is_judged(spark):
    r = random.Random(9)
    some = lambda n, of=string.ascii_letters + string.digits: "".join(r.choice(of) for _ in range(n))
    rows = [(k, f"the understanding of this situation is nothing unusual here for handle incoming request session token = {some(40)}") for k in range(200)]
    ratios = secrets.train(spark.createDataFrame(rows, "doc_id long, text string"))
    access, hexed, a, b, c = "AKIA" + some(16, string.ascii_uppercase), some(32, "0123456789abcdef"), some(40), some(40) + "Z", some(40)
    texts = [f"é {access}/{a} end", f"{b}-{hexed}", f"{b}-{hexed}-{a}/{access}/{c}", f"{access}/short", f"{a} {b}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {x.doc_id: x for x in secrets.judged(secrets.pattern_spans(docs), ratios).collect()}
    wanted = [["/" + a], [b + "-"], [b + "-", f"-{a}/", "/" + c], [], [a, b]]
    for k, want in enumerate(wanted):
        spans = sorted(found[k]["_markov"], key=lambda s: s.start)
        assert [s.value for s in spans] == want
        assert all(texts[k][s.start : s.end] == s.value for s in spans)
        assert [s.value for s in found[k]["_access"]] == [access] * (access in texts[k]) and [s.value for s in found[k]["_hex"]] == [hexed] * (hexed in texts[k])
