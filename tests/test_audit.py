"""Quality control, corrections, evidence, selection, records and scans on small fixtures."""

import datetime
import itertools
import json
import random
import statistics

import pytest
from pyspark.sql import functions as F

from leafwork.operators import corrections, cross, evidence, gates, qc, records, selection
from leafwork.sources import readers, scans, writers


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# ---------------------------------------------------------------- quality control


@pytest.fixture(scope="module")
def flagged(spark):
    df = spark.createDataFrame([("1", "a", "p1", "s1", "70"), ("2", "", "p1", "s1", "x"), ("3", "c", "p2", "s2", "10"), ("3", "c", "p2", "s2", "11")], "id string, k string, page string, source_sha256 string, amount string")
    s = qc.Settings(record="id", keys=["id"], page="page", entity=["k"], provenance=["k"], bounds={"amount": (0, 50)}, values=["amount"], group=["page"], cluster=1)
    numbers = df.withColumn("amount2", F.expr("try_cast(amount as double)"))
    return numbers, qc.Settings(**{**s.__dict__, "values": ["amount2"]})


def test_flags_and_release(spark, flagged):
    df, s = flagged
    flags = qc.run_checks(df, s)
    got = {(r["check"], r["record"], r["field"]) for r in flags.collect()}
    assert {("out_of_bounds", "1", "amount"), ("nonnumeric_bounded_value", "2", "amount"), ("missing_provenance", "2", "k"), ("repeated_vintage_disagreement", "", ""), ("clustered_value_anomalies", "", "")} == got
    assert flags.select("case_id").distinct().count() == flags.count()
    again = {r.case_id: r.evidence_hash for r in qc.run_checks(df.withColumn("amount", F.expr("if(id = '1', '80', amount)")), s).collect()}
    first = {r.case_id: r.evidence_hash for r in flags.collect()}
    changed = {r.case_id for r in flags.collect() if r["check"] in ("out_of_bounds",)}
    assert set(again) == set(first) and {c for c in first if first[c] != again[c]} == changed
    assert qc.release(flags, s).first()["status"] == "fail"
    settled = flags.select("case_id", "evidence_hash", F.lit("source_verified").alias("disposition"), F.lit("seen").alias("reason"), F.lit("p").alias("evidence_page"), F.lit("").alias("correction_id"))
    done = qc.adjudicate(flags, settled)
    assert qc.release(done, s).first().asDict() == {"status": "pass", "n_blockers": 0, "cases": []}
    stale = qc.adjudicate(flags, settled.withColumn("evidence_hash", F.lit("old")))
    assert {r["check"] for r in stale.collect()} >= {"stale_qc_decision"} and qc.release(stale, s).first()["n_blockers"] == 2 * flags.count()
    for broken, what in ((settled.withColumn("disposition", F.lit("maybe")), "unknown"), (settled.unionByName(settled), "twice"), (settled.withColumn("case_id", F.lit("")), "no case_id")):
        with pytest.raises(gates.Violation, match=what):
            qc.adjudicate(flags, broken)
    reports = qc.report(df, settled, s)
    assert reports["review_queue"].count() == 0 and reports["source_support"].filter("page = 'p1'").first()["source_hashes"] == "s1"
    assert {tuple(r) for r in reports["summary"].filter("measure = 'severity'").collect()} == {("severity", "blocking", flags.count())}


def test_corrected_needs_the_right_correction(spark, flagged):
    df, s = flagged
    flags = qc.run_checks(df, s).filter("check = 'out_of_bounds'")
    f = flags.first()
    decide = lambda cid: spark.createDataFrame([(f.case_id, f.evidence_hash, "corrected", "seen", "p", cid)], "case_id string, evidence_hash string, disposition string, reason string, evidence_page string, correction_id string")
    fixed = spark.createDataFrame([("c1", "1", "amount", "s1", "", "70"), ("c2", "2", "amount", "s1", "", "70"), ("c3", "1", "amount", "s9", "", "71")], "correction_id string, record_id string, field string, source_hash string, contract_signature string, after string")
    found = {cid: qc.adjudicate(flags, decide(cid), fixed).filter("check = 'stale_qc_decision'").collect() for cid in ("c1", "c2", "c3", "c4", "")}
    assert {c: [r.message for r in x] for c, x in found.items()} == {"c1": [], "c2": ["record_id"], "c3": ["source_hash, after"], "c4": ["the correction was not applied"], "": ["a correction is missing"]}


def test_empty_table_and_domain_checks(spark, flagged):
    df, s = flagged
    assert [r["check"] for r in qc.run_checks(df.limit(0), s).collect()] == ["empty_dataset"]
    own = qc.Settings(**{**s.__dict__, "domain_checks": [lambda d: d.filter("id = '1'").select(F.lit("mine").alias("check"), F.lit("advisory").alias("severity"), F.col("id").alias("record"))]})
    assert qc.run_checks(df, own).filter("check = 'mine'").count() == 1
    with pytest.raises(gates.Violation, match="missing"):
        qc.run_checks(df.drop("k"), s)


def test_medians_are_exact(spark):
    r = random.Random(4)
    data = [(g, float(r.choice([1, 1, 1, r.randint(0, 50)]))) for g in "abc" for _ in range({"a": 1, "b": 40, "c": 301}[g])] + [("d", None), (None, 3.0), (None, 5.0)]
    got = {x.g: (x.m, x.n) for x in cross.medians(spark.createDataFrame(data, "g string, v double").repartition(5), ["g"], "v", "m").collect()}
    want = {}
    for g, own in itertools.groupby(sorted(data, key=lambda x: str(x[0])), key=lambda x: x[0]):
        values = [v for _, v in own if v is not None]
        if values:
            want[g] = (statistics.median(values), len(values))
    assert got == want


def test_mad_of_zero(spark):
    df = spark.createDataFrame([("g", 5.0)] * 6 + [("g", 60.0), ("g", 6.0)], "g string, v double")
    assert [r.v for r in cross.mad_outliers(df, ["g"], "v", 3.0, 2.0).collect()] == [60.0]


# ---------------------------------------------------------------- corrections

BASE = [("1", "a", "s1", "c1"), ("2", "b", "s2", "c1")]
FIX = ("k", "1", "name", "a", "z", "s1", "c1")
KIND = "correction_id string, record_id string, field string, old_value string, new_value string, source_hash string, contract_signature string"


def fix(spark, *changes):
    return spark.createDataFrame([dict(zip(("correction_id", "record_id", "field", "old_value", "new_value", "source_hash", "contract_signature"), FIX)) | c for c in changes], KIND)


def test_corrections_apply_or_refuse(spark):
    df = spark.createDataFrame(BASE, "id string, name string, source_sha256 string, contract_signature string")
    done, ledger = corrections.apply_corrections(df, fix(spark, {}), "id")
    assert rows(done, "id")[0][1] == "z" and ledger.first()["before"] == "a"
    assert corrections.ledger_mismatches(ledger, df, done, "id", ["name"]).count() == 0
    for change, why in (({"old_value": "q"}, "old value"), ({"source_hash": "q"}, "source hash"), ({"contract_signature": "q"}, "contract"), ({"field": "id"}, "protected"), ({"field": "nope"}, "missing field"), ({"record_id": "9"}, "missing record")):
        with pytest.raises(gates.Violation, match=why):
            corrections.apply_corrections(df, fix(spark, change), "id")
    with pytest.raises(gates.Violation, match="repeated target"):
        corrections.apply_corrections(df, fix(spark, {}, {"correction_id": "k2"}), "id")
    with pytest.raises(gates.Violation, match="repeated"):
        corrections.apply_corrections(df.union(df), fix(spark, {}), "id")
    same, _ = corrections.apply_corrections(df, fix(spark, {}).limit(0), "id")
    assert rows(same, "id") == BASE


def test_standardize(spark):
    df = spark.createDataFrame([("1", "1,200", "s1", "c1"), ("2", "x", "s2", "c1"), ("3", "", "s3", "c1")], "id string, name string, source_sha256 string, contract_signature string")
    done, _, review = corrections.standardize(df, fix(spark, {"old_value": "1,200", "new_value": "1,300"}), "id", ["name"], ["name"], transform=lambda d: d.withColumn("seen", F.lit(True)))
    assert [r[1] for r in rows(done, "id")] == [1300.0, None, None] and rows(review) == [("2", "name", "x")] and "seen" in done.columns
    with pytest.raises(gates.Violation):
        corrections.standardize(df, fix(spark, {}).limit(0), "id", ["gone"])


def test_reviews(spark):
    pages = spark.createDataFrame([("p", "s", ["a"]), ("q", "s", ["b"])], "page string, source_sha256 string, recs array<string>")
    review = lambda page, status, sha: spark.createDataFrame([(page, status, sha, ["new"])], "page string, status string, source_sha256 string, recs array<string>")
    assert rows(corrections.apply_reviews(pages, review("p", "accepted", "s"), "page", "recs"), "page")[0][2] == ["new"]
    assert rows(corrections.apply_reviews(pages, review("p", "flagged", "s"), "page", "recs"), "page")[0][2] == ["a"]
    for bad, why in ((review("z", "accepted", "s"), "unknown"), (review("p", "accepted", "t"), "stale"), (review("p", "accepted", "s").union(review("p", "accepted", "s")), "twice")):
        with pytest.raises(gates.Violation, match=why):
            corrections.apply_reviews(pages, bad, "page", "recs")


# ---------------------------------------------------------------- evidence and selection


def test_manual_evidence_is_checked(spark):
    ok = [(1900, 1, 1, 1, "cache_error", "hard", None, "n")]
    kind = "year int, edition int, part int, page int, evidence_family string, strength string, affected_records int, note string"
    assert evidence.manual_signals(spark.createDataFrame(ok, kind)).first()["magnitude"] == 1.0
    for bad in ([ok[0], ok[0]], [(*ok[0][:4], "nope", *ok[0][5:])], [(*ok[0][:5], "strong", *ok[0][6:])]):
        with pytest.raises(gates.Violation):
            evidence.manual_signals(spark.createDataFrame(bad, kind))


def test_signals_are_unique_and_on_known_pages(spark):
    pages = spark.createDataFrame([(1900, 1, 1, 1)], "year int, edition int, part int, page int")
    one = evidence.signal(pages.withColumn("n", F.lit(3)), "r", "f", 1, F.lit(2.0), ["n"])
    assert evidence.union_signals([one], pages).first()["signal_id"].startswith("signal:")
    with pytest.raises(gates.Violation, match="repeated"):
        evidence.union_signals([one, one], pages)
    with pytest.raises(gates.Violation, match="unknown"):
        evidence.union_signals([one.withColumn("page", F.lit(9))], pages)


def test_gap_and_capital_contracts(spark):
    gap = spark.createDataFrame([(1900, 1, 1, 1, 1.0, 0.5, True, True, "e")], "year int, edition int, part int, page int, weight double, support double, charter_agrees boolean, transit_agrees boolean, entity string")
    with pytest.raises(gates.Violation, match="support"):
        evidence.gap_signals(gap)
    assert evidence.gap_signals(gap.withColumn("support", F.lit(0.8))).first()["magnitude"] == 5.0
    cap = spark.createDataFrame([(1900, 1, 1, 1, "factor_strong", 9.0, "e")], "year int, edition int, part int, page int, kind string, factor double, entity string")
    with pytest.raises(gates.Violation, match="factor"):
        evidence.capital_signals(cap)


def test_selectors(spark):
    p = spark.createDataFrame([("b", 2), ("a", 1), ("c", 3)], "id string, n int")
    assert [r.id for r in selection.select_pages(p, "id", "n", limit=2).collect()] == ["a", "b"]
    ids = spark.createDataFrame([("c",), ("c",), ("a",)], "id string")
    assert [r.id for r in selection.select_pages(p, "id", "n", ids=ids).collect()] == ["a", "c"]
    for bad in ({}, {"limit": 1, "everything": True}, {"limit": 0}, {"ids": spark.createDataFrame([("z",)], "id string")}):
        with pytest.raises(gates.Violation):
            selection.select_pages(p, "id", "n", **bad)
    selection.require_authorized(p, "id", ["c", "b", "a"])
    with pytest.raises(gates.Violation):
        selection.require_authorized(p, "id", ["a"])
    assert [r.n for r in selection.restored(p.withColumn("o", 10 - F.col("n")), "o").collect()] == [3, 2, 1]


def test_labels_when_the_gate_is_shut_or_the_cap_is_near(spark):
    df = spark.createDataFrame([(1, True, False, True), (2, False, False, True), (3, True, True, True), (4, True, False, False), (5, True, False, True)], "r int, eligible boolean, counted boolean, localized boolean")
    label = lambda *a: [x[0] for x in rows(selection.labelled(df, "r", *a).select("status", "r"), "r")]
    assert label(True, 1, 5) == ["selected", "ineligible", "already_counted", "tier4_only", "cap_exhausted"]
    assert label(True, 5, 1)[-1] == "trial_limit" and label(False, 5, 5)[0] == "calibration_gate_failed" and label(True, 0, 5)[0] == "cap_exhausted"


def test_round_robin_against_brute_force(spark):
    r = random.Random(3)
    data = [(c, f"u{r.randrange(12)}", f"{r.randrange(99):02}") for c in "abcd" for _ in range(8)]
    data = list({(c, u): (c, u, h) for c, u, h in data}.values())
    got = [tuple(x) for x in selection.round_robin(spark.createDataFrame(data, "c string, u string, h string"), list("dacb"), "c", "u", "h", 9).orderBy("place").collect()]
    queues, out = {c: sorted((h, u) for d, u, h in data if d == c) for c in "dacb"}, []
    while len(out) < 9 and any(u not in {x[2] for x in out} for q in queues.values() for _, u in q):
        for c in "dacb":
            left = [u for _, u in queues[c] if u not in {x[2] for x in out}]
            if left and len(out) < 9:
                out.append((len(out) + 1, c, left[0]))
    assert got == out


def test_matched_controls_against_brute_force(spark):
    import hashlib

    r = random.Random(8)
    make = lambda p, n: [(f"{p}{k}", r.choice([1, 2, 3]), r.choice([1, 2]), r.choice([1, 2]), r.randrange(6)) for k in range(n)]
    a, b = make("a", 9), make("b", 40)
    kind = "key string, year int, edition int, part int, records int"
    got = [tuple(x) for x in selection.matched_controls(spark.createDataFrame(a, kind), spark.createDataFrame(b, kind).repartition(4), "key", "key", 7).orderBy("candidate").collect()]
    want, used = [], set()
    for x in sorted(a)[:7]:
        def score(y, x=x):
            level = 4 if x[2] != y[2] else 0 if (x[1], x[3]) == (y[1], y[3]) else 1 if x[1] == y[1] else 2 if x[3] == y[3] else 3
            return level, abs(x[4] - y[4]), abs(x[1] - y[1]), hashlib.sha256(f"control\0{x[0]}\0{y[0]}".encode()).hexdigest(), y[0]
        y = min((y for y in b if y[0] not in used), key=score)
        used.add(y[0])
        want.append((x[0], y[0], selection.LEVELS[score(y)[0]], score(y)[1]))
    assert got == want


# ---------------------------------------------------------------- records and scans


def test_page_records_refuse_stale_overrides(spark):
    inv = spark.createDataFrame([("a", 2, "s", "")], "source string, page_count int, source_sha256 string, final_type string")
    texts = spark.createDataFrame([("a", 1, "hello")], "source string, page int, text string")
    over = lambda page, sha: spark.createDataFrame([("a", page, "excluded", sha)], "source string, page int, decision string, source_sha256 string")
    say = lambda c: F.struct(F.lit("selected").alias("classification"), F.lit(1).alias("score"), F.lit("").alias("reasons"))
    assert rows(records.page_records(inv, texts, over(2, "s"), say).select("page", "final_type", "classification"), "page") == [(1, "unreviewed", "selected"), (2, "excluded", "missing")]
    for bad, why in ((over(2, "t"), "stale"), (over(7, "s"), "unknown"), (over(2, "s").union(over(2, "s")), "twice")):
        with pytest.raises(gates.Violation, match=why):
            records.page_records(inv, texts, bad, say)


def test_requests_and_merges(spark):
    p = spark.createDataFrame([("p", 3)], "page string, n int")
    asked = records.requests(p, "page", "n", "s")
    assert asked.count() == 3 and asked.select("request_hash").distinct().count() == 3
    done, pending = records.split_pending(asked, asked.filter("segment = 0"))
    assert (done.count(), pending.count()) == (1, 2)
    merged = spark.createDataFrame([("p", 1), ("p", 3)], "page string, i int")
    assert rows(records.incomplete_merges(merged, p, "page", "i", "n")) == [("p", 2, 3)]
    assert records.incomplete_merges(spark.createDataFrame([("p", 1), ("p", 2), ("p", 3)], "page string, i int"), p, "page", "i", "n").count() == 0
    assert records.anchor_fields([], [], ["e"], "t", ["d"]) == ["e", "t"] and records.anchor_fields([], [], [], "t", ["d"]) == ["d"]
    assert spark.range(1).select(F.lit(None).cast("int").alias("b"), F.lit("x").alias("a")).select(records.anchor(["b", "a"])).first()[0] == '{"a":"x","b":null}'
    with pytest.raises(gates.Violation):
        records.require_disjoint(["a", "page"], ["page"])


def test_scans(spark, tmp_path):
    sha = "a" * 64
    path = str(tmp_path / "i.tsv")
    (tmp_path / "i.tsv").write_text(f"source_order\tsource_id\tpath\tsource_sha256\tsize_bytes\tpage_count\n0\ta\tx/a.pdf\t{sha}\t10\t3\n")
    assert scans.inventory(spark, path).first().asDict()["page_count"] == 3
    for cell, bad in (("x/a.pdf", "../a.pdf"), (sha, "zz"), ("\t3\n", "\t03\n"), ("\t10\t", "\t0\t")):
        (tmp_path / "bad.tsv").write_text((tmp_path / "i.tsv").read_text().replace(cell, bad))
        with pytest.raises(gates.Violation):
            scans.inventory(spark, str(tmp_path / "bad.tsv"))
    snap = scans.snapshot(spark, path)
    assert scans.snapshot_lines(snap).count() == 2 and len(snap.first().sha256) == 64
    with pytest.raises(gates.Violation, match="large"):
        scans.snapshot(spark, path, 5)
    declared = spark.createDataFrame([("a", sha), ("b", sha)], "path string, sha256 string")
    assert rows(scans.verified(spark.createDataFrame([("a", "x")], "path string, sha256 string"), declared, "path"), "path") == [("a", "hash"), ("b", "missing")]
    good = spark.createDataFrame([("a-1", "https://x", "1", "")], "source_id string, url string, first_page string, last_page string")
    assert scans.source_manifest(good).count() == 1
    for bad in (good.withColumn("url", F.lit("http://x")), good.withColumn("source_id", F.lit("A")), good.withColumn("last_page", F.lit("0")), good.limit(0)):
        with pytest.raises(gates.Violation):
            scans.source_manifest(bad)
    pages = spark.createDataFrame([("1", "a", "1", sha, "selected"), ("0", "a", "2", sha, "selected")], "manifest_index string, source_id string, page string, source_sha256 string, final_type string")
    assert [r.page for r in scans.page_manifest(pages, ["selected"]).collect()] == [2, 1]
    with pytest.raises(gates.Violation):
        scans.page_manifest(pages, ["other"])


def test_signed_queue_and_bundles(spark, tmp_path):
    queue = spark.createDataFrame([(1, "p"), (2, "q")], "selection_rank int, page_id string")
    files = spark.createDataFrame([("in", "h")], "path string, sha256 string")
    receipt = writers.signed({"rows": 2, "inputs": {"in": "h"}})
    assert scans.signed_queue(queue, receipt, files).count() == 2
    for bad in ({**receipt, "rows": 3}, writers.signed({"rows": 1, "inputs": {}}), writers.signed({"rows": 2, "inputs": {"in": "other"}})):
        with pytest.raises(gates.Violation):
            scans.signed_queue(queue, bad, files)
    folder = f"file://{tmp_path}/run"
    told = scans.write_bundle(folder, {"queue": queue, "files": files}, {"run": "r1"})
    assert scans.verify_bundle(spark, folder, told) == [] and json.loads((tmp_path / "run/receipt.json").read_text()) == told
    queue.limit(1).write.mode("overwrite").parquet(f"{folder}/queue")
    assert scans.verify_bundle(spark, folder, {**told, "x": 1}) == ["signature", "queue"]
    ok = {"q": scans.content_receipt(queue)}
    assert "signature" in scans.release_manifest({"q": queue.repartition(3)}, ok, {})
    with pytest.raises(gates.Violation):
        scans.release_manifest({"q": queue.limit(1)}, ok, {})
    scans.write_read_only(queue, f"file://{tmp_path}/ro", [F.col("selection_rank")])
    scans.export_delimited(queue, f"file://{tmp_path}/ex", "q", [F.col("selection_rank")])
    assert spark.read.parquet(f"file://{tmp_path}/ex/q.parquet").count() == 2
    with pytest.raises(gates.Violation):
        writers.write_tsv(queue, f"file://{tmp_path}/x", [], fields=["page_id"])


def test_decisions_and_small_things(spark):
    pages = spark.createDataFrame([("p", "s")], "page_id string, source_sha256 string")
    none = spark.createDataFrame([], "page_id string, source_sha256 string, status string, note string, at int")
    one = {"page_id": "p", "source_sha256": "s", "status": "flagged", "note": "why", "at": 1}
    two = scans.save_decision({**one, "status": "accepted", "note": "", "at": 2}, scans.save_decision(one, none, pages), pages)
    assert scans.latest_decisions(two).first()["status"] == "accepted" and two.count() == 2
    for bad in ({**one, "note": " "}, {**one, "page_id": "z"}, {**one, "source_sha256": "t"}):
        with pytest.raises(gates.Violation):
            scans.save_decision(bad, none, pages)
    assert scans.embedded_bytes(scans.embedded(b"abc")) == b"abc"
    with pytest.raises(gates.Violation):
        scans.embedded_bytes({**scans.embedded(b"abc"), "size": 2})
    assert scans.run_id(datetime.datetime(2024, 1, 2, 3, 4, 5, tzinfo=datetime.timezone.utc)) == "20240102T030405Z" and scans.file_key("a b/c") == "a_b_c"
    assert spark.range(1).select(scans.content_range_total(F.lit("bytes 0-9/100")), scans.content_range_total(F.lit("bytes 0-9/*"))).first()[:] == (100, None)
    assert scans.preview(two, ["status"]) == {"rows": 2, "status": {"accepted": 1, "flagged": 1}} and "signature" in scans.contract({"prompt": "x"})
    plan = scans.staging_plan(spark.createDataFrame([("k", "h")], "key string, sha256 string"), spark.createDataFrame([("k", 1, "r1/k", "h"), ("k", 0, "r0/k", "x")], "key string, rank int, path string, sha256 string"), "/t")
    assert plan.first().asDict() == {"key": "k", "sha256": "h", "path": "r1/k", "target": "/t/k"}


def test_catalogs_of_three_shapes(spark):
    items = '[{"id":"a","n":1},{"id":"b","n":2}]'
    shapes = [items, '{"total":2,"items":' + items + "}", '{"a":{"id":"a","n":1},"b":{"id":"b","n":2}}']
    pages = spark.createDataFrame([(k, f"<script>var cat = {x};</script>") for k, x in enumerate(shapes)], "page int, html string")
    found = readers.html_catalog(pages, "html", "cat", "id string, n int")
    assert rows(found, "page", "position") == [(k, p, i, p) for k in range(3) for p, i in ((1, "a"), (2, "b"))]
    with pytest.raises(gates.Violation):
        readers.html_catalog(spark.createDataFrame([(1, 'cat = [{"id":"a"},{"id":"a"}];')], "page int, html string"), "html", "cat", "id string, n int")


def test_log_and_jsonl(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"id":"a","n":1}\n\n{"id":"a","n":2}\n')
    log = readers.read_jsonl(spark, str(tmp_path / "log.jsonl"), "id string, n int")
    assert readers.last_by_key(log, "id", "n").first()["n"] == 2
    writers.write_jsonl(log, f"file://{tmp_path}/out", [F.col("n")])
    assert [json.loads(x) for f in sorted((tmp_path / "out").glob("part-*")) for x in f.read_text().split("\n") if x] == [{"id": "a", "n": 1}, {"id": "a", "n": 2}]
    (tmp_path / "bad.jsonl").write_text("[1]\nnope\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        readers.read_jsonl(spark, str(tmp_path / "bad.jsonl"), "id string, n int").collect()


def test_audit_of_a_cache(spark):
    sources = spark.createDataFrame([("a", None, False, "x", "x")], "source string, error string, manual boolean, found_sha256 string, expected_sha256 string")
    mapping = spark.createDataFrame([("g", 1, "g-1")], "group string, page int, page_id string")
    art = lambda *rows: records.mapped_artifacts(spark.createDataFrame(list(rows), "group string, page int, file string, body string"), mapping)
    tree = spark.createDataFrame([("s1",)], "signature string")
    none = tree.limit(0)
    ok = records.audit(records.acquired(sources), art(("g", 1, "f", "{}")), tree, tree, none, 1).first().asDict()
    assert all(ok.values()) and len(ok) == 8
    bad = records.audit(records.acquired(sources.withColumn("found_sha256", F.lit("y"))), art(("g", 1, "f", "{}"), ("g", 1, "f2", "oops"), ("g", 2, "f3", "{}")), tree, tree.withColumn("signature", F.lit("s2")), tree, 1).first().asDict()
    assert not any(v for k, v in bad.items() if k != "pages_complete")


def test_limits(spark):
    from leafwork.functions import exprs

    assert [r[0] for r in spark.createDataFrame([(106948,), (19,), (0,)], "n long").select(exprs.cap(F.col("n"), 0.05, 5000)).collect()] == [5000, 0, 0]
    assert spark.range(1).select(exprs.cap(F.lit(106948), 0.05, 10**6)).first()[0] == 5347
    gates.enforce(10, 2, 10, 4, {"requests": 3, "failed": 0}, 1.0)
    for bad in ((11, 2, 10, 4, None, 1.0), (1, 5, 10, 4, None, 1.0), (1, 1, 10, 4, {"requests": 3, "failed": 1}, 1.0), (1, 1, 10, 4, None, None), (1, 1, 10, 4, None, 30.0)):
        with pytest.raises(gates.Violation):
            gates.enforce(*bad)
