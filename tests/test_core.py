"""Operators on small fixtures with known results."""

import json

import pytest
from pyspark.sql import functions as F

from leafwork.functions import canonical, exprs
from leafwork.operators import cross, gates, joins, nested, panel, ranking
from leafwork.sources import readers, writers


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def one(spark, value, kind, f):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("text, number", [("1,234.5", 1234.5), (" 7 ", 7.0), ("1_000", None), ("1d", None), ("inf", None), ("", None), ("-3e2", -300.0), (None, None)])
def test_to_float(spark, text, number):
    assert one(spark, text, "string", exprs.to_float) == number


@pytest.mark.parametrize("text, number", [("1900", 1900.0), ("1900-01-03", 693598.0), ("1900-02", 22802.0), ("x", None)])
def test_time_number(spark, text, number):
    assert one(spark, text, "string", exprs.time_number) == number


@pytest.mark.parametrize("x", [12.0, 1.1, 0.0, 123456.0, 1234567.0, 0.00012345, 0.000012345, -2.5, 100000.0, 999999.5, 1e-7, 3.14159265, 1e20])
def test_fmt_g(spark, x):
    assert one(spark, x, "double", exprs.fmt_g) == f"{x:g}"


@pytest.mark.parametrize("text, page", [("pdfs/volume/1900-1.pdf#page=7", ("volume/1900-1.pdf", 7)), ("/a.pdf#page=1", None), ("a/../b.pdf#page=1", None), ("a.pdf#page=0", None), ("a.pdf#page=01", None), ("a.txt#page=1", None)])
def test_page_id(spark, text, page):
    found = one(spark, text, "string", exprs.page_id)
    assert (found and tuple(found)) == page


def test_ratio_and_wilson(spark):
    df = spark.createDataFrame([(2.0, 4.0), (0.0, 0.0), (0.0, 1.0), (None, 1.0), (-2.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(exprs.sym_ratio(F.col("a"), F.col("b"))).collect()] == [2.0, 1.0, float("inf"), None, 1.0]
    low, high = spark.range(1).select(*exprs.wilson(F.lit(20), F.lit(20))).first()
    assert tuple(spark.range(1).select(*exprs.wilson(F.lit(0), F.lit(0))).first()) == (0.0, 1.0)
    assert round(low, 4) == 0.8389 and abs(high - 1) < 1e-12


def test_decimal_and_ids(spark):
    df = spark.createDataFrame([("1.500",), ("100",), ("0.000",)], "x string")
    assert [r[0] for r in df.select(exprs.decimal_text(F.col("x").cast("decimal(38,18)"))).collect()] == ["1.5", "100", "0"]
    assert spark.range(1).select(exprs.slug(F.lit("The Bank, Ltd."))).first()[0] == "the_bank_ltd"
    assert spark.range(1).select(exprs.file_name(F.lit("https://h/a/b%20c.pdf?x=1"))).first()[0] == "b c.pdf"


def test_canonical_json(spark):
    assert canonical.canonical_text('{"b": 1, "a": [1.0, "é"]}') == '{"a":[1.0,"é"],"b":1}'
    assert [canonical.canonical_text(x) for x in ('{"a":1,"a":2}', '{"a":NaN}', "[1]", None, "{")] == [None] * 5
    df = spark.createDataFrame([('{"b":1,"a":2}',), (None,)], "x string")
    assert [r[0] for r in df.select(canonical.canonical_json("x")).collect()] == ['{"a":2,"b":1}', None]


def test_reversal(spark):
    df = spark.createDataFrame([("c", 1, 1.1), ("c", 2, 12.0), ("c", 3, 1.3), ("d", 1, 5.0)], "e string, t int, v double")
    found = panel.isolated_reversals(df, ["e"], "t", "v", 3.0, 1.5).collect()
    assert [(r.e, r.t, r.before, r.middle, r.after) for r in found] == [("c", 2, 1.1, 12.0, 1.3)]


def test_gap_spine_and_sets(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 1), ("c", 3)], "e string, t int")
    assert rows(panel.panel_gaps(df, ["e"], "t"), "e") == [("a", 1, 3, 2)]
    assert rows(panel.coverage(df, "e", "t"), "t") == [(1, 2), (2, 0), (3, 2)]
    assert rows(panel.entries_exits(df, "e", "t"), "t") == [(3, 1, 1)]
    assert rows(panel.present_absent_present(df, ["e"], "t"), "e") == [("a", 2)]


def test_two_sided(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 2, None), ("a", 3, 10.0), ("b", 1, 10.0), ("b", 2, 100.0), ("b", 3, 10.0), ("c", 1, 10.0), ("c", 2, 20.0), ("c", 3, 10.0)], "e string, t int, v double")
    assert [(r.e, r.kind) for r in panel.two_sided_anomalies(df, ["e"], "t", "v").orderBy("e").collect()] == [("a", "missing_middle"), ("b", "factor_strong"), ("c", "factor_weak")]


def test_mad_zero_and_clusters(spark):
    df = spark.createDataFrame([(f"r{k}", "g", v) for k, v in enumerate([10.0, 10.0, 10.0, 10.0, 100.0])], "id string, g string, v double")
    assert [r.id for r in cross.mad_outliers(df, ["g"], "v", 8.0, 10.0).collect()] == ["r4"]
    flags = spark.createDataFrame([("p", "c2"), ("p", "c1"), ("p", "c3"), ("q", "c4")], "page string, case string")
    assert rows(cross.clusters(flags, "page", "case", 3), "page") == [("p", 3, "c1;c2;c3")]


def test_vintages(spark):
    df = spark.createDataFrame([("k", 10.0), ("k", 11.0), ("m", 5.0), ("m", 5.0), ("n", 1.0), ("o", None), ("o", 2.0)], "k string, v double")
    assert rows(cross.duplicate_keys(df, ["k"], ["v"]), "k") == [("k", 2, "repeated_vintage_disagreement"), ("m", 2, "duplicate_key"), ("o", 2, "repeated_vintage_disagreement")]
    assert [(r.k, r.conflict) for r in cross.vintage_conflicts(df, ["k"], "v").orderBy("k").collect()] == [("k", True), ("m", False), ("n", False), ("o", True)]


def test_as_of_is_strict_backward_and_inclusive_forward(spark):
    gaps = spark.createDataFrame([("s", "b", 1)], "g string, k string, id int")
    anchors = spark.createDataFrame([("s", "a", 10), ("s", "b", 20), ("s", "c", 30)], "g string, k string, page int")
    assert joins.as_of(gaps, anchors, ["g"], "k", ["page"]).first()["prev_page"] == 10
    assert joins.as_of(gaps, anchors, ["g"], "k", ["page"], False).first()["next_page"] == 20


def test_interval_join_by_group_and_by_bucket(spark):
    points = spark.createDataFrame([("a", k) for k in range(20)] + [("c", 4), ("c", 4), ("b", 200)], "g string, p int")
    ranges = spark.createDataFrame([("a", 3, 9, "x"), ("a", 8, 15, "y"), ("a", None, None, "z"), ("b", 0, 99, "w")], "g string, lo int, hi int, n string")
    want = sorted((g, p, n) for g, p in map(tuple, points.collect()) for h, lo, hi, n in map(tuple, ranges.collect()) if g == h and (lo is None or lo <= p <= hi))
    lost = [("b", 200, None), ("c", 4, None), ("c", 4, None)]
    for width in (None, 4):
        for how in ("inner", "left"):
            found = joins.interval_join(points, ranges, ["g"], "p", "lo", "hi", how, width).select("g", "p", "n")
            assert sorted(map(tuple, found.collect()), key=str) == sorted([*want, *(lost if how == "left" else [])], key=str)


def test_overlay(spark):
    df = spark.createDataFrame([("r1", "12", "x"), ("r2", "5", "y")], "id string, amount string, name string")
    changes = spark.createDataFrame([("r1", "amount", "12", "1.2"), ("r2", "amount", "6", "7")], "id string, field string, old string, new string")
    after = joins.overlay(df, changes, "id", ["amount", "name"])
    assert rows(after, "id") == [("r1", "1.2", "x"), ("r2", "5", "y")]
    assert rows(joins.differences(df, after, "id", ["amount", "name"]), "id") == [("r1", "amount", "12", "1.2", "changed")]


def test_gates(spark):
    df = spark.createDataFrame([("1", "", "error", "excluded", "70"), ("2", "k", "ok", "selected", "x")], "id string, k string, status string, final_type string, amount string")
    found = rows(gates.row_flags(df, "id", ["k"], [], {"amount": (0, 50)}).select("record", "check"), "record", "check")
    assert found == [("1", "extraction_failure"), ("1", "invalid_page_selection"), ("1", "missing_key"), ("1", "out_of_bounds"), ("2", "nonnumeric_bounded_value")]
    with pytest.raises(gates.Violation, match="unique"):
        gates.require_empty("unique", gates.not_unique(df.union(df), ["id"]))
    assert gates.not_unique(df, ["id"]).count() == 0
    with pytest.raises(gates.Violation, match="missing"):
        gates.columns(df, ["nope"])


def test_segments(spark):
    ok = spark.createDataFrame([("p", 0, "a", 1), ("p", 0, "b", 2), ("p", 1, "b", 2), ("p", 1, "c", 3)], "page string, seg int, anchor string, v int")
    merged, bad = nested.merge_segments(ok, "page", "seg", "anchor", "v")
    assert rows(merged, "anchor") == [("p", "a", 1), ("p", "b", 2), ("p", "c", 3)] and bad.count() == 0
    off = ok.withColumn("v", F.expr("if(seg = 1 and anchor = 'b', 20, v)"))
    assert [r.conflict for r in nested.merge_segments(off, "page", "seg", "anchor", "v")[1].collect()] == ["overlap_disagreement"]
    far = ok.filter("not (seg = 1 and anchor = 'b')")
    assert [r.conflict for r in nested.merge_segments(far, "page", "seg", "anchor", "v")[1].collect()] == ["no_shared_anchor"]


def test_rank_all_equals_sort(spark):
    df = spark.range(1000).selectExpr("id", "id * 7919 % 1009 as k")
    found = [r.id for r in ranking.rank_all(df, [F.col("k")], "n").orderBy("n").collect()]
    assert found == [r.id for r in df.orderBy("k").collect()]


def test_tsv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("b", 'x "q"\t1', None), ("a", "", "é")], "k string, v string, w string")
    path = str(tmp_path / "t")
    writers.write_tsv(df, path, [F.col("k")], single=True)
    back = readers.read_tsv(spark, path, ["k", "v", "w"])
    assert rows(back, "k") == [("a", "", "é"), ("b", 'x "q"\t1', "")]
    with pytest.raises(gates.Violation, match="header"):
        readers.read_tsv(spark, path, ["k", "w", "v"])


def test_immutable_store_and_receipts(spark, tmp_path):
    store = str(tmp_path / "s")
    df = spark.createDataFrame([("a", "1")], "k string, c string")
    assert [writers.append_immutable(df, store, "k", "c") for _ in range(2)] == [1, 0]
    with pytest.raises(gates.Violation):
        writers.append_immutable(df.withColumn("c", F.lit("2")), store, "k", "c")
    receipt = writers.signed({"a": 1})
    assert writers.verify(receipt) and not writers.verify(receipt | {"a": 2})
    writers.publish(str(tmp_path / "p" / "current.json"), "r1", 0, True)
    assert json.loads((tmp_path / "p" / "current.json").read_text()) == {"run": "r1"}


def test_other_sources(spark, tmp_path):
    page = spark.createDataFrame([(1, '<script>var items = [{"id":"a"},{"id":"b"}];</script>')], "p int, html string")
    assert rows(readers.html_catalog(page, "html", "items", "id string"), "position") == [(1, 1, "a"), (1, 2, "b")]
    xml = spark.createDataFrame([("<m><t>T</t></m>",)], "x string")
    assert readers.xml_fields(xml, "x", {"title": "m/t", "none": "m/u"}).select("title", "none").first() == ("T", "")
    (tmp_path / "tree").mkdir()
    (tmp_path / "tree" / "f.txt").write_text("abc")
    assert readers.tree_summary(readers.read_tree(spark, str(tmp_path / "tree"))).first()["files"] == 1
    r = spark.createDataFrame([("e", 2, 4), ("f", 3, None)], "e string, a int, b int")
    assert [x.page for x in readers.expand_ranges(r, "a", "b").orderBy("page").collect()] == [2, 3, 4]
    (tmp_path / "res").mkdir()
    for k in (1, 2):
        (tmp_path / "res" / f"reservation-{k}.json").write_text(json.dumps({"reservation_id": str(k), "page_ids": ["p1"]}))
    with pytest.raises(gates.Violation, match="reserved twice"):
        readers.reservations(spark, str(tmp_path / "res"))
