"""Queries over the test tables, one or more for each family of operators, with the DuckDB SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leafwork.functions import exprs
from leafwork.operators import cross, gates, joins, nested, panel, ranking

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(c: str):
    return F.col(c).cast("decimal(18,2)")


def nation_months(spark, sf) -> DataFrame:
    o, c, n = t(spark, sf, "orders"), t(spark, sf, "customer"), t(spark, sf, "nation")
    rows = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return rows.groupBy("n_name", (12 * F.year("o_orderdate") + F.month("o_orderdate")).alias("t")).agg(F.sum(money("o_totalprice")).cast("double").alias("v"))


_MONTHS = "p as (select n_name, 12 * year(o_orderdate) + month(o_orderdate) as t, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as v from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by all)"


def customer_quarters(spark, sf) -> DataFrame:
    o = t(spark, sf, "orders")
    return o.groupBy("o_custkey", (4 * F.year("o_orderdate") + F.quarter("o_orderdate")).alias("t")).agg(F.count("*").alias("n"))


_QUARTERS = "q as (select o_custkey, 4 * year(o_orderdate) + quarter(o_orderdate) as t, count(*) as n from orders group by all)"
_RATIO = "case when {0} = {1} then 1.0 when least(abs({0}), abs({1})) = 0 then 'infinity'::double else greatest(abs({0}), abs({1})) / least(abs({0}), abs({1})) end"


@query(f"""with {_MONTHS}, w as (select *, lag(t) over x as t0, lead(t) over x as t2, lag(v) over x as before, lead(v) over x as after from p window x as (partition by n_name order by t))
select n_name, t, before, v as middle, after, round({_RATIO.format('v', '((before + after) / 2)')}, 6) as ratio from w
where t - t0 = 1 and t2 - t = 1 and {_RATIO.format('before', 'after')} <= 1.5 and {_RATIO.format('v', '((before + after) / 2)')} >= 2""")
def isolated_reversal(spark, sf):
    return panel.isolated_reversals(nation_months(spark, sf), ["n_name"], "t", "v", 2.0, 1.5).withColumn("ratio", F.round("ratio", 6))


@query(f"""with {_MONTHS}, w as (select *, lag(v) over (partition by n_name order by t) as before from p)
select n_name, t, before, v as after, round({_RATIO.format('before', 'v')}, 6) as ratio from w where before is not null and {_RATIO.format('before', 'v')} >= 5""")
def one_sided_jump(spark, sf):
    return panel.one_sided_jumps(nation_months(spark, sf), ["n_name"], "t", "v", 5.0).withColumn("ratio", F.round("ratio", 6))


@query(f"""with {_QUARTERS}, w as (select o_custkey, lag(t) over (partition by o_custkey order by t) as gap_from, t as gap_to from q)
select *, gap_to - gap_from as gap from w where gap_to - gap_from > 1""")
def panel_gap(spark, sf):
    return panel.panel_gaps(customer_quarters(spark, sf), ["o_custkey"], "t")


@query(f"""with {_MONTHS}, w as (select n_name, t, median(v) over (partition by n_name order by t rows between 3 preceding and 1 preceding) as before,
median(v) over (partition by n_name order by t rows between current row and 2 following) as after,
count(v) over y as n, min(t) over y as lo, max(t) over y as hi from p window y as (partition by n_name order by t rows between 3 preceding and 2 following))
select n_name, t, before, after, round({_RATIO.format('before', 'after')}, 6) as ratio from w where n = 6 and hi - lo = 5 and {_RATIO.format('before', 'after')} >= 2""")
def persistent_shift(spark, sf):
    return panel.persistent_shifts(nation_months(spark, sf), ["n_name"], "t", "v", 3, 2.0).withColumn("ratio", F.round("ratio", 6))


@query("""with d as (select user_id, cast(floor(epoch(ts) / 3600) as bigint) as t from events where event_type = 'error'),
s as (select unnest(range((select min(t) from d), (select max(t) from d) + 1)) as t)
select s.t, count(distinct user_id) as n_entities from s left join d on s.t = d.t group by s.t""")
def coverage_spine(spark, sf):
    e = t(spark, sf, "events").filter("event_type = 'error'").select("user_id", F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600).alias("t"))
    return panel.coverage(e, "user_id", "t")


@query("""with d as (select user_id, cast(floor(epoch(ts) / 3600) as bigint) as t from events where event_type = 'error'),
s as (select unnest(range((select min(t) from d), (select max(t) from d) + 1)) as t)
select t from s where not exists (select 1 from d where d.t = s.t)""")
def zero_coverage(spark, sf):
    return coverage_spine(spark, sf).filter("n_entities = 0").select("t")


@query(f"""with {_QUARTERS}, c as (select t, count(distinct o_custkey) as n_entities from q group by t), w as (select *, lag(n_entities) over (order by t) as n_before from c)
select *, round(least(n_entities, n_before) / greatest(n_entities, n_before), 6) as ratio from w where least(n_entities, n_before) / greatest(n_entities, n_before) < 0.99""")
def coverage_change(spark, sf):
    return panel.coverage_changes(customer_quarters(spark, sf), "o_custkey", "t", 0.99).withColumn("ratio", F.round("ratio", 6))


@query(f"""with {_QUARTERS}, o as (select t, lag(t) over (order by t) as t0 from (select distinct t from q))
select o.t, (select count(*) from q where q.t = o.t and not exists (select 1 from q b where b.o_custkey = q.o_custkey and b.t = o.t0)) as n_entries,
(select count(*) from q where q.t = o.t0 and not exists (select 1 from q b where b.o_custkey = q.o_custkey and b.t = o.t)) as n_exits from o where t0 is not null""")
def entries_exits(spark, sf):
    return panel.entries_exits(customer_quarters(spark, sf), "o_custkey", "t")


@query(f"""with {_QUARTERS} select a.o_custkey, a.t + 1 as t from q a join q b on a.o_custkey = b.o_custkey and b.t = a.t + 2
where not exists (select 1 from q c where c.o_custkey = a.o_custkey and c.t = a.t + 1)""")
def present_absent_present(spark, sf):
    return panel.present_absent_present(customer_quarters(spark, sf), ["o_custkey"], "t")


@query(f"""with {_QUARTERS}, s as (select c_nationkey, t, count(*) as support from q join customer on o_custkey = c_custkey group by all)
select a.c_nationkey, a.t, a.support, b.support as support_before, c.support as support_after, round(2.0 * a.support / nullif(b.support + c.support, 0), 6) as ratio
from s a left join s b on a.c_nationkey = b.c_nationkey and b.t = a.t - 1 left join s c on a.c_nationkey = c.c_nationkey and c.t = a.t + 1""")
def support_ratio(spark, sf):
    s = customer_quarters(spark, sf).join(t(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey", "t").agg(F.count("*").alias("support"))
    w = Window.partitionBy("c_nationkey").orderBy("t")
    at = lambda f, d: F.when(f("t").over(w) == F.col("t") + d, f("support").over(w))
    rows = s.select("c_nationkey", "t", "support", at(F.lag, -1).alias("support_before"), at(F.lead, 1).alias("support_after"))
    return rows.withColumn("ratio", F.round(2.0 * F.col("support") / F.nullif(F.col("support_before") + F.col("support_after"), F.lit(0)), 6))


def _errors_and_clicks(spark, sf):
    e = t(spark, sf, "events")
    return e.filter("event_type = 'error'").select("user_id", "ts", "event_id"), e.filter("event_type = 'click'").select("user_id", "ts", F.col("event_id").alias("click_id"))


@query("""select user_id, ts, event_id, (select max(struct_pack(ts := c.ts, id := c.event_id)).id from events c where c.user_id = e.user_id and c.event_type = 'click' and c.ts < e.ts) as prev_click_id
from events e where event_type = 'error'""")
def asof_prev(spark, sf):
    a, b = _errors_and_clicks(spark, sf)
    return joins.as_of(a, b, ["user_id"], "ts", ["click_id"], True, ["click_id"])


@query("""select user_id, ts, event_id, (select min(struct_pack(ts := c.ts, id := c.event_id)).id from events c where c.user_id = e.user_id and c.event_type = 'click' and c.ts >= e.ts) as next_click_id
from events e where event_type = 'error'""")
def asof_next(spark, sf):
    a, b = _errors_and_clicks(spark, sf)
    return joins.as_of(a, b, ["user_id"], "ts", ["click_id"], False, ["click_id"])


_RANGES = [("click", 7, 9), ("view", 0, 3), ("view", 2, 5), ("error", None, None)]


@query("""with r(kind, lo, hi) as (values ('click', 7, 9), ('view', 0, 3), ('view', 2, 5), ('error', null, null))
select event_id, hour(ts) as h, event_type, lo, hi from events join r on event_type = kind and (lo is null or hour(ts) between lo and hi)""")
def interval_join(spark, sf):
    e = t(spark, sf, "events").select("event_id", F.hour("ts").alias("h"), "event_type")
    r = spark.createDataFrame(_RANGES, "event_type string, lo int, hi int")
    return joins.interval_join(e, r, ["event_type"], "h", "lo", "hi").withColumnsRenamed({"_start": "lo", "_end": "hi"})


@query("""with c as (select event_type, cast(floor(epoch(ts) / 3600) as bigint) as h, count(*) as n from events group by all),
w as (select *, lag(h) over x as h0, lead(h) over x as h2, lag(n) over x as c0, lead(n) over x as c2 from c window x as (partition by event_type order by h))
select event_type, h, n, least(c0, c2) as neighbors, round(least(c0, c2) / greatest(n, 1), 6) as magnitude from w where h - h0 = 1 and h2 - h = 1 and least(c0, c2) >= 4 and n <= 0.5 * least(c0, c2)""")
def density_collapse(spark, sf):
    c = t(spark, sf, "events").groupBy("event_type", F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600).alias("h")).agg(F.count("*").alias("n"))
    return panel.density_collapses(c, ["event_type"], "h", "n", 4, 0.5).withColumn("magnitude", F.round("magnitude", 6))


@query("""with v as (select c_custkey, c_mktsegment, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as v from orders join customer on o_custkey = c_custkey group by all),
m as (select c_mktsegment, median(v) as med from v group by 1), d as (select v.*, med, abs(v - med) as dev from v join m using (c_mktsegment)),
a as (select c_mktsegment, median(dev) as mad from d group by 1)
select c_custkey, c_mktsegment, v, round(0.67448975 * dev / mad, 6) as z from d join a using (c_mktsegment) where 0.67448975 * dev / mad >= 2.5""")
def mad_outliers(spark, sf):
    v = t(spark, sf, "orders").join(t(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_custkey", "c_mktsegment").agg(F.sum(money("o_totalprice")).cast("double").alias("v"))
    return cross.mad_outliers(v, ["c_mktsegment"], "v", 2.5, 10).select("c_custkey", "c_mktsegment", "v", F.round("z", 6).alias("z"))


@query("select p_brand, count(*) as n, round(avg(case when p_size % 10 = 0 then 1.0 else 0.0 end), 6) as share from part group by 1 having count(*) >= 20 and avg(case when p_size % 10 = 0 then 1.0 else 0.0 end) >= 0.1")
def heaping(spark, sf):
    return cross.heaping(t(spark, sf, "part").withColumn("p_size", F.col("p_size").cast("double")), ["p_brand"], "p_size", 10, 0.1, 20).withColumn("share", F.round("share", 6))


@query("select l_orderkey, l_linenumber, count(*) as n, case when count(distinct struct_pack(a := l_partkey, b := l_suppkey, c := l_quantity)) = 1 then 'duplicate_key' else 'repeated_vintage_disagreement' end as check from lineitem group by 1, 2 having count(*) > 1")
def vintage_disagreement(spark, sf):
    return cross.duplicate_keys(t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_quantity"])


@query("select sha256(text) as digest, count(*) as n, min(doc_id) as first_doc from documents where text is not null group by 1 having count(*) > 1")
def duplicate_docs(spark, sf):
    return t(spark, sf, "documents").filter("text is not null").groupBy(F.sha2("text", 256).alias("digest")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).filter("n > 1")


@query("""with g as (select l_orderkey, l_linenumber, count(*) as n, count(l_quantity) as n_valued, min(l_quantity) as lo, max(l_quantity) as hi from lineitem group by 1, 2),
k as (select l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate, l_partkey, l_suppkey, l_extendedprice) as r from lineitem)
select k.l_orderkey, k.l_linenumber, l_shipdate, l_partkey, n, lo, hi, coalesce(lo <> hi, false) or (n_valued >= 1 and n_valued < n) as conflict from k join g using (l_orderkey, l_linenumber) where r = 1""")
def reconcile_vintages(spark, sf):
    li = t(spark, sf, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    first = cross.keep_first(li, keys, [F.col(c) for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")])
    return first.select(*keys, "l_shipdate", "l_partkey").join(cross.vintage_conflicts(li, keys, "l_quantity").drop("n_valued"), keys)


@query("""with s as (select l_orderkey, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as parts from lineitem group by 1)
select o_orderkey, o_totalprice, parts, round(abs(parts - o_totalprice) / o_totalprice, 6) as error_share from orders join s on o_orderkey = l_orderkey where o_totalprice > 0 and abs(parts - o_totalprice) / o_totalprice > 0.01""")
def accounting_mismatch(spark, sf):
    s = t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sum(money("l_extendedprice")).cast("double").alias("parts"))
    rows = t(spark, sf, "orders").join(s, F.col("o_orderkey") == F.col("l_orderkey"))
    return cross.accounting(rows, F.col("parts"), F.col("o_totalprice"), 0.01).select("o_orderkey", "o_totalprice", "parts", F.round("error_share", 6).alias("error_share"))


@query("""with l as (select lang, quality from labels join documents using (doc_id)), c as (select lang, count(*) filter (quality = 1) as confirmed, count(*) filter (quality = 0) as rejected from l group by 1),
w as (select *, confirmed + rejected as n, confirmed / (confirmed + rejected) as p from c)
select lang, confirmed, rejected, round(p, 9) as precision,
round((p + 1.96*1.96/(2*n) - 1.96*sqrt(p*(1-p)/n + 1.96*1.96/(4*n*n))) / (1 + 1.96*1.96/n), 9) as low,
round(least(1.0, (p + 1.96*1.96/(2*n) + 1.96*sqrt(p*(1-p)/n + 1.96*1.96/(4*n*n))) / (1 + 1.96*1.96/n)), 9) as high,
n >= 20 and p >= 0.7 and (p + 1.96*1.96/(2*n) - 1.96*sqrt(p*(1-p)/n + 1.96*1.96/(4*n*n))) / (1 + 1.96*1.96/n) >= 0.5 as gate from w""")
def wilson_by_lang(spark, sf):
    rows = t(spark, sf, "labels").join(t(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    return ranking.calibration(rows, "lang", "quality", 20, 0.7, 0.5).select("lang", "confirmed", "rejected", *[F.round(c, 9).alias(c) for c in ("precision", "low", "high")], "gate")


def signals(spark, sf) -> DataFrame:
    """Evidence over customers from three checks."""
    quarters = customer_quarters(spark, sf)
    gaps = panel.panel_gaps(quarters, ["o_custkey"], "t").select(F.col("o_custkey").alias("unit"), F.lit("panel_gap").alias("rule"), F.lit("panel").alias("family"), F.lit(3).alias("tier"), F.col("gap_from").cast("string").alias("entity"), F.col("gap").cast("double").alias("magnitude"), F.lit(True).alias("localized"))
    jumps = panel.one_sided_jumps(quarters, ["o_custkey"], "t", "n", 3.0).select(F.col("o_custkey").alias("unit"), F.lit("jump").alias("rule"), F.lit("value").alias("family"), F.lit(2).alias("tier"), F.col("t").cast("string").alias("entity"), F.round("ratio", 6).alias("magnitude"), F.lit(True).alias("localized"))
    broke = t(spark, sf, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("unit"), F.lit("negative_balance").alias("rule"), F.lit("value").alias("family"), F.lit(4).alias("tier"), F.lit("").alias("entity"), F.lit(None).cast("double").alias("magnitude"), F.lit(False).alias("localized"))
    return gaps.unionByName(jumps).unionByName(broke)


_SIGNALS = f"""{_QUARTERS}, w as (select *, lag(t) over x as t0, lag(n) over x as n0 from q window x as (partition by o_custkey order by t)),
s as (select o_custkey as unit, 'panel_gap' as rule, 'panel' as family, 3 as tier, cast(t0 as varchar) as entity, cast(t - t0 as double) as magnitude, true as localized from w where t - t0 > 1
union all select o_custkey, 'jump', 'value', 2, cast(t as varchar), round({_RATIO.format('n0', 'n')}, 6), true from w where n0 is not null and {_RATIO.format('n0', 'n')} >= 3
union all select c_custkey, 'negative_balance', 'value', 4, '', null, false from customer where c_acctbal < 0),
g as (select *, case when localized and tier <= 3 then 1 when localized then 2 else 3 end as grade from s),
b as (select *, min(grade) over (partition by unit) as best, count(*) over (partition by unit) as n_signals from g),
r as (select unit, any_value(n_signals) as n_signals, count(distinct rule) as rules, count(distinct family) as families, count(distinct entity) as entities, min(tier) as tier, max(magnitude) as magnitude from b where grade <= best group by unit),
k as (select *, row_number() over (order by tier, families desc, rules desc, entities desc, magnitude desc nulls last, unit) as page_rank from r)"""


@query(f"with {_SIGNALS} select * from k")
def priority_rank(spark, sf):
    return ranking.priority(ranking.rollup(signals(spark, sf), "unit"), "unit")


@query(f"with {_SIGNALS}, c as (select *, tier <= 3 and unit % 7 <> 0 as q, sum(case when tier <= 3 and unit % 7 <> 0 then 1 else 0 end) over (order by page_rank) as run from k) select unit, page_rank, q and run <= 100 as selected from c")
def capped_selection(spark, sf):
    return ranking.capped(priority_rank(spark, sf), "page_rank", (F.col("tier") <= 3) & (F.col("unit") % 7 != 0), 100).select("unit", "page_rank", "selected")


@query(f"with {_SIGNALS} select unit, sha256(string_agg(sha256(rule || ':' || entity), ',' order by sha256(rule || ':' || entity))) as evidence_hash from s group by unit")
def evidence_hash(spark, sf):
    return ranking.evidence_hash(signals(spark, sf).withColumn("h", F.sha2(F.concat_ws(":", "rule", "entity"), 256)), ["unit"], "h")


@query("select o_orderkey, case when o_orderkey % 3 = 0 then 'X' when o_orderkey % 5 = 0 then o_orderstatus else o_orderstatus end as o_orderstatus, o_orderpriority from orders")
def apply_overlay(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    new = o.filter("o_orderkey % 3 = 0").select("o_orderkey", F.lit("o_orderstatus").alias("field"), F.col("o_orderstatus").alias("old"), F.lit("X").alias("new"))
    stale = o.filter("o_orderkey % 3 <> 0 and o_orderkey % 5 = 0").select("o_orderkey", F.lit("o_orderstatus").alias("field"), F.lit("?").alias("old"), F.lit("Y").alias("new"))
    return joins.overlay(o, new.unionByName(stale), "o_orderkey", ["o_orderstatus", "o_orderpriority"])


@query("""with b as (select o_orderkey as k, o_orderstatus as s, o_orderpriority as p from orders where o_orderkey % 4 <> 0), a as (select o_orderkey as k, case when o_orderkey % 3 = 0 then 'X' else o_orderstatus end as s, o_orderpriority as p from orders where o_orderkey % 5 <> 0),
m as (select coalesce(b.k, a.k) as k, b.k is not null as hb, a.k is not null as ha, b.s as bs, a.s as as_, b.p as bp, a.p as ap from b full join a on a.k = b.k)
select k, 'status' as field, bs as before, as_ as after, case when not hb then 'added' when not ha then 'removed' else 'changed' end as change from m where not (hb and ha and bs is not distinct from as_)
union all select k, 'priority', bp, ap, case when not hb then 'added' when not ha then 'removed' else 'changed' end from m where not (hb and ha and bp is not distinct from ap)""")
def ledger_diff(spark, sf):
    o = t(spark, sf, "orders").selectExpr("o_orderkey as k", "o_orderstatus as status", "o_orderpriority as priority")
    return joins.differences(o.filter("k % 4 <> 0"), o.filter("k % 5 <> 0").withColumn("status", F.expr("if(k % 3 = 0, 'X', status)")), "k", ["status", "priority"])


@query("select o_orderkey, o_custkey from orders where not exists (select 1 from customer where c_custkey = o_custkey and c_acctbal > 0)")
def orphans(spark, sf):
    return gates.orphans(t(spark, sf, "orders"), "o_custkey", t(spark, sf, "customer").filter("c_acctbal > 0"), "c_custkey").select("o_orderkey", "o_custkey")


@query("""select c_custkey, coalesce(case when c_custkey % 10 = 0 then 'page' end, case when c_nationkey < 5 then 'source' end, 'unreviewed') as decision, case when c_custkey % 10 = 0 then 'c_custkey' when c_nationkey < 5 then 'c_nationkey' else 'default' end as decided_by from customer""")
def override_precedence(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    pages = c.filter("c_custkey % 10 = 0").selectExpr("c_custkey", "'page' as d")
    sources = t(spark, sf, "nation").filter("n_nationkey < 5").selectExpr("n_nationkey as c_nationkey", "'source' as d")
    return joins.prefer(c, [(pages, "c_custkey", "d"), (sources, "c_nationkey", "d")], "unreviewed").select("c_custkey", "decision", "decided_by")


@query("""with l as (select c_custkey as k, c_name as a, c_nationkey as b from customer where c_custkey % 3 <> 0), r as (select c_custkey as k, c_name as a, case when c_custkey % 7 = 0 then -1 else c_nationkey end as b from customer where c_custkey % 4 <> 0)
select coalesce(l.k, r.k) as k, case when l.k is null then 'unknown' when r.k is null then 'missing' else 'drift' end as status from l full join r on l.k = r.k where l.k is null or r.k is null or l.a <> r.a or l.b <> r.b""")
def identity_drift(spark, sf):
    c = t(spark, sf, "customer").selectExpr("c_custkey as k", "c_name as a", "c_nationkey as b")
    return joins.identity_drift(c.filter("k % 3 <> 0"), c.filter("k % 4 <> 0").withColumn("b", F.expr("if(k % 7 = 0, -1, b)")), "k", ["a", "b"])


@query("""with b as (select p_partkey, p_name, row_number() over (order by p_partkey) as pos from part where p_partkey % 50 <> 0), u as (select p_partkey, p_name || '*' as p_name from part where p_partkey % 25 = 0)
select b.p_partkey, coalesce(u.p_name, b.p_name) as p_name, pos from b left join u using (p_partkey) union all
select p_partkey, p_name, (select max(pos) from b) + row_number() over (order by p_partkey) from u where p_partkey % 50 = 0""")
def upsert(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", "p_name")
    base = ranking.rank_all(p.filter("p_partkey % 50 <> 0"), [F.col("p_partkey")], "pos").select("p_partkey", "p_name", "pos")
    return joins.upsert(base, p.filter("p_partkey % 25 = 0").withColumn("p_name", F.concat("p_name", F.lit("*"))), "p_partkey", "pos")


@query("select conv_id, row_number() over (partition by conv_id order by turn, role, text) as record_index, turn, role, length(text) as n from conversations")
def flatten_conversations(spark, sf):
    c = t(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    return nested.flatten(c, ["conv_id"], "turns").select("conv_id", "record_index", "turn", "role", F.length("text").alias("n"))


def components(vectors: DataFrame) -> DataFrame:
    """Every component of every vector with its 1-based index; a null or empty vector keeps one row, with nulls."""
    rows = nested.flatten(vectors.withColumn("embedding", F.transform("embedding", lambda v: F.struct(F.round(v.cast("double"), 6).alias("x")))), ["vec_id", "label"], "embedding")
    return rows.withColumn("record_index", F.col("record_index").cast("long"))


@query("select vec_id, label, i as record_index, round(cast(embedding[i] as double), 6) as x from embeddings left join lateral (select unnest(range(1, len(embedding) + 1)) as i) on true")
def embedding_components(spark, sf):
    return components(t(spark, sf, "embeddings"))


@query("select c_custkey as key, c_name as name, c_mktsegment as segment, null::double as balance from customer union all by name select s_suppkey as key, s_name as name, s_acctbal as balance from supplier")
def schema_union(spark, sf):
    a = t(spark, sf, "customer").selectExpr("c_custkey as key", "c_name as name", "c_mktsegment as segment")
    return nested.union_all([a, t(spark, sf, "supplier").selectExpr("s_suppkey as key", "s_name as name", "s_acctbal as balance")])


@query("""select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) as host,
regexp_replace(regexp_replace(regexp_replace(url, '^[a-z]+://[^/?#]+', ''), '[?#].*$', ''), '^.*/', '') as file from pages""")
def page_title(spark, sf):
    p = t(spark, sf, "pages")
    return p.select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.parse_url("url", F.lit("HOST")).alias("host"), exprs.file_name(F.col("url")).alias("file"))


_TERMS = ["the", "der", "que", "password"]


@query("""with n as (select doc_id, ' ' || regexp_replace(lower(text), '\\s+', ' ', 'g') || ' ' as x from documents where text is not null),
s as (select doc_id, list_filter(['the', 'der', 'que', 'password'], lambda w: contains(x, ' ' || w || ' ')) as hits from n)
select doc_id, len(hits) as score, array_to_string(hits, ';') as reasons, case when len(hits) >= 1 then 'selected' else 'flagged' end as classification from s""")
def classify_documents(spark, sf):
    x = F.concat(F.lit(" "), F.regexp_replace(F.lower("text"), r"\s+", " "), F.lit(" "))
    d = t(spark, sf, "documents").filter("text is not null").select("doc_id", x.alias("x"))
    hits = F.filter(F.array(*map(F.lit, _TERMS)), lambda w: F.col("x").contains(F.concat(F.lit(" "), w, F.lit(" "))))
    return d.select("doc_id", hits.alias("h")).select("doc_id", F.size("h").alias("score"), F.array_join("h", ";").alias("reasons"), F.when(F.size("h") >= 1, "selected").otherwise("flagged").alias("classification"))


@query("""with l as (select 'l_quantity' as variable, l_quantity as x from lineitem union all select 'l_discount', l_discount from lineitem)
select variable, count(*) as n, count(x) as nonmissing, round(avg(x), 6) as mean, round(stddev_samp(x), 6) as sd, min(x) as min, median(x) as p50, max(x) as max from l group by 1""")
def describe_lineitem(spark, sf):
    rows = cross.describe(t(spark, sf, "lineitem"), ["l_quantity", "l_discount"])
    return rows.withColumn("mean", F.round("mean", 6)).withColumn("sd", F.round("sd", 6))


@query("select l_returnflag, l_linestatus, count(*) as freq from lineitem group by 1, 2")
def frequencies(spark, sf):
    return cross.frequencies(t(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("select user_id, count(*) filter (event_type = 'click') as click, count(*) filter (event_type = 'view') as view, count(*) filter (event_type = 'error') as error, count(*) as total from events group by 1")
def pivot_counters(spark, sf):
    n = lambda k: F.count_if(F.col("event_type") == k).alias(k)
    return t(spark, sf, "events").groupBy("user_id").agg(n("click"), n("view"), n("error"), F.count("*").alias("total"))


@query("select cast(json_extract_string(props, '$.k') as bigint) as k, count(*) as n from events group by 1")
def event_props(spark, sf):
    return t(spark, sf, "events").groupBy(F.get_json_object("props", "$.k").cast("long").alias("k")).agg(F.count("*").alias("n"))


@query("""with p as (select o_custkey, cast(count(*) as bigint) as n from orders group by 1 having count(*) >= 15) select 'page' as metric, count(*) as value from p union all select 'flags', cast(sum(n) as bigint) from p
union all select 'customers', count(*) from customer union all select 'orders', count(*) from orders""")
def release_accounting(spark, sf):
    p = t(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).filter("n >= 15")
    one = lambda name, df, agg: df.agg(agg.cast("long").alias("value")).select(F.lit(name).alias("metric"), "value")
    return one("page", p, F.count("*")).unionByName(one("flags", p, F.sum("n"))).unionByName(one("customers", t(spark, sf, "customer"), F.count("*"))).unionByName(one("orders", t(spark, sf, "orders"), F.count("*")))


@query("select l_orderkey, min(l_linenumber) as lo, max(l_linenumber) as hi, count(*) as n, count(distinct l_linenumber) as d from lineitem group by 1 having min(l_linenumber) <> 1 or max(l_linenumber) <> count(*) or count(distinct l_linenumber) <> count(*)")
def contiguity(spark, sf):
    return gates.not_contiguous(t(spark, sf, "lineitem"), ["l_orderkey"], "l_linenumber")


@query("select l_partkey from lineitem group by 1 having count(distinct l_returnflag || l_linestatus) > 1")
def functional_dependency(spark, sf):
    return gates.not_functional(t(spark, sf, "lineitem"), ["l_partkey"], ["l_returnflag", "l_linestatus"])


@query("""select cast(p_partkey as varchar) as record, 'out_of_bounds' as check, 'p_retailprice' as field, cast(cast(p_retailprice as decimal(18,2)) as varchar) as observed from part where p_retailprice < 1000 or p_retailprice > 1500""")
def bounds_flags(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", money("p_retailprice").cast("string").alias("p_retailprice"))
    return gates.row_flags(p, "p_partkey", ["p_partkey"], [], {"p_retailprice": (1000, 1500)})


@query("""with m as (select 2 * (year(o_orderdate) - 1990) + (case when month(o_orderdate) <= 6 then 1 else 2 end) as w, count(*) as n from orders group by 1)
select w, n, case when w % 2 = 0 then 2 else 1 end as edition, cast((w - (case when w % 2 = 0 then 2 else 1 end)) / 2 as integer) as year from m""")
def waves(spark, sf):
    o = t(spark, sf, "orders").select(exprs.wave(F.year("o_orderdate") - 1990, F.when(F.month("o_orderdate") <= 6, 1).otherwise(2)).alias("w"))
    year, edition = exprs.unwave(F.col("w"))
    return o.groupBy("w").agg(F.count("*").alias("n")).select("w", "n", edition.alias("edition"), year.alias("year"))


@query("select 'bank:' || substr(sha256(lower(c_name) || chr(0) || lower(c_mktsegment)), 1, 24) as entity, c_custkey from customer")
def entity_ids(spark, sf):
    return t(spark, sf, "customer").select(exprs.entity_id(F.col("c_name"), F.col("c_mktsegment")).alias("entity"), "c_custkey")


_SEGMENTS = """s as (select conv_id, turn // 2 as seg, turn, case when turn % 8 = 0 and conv_id % 5 = 0 then 'other' else role end as role from conversations union all select conv_id, turn // 2 - 1, turn, role from conversations where turn % 2 = 0 and turn > 0 and not (conv_id % 7 = 0 and turn % 4 = 0)),
g as (select conv_id, turn, min(role) as role, min(role) <> max(role) as differ from s group by 1, 2)"""


def _segments(spark, sf):
    c = t(spark, sf, "conversations").selectExpr("conv_id", "turn div 2 as seg", "turn", "role")
    again = c.filter("turn % 2 = 0 and turn > 0 and not (conv_id % 7 = 0 and turn % 4 = 0)").withColumn("seg", F.col("seg") - 1)
    own = c.withColumn("role", F.expr("if(turn % 8 = 0 and conv_id % 5 = 0, 'other', role)"))
    return nested.merge_segments(own.unionByName(again), "conv_id", "seg", "turn", "role")


@query(f"with {_SEGMENTS} select conv_id, turn, role from g where not differ")
def segment_merge(spark, sf):
    return _segments(spark, sf)[0]


@query(f"""with {_SEGMENTS}, e as (select conv_id, min(seg) as a, max(seg) as b from s group by 1), p as (select conv_id, unnest(range(a, b)) as k from e),
h as (select distinct x.conv_id, x.seg from s x join s y on x.conv_id = y.conv_id and y.seg = x.seg + 1 and x.turn = y.turn)
select conv_id, 'overlap_disagreement' as conflict, cast(turn as varchar) as detail from g where differ
union all select p.conv_id, 'no_shared_anchor', cast(k as varchar) from p where not exists (select 1 from h where h.conv_id = p.conv_id and h.seg = p.k)""")
def segment_conflicts(spark, sf):
    return _segments(spark, sf)[1]


@query("select distinct o_custkey from orders where o_totalprice > 200000 intersect select c_custkey from customer where c_acctbal > 5000")
def set_intersection(spark, sf):
    return t(spark, sf, "orders").filter("o_totalprice > 200000").select("o_custkey").intersect(t(spark, sf, "customer").filter("c_acctbal > 5000").select("c_custkey"))


@query("select c_custkey from customer except select o_custkey from orders where o_totalprice > 200000")
def set_difference(spark, sf):
    return t(spark, sf, "customer").select("c_custkey").exceptAll(t(spark, sf, "orders").filter("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey")).distinct())


@query("""with p as (select event_type, user_id, cast(floor(epoch(ts) / 86400) as bigint) as t, cast(sum(cast(value as decimal(18,2))) as double) as v from events group by all),
w as (select *, lag(t) over x as t0, lead(t) over x as t2, lag(v) over x as b, lead(v) over x as a from p window x as (partition by event_type, user_id order by t))
select event_type, user_id, t, round(v / b, 6) as r from w where t - t0 = 1 and t2 - t = 1 and b > 0 and v / b >= 10""")
def daily_spikes(spark, sf):
    p = t(spark, sf, "events").groupBy("event_type", "user_id", F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 86400).alias("t")).agg(F.sum(money("value")).cast("double").alias("v"))
    w = Window.partitionBy("event_type", "user_id").orderBy("t")
    rows = p.select("event_type", "user_id", "t", "v", F.lag("t").over(w).alias("t0"), F.lead("t").over(w).alias("t2"), F.lag("v").over(w).alias("b"))
    return rows.filter("t - t0 = 1 and t2 - t = 1 and b > 0").withColumn("r", F.col("v") / F.col("b")).filter("r >= 10").select("event_type", "user_id", "t", F.round("r", 6).alias("r"))
