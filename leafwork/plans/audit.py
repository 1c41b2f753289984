"""Queries of the audit, selection and record operators over the test tables, with the DuckDB SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwork.functions import exprs
from leafwork.operators import corrections, evidence, gates, panel, qc, ranking, records, selection
from leafwork.plans.queries import _RATIO, ORACLES, customer_quarters, money, nation_months, query, t
from leafwork.sources import scans

# ---------------------------------------------------------------- quality control

_QC = qc.Settings(record="o_orderkey", keys=["o_orderkey"], page="page", entity=["o_custkey"], provenance=["clerk"], bounds={"price": (900, 400_000)})


def _orders(spark, sf) -> DataFrame:
    return t(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_custkey", "concat('p', o_custkey % 50) as page", "if(o_orderkey % 503 = 0, '', o_orderpriority) as clerk", "cast(cast(o_totalprice as decimal(18,2)) as string) as price",
        "if(o_orderkey % 211 = 0, 'no', 'yes') as identity_valid", "if(o_orderkey % 307 = 0, 'Failed', 'ok') as status", "if(o_orderkey % 401 = 0, 'flagged', 'selected') as final_type",
    )


_QC_FLAGS = r"""o as (select cast(o_orderkey as varchar) as k, 'p' || (o_custkey % 50) as page, case when o_orderkey % 503 = 0 then '' else o_orderpriority end as clerk, cast(cast(o_totalprice as decimal(18,2)) as varchar) as price, o_orderkey, o_totalprice from orders),
h as (select *, 'missing_provenance' as chk, 'clerk' as field, clerk as observed, 'A provenance field is blank.' as message from o where clerk = ''
union all select *, 'invalid_identity', 'identity_valid', 'no', 'The identity is not valid.' from o where o_orderkey % 211 = 0
union all select *, 'extraction_failure', 'status', 'Failed', 'The extraction failed.' from o where o_orderkey % 307 = 0
union all select *, 'unresolved_page', 'final_type', 'flagged', 'The page has no decision.' from o where o_orderkey % 401 = 0
union all select *, 'invalid_page_selection', 'final_type', 'flagged', 'The page is not selected.' from o where o_orderkey % 401 = 0
union all select *, 'out_of_bounds', 'price', price, 'The value is outside its bounds.' from o where o_totalprice < 900 or o_totalprice > 400000),
l as (select *, '{"check":"' || chk || '","field":"' || field || '","key":"{\"o_orderkey\":\"' || k || '\"}","page":"' || page || '","record":"' || k || '"}' as loc from h),
f0 as (select 'qc-' || substr(sha256(loc), 1, 20) as case_id, chk, 'blocking' as severity, k as record, page, field, observed, o_orderkey,
sha256('{"expected":"","locator":"' || replace(replace(loc, '\', '\\'), '"', '\"') || '","message":"' || message || '","observed":"' || observed || '","provenance":"{\"clerk\":\"' || clerk || '\"}"}') as evidence_hash from l),
cl as (select page, count(*) as n, string_agg(case_id, ';' order by case_id) as cases, '{"check":"clustered_value_anomalies","field":"","key":"","page":"' || page || '","record":""}' as loc from f0 where chk = 'out_of_bounds' group by page having count(*) >= 3),
f as (select * from f0 union all select 'qc-' || substr(sha256(loc), 1, 20), 'clustered_value_anomalies', 'blocking', '', page, '', cast(n as varchar), null,
sha256('{"expected":"< 3","locator":"' || replace(loc, '"', '\"') || '","message":"' || cases || '","observed":"' || n || '","provenance":""}') from cl)"""


@query(f"with {_QC_FLAGS} select case_id, chk as \"check\", severity, record, page, field, observed, evidence_hash from f")
def qc_flags(spark, sf):
    return qc.run_checks(_orders(spark, sf), _QC).select("case_id", "check", "severity", "record", "page", "field", "observed", "evidence_hash")


_QC_DECIDED = (
    _QC_FLAGS
    + r""", d as (select case_id, record, field, observed, case when o_orderkey % 3 = 0 then 'old' else evidence_hash end as hash, case when o_orderkey % 5 = 0 then 'open' when o_orderkey % 7 = 0 then 'corrected' else 'source_verified' end as disposition,
case when o_orderkey % 13 = 0 then '' else 'seen' end as reason, case when o_orderkey % 11 = 0 then '' else 'p1' end as epage, case when o_orderkey % 7 = 0 and o_orderkey % 17 <> 0 then 'c' || record || field || chk else '' end as cid, o_orderkey from f where o_orderkey % 4 <> 1),
j as (select f.*, d.disposition, case when d.case_id is null then '' when hash <> evidence_hash then 'the evidence has changed' when disposition <> 'open' and reason = '' then 'a reason is missing'
when disposition <> 'open' and epage = '' then 'a page of the source is missing' when disposition = 'corrected' and cid = '' then 'a correction is missing'
when disposition = 'corrected' and f.o_orderkey % 2 = 0 and f.observed <> '' then 'after' else '' end as problem, d.case_id is not null as decided, evidence_hash as eh from f left join d using (case_id)),
e as (select chk, case_id as of, 'stale_qc_decision' as x from j where problem <> '' union all select '', 'qc-gone', 'orphaned_open_decision'),
a as (select case_id, chk, page, case when decided and problem = '' then disposition else 'open' end as disposition, case when decided and problem = '' and disposition <> 'open' then 'reviewed' else 'open' end as decision_status from j
union all select 'qc-' || substr(sha256('{"check":"' || x || '","field":"","key":"{\"case_id\":\"' || of || '\"}","page":"","record":""}'), 1, 20), x, '', 'open', 'open' from e)"""
)


def _decided(spark, sf) -> DataFrame:
    flags = qc.run_checks(_orders(spark, sf), _QC)
    k, cid = F.expr("try_cast(record as bigint)"), F.concat(F.lit("c"), "record", "field", "check")
    decisions = flags.filter(k % 4 != 1).select(
        "case_id", F.when(k % 3 == 0, "old").otherwise(F.col("evidence_hash")).alias("evidence_hash"), F.when(k % 5 == 0, "open").when(k % 7 == 0, "corrected").otherwise("source_verified").alias("disposition"),
        F.when(k % 13 == 0, "").otherwise("seen").alias("reason"), F.when(k % 11 == 0, "").otherwise("p1").alias("evidence_page"), F.when((k % 7 == 0) & (k % 17 != 0), cid).otherwise("").alias("correction_id"),
    )
    gone = spark.createDataFrame([("qc-gone", "h", "open", "", "", "")], decisions.schema)
    fixed = flags.select(cid.alias("correction_id"), F.col("record").alias("record_id"), "field", F.lit("").alias("source_hash"), F.lit("").alias("contract_signature"), F.when(k % 2 == 0, "?").otherwise(F.col("current")).alias("after"))
    return qc.adjudicate(flags, decisions.unionByName(gone), fixed)


@query(f"with {_QC_DECIDED} select case_id, chk as \"check\", disposition, decision_status from a")
def qc_adjudicated(spark, sf):
    return _decided(spark, sf).select("case_id", "check", "disposition", "decision_status")


@query(f"with {_QC_DECIDED} select 'check' as measure, chk as value, count(*) as n from a group by all union all select 'severity', 'blocking', count(*) from a union all select 'disposition', disposition, count(*) from a group by all")
def qc_summary(spark, sf):
    return qc.summary(_decided(spark, sf))


@query(f"with {_QC_DECIDED}, b as (select case_id from a where decision_status <> 'reviewed') select case when count(*) = 0 then 'pass' else 'fail' end as status, count(*) as n_blockers, (select string_agg(case_id, ';' order by case_id) from (select case_id from b order by case_id limit 20)) as cases from b")
def qc_release(spark, sf):
    return qc.release(_decided(spark, sf), _QC).withColumn("cases", F.array_join("cases", ";"))


@query(f"with {_QC_DECIDED}, r as (select 'p' || (o_custkey % 50) as page, count(*) as n_rows from orders group by 1), g as (select page, count(*) as n_flags, count(*) filter (decision_status <> 'reviewed') as n_open_blocking from a where page <> '' group by 1) select page, coalesce(n_rows, 0) as n_rows, coalesce(n_flags, 0) as n_flags, coalesce(n_open_blocking, 0) as n_open_blocking from r full join g using (page)")
def qc_source_support(spark, sf):
    return qc.source_support(_orders(spark, sf), _decided(spark, sf), _QC).drop("source_hashes")


_PANEL = qc.Settings(record="", keys=[], entity=["n_name"], time="t", values=["v"], shape="panel", jump=5.0, isolated=2.0, returned=1.5, shift_window=3, shift=1.5, coverage=0.9)


@query(f"""with m as (select n_name, 12 * year(o_orderdate) + month(o_orderdate) as t, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as v from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by all),
w as (select *, lag(v) over x as b, lead(v) over x as a, lag(t) over x as t0, lead(t) over x as t2, median(v) over (partition by n_name order by t rows between 3 preceding and 1 preceding) as m1, median(v) over (partition by n_name order by t rows between current row and 2 following) as m2,
count(v) over y as n6, min(t) over y as lo, max(t) over y as hi from m window x as (partition by n_name order by t), y as (partition by n_name order by t rows between 3 preceding and 2 following)),
c as (select t, count(distinct n_name) as n from m group by 1), cw as (select *, lag(n) over (order by t) as n0 from c), ends as (select min(t) as a, max(t) as b from m)
select 'one_sided_jump' as "check", n_name as entity, cast(t as varchar) as period, 'v' as field from w where b is not null and {_RATIO.format('b', 'v')} >= 5
union all select 'isolated_reversal', n_name, cast(t as varchar), 'v' from w where t - t0 = 1 and t2 - t = 1 and {_RATIO.format('b', 'a')} <= 1.5 and {_RATIO.format('v', '((b + a) / 2)')} >= 2
union all select 'persistent_shift', n_name, cast(t as varchar), 'v' from w where n6 = 6 and hi - lo = 5 and {_RATIO.format('m1', 'm2')} >= 1.5
union all select 'panel_gap', n_name, cast(t as varchar), 't' from w where t - t0 > 1
union all select 'coverage_change', '', cast(t as varchar), '' from cw where least(n, n0) / greatest(n, n0) < 0.9
union all select 'zero_coverage_period', '', cast(s.t as varchar), '' from (select unnest(range(a, b + 1)) as t from ends) s where s.t not in (select t from m)""")
def qc_panel(spark, sf):
    return qc.panel_checks(nation_months(spark, sf), _PANEL).select("check", "entity", "period", "field")


@query("""with s as (select l_orderkey, l_linenumber, l_returnflag, l_quantity, l_extendedprice, l_discount from lineitem),
m as (select l_returnflag, median(l_extendedprice) as med from s group by 1), d as (select s.*, med, abs(l_extendedprice - med) as dev from s join m using (l_returnflag)), a as (select l_returnflag, median(dev) as mad from d group by 1),
q as (select l_returnflag, count(*) as n, avg(case when l_quantity % 1 = 0 and cast(l_quantity as bigint) % 5 = 0 then 1.0 else 0.0 end) as share from s where abs(l_quantity - round(l_quantity)) < 1e-9 group by 1)
select 'robust_cross_section_outlier' as "check", 'l_extendedprice' as field, count(*) as n from d join a using (l_returnflag) where 0.67448975 * dev / mad >= 2 group by all having count(*) > 0
union all select 'heaping', 'l_quantity', count(*) from q where n >= 20 and share >= 0.15 group by all having count(*) > 0
union all select 'accounting_inconsistency', 'half', count(*) from s where l_extendedprice > 0 and abs(l_quantity * 1000 - l_extendedprice) / l_extendedprice > 0.5 group by all having count(*) > 0""")
def qc_cross_section(spark, sf):
    rows = t(spark, sf, "lineitem").selectExpr("concat(l_orderkey, '-', l_linenumber) as record", "l_returnflag", "l_quantity", "l_extendedprice", "l_quantity * 1000 as part", "l_linenumber", "l_orderkey")
    price = qc.Settings(record="record", keys=["record"], entity=["record"], values=["l_extendedprice"], group=["l_returnflag"], z=2.0, heap_share=2.0, accounting={"half": (["part"], "l_extendedprice")}, tolerance=0.5)
    heap = qc.Settings(record="record", keys=["record"], entity=["record"], values=["l_quantity"], group=["l_returnflag"], z=1e9, heap_base=5, heap_share=0.15)
    return qc.cross_section_checks(rows, price).unionByName(qc.cross_section_checks(rows, heap)).groupBy("check", "field").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- evidence

_KEY = "year(l_shipdate) as year, case when month(l_shipdate) <= 6 then 1 else 2 end as edition, l_linenumber as part, 1 + l_suppkey % 40 as page"
_RAW = "case when l_discount < 0.02 then '' else 'x' end as state, case when l_tax < 0.01 then '' else 'y' end as city, case when l_quantity < 4 then null else 'z' end as name, case when l_partkey % 9 = 0 then 'bad' when l_partkey % 11 = 0 then '' else '12-' || l_partkey end as transit"
_CLEAN = "case when l_discount < 0.03 then 0 else 1 end as ok_city, case when l_tax < 0.02 then null else 1 end as ok_name, 1990 + l_partkey % 9 as established, year(l_shipdate) + l_partkey % 3 as statement, cast(l_extendedprice as double) as a, l_quantity as b, case when l_orderkey % 5 = 0 then null else l_discount end as c, l_extendedprice * (case when l_orderkey % 7 = 0 then 1.5 else 1.0 end) + l_quantity as total"
_RAW_Q = f"""rr as (select {_KEY}, {_RAW} from lineitem), rq as (select year, edition, part, page, count(*) as raw_rows, count(*) filter (coalesce(state, '') = '') as raw_missing_state, count(*) filter (coalesce(city, '') = '') as raw_missing_city, count(*) filter (coalesce(name, '') = '') as raw_missing_name,
count(*) filter (coalesce(transit, '') <> '' and not regexp_full_match(transit, '[0-9]{{2}}-[0-9]+')) as raw_invalid_transit from rr group by 1, 2, 3, 4)"""
_CLEAN_Q = f"""cc as (select {_KEY}, {_CLEAN} from lineitem where l_partkey % 6 <> 0), cs as (select *, case when (a is not null)::int + (b is not null)::int + (c is not null)::int >= 3 and year >= 1934 and total > 0 then abs(coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0) - total) / total end as share from cc),
cq as (select year, edition, part, page, count(*) as clean_rows, count(*) filter (not coalesce(ok_city = 1, false)) as invalid_city, count(*) filter (not coalesce(ok_name = 1, false)) as invalid_name, count(*) filter (established > year or established < 1776) as invalid_established, count(*) filter (statement > year + 1) as invalid_statement,
count(*) filter (share > 0.01) as accounting_mismatch, max(share) as max_error_share from cs group by 1, 2, 3, 4)"""


def _lines(spark, sf, columns: str, where: str = "true") -> DataFrame:
    spark_sql = columns.replace("'12-' || l_partkey", "concat('12-', l_partkey)")
    spark_key = _KEY
    return t(spark, sf, "lineitem").filter(where).selectExpr(*_split(f"{spark_key}, {spark_sql}"))


def _split(columns: str) -> list[str]:
    """At commas outside of parentheses."""
    out, depth, at = [], 0, 0
    for k, c in enumerate(columns):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(columns[at:k])
            at = k + 1
    return [*out, columns[at:]]


def _raw(spark, sf) -> DataFrame:
    return evidence.raw_quality(_lines(spark, sf, _RAW), evidence.PAGE, {"state": "state", "city": "city", "name": "name"}, "transit")


def _clean(spark, sf) -> DataFrame:
    return evidence.clean_quality(_lines(spark, sf, _CLEAN, "l_partkey % 6 <> 0"), evidence.PAGE, {"city": "ok_city", "name": "ok_name"}, "year", "established", "statement", ["a", "b", "c"], "total")


@query(f"with {_RAW_Q} select * from rq")
def raw_page_quality(spark, sf):
    return _raw(spark, sf)


@query(f"with {_CLEAN_Q} select * replace (round(max_error_share, 9) as max_error_share) from cq")
def clean_page_quality(spark, sf):
    return _clean(spark, sf).withColumn("max_error_share", F.round("max_error_share", 9))


_EXCLUSIONS = "x(year, edition, part, lo, hi) as (values (1996, 1, 1, 3, 9), (1996, 1, 1, 8, 12), (1997, 2, 2, null, null), (1995, 1, 3, 40, 40))"
_PAGES = f"pg as (select distinct {_KEY} from lineitem)"


def _pages(spark, sf) -> DataFrame:
    return t(spark, sf, "lineitem").selectExpr(*_split(_KEY)).distinct()


def _exclusions(spark) -> DataFrame:
    return spark.createDataFrame([(1996, 1, 1, 3, 9), (1996, 1, 1, 8, 12), (1997, 2, 2, None, None), (1995, 1, 3, 40, 40)], "year int, edition int, part int, start int, end int")


def _eligible(spark, sf) -> DataFrame:
    return evidence.eligible(_pages(spark, sf), _exclusions(spark), F.col("page") % 13 == 0)


_ELIGIBLE = f"{_PAGES}, {_EXCLUSIONS}, el as (select pg.*, case when page % 13 = 0 then 'advertisement' when exists (select 1 from x where x.year = pg.year and x.edition = pg.edition and x.part = pg.part and (lo is null or page between lo and hi)) then 'excluded' else '' end as reason from pg)"


@query(f"with {_ELIGIBLE} select *, reason = '' as eligible from el")
def page_eligibility(spark, sf):
    return _eligible(spark, sf)


_QUALITY_S = """qs as (select pg.*, coalesce(raw_rows, 0) as n, coalesce(clean_rows, 0) as m, greatest(raw_missing_state, raw_missing_city, raw_missing_name, 0) as lost, coalesce(raw_invalid_transit, 0) as tr, greatest(0, coalesce(raw_rows, 0) - coalesce(clean_rows, 0)) as gone, greatest(invalid_city, invalid_name, 0) as ident, coalesce(accounting_mismatch, 0) as off
from pg left join rq using (year, edition, part, page) left join cq using (year, edition, part, page)),
q2 as (select year, edition, part, page, n, m, 'raw_identity_field_loss' as rule, 'identity' as family, 2 as tier, cast(lost as double) as magnitude from qs where n > 0 and lost >= 5 and lost >= 0.1 * n
union all select year, edition, part, page, n, m, 'transit_format_cluster', 'identity', 2, tr from qs where n > 0 and tr >= 5 and tr >= 0.1 * n
union all select year, edition, part, page, n, m, 'raw_clean_row_loss', 'field_loss', 4, gone from qs where n > 0 and gone >= 5 and gone >= 0.1 * n
union all select year, edition, part, page, n, m, 'clean_identity_failure_cluster', 'identity', 2, ident from qs where m > 0 and ident >= 5 and ident >= 0.1 * m
union all select year, edition, part, page, n, m, 'accounting_mismatch_cluster', 'accounting', 2, off from qs where m > 0 and off >= 3 and off >= 0.01 * m and year >= 1934)"""


@query(f"""with {_PAGES}, {_RAW_Q}, {_CLEAN_Q}, {_QUALITY_S} select year, edition, part, page, rule, family, tier, magnitude, '{{"clean_rows":"' || m || '","raw_rows":"' || n || '"}}' as evidence from q2""")
def quality_signals(spark, sf):
    return evidence.quality_signals(_pages(spark, sf), _raw(spark, sf), _clean(spark, sf)).drop("entity", "directness")


_DENSITY_S = """dn as (select pg.*, coalesce(raw_rows, 0) as n from pg left join rq using (year, edition, part, page)), dw as (select *, lag(page) over w as p0, lead(page) over w as p2, lag(n) over w as n0, lead(n) over w as n2 from dn window w as (partition by year, edition, part order by page)),
ds as (select year, edition, part, page, least(n0, n2) / greatest(n, 1) as magnitude from dw where page - p0 = 1 and p2 - page = 1 and least(n0, n2) >= 4 and n <= 0.5 * least(n0, n2))"""


@query(f"with {_PAGES}, {_RAW_Q}, {_DENSITY_S} select year, edition, part, page, round(magnitude, 9) as magnitude, 'page_density_collapse' as rule, 1 as tier from ds")
def density_signals(spark, sf):
    policy = evidence.Policy(density_least=4, density_share=0.5)
    return evidence.density_signals(_pages(spark, sf), _raw(spark, sf), policy).select(*evidence.PAGE, F.round("magnitude", 9).alias("magnitude"), "rule", "tier")


@query(f"with {_PAGES}, {_EXCLUSIONS} select pg.*, 'scope_exclusion' as rule, cast(count(*) as double) as magnitude from pg join x on x.year = pg.year and x.edition = pg.edition and x.part = pg.part and (lo is null or page between lo and hi) group by all")
def scope_signals(spark, sf):
    return evidence.scope_signals(_pages(spark, sf), _exclusions(spark)).select(*evidence.PAGE, "rule", "magnitude")


_FAMILIES = ["structural_failure", "cropped_page", "cache_error", "documented_rerun", "manual_correction", "location_correction", "correspondent_error"]
_MANUAL_SQL = "mf(i, fam, rule, family, tier, strength) as (values " + ", ".join(f"({k}, '{f}', '{evidence.MANUAL[f][0]}', '{evidence.MANUAL[f][1]}', {evidence.MANUAL[f][2]}, '{evidence.MANUAL[f][3]}')" for k, f in enumerate(_FAMILIES)) + ")"


@query(f"""with {_PAGES}, {_MANUAL_SQL} select pg.*, rule, family, tier, coalesce(case when page % 4 = 0 then null else page end, 1)::double as magnitude,
'{{"affected_records":"' || coalesce(cast(case when page % 4 = 0 then null else page end as varchar), '') || '","evidence_family":"' || fam || '","note":"n","strength":"' || strength || '"}}' as evidence from pg join mf on i = (year + edition + part + page) % 7""")
def manual_signals(spark, sf):
    fam = F.array(*map(F.lit, _FAMILIES))[(F.col("year") + F.col("edition") + F.col("part") + F.col("page")) % 7]
    strength = F.create_map(*[x for f in _FAMILIES for x in (F.lit(f), F.lit(evidence.MANUAL[f][3]))])
    rows = _pages(spark, sf).withColumn("evidence_family", fam).withColumn("strength", strength[F.col("evidence_family")]).withColumn("affected_records", F.expr("if(page % 4 = 0, null, page)")).withColumn("note", F.lit("n"))
    return evidence.manual_signals(rows).drop("entity", "directness")


_CAPITAL = """cb as (select o_custkey, 4 * year(o_orderdate) + quarter(o_orderdate) as t, count(*) as n from orders group by all),
ca as (select o_custkey, t, case when o_custkey % 5 = 0 and (t - 1) % 4 = 1 then null else 2 * n end as v from cb),
cw as (select *, lag(t) over x as t0, lead(t) over x as t2, lag(v) over x as b, lead(v) over x as a from ca window x as (partition by o_custkey order by t)),
ck as (select o_custkey, t, case when v is null then null else greatest(v / b, b / v) end as factor, case when v is null then 'missing_middle' when greatest(v / b, b / v) >= 10 then 'factor_strong' when greatest(v / b, b / v) >= 2 then 'factor_weak' end as kind from cw where t - t0 = 1 and t2 - t = 1 and b = a and b > 0)"""


@query(f"""with {_CAPITAL} select t // 4 as year, 1 as edition, t % 4 as part, o_custkey as page, case kind when 'missing_middle' then 'capital_missing_middle' when 'factor_strong' then 'capital_factor_10' else 'capital_factor_2_10' end as rule, case kind when 'factor_weak' then 4 else 2 end as tier,
case when kind = 'missing_middle' then 1.0 else factor end as magnitude, 'bank:' || substr(sha256(cast(o_custkey as varchar) || chr(0) || 'c'), 1, 24) as entity from ck where kind is not null""")
def capital_signals(spark, sf):
    q = customer_quarters(spark, sf).withColumn("v", F.expr("if(o_custkey % 5 = 0 and pmod(t - 1, 4) = 1, null, 2 * n)").cast("double")).drop("n")
    found = panel.two_sided_anomalies(q, ["o_custkey"], "t", "v")
    rows = found.selectExpr("cast(t div 4 as int) as year", "1 as edition", "cast(t % 4 as int) as part", "o_custkey as page", "kind", "factor", "cast(o_custkey as string) as a", "'c' as b").withColumn("entity", exprs.entity_id(F.col("a"), F.col("b")))
    return evidence.capital_signals(rows).select(*evidence.PAGE, "rule", "tier", "magnitude", "entity")


_GAPS = """ga as (select o_orderkey, 3986 + o_orderkey % 9 as wave, 1 + o_orderkey % 2 as pp, 1 + o_orderkey % 5 as pg, 1 + o_orderkey % 2 + (case when o_orderkey % 19 = 0 then 1 else 0 end) as np, 1 + o_orderkey % 5 + o_orderkey % 3 as ng, o_orderkey % 4 < 2 as ch, o_orderkey % 3 = 0 as tr from orders),
gl as (select *, pp as part, pg as page, 1.0 as w from ga where pp = np and pg = ng union all select *, pp, pg, 0.5 from ga where pp = np and pg + 1 = ng union all select *, np, ng, 0.5 from ga where pp = np and pg + 1 = ng)"""


@query(f"""with {_GAPS} select cast((wave - (case when wave % 2 = 0 then 2 else 1 end)) / 2 as integer) as year, case when wave % 2 = 0 then 2 else 1 end as edition, part, page, case when w = 1 then 'panel_gap_same_page' else 'panel_gap_adjacent' end as rule, case when w = 1 then 'same_page_bracket' else 'adjacent_page_bracket' end as directness,
w * (case when ch and tr then 5 when ch or tr then 3 else 1 end) as magnitude, count(*) as n from gl group by all""")
def gap_signals(spark, sf):
    g = t(spark, sf, "orders").selectExpr("o_orderkey", "cast(3986 + o_orderkey % 9 as int) as wave", "1 + o_orderkey % 2 as prev_part", "1 + o_orderkey % 5 as prev_page", "1 + o_orderkey % 2 + if(o_orderkey % 19 = 0, 1, 0) as next_part", "1 + o_orderkey % 5 + o_orderkey % 3 as next_page", "o_orderkey % 4 < 2 as charter_agrees", "o_orderkey % 3 = 0 as transit_agrees", "0.9D as support", "cast(o_orderkey as string) as entity")
    return evidence.gap_signals(evidence.gap_places(g)).groupBy(*evidence.PAGE, "rule", "directness", "magnitude").agg(F.count("*").alias("n"))


def _all_signals(spark, sf) -> DataFrame:
    parts = [quality_parts := evidence.quality_signals(_pages(spark, sf), _raw(spark, sf), _clean(spark, sf)), evidence.scope_signals(_pages(spark, sf), _exclusions(spark)), evidence.density_signals(_pages(spark, sf), _raw(spark, sf), evidence.Policy(density_least=4, density_share=0.5))]
    assert quality_parts.columns == evidence.SIGNAL
    return evidence.union_signals(parts, _pages(spark, sf))


@query(f"""with {_ELIGIBLE}, {_RAW_Q}, {_CLEAN_Q}, {_QUALITY_S}, {_DENSITY_S}, al as (select year, edition, part, page, tier from q2 union all select year, edition, part, page, 1 from ds union all select pg.year, pg.edition, pg.part, pg.page, 4 from pg join x on x.year = pg.year and x.edition = pg.edition and x.part = pg.part and (lo is null or pg.page between lo and hi) group by all)
select * from (select count(*) as pages, count(*) filter (reason = '') as eligible, count(*) filter (reason <> '') as ineligible, count(*) filter (reason = 'advertisement') as advertisements, count(*) filter (reason = 'excluded') as excluded from el),
(select count(*) as signals, count(distinct (year, edition, part, page)) as pages_with_signals, count(*) filter (tier = 1) as tier_1, count(*) filter (tier = 2) as tier_2, count(*) filter (tier = 3) as tier_3, count(*) filter (tier = 4) as tier_4 from al)""")
def evidence_receipt(spark, sf):
    return evidence.receipt(_eligible(spark, sf), _all_signals(spark, sf))


# ---------------------------------------------------------------- selection


def _ranked(spark, sf) -> DataFrame:
    c = t(spark, sf, "customer").selectExpr("c_custkey", "c_acctbal", "c_nationkey % 4 + 1 as tier", "1L as families", "1L + c_custkey % 2 as rules", "1L + c_custkey % 3 as entities", "cast(c_acctbal as double) as magnitude", "c_custkey % 7 as n_records", "c_custkey % 9 <> 0 as eligible", "c_custkey % 11 = 0 as counted")
    return selection.priority(c, "c_custkey", "n_records")


_RANKED = """rk as (select *, entities / greatest(n_records, entities) as share from (select c_custkey, c_nationkey % 4 + 1 as tier, 1 as families, 1 + c_custkey % 2 as rules, 1 + c_custkey % 3 as entities, cast(c_acctbal as double) as magnitude, c_custkey % 7 as n_records, c_custkey % 9 <> 0 as eligible, c_custkey % 11 = 0 as counted from customer)),
rn as (select *, row_number() over (order by tier, families desc, rules desc, entities desc, share desc, magnitude desc, c_custkey) as page_rank from rk)"""


@query(f"with {_RANKED} select c_custkey, page_rank, round(share, 9) as affected_share from rn")
def priority_share(spark, sf):
    return _ranked(spark, sf).select("c_custkey", "page_rank", F.round("affected_share", 9).alias("affected_share"))


@query(f"""with {_RANKED}, q as (select *, eligible and not counted and tier <= 3 as ok, row_number() over (partition by eligible and not counted and tier <= 3 order by page_rank) as k from rn)
select c_custkey, case when not eligible then 'ineligible' when counted then 'already_counted' when tier > 3 then 'tier4_only' when k <= 40 then 'selected' else 'trial_limit' end as status, case when ok and k <= 40 then k end as selection_rank from q""")
def selection_labels(spark, sf):
    rows = selection.labelled(_ranked(spark, sf).withColumn("localized", F.col("tier") <= 3), "page_rank", True, 500, 40)
    return rows.select("c_custkey", "status", "selection_rank")


@query("""with s as (select event_id, event_type, case when event_type = 'click' then 'documented' when event_type = 'view' then 'identity' else 'correspondent' end as family, case when event_id % 10 = 0 then 'scope_exclusion' else 'r' end as rule, case when event_id % 3 = 0 then '{"evidence_family":"x","k":1}' else '{"k":1}' end as evidence from events)
select case when family = 'documented' then 'documented' when rule = 'scope_exclusion' then 'scope_exclusion' when event_id % 3 = 0 then family || '_manual' end as category, count(*) as n from s group by 1""")
def manual_categories(spark, sf):
    e = t(spark, sf, "events").selectExpr("event_id", "case when event_type = 'click' then 'documented' when event_type = 'view' then 'identity' else 'correspondent' end as family", "if(event_id % 10 = 0, 'scope_exclusion', 'r') as rule", """if(event_id % 3 = 0, '{"evidence_family":"x","k":1}', '{"k":1}') as evidence""")
    return e.groupBy(selection.manual_category(F.col("family"), F.col("rule"), F.col("evidence")).alias("category")).agg(F.count("*").alias("n"))


@query("with r as (select event_type, event_id, row_number() over (partition by event_type order by event_id) as k, count(*) over (partition by event_type) as n from events) select event_type, max(n) as n, string_agg(cast(event_id as varchar), ',' order by event_id) filter (k <= 20) as samples from r group by 1")
def sample_caps(spark, sf):
    return selection.samples(t(spark, sf, "events"), ["event_type"], "event_id").select("event_type", "n", F.array_join(F.transform("samples", lambda x: x.cast("string")), ",").alias("samples"))


@query("select o_orderkey from orders where o_orderkey % 17 <> 0 and o_orderdate between date '1996-03-05' and date '1997-06-30' and (year(o_orderdate) // 10) * 10 + 9 >= 1996")
def date_window(spark, sf):
    o = t(spark, sf, "orders").selectExpr("o_orderkey", "if(o_orderkey % 17 = 0, 'undated', date_format(o_orderdate, 'yyyy-MM-dd')) as date", "cast(year(o_orderdate) div 10 * 10 as int) as decade")
    return o.filter(selection.decade_may_match(F.col("decade"), "1996-03-05", "1997-06-30") & selection.in_window(F.col("date"), "1996-03-05", "1997-06-30")).select("o_orderkey")


@query("""select o_orderkey, case when o_orderkey % 29 = 0 then 'error' else concat_ws(';', case when o_orderstatus <> 'F' then 'status=' || o_orderstatus end, case when o_orderpriority like '1%' then 'scan_quality=poor' end, case when o_orderkey % 6 = 0 then 'uncertain_fields' end) end as reason from orders""")
def review_reasons(spark, sf):
    o = t(spark, sf, "orders").selectExpr("o_orderkey", "if(o_orderstatus = 'F', 'ok', o_orderstatus) as status", "if(o_orderpriority like '1%', 'poor', 'good') as quality", "array(array(), if(o_orderkey % 6 = 0, array('x'), cast(array() as array<string>))) as uncertain", "if(o_orderkey % 29 = 0, 'boom', '') as error")
    return o.select("o_orderkey", selection.review_reason("status", "quality", "uncertain").alias("reason"))


@query("select p_partkey, p_brand from part where p_partkey in (select distinct l_partkey from lineitem where l_quantity >= 49) union all select p_partkey, p_brand || '*' from part where p_brand like 'Brand#1%' union all select * from (select p_partkey, p_brand || '!' from part order by p_partkey limit 25)")
def page_selectors(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", "p_brand")
    ids = t(spark, sf, "lineitem").filter("l_quantity >= 49").select(F.col("l_partkey").alias("p_partkey"))
    mark = lambda df, m: df.withColumn("p_brand", F.concat("p_brand", F.lit(m)))
    return selection.select_pages(p, "p_partkey", "p_partkey", ids=ids).unionByName(mark(selection.select_pages(p, "p_partkey", "p_partkey", prefix=("p_brand", "Brand#1")), "*")).unionByName(mark(selection.select_pages(p, "p_partkey", "p_partkey", limit=25), "!"))


@query("select l_partkey, min(l_orderkey * 10 + l_linenumber) as at from lineitem group by 1")
def first_appearance(spark, sf):
    return selection.first_by_key(t(spark, sf, "lineitem").selectExpr("l_partkey", "l_orderkey * 10 + l_linenumber as at"), "l_partkey", "at")


# ---------------------------------------------------------------- corrections


def _corrections(spark, sf) -> tuple[DataFrame, DataFrame]:
    o = t(spark, sf, "orders").selectExpr("cast(o_orderkey as string) as id", "o_orderstatus as status", "o_orderpriority as priority", "sha2(o_orderpriority, 256) as source_sha256", "'v1' as contract_signature")
    new = lambda n, field: o.filter(F.col("id").cast("long") % n == 0).selectExpr(f"concat('{field}', id) as correction_id", "id as record_id", f"'{field}' as field", f"{field} as old_value", f"concat({field}, '!') as new_value", "source_sha256 as source_hash", "contract_signature")
    return o, new(3, "status").unionByName(new(5, "priority"))


@query("select cast(o_orderkey as varchar) as id, o_orderstatus || (case when o_orderkey % 3 = 0 then '!' else '' end) as status, o_orderpriority || (case when o_orderkey % 5 = 0 then '!' else '' end) as priority from orders")
def corrected_orders(spark, sf):
    return corrections.apply_corrections(*_corrections(spark, sf), "id")[0].select("id", "status", "priority")


@query("""select 'status' || o_orderkey as correction_id, case when o_orderkey % 2 = 0 then 'old value' when o_orderkey % 5 = 0 then 'source hash' when o_orderkey % 7 = 0 then 'contract signature' end as problem from orders where o_orderkey % 3 = 0 and (o_orderkey % 2 = 0 or o_orderkey % 5 = 0 or o_orderkey % 7 = 0)
union all select 'x' || n_nationkey, case when n_nationkey % 2 = 0 then 'protected field' else 'missing field' end from nation union all select 'gone', 'missing record'""")
def stale_corrections(spark, sf):
    o, c = _corrections(spark, sf)
    c = c.filter("field = 'status'")
    k = F.col("record_id").cast("long")
    c = c.withColumn("old_value", F.when(k % 2 == 0, "?").otherwise(F.col("old_value"))).withColumn("source_hash", F.when(k % 5 == 0, "?").otherwise(F.col("source_hash"))).withColumn("contract_signature", F.when(k % 7 == 0, "v0").otherwise(F.col("contract_signature")))
    odd = t(spark, sf, "nation").selectExpr("concat('x', n_nationkey) as correction_id", "cast(-n_nationkey - 1 as string) as record_id", "if(n_nationkey % 2 = 0, 'contract_signature', 'nope') as field", "'' as old_value", "'' as new_value", "'' as source_hash", "'' as contract_signature")
    gone = spark.createDataFrame([("gone", "-999", "status", "", "", "", "")], odd.schema)
    return corrections.stale(o, c.unionByName(odd).unionByName(gone), "id", "source_sha256", "contract_signature")


@query("""select case when o_orderkey % 2 = 0 then 'status' || o_orderkey end as correction_id, cast(o_orderkey as varchar) as record_id, case when o_orderkey % 2 = 0 then 'other values' else 'not in the ledger' end as problem from orders where o_orderkey % 3 = 0 union all select 'extra', '-1', 'not applied'""")
def ledger_check(spark, sf):
    o, c = _corrections(spark, sf)
    c = c.filter("field = 'status'")
    after, ledger = corrections.apply_corrections(o, c, "id")
    told = ledger.filter("record_id % 2 = 0").withColumn("after", F.lit("else")).select("correction_id", "record_id", "field", "before", "after")
    told = told.unionByName(spark.createDataFrame([("extra", "-1", "status", "", "")], told.schema))
    return corrections.ledger_mismatches(told, o, after, "id", ["status", "priority"]).select("correction_id", "record_id", "problem")


@query("select conv_id, case when conv_id % 3 = 0 and conv_id % 2 = 0 then 1 else count(*) end as n from conversations group by 1")
def reviewed_pages(spark, sf):
    p = t(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list("text")).alias("records")).withColumn("source_sha256", F.sha2(F.col("conv_id").cast("string"), 256))
    r = p.filter("conv_id % 3 = 0").select("conv_id", F.expr("if(conv_id % 2 = 0, 'accepted', 'flagged')").alias("status"), "source_sha256", F.array(F.lit("one")).alias("records"))
    return corrections.apply_reviews(p, r, "conv_id", "records").select("conv_id", F.size("records").cast("long").alias("n"))


# ---------------------------------------------------------------- records


@query("""with o as (select o_orderkey, o_custkey, row_number() over (partition by o_custkey order by o_orderkey) as parent_index from orders where o_custkey % 10 <> 0)
select o_custkey, parent_index, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity) as child_index, l_partkey from o join lineitem on l_orderkey = o_orderkey""")
def two_level_flatten(spark, sf):
    li = t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))).alias("items"))
    o = t(spark, sf, "orders").join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "items"))).alias("orders"))
    return records.flatten_two(o, ["o_custkey"], "orders", "items", F.col("o_custkey") % 10 == 0)[1].select("o_custkey", "parent_index", "child_index", "l_partkey")


_RATES = {"input_tokens": 0.375, "output_tokens": 1.875, "thought_tokens": 1.875}


def _usage(spark, sf) -> DataFrame:
    return t(spark, sf, "orders").selectExpr("o_orderkey", "o_orderstatus", "cast(o_custkey as int) as input_tokens", "if(o_orderstatus = 'P' and o_orderkey % 2 = 0, null, cast(o_orderkey % 1000 as int)) as output_tokens", "cast(o_orderkey % 77 as int) as thought_tokens", "'ok' as status", "'' as error", "0 as total_tokens")


@query("""with u as (select o_orderstatus, o_custkey as i, case when o_orderstatus = 'P' and o_orderkey % 2 = 0 then null else o_orderkey % 1000 end as o, o_orderkey % 77 as th from orders)
select o_orderstatus, count(*) as results, count(*) filter (o is null) as unknown, cast(sum(i) filter (o is not null) as bigint) as input_tokens, cast(sum(o) as bigint) as output_tokens, cast(sum(th) filter (o is not null) as bigint) as thought_tokens,
case when count(*) filter (o is null) = 0 then round((sum(i) * 0.375 + sum(o) * 1.875 + sum(th) * 1.875) / 1e6, 9) end as cost from u group by 1""")
def token_accounting(spark, sf):
    return records.accounting(_usage(spark, sf), _RATES, ["o_orderstatus"]).withColumn("cost", F.round("cost", 9))


@query("select count(*) as basis, true as complete, round(avg((o_custkey * 0.375 + (o_orderkey % 1000) * 1.875 + (o_orderkey % 77) * 1.875) / 1e6) * 5335, 6) as projected from orders where o_orderstatus <> 'P'")
def cost_projection(spark, sf):
    return records.projected_cost(_usage(spark, sf).filter("o_orderstatus <> 'P'"), _RATES, 5335).withColumn("projected", F.round("projected", 6))


@query("select o_orderkey, o_orderpriority, case when o_orderkey % 4 = 0 then 'error' else 'ok' end as status, case when o_orderkey % 4 = 0 then 'no result' else '' end as error, case when o_orderkey % 4 = 0 then 0 else o_custkey end as input_tokens from orders")
def error_rows(spark, sf):
    results = _usage(spark, sf).filter("o_orderkey % 4 <> 0").drop("o_orderstatus", "output_tokens", "thought_tokens", "total_tokens")
    return records.with_errors(t(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), results, "o_orderkey").select("o_orderkey", "o_orderpriority", "status", "error", "input_tokens")


@query("""with e as (select l_orderkey as k, case when l_linenumber % 2 = 0 then 'ok' else 'error' end as status, l_linenumber as attempt, l_partkey from lineitem where l_suppkey % 8 <> 0), r as (select *, row_number() over (partition by k order by status = 'ok' desc, attempt desc, l_partkey) as n from e)
select k, status, attempt from r where n = 1""")
def cache_precedence(spark, sf):
    e = t(spark, sf, "lineitem").selectExpr("l_orderkey as k", "if(l_linenumber % 2 = 0, 'ok', 'error') as status", "l_linenumber as attempt", "'s' as source", "if(l_suppkey % 8 = 0, 't', 's') as current_source")
    return records.cached(e, "k", ["source"]).select("k", "status", "attempt")


def _artifacts(spark, sf) -> DataFrame:
    a = t(spark, sf, "events").selectExpr("event_type as group", "cast(event_id % 300 as int) as page", "concat('f', event_id) as file", """if(event_id % 13 = 0, 'oops', concat('{"model":"m', event_id % 3, '"}')) as body""")
    m = t(spark, sf, "nation").selectExpr("explode(sequence(n_nationkey * 10, n_nationkey * 10 + 9)) as page").crossJoin(F.broadcast(spark.createDataFrame([("click",), ("view",)], "group string"))).selectExpr("group", "cast(page as int) as page", "concat(group, '-', page) as page_id")
    return records.mapped_artifacts(a, m)


@query("""with a as (select event_type as g, event_id % 300 as page, event_id % 13 = 0 as bad, event_id % 3 as model, event_type in ('click', 'view') and event_id % 300 < 250 as mapped from events)
select g as "group", count(*) filter (not bad) as json, count(*) filter (bad) as error, count(*) filter (mapped) as mapped, count(*) filter (not mapped) as unmapped, (select count(*) from (select page from a b where b.g = a.g and mapped group by page having count(*) > 1)) as collisions,
count(*) filter (not bad and model = 0) as m0 from a group by g""")
def artifact_groups(spark, sf):
    return records.artifact_counts(_artifacts(spark, sf)).select("group", "json", "error", "mapped", "unmapped", "collisions", F.col("models")["m0"].alias("m0"))


@query("""with f as (select 'k' || (s_suppkey % 40) as key, s_suppkey % 3 as rank, 'r' || (s_suppkey % 3) || '/' || s_suppkey as path, md5(cast(s_suppkey % 5 as varchar)) as sha256 from supplier), w as (select 'k' || i as key, md5(cast(i % 5 as varchar)) as sha256 from range(50) r(i))
select key, (select path from f where f.key = w.key and f.sha256 = w.sha256 order by rank, path limit 1) as path from w""")
def first_root(spark, sf):
    f = t(spark, sf, "supplier").selectExpr("concat('k', s_suppkey % 40) as key", "s_suppkey % 3 as rank", "concat('r', s_suppkey % 3, '/', s_suppkey) as path", "md5(cast(s_suppkey % 5 as string)) as sha256")
    w = spark.range(50).selectExpr("concat('k', id) as key", "md5(cast(id % 5 as string)) as sha256")
    return records.first_matching(f, w, "key", "sha256").select("key", "path")


def _page_records(spark, sf) -> tuple[DataFrame, DataFrame]:
    inv = t(spark, sf, "nation").selectExpr("n_name as source", "cast(3 + n_nationkey % 4 as int) as page_count", "sha2(n_name, 256) as source_sha256", "if(n_nationkey % 5 = 0, 'selected', '') as final_type")
    texts = t(spark, sf, "customer").join(t(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("source"), (F.col("c_custkey") % 3 + 1).cast("int").alias("page")).agg(F.min("c_mktsegment").alias("text"))
    over = inv.filter("page_count > 4").selectExpr("source", "2 as page", "'excluded' as decision", "source_sha256")

    def classify(text):
        hits = F.filter(F.array(*map(F.lit, ["AUTO", "BUILD"])), lambda w: F.coalesce(text, F.lit("")).contains(w))
        return F.struct(F.when(F.size(hits) > 0, "selected").otherwise("flagged").alias("classification"), F.size(hits).alias("score"), F.array_join(hits, ";").alias("reasons"))

    return records.page_records(inv, texts, over, classify), inv


_PAGE_RECORDS = """iv as (select n_name as source, 3 + n_nationkey % 4 as page_count, case when n_nationkey % 5 = 0 then 'selected' else '' end as ft, n_nationkey from nation), px as (select iv.*, unnest(range(1, page_count + 1)) as page from iv),
tx as (select c_nationkey, c_custkey % 3 + 1 as page, min(c_mktsegment) as text from customer group by 1, 2),
pr as (select source, px.page, case when text is null then 'missing' when text like '%AUTO%' or text like '%BUILD%' then 'selected' else 'flagged' end as classification, case when page_count > 4 and px.page = 2 then 'excluded' when ft <> '' then ft else 'unreviewed' end as final_type, case when page_count > 4 and px.page = 2 then 'page' when ft <> '' then 'source' else 'default' end as decided_by
from px left join tx on c_nationkey = n_nationkey and tx.page = px.page)"""


@query(f"with {_PAGE_RECORDS} select * from pr")
def page_records(spark, sf):
    return _page_records(spark, sf)[0].select("source", "page", "classification", "final_type", "decided_by")


@query(f"with {_PAGE_RECORDS} select n_name as source, 'pages are not 1..n' as problem from nation where n_nationkey % 3 = 0 union all select distinct source, 'a page has no valid type' from pr join nation on n_name = source where final_type = 'unreviewed' and not (n_nationkey % 3 = 0 and page = 2)")
def extraction_gate(spark, sf):
    r, _ = _page_records(spark, sf)
    some = t(spark, sf, "nation").filter("n_nationkey % 3 = 0").select(F.col("n_name").alias("_n"))
    gone = r.join(some, (F.col("source") == F.col("_n")) & (F.col("page") == 2), "left_anti")
    return records.not_ready(gone, ["selected", "excluded"])


@query("select n_name as source, case when n_nationkey % 4 = 0 then 'no pages' when n_nationkey % 4 = 1 then 'hash' else 'page count' end as problem from nation where n_nationkey % 4 <> 3")
def source_currency(spark, sf):
    r, inv = _page_records(spark, sf)
    k = t(spark, sf, "nation").selectExpr("n_name as _name", "n_nationkey % 4 as k")
    r = r.join(k, F.col("source") == F.col("_name")).filter("k <> 0 and not (k = 2 and page = 1)").drop("_name", "k")
    inv = inv.join(k, F.col("source") == F.col("_name")).withColumn("source_sha256", F.when(F.col("k") == 1, "x").otherwise(F.col("source_sha256")))
    return records.not_current(r, inv)


@query(f"with {_PAGE_RECORDS}, e as (select source, case when page = 1 then 'selected' else final_type end as ty from pr) select source, count(*) as pages, count(*) filter (ty <> 'unreviewed') as resolved, count(*) filter (ty = 'unreviewed') as unresolved from e group by 1")
def review_progress(spark, sf):
    r, inv = _page_records(spark, sf)
    d = inv.selectExpr("source", "1 as page", "'flagged' as decision", "1 as at").unionByName(inv.selectExpr("source", "1 as page", "'selected' as decision", "2 as at"))
    return records.progress(records.effective_types(r, d))


@query("select c_custkey, 'stored' as only_in from customer where c_custkey % 20 = 1 union all select c_custkey, 'current' from customer where c_custkey % 20 = 2")
def changed_selection(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey")
    return records.changed_selection(c.filter("c_custkey % 20 <> 2"), c.filter("c_custkey % 20 <> 1"))


@query("""select s_suppkey, case when s_suppkey % 7 = 0 then 'failed' when s_suppkey % 5 = 0 and s_suppkey % 2 = 0 then 'manual_required' when s_suppkey % 5 = 0 then 'missing' when s_suppkey % 3 = 0 then 'downloaded' when s_suppkey % 11 = 0 then 'failed' else 'valid_existing' end as status from supplier""")
def acquisition_status(spark, sf):
    s = t(spark, sf, "supplier").selectExpr("s_suppkey", "if(s_suppkey % 7 = 0, 'boom', null) as error", "s_suppkey % 2 = 0 as manual", "if(s_suppkey % 5 = 0, null, 'a') as found_sha256", "if(s_suppkey % 3 = 0, null, if(s_suppkey % 11 = 0, 'b', 'a')) as expected_sha256")
    return records.acquired(s).select("s_suppkey", "status")


@query("""with p as (select p_partkey, cast(greatest(1, ceil(p_size / 20.0)) as integer) as n from part), b as (select p_partkey, n, unnest(range(0, n)) as segment from p)
select p_partkey, segment, round(greatest(0, segment / n - 0.05), 9) as top, round(least(1, (segment + 1) / n + 0.05), 9) as bottom from b""")
def alternate_requests(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", records.segments(F.col("p_size"), 20).alias("n"))
    return records.requests(p, "p_partkey", "n", "s1").select("p_partkey", "segment", F.round("top", 9).alias("top"), F.round("bottom", 9).alias("bottom"))


@query("""select o_orderkey, 'other value' as problem, 'status' as detail from orders where o_orderkey % 9 = 0 union all select o_orderkey, 'index is missing', 'items:9' from orders where o_orderkey % 10 = 1 union all select o_orderkey, 'page is not expected', '' from orders where o_orderkey % 9 <> 0 and o_orderkey % 10 <> 1 and o_orderkey % 4 <> 0 union all select -1, 'page is missing', 'status'""")
def gold_comparison(spark, sf):
    r = t(spark, sf, "orders").selectExpr("o_orderkey", "o_orderstatus as status", "array(1, 2) as items")
    gold = r.filter("o_orderkey % 9 = 0").selectExpr("o_orderkey", "'status' as field", "cast(null as int) as index", "concat(status, '?') as expected").unionByName(r.filter("o_orderkey % 10 = 1").selectExpr("o_orderkey", "'items' as field", "9 as index", "'1' as expected"))
    gold = gold.unionByName(r.filter("o_orderkey % 4 = 0").selectExpr("o_orderkey", "'items' as field", "2 as index", "'2' as expected"))
    gold = gold.unionByName(spark.createDataFrame([(-1, "status", None, "F")], gold.schema))
    return records.gold_mismatches(r, gold, "o_orderkey")


@query("select 'n' || n_nationkey as source, 'part' || (n_nationkey % 2) as part, page, page - 2 as part_page from (select n_nationkey, unnest(range(3, 8 + n_nationkey % 3)) as page from nation where n_nationkey % 6 not in (1, 2, 3))")
def mapped_ranges(spark, sf):
    m = t(spark, sf, "nation").selectExpr("concat('n', n_nationkey) as source", "case n_nationkey % 6 when 1 then 'xpart' when 2 then '' when 3 then 'missing' else concat('part', n_nationkey % 2) end as part", "3 as start", "cast(7 + n_nationkey % 3 as int) as end", "2 as offset")
    return scans.expanded_ranges(m)


@query("select n_name as edition, case when n_nationkey % 4 = 0 then 'x' || n_nationkey else 'own' end as source, case when n_nationkey % 4 = 0 then 'crosswalk' else 'recovered' end as source_origin from nation where n_nationkey % 5 <> 0")
def configured_editions(spark, sf):
    n = t(spark, sf, "nation")
    e = n.selectExpr("n_name as edition", "if(n_nationkey % 4 = 0, '', 'own') as source", "if(n_nationkey % 5 = 0, 'placeholder', 'configured') as status")
    return scans.configured(e, n.filter("n_nationkey % 4 = 0").selectExpr("n_name as edition", "concat('x', n_nationkey) as source"))


@query("select n_name as name, 'w' || n_nationkey as identifier from nation where n_nationkey % 2 = 1")
def prompt_identifiers(spark, sf):
    p = t(spark, sf, "nation").selectExpr("n_name as name", "concat('use `name` and `w', n_nationkey, '`, or `yes`') as text")
    return scans.unknown_identifiers(p, ["name", *[f"w{k}" for k in range(0, 26, 2)]], ["yes"])


@query("""select o_custkey, sha256(string_agg('{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}', chr(10) order by o_orderkey)) as signature from orders group by 1""")
def page_signature(spark, sf):
    return records.ordered_signature(t(spark, sf, "orders"), "o_orderkey", ["o_orderkey", "o_orderstatus"], ["o_custkey"])


@query("select coalesce(a.k, b.k) as k, coalesce(n_left, 0) as n_left, coalesce(n_right, 0) as n_right from (select o_custkey as k, count(*) as n_left from orders group by 1) a full join (select c_custkey as k, count(*) as n_right from customer where c_custkey % 2 = 0 group by 1) b on a.k = b.k")
def outer_support(spark, sf):
    return records.outer_support(t(spark, sf, "orders").withColumnRenamed("o_custkey", "k"), t(spark, sf, "customer").filter("c_custkey % 2 = 0").withColumnRenamed("c_custkey", "k"), "k")


@query("select c_custkey, coalesce(c_name, '') as c_name, case when c_custkey % 3 = 0 then 1 else 0 end as flag, round(c_acctbal * (case when c_custkey % 2 = 0 then 1000 else 1 end), 2) as balance from customer")
def normalized_records(spark, sf):
    c = t(spark, sf, "customer").selectExpr("c_custkey", "c_name", "c_custkey % 3 = 0 as flag", "cast(c_acctbal as decimal(18,2)) as balance", "if(c_custkey % 2 = 0, 1000, null) as unit")
    return records.normalized(c, "unit", ["balance"]).select("c_custkey", "c_name", "flag", F.round(F.col("balance").cast("double"), 2).alias("balance"))


@query("select c_custkey, concat_ws(' — ', nullif(case when c_custkey % 3 = 0 then '' else c_name end, ''), c_mktsegment) as title, c_custkey % 2 = 0 as changed from customer")
def lineage_titles(spark, sf):
    c = t(spark, sf, "customer").selectExpr("c_custkey", "if(c_custkey % 3 = 0, '', c_name) as a", "c_mktsegment as b", "'old' as source_sha256")
    now = c.filter("c_custkey % 2 = 0").select("c_custkey", F.lit("new").alias("source_sha256"))
    return records.with_lineage(c, now, "c_custkey", ["source_sha256"]).select("c_custkey", records.title("a", "b").alias("title"), (F.col("source_sha256") == "new").alias("changed"))


# ---------------------------------------------------------------- draws, checked by brute force in the tests


@query()
def round_robin_sample(spark, sf):
    rows = t(spark, sf, "documents").select("lang", "source", F.md5(F.col("source")).alias("h")).filter("lang is not null and source is not null").distinct()
    names = sorted(r[0] for r in rows.select("lang").distinct().collect())
    return selection.round_robin(rows, names, "lang", "source", "h", 12)


@query()
def matched_controls(spark, sf):
    p = t(spark, sf, "part").selectExpr("p_partkey as key", "p_size as records", "p_partkey % 6 as year", "p_partkey % 2 + 1 as edition", "p_partkey % 3 as part")
    return selection.matched_controls(p.filter("records = 50"), p.filter("records < 50"), "key", "key", 50)


__all__ = ["ORACLES", "gates", "money", "ranking"]
