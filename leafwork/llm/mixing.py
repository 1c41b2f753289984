"""Mixing sources to target weights by systematic sampling.

Each document of a source has the same expected number of copies, target over source size. Laid end to end within the
source, these expectations are a line; the source's random offset places marks at distance one, and a document is taken
once per mark within its stretch. The line goes up through the even sizes and down through the odd ones, then by bucket
and doc_id. So the marks spread over all sizes, and what the offset adds on the way up it takes off on the way down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwork.llm.common import materialize, table, word_count

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
_LINE = "if(size % 2 = 0, size, 1099511627776 - size)"
#: Documents of one source and size that one task ranks, about.
BUCKET_ROWS = 20_000
LEAST_BUCKETS = 16


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Each source's target from (source, source_size): one row per source, all in one window.

    Weights go round the sources by code point, null last. Resharing the excess of stopped sources until none is above
    its limit gives every source min(limit, weight * level) for one level. Sorted by limit per weight, the sources
    stopped are a prefix. The level that a prefix would give rises as long as its next source must stop too, and falls
    from there on, so the level wanted is the greatest of all.
    """
    w = "array(" + ", ".join(f"{float(x)}D" for x in weights) + ")"
    ranked = sizes.selectExpr("source", "source_size", f"{w}[pmod(row_number() over (order by source asc nulls last) - 1, {len(weights)})] as _weight")
    limits = ranked.selectExpr("*", f"cast({most} * source_size as double) as _limit", "cast(sum(source_size) over () as double) as _all")
    order = "over (order by _limit / _weight, source nulls last rows between"
    sums = limits.selectExpr("*", f"coalesce(sum(_limit) {order} unbounded preceding and 1 preceding), 0D) as _stopped", f"sum(_weight) {order} current row and unbounded following) as _open")
    levels = sums.selectExpr("*", "(_all - _stopped) / _open as _level")
    level = levels.selectExpr("*", "max(_level) over () as _top")
    return level.selectExpr("source", "source_size", "least(_limit, _top * _weight) as target")


def offset(source: Column, seed: int) -> Column:
    """The source's random offset, at least 0 and below 1."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), source), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / 4294967296.0


def mix(docs: DataFrame, seed: int = 7, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """`docs` (doc_id, source and size, long) with source_size, target (double) and copies (long).

    Null sources are one source, the last. A source whose documents are all empty has target 0 and takes none. Repeated
    rows are ranked each; among equal ones which gets the extra copy is arbitrary, how many do is not. The hot source
    is ranked by (source, size, bucket), so no task orders a whole source. Columns of `docs` that clash are replaced.
    """
    own = [c for c in docs.columns if c not in {"source_size", "target", "copies"}]
    n = docs.count()
    buckets = max(LEAST_BUCKETS, n // BUCKET_ROWS)
    key = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 8)
    dealt = docs.select(*[f"`{c}`" for c in own], (F.conv(key, 16, 10).cast("long") % F.lit(buckets)).alias("_bucket"))
    sizes = dealt.groupBy("source", "size", "_bucket").agg(F.count("*").alias("_n"))
    by_size = sizes.groupBy("source", "size").agg(F.sum("_n").alias("_m"))
    target = targets(by_size.groupBy("source").agg(F.sum(F.col("size") * F.col("_m")).alias("source_size")), weights, most)
    ahead = "rows between unbounded preceding and 1 preceding"
    size_ahead = by_size.selectExpr("source", "size", f"coalesce(sum(_m) over (partition by source order by {_LINE} {ahead}), 0) as _before_size")
    bucket_ahead = sizes.selectExpr("source", "size", "_bucket", f"coalesce(sum(_n) over (partition by source, size order by _bucket {ahead}), 0) as _before_bucket")
    a, b, t = bucket_ahead.alias("a"), size_ahead.alias("b"), target.alias("t")
    starts = (
        a.join(b, F.expr("a.source <=> b.source and a.size = b.size"))
        .join(t, F.expr("a.source <=> t.source"))
        .selectExpr("a.source as _source", "a.size as _size", "a._bucket as _b", "_before_size + _before_bucket as _before", "source_size", "target", "case when source_size > 0 then target / source_size else 0D end as _rate")
        .withColumn("_offset", offset(F.col("_source"), seed))
    )
    ranked = dealt.selectExpr("*", "row_number() over (partition by source, size, _bucket order by doc_id) - 1 as _local")
    joined = ranked.join(starts, F.expr("source <=> _source and size = _size and _bucket = _b"))
    rank = "(_before + _local)"
    return joined.select(*[f"`{c}`" for c in own], "source_size", "target", F.expr(f"cast(floor(_rate * ({rank} + 1) + _offset) - floor(_rate * {rank} + _offset) as long)").alias("copies"))


def copied(docs: DataFrame, size: Column, **options) -> DataFrame:
    """Each row of `docs`, with its columns alone, as often as the mix takes it; only doc_id, source and sizes are mixed.

    Rows that agree in doc_id, source, text and size share what the mix gives them: as evenly as it goes.
    """
    narrow = docs.select("doc_id", "source", size.alias("size"), F.xxhash64("text").alias("h"))
    mixed = mix(narrow, **options).groupBy("doc_id", "source", "size", "h").agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows"))
    found = materialize(mixed.filter("_copies > 0").selectExpr("doc_id as _d", "source as _s", "size as _z", "h as _h", "_copies", "_rows"), "copies")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_doc"), F.col("source").alias("_source"), size.alias("_size"), F.xxhash64("text").alias("_text"))
    same = F.expr("_doc <=> _d and _source <=> _s and _size = _z and _text = _h")
    once, again = found.filter("_rows = 1"), found.filter("_rows > 1")
    out = rows.join(once, same).selectExpr("_row", "explode(sequence(1L, _copies)) as _copy").select("_row")
    if not again.isEmpty():
        shared = rows.join(again, same).selectExpr("_row", "_copies", "_rows", "row_number() over (partition by _d, _s, _z, _h order by _h) - 1 as _place")
        taken = shared.selectExpr("_row", "_copies div _rows + if(_place < _copies % _rows, 1, 0) as _n").filter("_n > 0")
        out = out.union(taken.selectExpr("_row", "explode(sequence(1L, _n)) as _copy").select("_row"))
    return out.select("_row.*")


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    """What the mix takes of each document; a null text has size 0, a null source is the last, repeated rows count each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mix(docs).selectExpr("doc_id", "size", "source_size", "target", "copies * size as taken")


OP7_SQL = r"""
with d as (
  select doc_id, source, cast(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) as bigint) as size
  from documents),
k as (select *, cast('0x' || substr(md5(cast(doc_id as varchar)), 1, 8) as bigint) % (select greatest(16, count(*) // 20000) from d) as bucket from d),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
w as (select *, [5.0::double, 2.0::double, 1.0::double][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight from s),
l as (select *, cast(3 * source_size as double) as lim, cast(sum(source_size) over () as double) as total from w),
c as (
  select *, (total - coalesce(sum(lim) over (order by lim / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by lim / weight, source nulls last rows between current row and unbounded following) as lev from l),
t as (select source, source_size, least(lim, top * weight) as target from (select *, max(lev) over () as top from c)),
r as (select *, row_number() over (partition by source order by case when size % 2 = 0 then size else 1099511627776 - size end, bucket, doc_id) - 1 as k from k),
j as (
  select doc_id, size, source_size, target, k, case when source_size > 0 then target / source_size else 0 end as rate,
    cast(cast('0x' || substr(md5('7:' || coalesce('=' || r.source, 'null')), 1, 8) as bigint) as double) / 4294967296.0 as off
  from r join t on r.source is not distinct from t.source)
select doc_id, size, source_size, target, cast(floor(rate * (k + 1) + off) - floor(rate * k + off) as bigint) * size as taken from j
"""
