"""Joins beyond equality: as-of, interval, overlays, reconciliation, ledgers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leafwork.operators.ranking import rank_all

def as_of(left: DataFrame, right: DataFrame, by: list[str], key: str, take: Sequence[str], backward: bool = True, tie: Sequence[str] = ()) -> DataFrame:
    """`left` with `take` of the nearest row of `right` in the same group: the last with a smaller key, or, forward, the
    first with a key not smaller. Both sides are one sorted stream by group, so no pair of rows is formed."""
    marks = [F.col(c).alias(f"_{c}") for c in take]
    l = left.select(*left.columns, *[F.lit(None).cast(dict(right.dtypes)[c]).alias(f"_{c}") for c in take], F.lit(0).alias("_anchor"))
    missing = [F.lit(None).cast(t).alias(c) for c, t in left.dtypes if c not in (*by, key)]
    r = right.select(*by, key, *missing, *marks, F.lit(1).alias("_anchor")).select(*l.columns)
    both = l.unionByName(r)
    sort = [F.col(key), F.col("_anchor"), *[F.col(f"_{c}") for c in tie]]
    if not backward:
        sort = [F.col(key).desc(), F.col("_anchor").desc(), *[F.col(f"_{c}").desc() for c in tie]]
    w = Window.partitionBy(*by).orderBy(*sort).rowsBetween(Window.unboundedPreceding, -1)
    found = F.last(F.when(F.col("_anchor") == 1, F.struct(*[f"_{c}" for c in take])), ignorenulls=True).over(w)
    return both.withColumn("_found", found).filter("_anchor = 0").select(*left.columns, *[F.col(f"_found._{c}").alias(f"{'prev' if backward else 'next'}_{c}") for c in take])


def interval_join(points: DataFrame, ranges: DataFrame, by: list[str], at: str, start: str, end: str, how: str = "inner", width: int | None = None) -> DataFrame:
    """Points in the ranges of their group, all matches; a range without start and end is the whole group. `how` is inner,
    or left: then points in no range stay, with nulls.

    With `width`, points and ranges meet by bucket of that width, for groups with many ranges; without, by group. Spark
    broadcasts the ranges if they are small enough.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how is inner or left, not {how}")
    r = ranges.withColumnRenamed(start, "_start").withColumnRenamed(end, "_end").withColumnsRenamed({c: f"_by_{c}" for c in by})
    same = [F.col(c) == F.col(f"_by_{c}") for c in by]
    inside = F.col("_start").isNull() | F.col(at).between(F.col("_start"), F.col("_end"))
    ours = [f"_by_{c}" for c in by]
    if width is None:
        found = points.join(r, [*same, inside]).drop(*ours)
    else:
        spread = r.filter("_start is not null").withColumn("_rb", F.explode(F.sequence(F.floor(F.col("_start") / width), F.floor(F.col("_end") / width))))
        near = points.withColumn("_pb", F.floor(F.col(at) / width)).join(spread, [*same, F.col("_pb") == F.col("_rb"), inside]).drop("_pb", "_rb", *ours)
        found = near.unionByName(points.join(r.filter("_start is null"), same).drop(*ours))
    if how == "left":  # whether a point has a match depends on its group and place alone
        hit = found.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col(at).alias("_at")).distinct()
        found = found.unionByName(points.join(hit, [*same, F.col(at) == F.col("_at")], "left_anti"), allowMissingColumns=True)
    return found


def overlay(df: DataFrame, changes: DataFrame, key: str, fields: Sequence[str], field: str = "field", old: str = "old", new: str = "new") -> DataFrame:
    """`df` with the replacement of each (key, field) in `changes` whose old value still stands; others are left out, which
    corrections.apply_corrections refuses to do. Of several for one field the greatest counts. All values are text."""
    wide = changes.groupBy(key).pivot(field, list(fields)).agg(F.max(F.struct(old, new)))
    joined = df.join(wide.select(F.col(key).alias("_key"), *[F.col(f).alias(f"_{f}") for f in fields]), F.col(key) == F.col("_key"), "left")
    pick = {f: F.when(F.col(f"_{f}.{old}").eqNullSafe(F.col(f)) & F.col(f"_{f}").isNotNull(), F.col(f"_{f}.{new}")).otherwise(F.col(f)) for f in fields}
    return joined.select(*[pick.get(c, F.col(c)).alias(c) for c in df.columns])


def differences(before: DataFrame, after: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """key, field, before, after and change (added, removed, changed) of two versions, all values as text."""
    melt = lambda df, name: df.selectExpr(key, "stack({}, {}) as (field, {})".format(len(fields), ", ".join(f"'{f}', cast({f} as string)" for f in fields), name))
    a, b = melt(before, "before").withColumn("_a", F.lit(1)), melt(after, "after").withColumn("_b", F.lit(1))
    rows = a.join(b, [key, "field"], "full_outer").filter(~(F.col("before").eqNullSafe(F.col("after")) & F.col("_a").isNotNull() & F.col("_b").isNotNull()))
    return rows.select(key, "field", "before", "after", F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").otherwise("changed").alias("change"))


def upsert(base: DataFrame, updates: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of `base`, updated where `updates` has their key, and after them its new keys, numbered on from the greatest
    `order`. Existing rows keep their order; new ones are numbered in the order of their keys, without a one-task window."""
    values = [c for c in base.columns if c not in (key, order)]
    u = updates.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in values])
    kept = base.join(u, F.col(key) == F.col("_k"), "left").select(*[F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) if c in values else F.col(c) for c in base.columns])
    last = base.agg(F.coalesce(F.max(order), F.lit(0))).first()[0]
    fresh = rank_all(updates.join(base.select(key), key, "left_anti"), [F.col(key)], "_new")
    fresh = fresh.withColumn(order, (F.col("_new") + last).cast(dict(base.dtypes)[order])).drop("_new")
    return kept.unionByName(fresh.select(*base.columns))


def prefer(df: DataFrame, layers: Sequence[tuple[DataFrame, str, str]], default: str) -> DataFrame:
    """`df` with decision and decided_by: the first layer (table, key, decision column) that has one, else `default`."""
    value, source = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k, (layer, key, column) in enumerate(layers):
        df = df.join(layer.select(F.col(key).alias(f"_k{k}"), F.col(column).alias(f"_v{k}")), F.col(key) == F.col(f"_k{k}"), "left")
        value, source = F.coalesce(value, F.col(f"_v{k}")), F.coalesce(source, F.when(F.col(f"_v{k}").isNotNull(), F.lit(key)))
    return df.withColumn("decision", F.coalesce(value, F.lit(default))).withColumn("decided_by", F.coalesce(source, F.lit("default"))).drop(*[f"_{x}{k}" for k in range(len(layers)) for x in "kv"])


def identity_drift(left: DataFrame, right: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """key and status: unknown (right only), missing (left only) or drift (a field differs)."""
    r = right.select(F.col(key).alias("_k"), *[F.col(f).alias(f"_{f}") for f in fields])
    rows = left.join(r, F.col(key) == F.col("_k"), "full_outer")
    same: Column = F.lit(True)
    for f in fields:
        same = same & F.col(f).eqNullSafe(F.col(f"_{f}"))
    status = F.when(F.col(key).isNull(), "unknown").when(F.col("_k").isNull(), "missing").when(~same, "drift")
    return rows.select(F.coalesce(F.col(key), F.col("_k")).alias(key), status.alias("status")).filter("status is not null")
