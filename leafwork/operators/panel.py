"""Checks over entity-by-time panels: spines, gaps, jumps, reversals, shifts, coverage, entries and exits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leafwork.functions.exprs import sym_ratio

CLOSE = 1e-9


def _over(entity: list[str], t: str):
    return Window.partitionBy(*entity).orderBy(t)


def panel_gaps(df: DataFrame, entity: list[str], t: str, step: float = 1) -> DataFrame:
    """Rows whose predecessor of the same entity is more than one step back: gap_from, gap_to and the number missing."""
    rows = df.withColumn("gap_from", F.lag(t).over(_over(entity, t)))
    return rows.filter(F.col(t) - F.col("gap_from") > step + CLOSE).select(*entity, "gap_from", F.col(t).alias("gap_to"), (F.col(t) - F.col("gap_from")).alias("gap"))


def one_sided_jumps(df: DataFrame, entity: list[str], t: str, value: str, ratio: float) -> DataFrame:
    """Neighbouring rows whose values differ by a factor of at least `ratio`; a null value skips its pairs."""
    rows = df.withColumn("before", F.lag(value).over(_over(entity, t)))
    return rows.withColumn("ratio", sym_ratio(F.col("before"), F.col(value))).filter(F.col("ratio") >= ratio).select(*entity, t, "before", F.col(value).alias("after"), "ratio")


def isolated_reversals(df: DataFrame, entity: list[str], t: str, value: str, isolated: float, returned: float, step: float = 1) -> DataFrame:
    """Middle rows of three that are a step apart: the outer values agree within `returned`, the middle one is off their
    median by at least `isolated`."""
    w = _over(entity, t)
    rows = df.select(*entity, t, value, F.lag(t).over(w).alias("_t0"), F.lead(t).over(w).alias("_t2"), F.lag(value).over(w).alias("before"), F.lead(value).over(w).alias("after"))
    near = (F.abs(F.col(t) - F.col("_t0") - step) < CLOSE) & (F.abs(F.col("_t2") - F.col(t) - step) < CLOSE)
    ratio = sym_ratio(F.col(value), (F.col("before") + F.col("after")) / 2)
    return rows.filter(near).withColumn("ratio", ratio).filter((sym_ratio(F.col("before"), F.col("after")) <= returned) & (F.col("ratio") >= isolated)).select(*entity, t, "before", F.col(value).alias("middle"), "after", "ratio")


def persistent_shifts(df: DataFrame, entity: list[str], t: str, value: str, window: int, ratio: float, step: float = 1) -> DataFrame:
    """First rows of `window` rows whose median is off that of the `window` rows before by at least `ratio`; all rows
    must be a step apart and have a value."""
    w = _over(entity, t)
    both, before, after = w.rowsBetween(-window, window - 1), w.rowsBetween(-window, -1), w.rowsBetween(0, window - 1)
    rows = df.select(
        *entity, t,
        F.expr(f"percentile({value}, 0.5)").over(before).alias("before"), F.expr(f"percentile({value}, 0.5)").over(after).alias("after"),
        F.count(value).over(both).alias("_n"), F.min(t).over(both).alias("_lo"), F.max(t).over(both).alias("_hi"),
    )
    full = (F.col("_n") == 2 * window) & (F.abs(F.col("_hi") - F.col("_lo") - step * (2 * window - 1)) < CLOSE)
    return rows.filter(full).withColumn("ratio", sym_ratio(F.col("before"), F.col("after"))).filter(F.col("ratio") >= ratio).select(*entity, t, "before", "after", "ratio")


def spine(df: DataFrame, t: str, step: int = 1, limit: int = 100_000) -> DataFrame:
    """Every period from the first to the last, at most `limit`; the driver learns the two ends only."""
    lo, hi = df.agg(F.min(t), F.max(t)).first()
    if lo is not None and (hi - lo) / step + 1 > limit:
        raise ValueError(f"a spine of more than {limit} periods")
    spark = df.sparkSession
    return spark.range(0 if lo is None else int(lo), 0 if lo is None else int(hi) + 1, step).select(F.col("id").alias(t))


def coverage(df: DataFrame, entity: str, t: str, step: int = 1) -> DataFrame:
    """Distinct entities by period of the spine, 0 where there are none."""
    counts = df.groupBy(t).agg(F.countDistinct(entity).alias("n_entities"))
    return spine(df, t, step).join(counts.withColumnRenamed(t, "_t"), F.col(t) == F.col("_t"), "left").select(t, F.coalesce("n_entities", F.lit(0)).alias("n_entities"))


def coverage_changes(df: DataFrame, entity: str, t: str, least: float) -> DataFrame:
    """Observed periods whose distinct entities and those of the period before have a ratio, smaller to larger, below
    `least`. The window is over periods, one row each."""
    counts = df.groupBy(t).agg(F.countDistinct(entity).alias("n_entities"))
    rows = counts.withColumn("n_before", F.lag("n_entities").over(Window.orderBy(t)))
    ratio = F.least("n_entities", "n_before") / F.greatest("n_entities", "n_before")
    return rows.withColumn("ratio", ratio).filter(F.col("ratio") < least)


def entries_exits(df: DataFrame, entity: str, t: str) -> DataFrame:
    """Entities that enter and leave from one observed period to the next, counted without gathering any set."""
    seen = df.select(entity, t).distinct()
    order = seen.select(t).distinct().select(t, F.lag(t).over(Window.orderBy(t)).alias("_last"), F.lead(t).over(Window.orderBy(t)).alias("_next"))
    w = _over([entity], t)
    rows = seen.select(entity, t, F.lag(t).over(w).alias("_before"), F.lead(t).over(w).alias("_after")).join(F.broadcast(order) if order.count() <= 100_000 else order, t)
    entered = rows.filter(F.col("_last").isNotNull() & ~F.col("_before").eqNullSafe(F.col("_last"))).groupBy(t).agg(F.count("*").alias("n_entries"))
    left = rows.filter(F.col("_next").isNotNull() & ~F.col("_after").eqNullSafe(F.col("_next"))).groupBy(F.col("_next").alias("_t")).agg(F.count("*").alias("n_exits"))
    return order.filter("_last is not null").join(entered, t, "left").join(left, F.col(t) == F.col("_t"), "left").select(t, F.coalesce("n_entries", F.lit(0)).alias("n_entries"), F.coalesce("n_exits", F.lit(0)).alias("n_exits"))


def density_collapses(df: DataFrame, part: list[str], page: str, count: str, least: int, share: float) -> DataFrame:
    """Middle pages of three consecutive ones with both neighbours at `least` or more and at most `share` of the smaller."""
    w = _over(part, page)
    rows = df.select(*part, page, count, F.lag(page).over(w).alias("_p0"), F.lead(page).over(w).alias("_p2"), F.lag(count).over(w).alias("_c0"), F.lead(count).over(w).alias("_c2"))
    near = F.least("_c0", "_c2")
    hit = (F.col(page) - F.col("_p0") == 1) & (F.col("_p2") - F.col(page) == 1) & (F.col("_c0").isNotNull() & F.col("_c2").isNotNull()) & (near >= least) & (F.col(count) <= share * near)
    return rows.filter(hit).select(*part, page, count, near.alias("neighbors"), (near / F.greatest(F.col(count), F.lit(1))).alias("magnitude"))


def present_absent_present(df: DataFrame, entity: list[str], t: str) -> DataFrame:
    """Entities and periods t without a row though t - 1 and t + 1 have one."""
    keys = df.select(*entity, t).distinct()
    before, after = keys.withColumn(t, F.col(t) + 1), keys.withColumn(t, F.col(t) - 1)
    return before.join(after, [*entity, t]).join(keys, [*entity, t], "left_anti")


def two_sided_anomalies(df: DataFrame, entity: list[str], t: str, value: str, strong: float = 10, weak: float = 2) -> DataFrame:
    """Rows between neighbours exactly one step off with equal positive values: a missing middle, or one off by a factor
    of at least `strong`, or of at least `weak`."""
    w = _over(entity, t)
    rows = df.select(*entity, t, value, F.lag(t).over(w).alias("_t0"), F.lead(t).over(w).alias("_t2"), F.lag(value).over(w).alias("before"), F.lead(value).over(w).alias("after"))
    framed = (F.col(t) - F.col("_t0") == 1) & (F.col("_t2") - F.col(t) == 1) & (F.col("before") == F.col("after")) & (F.col("before") > 0)
    factor = F.when(F.col(value) > 0, F.greatest(F.col(value) / F.col("before"), F.col("before") / F.col(value)))
    kind = F.when(F.col(value).isNull(), "missing_middle").when(factor >= strong, "factor_strong").when(factor >= weak, "factor_weak")
    return rows.filter(framed).withColumn("factor", factor).withColumn("kind", kind).filter("kind is not null").select(*entity, t, value, "before", "factor", "kind")
