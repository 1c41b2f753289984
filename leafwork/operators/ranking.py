"""From evidence signals to a capped selection: rollups, ranks, samples, controls, calibration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leafwork.functions.exprs import wilson


def rollup(signals: DataFrame, unit: str) -> DataFrame:
    """By unit the counts over its signals (rule, family, tier, entity, magnitude, localized). Localized signals of tier
    3 or less count; without any, the localized ones; without these, all."""
    grade = F.when(F.col("localized") & (F.col("tier") <= 3), 1).when(F.col("localized"), 2).otherwise(3)
    # The unit's best grade first, so distinct counts are taken once; window and groups share one exchange.
    w = Window.partitionBy(unit)
    rows = signals.withColumn("_grade", grade).select("*", F.min("_grade").over(w).alias("_best"), F.count("*").over(w).alias("_all"))
    here = F.col("_grade") <= F.col("_best")
    distinct = [F.countDistinct(F.when(here, F.col(c))).alias(n) for c, n in (("rule", "rules"), ("family", "families"), ("entity", "entities"))]
    return rows.groupBy(unit).agg(F.first("_all").alias("n_signals"), *distinct, F.min(F.when(here, F.col("tier"))).alias("tier"), F.max(F.when(here, F.col("magnitude"))).alias("magnitude"))


def priority(rolled: DataFrame, unit: str) -> DataFrame:
    """A total order: tier, then families, rules, entities and magnitude downwards, then the unit."""
    order = [F.col("tier").asc(), F.col("families").desc(), F.col("rules").desc(), F.col("entities").desc(), F.col("magnitude").desc_nulls_last(), F.col(unit).asc()]
    return rank_all(rolled, order, "page_rank")


def rank_all(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Ranks 1..n over all rows without a one-task window: rows are range-partitioned in order, ranked by partition, and
    the partitions' sizes, one row each, are summed up."""
    placed = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    placed = placed.persist()
    before = placed.groupBy("_part").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_part", "_before")
    local = placed.withColumn("_local", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return local.join(F.broadcast(before), "_part").withColumn(name, (F.col("_before") + F.col("_local")).cast("long")).drop("_part", "_before", "_local")


def evidence_hash(signals: DataFrame, by: list[str], member: str) -> DataFrame:
    """A hash of the sorted member hashes of each group; members of a unit are few."""
    return signals.groupBy(*by).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(member)), ","), 256).alias("evidence_hash"))


def calibration(labels: DataFrame, stratum: str, outcome: str, least_n: int, least_p: float, least_low: float) -> DataFrame:
    """By stratum the confirmed and rejected labels, precision, Wilson's bounds and whether the gate opens."""
    rows = labels.groupBy(stratum).agg(F.count_if(F.col(outcome) == 1).alias("confirmed"), F.count_if(F.col(outcome) == 0).alias("rejected"))
    n = F.col("confirmed") + F.col("rejected")
    low, high = wilson(F.col("confirmed"), n)
    rows = rows.select(stratum, "confirmed", "rejected", (F.col("confirmed") / F.nullif(n, F.lit(0))).alias("precision"), low.alias("low"), high.alias("high"))
    gate = (F.col("confirmed") + F.col("rejected") >= least_n) & (F.col("precision") >= least_p) & (F.col("low") >= least_low)
    return rows.withColumn("gate", F.coalesce(gate, F.lit(False)))


def capped(ranked: DataFrame, rank: str, qualifies: Column, limit: int) -> DataFrame:
    """`ranked` with selected: the first `limit` qualifying rows by rank. Rows beyond the cap's rank need no running count."""
    last = ranked.filter(qualifies).orderBy(rank).limit(limit).agg(F.max(rank)).first()[0]
    return ranked.withColumn("selected", qualifies & (F.col(rank) <= F.lit(last if last is not None else -1)))
