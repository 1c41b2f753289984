"""Nested records to rows and back: flattening, indexes, unions of schemas, merging of overlapping segments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten(df: DataFrame, keys: list[str], column: str, index: str = "record_index") -> DataFrame:
    """A row per element with its 1-based index and fields; a row without elements stays, with nulls."""
    rows = df.select(*keys, F.posexplode_outer(column).alias("_at", "_record"))
    return rows.select(*keys, (F.col("_at") + 1).alias(index), "_record.*")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows with the columns in the order in which they are first seen; absent ones are null."""
    names = list(dict.fromkeys(c for df in frames for c in df.columns))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).select(*names)


def merge_segments(rows: DataFrame, page: str, segment: str, anchor: str, value: str) -> tuple[DataFrame, DataFrame]:
    """Merged (page, anchor, value), and conflicts: anchors whose segments disagree, and neighbours without a common anchor."""
    merged = rows.groupBy(page, anchor).agg(F.min(value).alias(value), F.min(F.struct(value)).alias("_lo"), F.max(F.struct(value)).alias("_hi"))
    differ = merged.filter("_lo <> _hi").select(page, F.lit("overlap_disagreement").alias("conflict"), F.col(anchor).cast("string").alias("detail"))
    span = rows.groupBy(page).agg(F.min(segment).alias("_a"), F.max(segment).alias("_b")).filter("_b > _a").select(page, F.explode(F.expr("sequence(_a, _b - 1)")).alias("_s"))
    a, b = rows.select(F.col(page).alias("_pa"), F.col(segment).alias("_sa"), F.col(anchor).alias("_aa")), rows.select(F.col(page).alias("_pb"), (F.col(segment) - 1).alias("_sb"), F.col(anchor).alias("_ab"))
    shared = a.join(b, F.expr("_pa = _pb and _sa = _sb and _aa = _ab")).select(F.col("_pa").alias(page), F.col("_sa").alias("_s")).distinct()
    apart = span.join(shared, [page, "_s"], "left_anti").select(page, F.lit("no_shared_anchor").alias("conflict"), F.col("_s").cast("string").alias("detail"))
    return merged.filter("_lo = _hi").select(page, anchor, value), differ.unionByName(apart)
