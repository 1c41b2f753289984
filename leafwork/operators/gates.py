"""Gates return what violates them; the driver raises if that is not empty."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwork.functions.exprs import blank, to_float, truthy


class Violation(ValueError):
    """A gate found rows; the message names it and shows a few."""


def require_empty(name: str, rows: DataFrame, show: int = 3) -> None:
    found = rows.limit(show).collect()
    if found:
        raise Violation(f"{name}: {[r.asDict() for r in found]}")


def enforce(requests: int, workers: int, most_requests: int, most_workers: int, ramp: dict | None = None, review_age_hours: float | None = None, oldest_hours: float = 24) -> None:
    """A live run's limits: requests and workers, a ramp of trial requests without a failure, and a cost review that is recent."""
    wrong = [
        (not 0 < requests <= most_requests, f"{requests} requests, {most_requests} allowed"),
        (not 0 < workers <= most_workers, f"{workers} workers, {most_workers} allowed"),
        (ramp is not None and (not ramp.get("requests") or ramp.get("failed", 0) > 0), "the ramp has not succeeded"),
        (review_age_hours is None or not 0 <= review_age_hours <= oldest_hours, "the cost review is missing or old"),
    ]
    if told := [text for bad, text in wrong if bad]:
        raise Violation("; ".join(told))


def columns(df: DataFrame, required: list[str], exact: bool = False) -> None:
    if exact and df.columns != list(required):
        raise Violation(f"columns are {df.columns}, not {list(required)}")
    if missing := [c for c in required if c not in df.columns]:
        raise Violation(f"columns are missing: {missing}")


def not_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    return df.join(parent.select(F.col(parent_key).alias("_p")), F.col(key) == F.col("_p"), "left_anti")


def not_functional(df: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """Keys that map to more than one tuple of values."""
    v = F.struct(*values)
    return df.groupBy(*key).agg(F.min(v).alias("_lo"), F.max(v).alias("_hi")).filter(~F.col("_lo").eqNullSafe(F.col("_hi"))).select(*key)


def not_contiguous(df: DataFrame, group: list[str], index: str, first: int = 1) -> DataFrame:
    """Groups whose indexes are not first, first + 1, ... without repeats."""
    rows = df.groupBy(*group).agg(F.min(index).alias("lo"), F.max(index).alias("hi"), F.count("*").alias("n"), F.countDistinct(index).alias("d"))
    return rows.filter((F.col("lo") != first) | (F.col("hi") - F.col("lo") + 1 != F.col("n")) | (F.col("d") != F.col("n")))


# The words of failed extraction, and of pages without a decision.
FAILED = ("error", "failed", "missing", "unusable")
UNRESOLVED = ("unreviewed", "unresolved", "flagged", "stale", "missing")


def row_flags(df: DataFrame, record: str, keys: list[str] = (), provenance: list[str] = (), bounds: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """(record, check, field, observed) of the row checks. Which column holds a status is settled by which columns there
    are; all checks of a row come from one pass over it."""
    has = set(df.columns)
    first = lambda *names: next((n for n in names if n in has), None)
    made = []
    flag = lambda cond, check, field, observed: made.append(F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(check).alias("check"), F.lit(field).alias("field"), observed.cast("string").alias("observed"))))
    for k in keys:
        flag(blank(F.col(k)), "missing_key", k, F.col(k))
    for p in provenance:
        flag(blank(F.col(p)), "missing_provenance", p, F.col(p))
    if "identity_valid" in has:
        flag(~truthy(F.col("identity_valid")), "invalid_identity", "identity_valid", F.col("identity_valid"))
    if status := first("extraction_status", "status"):
        flag(F.lower(F.trim(status)).isin(*FAILED), "extraction_failure", status, F.col(status))
    if page := first("final_classification", "classification", "final_type"):
        flag(F.lower(F.trim(page)).isin(*UNRESOLVED), "unresolved_page", page, F.col(page))
    if "final_type" in has:
        flag(~blank(F.col("final_type")) & (F.lower(F.trim("final_type")) != "selected"), "invalid_page_selection", "final_type", F.col("final_type"))
    for field, (lo, hi) in (bounds or {}).items():
        number = to_float(F.col(field).cast("string"))
        flag(~blank(F.col(field)) & number.isNull(), "nonnumeric_bounded_value", field, F.col(field))
        flag((number < lo) | (number > hi), "out_of_bounds", field, F.col(field))
    if not made:
        return df.select(F.col(record).cast("string").alias("record"), F.lit("").alias("check"), F.lit("").alias("field"), F.lit("").alias("observed")).limit(0)
    return df.select(F.col(record).cast("string").alias("record"), F.explode(F.array_compact(F.array(*made))).alias("_f")).select("record", "_f.*")
