"""Corrections and reviews that reject what no longer fits, and the ledger of what they changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwork.operators.gates import Violation, not_unique, require_empty
from leafwork.operators.joins import differences


def _long(df: DataFrame, record: str, fields: Sequence[str]) -> DataFrame:
    """(record, field, value), all as text."""
    pairs = ", ".join(f"'{f}', cast(`{f}` as string)" for f in fields)
    return df.selectExpr(f"cast(`{record}` as string) as _record", f"stack({len(fields)}, {pairs}) as (_field, _value)")


def stale(df: DataFrame, corrections: DataFrame, record: str, source: str, contract: str, protected: Sequence[str] = ()) -> DataFrame:
    """correction_id and problem of each correction that can't be applied: a protected or unknown field, an unknown record,
    another old value, source hash or contract, or a second one for the same record and field."""
    fields = [c for c in df.columns if c not in {record, source, contract, *protected}]
    known = df.selectExpr(f"cast(`{record}` as string) as _r", f"cast(`{source}` as string) as _source", f"cast(`{contract}` as string) as _contract")
    c = corrections.join(known, F.col("record_id") == F.col("_r"), "left")
    wanted = corrections.select(F.col("record_id").alias("_record")).distinct()
    values = _long(df.join(wanted, F.col(record).cast("string") == F.col("_record"), "left_semi"), record, fields)
    c = c.join(values, (F.col("record_id") == F.col("_record")) & (F.col("field") == F.col("_field")), "left")
    again = not_unique(corrections, ["record_id", "field"]).select(F.col("record_id").alias("_ar"), F.col("field").alias("_af"))
    c = c.join(again, (F.col("record_id") == F.col("_ar")) & (F.col("field") == F.col("_af")), "left")
    differs = lambda a, b: ~F.coalesce(F.col(a), F.lit("")).eqNullSafe(F.coalesce(F.col(b), F.lit("")))
    problem = (
        F.when(F.col("field").isin(record, source, contract, *protected), "protected field")
        .when(~F.col("field").isin(*fields), "missing field")
        .when(F.col("_r").isNull(), "missing record")
        .when(F.col("_ar").isNotNull(), "repeated target")
        .when(differs("_value", "old_value"), "old value")
        .when(differs("_source", "source_hash"), "source hash")
        .when(differs("_contract", "contract_signature"), "contract signature")
    )
    return c.withColumn("problem", problem).filter("problem is not null").select("correction_id", "problem")


def apply_corrections(df: DataFrame, corrections: DataFrame, record: str, source: str = "source_sha256", contract: str = "contract_signature", protected: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """`df` with all corrections (correction_id, record_id, field, old_value, new_value, source_hash, contract_signature
    and more) applied, and the ledger of differences. One that can't be applied is a violation and nothing is applied.

    A record id that is blank or repeated is a violation too. Values are text; other types are cast back.
    """
    require_empty("a record has no id", df.filter(F.coalesce(F.trim(F.col(record).cast("string")), F.lit("")) == ""))
    require_empty("a record id is repeated", not_unique(df, [record]))
    require_empty("a correction is stale", stale(df, corrections, record, source, contract, protected))
    fields = [r[0] for r in corrections.select("field").distinct().collect()]  # at most the columns of df
    types = dict(df.dtypes)
    out = df
    if fields:
        # One row by record: a map of its corrected fields, so the table is joined once whatever the number of fields.
        wide = corrections.groupBy(F.col("record_id").alias("_record")).agg(F.map_from_entries(F.collect_list(F.struct("field", "new_value"))).alias("_new"))
        joined = df.join(wide, F.col(record).cast("string") == F.col("_record"), "left")
        new = {f: F.when(F.map_contains_key("_new", F.lit(f)), F.col("_new")[f].cast(types[f])).otherwise(F.col(f)) for f in fields}
        out = joined.select(*[new.get(c, F.col(c)).alias(c) for c in df.columns])
    extra = [c for c in corrections.columns if c not in ("correction_id", "record_id", "field", "old_value", "new_value")]
    ledger = corrections.select("correction_id", "record_id", "field", F.col("old_value").alias("before"), F.col("new_value").alias("after"), *extra)
    return out, ledger


def ledger_mismatches(ledger: DataFrame, before: DataFrame, after: DataFrame, record: str, fields: Sequence[str]) -> DataFrame:
    """Changes between two versions that the ledger doesn't have, and entries of the ledger that aren't there."""
    real = differences(before, after, record, fields).select(F.col(record).cast("string").alias("_r"), F.col("field").alias("_f"), F.col("before").alias("_b"), F.col("after").alias("_a"))
    both = ledger.select("correction_id", "record_id", "field", "before", "after").join(real, F.expr("record_id = _r and field = _f"), "full_outer")
    problem = F.when(F.col("record_id").isNull(), "not in the ledger").when(F.col("_r").isNull(), "not applied").when(~F.col("before").eqNullSafe(F.col("_b")) | ~F.col("after").eqNullSafe(F.col("_a")), "other values")
    return both.select("correction_id", F.coalesce("record_id", "_r").alias("record_id"), F.coalesce("field", "_f").alias("field"), problem.alias("problem")).filter("problem is not null")


def apply_reviews(pages: DataFrame, reviews: DataFrame, page: str, nested: str, source: str = "source_sha256") -> DataFrame:
    """`pages` with the nested records of accepted reviews (page, status, source hash, the nested column) in place of their own.

    A review of an unknown page, of a page whose source has changed, or a second one for a page is a violation.
    """
    require_empty("a page is reviewed twice", not_unique(reviews, [page]))
    r = reviews.select(F.col(page).alias("_page"), F.col("status").alias("_status"), F.col(source).alias("_source"), F.col(nested).alias("_nested"))
    unknown = r.join(pages.select(page), F.col("_page") == F.col(page), "left_anti")
    require_empty("a review is of an unknown page", unknown.select("_page"))
    both = pages.join(r, F.col(page) == F.col("_page"), "left")
    require_empty("a review is stale", both.filter(~F.col("_source").eqNullSafe(F.col(source)) & F.col("_page").isNotNull()).select(page))
    return both.select(*[F.when(F.col("_status") == "accepted", F.col("_nested")).otherwise(F.col(c)).alias(c) if c == nested else F.col(c) for c in pages.columns])


def standardize(df: DataFrame, corrections: DataFrame, record: str, columns: Sequence[str], numbers: Sequence[str] = (), transform=None, **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Corrections, then the column contract, numbers parsed, and an optional transform of entities: (table, ledger, review),
    where review has the numbers that could not be read: nothing is dropped for them."""
    from leafwork.functions.exprs import blank, to_float

    if missing := [c for c in columns if c not in df.columns]:
        raise Violation(f"columns are missing: {missing}")
    done, ledger = apply_corrections(df, corrections, record, **options)
    odd = [F.when(~blank(F.col(c)) & to_float(F.col(c).cast("string")).isNull(), F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value"))) for c in numbers]
    review = done.select(F.col(record), F.explode(F.array_compact(F.array(*odd))).alias("_x")).select(record, "_x.*") if odd else done.select(record, F.lit("").alias("field"), F.lit("").alias("value")).limit(0)
    done = done.select(*[to_float(F.col(c).cast("string")).alias(c) if c in numbers else F.col(c) for c in done.columns])
    return (transform(done) if transform else done), ledger, review
