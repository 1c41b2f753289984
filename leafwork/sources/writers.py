"""Writers whose output does not depend on the order of tasks."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwork.operators.gates import Violation


def write_tsv(df: DataFrame, path: str, order: list[Column], single: bool = False, fields: list[str] | None = None) -> None:
    """A tab-separated table in total order; nested cells as JSON. With `single` one file, for small reports. With `fields`
    just these columns in this order: one that is missing, or not among them, is a violation."""
    if fields is not None:
        if set(fields) != set(df.columns):
            raise Violation(f"columns are {df.columns}, not {fields}")
        df = df.select(*fields)
    flat = df.select(*[F.to_json(c, {"ignoreNullFields": "false"}).alias(c) if t.startswith(("struct", "array", "map")) else F.col(c) for c, t in df.dtypes])
    rows = flat.orderBy(*order)
    (rows.coalesce(1) if single else rows).write.mode("overwrite").csv(path, sep="\t", header=True, quote='"', escape='"', emptyValue="", nullValue="", lineSep="\n")


def write_jsonl(df: DataFrame, path: str, order: list[Column]) -> None:
    """An object a line in total order, with keys in name order and nulls shown."""
    df.orderBy(*order).select(*sorted(df.columns)).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def append_immutable(new: DataFrame, store: str, key: str, content: str) -> int:
    """Append rows with new keys to a Parquet store; equal content again is no change, other content is a violation."""
    spark = new.sparkSession
    try:
        old = spark.read.parquet(store)
    except Exception as e:  # the store begins with its first append
        if "PATH_NOT_FOUND" not in str(e):
            raise
        old = spark.createDataFrame([], new.schema)
    both = new.join(old.select(F.col(key).alias("_k"), F.col(content).alias("_c")), F.col(key) == F.col("_k"), "left")
    conflict = both.filter(F.col("_k").isNotNull() & ~F.col("_c").eqNullSafe(F.col(content))).limit(3).collect()
    if conflict:
        raise Violation(f"already stored with other content: {[r[key] for r in conflict]}")
    fresh = both.filter("_k is null").select(*new.columns).persist()
    n = fresh.count()
    if n:
        fresh.write.mode("append").parquet(store)
    fresh.unpersist()
    return n


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False, default=str)


def signed(payload: dict) -> dict:
    """`payload` with the SHA-256 of its canonical JSON."""
    return {**payload, "signature": hashlib.sha256(canonical(payload).encode()).hexdigest()}


def verify(receipt: dict) -> bool:
    return signed({k: v for k, v in receipt.items() if k != "signature"}) == receipt


def write_text(path: str, text: str) -> None:
    """Replace a driver-side file at once."""
    folder = os.path.dirname(path) or "."
    os.makedirs(folder, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=folder)
    with os.fdopen(handle, "w", encoding="utf-8", newline="\n") as f:
        f.write(text)
        f.flush()
        os.fsync(f.fileno())
    os.replace(name, path)


def publish(pointer: str, run: str, errors: int, complete: bool) -> None:
    """Point to a run, if it is complete and has no errors."""
    if errors or not complete:
        raise Violation("only a complete run without errors is published")
    write_text(pointer, canonical({"run": run}) + "\n")
