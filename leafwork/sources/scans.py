"""Scans that verify what they read, and sinks that publish runs with receipts."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwork.functions.exprs import blank, strict_flag, strict_int
from leafwork.operators.gates import Violation, columns, not_unique, require_empty
from leafwork.sources.readers import read_tsv
from leafwork.sources.writers import signed, verify, write_text, write_tsv

SHA = "^[0-9a-f]{64}$"
SAFE_PDF = r"^(?!/)(?!.*(^|/)\.\.(/|$))[^\\]+\.pdf$"


# ---------------------------------------------------------------- scans


def snapshot(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    """(path, length, sha256, content) of files: what is parsed is what was hashed. A file above `most` bytes is a violation."""
    rows = spark.read.format("binaryFile").load(path)
    if most is not None:
        require_empty("a file is too large", rows.select("path", "length").filter(F.col("length") > most))
    return rows.select("path", "length", F.sha2("content", 256).alias("sha256"), "content")


def snapshot_lines(snap: DataFrame) -> DataFrame:
    """(path, line, text) of the bytes of a snapshot, a leading byte-order mark dropped; blank lines stay."""
    text = F.regexp_replace(F.decode("content", "UTF-8"), "^﻿", "")
    return snap.select("path", F.posexplode(F.split(F.regexp_replace(text, r"\n$", ""), "\r?\n", -1)).alias("line", "text")).withColumn("line", F.col("line") + 1)


def verified(files: DataFrame, declared: DataFrame, key: str) -> DataFrame:
    """(key, problem) of declared (key, sha256) whose file is missing or has another hash."""
    f = files.select(F.col(key).alias("_k"), F.col("sha256").alias("_sha"))
    rows = declared.join(f, F.col(key) == F.col("_k"), "left")
    return rows.select(key, F.when(F.col("_k").isNull(), "missing").when(F.col("_sha") != F.col("sha256"), "hash").alias("problem")).filter("problem is not null")


def typed(rows: DataFrame, ints: dict[str, int] = {}, flags: Sequence[str] = (), shas: Sequence[str] = (), paths: Sequence[str] = (), enums: dict[str, Sequence[str]] = {}, unique: Sequence[Sequence[str]] = (), optional: Sequence[str] = ()) -> DataFrame:
    """Text columns as what they must be: integers (column: least), 0/1 flags, SHA-256 hashes, safe paths of PDF files, one of
    a few words; `unique` names sets of columns. Anything else is a violation; columns in `optional` may be blank."""
    new, bad = {}, F.lit(False)

    def need(c: str, ok: Column) -> None:
        nonlocal bad
        fine = F.coalesce(ok, F.lit(False))
        bad = bad | ~(fine | blank(F.col(c)) if c in optional else fine)

    for c, least in ints.items():
        new[c] = strict_int(F.col(c), least)
        need(c, new[c].isNotNull())
    for c in flags:
        new[c] = strict_flag(F.col(c))
        need(c, new[c].isNotNull())
    for c in shas:
        need(c, F.col(c).rlike(SHA))
    for c in paths:
        need(c, F.col(c).rlike(SAFE_PDF))
    for c, words in enums.items():
        need(c, F.col(c).isin(*words))
    require_empty("a row has a wrong value", rows.filter(bad))
    for keys in unique:
        require_empty(f"{list(keys)} is repeated", not_unique(rows.filter(~blank(F.col(keys[0]))) if keys[0] in optional else rows, list(keys)))
    return rows.select(*[new.get(c, F.col(c)).alias(c) for c in rows.columns])


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """Sources in order: source_order, source_id, path, source_sha256, size_bytes, page_count, each key once."""
    rows = read_tsv(spark, path, ["source_order", "source_id", "path", "source_sha256", "size_bytes", "page_count"])
    return typed(rows, ints={"source_order": 0, "size_bytes": 1, "page_count": 1}, shas=["source_sha256"], paths=["path"], unique=[["source_order"], ["source_id"], ["path"]])


def source_manifest(rows: DataFrame, allow_empty: bool = False) -> DataFrame:
    """Sources to acquire (source_id, url, first_page, last_page): ids of small letters, digits and - _, https addresses,
    pages in order or blank."""
    out = typed(rows, ints={"first_page": 1, "last_page": 1}, optional=["first_page", "last_page"], unique=[["source_id"]])
    wrong = ~F.coalesce(F.col("source_id").rlike("^[a-z0-9][a-z0-9_-]*$"), F.lit(False)) | ~F.coalesce(F.col("url").startswith("https://"), F.lit(False)) | F.coalesce(F.col("last_page") < F.col("first_page"), F.lit(False))
    require_empty("a source is wrong", out.filter(wrong))
    if not allow_empty and out.isEmpty():
        raise Violation("the manifest has no sources")
    return out


def page_manifest(rows: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Pages in manifest order: manifest_index, source_id, page, source_sha256, final_type."""
    out = typed(rows, ints={"manifest_index": 0, "page": 1}, shas=["source_sha256"], enums={"final_type": allowed}, unique=[["manifest_index"], ["source_id", "page"]])
    return out.orderBy("manifest_index")


def overrides(rows: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Decisions of people: source_id, page (blank for the whole source), source_sha256, decision, note."""
    return typed(rows, ints={"page": 1}, optional=["page"], shas=["source_sha256"], enums={"decision": allowed}, unique=[["source_id", "page"]])


def expanded_ranges(mapping: DataFrame) -> DataFrame:
    """Ranges (source, part, start, end, offset) as one row a page, with the page of the part that it shows; rows whose part
    begins with x, or is blank or `missing`, are placeholders and give none; overlapping ranges are a violation."""
    real = mapping.filter(~blank(F.col("part")) & ~F.lower("part").startswith("x") & (F.lower("part") != "missing"))
    rows = real.select("source", "part", F.explode(F.sequence("start", "end")).alias("page"), "offset").withColumn("part_page", F.col("page") - F.col("offset"))
    require_empty("ranges overlap", not_unique(rows, ["source", "page"]))
    return rows.drop("offset")


def configured(editions: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Editions with status configured, from their own source or, if they have none, from a crosswalk (edition, source);
    an edition that both or neither give, or a crosswalk of an edition that isn't there, is a violation."""
    c = crosswalk.select(F.col("edition").alias("_e"), F.col("source").alias("_s"))
    both = editions.filter("status = 'configured'").join(c, F.col("edition") == F.col("_e"), "left")
    require_empty("an edition has two sources or none", both.filter(blank(F.col("source")) == F.col("_s").isNull()))
    require_empty("a crosswalk is of an unknown edition", c.join(editions.select("edition"), F.col("_e") == F.col("edition"), "left_anti"))
    return both.select("edition", F.when(blank(F.col("source")), F.col("_s")).otherwise(F.col("source")).alias("source"), F.when(blank(F.col("source")), "crosswalk").otherwise("recovered").alias("source_origin"))


def unknown_identifiers(prompts: DataFrame, fields: Sequence[str], literals: Sequence[str]) -> DataFrame:
    """(name, identifier) of words in backticks of prompts (name, text) that are neither fields of the schema nor literals."""
    known = F.array(*map(F.lit, [*fields, *literals])) if fields or literals else F.array().cast("array<string>")
    found = F.array_distinct(F.regexp_extract_all("text", F.lit("`([A-Za-z_][A-Za-z0-9_]*)`"), 1))
    return prompts.select("name", F.explode(F.array_except(found, known)).alias("identifier"))


def signed_queue(queue: DataFrame, receipt: dict, files: DataFrame, rank: str = "selection_rank", key: str = "page_id") -> DataFrame:
    """A queue whose receipt holds: its signature, the number of rows, ranks 1..n, unique keys, and each input's hash
    (receipt['inputs'], by path, against `files`)."""
    if not verify(receipt):
        raise Violation("the receipt's signature is wrong")
    n, lo, hi, ranks, keys = queue.agg(F.count("*"), F.min(rank), F.max(rank), F.countDistinct(rank), F.countDistinct(key)).first()
    if n != receipt["rows"] or n and (lo, hi, ranks, keys) != (1, n, n, n):
        raise Violation("the queue isn't what the receipt says")
    declared = queue.sparkSession.createDataFrame([(k, v) for k, v in receipt["inputs"].items()], "path string, sha256 string")
    require_empty("an input has changed", verified(files, declared, "path"))
    return queue.orderBy(rank)


# ---------------------------------------------------------------- sinks


def write_read_only(df: DataFrame, path: str, order: list[Column]) -> None:
    """A small driver-side report that no one writes to by mistake."""
    write_tsv(df, path, order, single=True)
    for name in os.listdir(path.removeprefix("file://")):
        os.chmod(os.path.join(path.removeprefix("file://"), name), 0o444)


def write_bundle(folder: str, tables: dict[str, DataFrame], facts: dict) -> dict:
    """Each table as Parquet below `folder`, and a signed receipt of the facts, the tables' rows and a hash of each one's content."""
    told = {}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        told[name] = content_receipt(df.sparkSession.read.parquet(f"{folder}/{name}"))
    receipt = signed({**facts, "tables": told})
    write_text(f"{folder.removeprefix('file://')}/receipt.json", __import__("json").dumps(receipt, sort_keys=True, indent=1) + "\n")
    return receipt


def content_receipt(df: DataFrame) -> dict:
    """Rows, and a hash of the content that does not depend on the order of rows or files: sums of two row hashes."""
    cols = [F.col(f"`{c}`") if not k.startswith("map") else F.to_json(f"`{c}`") for c, k in df.dtypes]
    wide = lambda h: F.sum(h.cast("decimal(20,0)"))
    n, a, b = df.agg(F.count("*"), wide(F.xxhash64(*cols)), wide(F.xxhash64(F.lit("again"), *cols))).first()
    return {"rows": n, "hash": hashlib.sha256(f"{n}:{a}:{b}".encode()).hexdigest()}


def verify_bundle(spark: SparkSession, folder: str, receipt: dict) -> list[str]:
    """What is wrong with a run: its signature, and each table whose rows or content differ from the receipt."""
    wrong = [] if verify(receipt) else ["signature"]
    for name, told in sorted(receipt.get("tables", {}).items()):
        try:
            found = content_receipt(spark.read.parquet(f"{folder}/{name}"))
        except Exception as e:  # a missing table is a finding
            if "PATH_NOT_FOUND" not in str(e):
                raise
            found = None
        if found != told:
            wrong.append(name)
    return wrong


def release_manifest(inputs: dict[str, DataFrame], declared: dict[str, dict], facts: dict) -> dict:
    """A signed manifest of inputs; one whose content isn't what was declared is a violation."""
    now = {name: content_receipt(df) for name, df in inputs.items()}
    stale = sorted(n for n in set(now) | set(declared) if now.get(n) != declared.get(n))
    if stale:
        raise Violation(f"inputs have changed: {stale}")
    return signed({**facts, "inputs": now})


def staging_plan(wanted: DataFrame, files: DataFrame, target: str) -> DataFrame:
    """What to copy: for wanted (key, sha256) the first root's file with that hash, and where to; a file that no root has is a violation."""
    from leafwork.operators.records import first_matching

    plan = first_matching(files, wanted, "key", "sha256")
    require_empty("no root has the file", plan.filter("path is null"))
    return plan.withColumn("target", F.concat(F.lit(target.rstrip("/") + "/"), "key"))


def export_delimited(df: DataFrame, folder: str, name: str, order: list[Column]) -> None:
    """A table for statistics packages: tab-separated text, and Parquet in place of their own format."""
    write_tsv(df, f"{folder}/{name}.tsv", order)
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def save_decision(decision: dict, history: DataFrame, pages: DataFrame) -> DataFrame:
    """`history` with one more decision (page_id, source_sha256, status, note, at): of a known page, current, and with a note
    unless it accepts. The latest by page holds."""
    found = pages.filter(F.col("page_id") == decision["page_id"]).select("source_sha256").limit(2).collect()
    if len(found) != 1 or found[0][0] != decision["source_sha256"]:
        raise Violation("the decision is of an unknown or changed page")
    if decision["status"] != "accepted" and not (decision.get("note") or "").strip():
        raise Violation("the decision needs a note")
    return history.unionByName(history.sparkSession.createDataFrame([tuple(decision[c] for c in history.columns)], history.schema))


def latest_decisions(history: DataFrame) -> DataFrame:
    return history.groupBy("page_id").agg(F.max_by(F.struct(*[c for c in history.columns if c != "page_id"]), "at").alias("_d")).select("page_id", "_d.*")


def contract(parts: dict) -> dict:
    """Prompt, schema, settings and dependencies under one signature."""
    return signed(parts)


def embedded(content: bytes) -> dict:
    """Evidence that holds its own bytes."""
    import base64

    return {"size": len(content), "sha256": hashlib.sha256(content).hexdigest(), "content": base64.b64encode(content).decode()}


def embedded_bytes(evidence: dict) -> bytes:
    import base64

    content = base64.b64decode(evidence["content"], validate=True)
    if len(content) != evidence["size"] or hashlib.sha256(content).hexdigest() != evidence["sha256"]:
        raise Violation("the evidence is not what it was")
    return content


def run_id(now) -> str:
    """The name of a run that began at an aware time."""
    from datetime import timezone

    return now.astimezone(timezone.utc).strftime("%Y%m%dT%H%M%SZ")


def file_key(name: str) -> str:
    return re.sub(r"[^A-Za-z0-9._-]+", "_", name)


def content_range_total(header: Column) -> Column:
    """The whole size in a header such as `bytes 0-9/100`; null if it is unknown or the header is wrong."""
    return F.regexp_extract(header, r"^bytes [0-9]+-[0-9]+/([0-9]+)$", 1).try_cast("long")


def preview(df: DataFrame, by: Sequence[str]) -> dict:
    """Counts to show before anything is written."""
    columns(df, list(by))
    return {"rows": df.count(), **{c: {r[0]: r[1] for r in df.groupBy(c).count().orderBy(c).limit(50).collect()} for c in by}}
