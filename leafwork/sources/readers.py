"""Readers with strict contracts. Nothing is inferred: text columns first, typed by the caller."""

from __future__ import annotations

import tomllib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from leafwork.operators.gates import Violation, require_empty


def read_tsv(spark: SparkSession, path: str, fields: Sequence[str], exact: bool = True) -> DataFrame:
    """A tab-separated table of text with the header `fields`; with exact=False it may have more columns. Blank cells are
    '', never null; rows with other numbers of cells raise an error when read."""
    first = spark.read.text(path).limit(1).collect()
    header = [h.strip('"') for h in first[0][0].removeprefix("﻿").split("\t")] if first else []
    if exact and header != list(fields):
        raise Violation(f"{path}: the header is {header}, not {list(fields)}")
    if missing := [f for f in fields if f not in header]:
        raise Violation(f"{path}: columns are missing: {missing}")
    if len(set(header)) != len(header):
        raise Violation(f"{path}: a column occurs twice")
    schema = T.StructType([T.StructField(h, T.StringType()) for h in header])
    rows = spark.read.csv(path, schema=schema, sep="\t", header=True, quote='"', escape='"', mode="FAILFAST", enforceSchema=True, multiLine=False)
    return rows.select(*[F.coalesce(F.col(f"`{h}`"), F.lit("")).alias(h) for h in header])


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """An object a line; blank lines are skipped, anything but an object of the schema raises an error when read."""
    return spark.read.json(path, schema=schema, mode="FAILFAST")


def last_by_key(log: DataFrame, key: str, order: str) -> DataFrame:
    """Of an append-only log the last record by key."""
    return log.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc()))).filter("_n = 1").drop("_n")


def read_tree(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, bytes, modified and sha256 of each file below `path`."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"))


def tree_summary(tree: DataFrame) -> DataFrame:
    """Files, bytes, latest change and a signature of names, sizes and hashes that does not depend on order.

    Line hashes are added up in four parts, so no list of all files is gathered.
    """
    line = F.sha2(F.concat_ws("\0", "path", F.col("bytes").cast("string"), "sha256"), 256)
    parts = [F.sum(F.conv(F.substring(line, 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)")).alias(f"_p{k}") for k in range(4)]
    rows = tree.agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.max("modified").alias("latest"), *parts)
    return rows.select("files", "bytes", "latest", F.sha2(F.concat_ws(":", *[F.coalesce(F.col(f"_p{k}").cast("string"), F.lit("0")) for k in range(4)]), 256).alias("signature"))


def html_catalog(pages: DataFrame, html: str, variable: str, schema: str) -> DataFrame:
    """The items of a JSON value assigned to a variable in a page's script, with their 1-based place: a list, an object whose
    `items` is the list, or an object of items by id, taken in the order of their ids. An id twice in a page is a violation
    if the schema has one."""
    own = [c for c in pages.columns if c != html]
    body = F.regexp_extract(html, rf"{variable}\s*=\s*([\[{{][\s\S]*?[\]}}])\s*;", 1)
    listed = F.from_json(body, f"array<struct<{schema}>>")
    inner = F.from_json(F.get_json_object(body, "$.items"), f"array<struct<{schema}>>")
    by_id = F.map_values(F.from_json(body, f"map<string, struct<{schema}>>"))
    has = F.get_json_object(body, "$.items").isNotNull()
    some = F.when(body.startswith("["), listed).when(has, inner).otherwise(by_id)
    rows = pages.select(*own, F.posexplode(some).alias("_at", "_item")).select(*own, (F.col("_at") + 1).alias("position"), "_item.*")
    if "id" in rows.columns and "id" not in own:
        require_empty("an id is repeated", rows.groupBy(*own, "id").agg(F.count("*").alias("n")).filter("n > 1"))
    return rows


def partial_files(tree: DataFrame, pattern: str = r"\.(part|tmp|crdownload)$") -> DataFrame:
    """Files of a tree that a download has not finished."""
    return tree.filter(F.col("path").rlike(pattern))


def xml_fields(df: DataFrame, xml: str, paths: dict[str, str]) -> DataFrame:
    """`df` with a text column for each xpath; absent ones are ''."""
    return df.select("*", *[F.coalesce(F.xpath_string(xml, F.lit(p)), F.lit("")).alias(n) for n, p in paths.items()])


def expand_ranges(ranges: DataFrame, start: str, end: str, name: str = "page") -> DataFrame:
    """A row per page of inclusive ranges; ranges without both ends, or that run backwards, give none."""
    rows = ranges.filter(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) <= F.col(end)))
    return rows.withColumn(name, F.explode(F.sequence(start, end)))


def read_config(path: str) -> dict:
    with open(path, "rb") as f:
        return tomllib.load(f)


def reservations(spark: SparkSession, path: str) -> DataFrame:
    """reservation_id and page_id from JSON files {reservation_id, page_ids}; a page in two of them is a violation."""
    rows = spark.read.json(path, schema="reservation_id string, page_ids array<string>", multiLine=True, mode="FAILFAST")
    pages = rows.select("reservation_id", F.explode("page_ids").alias("page_id"))
    twice = pages.groupBy("page_id").agg(F.count("*").alias("n")).filter("n > 1").limit(3).collect()
    if twice:
        raise Violation(f"reserved twice: {[r['page_id'] for r in twice]}")
    return pages
