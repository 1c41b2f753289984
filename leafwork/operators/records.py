"""Extraction records: two-level flattening, lineage, usage and cost, caches, page records, gates, alternate requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leafwork.operators.gates import Violation, not_contiguous, not_unique, orphans, require_empty

USAGE = ("input_tokens", "output_tokens", "thought_tokens", "total_tokens")


# ---------------------------------------------------------------- records


def flatten_two(df: DataFrame, keys: Sequence[str], parents: str, children: str, skip: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Parents and children of a nested array as two tables: parents with parent_index, children with parent_index and
    child_index, both from 1 within the row. Rows for which `skip` holds give none."""
    rows = df if skip is None else df.filter(~F.coalesce(skip, F.lit(False)))
    up = rows.select(*keys, F.posexplode(parents).alias("_at", "_p")).withColumn("parent_index", F.col("_at") + 1)
    fields = [f.name for f in df.schema[parents].dataType.elementType.fields]
    down = up.select(*keys, "parent_index", F.posexplode(f"_p.{children}").alias("_at", "_c"))
    return up.select(*keys, "parent_index", *[F.col(f"_p.{f}").alias(f) for f in fields if f != children]), down.select(*keys, "parent_index", (F.col("_at") + 1).alias("child_index"), "_c.*")


def normalized(df: DataFrame, multiplier: str, scaled: Sequence[str]) -> DataFrame:
    """Nulls as empty text, booleans as 0 and 1, and balance-sheet fields times the row's unit multiplier."""
    out = []
    for c, kind in df.dtypes:
        x = F.col(c)
        if c in scaled:
            x = x * F.coalesce(F.col(multiplier), F.lit(1))
        if kind == "string":
            x = F.coalesce(x, F.lit(""))
        elif kind == "boolean":
            x = x.cast("int")
        out.append(x.alias(c))
    return df.select(*out)


def with_lineage(cached: DataFrame, pages: DataFrame, key: str, lineage: Sequence[str]) -> DataFrame:
    """Cached results with the current lineage of their page over the cached one; what was extracted stays."""
    now = pages.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in lineage])
    return cached.join(now, F.col(key) == F.col("_k"), "left").select(*[F.when(F.col("_k").isNotNull(), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in lineage else F.col(c) for c in cached.columns])


def require_disjoint(model: Sequence[str], owned: Sequence[str]) -> None:
    if both := sorted(set(model) & set(owned)):
        raise Violation(f"field names are reserved: {both}")


def with_errors(pages: DataFrame, results: DataFrame, key: str, message: str = "no result") -> DataFrame:
    """A row for every page: its result, or status error with the page's lineage and a usage of zero that is known."""
    fields = [c for c in results.columns if c != key]
    r = results.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in fields])
    rows = pages.join(r, F.col(key) == F.col("_k"), "left")
    blank = {"status": F.lit("error"), "error": F.lit(message), **{u: F.lit(0) for u in USAGE}}
    kinds = dict(results.dtypes)
    return rows.select(*pages.columns, *[F.when(F.col("_k").isNull(), blank.get(c, F.lit(None)).cast(kinds[c])).otherwise(F.col(f"_{c}")).alias(c) for c in fields])


def gold_mismatches(records: DataFrame, gold: DataFrame, page: str) -> DataFrame:
    """(page, problem, detail) of gold expectations (page, field, index from 1 or null, expected as text) that the records
    (page, fields as columns, arrays for repeated ones) miss, and of pages only one side has."""
    kinds = dict(records.dtypes)
    fields = [c for c in records.columns if c != page]
    shown = F.create_map(*[x for c in fields for x in (F.lit(c), scalar_text(F.col(c), kinds[c]))])
    many = {c: kinds[c][6:-1] for c in fields if kinds[c].startswith("array")}
    each = lambda kind: lambda v: scalar_text(v, kind)
    items = F.create_map(*[x for c, kind in many.items() for x in (F.lit(c), F.transform(c, each(kind)))]) if many else F.lit(None).cast("map<string,array<string>>")
    rows = records.select(F.col(page).alias("_p"), shown.alias("_one"), items.alias("_many"))
    both = gold.join(rows, F.col(page) == F.col("_p"), "left")
    got = F.when(F.col("index").isNull(), F.col("_one")[F.col("field")]).otherwise(F.get(F.col("_many")[F.col("field")], F.col("index") - 1))
    problem = F.when(F.col("_p").isNull(), "page is missing").when(~F.col("field").isin(*fields), "field is missing").when(got.isNull(), "index is missing").when(got != F.col("expected"), "other value")
    wrong = both.withColumn("problem", problem).filter("problem is not null").select(page, "problem", F.concat_ws(":", "field", F.col("index").cast("string")).alias("detail"))
    extra = orphans(records, page, gold.select(page).distinct(), page).select(page, F.lit("page is not expected").alias("problem"), F.lit("").alias("detail"))
    return wrong.unionByName(extra)


def scalar_text(c: Column, kind: str) -> Column:
    """A value as the text that gold files hold: null, true and false in words, nested values as JSON."""
    text = F.to_json(c) if kind.startswith(("array", "struct", "map")) else c.cast("string")
    return F.coalesce(text, F.lit("null"))


def anchor_fields(explicit: Sequence[str], keys: Sequence[str], entity: Sequence[str], time: str, default: Sequence[str]) -> list[str]:
    """The fields that tell records of a page apart: as given, else the keys, else entity and time, else the default."""
    return list(explicit) or list(keys) or [*entity, *([time] if entity and time else [])] or list(default)


def anchor(fields: Sequence[str]) -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in sorted(fields)]), {"ignoreNullFields": "false"})


def json_safe(df: DataFrame) -> DataFrame:
    """Dates, times, decimals and binaries as text, at the top level; nested values keep their JSON types."""
    return df.select(*[F.col(c).cast("string").alias(c) if k.startswith(("date", "timestamp", "decimal")) else F.base64(c).alias(c) if k == "binary" else F.col(c) for c, k in df.dtypes])


# ---------------------------------------------------------------- usage and cost


def usage_known(fields: Sequence[str] = USAGE) -> Column:
    """Whether all counters are there and not negative."""
    ok = F.lit(True)
    for c in fields:
        ok = ok & F.coalesce(F.col(c) >= 0, F.lit(False))
    return ok


def accounting(results: DataFrame, rates: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Sums of known usage, how many results have none, and the cost by rates per million; null cost while any is unknown."""
    known = usage_known(list(rates))
    sums = [F.coalesce(F.sum(F.when(known, F.col(c))), F.lit(0)).alias(c) for c in rates]
    rows = results.groupBy(*by).agg(F.count("*").alias("results"), F.count_if(~known).alias("unknown"), *sums)
    cost = sum((F.col(c) * r for c, r in rates.items()), F.lit(0.0)) / 1e6
    return rows.withColumn("cost", F.when(F.col("unknown") == 0, cost))


def projected_cost(results: DataFrame, rates: dict[str, float], pending: int) -> DataFrame:
    """One row: mean cost of results with known usage times the pending ones; null without any, or if any is unknown."""
    one = sum((F.col(c) * r for c, r in rates.items()), F.lit(0.0)) / 1e6
    rows = results.agg(F.bool_and(usage_known(list(rates))).alias("complete"), F.avg(one).alias("mean"), F.count("*").alias("basis"))
    return rows.select("basis", F.coalesce("complete", F.lit(False)).alias("complete"), F.when(F.col("complete"), F.col("mean") * pending).alias("projected"))


def ordered_signature(df: DataFrame, order: str, fields: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """A hash of the ordered list of each group's field values; a group is one run's pages."""
    each = F.struct(F.col(order).alias("_o"), F.to_json(F.struct(*fields)).alias("j"))
    return df.groupBy(*by).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(each)), lambda x: x["j"]), "\n"), 256).alias("signature"))


# ---------------------------------------------------------------- caches


def cached(entries: DataFrame, key: str, identity: Sequence[str]) -> DataFrame:
    """By page its valid cache entry (status ok or error, attempt): a success before errors, then the latest attempt. An
    entry whose identity fields (as columns x and current_x) differ is not valid."""
    same = F.lit(True)
    for c in identity:
        same = same & F.col(c).eqNullSafe(F.col(f"current_{c}"))
    w = Window.partitionBy(key).orderBy((F.col("status") == "ok").desc(), F.col("attempt").desc())
    return entries.filter(same).withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def mapped_artifacts(artifacts: DataFrame, mapping: DataFrame) -> DataFrame:
    """Artifacts (group, page, file, body) with the page they belong to: kind json, error (a body that isn't a JSON object)
    and mapped or unmapped."""
    m = mapping.select(F.col("group").alias("_g"), F.col("page").alias("_p"), "page_id")
    rows = artifacts.join(m, (F.col("group") == F.col("_g")) & (F.col("page") == F.col("_p")), "left")
    sane = F.json_object_keys("body").isNotNull()
    return rows.select(*artifacts.columns, "page_id", F.when(sane, "json").otherwise("error").alias("kind"), F.when(sane, F.get_json_object("body", "$.model")).alias("model"))


def artifact_counts(mapped: DataFrame) -> DataFrame:
    """By group: artifacts of each kind, mapped and unmapped, pages with several, and a count by model."""
    models = mapped.filter("model is not null").groupBy("group", "model").agg(F.count("*").alias("n")).groupBy(F.col("group").alias("_g")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("model", "n")))).alias("models"))
    twice = mapped.filter("page_id is not null").groupBy("group", "page_id").agg(F.count("*").alias("n")).groupBy(F.col("group").alias("_h")).agg(F.count_if(F.col("n") > 1).alias("collisions"))
    rows = mapped.groupBy("group").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in ("json", "error")], F.count("page_id").alias("mapped"), F.count_if(F.col("page_id").isNull()).alias("unmapped"))
    return rows.join(models, F.col("group") == F.col("_g"), "left").join(twice, F.col("group") == F.col("_h"), "left").drop("_g", "_h").withColumn("collisions", F.coalesce("collisions", F.lit(0)))


def audit(sources: DataFrame, mapped: DataFrame, before: DataFrame, after: DataFrame, partial: DataFrame, expected_pages: int) -> DataFrame:
    """One row of gates over a recovered cache, and `passed` if all hold: every source has a status that may be used (see
    acquired), every artifact is JSON and mapped, no page has several, all pages are there, the tree stood still between
    two summaries (see sources.readers.tree_summary), and no file is partial."""
    one = F.lit(1).alias("_one")
    twice = mapped.filter("page_id is not null").groupBy("page_id").agg(F.count("*").alias("n")).agg(F.count("*").alias("pages"), F.count_if(F.col("n") > 1).alias("twice"))
    parts = [
        sources.agg(F.coalesce(F.bool_and("usable"), F.lit(False)).alias("sources_usable"), one),
        mapped.agg((F.count_if(F.col("kind") != "json") == 0).alias("no_errors"), (F.count_if(F.col("page_id").isNull()) == 0).alias("all_mapped"), one),
        twice.select((F.col("twice") == 0).alias("no_collisions"), (F.col("pages") == expected_pages).alias("pages_complete"), one),
        before.select("signature").exceptAll(after.select("signature")).agg((F.count("*") == 0).alias("tree_is_quiet"), one),
        partial.agg((F.count("*") == 0).alias("no_partial_files"), one),
    ]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.join(F.broadcast(p), "_one")  # a row each
    gates = [c for c in rows.columns if c != "_one"]
    every = F.lit(True)
    for g in gates:
        every = every & F.col(g)
    return rows.select(*gates, every.alias("passed"))


def first_matching(files: DataFrame, wanted: DataFrame, key: str, digest: str) -> DataFrame:
    """For each wanted (key, digest) the file (key, rank of its root, path, digest) with that digest in the first root that
    has one; null path if none has."""
    w = files.select(F.col(key).alias("_k"), F.col(digest).alias("_d"), "rank", "path")
    rows = wanted.join(w, (F.col(key) == F.col("_k")) & (F.col(digest) == F.col("_d")), "left")
    return rows.groupBy(key, digest).agg(F.min_by("path", F.struct("rank", "path")).alias("path"))


def image_index(stem: Column) -> Column:
    """The number after the last underscore of an image's name."""
    return F.regexp_extract(stem, r"_([0-9]+)$", 1).try_cast("int")


# ---------------------------------------------------------------- pages


def page_records(inventory: DataFrame, texts: DataFrame, overrides: DataFrame, classify) -> DataFrame:
    """A record for every page 1..page_count of every source (source, page_count, source_sha256, final_type), with the
    classification of its text (source, page, text) by `classify`, a function from a text column to struct(classification,
    score, reasons), and its final type: a page override (source, page, decision, source_sha256), else the source's, else
    unreviewed. An override for a source that has changed, or for an unknown page, is a violation."""
    pages = inventory.withColumn("page", F.explode(F.expr("sequence(1, page_count)")))
    x = texts.select(F.col("source").alias("_s"), F.col("page").alias("_p"), classify(F.col("text")).alias("_c"))
    o = overrides.select(F.col("source").alias("_os"), F.col("page").alias("_op"), "decision", F.col("source_sha256").alias("_osha"))
    require_empty("a page is overridden twice", not_unique(o, ["_os", "_op"]))
    rows = pages.join(x, F.expr("source = _s and page = _p"), "left").join(o, F.expr("source = _os and page = _op"), "full_outer")
    require_empty("an override is of an unknown page", rows.filter("source is null").select("_os", "_op"))
    require_empty("an override is stale", rows.filter("_osha <> source_sha256").select("_os", "_op"))
    final = F.coalesce("decision", F.nullif("final_type", F.lit("")), F.lit("unreviewed"))
    by = F.when(F.col("decision").isNotNull(), "page").when(F.nullif("final_type", F.lit("")).isNotNull(), "source").otherwise("default")
    return rows.select("source", "page", "source_sha256", F.coalesce("_c.classification", F.lit("missing")).alias("classification"), F.coalesce("_c.score", F.lit(0)).alias("score"), F.coalesce("_c.reasons", F.lit("")).alias("reasons"), final.alias("final_type"), by.alias("decided_by"))


def not_current(records: DataFrame, inventory: DataFrame) -> DataFrame:
    """Sources whose pages and inventory differ in hash or number of pages, or that only one side has."""
    r = records.groupBy(F.col("source").alias("_s")).agg(F.min("source_sha256").alias("_lo"), F.max("source_sha256").alias("_hi"), F.count("*").alias("_n"))
    both = inventory.join(r, F.col("source") == F.col("_s"), "full_outer")
    problem = F.when(F.col("_s").isNull(), "no pages").when(F.col("source").isNull(), "not in the inventory").when((F.col("_lo") != F.col("source_sha256")) | (F.col("_hi") != F.col("source_sha256")), "hash").when(F.col("_n") != F.col("page_count"), "page count")
    return both.select(F.coalesce("source", "_s").alias("source"), problem.alias("problem")).filter("problem is not null")


def not_ready(records: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """(source, problem) that keeps pages from extraction: pages not 1..n, a page twice, a type that isn't allowed."""
    gaps = not_contiguous(records, ["source"], "page").select("source", F.lit("pages are not 1..n").alias("problem"))
    twice = not_unique(records, ["source", "page"]).select("source", F.lit("a page is repeated").alias("problem")).distinct()
    kinds = records.filter(~F.coalesce(F.col("final_type").isin(*allowed), F.lit(False))).select("source", F.lit("a page has no valid type").alias("problem")).distinct()
    return gaps.unionByName(twice).unionByName(kinds)


def changed_selection(stored: DataFrame, current: DataFrame) -> DataFrame:
    """Rows that only the stored or only the current selection has; empty if the stored one still holds."""
    a = stored.select(*current.columns)
    return a.exceptAll(current).withColumn("only_in", F.lit("stored")).unionByName(current.exceptAll(a).withColumn("only_in", F.lit("current")))


def effective_types(records: DataFrame, decisions: DataFrame) -> DataFrame:
    """`records` with effective_type: the last decision (source, page, decision, at) or the record's own type."""
    last = decisions.groupBy(F.col("source").alias("_s"), F.col("page").alias("_p")).agg(F.max_by("decision", "at").alias("_d"))
    return records.join(last, F.expr("source = _s and page = _p"), "left").withColumn("effective_type", F.coalesce("_d", "final_type")).drop("_s", "_p", "_d")


def progress(records: DataFrame, open_types: Sequence[str] = ("unreviewed", "flagged", "unresolved")) -> DataFrame:
    """By source the pages with and without an effective type that settles them."""
    open_ = F.col("effective_type").isin(*open_types)
    return records.groupBy("source").agg(F.count("*").alias("pages"), F.count_if(~open_).alias("resolved"), F.count_if(open_).alias("unresolved"))


def acquired(sources: DataFrame) -> DataFrame:
    """Inventory rows of sources (with expected_sha256, found_sha256, manual, error): valid_existing, downloaded, manual_required,
    missing or failed, and whether they may be used."""
    status = F.when(F.col("error").isNotNull(), "failed").when(F.col("found_sha256").isNull() & F.col("manual"), "manual_required").when(F.col("found_sha256").isNull(), "missing").when(F.col("expected_sha256") == F.col("found_sha256"), "valid_existing").when(F.col("expected_sha256").isNull(), "downloaded").otherwise("failed")
    return sources.withColumn("status", status).withColumn("usable", F.col("status").isin("valid_existing", "downloaded"))


def title(*parts: str) -> Column:
    return F.concat_ws(" — ", *[F.nullif(F.trim(p), F.lit("")) for p in parts])


# ---------------------------------------------------------------- alternate extraction


def segments(records: Column, target: int) -> Column:
    """How many bands a page of so many records is cut into."""
    return F.greatest(F.lit(1), F.ceil(records / target)).cast("int")


def bands(n: str, overlap: float = 0.05) -> Column:
    """The bands of a page of height 1, cut into `n` with an overlap to either side."""
    return F.expr(f"transform(sequence(0, {n} - 1), k -> named_struct('segment', k, 'top', greatest(0D, k / {n} - {overlap}D), 'bottom', least(1D, (k + 1) / {n} + {overlap}D)))")


def requests(pages: DataFrame, key: str, n: str, settings: str) -> DataFrame:
    """A request for every band of every page, with a hash of what is asked."""
    rows = pages.select(key, F.explode(bands(n)).alias("_b")).select(key, "_b.*")
    return rows.withColumn("request_hash", F.sha2(F.to_json(F.struct(F.col("bottom"), F.col(key).cast("string").alias("page"), F.lit(settings).alias("settings"), F.col("segment"), F.col("top"))), 256))


def split_pending(asked: DataFrame, done: DataFrame, key: str = "request_hash") -> tuple[DataFrame, DataFrame]:
    """The requests with a result, and those without."""
    return asked.join(done.select(key).distinct(), key, "left_semi"), asked.join(done.select(key).distinct(), key, "left_anti")


def incomplete_merges(merged: DataFrame, expected: DataFrame, page: str, index: str, n: str) -> DataFrame:
    """Pages whose merged records are not just 1..n, for the expected n."""
    found = merged.groupBy(F.col(page).alias("_p")).agg(F.countDistinct(index).alias("_d"), F.min(index).alias("_lo"), F.max(index).alias("_hi"), F.count("*").alias("_c"))
    rows = expected.join(found, F.col(page) == F.col("_p"), "left")
    good = (F.col("_lo") == 1) & (F.col("_hi") == F.col(n)) & (F.col("_d") == F.col(n)) & (F.col("_c") == F.col(n))
    return rows.filter(~F.coalesce(good, F.col(n) == 0)).select(page, F.coalesce("_c", F.lit(0)).alias("found"), F.col(n).alias("expected"))


def outer_support(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Counts of two tables by one key, zero where a table has none."""
    x, y = a.groupBy(F.col(key).alias("_a")).agg(F.count("*").alias("n_left")), b.groupBy(F.col(key).alias("_b")).agg(F.count("*").alias("n_right"))
    return x.join(y, F.col("_a") == F.col("_b"), "full_outer").select(F.coalesce("_a", "_b").alias(key), F.coalesce("n_left", F.lit(0)).alias("n_left"), F.coalesce("n_right", F.lit(0)).alias("n_right"))
