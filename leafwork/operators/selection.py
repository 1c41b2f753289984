"""Which pages are taken: selectors, windows of dates, labels of a capped selection, draws and matched controls."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leafwork.functions.exprs import blank, iso_date
from leafwork.operators.gates import Violation, orphans, require_empty


def select_pages(pages: DataFrame, key: str, order: str, *, limit: int | None = None, prefix: tuple[str, str] | None = None, ids: DataFrame | None = None, everything: bool = False) -> DataFrame:
    """Pages by exactly one selector: the first `limit` in order, those whose column begins with a prefix, those whose key
    is in `ids` (repeats count once, an unknown id is a violation), or all. The order of the manifest is kept."""
    if sum((limit is not None, prefix is not None, ids is not None, everything)) != 1:
        raise Violation("exactly one selector is needed")
    if limit is not None:
        if limit < 1:
            raise Violation("a limit is at least 1")
        return pages.orderBy(order).limit(limit)
    if prefix is not None:
        return pages.filter(F.col(prefix[0]).cast("string").startswith(prefix[1])).orderBy(order)
    if ids is not None:
        require_empty("an id is unknown", orphans(ids, key, pages, key))
        return pages.join(ids.select(F.col(key).alias("_id")).distinct(), F.col(key) == F.col("_id"), "left_semi").orderBy(order)
    return pages.orderBy(order)


def require_authorized(pages: DataFrame, key: str, allowed: Sequence[str]) -> None:
    """The pages asked for are just those that are allowed, each once."""
    found = [r[0] for r in pages.select(key).orderBy(key).limit(len(allowed) + 1).collect()]
    if found != sorted(set(allowed)):
        raise Violation(f"pages {found[:5]} are not those allowed")


def first_by_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """DISTINCT that keeps the order of first appearance."""
    first = rows.groupBy(key).agg(F.min(order).alias(order))
    return first.orderBy(order)


def restored(df: DataFrame, ordinal: str) -> DataFrame:
    """The order of the input, whatever order the work was done in."""
    return df.orderBy(ordinal).drop(ordinal)


def samples(df: DataFrame, by: list[str], value: str, most: int = 20) -> DataFrame:
    """By group how many values there are and the first `most` in order; no group is gathered whole."""
    ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(value))).filter(F.col("_n") <= most)
    counts = df.groupBy(*by).agg(F.count("*").alias("n"))
    return counts.join(ranked.groupBy(*by).agg(F.array_sort(F.collect_list(value)).alias("samples")), by)


def in_window(date: Column, start: str | None, end: str | None) -> Column:
    """Whether an ISO date is within [start, end]; a row without a valid date passes only if neither end is given."""
    if start is None and end is None:
        return F.lit(True)
    d = iso_date(date)
    ok = F.lit(True)
    if start is not None:
        ok = ok & (d >= F.lit(start).cast("date"))
    if end is not None:
        ok = ok & (d <= F.lit(end).cast("date"))
    return F.coalesce(ok, F.lit(False))


def decade_may_match(decade: Column, start: str | None, end: str | None) -> Column:
    """Whether a decade can hold a date within [start, end]: the cheap filter before dates are known."""
    ok = F.lit(True)
    if start is not None:
        ok = ok & (decade + 9 >= int(start[:4]))
    if end is not None:
        ok = ok & (decade <= int(end[:4]))
    return F.coalesce(ok, F.lit(start is None and end is None))


def review_reason(status: str, quality: str, uncertain: str, error: str = "error") -> Column:
    """`error`, or the reasons to review joined by `;`: status, scan quality and any uncertain field; empty for none."""
    reasons = F.concat_ws(";", F.when(~F.coalesce(F.col(status) == "ok", F.lit(False)), F.concat(F.lit("status="), F.coalesce(F.col(status), F.lit("")))), F.when(F.coalesce(F.col(quality) != "good", F.lit(False)), F.concat(F.lit("scan_quality="), F.col(quality))), F.when(F.exists(F.col(uncertain), lambda u: F.size(u) > 0), F.lit("uncertain_fields")))
    return F.when(~blank(F.col(error)), "error").otherwise(reasons)


def priority(rolled: DataFrame, unit: str, records: str) -> DataFrame:
    """`rolled` (see ranking.rollup; with `records`, the unit's rows) with affected_share and page_rank by seven keys: tier,
    then families, rules, entities, share and magnitude downwards, then the unit."""
    from leafwork.operators.ranking import rank_all

    of = F.greatest(F.coalesce(F.col(records), F.lit(0)), F.col("entities"))
    rows = rolled.withColumn("affected_share", F.when(of > 0, F.col("entities") / of))
    order = [F.col("tier").asc(), F.col("families").desc(), F.col("rules").desc(), F.col("entities").desc(), F.coalesce("affected_share", F.lit(0.0)).desc(), F.coalesce("magnitude", F.lit(0.0)).desc(), F.col(unit).asc()]
    return rank_all(rows, order, "page_rank")


def labelled(ranked: DataFrame, rank: str, gate: bool, remaining: int, trial: int) -> DataFrame:
    """`ranked` (eligible, counted, localized: whether it has a localized signal of tier 3 or less) with status and
    selection_rank. The first min(remaining, trial) that qualify are selected; only that many rows reach the driver."""
    why = F.when(~F.col("eligible"), "ineligible").when(F.col("counted"), "already_counted").when(~F.col("localized"), "tier4_only")
    why = why.otherwise("candidate") if gate else why.otherwise("calibration_gate_failed")
    rows = ranked.withColumn("_why", why)
    limit = max(0, min(remaining, trial))
    taken = [r[0] for r in rows.filter("_why = 'candidate'").select(rank).orderBy(rank).limit(limit).collect()]
    place = F.create_map(*[x for k, r in enumerate(taken) for x in (F.lit(r), F.lit(k + 1))])[F.col(rank)] if taken else F.lit(None).cast("int")
    rows = rows.withColumn("selection_rank", F.when(F.col("_why") == "candidate", place))
    beyond = "cap_exhausted" if remaining < trial else "trial_limit"
    return rows.withColumn("status", F.when(F.col("selection_rank").isNotNull(), "selected").when(F.col("_why") == "candidate", beyond).otherwise(F.col("_why"))).drop("_why")


def manual_category(family: Column, rule: Column, evidence: Column) -> Column:
    """The category of manual evidence that a signal belongs to, from its family, rule and the keys of its evidence; else null."""
    manual = F.array_contains(F.coalesce(F.json_object_keys(evidence), F.array().cast("array<string>")), "evidence_family")
    return F.when(family == "documented", "documented").when(rule == "scope_exclusion", "scope_exclusion").when(manual & (family == "identity"), "identity_manual").when(manual & (family == "correspondent"), "correspondent_manual")


def round_robin(df: DataFrame, categories: Sequence[str], category: str, unit: str, order: str, take: int) -> DataFrame:
    """(place, category, unit): the categories in their fixed order give their next unit that none has given, until `take`
    are drawn. Of each queue the driver reads the first `take` times the number of categories, which suffices."""
    w = Window.partitionBy(category).orderBy(order, unit)
    some = df.filter(F.col(category).isin(*categories)).select(category, unit, F.row_number().over(w).alias("_n")).filter(F.col("_n") <= take * len(categories))
    queues: dict[str, list] = {c: [] for c in categories}
    for r in some.orderBy(category, "_n").collect():
        queues[r[0]].append(r[1])
    drawn: dict = {}
    while len(drawn) < take and any(queues.values()):
        for c in categories:
            queues[c] = [u for u in queues[c] if u not in drawn]
            if queues[c] and len(drawn) < take:
                drawn[queues[c].pop(0)] = c
    kinds = dict(df.dtypes)
    return df.sparkSession.createDataFrame([(k + 1, c, u) for k, (u, c) in enumerate(drawn.items())], f"place int, category {kinds[category]}, unit {kinds[unit]}")


# What two pages have in common, nearest first.
LEVELS = ("same_issue_part", "same_issue", "same_edition_part", "same_edition", "other")


def _match(a: dict, b: dict) -> tuple:
    issue, edition, part = a["year"] == b["year"], a["edition"] == b["edition"], a["part"] == b["part"]
    level = 4 if not edition else 0 if issue and part else 1 if issue else 2 if part else 3
    return level, abs(a["records"] - b["records"]), abs(a["year"] - b["year"])


def matched_controls(candidates: DataFrame, controls: DataFrame, key: str, order: str, most: int) -> DataFrame:
    """(candidate, control, level, distance): the first `most` candidates in order each take the nearest control that is
    left, by level, difference of records, difference of years, and a hash of both keys; columns key, year, edition, part, records.

    The candidates are the stated set, at most `most`; every control is compared with them where it is. A task keeps the
    `most` nearest of each candidate, as no more can be taken by others, so at most `most` squared rows leave a task.
    """
    import hashlib

    need = [key, "year", "edition", "part", "records"]
    asked = [r.asDict() for r in candidates.orderBy(order).limit(most).select(*need).collect()]
    if not asked:
        return candidates.sparkSession.createDataFrame([], "candidate string, control string, level string, distance long")

    def tie(a: str, b: str) -> str:
        return hashlib.sha256(f"control\0{a}\0{b}".encode()).hexdigest()

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[int, list] = {k: [] for k in range(len(asked))}
        for batch in batches:
            rows = batch.to_dict("records")
            for k, a in enumerate(asked):
                found = [(*_match(a, b), tie(a[key], b[key]), b[key]) for b in rows]
                best[k] = sorted([*best[k], *found])[:most]
        out = [(k, *x) for k, own in best.items() for x in own]
        if out:
            yield pd.DataFrame(out, columns=["k", "level", "records", "years", "tie", "control"])

    rows = controls.select(F.col(key).cast("string"), *[F.col(c).cast("long") for c in need[1:]])
    asked = [{**a, key: str(a[key]), **{c: int(a[c]) for c in need[1:]}} for a in asked]
    found = rows.mapInPandas(near, "k int, level int, records long, years long, tie string, control string")
    w = Window.partitionBy("k").orderBy("level", "records", "years", "tie", "control")
    queues: dict[int, list] = {}
    for r in found.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= most).orderBy("k", "_n").collect():
        queues.setdefault(r["k"], []).append(r)
    out, used = [], set()
    for k, a in enumerate(asked):
        r = next((r for r in queues.get(k, []) if r["control"] not in used), None)
        if r is not None:
            used.add(r["control"])
            out.append((a[key], r["control"], LEVELS[r["level"]], r["records"]))
    return candidates.sparkSession.createDataFrame(out, "candidate string, control string, level string, distance long")
