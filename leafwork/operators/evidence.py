"""Signals of pages worth another look: page quality, eligibility, the rules, and their union with a receipt."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwork.functions.exprs import blank, entity_id, unwave
from leafwork.operators import panel
from leafwork.operators.gates import not_unique, orphans, require_empty

PAGE = ("year", "edition", "part", "page")
SIGNAL = [*PAGE, "rule", "family", "tier", "entity", "directness", "magnitude", "evidence"]

# Rule, signal family, tier and strength by family of manual evidence.
MANUAL = {
    "structural_failure": ("documented_structural_failure", "documented", 1, "hard"),
    "cropped_page": ("documented_cropped_page", "documented", 1, "hard"),
    "cache_error": ("documented_cache_error", "documented", 1, "hard"),
    "documented_rerun": ("documented_rerun", "documented", 2, "strong"),
    "manual_correction": ("documented_manual_correction", "documented", 2, "strong"),
    "location_correction": ("location_correction_cluster", "identity", 4, "supporting"),
    "correspondent_error": ("correspondent_parse_error", "correspondent", 4, "supporting"),
}


@dataclass(frozen=True)
class Policy:
    """Thresholds of the rules."""

    capital_strong: float = 10
    capital_secondary: float = 2
    gap_support: float = 0.8
    gap_strong: float = 5
    gap_corroborated: float = 3
    identity_least: int = 5
    identity_share: float = 0.1
    accounting_year: int = 1934
    accounting_least: int = 3
    accounting_share: float = 0.01
    density_least: int = 10
    density_share: float = 0.25


# ---------------------------------------------------------------- pages


def raw_quality(rows: DataFrame, page: Sequence[str], missing: dict[str, str], transit: str) -> DataFrame:
    """By page raw_rows, raw_missing_<name> for each (name: column) and raw_invalid_transit: a given transit that isn't nn-n."""
    bad = ~blank(F.col(transit)) & ~F.coalesce(F.col(transit).cast("string").rlike("^[0-9]{2}-[0-9]+$"), F.lit(False))
    return rows.groupBy(*page).agg(F.count("*").alias("raw_rows"), *[F.count_if(blank(F.col(c))).alias(f"raw_missing_{n}") for n, c in missing.items()], F.count_if(bad).alias("raw_invalid_transit"))


def clean_quality(rows: DataFrame, page: Sequence[str], ok: dict[str, str], year: str, established: str, statement: str, parts: Sequence[str], total: str, least: int = 3, tolerance: float = 0.01, since: int = 1934, earliest: int = 1776) -> DataFrame:
    """By page clean_rows, invalid_<name> for each (name: column that is 1 if valid), dates that can't be, accounting
    mismatches and the largest share by which parts miss the total.

    The share is that of a positive total, from `since` on, of rows in which at least `least` parts are given.
    """
    given = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in parts])
    sums = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in parts])
    share = F.when((given >= least) & (F.col(year) >= since) & (F.col(total) > 0), F.abs(sums - F.col(total)) / F.col(total))
    sure = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return rows.withColumn("_share", share).groupBy(*page).agg(
        F.count("*").alias("clean_rows"), *[F.count_if(~F.coalesce(F.col(c) == 1, F.lit(False))).alias(f"invalid_{n}") for n, c in ok.items()],
        sure((F.col(established) > F.col(year)) | (F.col(established) < earliest)).alias("invalid_established"), sure(F.col(statement) > F.col(year) + 1).alias("invalid_statement"),
        sure(F.col("_share") > tolerance).alias("accounting_mismatch"), F.max("_share").alias("max_error_share"),
    )


def excluded(pages: DataFrame, exclusions: DataFrame) -> DataFrame:
    """(page key, n_matches) of pages in an interval (year, edition, part, start, end) that is left out; an interval without
    ends is the whole part. Intervals are few by part, so pages keep their place and no pair is kept."""
    key = ["year", "edition", "part"]
    hit = F.col("start").isNull() | F.col("page").between(F.col("start"), F.col("end"))
    e = exclusions.select(*[F.col(c).alias(f"_{c}") for c in key], "start", "end")
    both = pages.select(*PAGE).join(e, [F.col(c) == F.col(f"_{c}") for c in key]).filter(hit)
    return both.groupBy(*PAGE).agg(F.count("*").alias("n_matches"))


def eligible(pages: DataFrame, exclusions: DataFrame, advertisement: Column) -> DataFrame:
    """`pages` with reason (advertisement, excluded or empty) and eligible."""
    out = excluded(pages, exclusions).select(*[F.col(c).alias(f"_{c}") for c in PAGE], "n_matches")
    both = pages.join(out, [F.col(c) == F.col(f"_{c}") for c in PAGE], "left")
    reason = F.when(advertisement, "advertisement").when(F.col("n_matches").isNotNull(), "excluded").otherwise("")
    return both.select(*pages.columns, reason.alias("reason")).withColumn("eligible", F.col("reason") == "")


# ---------------------------------------------------------------- rules


def signal(rows: DataFrame, rule: Column | str, family: Column | str, tier: Column | int, magnitude: Column, evidence: Sequence[str], entity: Column | None = None, directness: Column | str = "observed_page") -> DataFrame:
    """Rows with a page key as signals; the evidence is JSON of the named columns in name order."""
    col = lambda x: x if isinstance(x, Column) else F.lit(x)
    shown = F.to_json(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in sorted(evidence)]))
    return rows.select(*PAGE, col(rule).alias("rule"), col(family).alias("family"), col(tier).cast("int").alias("tier"), (entity if entity is not None else F.lit("")).alias("entity"), col(directness).alias("directness"), magnitude.cast("double").alias("magnitude"), shown.alias("evidence"))


def scope_signals(pages: DataFrame, exclusions: DataFrame) -> DataFrame:
    return signal(excluded(pages, exclusions), "scope_exclusion", "known_negative", 4, F.col("n_matches"), ["n_matches"])


def manual_signals(manual: DataFrame) -> DataFrame:
    """Signals of manual evidence (page key, evidence_family, strength, affected_records, note): an unknown family, another
    strength than its family's, or a repeated row is a violation. Blank affected records count as one."""
    require_empty("manual evidence is repeated", not_unique(manual, manual.columns))
    pick = lambda k: F.create_map(*[x for f, v in MANUAL.items() for x in (F.lit(f), F.lit(v[k]))])[F.col("evidence_family")]
    require_empty("manual evidence of an unknown family or strength", manual.filter(pick(0).isNull() | (pick(3) != F.col("strength"))))
    return signal(manual, pick(0), pick(1), pick(2), F.coalesce(F.col("affected_records"), F.lit(1)), ["affected_records", "evidence_family", "note", "strength"])


def capital_signals(rows: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Signals of two-sided anomalies (page key, kind, factor, entity): see panel.two_sided_anomalies."""
    known = {"missing_middle": ("capital_missing_middle", 2), "factor_strong": ("capital_factor_10", 2), "factor_weak": ("capital_factor_2_10", 4)}
    pick = lambda k: F.create_map(*[x for f, v in known.items() for x in (F.lit(f), F.lit(v[k]))])[F.col("kind")]
    wrong = ((F.col("kind") == "factor_strong") & ~(F.col("factor") >= policy.capital_strong)) | ((F.col("kind") == "factor_weak") & ~((F.col("factor") >= policy.capital_secondary) & (F.col("factor") < policy.capital_strong)))
    require_empty("a capital factor is not what its flag says", rows.filter(pick(0).isNull() | F.coalesce(wrong, F.lit(True)) & (F.col("kind") != "missing_middle")))
    magnitude = F.when(F.col("kind") == "missing_middle", 1.0).otherwise(F.col("factor"))
    return signal(rows, pick(0), F.lit("capital"), pick(1), magnitude, ["factor", "kind"], F.col("entity"))


def gap_places(gaps: DataFrame) -> DataFrame:
    """Gaps (wave, prev_part, prev_page, next_part, next_page, ...) with the pages where they may be: both anchors on one page
    give it with weight 1, anchors on neighbouring pages of a part give both with 0.5, others none."""
    same = (F.col("prev_part") == F.col("next_part")) & (F.col("prev_page") == F.col("next_page"))
    near = (F.col("prev_part") == F.col("next_part")) & (F.col("prev_page") + 1 == F.col("next_page"))
    place = lambda part, page, w: F.struct(F.col(part).alias("part"), F.col(page).alias("page"), F.lit(w).alias("weight"))
    places = F.when(same, F.array(place("prev_part", "prev_page", 1.0))).when(near, F.array(place("prev_part", "prev_page", 0.5), place("next_part", "next_page", 0.5)))
    year, edition = unwave(F.col("wave"))
    return gaps.withColumn("_place", F.explode_outer(places)).select(*gaps.columns, year.alias("year"), edition.alias("edition"), "_place.part", "_place.page", "_place.weight")


def gap_signals(placed: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Signals of the gaps that have a place (with support, charter_agrees, transit_agrees, entity): the weight of the place
    times 5, 3 or 1 for two, one or no agreeing identifiers. Support below the policy's is a violation."""
    require_empty("a gap has too little support", placed.filter(~F.coalesce(F.col("support") >= policy.gap_support, F.lit(False))))
    rows = placed.filter("weight is not null")
    both, any_ = F.col("charter_agrees") & F.col("transit_agrees"), F.col("charter_agrees") | F.col("transit_agrees")
    times = F.when(both, float(policy.gap_strong)).when(any_, float(policy.gap_corroborated)).otherwise(1.0)
    whole = F.col("weight") == 1
    return signal(rows, F.when(whole, "panel_gap_same_page").otherwise("panel_gap_adjacent"), "panel_gap", 3, times * F.col("weight"), ["charter_agrees", "support", "transit_agrees", "weight"], F.col("entity"), F.when(whole, "same_page_bracket").otherwise("adjacent_page_bracket"))


def quality_signals(pages: DataFrame, raw: DataFrame, clean: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Signals of page quality from one pass over the pages with their raw and clean figures: identity fields lost, bad
    transits, rows lost, invalid identities, accounting mismatches."""
    key = lambda df: df.select(*[F.col(c).alias(f"_{c}") for c in PAGE], *[c for c in df.columns if c not in PAGE])
    on = lambda: [F.col(c) == F.col(f"_{c}") for c in PAGE]
    rows = pages.select(*PAGE).join(key(raw), on(), "left").drop(*[f"_{c}" for c in PAGE]).join(key(clean), on(), "left").drop(*[f"_{c}" for c in PAGE])
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    n_raw, n_clean = zero("raw_rows"), zero("clean_rows")
    lost = F.greatest(*[zero(c) for c in raw.columns if c.startswith("raw_missing_")])
    transit = F.greatest(zero("raw_invalid_transit"), zero("invalid_transit") if "invalid_transit" in clean.columns else F.lit(0))
    gone = F.greatest(F.lit(0), n_raw - n_clean)
    identity = F.greatest(zero("invalid_city"), zero("invalid_name"))
    off = zero("accounting_mismatch")
    hit = lambda x, n, least, share: (n > 0) & (x >= least) & (x >= share * n)
    p = policy
    made = [
        (hit(lost, n_raw, p.identity_least, p.identity_share), "raw_identity_field_loss", "identity", 2, lost),
        (hit(transit, n_raw, p.identity_least, p.identity_share), "transit_format_cluster", "identity", 2, transit),
        (hit(gone, n_raw, p.identity_least, p.identity_share), "raw_clean_row_loss", "field_loss", 4, gone),
        (hit(identity, n_clean, p.identity_least, p.identity_share), "clean_identity_failure_cluster", "identity", 2, identity),
        (hit(off, n_clean, p.accounting_least, p.accounting_share) & (F.col("year") >= p.accounting_year), "accounting_mismatch_cluster", "accounting", 2, off),
    ]
    each = F.explode(F.array_compact(F.array(*[F.when(c, F.struct(F.lit(rule).alias("rule"), F.lit(family).alias("family"), F.lit(tier).alias("tier"), x.cast("double").alias("magnitude"))) for c, rule, family, tier, x in made])))
    found = rows.select(*PAGE, n_raw.alias("raw_rows"), n_clean.alias("clean_rows"), each.alias("_s")).select(*PAGE, "raw_rows", "clean_rows", "_s.*")
    return signal(found, F.col("rule"), F.col("family"), F.col("tier"), F.col("magnitude"), ["clean_rows", "raw_rows"])


def density_signals(pages: DataFrame, raw: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Signals of pages whose rows collapse between two full neighbours; a page without rows counts 0."""
    n = raw.select(*[F.col(c).alias(f"_{c}") for c in PAGE], "raw_rows")
    rows = pages.select(*PAGE).join(n, [F.col(c) == F.col(f"_{c}") for c in PAGE], "left").select(*PAGE, F.coalesce("raw_rows", F.lit(0)).alias("n"))
    return signal(panel.density_collapses(rows, ["year", "edition", "part"], "page", "n", policy.density_least, policy.density_share), "page_density_collapse", "structure", 1, F.col("magnitude"), ["n", "neighbors"])


def entity(state: str, city: str, name: str, *more: str) -> Column:
    return entity_id(*[F.col(c) for c in (state, city, name, *more)])


def union_signals(parts: Sequence[DataFrame], pages: DataFrame) -> DataFrame:
    """All signals with a hash and an id; one on an unknown page, or two alike, are violations. Rules that their producer left
    without rows cost nothing."""
    every = reduce(DataFrame.unionByName, [p.select(*SIGNAL) for p in parts])
    body = F.to_json(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in sorted(SIGNAL)]))
    every = every.withColumn("signal_hash", F.sha2(body, 256))
    require_empty("a signal is repeated", not_unique(every, ["signal_hash"]))
    name = lambda df: df.select("*", F.concat_ws("/", *PAGE).alias("page_id"))
    require_empty("a signal is on an unknown page", orphans(name(every), "page_id", name(pages), "page_id").select("page_id", "rule"))
    return name(every).withColumn("signal_id", F.concat(F.lit("signal:"), F.substring("signal_hash", 1, 24)))


def signal_order(signals: DataFrame) -> DataFrame:
    return signals.orderBy(*PAGE, "tier", "rule", "entity", "directness", "evidence")


def receipt(pages: DataFrame, signals: DataFrame) -> DataFrame:
    """One row of counts: pages, eligible and not, by reason, signals, pages with signals, and signals by tier."""
    p = pages.agg(F.count("*").alias("pages"), F.count_if("eligible").alias("eligible"), F.count_if(~F.col("eligible")).alias("ineligible"), F.count_if(F.col("reason") == "advertisement").alias("advertisements"), F.count_if(F.col("reason") == "excluded").alias("excluded"))
    s = signals.agg(F.count("*").alias("signals"), F.countDistinct("page_id").alias("pages_with_signals"), *[F.count_if(F.col("tier") == k).alias(f"tier_{k}") for k in (1, 2, 3, 4)])
    one = F.lit(1).alias("_one")
    return p.select("*", one).join(F.broadcast(s.select("*", one)), "_one").drop("_one")  # a row each
