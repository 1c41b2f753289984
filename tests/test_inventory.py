"""Each operator of the inventory with what implements it; an id without an entry fails."""

from importlib import import_module

import pytest

IDS = [f"{p}{k}" for p, n in (("S", 21), ("K", 14), ("P", 21), ("J", 23), ("A", 28), ("W", 15), ("T", 8), ("U", 8), ("F", 32), ("C", 20), ("R", 15), ("X", 6), ("St", 5), ("H", 24)) for k in range(1, n + 1)]

#: id: functions below leafwork (module.name); queries of plans.queries and plans.audit compare most of them with SQL.
WHERE = """
S1 sources.readers.read_tsv
S2 sources.scans.snapshot sources.scans.snapshot_lines
S3 sources.scans.inventory sources.scans.typed
S4 sources.scans.source_manifest
S5 sources.scans.page_manifest
S6 sources.scans.typed sources.scans.page_manifest
S7 operators.gates.orphans operators.gates.not_functional operators.evidence.union_signals
S8 sources.scans.configured sources.scans.expanded_ranges
S9 sources.readers.read_jsonl
S10 sources.readers.last_by_key
S11 sources.readers.read_tree sources.readers.tree_summary sources.readers.partial_files
S12 operators.records.mapped_artifacts
S13 sources.scans.export_delimited
S14 sources.readers.html_catalog
S15 sources.readers.xml_fields
S16 sources.scans.expanded_ranges sources.readers.expand_ranges
S17 sources.scans.signed_queue
S18 sources.readers.read_config
S19 sources.scans.unknown_identifiers
S20 sources.readers.last_by_key
S21 sources.readers.reservations
K1 sources.writers.write_tsv
K2 sources.writers.write_text
K3 operators.nested.union_all sources.writers.write_tsv
K4 sources.writers.write_jsonl
K5 sources.writers.append_immutable
K6 sources.scans.write_read_only
K7 sources.scans.write_bundle
K8 sources.writers.publish
K9 sources.scans.export_delimited
K10 sources.scans.staging_plan
K11 operators.qc.report sources.scans.write_bundle
K12 sources.scans.save_decision
K13 operators.joins.upsert
K14 streaming.events.reserve
P1 operators.gates.columns operators.qc.columns_needed
P2 operators.gates.row_flags
P3 operators.gates.row_flags
P4 operators.gates.row_flags
P5 operators.gates.row_flags
P6 operators.gates.row_flags
P7 operators.gates.row_flags
P8 operators.gates.row_flags
P9 operators.evidence.raw_quality
P10 operators.evidence.clean_quality
P11 operators.evidence.clean_quality operators.cross.row_total
P12 operators.selection.select_pages
P13 operators.selection.in_window operators.selection.decade_may_match
P14 operators.selection.review_reason
P15 operators.evidence.eligible
P16 operators.records.normalized
P17 operators.corrections.stale
P18 functions.exprs.page_id
P19 operators.records.with_lineage
P20 operators.records.require_disjoint
P21 operators.gates.enforce
J1 operators.panel.present_absent_present
J2 operators.panel.present_absent_present
J3 plans.queries.QUERIES
J4 operators.joins.as_of
J5 operators.joins.as_of
J6 operators.joins.interval_join operators.evidence.excluded
J7 operators.gates.orphans
J8 operators.records.mapped_artifacts
J9 operators.joins.identity_drift
J10 operators.joins.prefer operators.records.page_records
J11 operators.joins.upsert
J12 operators.joins.upsert
J13 operators.corrections.apply_corrections
J14 operators.corrections.apply_reviews
J15 operators.qc.adjudicate
J16 operators.qc.adjudicate
J17 operators.corrections.ledger_mismatches
J18 operators.records.gold_mismatches
J19 operators.gates.orphans
J20 operators.selection.matched_controls
J21 operators.nested.merge_segments operators.records.incomplete_merges
J22 operators.records.first_matching
J23 operators.qc.source_support operators.records.outer_support
A1 operators.evidence.raw_quality
A2 operators.evidence.clean_quality
A3 operators.gates.not_unique
A4 plans.queries.QUERIES
A5 operators.cross.duplicate_keys
A6 operators.panel.coverage
A7 operators.cross.mad_outliers operators.cross.medians
A8 operators.cross.heaping
A9 operators.cross.clusters operators.qc.cluster_flags
A10 operators.qc.unique_flags
A11 operators.qc.summary
A12 operators.qc.source_support
A13 operators.qc.release operators.qc.blockers
A14 plans.queries.QUERIES
A15 operators.ranking.rollup operators.selection.priority
A16 operators.ranking.evidence_hash
A17 operators.ranking.calibration
A18 operators.records.artifact_counts
A19 operators.records.accounting
A20 operators.records.projected_cost
A21 operators.cross.vintage_conflicts
A22 operators.cross.describe
A23 operators.cross.frequencies
A24 operators.panel.coverage
A25 operators.gates.require_empty sources.scans.verify_bundle
A26 operators.records.progress
A27 streaming.events.reserve
A28 operators.evidence.receipt
W1 operators.panel.two_sided_anomalies
W2 operators.panel.panel_gaps
W3 operators.panel.one_sided_jumps
W4 operators.panel.isolated_reversals
W5 operators.panel.persistent_shifts
W6 operators.panel.coverage_changes
W7 operators.panel.entries_exits
W8 operators.panel.density_collapses
W9 operators.joins.as_of
W10 operators.selection.priority
W11 operators.selection.labelled
W12 operators.selection.round_robin
W13 operators.cross.keep_first
W14 operators.ranking.rank_all
W15 operators.gates.not_contiguous
T1 operators.qc.ordered
T2 operators.evidence.signal_order
T3 operators.ranking.capped operators.selection.labelled
T4 operators.selection.select_pages
T5 operators.selection.samples
T6 operators.evidence.signal_order
T7 operators.selection.restored
T8 operators.ranking.priority
U1 operators.joins.as_of
U2 operators.evidence.union_signals
U3 operators.qc.run_checks
U4 operators.records.changed_selection
U5 plans.queries.QUERIES
U6 streaming.events.reserve
U7 operators.selection.first_by_key
U8 operators.nested.union_all
F1 functions.exprs.page_id
F2 functions.exprs.slug
F3 sources.scans.file_key
F4 plans.queries.QUERIES
F5 functions.exprs.sort_key
F6 functions.exprs.file_name
F7 operators.records.title
F8 sources.writers.signed functions.exprs.stable_id
F9 sources.readers.read_tree sources.readers.tree_summary
F10 functions.exprs.entity_id
F11 functions.exprs.sym_ratio
F12 functions.exprs.wilson
F13 functions.exprs.cap
F14 operators.records.segments operators.records.bands
F15 operators.cross.heaping
F16 functions.exprs.fmt_g
F17 functions.exprs.decimal_text
F18 functions.exprs.time_number
F19 operators.panel.spine
F20 functions.exprs.iso_date
F21 sources.scans.run_id
F22 operators.ranking.evidence_hash
F23 operators.selection.review_reason
F24 operators.nested.flatten
F25 operators.records.flatten_two
F26 functions.canonical.canonical_json
F27 operators.records.scalar_text
F28 operators.records.anchor
F29 functions.exprs.to_float
F30 sources.scans.content_range_total
F31 functions.exprs.wave functions.exprs.unwave
F32 operators.selection.manual_category
C1 operators.evidence.union_signals operators.evidence.receipt
C2 operators.selection.priority operators.ranking.calibration operators.selection.labelled
C3 operators.selection.round_robin operators.selection.matched_controls
C4 operators.qc.common_checks
C5 operators.qc.panel_checks
C6 operators.qc.cross_section_checks
C7 operators.qc.make_flags
C8 operators.evidence.capital_signals
C9 operators.evidence.gap_places operators.evidence.gap_signals
C10 operators.records.audit
C11 operators.records.page_records
C12 operators.records.not_ready operators.records.not_current
C13 operators.records.changed_selection
C14 operators.corrections.standardize
C15 operators.cross.vintage_conflicts operators.cross.keep_first
C16 operators.cross.describe operators.cross.frequencies
C17 operators.qc.run_checks operators.qc.report
C18 sources.scans.release_manifest
C19 operators.records.requests operators.records.incomplete_merges
C20 sources.scans.verify_bundle
R1 operators.evidence.scope_signals
R2 operators.evidence.manual_signals
R3 operators.evidence.manual_signals
R4 operators.evidence.manual_signals
R5 operators.evidence.manual_signals
R6 operators.evidence.capital_signals
R7 operators.evidence.capital_signals
R8 operators.evidence.capital_signals
R9 operators.evidence.gap_signals
R10 operators.evidence.quality_signals
R11 operators.evidence.quality_signals
R12 operators.evidence.quality_signals
R13 operators.evidence.quality_signals
R14 operators.evidence.quality_signals
R15 operators.evidence.density_signals
X1 operators.records.page_records
X4 sources.scans.typed
X5 operators.qc.run_checks
X6 operators.corrections.standardize
St1 streaming.events.upsert_latest
St2 streaming.events.quiet_sessions
St3 streaming.events.reserve
St4 operators.qc.adjudicate
St5 operators.records.cached operators.records.split_pending
H1 sources.scans.verified
H2 operators.records.not_current
H3 operators.records.cached
H4 operators.gates.not_unique
H5 sources.scans.overrides operators.records.gold_mismatches
H6 operators.records.acquired
H7 sources.readers.html_catalog operators.selection.in_window operators.joins.upsert
H8 operators.selection.require_authorized
H9 operators.records.with_errors
H10 operators.records.usage_known
H11 operators.records.ordered_signature
H12 sources.writers.signed sources.scans.content_receipt
H13 sources.scans.embedded sources.scans.embedded_bytes
H14 operators.records.page_records operators.records.not_ready
H15 operators.records.image_index
H16 sources.readers.tree_summary
H17 operators.records.anchor_fields
H18 operators.records.requests
H19 operators.records.split_pending
H20 operators.records.effective_types operators.records.progress
H21 operators.records.json_safe
H22 sources.scans.contract
H23 operators.qc.row_key operators.qc.entity
H24 sources.scans.preview
"""

#: What is not there, and why.
OPEN = {
    "X2": "callables of an outside extractor: a boundary of the caller",
    "X3": "a count of pages in a file format that nothing here reads; taken as a column",
}


def entries():
    return dict(line.split(" ", 1) for line in WHERE.strip().split("\n"))


def test_every_id_is_accounted_for():
    assert sorted([*entries(), *OPEN]) == sorted(IDS)


@pytest.mark.parametrize("name", sorted({x for v in entries().values() for x in v.split()}))
def test_it_exists(name):
    module, _, attribute = name.rpartition(".")
    assert getattr(import_module(f"leafwork.{module}"), attribute)
