"""Registered queries of the support behind attachments and of the gate that follows from it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import publication, support
from .queries import query
from .universe_queries import raw, raw_sql

_K = "c_custkey"
_METHODS = (*support.AUDITED, "direct_isin", "unattached")
ATTACHED = {
    "symbol": f"concat('S', {_K})", "entity_lei": f"concat('LEI', {_K} % 700)", "lei": f"concat('OLD', {_K})", "entity_attach_method": f"CASE {_K} % 8 {' '.join(f'WHEN {i} THEN {chr(39)}{m}{chr(39)}' for i, m in enumerate(_METHODS))} END",
    "curated_identity_source": f"CASE WHEN {_K} % 3 = 0 THEN 'desk' END", "direct_lei": f"CASE WHEN {_K} % 5 = 0 THEN concat('lei', {_K} % 700) END", "direct_prefix_mismatch_lei": f"CASE WHEN {_K} % 7 = 0 THEN concat('LEI', {_K} % 700) END", "isin": f"CASE WHEN {_K} % 2 = 0 THEN concat('DE', {_K}) END",
    "raw_isin": f"CASE WHEN {_K} % 3 = 1 THEN concat('fr', {_K}) END", "foreign_issuer_raw_isin": "''", "foreign_issuer_raw_isin_in_expansion": f"{_K} % 4 = 1", "candidate_lei": f"CASE WHEN {_K} % 29 = 0 THEN concat('LEI', {_K}) END", "foreign_issuer_candidate_lei": f"concat('lei', {_K} % 700)",
    "candidate_legal_name": f"CASE WHEN {_K} % 23 = 0 THEN 'AB Inc' WHEN {_K} % 2 = 0 THEN concat('Name', {_K} % 700, ' Inc') END", "legal_name": f"concat('NAME', {_K} % 700 + CASE WHEN {_K} % 37 = 0 THEN 1 ELSE 0 END)", "internal_candidate_name": f"CASE WHEN {_K} % 3 < 2 THEN concat('Name', {_K} % 700) END",
    "openfigi_name": f"CASE WHEN {_K} % 23 = 0 THEN 'AB' ELSE 'OTHER' END", "listing_name_used_for_legal_name_search": "''", "legal_name_anchor_status": f"CASE WHEN {_K} % 11 = 0 THEN 'confirmed' END", "foreign_issuer_name_match_status": f"CASE WHEN {_K} % 13 = 0 THEN 'matched' END",
    "compatible_isin_gate_status": f"CASE WHEN {_K} % 31 = 0 THEN 'Rejected' ELSE 'passed' END",
}
_MATCHED = f"CASE WHEN {_K} % 3 = 2 THEN array(concat('DE', {_K})) END"
RECORDS = {"isin": f"CASE WHEN {_K} % 3 = 1 THEN concat('FR', {_K}) ELSE concat('DE', {_K}) END", "record_status": f"CASE WHEN {_K} % 6 = 5 THEN 'error' ELSE 'success' END", "lei": f"concat('LEI', {_K} % CASE WHEN {_K} % 10 = 1 THEN 699 ELSE 700 END)"}
REVIEWED = {"symbol": f"concat('s', {_K})", "entity_lei": f"concat('LEI', {_K} % 700)", "attach_method": "'name_anchor_confirmed'", "review_status": f"CASE WHEN {_K} % 5 = 1 THEN 'Approved' ELSE 'rejected' END"}


def _key(c: str) -> str:
    return f"regexp_replace(upper({c}), ' INC$', '')"


_SHORT, _ACRONYM = "length(regexp_replace({0}, '[^A-Z0-9]+', '', 'g')) BETWEEN 1 AND 3", "regexp_full_match({0}, '[A-Z0-9]{{2,4}}( [A-Z0-9]{{2,4}})*')"
_FIGI = _key("openfigi_name")
AUDIT = f"""w AS (SELECT *, upper(entity_lei) AS entity, coalesce(candidate_legal_name, legal_name) AS said FROM att),
x AS (SELECT *, {_key("said")} AS legal FROM w),
grp AS (SELECT entity, coalesce(bool_or(upper(coalesce(candidate_lei, foreign_issuer_candidate_lei)) <> entity), false) AS c1, min(legal) <> max(legal) AS c2, bool_or(lower(compatible_isin_gate_status) = 'rejected') AS c3 FROM x GROUP BY entity),
good AS (SELECT isin, lei FROM rec WHERE record_status = 'success'),
y AS (SELECT x.*, list_contains([{_key("internal_candidate_name")}, {_FIGI}], legal) AS same,
  ((isin IS NOT NULL OR raw_isin IS NOT NULL) AND (coalesce(upper(direct_lei) = entity, false) OR coalesce(direct_prefix_mismatch_lei = entity, false)))
   OR EXISTS (SELECT 1 FROM good WHERE good.lei = entity AND (good.isin = x.isin OR good.isin = upper(x.raw_isin) OR good.isin = x.matched_compatible_isins[1])) AS strong FROM x WHERE entity_attach_method NOT IN ('direct_isin', 'unattached')),
z AS (SELECT *, entity_attach_method IN ('name_anchor_confirmed', 'foreign_issuer_name_anchor_confirmed', 'isin_direct_prefix_mismatch_name_confirmed') AS heur,
  CASE WHEN entity_attach_method LIKE '%curated_identity' THEN curated_identity_source IS NOT NULL WHEN entity_attach_method = 'isin_direct_prefix_mismatch_name_confirmed' THEN true WHEN entity_attach_method = 'foreign_issuer_name_anchor_confirmed' THEN matched_compatible_isins IS NOT NULL OR foreign_issuer_raw_isin_in_expansion ELSE matched_compatible_isins IS NOT NULL END AS det,
  coalesce(legal_name_anchor_status = 'confirmed', false) OR coalesce(foreign_issuer_name_match_status = 'matched', false) OR same AS alike,
  {_SHORT.format("legal")} OR (same AND {_SHORT.format(_FIGI)}) AS short, {_ACRONYM.format("legal")} OR (same AND {_ACRONYM.format(_FIGI)}) AS acro FROM y),
v AS (SELECT z.*, c1, c2, c3, c1 OR c2 OR c3 AS conflict, (short OR acro) AND NOT strong AS risk, heur AND NOT strong AS weak, EXISTS (SELECT 1 FROM rev WHERE upper(rev.symbol) = z.symbol AND rev.entity_lei = entity AND rev.attach_method = entity_attach_method AND lower(rev.review_status) = 'approved') AS okay FROM z JOIN grp USING (entity)),
aud AS (SELECT *, CASE WHEN det AND NOT conflict AND NOT (heur AND risk) AND (NOT heur OR alike) AND NOT weak THEN 'machine_verifiably_safe' WHEN okay AND NOT conflict THEN 'reviewed_safe' ELSE 'needs_review' END AS review_status,
  CASE WHEN NOT heur THEN 'deterministic_non_direct' WHEN strong THEN 'strong_bidirectional_deterministic' ELSE 'weak_or_name_only' END AS support_kind FROM v)"""
_CTES = (raw_sql("att", "customer", {**ATTACHED, "matched_compatible_isins": _MATCHED.replace("array(", "list_value(")}), raw_sql("rec", "customer", RECORDS), raw_sql("rev", "customer", REVIEWED), AUDIT)


def _audit(spark, sf):
    return support.attach_support(raw(spark, sf, "customer", {**ATTACHED, "matched_compatible_isins": _MATCHED}), raw(spark, sf, "customer", RECORDS), raw(spark, sf, "customer", REVIEWED))


@query(
    """SELECT symbol, entity AS entity_lei, entity_attach_method AS attach_method, det AS deterministic_support, strong AS strong_support, alike AS name_match, short AS normalized_name_too_short, acro AS normalized_name_acronym_only, false AS cjk_name_collapsed_to_latin_acronym,
 false AS distinctive_tokens_removed, c1 AS conflicting_candidate_leis, c2 AS conflicting_legal_names, c3 AS country_gate_rejected_in_group, support_kind, review_status,
 CASE WHEN review_status = 'needs_review' THEN CASE WHEN conflict THEN 'conflicting_group_identity' WHEN risk THEN 'name_normalization_requires_review' WHEN weak THEN 'weak_heuristic_requires_review' WHEN NOT det THEN 'missing_deterministic_support' WHEN NOT alike THEN 'legal_name_not_conservatively_matched' ELSE 'needs_review' END END AS review_reason FROM aud""",
    *_CTES,
)
def id13_attach_support(spark, sf):
    return _audit(spark, sf)


@query(
    """SELECT CASE WHEN count(*) FILTER (review_status = 'needs_review') = 0 THEN 'ready_machine_safe' ELSE 'blocked_pending_review' END AS status, count(*) AS non_direct, count(*) FILTER (heur) AS heuristic, count(*) FILTER (review_status = 'machine_verifiably_safe') AS machine_safe,
 count(*) FILTER (review_status = 'reviewed_safe') AS reviewed_safe, count(*) FILTER (review_status = 'needs_review') AS review_required, count(*) FILTER (conflict) AS group_conflicts, count(*) FILTER (weak AND review_status = 'needs_review') AS weak_in_review,
 count(*) FILTER (weak AND review_status = 'reviewed_safe') AS weak_reviewed_safe, count(*) FILTER (heur AND strong) AS strong_heuristic, count(*) FILTER (weak) AS weak_or_name_only FROM aud""",
    *_CTES,
)
def id13_gate_figures(spark, sf):
    return support.gate_figures(_audit(spark, sf))


@query(
    "SELECT blocker FROM (SELECT unnest([CASE WHEN count(*) FILTER (review_status = 'needs_review') > 0 THEN 'publication_gate_not_ready' END, CASE WHEN count(*) FILTER (review_status = 'needs_review') > 0 THEN 'heuristic_review_required' END, CASE WHEN count(*) FILTER (conflict) > 0 THEN 'group_conflicts_present' END]) AS blocker FROM aud) WHERE blocker IS NOT NULL",
    *_CTES,
)
def id13_gate_blockers(spark, sf):
    """What the audit's figures hold back."""
    figures = support.gate_figures(_audit(spark, sf)).withColumns({"unresolved_groups": F.lit(0), "guardrails_unmerged": F.lit(True)})
    return publication.blockers(figures)
