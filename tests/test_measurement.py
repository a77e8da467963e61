"""The measurement summary against literal rows."""

from lodestar.operators import measurement
from lodestar.plans import measurement_queries as q
from lodestar.plans.support_queries import _audit
from lodestar.plans.universe_queries import raw

DATA = "/root/testdata/sf0.001"
LISTED = {c: "string" for c in q.LISTINGS} | {"foreign_issuer_candidate_evaluated": "boolean", "foreign_issuer_raw_isin_in_expansion": "boolean", "entity_attach_reasons": "array<string>"}
PAIRED, ASKED = "left string, right string, pair_type string, grouped boolean, grouping_path string, reason string", "origin string, lei string, requested boolean, expansion_status string"


def summary(spark, rows, pairs=(), asked=()):
    schema = ", ".join(f"{c} {t}" for c, t in LISTED.items())
    listings = spark.createDataFrame([tuple(r.get(c) for c in LISTED) for r in rows], schema)
    return measurement.measurement_summary(listings, spark.createDataFrame(list(pairs), PAIRED), spark.createDataFrame(list(asked), ASKED), _audit(spark, DATA).limit(0)).first().asDict()


def test_nothing_counts_zero(spark):
    got = summary(spark, [])
    assert {v for k, v in got.items() if k.endswith(("_count", "_rate", "_percentage"))} == {0} and got["decision_bucket_counts"] == {}
    assert (got["accepted_pairs_passed"], got["guardrail_pairs_unmerged"], got["publication_gate_status"]) == (False, True, "ready_machine_safe")


def test_counters_rates_and_maps(spark):
    rows = [
        {"symbol": "A", "isin": "US1", "isin_status": "success", "direct_lei": "l1", "entity_lei": "L1", "entity_attach_method": "direct_isin"},
        {"symbol": "A.DE", "entity_lei": " l1 ", "entity_attach_method": "lei_expansion", "decision_bucket": "fixable_free"},
        {"symbol": "B", "isin_status": "suspect", "isin_error_reason": "", "entity_attach_method": "unattached_no_anchor", "entity_attach_reasons": ["x", "", "y", "x"], "listing_group_kind": "multi_listing_candidate", "listing_group": "B,B.L"},
        {"symbol": "B.L", "entity_lei": "", "entity_attach_method": "unattached_ambiguous", "entity_attach_reasons": ["x"], "listing_group_kind": "multi_listing_candidate", "listing_group": "B,B.L", "candidate_lei": "L9"},
        {"symbol": "C", "entity_attach_method": "unattached_no_anchor", "entity_attach_reasons": None, "foreign_issuer_candidate_evaluated": True, "foreign_issuer_final_gate_status": "rejected", "foreign_issuer_reject_reason": "name_unconfirmed"},
        {},
    ]
    pairs = [("A", "A.DE", "adr_home", True, "direct_anchor_plus_lei_expansion", None), ("TLS.AX", "tls", "share_class", False, None, None), ("B", "B.L", "bare_collision", True, None, None)]
    asked = [("direct", "L1", True, "success"), ("direct", "l1", True, "success"), ("legal_name_candidate", "L1", False, None), ("legal_name_candidate", "L2", None, None), ("direct", " ", True, "error")]
    got = summary(spark, rows, pairs, asked)
    want = {
        "candidate_count": 6, "attached_count": 2, "attached_rate": 0.3333, "isin_found_count": 1, "lei_found_rate_among_isins": 1.0, "isin_suspect_reasons": {"unknown": 1}, "anchor_lei_count": 1, "entity_groups_formed": 1, "unresolved_multi_listing_entities_count": 1,
        "entity_attach_reasons_counts": {"x": 3, "y": 1}, "decision_bucket_counts": {"fixable_free": 1}, "unresolved_percentage": 0.5, "candidate_lei_retained_provisional_count": 1, "foreign_issuer_fallback_reject_reason_counts": {"name_unconfirmed": 1},
        "foreign_issuer_fallback_raw_isin_in_expansion_counts": {"false": 1}, "unresolved_no_isin_count": 4, "acceptance_pairs_grouped": 2, "pairs_grouped_direct_anchor_plus_lei_expansion": 1, "accepted_pairs_passed": True, "guardrail_pairs_unmerged": False,
        "gleif_lei_expansion_requested_count": 1, "gleif_lei_expansion_requested_by_origin": {"direct": 1}, "gleif_lei_expansion_excluded_by_origin": {"legal_name_candidate": 2}, "gleif_lei_expansion_legal_name_candidate_requested_count": 1,
        "gleif_lei_expansion_legal_name_candidate_not_requested_count": 1, "gleif_lei_expansion_status_counts": {"success": 1},
    }
    assert {k: got[k] for k in want} == want


def test_listings_are_scanned_once(spark):
    rows = raw(spark, DATA, "customer", {**q.LISTINGS, "entity_attach_reasons": q._REASONS})
    empty = summary_frames(spark)
    plan = measurement.measurement_summary(rows, *empty)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def summary_frames(spark):
    audit = spark.createDataFrame([], _audit(spark, DATA).schema)
    return spark.createDataFrame([], PAIRED), spark.createDataFrame([], ASKED), audit
