"""What a run of entity attachment came to: some eighty counters, rates and counts by reason over listings, test pairs, requests and the audit, as one row.

Every row tells what it counts for as tags (name, key). Tags are counted with map-side combine, so a listing is read once and only
distinct tags are shuffled; the last aggregate turns the counts into columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import symbol
from .support import CURATED

# Methods of attachment, kinds of pairs and decisions, as the counters name them.
MISMATCH, EXPANSION, ANCHOR, FOREIGN = "isin_direct_prefix_mismatch_name_confirmed", "lei_expansion", "name_anchor_confirmed", "foreign_issuer_name_anchor_confirmed"
ATTACHED = ("direct_isin", MISMATCH, EXPANSION, ANCHOR, FOREIGN)
BUCKETS = {"fixable_free": "fixable_free", "provider_or_curated": "requires_provider_or_curated_identity", "review": "needs_manual_review"}
GROUPING = {"pairs_grouped_direct_anchor_plus_lei_expansion": "direct_anchor_plus_lei_expansion", "pairs_grouped_direct_lei": "direct_lei", "pairs_grouped_name_anchor_confirmed": "name_anchor_confirmed"}
GUARDRAIL = ("TLS", "TLS.AX")


def _is(c: str, *values: str) -> Column:
    return F.coalesce(F.col(c).isin(*values), F.lit(False))


def _given(*names: str) -> Column:
    return F.coalesce(*(F.nullif(F.trim(F.col(n)), F.lit("")) for n in names))


def listing_flags() -> dict[str, Column]:
    """Counters of listings: what a row has to be to count."""
    method, found = "entity_attach_method", _given("isin").isNotNull() & _is("isin_status", "success")
    unattached, tried = symbol(_given("entity_lei", "lei")).isNull(), F.coalesce(F.col("foreign_issuer_candidate_evaluated"), F.lit(False))
    provisional = unattached & _given("candidate_lei").isNotNull()
    kind = F.upper(F.concat_ws(" ", "security_type", "symbol"))
    return {
        "candidate_count": F.lit(True), "attached_count": _is(method, *ATTACHED), "isin_found_count": found, "isin_suspect_count": _is("isin_status", "suspect"), "lei_found_count": _given("direct_lei").isNotNull(),
        "listings_attached_direct_isin": _is(method, "direct_isin", MISMATCH), "listings_attached_direct_isin_prefix_mismatch_name_confirmed": _is(method, MISMATCH), "listings_attached_via_lei_expansion": _is(method, EXPANSION),
        "listings_attached_name_anchor_confirmed": _is(method, ANCHOR), "listings_attached_foreign_issuer_name_anchor_confirmed": _is(method, FOREIGN), "listings_unattached_no_anchor": _is(method, "unattached_no_anchor"),
        "listings_unattached_ambiguous": _is(method, "unattached_ambiguous"), "foreign_issuer_fallback_evaluated_count": tried, "foreign_issuer_fallback_rejected_count": tried & _is("foreign_issuer_final_gate_status", "rejected"),
        "curated_identity_attach_count": _is(method, *CURATED), "candidate_lei_retained_provisional_count": provisional, "unresolved_single_listing_provisional_candidates_count": provisional & _is("listing_group_kind", "single_listing"),
        **{f"{k}_count": _is("decision_bucket", v) for k, v in BUCKETS.items()},
        "adrs_mapping_to_depositary_or_ambiguous_lei_count": (kind.contains("ADR") | kind.contains("DEPOSITARY")) & F.coalesce(symbol(F.col("lei_role")).isin("DEPOSITARY", "AMBIGUOUS"), F.lit(False)),
        "unresolved_no_isin_count": _given("isin").isNull() & ~_is("isin_status", "suspect"), "unresolved_no_lei_count": _given("isin").isNotNull() & _given("entity_lei").isNull(), "openfigi_not_found_count": _is("openfigi_status", "not_found"),
    }


def listing_groups() -> dict[str, Column]:
    """Grouped counters of listings: the key a row counts under, null where it does not."""
    flags = listing_flags()
    tried, rejected, lost = (flags[c] for c in ("foreign_issuer_fallback_evaluated_count", "foreign_issuer_fallback_rejected_count", "listings_unattached_no_anchor"))
    kind = _given("listing_group_kind")
    bucket = reduce(lambda c, v: c | v, (_is("decision_bucket", v) for v in BUCKETS.values()))
    return {
        "isin_suspect_reasons": F.when(flags["isin_suspect_count"], F.coalesce(_given("isin_error_reason"), F.lit("unknown"))), "entity_attach_reason_counts": _given("entity_attach_reason"),
        "compatible_isin_gate_status_counts": _given("compatible_isin_gate_status"), "compatible_isin_gate_reject_reason_counts": _given("compatible_isin_gate_reject_reason"), "decision_bucket_counts": F.when(bucket, F.col("decision_bucket")),
        "foreign_issuer_fallback_reject_reason_counts": F.when(rejected, _given("foreign_issuer_reject_reason")), "foreign_issuer_fallback_expansion_status_counts": F.when(tried, _given("foreign_issuer_lei_expansion_status")),
        "foreign_issuer_fallback_raw_isin_in_expansion_counts": F.when(tried, F.coalesce(F.col("foreign_issuer_raw_isin_in_expansion"), F.lit(False)).cast("string")),
        "requires_provider_or_curated_identity_by_listing_group_kind": F.when(_is("decision_bucket", BUCKETS["provider_or_curated"]), kind), "manual_review_by_listing_group_kind": F.when(_is("decision_bucket", BUCKETS["review"]), kind),
        "tail_without_anchor_by_listing_group_kind": F.when(lost, kind),
    }


def _distinct() -> dict[str, Column]:
    """What is counted once: entities of direct listings, entities, and unresolved groups of listings (listing_group: any key of the group)."""
    unattached = symbol(_given("entity_lei", "lei")).isNull()
    return {
        "anchor_lei_count": F.when(_is("entity_attach_method", "direct_isin", MISMATCH), symbol(F.col("direct_lei"))), "entity_groups_formed": symbol(_given("entity_lei", "lei")),
        "unresolved_multi_listing_entities_count": F.when(unattached & _is("listing_group_kind", "multi_listing_candidate"), F.coalesce(_given("listing_group"), F.col("symbol"))),
    }


#: A frame with its flags, its keyed counters and its counters over the elements of an array.
Counted = tuple[DataFrame, dict[str, Column], dict[str, Column], dict[str, Column]]


def _tags(rows: DataFrame, flags: dict[str, Column], keyed: dict[str, Column], lists: dict[str, Column]) -> DataFrame:
    """(name, key, n): rows that meet a flag (no key), and rows of each key; of lists, rows for each of their elements."""
    tag = lambda name, key: F.struct(F.lit(name).alias("name"), key.cast("string").alias("key"))
    one = F.array(*(F.when(c, tag(n, F.lit(None))) for n, c in flags.items()), *(F.when(F.nullif(k, F.lit("")).isNotNull(), tag(n, k)) for n, k in keyed.items()))
    elements = lambda name, c: F.transform(F.filter(F.coalesce(c, F.expr("cast(array() as array<string>)")), lambda x: x != ""), lambda x: tag(name, x))
    many = [elements(n, c) for n, c in lists.items()]
    return rows.select(F.explode(F.concat(F.array_compact(one), *many)).alias("t")).groupBy("t.name", "t.key").agg(F.count("*").alias("n"))


def _pairs(pairs: DataFrame) -> Counted:
    """pairs: left, right (symbols), pair_type, grouped, grouping_path, reason. A guardrail pair is one that must stay apart."""
    grouped = F.coalesce("grouped", F.lit(False))
    guard = _is("pair_type", "bare_collision") | F.coalesce(F.array_sort(F.array(symbol(F.col("left")), symbol(F.col("right")))) == F.array(*map(F.lit, GUARDRAIL)), F.lit(False))
    flags = {"acceptance_pairs_grouped": grouped, **{n: grouped & _is("grouping_path", path) for n, path in GROUPING.items()}, "pairs_blocked_no_valid_anchor": ~grouped & _is("reason", "no_valid_anchor_isin")}
    flags |= {f"{k}_pairs_grouped": grouped & _is("pair_type", k) for k in ("adr_home", "share_class")}
    return pairs, flags | {"_accepted": ~guard, "_accepted_apart": ~guard & ~grouped, "_guarded_together": guard & grouped}, {}, {}


def _requests(requests: DataFrame) -> Counted:
    """requests: origin, lei, requested (else excluded), expansion_status. An entity counts once for an origin and once in all, its status once."""
    lei = symbol(F.col("lei"))
    rows = requests.where(lei.isNotNull()).select(lei.alias("lei"), "origin", F.coalesce("requested", F.lit(False)).alias("requested"), "expansion_status")
    # One row an entity: its origins are few, so they fit in it.
    each = rows.groupBy("lei").agg(F.collect_set(F.when(F.col("requested"), F.col("origin"))).alias("asked"), F.collect_set(F.when(~F.col("requested"), F.col("origin"))).alias("left_out"), F.bool_or("requested").alias("requested"), F.max("expansion_status").alias("status"))
    legal = F.array_contains(F.array_union("asked", "left_out"), "legal_name_candidate")
    flags = {"gleif_lei_expansion_requested_count": F.col("requested"), "gleif_lei_expansion_legal_name_candidate_requested_count": legal & F.col("requested"), "gleif_lei_expansion_legal_name_candidate_not_requested_count": legal & ~F.col("requested")}
    return each, flags, {"gleif_lei_expansion_status_counts": F.col("status")}, {"gleif_lei_expansion_requested_by_origin": F.col("asked"), "gleif_lei_expansion_excluded_by_origin": F.col("left_out")}


def _audit(audit: DataFrame) -> Counted:
    """audit: what support.attach_support gives."""
    risk = F.col("normalized_name_too_short") | F.col("normalized_name_acronym_only") | F.col("cjk_name_collapsed_to_latin_acronym") | F.col("distinctive_tokens_removed")
    heuristic, weak, status = F.col("support_kind") != "deterministic_non_direct", F.col("support_kind") == "weak_or_name_only", F.col("review_status")
    return audit, {
        "non_direct_attach_audit_count": F.lit(True), "heuristic_attach_audit_count": heuristic, "heuristic_strong_deterministic_support_count": heuristic & ~weak, "heuristic_weak_or_name_only_count": weak, "heuristic_attach_normalization_risk_count": risk,
        "review_routed_weak_heuristic_count": weak & (status == "needs_review"), "reviewed_safe_heuristic_count": heuristic & (status == "reviewed_safe"), "publication_gate_review_required_count": status == "needs_review",
        "publication_gate_machine_safe_count": status == "machine_verifiably_safe", "name_anchor_precision_audit_count": F.col("attach_method") == ANCHOR,
    }, {}, {}


def measurement_summary(rows: DataFrame, pairs: DataFrame, requests: DataFrame, audit: DataFrame) -> DataFrame:
    """One row: counters (0 where nothing counts), rates with four places (0 of none), maps from key to count, and two verdicts on the pairs.

    rows: listings with the outcome of every gate, one a symbol; see _pairs, _requests and _audit for the others. Flags and keys that are null
    do not count. entity_groups_formed is the number of entities with two listings or more. Members of groups and samples of symbols are
    not here, since they grow with the listings: they are rows of `entity_members`.
    """
    given: list[Counted] = [(rows, listing_flags(), listing_groups(), {"entity_attach_reasons_counts": F.col("entity_attach_reasons")}), _pairs(pairs), _requests(requests), _audit(audit)]
    apart = _distinct()
    tags = reduce(DataFrame.unionAll, [_tags(df, flags, keyed | apart if i == 0 else keyed, lists) for i, (df, flags, keyed, lists) in enumerate(given)])
    name, n = F.col("name"), F.col("n")
    total = lambda x: F.coalesce(F.sum(F.when(name == x, n)), F.lit(0))
    flags = [x for _, own, _, _ in given for x in own]
    maps = [x for _, _, keyed, lists in given for x in (*keyed, *lists)]
    counts = {x: total(x) for x in flags} | {x: F.count_if((name == x) & (n > 1) if x == "entity_groups_formed" else name == x) for x in apart}
    entries = {x: F.map_from_entries(F.array_sort(F.collect_list(F.when(name == x, F.struct("key", "n"))))) for x in maps}
    one = tags.agg(*(c.alias(x) for x, c in (counts | entries).items()))
    rate = lambda part, whole: F.coalesce(F.round(F.try_divide(F.col(part).cast("double"), F.col(whole)), 4), F.lit(0.0))
    lost = (F.col("listings_unattached_no_anchor") + F.col("listings_unattached_ambiguous")).cast("double")
    rates = {f"{x}_rate": rate(f"{x}_count", "candidate_count") for x in ("attached", "isin_found", *BUCKETS)} | {
        "lei_found_rate_among_isins": rate("lei_found_count", "isin_found_count"), "unresolved_percentage": F.coalesce(F.round(F.try_divide(lost, F.col("candidate_count")), 4), F.lit(0.0)),
        "accepted_pairs_passed": (F.col("_accepted") > 0) & (F.col("_accepted_apart") == 0), "guardrail_pairs_unmerged": F.col("_guarded_together") == 0,
        "publication_gate_status": F.when(F.col("publication_gate_review_required_count") == 0, "ready_machine_safe").otherwise("blocked_pending_review"),
    }
    return one.select(*(c for c in one.columns if not c.startswith("_")), *(c.alias(x) for x, c in rates.items()))


def entity_members(rows: DataFrame) -> DataFrame:
    """(entity_lei, symbol) of entities with two listings or more: the groups that entity_groups_formed counts. Entities are found by a count, members by a join."""
    own = rows.select(symbol(_given("entity_lei", "lei")).alias("entity_lei"), "symbol").where("entity_lei IS NOT NULL")
    return own.join(own.groupBy("entity_lei").count().where("count > 1").select("entity_lei"), "entity_lei", "left_semi")
