"""Support of entity attachments that no direct identifier made: what backs each one, what speaks against it, and what may be published."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import symbol
from ..functions.names import legal_name, name_flags

# Methods of attachment that rest on names, that were decided by hand, and that need an audit; states of a review that count.
HEURISTIC = ("name_anchor_confirmed", "foreign_issuer_name_anchor_confirmed", "isin_direct_prefix_mismatch_name_confirmed")
CURATED = ("curated_identity", "manual_curated_identity")
AUDITED = ("lei_expansion", *HEURISTIC, *CURATED)
REVIEWED = ("reviewed_safe", "approved", "machine_safe")
SAFE, BY_REVIEW, OPEN = "machine_verifiably_safe", "reviewed_safe", "needs_review"
CONFLICTS = ("conflicting_candidate_leis", "conflicting_legal_names", "country_gate_rejected_in_group")


def _given(*names: str) -> Column:
    return F.coalesce(*(F.nullif(F.col(n), F.lit("")) for n in names))


def _listing_key(name: str) -> Column:
    """A listing's name as a key; one word in capitals is one already."""
    c = F.nullif(F.col(name), F.lit(""))
    return F.nullif(F.when((c == F.upper(c)) & ~c.contains(" "), c).otherwise(legal_name(c)), F.lit(""))


def entity_conflicts(rows: DataFrame) -> DataFrame:
    """For each entity (_entity): whether its listings name other candidates, several legal names, or one was refused for its country.

    Only least and greatest names are kept, so an entity may have any number of listings.
    """
    name = F.when(_given("candidate_legal_name", "legal_name").isNotNull(), F.coalesce(legal_name(_given("candidate_legal_name", "legal_name")), F.lit("")))
    candidate = symbol(_given("candidate_lei", "foreign_issuer_candidate_lei"))
    flags = (F.bool_or(candidate != F.col("_entity")), F.min(name) != F.max(name), F.bool_or(F.lower("compatible_isin_gate_status") == "rejected"))
    return rows.where(F.col("_entity").isNotNull()).groupBy("_entity").agg(*(F.coalesce(f, F.lit(False)).alias(c) for f, c in zip(flags, CONFLICTS, strict=True)))


def strong_support(rows: DataFrame, records: DataFrame) -> DataFrame:
    """(symbol) of rows whose entity is that of an identifier: found for the listing's own, or recorded for it or a compatible one.

    records: isin, record_status, lei. Identifiers are joined one by one; no list is looked up in another.
    """
    own = F.array_compact(F.array(*(symbol(F.col(c)) for c in ("isin", "raw_isin", "foreign_issuer_raw_isin"))))
    entity = F.col("_entity")
    told = (F.size(own) > 0) & (F.coalesce(symbol(F.col("direct_lei")) == entity, F.lit(False)) | F.coalesce(symbol(F.col("direct_prefix_mismatch_lei")) == entity, F.lit(False)))
    known = rows.where(entity.isNotNull())
    matched = F.transform(F.coalesce("matched_compatible_isins", F.expr("cast(array() as array<string>)")), lambda x: F.upper(F.trim(x)))
    each = known.select("symbol", "_entity", F.explode(F.array_distinct(F.concat(own, matched))).alias("isin"))
    good = records.where("record_status = 'success'").select("isin", symbol(F.col("lei")).alias("_entity"))
    return known.where(told).select("symbol").unionAll(each.join(good, ["isin", "_entity"], "left_semi").select("symbol")).distinct()


def attach_support(rows: DataFrame, records: DataFrame, reviewed: DataFrame) -> DataFrame:
    """symbol, entity_lei, attach_method, deterministic_support, strong_support, name_match, the flags of names and conflicts, review_status
    and review_reason of every row (one a symbol) that an audited method attached.

    Safe without a person is only what has deterministic support, no conflict in its entity and no risky name, and, for methods by name,
    a matching name and an identifier of the entity. reviewed: symbol, entity_lei, attach_method, review_status; an accepted review makes
    safe what has no conflict.
    """
    own = rows.withColumn("_entity", symbol(_given("entity_lei", "lei")))
    method = F.col("entity_attach_method")
    heuristic, curated = method.isin(*HEURISTIC), method.isin(*CURATED)
    some_isin = F.coalesce(F.size("matched_compatible_isins") > 0, F.lit(False))
    support = (
        F.when(curated, _given("curated_identity_source").isNotNull() & _given("entity_lei").isNotNull())
        .when(method == "isin_direct_prefix_mismatch_name_confirmed", _given("direct_lei", "direct_prefix_mismatch_lei", "entity_lei").isNotNull())
        .when(method == "foreign_issuer_name_anchor_confirmed", some_isin | F.coalesce("foreign_issuer_raw_isin_in_expansion", F.lit(False)))
        .otherwise(some_isin)
    )
    listed = ("internal_candidate_name", "openfigi_name", "listing_name_used_for_legal_name_search")
    said = _given("candidate_legal_name", "legal_name")
    audited = own.where(method.isin(*AUDITED)).withColumns({"deterministic_support": support, "_said": said, "_legal": F.nullif(legal_name(said), F.lit("")), **{f"_key_{c}": _listing_key(c) for c in listed}, **{f"_name_{c}": legal_name(F.col(c)) for c in listed}})
    same = F.coalesce(F.array_contains(F.array_compact(F.array(*(f"_key_{c}" for c in listed))), F.col("_legal")), F.lit(False))
    legal_flags = {k: F.coalesce(v, F.lit(False)) for k, v in name_flags(F.col("_said"), F.coalesce("_legal", F.lit(""))).items()}
    listing_flags = [name_flags(F.col(c), F.coalesce(f"_name_{c}", F.lit(""))) for c in listed]
    spread = ("normalized_name_too_short", "normalized_name_acronym_only")
    any_listing = lambda k: reduce(lambda x, y: x | y, (F.coalesce(f[k] & _given(c).isNotNull(), F.lit(False)) for f, c in zip(listing_flags, listed, strict=True)))
    flags = {k: v | (same & any_listing(k)) if k in spread else v for k, v in legal_flags.items()}
    audited = audited.withColumns(flags).withColumn("name_match", (F.coalesce(F.col("legal_name_anchor_status") == "confirmed", F.lit(False))) | F.coalesce(F.col("foreign_issuer_name_match_status") == "matched", F.lit(False)) | same)
    strong = strong_support(own.where(method.isin(*AUDITED)), records).select("symbol", F.lit(True).alias("strong_support"))
    accepted = reviewed.where(F.lower("review_status").isin(*REVIEWED)).select(symbol(F.col("symbol")).alias("_symbol"), symbol(F.col("entity_lei")).alias("_entity"), F.trim("attach_method").alias("entity_attach_method"), F.lit(True).alias("_reviewed")).distinct()
    met = audited.join(strong, "symbol", "left").join(entity_conflicts(own), "_entity", "left")
    met = met.withColumns({"_symbol": symbol(F.col("symbol")), "strong_support": F.coalesce("strong_support", F.lit(False)), **{c: F.coalesce(c, F.lit(False)) for c in CONFLICTS}})
    met = met.join(accepted, ["_symbol", "_entity", "entity_attach_method"], "left")
    strong_one, short = F.col("strong_support"), F.col("normalized_name_too_short") | F.col("normalized_name_acronym_only") | F.col("cjk_name_collapsed_to_latin_acronym")
    met = met.withColumns({"_conflict": reduce(lambda x, y: x | y, map(F.col, CONFLICTS)), "_risk": F.col("distinctive_tokens_removed") | (short & ~strong_one), "_weak": heuristic & ~strong_one})
    safe = F.col("deterministic_support") & ~F.col("_conflict") & ~(heuristic & F.col("_risk")) & (~heuristic | F.col("name_match")) & ~F.col("_weak")
    status = F.when(safe, SAFE).when(F.coalesce("_reviewed", F.lit(False)) & ~F.col("_conflict"), BY_REVIEW).otherwise(OPEN)
    reason = (
        F.when(F.col("_conflict"), "conflicting_group_identity").when(F.col("_risk"), "name_normalization_requires_review").when(F.col("_weak"), "weak_heuristic_requires_review")
        .when(~F.col("deterministic_support"), "missing_deterministic_support").when(~F.col("name_match"), "legal_name_not_conservatively_matched").otherwise(OPEN)
    )
    kind = F.when(~heuristic, "deterministic_non_direct").when(strong_one, "strong_bidirectional_deterministic").otherwise("weak_or_name_only")
    return met.select("symbol", F.col("_entity").alias("entity_lei"), F.col("entity_attach_method").alias("attach_method"), "deterministic_support", "strong_support", "name_match", *flags, *CONFLICTS, kind.alias("support_kind"), status.alias("review_status"), F.when(status == OPEN, reason).alias("review_reason"))


def gate_figures(audit: DataFrame) -> DataFrame:
    """One row of figures over an audit, in the terms of publication.blockers and with the counts behind them."""
    conflict = reduce(lambda x, y: x | y, map(F.col, CONFLICTS))
    heuristic, weak = F.col("support_kind") != "deterministic_non_direct", F.col("support_kind") == "weak_or_name_only"
    state = lambda s: F.col("review_status") == s
    return audit.agg(
        F.when(F.count_if(state(OPEN)) == 0, "ready_machine_safe").otherwise("blocked_pending_review").alias("status"), F.count("*").alias("non_direct"), F.count_if(heuristic).alias("heuristic"), F.count_if(state(SAFE)).alias("machine_safe"),
        F.count_if(state(BY_REVIEW)).alias("reviewed_safe"), F.count_if(state(OPEN)).alias("review_required"), F.count_if(conflict).alias("group_conflicts"), F.count_if(weak & state(OPEN)).alias("weak_in_review"), F.count_if(weak & state(BY_REVIEW)).alias("weak_reviewed_safe"),
        F.count_if(F.col("support_kind") == "strong_bidirectional_deterministic").alias("strong_heuristic"), F.count_if(weak).alias("weak_or_name_only"),
    )
