"""Attaching legal entities to listings: expansions, name anchors, curated decisions, groups, reasons and reports."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import has_cjk, legal_name, name_flags
from .timeseries import top_k

# Known listing pairs; entity states that may attach; states of a curated decision that count.
PAIRS = (("SAP", "SAP.DE", "adr_home"), ("ASML", "ASML.AS", "adr_home"), ("NVO", "NOVO-B.CO", "adr_home"), ("RIO", "RIO.L", "adr_home"), ("0005.HK", "HSBA.L", "cross_listing"), ("GOOG", "GOOGL", "share_class"), ("LEN", "LENB", "share_class"))
ENTITY_STATES, DECIDED = ("ACTIVE",), ("resolved", "reviewed_safe", "active")
# Reasons why a listing has no entity, the first that applies is named; and those that need a person or another source.
REASONS = (
    "legal_name_search_ambiguous", "legal_name_match_country_incompatible", "missing_listing_country_for_isin_gate", "gleif_lei_found_but_no_compatible_isin", "no_compatible_expanded_isin_for_listing_country",
    "direct_isin_prefix_mismatch_name_unconfirmed", "valid_isin_no_gleif_lei", "openfigi_not_found", "no_listing_name_for_legal_name_search", "legal_name_cache_miss", "legal_name_search_no_match", "yfinance_isin_suspect", "provider_isin_missing", "provider_isin_error",
)
MANUAL = ("legal_name_search_ambiguous", "multiple_compatible_expanded_lei", "direct_isin_prefix_mismatch_name_unconfirmed", "legal_name_match_country_incompatible", "missing_listing_country_for_isin_gate", "multiple_legal_name_anchor_candidates", "needs_manual_review")
PROVIDER = ("valid_isin_no_gleif_lei", "gleif_lei_found_but_no_compatible_isin", "no_compatible_expanded_isin_for_listing_country")


def _has_prefix(isins: str, country: str) -> Column:
    return F.coalesce(F.exists(isins, lambda x: F.substring(x, 1, 2) == F.col(country)), F.lit(False))


def expansion_matches(listings: DataFrame, records: DataFrame) -> DataFrame:
    """Listings (symbol, name_key, country) against expanded entities (lei, name_key, isins): one that has the name and an ISIN of the country attaches with high confidence, several are ambiguous."""
    # Entities are counted by name and country before the join, so a listing meets one row and no blank name meets any.
    prefixes = F.array_distinct(F.transform("isins", lambda x: F.substring(x, 1, 2)))
    spread = records.where("trim(name_key) <> ''").select("name_key", "lei", F.explode(prefixes).alias("country"))
    found = spread.groupBy("name_key", "country").agg(F.countDistinct("lei").alias("n_matches"), F.min("lei").alias("lei"))
    rows = listings.join(found, ["name_key", "country"], "left").withColumn("n_matches", F.coalesce("n_matches", F.lit(0).cast("long")))
    one = F.col("n_matches") == 1
    method = F.when(one, "lei_expansion").when(F.col("n_matches") > 1, "unattached_ambiguous").otherwise("unattached")
    return rows.select("symbol", F.when(one, F.col("lei")).alias("entity_lei"), "n_matches", method.alias("entity_attach_method"), F.when(one, "high").when(F.col("n_matches") > 1, "manual").alias("confidence"))


def name_anchors(listings: DataFrame, candidates: DataFrame) -> DataFrame:
    """The gates of a legal-name anchor, for listings (symbol, name_key, country) and entities found by name (lei, name_key, state, legal_country, isins).

    A listing passes with exactly one entity of its name, in an acceptable state, of its country and with an ISIN of its
    country; else the first gate that no entity passes is the reason.
    """
    # Entities are counted by name and by name and country before the join, so a listing meets one row of each, however many share its name.
    active = candidates.where(F.col("state").isin(*ENTITY_STATES))
    named = active.groupBy("name_key").agg(F.count("*").alias("_state"))
    held = F.when(_has_prefix("isins", "legal_country"), F.col("lei"))
    placed = active.where("legal_country IS NOT NULL").groupBy("name_key", F.col("legal_country").alias("country")).agg(F.count("*").alias("_place"), F.min(held).alias("_lo"), F.max(held).alias("_hi"))
    met = listings.where("name_key <> ''").select("symbol", "name_key", "country").join(named, "name_key").join(placed, ["name_key", "country"], "left")
    lo, hi = F.min("_lo"), F.max("_hi")
    counts = met.groupBy("symbol").agg(F.sum("_state").alias("n_state"), F.coalesce(F.sum("_place"), F.lit(0)).alias("n_place"), F.when(lo.isNull(), 0).when(lo == hi, 1).otherwise(2).alias("n_isin"), lo.alias("lei"))
    rows = listings.join(counts, "symbol", "left")
    reason = (
        F.when(F.coalesce("name_key", F.lit("")) == "", "no_listing_name_for_legal_name_search")
        .when(F.coalesce("n_state", F.lit(0)) == 0, "legal_name_search_no_match")
        .when(F.col("country").isNull(), "missing_listing_country_for_isin_gate")
        .when(F.col("n_place") == 0, "legal_name_match_country_incompatible")
        .when(F.col("n_isin") == 0, "gleif_lei_found_but_no_compatible_isin")
        .when(F.col("n_isin") > 1, "legal_name_search_ambiguous")
    )
    return rows.select("symbol", F.when(reason.isNull(), F.col("lei")).alias("entity_lei"), F.when(reason.isNull(), "confirmed").when(reason == "legal_name_search_ambiguous", "ambiguous").otherwise("rejected").alias("status"), reason.alias("reject_reason"))


def curated(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """rows (symbol, entity_lei, entity_legal_name, entity_attach_method) overwritten by the last valid decision (seq) of each symbol."""
    valid = decisions.where((F.coalesce("lei", F.lit("")) != "") & (F.coalesce("legal_name", F.lit("")) != "") & F.coalesce("lifecycle_state", F.lit("resolved")).isin(*DECIDED))
    last = top_k(valid, ["symbol"], [F.desc("seq")], 1).select("symbol", F.col("lei").alias("_lei"), F.col("legal_name").alias("_name"))
    out = rows.join(last, "symbol", "left")
    ours = F.col("_lei").isNotNull()
    return out.select("symbol", F.coalesce("_lei", "entity_lei").alias("entity_lei"), F.coalesce("_name", "entity_legal_name").alias("entity_legal_name"), F.when(ours, "curated_identity").otherwise(F.col("entity_attach_method")).alias("entity_attach_method"), F.when(ours, "reviewed_safe").alias("review_state"))


def group_profile(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """How many listings (symbol, lei, name_key) are one hop away by LEI, name or known pair, themselves included, and which comes first.

    Sizes are counts by key, less those that share both keys, so no group is gathered; pairs add partners that share neither key.
    """
    sizes = rows
    for keys, n in ((["lei"], "l"), (["name_key"], "n"), (["lei", "name_key"], "b")):
        known = rows.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias(f"_{n}"), F.min("symbol").alias(f"_{n}_first"))
        sizes = sizes.join(known, keys, "left")
    both = pairs.select(F.col("left").alias("symbol"), F.col("right").alias("partner")).unionAll(pairs.select("right", "left")).distinct()
    other = rows.select(F.col("symbol").alias("partner"), F.col("lei").alias("_plei"), F.col("name_key").alias("_pname"))
    apart = ~(F.coalesce(F.col("lei") == F.col("_plei"), F.lit(False)) | F.coalesce(F.col("name_key") == F.col("_pname"), F.lit(False)))
    partners = both.join(rows, "symbol").join(other, "partner").groupBy("symbol").agg(F.count_if(apart).alias("_p"), F.min("partner").alias("_p_first"))
    n = lambda c: F.coalesce(c, F.lit(0))
    by_keys = F.when(F.col("lei").isNull() & F.col("name_key").isNull(), 1).otherwise(n("_l") + n("_n") - n("_b"))
    out = sizes.join(partners, "symbol", "left").withColumn("group_size", (by_keys + n("_p")).cast("long"))
    return out.select("symbol", F.when(F.col("group_size") > 1, "multi_listing_candidate").otherwise("single_listing").alias("listing_group_kind"), "group_size", F.least("symbol", "_l_first", "_n_first", "_p_first").alias("group_first_symbol"))


def unattached_reasons(rows: DataFrame) -> DataFrame:
    """reasons, primary_reason and decision_bucket of listings without an entity (symbol, mapping_status, name_reject, gate_reject, direct_reject, isin_status, direct_lei)."""
    isin = F.when((F.col("isin_status") == "success") & F.col("direct_lei").isNull(), "valid_isin_no_gleif_lei").when(F.col("isin_status") == "suspect", "yfinance_isin_suspect").when(F.col("isin_status").isin("missing", "not_found"), "provider_isin_missing").when(F.col("isin_status") == "error", "provider_isin_error")
    given = F.array_distinct(F.array_compact(F.array(F.when(F.col("mapping_status") == "not_found", "openfigi_not_found"), *(F.nullif(F.col(c), F.lit("")) for c in ("name_reject", "gate_reject", "direct_reject")), isin)))
    out = rows.withColumn("reasons", F.when(F.size(given) == 0, F.array(F.lit("needs_manual_review"))).otherwise(given))
    first = F.coalesce(F.try_element_at(F.array_intersect(F.array(*map(F.lit, REASONS)), "reasons"), F.lit(1)), F.element_at("reasons", 1))
    among = lambda names: F.arrays_overlap("reasons", F.array(*map(F.lit, names)))
    bucket = F.when(among(MANUAL), "needs_manual_review").when(among(PROVIDER), "requires_provider_or_curated_identity").otherwise("fixable_free")
    return out.select("symbol", F.array_join("reasons", ",").alias("reasons"), first.alias("primary_reason"), bucket.alias("decision_bucket"))


def pair_report(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Whether both listings of each pair (left, right, pair_type) have one entity, by which path, or why not. rows: symbol, entity_lei, direct_lei, isin, method."""
    side = lambda name: rows.select(F.col("symbol").alias(name), F.struct("entity_lei", "direct_lei", "isin", "method").alias(f"{name}_row"))
    out = pairs.join(side("left"), "left", "left").join(side("right"), "right", "left")
    a, b = F.col("left_row"), F.col("right_row")
    grouped = F.coalesce(a["entity_lei"] == b["entity_lei"], F.lit(False))
    either = lambda field, value: F.coalesce(a[field] == value, F.lit(False)) | F.coalesce(b[field] == value, F.lit(False))
    path = F.when(either("method", "name_anchor_confirmed"), "name_anchor_confirmed").when(either("method", "lei_expansion"), "direct_anchor_plus_lei_expansion").when((a["method"] == "direct_isin") & (b["method"] == "direct_isin"), "direct_lei").otherwise("other")
    reason = (
        F.when(a.isNull() | b.isNull(), "symbol_missing_from_measurement")
        .when(a["entity_lei"].isNotNull() & b["entity_lei"].isNotNull(), "different_lei")
        .when(a["direct_lei"].isNull() & b["direct_lei"].isNull(), "no_valid_anchor_isin")
        .when(either("method", "unattached_ambiguous"), "ambiguous_lei_expansion_attach")
        .when(a["isin"].isNull() | b["isin"].isNull(), "missing_isin_or_anchor")
        .otherwise("missing_lei")
    )
    return out.select("left", "right", "pair_type", grouped.alias("grouped"), F.when(grouped, path).otherwise("").alias("grouping_path"), F.when(~grouped, reason).otherwise("").alias("not_grouped_reason"))


def lookup_work(listings: DataFrame, known_isins: DataFrame, named: DataFrame, known_leis: DataFrame) -> DataFrame:
    """(kind, id, origin) of ISINs and LEIs that still lack a fact: ISINs of listings, LEIs of direct anchors, then of name candidates; facts with a retryable status count as absent."""
    settled = lambda facts, key: facts.where(~F.col("status").isin("rate_limited", "error")).select(F.col(key).alias("id"))
    isins = listings.where("isin IS NOT NULL").select(F.lit("isin").alias("kind"), F.col("isin").alias("id"), F.lit("listing").alias("origin"), F.lit(0).alias("_o")).join(settled(known_isins, "isin"), "id", "left_anti")
    direct = known_isins.where("lei IS NOT NULL").select(F.lit("lei").alias("kind"), F.col("lei").alias("id"), F.lit("direct_anchor").alias("origin"), F.lit(0).alias("_o"))
    by_name = named.where("lei IS NOT NULL").select(F.lit("lei").alias("kind"), F.col("lei").alias("id"), F.lit("legal_name_candidate").alias("origin"), F.lit(1).alias("_o"))
    leis = direct.unionByName(by_name).join(settled(known_leis, "lei"), "id", "left_anti")
    return isins.unionByName(leis).groupBy("kind", "id").agg(F.min_by("origin", "_o").alias("origin"))


def cached_facts(requests: DataFrame, cache: DataFrame, keys: list[str]) -> DataFrame:
    """Requests (keys, variant) with their cached status: the first variant that is cached, else cache_miss."""
    found = requests.join(cache, [*keys, "variant"], "left").withColumn("hit", F.col("status").isNotNull())
    best = top_k(found, keys, [F.desc("hit"), F.asc("variant")], 1)
    return best.select(*keys, "variant", F.coalesce("status", F.lit("cache_miss")).alias("status"))


def anchor_slices(rows: DataFrame, countries: tuple[str, ...]) -> DataFrame:
    """Attached rows of the named countries, or with East Asian names: those that are looked at by hand."""
    return rows.where(F.col("entity_lei").isNotNull() & (F.col("country").isin(*countries) | has_cjk(F.col("name_key"))))


def attach_audit(rows: DataFrame) -> DataFrame:
    """Rows (symbol, entity_lei, name, method, reviewed) attached without a direct ISIN: risky names, entities of several names, and what may be published."""
    key = legal_name(F.col("name"))
    flags = name_flags(F.col("name"), F.col("name_key"))
    own = rows.where(F.col("entity_lei").isNotNull() & (F.col("method") != "direct_isin")).withColumn("name_key", key)
    own = own.withColumn("name_risk", reduce(lambda x, y: x | y, flags.values()))
    several = own.select("entity_lei", "name_key").distinct().groupBy("entity_lei").agg((F.count("*") > 1).alias("entity_conflict"))
    out = own.join(several, "entity_lei")
    state = F.when(F.coalesce("reviewed", F.lit(False)), "reviewed_safe").when(F.col("name_risk") | F.col("entity_conflict"), "needs_review").otherwise("machine_safe")
    return out.select("symbol", "name_risk", "entity_conflict", state.alias("audit_state"))


def publication_gate(audit: DataFrame) -> DataFrame:
    """One row: audited rows, how many need review or had one, and whether all may be published."""
    n = F.count_if(F.col("audit_state") == "needs_review")
    return audit.agg(F.count("*").alias("n"), n.alias("n_needs_review"), F.count_if(F.col("audit_state") == "reviewed_safe").alias("n_reviewed"), (n == 0).alias("publishable"))


def direct_attach(listings: DataFrame, leis: DataFrame) -> DataFrame:
    """Listings (symbol, isin, isin_status, allowed_prefixes) attached to the legal entity (isin, lei, legal_name; one row an isin) of their own isin.

    A found entity is attached if the isin's country prefix is allowed for the listing, and rejected otherwise.
    """
    isin = F.when(F.col("isin_status") == "success", F.nullif(F.upper(F.trim("isin")), F.lit("")))
    own = listings.withColumn("isin", isin).join(leis.where("isin IS NOT NULL"), "isin", "left")
    found = F.coalesce(F.col("lei") != "", F.lit(False))
    prefix = F.coalesce(F.array_contains("allowed_prefixes", F.substring("isin", 1, 2)), F.lit(False))
    passed = found & prefix
    status = F.when(passed, "passed").when(found, "rejected").otherwise("not_evaluated")
    return own.select(
        "symbol", "isin", prefix.alias("isin_prefix_match"), F.when(passed, "direct_isin").alias("attach_method"), F.when(passed, "direct_isin_to_lei").alias("attach_reason"),
        F.when(passed, F.col("lei")).alias("entity_lei"), F.when(passed, F.col("legal_name")).alias("entity_legal_name"), status.alias("gate_status"),
        F.when(found & ~prefix, "direct_isin_prefix_mismatch_name_unconfirmed").alias("reject_reason"),
    )


def _country(c: Column) -> Column:
    return F.nullif(F.upper(F.trim(c)), F.lit(""))


def home_country_evidence(sources: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """One row a lei: the home country and where it comes from. sources: name and table (lei, legal_name, legal_country, jurisdiction, headquarters_country, seq).

    Of a row the legal country counts first, then the jurisdiction's country, then the headquarters'. The first source with a
    country wins, and in it the first row.
    """
    rows = None
    for place, (name, df) in enumerate(sources):
        legal, area, seat = _country(F.col("legal_country")), _country(F.element_at(F.split("jurisdiction", "-"), 1)), _country(F.col("headquarters_country"))
        field = F.when(legal.isNotNull(), "legal_country").when(area.isNotNull(), "jurisdiction").otherwise("headquarters_country")
        one = df.select(_country(F.col("lei")).alias("lei"), F.coalesce(legal, area, seat).alias("home_country"), field.alias("source_field"), F.lit(name).alias("source_table"), F.trim(F.coalesce("legal_name", F.lit(""))).alias("source_legal_name"), F.lit(place).alias("place"), "seq")
        rows = one if rows is None else rows.unionAll(one)
    known = rows.where("lei IS NOT NULL AND home_country IS NOT NULL")
    first = F.min_by(F.struct("home_country", "source_field", "source_table", "source_legal_name"), F.struct("place", "seq")).alias("e")
    return known.groupBy("lei").agg(first).select("lei", "e.*")


def home_country_plan(entities: DataFrame, evidence: DataFrame, batch: str) -> DataFrame:
    """What becomes of the home country of each resolved entity (entity_id, lei, home_country, resolution_status, publication_batch_id) of a batch.

    action: changed (it had none), already_set, non_empty_conflict_not_overwritten, missing_evidence or no_lei. The lei is the
    row's own, else what follows lei: in its id.
    """
    own = entities.where((F.col("publication_batch_id") == batch) & (F.col("resolution_status") == "resolved"))
    lei = F.coalesce(_country(F.col("lei")), _country(F.regexp_replace("entity_id", "^lei:", "")))
    rows = own.select("entity_id", lei.alias("lei"), _country(F.col("home_country")).alias("current")).join(evidence, "lei", "left")
    there = F.col("home_country").isNotNull()
    action = (
        F.when(F.col("lei").isNull(), "no_lei")
        .when(~there, "missing_evidence")
        .when(F.col("current").isNull(), "changed")
        .when(F.col("current") == F.col("home_country"), "already_set")
        .otherwise("non_empty_conflict_not_overwritten")
    )
    changed = F.coalesce(F.col("current"), F.col("home_country"))
    return rows.select("entity_id", "lei", F.col("current").alias("current_home_country"), F.col("home_country").alias("evidence_country"), changed.alias("new_home_country"), "source_table", "source_field", action.alias("action"))
