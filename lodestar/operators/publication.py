"""The publication plan of measured entities: master, listing and review rows, and what blocks it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geography import region_of
from ..functions.symbols import lookup

# Confidence by method of attachment, its score, the method of provisional rows, and the gate's state that is ready.
METHOD_CONFIDENCE = {"direct_isin": "high", "lei_expansion": "high", "isin_direct_prefix_mismatch_name_confirmed": "high", "name_anchor_confirmed": "medium", "foreign_issuer_name_anchor_confirmed": "medium"}
SCORES = {"high": "0.95", "medium": "0.75", "low": "0.35", "provisional": "0.2"}
PROVISIONAL_METHOD, READY, SAFE = "provisional_single_listing_candidate", "ready_machine_safe", "machine_verifiably_safe"


def _first(*names: str) -> Column:
    """The first of the columns that isn't empty."""
    return F.coalesce(*(F.nullif(F.trim(n), F.lit("")) for n in names))


def measured(rows: DataFrame) -> DataFrame:
    """Measured listings with what becomes of each: state resolved (an entity with a LEI), provisional (a single listing with a candidate),
    needs_manual_review or null (neither), entity_id, lei, attach_method and attach_confidence."""
    own, candidate = _first("entity_lei", "lei"), _first("candidate_lei", "foreign_issuer_candidate_lei")
    single = F.coalesce(F.col("listing_group_kind") == "single_listing", F.lit(False)) & candidate.isNotNull()
    state = F.when(own.isNotNull(), "resolved").when(single, "provisional").when(F.col("decision_bucket") == "needs_manual_review", "needs_manual_review")
    out = rows.withColumns({"state": state, "_own": own, "_candidate": candidate})
    resolved = F.col("state") == "resolved"
    given = F.coalesce(_first("attachment_confidence"), lookup(METHOD_CONFIDENCE, F.col("entity_attach_method")), F.lit("low"))
    return out.withColumns(
        {
            "entity_id": F.when(resolved, F.concat(F.lit("lei:"), "_own")).when(F.col("state") == "provisional", F.concat(F.lit("provisional:"), "symbol")),
            "listing_lei": F.coalesce("_own", _first("candidate_lei")),
            "attach_method": F.when(resolved, F.coalesce("entity_attach_method", F.lit(""))).when(F.col("state") == "provisional", PROVISIONAL_METHOD),
            "attach_confidence": F.when(resolved, given).when(F.col("state") == "provisional", "provisional"),
        }
    )


def publication_plan(rows: DataFrame, audit: DataFrame, homes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(master, listings, reviews).

    master: one row an entity from its first listing (seq), with its primary listing: complete ones (prices and technicals) first, then at
    home, then no receipt, with a market, with a currency, by symbol. homes: lei, home_country, for entities whose rows name none, one row a
    lei. reviews: listings in need of one, and audited attachments (audit: symbol, entity_id, candidate_lei, attach_method, review_status,
    review_reason) that are not machine-verifiably safe. An entity's listings are only aggregated, so it may have any number.
    """
    seen = measured(rows)
    listed = seen.where(F.col("entity_id").isNotNull())
    resolved = F.col("state") == "resolved"
    name = F.when(resolved, _first("candidate_legal_name", "legal_name")).otherwise(_first("candidate_legal_name", "foreign_issuer_candidate_legal_name"))
    country = F.when(resolved, _first("candidate_legal_country", "home_country")).otherwise(_first("candidate_legal_country"))
    fields = F.struct(
        name.alias("legal_name"), F.coalesce(name, _first("openfigi_name", "internal_candidate_name")).alias("display_name"), F.when(F.upper(country).rlike("^[A-Z]{2}$"), F.upper(country)).alias("_given"),
        F.coalesce("_own", "_candidate").alias("lei"), F.col("attach_confidence").alias("_confidence"), F.col("state").alias("resolution_status"),
    )
    master = listed.groupBy("entity_id").agg(F.min_by(fields, F.struct("seq", "symbol")).alias("v")).select("entity_id", "v.*")
    known = homes.select(F.upper(F.trim("lei")).alias("_lei"), F.col("home_country").alias("_home")).where(F.col("_lei").isNotNull())
    master = master.join(known, F.upper("lei") == F.col("_lei"), "left").withColumn("home_country", F.coalesce("_given", F.nullif(F.col("_home"), F.lit("")))).drop("_given", "_home", "_lei")
    master = master.withColumns({"home_region": F.when(F.col("home_country").isNotNull(), region_of(F.col("home_country"))), "resolution_confidence": score("_confidence")}).drop("_confidence")

    mine = listed.join(master.select("entity_id", F.col("home_country").alias("_home")), "entity_id")
    complete = F.coalesce(F.col("has_prices") & F.col("has_technicals"), F.lit(False))
    at_home = F.coalesce(F.upper(_first("country")) == F.col("_home"), F.lit(False))
    receipt = F.coalesce(F.upper("security_type").contains("ADR"), F.lit(False))
    rank = F.struct((~complete).alias("partial"), (~at_home).alias("away"), receipt.alias("receipt"), _first("exchange_mic").isNull().alias("m"), _first("currency").isNull().alias("c"), F.col("symbol").alias("symbol"))
    best = mine.groupBy("entity_id").agg(F.min(rank).alias("b"), F.count("*").alias("n"), F.count_if(complete).alias("n_complete"))
    whole = ~F.col("b.partial")
    alone = F.when(whole, F.col("n_complete")).otherwise(F.col("n")) == 1
    reason = (
        F.when(alone, F.when(whole, "only_complete_listing").otherwise("only_available_listing"))
        .when(~F.col("b.away"), F.when(whole, "complete_home_listing").otherwise("home_listing"))
        .otherwise(F.when(whole, "deterministic_complete_listing").otherwise("deterministic_available_listing"))
    )
    primary = best.select("entity_id", F.col("b.symbol").alias("primary_listing_symbol"), reason.alias("primary_listing_reason"))
    listings = listed.join(primary, "entity_id").select(
        "symbol", "entity_id", F.col("listing_lei").alias("lei"), F.col("state").alias("resolution_status"), "attach_method", "attach_confidence", score("attach_confidence").alias("resolution_confidence"),
        (F.col("symbol") == F.col("primary_listing_symbol")).alias("is_primary_listing"), F.when(F.col("symbol") == F.col("primary_listing_symbol"), F.col("primary_listing_reason")).alias("primary_listing_reason"),
    )
    why = F.coalesce(_first("entity_attach_reason"), F.col("decision_bucket"))
    asked = seen.where("state = 'needs_manual_review'").select("symbol", F.lit(None).cast("string").alias("entity_id"), F.col("_candidate").alias("candidate_lei"), _first("entity_attach_method").alias("attach_method"), why.alias("review_reason"))
    unsafe = audit.where(~F.coalesce(F.col("review_status") == SAFE, F.lit(False)))
    audited = unsafe.select(_first("symbol").alias("symbol"), _first("entity_id").alias("entity_id"), _first("candidate_lei").alias("candidate_lei"), _first("attach_method").alias("attach_method"), F.coalesce(_first("review_reason"), F.lit("heuristic_attach_requires_review")).alias("review_reason"))
    return master.join(primary, "entity_id"), listings, asked.unionAll(audited)


def score(confidence: str) -> Column:
    return F.coalesce(lookup(SCORES, F.col(confidence)).cast("double"), F.lit(0.0))


def blockers(gate: DataFrame) -> DataFrame:
    """(blocker) of one row of figures: status, review_required, group_conflicts, unresolved_groups, guardrails_unmerged. A null figure is
    none, a null guardrail holds."""
    count = lambda c: F.coalesce(F.col(c), F.lit(0)) > 0
    rules = {
        "publication_gate_not_ready": ~F.coalesce(F.col("status") == READY, F.lit(False)), "heuristic_review_required": count("review_required"), "group_conflicts_present": count("group_conflicts"),
        "unresolved_multi_listing_entities_present": count("unresolved_groups"), "guardrail_pair_merged": ~F.coalesce("guardrails_unmerged", F.lit(True)),
    }
    return gate.select(F.explode(F.array_compact(F.array(*(F.when(c, b) for b, c in rules.items())))).alias("blocker"))
