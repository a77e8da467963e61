"""Gates that attach a legal entity to a listing, one after the other: only listings without an entity go on to the next gate."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import symbol
from ..functions.names import legal_name
from ..functions.symbols import let

# Why an identifier is suspect of another market's prefix.
MISMATCHES = ("provider_returned_alternate_market_instrument", "provider_listing_mismatch", "isin_prefix_mismatch")


def us_listing() -> Column:
    """Whether the listing, its provider's country or its exchange code says US."""
    return F.coalesce(symbol(F.col("country")) == "US", F.lit(False)) | F.coalesce(symbol(F.col("provider_country")) == "US", F.lit(False)) | F.coalesce(symbol(F.col("exchange_code")) == "US", F.lit(False))


def plain_name(name: Column) -> Column:
    """The key of a name for foreign issuers: the conservative one without PUBLIC at its end; null where nothing is left."""
    return let(F.regexp_replace(legal_name(name), " PUBLIC$", ""), lambda n: F.nullif(n, F.lit("")))


def _named_alike(*listed: str, legal: str) -> Column:
    """Whether a listing's provider name or own name is the legal name."""
    key = plain_name(F.col(legal))
    return F.coalesce(F.array_contains(F.array_compact(F.array(*(plain_name(F.col(c)) for c in listed))), key), F.lit(False))


def direct_isins(listings: DataFrame, records: DataFrame) -> DataFrame:
    """listings with _lei and _why: the entity of a valid ISIN. records: isin, record_status, lei, legal_name, one row an ISIN."""
    known = records.select(F.col("isin").alias("_isin"), "record_status", F.col("lei").alias("_found"))
    valid = F.coalesce(F.col("isin_status") == "success", F.lit(False))
    rows = listings.join(known, valid & (symbol(F.col("raw_isin")) == F.col("_isin")), "left")
    good = F.coalesce(F.col("record_status") == "success", F.lit(False)) & F.col("_found").isNotNull()
    why = F.when(~valid, F.concat(F.lit("isin_"), F.coalesce("isin_status", F.lit("missing")))).when(~good, "valid_isin_no_gleif_lei")
    return rows.select(*listings.columns, F.when(why.isNull(), F.col("_found")).alias("_lei"), why.alias("_why"))


def prefix_mismatches(listings: DataFrame, records: DataFrame) -> DataFrame:
    """listings with _lei and _why: the entity of a suspect ISIN of another market, for US listings whose name it has.

    _why is null as well where the gate does not apply: the ISIN is not suspect for a mismatch.
    """
    known = records.select(F.col("isin").alias("_isin"), "record_status", F.col("lei").alias("_found"), F.col("legal_name").alias("_legal"))
    applies = F.coalesce((F.col("isin_status") == "suspect") & F.col("isin_error_reason").isin(*MISMATCHES), F.lit(False))
    rows = listings.join(known, applies & us_listing() & (symbol(F.col("raw_isin")) == F.col("_isin")), "left")
    good = F.coalesce(F.col("record_status") == "success", F.lit(False)) & F.col("_found").isNotNull()
    why = (
        F.when(~us_listing(), "direct_prefix_mismatch_non_us_listing")
        .when(symbol(F.col("raw_isin")).isNull(), "missing_raw_isin")
        .when(~good, "direct_prefix_mismatch_no_gleif_lei")
        .when(~_named_alike("provider_name", "name", legal="_legal"), "direct_prefix_mismatch_name_unconfirmed")
    )
    return rows.select(*listings.columns, F.when(applies & why.isNull(), F.col("_found")).alias("_lei"), F.when(applies, why).alias("_why"))


def foreign_issuers(listings: DataFrame, candidates: DataFrame, expansions: DataFrame) -> DataFrame:
    """listings with _lei, _why and diagnostics: the one entity found by name that a US listing of a foreign issuer can be.

    candidates: symbol, place (order), lei, legal_name and its countries (legal_country, headquarters_country, jurisdiction). expansions:
    lei, expansion_status, isins. A candidate is confirmed with the listing's name, an expansion, and in it an ISIN of one of its countries or
    the listing's own ISIN if that is not a US one. Exactly one confirmed candidate attaches; of several all are named; of none the first
    candidate says why. issuer_lei, issuer_name_match, n_expanded and n_issuer_isins are that candidate's.
    """
    # Names are made plain on either side of the join, once a listing and once a candidate.
    keyed = listings.withColumns({"_own": symbol(F.col("raw_isin")), "_us": us_listing(), "_names": F.array_compact(F.array(plain_name(F.col("provider_name")), plain_name(F.col("name"))))})
    named = candidates.select(F.col("symbol").alias("_symbol"), "place", F.col("lei").alias("_candidate"), plain_name(F.col("legal_name")).alias("_legal"), F.array_compact(F.array_distinct(F.transform(F.array("legal_country", "headquarters_country", "jurisdiction"), lambda c: F.when(F.length(F.trim(c)) == 2, F.upper(F.trim(c)))))).alias("_prefixes"))
    grown = expansions.select(F.col("lei").alias("_candidate"), "expansion_status", F.transform("isins", lambda x: F.upper(F.trim(x))).alias("_isins"))
    met = keyed.join(named.join(grown, "_candidate", "left"), F.col("_us") & (F.col("symbol") == F.col("_symbol")), "left")
    ready = F.coalesce(F.col("expansion_status") == "success", F.lit(False))
    own = F.coalesce(F.array_contains("_isins", F.col("_own")) & ~F.col("_own").startswith("US"), F.lit(False))
    met = met.withColumns({"_alike": F.coalesce(F.array_contains("_names", F.col("_legal")), F.lit(False)), "_issuer": F.coalesce(F.size(F.filter(F.array_distinct("_isins"), lambda x: F.array_contains(F.col("_prefixes"), F.substring(x, 1, 2)))), F.lit(0)), "_by_own": own, "_ready": ready})
    why = (
        F.when(~F.col("_alike"), "name_unconfirmed")
        .when(F.col("expansion_status").isNull(), "lei_expansion_missing")
        .when(~F.col("_ready"), "lei_expansion_not_success")
        .when((F.col("_issuer") == 0) & ~F.col("_by_own"), "no_confirming_foreign_issuer_isin")
    )
    met = met.withColumn("_reason", why)
    confirmed = F.col("_symbol").isNotNull() & F.col("_reason").isNull()
    told = F.struct("_candidate", "_reason", F.col("_alike").alias("alike"), F.coalesce(F.size("_isins"), F.lit(0)).alias("n"), F.when(F.col("_ready"), F.col("_issuer")).otherwise(0).alias("n_issuer"))
    found = met.groupBy("symbol").agg(
        F.first(F.struct(*listings.columns, "_us")).alias("_row"), F.array_sort(F.collect_list(F.when(confirmed, F.col("_candidate")))).alias("_confirmed"), F.min_by(told, "place").alias("_first"), F.min_by(told, F.when(confirmed, F.col("place"))).alias("_best"),
    )
    n = F.size("_confirmed")
    reason = F.when(~F.col("_row._us"), "not_us_listing").when(F.col("_first").isNull() | F.col("_first._candidate").isNull(), "no_legal_name_candidate").when(n > 1, "multiple_foreign_issuer_candidates").when(n == 0, F.col("_first._reason"))
    shown = F.coalesce("_best", "_first")
    return found.select(
        *(F.col(f"_row.{c}").alias(c) for c in listings.columns), F.when(n == 1, F.col("_confirmed")[0]).alias("_lei"), reason.alias("_why"), F.when(n > 1, F.array_join("_confirmed", ",")).otherwise(shown["_candidate"]).alias("issuer_lei"),
        shown["alike"].alias("issuer_name_match"), shown["n"].alias("n_expanded"), shown["n_issuer"].alias("n_issuer_isins"),
    )


def waterfall(listings: DataFrame, gates: Sequence[tuple[str, Callable[[DataFrame], DataFrame]]]) -> DataFrame:
    """symbol, entity_lei, method (the gate that attached) and refused: for each gate that a listing came to and failed, in order, gate and reason.

    A gate takes rows of listings and returns them with _lei and _why, one row a listing. Rows that have an entity leave at once, so a later
    gate joins only what is left. What the last gate says of attached and of other rows comes from one pass over it.
    """
    left, out = listings.withColumn("refused", F.expr("cast(array() as array<struct<gate:string,reason:string>>)")), []
    for i, (name, gate) in enumerate(gates):
        tried = gate(left)
        more = F.when(F.col("_why").isNotNull(), F.array(F.struct(F.lit(name).alias("gate"), F.col("_why").alias("reason")))).otherwise(F.slice("refused", 1, 0))
        there = F.col("_lei").isNotNull()
        if i == len(gates) - 1:
            out.append(tried.select("symbol", F.col("_lei").alias("entity_lei"), F.when(there, name).otherwise("unattached").alias("method"), F.when(there, F.col("refused")).otherwise(F.concat("refused", more)).alias("refused")))
            break
        out.append(tried.where(there).select("symbol", F.col("_lei").alias("entity_lei"), F.lit(name).alias("method"), "refused"))
        left = tried.where(~there).withColumn("refused", F.concat("refused", more)).select(*listings.columns, "refused")
    if not out:
        return left.select("symbol", F.lit(None).cast("string").alias("entity_lei"), F.lit("unattached").alias("method"), "refused")
    return reduce(DataFrame.unionAll, out)
