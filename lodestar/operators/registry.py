"""The ticker registry: regions, upserts, candidates, clean-up plans, refresh gates and onboarding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import day, number, symbol
from ..functions.symbols import country_of, is_placeholder, let, listing_symbol, listing_symbol_in, listing_symbol_on, lookup
from .timeseries import top_k

# What counts as which refresh region; countries of each; ranks of validation states, and points of what is supported.
REGION_ALIASES = {
    "us": ("us", "usa", "united_states", "united states", "amer", "americas", "north_america", "north america", "latin_america", "latin america", "south_america", "south america", "nyse", "nasdaq", "nms", "nyq", "ase", "tor", "tsx", "xtse", "sao", "bvmf"),
    "eu": ("eu", "europe", "emea", "eur", "lis", "cph", "xetr", "etr", "lse", "ams", "epa"),
    "apac": ("apac", "asia", "asia_pacific", "asia pacific", "pacific", "il", "israel", "tlv", "tase", "xtae", "hkg", "asx"),
}
STATE_POINTS = {"validated_full": 300, "validated_market_only": 200, "pending_validation": 100, "rejected": 0}
# Suffixes of the countries that list by numbers.
NUMBERED = {"HK": "HK", "HONG KONG": "HK", "HONG KONG SAR": "HK", "JP": "T", "JAPAN": "T", "TW": "TW", "TAIWAN": "TW"}
PROMOTED, PARTIAL_ROWS = ("validated_full", "validated_market_only"), 30


def refresh_region(raw: Column) -> Column:
    """us, eu, apac, all or global of a region, exchange or continent name."""
    names = {alias: region for region, own in REGION_ALIASES.items() for alias in own}
    token = F.lower(F.trim(F.coalesce(raw, F.lit("all"))))
    return F.when(token.isin("", "all", "global"), "all").otherwise(F.coalesce(lookup(names, token), F.lit("global")))


def validated_symbols(rows: DataFrame, region: str, require_market: bool = True) -> DataFrame:
    """Active, promoted symbols of exactly one region, by their first row (seq); with market data if required."""
    own = rows.where((F.lower(F.trim("region")) == region) & (F.lower("status") == "active") & F.lower("promotion_status").isin(*PROMOTED))
    if require_market:
        own = own.where("market_supported")
    own = own.withColumn("symbol", symbol(F.col("normalized_symbol"))).where(F.col("symbol").isNotNull() & ~F.col("symbol").isin("", "NAN", "NONE", "NULL"))
    return own.groupBy("symbol").agg(F.min("seq").alias("first_seq"))


def normalised_registry(rows: DataFrame, upper: tuple[str, ...], lower: tuple[str, ...]) -> DataFrame:
    """Text columns trimmed and in their case, empty as null; the last row (seq) of each registry_key."""
    tidy = {c: F.nullif(F.trim(F.col(c)), F.lit("")) for c in (*upper, *lower)}
    out = rows.withColumns({c: F.upper(v) if c in upper else F.lower(v) for c, v in tidy.items()})
    return top_k(out, ["registry_key"], [F.desc("seq")], 1)


def best_candidates(rows: DataFrame) -> DataFrame:
    """The best candidate of each input symbol: by its state, then its points, then by name."""
    points = F.coalesce(lookup(STATE_POINTS, F.col("validation_status")), F.lit(0))
    score = points + F.when(F.col("market"), 50).otherwise(0) + F.when(F.col("fundamentals"), 10).otherwise(0) + F.when(F.col("earnings"), 10).otherwise(0)
    return top_k(rows.withColumn("score", score).withColumn("_state", F.coalesce(lookup(STATE_POINTS, F.col("validation_status")), F.lit(-1))), ["input_symbol"], [F.desc("_state"), F.desc("score"), F.asc("candidate")], 1).drop("_state")


def cleanup_plan(contexts: DataFrame, aliases: DataFrame, repairs: DataFrame) -> DataFrame:
    """One action for each symbol that needs one, by the first that applies.

    contexts: symbol, active_validated, rejected, all_rejected, has_coverage, price_rows, technical_rows, scorecard_rows; aliases:
    symbol, superseded_by; repairs: symbols that are repaired at any number of rows.
    """
    rows = contexts.join(aliases.dropDuplicates(["symbol"]), "symbol", "left").join(repairs.select("symbol", F.lit(True).alias("repair")).distinct(), "symbol", "left")
    prices, technicals, scores = (F.coalesce(F.col(f"{c}_rows"), F.lit(0)) > 0 for c in ("price", "technical", "scorecard"))
    nothing = ~prices & ~technicals & ~scores
    cleaned = F.col("all_rejected") & ~F.col("has_coverage")
    rejecting = "reject_deactivate_registry_rows_and_clear_stale_coverage"
    issue = (
        F.when(is_placeholder(F.col("symbol")), F.when(nothing, F.when(cleaned, "already_cleaned").otherwise("invalid_placeholder")))
        .when(F.col("superseded_by").isNotNull(), F.when(cleaned, "already_cleaned").otherwise("superseded_alias"))
        .when(F.col("active_validated") & nothing, "active_validated_without_materialized_data")
        .when(F.col("rejected") & prices & technicals, "rejected_shadow_row_with_tracked_canonical")
        .when(prices & technicals & ~scores, "repairable_missing_scorecard")
        .when(prices & ~technicals, F.when(F.coalesce("repair", F.lit(False)) | (F.col("price_rows") >= PARTIAL_ROWS), "repairable_missing_technicals").otherwise("partial_keep_review"))
    )
    out = rows.withColumn("issue_class", issue).where("issue_class IS NOT NULL")
    action = lookup({"invalid_placeholder": rejecting, "superseded_alias": "mark_superseded_alias_and_clear_stale_coverage", "active_validated_without_materialized_data": rejecting, "rejected_shadow_row_with_tracked_canonical": "suppress_from_readiness_error_audit", "repairable_missing_scorecard": "trigger_targeted_scorecard_build", "repairable_missing_technicals": "trigger_technical_backfill_then_scorecard_build", "partial_keep_review": "leave_partial_source_only_for_manual_review", "already_cleaned": "no_action"}, F.col("issue_class"))
    return out.select("symbol", "issue_class", action.alias("proposed_action"), "superseded_by")


def refresh_status(results: DataFrame, required: DataFrame) -> DataFrame:
    """One row: run status from (key, succeeded, exhausted). Only failures of required keys are failures; others make a run partial."""
    rows = results.join(required.select("key", F.lit(True).alias("required")).distinct(), "key", "left").withColumn("required", F.coalesce("required", F.lit(False)))
    counts = rows.agg(F.count_if("succeeded").alias("n_succeeded"), F.count_if(~F.col("succeeded")).alias("n_failed"), F.count_if(~F.col("succeeded") & F.col("required")).alias("n_required_failed"), F.count_if(~F.col("succeeded") & F.col("exhausted")).alias("n_exhausted"))
    hard = F.when(F.col("n_exhausted") > 0, "failed_retrying").otherwise("failed_hard")
    status = F.when((F.col("n_required_failed") > 0) & (F.col("n_succeeded") > 0), "partial").when(F.col("n_required_failed") > 0, hard).when(F.col("n_failed") > 0, "partial").otherwise("fresh")
    return counts.withColumn("status", status)


def calendar_status(calendar: DataFrame, series: DataFrame) -> DataFrame:
    """One row: a calendar that is empty failed; one that lacks a requested series or has a late row is partial."""
    lacking = series.select("series_key").distinct().join(calendar.select("series_key"), "series_key", "left_anti").agg(F.count("*").alias("n_missing"))
    counts = calendar.agg(F.count("*").alias("n_rows"), F.count_if(F.col("availability_status") == "late_missing_observation").alias("n_late"))
    status = F.when(F.col("n_rows") == 0, "failed_hard").when((F.col("n_missing") > 0) | (F.col("n_late") > 0), "partial").otherwise("fresh")
    return counts.join(F.broadcast(lacking), F.lit(True)).withColumn("status", status)


def series_schedule(anchors: DataFrame, groups: DataFrame) -> DataFrame:
    """Each anchor's schedule row once for every series of its group."""
    return anchors.join(groups, "anchor").drop("anchor")


def watermark_gate(tables: dict[str, tuple[DataFrame, str, bool, int]], end: str) -> DataFrame:
    """One row for each table: (rows, date column, blocking, grace days) gives its latest date, lag and whether it blocks or degrades a build."""
    at = F.lit(end).cast("date")
    own = [df.agg(F.max(F.col(date).cast("date")).alias("latest_date")).select(F.lit(name).alias("domain"), F.lit(blocking).alias("blocking"), "latest_date", F.datediff(at, "latest_date").alias("lag_days"), F.coalesce(F.datediff(at, "latest_date") <= grace, F.lit(False)).alias("ok")) for name, (df, date, blocking, grace) in tables.items()]
    state = F.when(F.col("ok"), "ready").when(F.col("blocking"), "blocked").otherwise("degraded")
    return reduce(DataFrame.unionAll, own).withColumn("state", state)


def rebuilt_coverage(symbols: DataFrame, domains: dict[str, tuple[DataFrame, str, str]], as_of: str) -> DataFrame:
    """Rows and latest date of each domain (rows, key, date) for touched symbols; fresh if any domain has rows, and the next earnings date."""
    out = symbols.select("ticker").distinct()
    for name, (df, key, date) in domains.items():
        aggs = [F.count("*").alias(f"{name}_rows"), F.max(date).alias(f"{name}_latest")]
        if name == "earnings":
            aggs.append(F.min(F.when(F.col(date) >= F.lit(as_of).cast("date"), F.col(date))).alias("next_earnings_date"))
        out = out.join(df.groupBy(F.col(key).alias("ticker")).agg(*aggs), "ticker", "left").na.fill(0, [f"{name}_rows"])
    return out.withColumn("coverage_status", F.when(reduce(lambda x, y: x | y, (F.col(f"{n}_rows") > 0 for n in domains)), "fresh").otherwise("unknown"))


def backfilled(existing: DataFrame, resolved: DataFrame, key: str, columns: tuple[str, ...]) -> DataFrame:
    """Null columns filled from resolved rows, present ones kept; malformed symbols are reported and never filled."""
    rows = existing.join(resolved.select(key, *(F.col(c).alias(f"_{c}") for c in columns)).dropDuplicates([key]), key, "left")
    whole = F.col(key).rlike("^[A-Z0-9][A-Z0-9.-]*$")
    filled = F.when(~whole, "malformed_symbol").when(reduce(lambda x, y: x | y, (F.col(c).isNull() & F.col(f"_{c}").isNotNull() for c in columns)), "filled").otherwise("unchanged")
    return rows.select(key, *(F.when(whole, F.coalesce(c, f"_{c}")).otherwise(F.col(c)).alias(c) for c in columns), filled.alias("outcome"))


def onboarding_identities(holdings: DataFrame, entities: DataFrame, registered: DataFrame) -> DataFrame:
    """A provider symbol for each holding (etf_ticker, source_symbol, source_country, source_exchange), from the first source that has one.

    Known entities come first, then the registry, the exchange's suffix, a suffix that is there, the country's numbers, and US
    symbols; what is left says why not. A bare number of a country that lists by numbers is its country's, well known or not. entities and registered have (symbol); a row that has the symbol in another country
    doesn't count.
    """
    src, place = F.coalesce(symbol(F.col("source_symbol")), F.lit("")), F.upper(F.trim("source_country"))
    rows = holdings.withColumns({"source_symbol": src, "source_country": place, "_plain": listing_symbol(src)})
    rows = rows.withColumns({"_exchange": let(listing_symbol_on(src, F.col("source_exchange")), lambda s: F.when(s != F.col("_plain"), s)), "_number": let(listing_symbol_in(src, place), lambda s: F.when((s != F.col("_plain")) | (src.rlike("^[0-9]+$") & s.endswith(F.concat(F.lit("."), lookup(NUMBERED, place)))), s))})
    rows = rows.withColumn("_wanted", F.coalesce("_exchange", F.when(F.col("_plain").contains("."), F.col("_plain")), "_number", "_plain"))
    for name, known in (("_entity", entities), ("_registry", registered)):
        own = known.select(F.col("symbol").alias("_wanted"), F.lit(True).alias(name)).distinct()
        rows = rows.join(own, "_wanted", "left")
    fits = F.coalesce(place.isNull() | country_of(F.col("_wanted")).isNull() | (place == country_of(F.col("_wanted"))), F.lit(True))
    step = lambda when, source, confidence: F.when(when, F.struct(F.col("_wanted").alias("s"), F.lit(source).alias("source"), F.lit(confidence).alias("c")))
    bare_us = (place == "US") & F.col("_plain").rlike("^[A-Z][A-Z-]{0,5}$")
    found = F.coalesce(step(F.col("_entity") & fits, "entity_attributes_static", 0.95), step(F.col("_registry") & fits, "ticker_registry", 0.92), step(F.col("_exchange").isNotNull(), "source_exchange", 0.86), step(F.col("_plain").contains(".") & F.col("_number").isNull(), "provider_symbol_already_qualified", 0.90), step(F.col("_number").isNotNull(), "source_country_numeric_mapping", 0.84), step(bare_us, "us_bare_symbol", 0.75))
    abroad = F.coalesce(place != "US", F.lit(False))
    lost = F.when(F.col("source_symbol") == "", "missing_source_symbol").when(abroad, "missing_provider_symbol").otherwise("ambiguous_listing")
    out = rows.withColumn("_f", F.when(F.col("source_symbol") != "", found))
    return out.select("etf_ticker", "source_symbol", "source_country", F.col("_f.s").alias("provider_symbol"), F.col("_f.s").isNotNull().alias("is_onboardable"), F.coalesce("_f.source", F.when(lost == "missing_provider_symbol", "source_country").otherwise("source_identity")).alias("resolution_source"), F.coalesce("_f.c", F.when(lost == "missing_provider_symbol", 0.35).when(lost == "ambiguous_listing", 0.25).otherwise(0.0)).alias("resolution_confidence"), F.when(F.col("_f").isNull(), lost).alias("not_onboardable_reason"))


def request_keys(rows: DataFrame) -> DataFrame:
    """Mapping requests of listings (symbol, mic, exchange_code, currency): canonical JSON and its sha256; the exchange code only where there is no MIC."""
    text = lambda c: F.nullif(F.upper(F.trim(c)), F.lit(""))
    bare = F.regexp_replace(F.upper(F.trim("symbol")), r"\.[A-Z]+$", "")
    payload = F.to_json(F.struct(text("currency").alias("currency"), F.when(text("mic").isNull(), text("exchange_code")).alias("exchCode"), F.lit("TICKER").alias("idType"), bare.alias("idValue"), text("mic").alias("micCode")))
    return rows.select("symbol", payload.alias("payload")).withColumn("request_hash", F.sha2("payload", 256))


def completeness_text(windows: DataFrame) -> DataFrame:
    """Sentences on each symbol's window (symbol, first_date, last_date, expected, actual, missing, completeness)."""
    missing, pct = F.col("missing"), F.col("completeness")
    tier = F.when(missing == 0, "Assessment: acceptable (no missing business days in range).").when(pct.isNull(), "Assessment: needs review (completeness percentage unavailable).").when((pct >= 99) & (missing <= 3), "Assessment: generally acceptable with minor gaps.").when(pct >= 95, "Assessment: usable but gaps should be reviewed before strict analyses.").otherwise("Assessment: not acceptable for strict analyses until gaps are resolved.")
    span = F.concat(F.lit("from "), F.col("first_date").cast("string"), F.lit(" to "), F.col("last_date").cast("string"))
    scored = F.concat(F.lit("Market price history is "), F.col("completeness").cast("decimal(20,2)").cast("string"), F.lit("% complete "), span, F.lit(", with "), missing.cast("string"), F.lit(" missing business days."))
    body = F.when(F.col("expected") > 0, scored).otherwise(F.concat(F.lit("Market price history window is "), span, F.lit(".")))
    none = (F.col("actual") <= 0) | F.col("first_date").isNull()
    return windows.select("symbol", F.when(none, "Market price history is not available in canonical tables for the requested scope.").otherwise(F.concat_ws(" ", body, tier)).alias("summary"))


def point_metrics(rows: DataFrame) -> DataFrame:
    """Point-in-time metrics in long form. Only a fund's size falls back to its assets; dividend figures of the history beat the vendor's."""
    size = F.coalesce(F.nullif("market_cap", F.lit(0.0)), F.when(F.col("is_fund"), F.col("total_assets")))
    rate, price, eps = F.col("history_rate"), F.col("price"), F.col("eps")
    paid = F.when(rate > 0, rate)
    values = {"market_cap": size, "eps": eps, "dividend_rate": F.coalesce(paid, "vendor_rate"), "dividend_yield": F.coalesce(F.when(price > 0, F.try_divide(paid, price)), "vendor_yield"), "payout_ratio": F.when(eps > 0, F.try_divide(paid, eps))}
    cells = F.array(*(F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value")) for k, v in values.items()))
    return rows.select("ticker", F.explode(cells).alias("m")).select("ticker", "m.metric", "m.value").where("value IS NOT NULL")


def theme_dimension(themes: DataFrame, holdings: DataFrame) -> DataFrame:
    """Each theme with its distinct holdings and their latest date; an active theme without holdings violates the contract."""
    counts = holdings.groupBy("etf_ticker").agg(F.countDistinct("holding_symbol").alias("holdings_count"), F.max("as_of").alias("holdings_as_of"))
    return themes.join(counts, "etf_ticker", "left").na.fill(0, ["holdings_count"]).withColumn("contract_violated", F.col("active") & (F.col("holdings_count") == 0))


def replaced_holdings(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """All holdings of refreshed funds replaced, those of others kept; of rows with one listing key (etf_ticker, listing_key) the heaviest stays."""
    best = top_k(fresh, ["etf_ticker", "listing_key"], [F.desc("weight"), F.asc("holding_symbol")], 1)
    return existing.join(fresh.select("etf_ticker").distinct(), "etf_ticker", "left_anti").unionByName(best.select(existing.columns))


def renormalised_holdings(holdings: DataFrame) -> DataFrame:
    """Each fund's holdings (holding_symbol, holding_country) before and after symbols are normalised: changed, bare numbers and missing ones."""
    after = listing_symbol_in(F.col("holding_symbol"), F.col("holding_country"))
    rows = holdings.withColumn("_after", after)
    bare = lambda c: F.count_if(F.coalesce(F.col(c).rlike("^[0-9]+$"), F.lit(False)))
    return rows.groupBy("etf_ticker").agg(F.count("*").alias("n"), F.count_if(~F.col("_after").eqNullSafe(F.col("holding_symbol"))).alias("changed"), bare("holding_symbol").alias("numeric_before"), bare("_after").alias("numeric_after"), F.count_if(F.col("_after") == "").alias("missing"))


def canonical_prices(raw: DataFrame, aliases: dict[str, tuple[str, ...]]) -> DataFrame:
    """Provider rows as (symbol, date, close, adj_close, volume): the first alias that is there; adj_close falls back to close; rows without date or close go."""
    pick = lambda c: F.coalesce(*(F.col(f"`{n}`") for n in aliases[c] if n in raw.columns), F.lit(None))
    rows = raw.select(symbol(pick("symbol")).alias("symbol"), day(pick("date").cast("string")).alias("date"), *(number(pick(c).cast("string")).alias(c) for c in ("close", "adj_close", "volume")))
    return rows.withColumn("adj_close", F.coalesce("adj_close", "close")).dropna(subset=["date", "close"])


def snapshot_report(registered: DataFrame, coverage: DataFrame, prices: DataFrame, stale_before: str) -> DataFrame:
    """(ticker, section, key, value) of each registered ticker and its warnings: no coverage, no prices, or prices that ended before a day. Of repeated rows of a ticker the smallest value counts."""
    last = prices.groupBy(F.col("symbol").alias("ticker")).agg(F.count("*").alias("price_rows"), F.max("date").alias("last_date"))
    one = lambda df, *columns: df.groupBy("ticker").agg(*(F.min(c).alias(c) for c in columns))
    rows = one(registered, "status", "promotion_status").join(one(coverage, "coverage_status"), "ticker", "left").join(last, "ticker", "left")
    warnings = F.array_compact(F.array(F.when(F.col("coverage_status").isNull(), "coverage_row_missing"), F.when(F.col("price_rows").isNull(), "market_prices_missing"), F.when(F.col("last_date") < F.lit(stale_before).cast("date"), "market_prices_stale")))
    cell = lambda section, key, value: F.struct(F.lit(section).alias("section"), F.lit(key).alias("key"), value.cast("string").alias("value"))
    cells = F.array(cell("registry", "status", F.col("status")), cell("registry", "promotion_status", F.col("promotion_status")), cell("coverage", "coverage_status", F.col("coverage_status")), cell("availability", "price_rows", F.coalesce("price_rows", F.lit(0))), cell("window", "last_date", F.col("last_date")))
    return rows.select("ticker", F.explode(cells).alias("c"), F.array_join(warnings, ",").alias("warnings")).select("ticker", "c.*", "warnings")
