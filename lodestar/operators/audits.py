"""Freshness by exchange calendar, overlaps, rebuild summaries, instrument policy and frontier audits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import symbol

from ..functions.dates import business_days
from .timeseries import as_of, top_k

# The domains that each instrument type must and should support.
POLICY = {
    "equity": (("market",), ("fundamentals", "earnings")), "adr": (("market",), ("fundamentals", "earnings")), "etf": (("market",), ()), "country_fund": (("market",), ()), "index_proxy": (("market",), ()), "unknown": (("market",), ()),
}
ALLOWED_MISSING_SESSIONS, SESSION_DAYS = 1, 14


def session_freshness(prices: DataFrame, listings: DataFrame, sessions: DataFrame, today: str) -> DataFrame:
    """State of each symbol by sessions of its exchange after its last price, in the days before today: none fresh, few tolerated, else failed.

    listings has (symbol, mic), sessions (mic, session_date).
    """
    at = F.lit(today).cast("date")
    recent = sessions.where((F.col("session_date") < at) & (F.col("session_date") >= F.date_sub(at, SESSION_DAYS)))
    last = prices.groupBy("symbol").agg(F.max("date").alias("last_date"))
    rows = listings.join(last, "symbol", "left").join(recent.groupBy("mic").agg(F.array_sort(F.collect_set("session_date")).alias("sessions"), F.max("session_date").alias("expected_date")), "mic", "left")
    missing = F.size(F.filter(F.coalesce("sessions", F.expr("cast(array() as array<date>)")), lambda d: d > F.col("last_date"))).cast("long")
    rows = rows.withColumn("missing_sessions", F.when(F.col("last_date").isNotNull(), missing))
    state = F.when(F.col("last_date").isNull() | F.col("expected_date").isNull(), "unknown").when(F.col("missing_sessions") == 0, "fresh").when(F.col("missing_sessions") <= ALLOWED_MISSING_SESSIONS, "stale_within_tolerance").otherwise("failed_hard")
    return rows.select("symbol", "mic", "last_date", "expected_date", "missing_sessions", state.alias("freshness_state"))


def ex_date_overlap(actions: DataFrame) -> DataFrame:
    """For each symbol and action: ex-dates of each provider, of all, and those that every provider has."""
    providers = actions.select("symbol", "action", "provider").distinct().groupBy("symbol", "action").agg(F.count("*").alias("providers"))
    dates = actions.groupBy("symbol", "action", "ex_date").agg(F.countDistinct("provider").alias("n"))
    return dates.join(providers, ["symbol", "action"]).groupBy("symbol", "action", "providers").agg(F.count("*").alias("dates"), F.count_if(F.col("n") == F.col("providers")).alias("shared_dates"))


def rebuild_summary(rebuilt: DataFrame, existing: DataFrame) -> DataFrame:
    """One row: rebuilt rows, rows with each domain, and existing tickers that the rebuild no longer has."""
    counts = rebuilt.agg(F.count("*").alias("n"), *(F.count_if(c).alias(f"n_{c}") for c in ("market_data_available", "fundamentals_available", "earnings_available")))
    gone = existing.select("ticker").distinct().join(rebuilt.select("ticker"), "ticker", "left_anti").agg(F.count("*").alias("removed"), F.min("ticker").alias("first_removed"))
    return counts.join(F.broadcast(gone), F.lit(True))


def promotion_status(instruments: DataFrame) -> DataFrame:
    """Status by policy from (ticker, instrument_type, market, fundamentals, earnings): rejected without a required domain, full with all,
    market only with the reason: what is preferred and absent, or none. Types without a policy, null too, go by that of unknown ones."""
    given = F.coalesce(F.when(F.col("instrument_type").isin(*POLICY), F.col("instrument_type")), F.lit("unknown"))
    domain = lambda d: F.coalesce(F.col(d), F.lit(False))
    of = lambda d, level: given.isin(*[t for t, p in POLICY.items() if d in p[level]])
    lost = [F.when(of(d, 0) & ~domain(d), F.lit(f"missing_{d}")) for d in ("market", "fundamentals", "earnings")]
    lacks = [F.when(of(d, 1) & ~domain(d), F.lit(f"missing_{d}")) for d in ("fundamentals", "earnings")]
    texts = lambda parts: F.array_join(F.array_compact(F.array(*parts)), ",")
    rows = instruments.select("ticker", given.alias("_type"), texts(lost).alias("_lost"), texts(lacks).alias("_lacks"), (domain("market") & domain("fundamentals") & domain("earnings")).alias("_full"))
    status = F.when(F.col("_lost") != "", "rejected").when(F.col("_full"), "validated_full").otherwise("validated_market_only")
    plain = F.when(F.col("_type") == "index_proxy", "market_supported_index_proxy").otherwise("market_supported")
    reasons = F.when(F.col("_lost") != "", F.col("_lost")).when(F.col("_full"), "all_domains_supported").when(F.col("_lacks") != "", F.col("_lacks")).otherwise(plain)
    return rows.select("ticker", status.alias("promotion_status"), reasons.alias("reasons"))


def staleness_replay(points: DataFrame, days: DataFrame, limit: int) -> DataFrame:
    """(series_key, as_of_date, replayed_stale): whether the latest point on or before a day is missing or older than limit business days."""
    rows = as_of(days.select("series_key", "as_of_date"), points, ["series_key"], "as_of_date", "observation_date", ["value"])
    stale = F.col("observation_date").isNull() | (business_days(F.col("observation_date"), F.col("as_of_date")) > limit)
    return rows.select("series_key", "as_of_date", stale.alias("replayed_stale"))


def frontier(candidates: DataFrame, tracked: DataFrame) -> DataFrame:
    """Whether a candidate is already tracked, by symbol, then entity, then LEI, and what to do with it; the first tracked symbol by name is named."""
    out = candidates
    for i, key in enumerate(("symbol", "entity_id", "lei")):
        known = tracked.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"_k{i}")).agg(F.min("symbol").alias(f"_m{i}"))
        out = out.join(known, F.col(key) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
    status = F.when(F.col("_m0").isNotNull(), "already_tracked_symbol").when(F.coalesce("_m1", "_m2").isNotNull(), "already_tracked_entity").when(F.coalesce("entity_id", "lei").isNull(), "unresolved").otherwise("new_entity")
    action = F.when(status.startswith("already"), "suppress").when(status == "unresolved", "review").otherwise("admit")
    return out.select("symbol", F.coalesce("_m0", "_m1", "_m2").alias("matched_symbol"), status.alias("status"), action.alias("action"))


def recent(df: DataFrame, key: str, order: str, k: int) -> DataFrame:
    return top_k(df, [key], [F.desc(order)], k)


def row_breakdown(tickers: DataFrame, provider: dict[str, DataFrame], filtered: dict[str, DataFrame], skipped: DataFrame) -> DataFrame:
    """For each requested ticker the provider's rows and the rows left after filters, by table, and why nothing was written.

    The reason is that of skipped (ticker, reason) if there is one, else that the provider gave nothing, or that no row was in the
    window; null where rows were written.
    """
    out = tickers.select(symbol(F.col("ticker")).alias("ticker")).where("ticker IS NOT NULL").distinct()
    sides = {"provider": provider, "filtered": filtered}
    for side, tables in sides.items():
        for name, df in tables.items():
            out = out.join(df.groupBy(symbol(F.col("ticker")).alias("ticker")).agg(F.count("*").alias(f"{side}_{name}")), "ticker", "left")
    names = [f"{side}_{name}" for side, tables in sides.items() for name in tables]
    out = out.withColumns({n: F.coalesce(n, F.lit(0)) for n in names})
    total = lambda side: sum((F.col(f"{side}_{name}") for name in sides[side]), F.lit(0))
    why = skipped.groupBy(symbol(F.col("ticker")).alias("ticker")).agg(F.max(F.nullif(F.trim("reason"), F.lit(""))).alias("given"))
    reason = F.coalesce("given", F.when(total("provider") == 0, "provider_returned_empty").when(total("filtered") == 0, "window_filter_no_matches"))
    return out.join(why, "ticker", "left").select("ticker", *names, total("filtered").alias("rows_written"), reason.alias("zero_reason"))
