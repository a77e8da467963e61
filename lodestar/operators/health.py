"""Freshness, window plans, coverage and readiness."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import symbol
from ..functions.dates import is_weekend
from ..functions.symbols import is_placeholder

# States from worst to best.
SEVERITY = ("failed_hard", "failed_retrying", "partial", "stale_within_tolerance", "delayed_expected", "unknown", "fresh")


def freshness(last: Column, now: Column, fresh_hours: float = 26, grace_hours: float = 24, failure: Column | None = None, partial: Column | None = None, delayed: Column | None = None) -> Column:
    """State of an asset by its last observation: failures first, then age against the fresh span and its grace."""
    no = F.lit(False)
    age = (F.unix_timestamp(now) - F.unix_timestamp(last)) / 3600.0
    return F.when(F.coalesce(failure, no) if failure is not None else no, "failed_retrying").when(partial if partial is not None else no, "partial").when(last.isNull(), "unknown").when(age <= fresh_hours, "fresh").when(age <= fresh_hours + grace_hours, "stale_within_tolerance").when(delayed if delayed is not None else no, "delayed_expected").otherwise("failed_hard")


def worst(status: Column) -> Column:
    """Aggregate: the worst state."""
    rank = F.array_position(F.array(*map(F.lit, SEVERITY)), status)
    return F.min_by(status, F.when(rank > 0, rank))


def run_status(succeeded: Column, failed: Column) -> Column:
    return F.when((succeeded > 0) & (failed > 0), "partial").when(failed > 0, "failed_retrying").when(succeeded > 0, "fresh").otherwise("failed_hard")


def asset_status(assets: dict[str, tuple[DataFrame, str, float, float]], now: str) -> DataFrame:
    """One row for each asset (table, date column, fresh and grace hours): rows, last date, state. overall_state() sums them up."""
    at = F.lit(now).cast("timestamp")
    parts = [df.agg(F.count("*").alias("n_rows"), F.max(c).cast("timestamp").alias("last")).select(F.lit(name).alias("asset"), "n_rows", F.col("last").cast("date").alias("last_available_date"), freshness(F.col("last"), at, fresh, grace).alias("freshness_state")) for name, (df, c, fresh, grace) in assets.items()]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionAll(p)
    return rows


def overall_state(assets: DataFrame) -> DataFrame:
    """asset_status' rows with the worst of their states on each: one small row for each asset is joined with one."""
    return assets.crossJoin(F.broadcast(assets.agg(worst(F.col("freshness_state")).alias("overall_state"))))


def gap_plan(dates: DataFrame, symbols: DataFrame, end: str, lookback: int, overlap: int = 0, business: bool = True) -> DataFrame:
    """One row: the window to refresh for (symbol, date) against all (business) days of the look-back window.

    The latest complete date is the smallest of the symbols' latest dates, null if a symbol has none. Days are expected for each
    symbol: the look-back bounds them, whatever the number of symbols.
    """
    stop, base = F.lit(end).cast("date"), F.date_sub(F.lit(end).cast("date"), max(1, lookback))
    have = dates.where(F.col("date").between(base, stop)).select("symbol", "date").distinct().withColumn("here", F.lit(True))
    days = symbols.select("symbol").distinct().withColumn("date", F.explode(F.sequence(base, stop)))
    if business:
        days = days.where(~is_weekend(F.col("date")))
    latest = symbols.select("symbol").distinct().join(have.groupBy("symbol").agg(F.max("date").alias("latest")), "symbol", "left").agg(F.count("*").alias("symbols"), F.count("latest").alias("with_dates"), F.min("latest").alias("least"))
    missing = days.join(have, ["symbol", "date"], "left").where(F.col("here").isNull()).agg(F.min("date").alias("earliest_missing_date"), F.countDistinct("date").alias("missing_dates"), F.countDistinct("symbol").alias("stale_symbols"), F.count("*").alias("missing_symbol_dates"))
    complete = F.when(F.col("with_dates") == F.col("symbols"), F.col("least"))
    first = F.col("earliest_missing_date")
    mode = F.when(first.isNull(), "normal").when(F.coalesce(first <= complete, F.lit(False)), "gap-repair").otherwise("catch-up")
    start = F.greatest(base, F.date_sub(F.coalesce(first, stop), overlap))
    return latest.join(F.broadcast(missing), F.lit(True)).select(mode.alias("mode"), start.alias("start_date"), stop.alias("end_date"), complete.alias("latest_complete_date"), first.alias("earliest_missing_date"), "missing_dates", "stale_symbols", "missing_symbol_dates")


def watermark_plan(tables: dict[str, tuple[DataFrame, str]], end: str, lookback: int, grace: int, overlap: int = 0) -> DataFrame:
    """For each table its latest date in the window, whether that is older than the grace, and the window to refresh."""
    stop, base = F.lit(end).cast("date"), F.date_sub(F.lit(end).cast("date"), max(1, lookback))
    rows = None
    for name, (df, c) in tables.items():
        one = df.where(F.col(c).cast("date").between(base, stop)).agg(F.max(F.col(c).cast("date")).alias("latest")).withColumn("table_name", F.lit(name))
        rows = one if rows is None else rows.unionAll(one)
    latest = F.col("latest")
    gap = F.coalesce(latest < F.date_sub(stop, grace), F.lit(True))
    missing = F.when(gap, F.coalesce(F.date_add(latest, 1), base))
    count = F.when(gap, F.greatest(F.lit(1), F.datediff(stop, missing) + 1)).otherwise(0)
    return rows.select("table_name", latest.alias("latest_date"), gap.alias("gap_exists"), F.when(gap, "catch-up").otherwise("normal").alias("mode"), F.greatest(base, F.date_sub(F.coalesce(missing, stop), overlap)).alias("start_date"), count.cast("long").alias("missing_dates"))


def symbol_coverage(required: DataFrame, prices: DataFrame, fundamentals: DataFrame, earnings: DataFrame, as_of: str) -> DataFrame:
    """For each required symbol which domains have rows, their last dates, the next earnings date, and a status with its reason."""
    at = F.lit(as_of).cast("date")
    out = required.select("symbol").distinct()
    for df, key, aggs in (
        (prices, "symbol", [F.max("date").alias("market_data_last_date"), F.lit(True).alias("market_data_available")]),
        (fundamentals, "ticker", [F.max("period_end").alias("fundamentals_last_date"), F.lit(True).alias("fundamentals_available")]),
        (earnings, "ticker", [F.min(F.when(F.col("earnings_date") >= at, F.col("earnings_date"))).alias("next_earnings_date"), F.lit(True).alias("earnings_available")]),
    ):
        out = out.join(df.withColumnRenamed(key, "symbol").groupBy("symbol").agg(*aggs), "symbol", "left")
    flags = ("market_data_available", "fundamentals_available", "earnings_available")
    out = out.withColumns({f: F.coalesce(f, F.lit(False)) for f in flags})
    absent = F.array_compact(F.array(*(F.when(~F.col(f), F.lit(n)) for f, n in zip(flags, ("market_data", "fundamentals", "earnings"), strict=True))))
    status = F.when(F.size(absent) == 0, "fresh").when(F.size(absent) == 3, "failed_hard").otherwise("partial")
    reason = F.when(F.size(absent) == 0, "all_domains_available").otherwise(F.concat(F.lit("missing_"), F.array_join(absent, "_")))
    return out.select(F.col("symbol").alias("ticker"), *flags, "market_data_last_date", "fundamentals_last_date", "next_earnings_date", status.alias("coverage_status"), reason.alias("reason"))


# Fixed value: symbols that another has taken the place of.
SUPERSEDED = {"700.HK": "0700.HK"}


def complete_coverage(prices: DataFrame, quotes: DataFrame, fundamentals: DataFrame, earnings: DataFrame, as_of: str) -> DataFrame:
    """Coverage of every symbol that any source has, rebuilt from the rows themselves.

    Only price rows make market data available; quotes keep a symbol in sight. Without prices, placeholders and superseded symbols
    are left out.
    """
    everything = reduce(DataFrame.unionAll, [df.select(symbol(F.col(key)).alias("symbol")) for df, key in ((prices, "symbol"), (quotes, "symbol"), (fundamentals, "ticker"), (earnings, "ticker"))])
    named = lambda df, key: df.withColumn(key, symbol(F.col(key)))
    required = everything.where("symbol IS NOT NULL")
    found = symbol_coverage(required, named(prices, "symbol"), named(fundamentals, "ticker"), named(earnings, "ticker"), as_of)
    left_out = is_placeholder(F.col("ticker")) | F.col("ticker").isin(*SUPERSEDED)
    reason = F.when(F.col("reason") == "all_domains_available", "market_fundamentals_earnings_available").otherwise(F.col("reason"))
    return found.where(F.col("market_data_available") | ~left_out).withColumn("reason", reason)


def merge_coverage(own: DataFrame, existing: DataFrame, columns: Sequence[str]) -> DataFrame:
    """existing with one domain's columns from own where own has the ticker; other columns stay, new tickers come in."""
    o = own.select("ticker", *(F.col(c).alias(f"_{c}") for c in columns), F.lit(True).alias("_own"))
    rows = existing.join(o, "ticker", "full_outer")
    return rows.select("ticker", *(F.when(F.col("_own"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in existing.columns if c != "ticker"))


def coverage_assessment(required: DataFrame, present: DataFrame) -> DataFrame:
    """How many required symbols are present, the ratio, and how many are missing."""
    here = required.select("symbol").distinct().join(present.select("symbol", F.lit(1).alias("here")).distinct(), "symbol", "left")
    counts = here.agg(F.count("*").alias("required"), F.count("here").alias("covered"))
    share = F.try_divide(F.col("covered").cast("double"), F.col("required"))
    return counts.select("required", "covered", (F.col("required") - F.col("covered")).alias("missing"), F.coalesce(share, F.lit(0.0)).alias("coverage_ratio"), F.when(share == 1, "fresh").when(share > 0, "partial").otherwise("failed_hard").alias("status"))


def ticker_readiness(registry: DataFrame, prices: DataFrame, technicals: DataFrame, scorecards: DataFrame) -> DataFrame:
    """Rows of each source by ticker, and the state of a ticker: placeholder, not materialised, source only, tracked without or with a scorecard."""
    out = registry.groupBy("ticker").agg(F.min("status").alias("registry_status"), F.bool_or((F.col("status") == "active") & F.col("promotion_status").startswith("validated")).alias("registry_active_validated"))
    names = {"source_price_rows": prices, "technical_feature_rows": technicals, "scorecard_rows": scorecards}
    for name, df in names.items():
        out = out.join(df.groupBy(F.col("symbol").alias("ticker")).agg(F.count("*").alias(name)), "ticker", "full_outer")
    out = out.withColumns({n: F.coalesce(n, F.lit(0)) for n in names} | {"registry_active_validated": F.coalesce("registry_active_validated", F.lit(False)), "is_placeholder_symbol": is_placeholder(F.col("ticker"), 6)})
    has = [F.col(n) > 0 for n in names]
    state = F.when(F.col("is_placeholder_symbol"), "invalid_placeholder").when(~has[0], "not_materialized").when(~has[1], "source_only").when(~has[2], "tracked_without_scorecard").otherwise("tracked_with_scorecard")
    return out.withColumns({"readiness_state": state, "tracked": has[0] & has[1] & ~F.col("is_placeholder_symbol")})


def with_coverage(rows: DataFrame, coverage: DataFrame, registry: DataFrame, readiness: DataFrame) -> DataFrame:
    """Readiness rows with what coverage says of market data (null: nothing), its status, and whether a rejected listing only shadows a tracked one.

    A ticker is such a shadow if the registry has a rejected and another row of it and readiness tracks it with a scorecard.
    """
    said = coverage.groupBy("ticker").agg(F.bool_or("market_data_available").alias("coverage_market_data"), F.max("coverage_status").alias("coverage_status"))
    gone = F.coalesce(F.lower(F.trim("status")) == "rejected", F.lit(False))
    both = registry.groupBy("ticker").agg((F.bool_or(gone) & F.bool_or(~gone)).alias("both"))
    ready = readiness.where("tracked AND scorecard_ready").select("ticker", F.lit(True).alias("ready")).distinct()
    out = rows.join(said, "ticker", "left").join(both, "ticker", "left").join(ready, "ticker", "left")
    return out.withColumn("shadow", F.coalesce(F.col("both") & F.col("ready"), F.lit(False))).drop("both", "ready")


def readiness_issues(rows: DataFrame) -> DataFrame:
    """(ticker, issue_type): every issue of every ticker. With with_coverage's columns also those of coverage, and its two exceptions:
    a rejected shadow of a tracked listing may have data, a rejected placeholder is cleaned up only if coverage knows nothing of it."""
    known = {c: F.col(c) if c in rows.columns else F.lit(v) for c, v in (("coverage_market_data", None), ("coverage_status", None), ("shadow", False))}
    market = known["coverage_market_data"].cast("boolean")
    unseen = market.isNull() & (F.coalesce(known["coverage_status"].cast("string"), F.lit("")) == "")
    p, t, s = (F.col(c) > 0 for c in ("source_price_rows", "technical_feature_rows", "scorecard_rows"))
    rejected = F.coalesce(F.col("registry_status") == "rejected", F.lit(False))
    issues = {
        "registry_active_validated_without_prices": F.col("registry_active_validated") & ~p,
        "prices_without_technicals": p & ~t,
        "technicals_without_scorecard": t & ~s,
        "rejected_with_materialized_data": rejected & (p | t | s) & ~known["shadow"],
        "placeholder_like_symbol": F.col("is_placeholder_symbol") & ~(rejected & ~p & ~t & ~s & unseen),
        "coverage_disagrees_with_materialized_rows": F.coalesce(market != p, F.lit(False)),
    }
    found = F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in issues.items())))
    return rows.select("ticker", F.explode(found).alias("issue_type"))
