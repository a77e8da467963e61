"""Fundamentals and earnings products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.casts import day, number, ratio, symbol
from .timeseries import first_value, last_value

LOOKBACK_DAYS = 330


def fundamentals_summary(facts: DataFrame) -> DataFrame:
    """Latest metrics, price-earnings ratio and growth of each ticker, from (ticker, metric, value, period_end, source, seq).

    Growth compares the last value with the last one at least LOOKBACK_DAYS older, or else with the one before. seq breaks ties
    of period_end.
    """
    rows = facts.select(symbol(F.col("ticker")).alias("ticker"), F.lower("metric").alias("metric"), number(F.col("value")).alias("value"), day(F.col("period_end")).alias("period_end"), "source", "seq").dropna(subset=["ticker", "metric", "value", "period_end"])
    by = Window.partitionBy("ticker", "metric")
    rows = rows.withColumns({"last_end": F.max("period_end").over(by), "rn": F.row_number().over(by.orderBy(F.desc("period_end"), F.desc("seq")))})
    at = F.struct("period_end", "seq")
    old = F.col("period_end") <= F.date_sub("last_end", LOOKBACK_DAYS)
    latest = F.max_by("value", at)
    prior = F.coalesce(F.max_by("value", F.when(old, at)), F.max(F.when(F.col("rn") == 2, F.col("value"))))
    growth = F.try_divide(latest - prior, F.nullif(F.abs(prior), F.lit(0.0)))
    each = rows.groupBy("ticker", "metric").agg(latest.alias("latest"), growth.alias("growth"), F.max(at).alias("at"), F.max_by("source", at).alias("source"))
    of = lambda m, c="latest": F.max(F.when(F.col("metric") == m, F.col(c)))
    names = ("revenue", "eps", "market_cap", "trailing_pe", "net_income", "shares_outstanding")
    wide = each.groupBy("ticker").agg(*(of(m).alias(m) for m in names), of("revenue", "growth").alias("revenue_growth_yoy"), F.coalesce(of("net_income", "growth"), of("eps", "growth")).alias("earnings_growth_yoy"), F.max("at.period_end").alias("latest_period_end"), F.max_by("source", "at").alias("source"))
    plus = lambda c: F.when(F.col(c) > 0, F.col(c))
    pe = F.when(plus("net_income").isNotNull(), ratio(F.col("market_cap"), plus("net_income"))).otherwise(ratio(ratio(F.col("market_cap"), plus("shares_outstanding")), plus("eps")))
    return wide.select("ticker", F.col("revenue").alias("latest_revenue"), F.col("eps").alias("latest_eps"), F.coalesce("trailing_pe", pe).alias("trailing_pe"), "market_cap", "revenue_growth_yoy", "earnings_growth_yoy", "latest_period_end", F.coalesce(F.nullif(F.trim("source"), F.lit("")), F.lit("unknown")).alias("source"))


def next_earnings(events: DataFrame, as_of: str, columns: tuple[str, ...]) -> DataFrame:
    """The first date on or after as_of of each ticker; each column its first value that isn't null, by date and fetch order."""
    rows = events.where(F.col("earnings_date") >= F.lit(as_of).cast("date"))
    return rows.groupBy("ticker").agg(F.min("earnings_date").alias("earnings_date"), *(first_value(c, "earnings_date", "seq").alias(c) for c in columns))


def merged_earnings(events: DataFrame, history: DataFrame) -> DataFrame:
    """Both tables merged by ticker and date, the last value of each column that isn't null; surprise is actual less estimate, else the vendor's."""
    rows = events.withColumn("_order", F.lit(0)).unionByName(history.withColumn("_order", F.lit(1)), allowMissingColumns=True)
    out = rows.groupBy("ticker", "earnings_date").agg(*(last_value(c, "_order", "seq").alias(c) for c in ("actual_eps", "estimate_eps", "surprise_eps")))
    return out.withColumn("surprise_eps", F.coalesce(F.col("actual_eps") - F.col("estimate_eps"), "surprise_eps"))


def upcoming_and_history(dates: DataFrame) -> DataFrame:
    """All reported dates of a ticker (history) and its earliest unreported one (upcoming)."""
    reported = F.col("actual_eps").isNotNull()
    rank = F.row_number().over(Window.partitionBy("ticker", reported).orderBy("earnings_date", "seq"))
    return dates.withColumns({"kind": F.when(reported, "history").otherwise("upcoming"), "_rank": rank}).where(reported | (F.col("_rank") == 1)).drop("_rank")


def surprise_stats(earnings: DataFrame, k: int = 4) -> DataFrame:
    """Beats, misses, mean and last surprise of the latest k reports, and the later half's sum less the earlier half's."""
    pct = F.try_divide(F.col("actual_eps") - F.col("estimate_eps"), F.nullif(F.abs("estimate_eps"), F.lit(0.0)))
    by = Window.partitionBy("ticker")
    rows = earnings.withColumn("pct", pct).where(F.col("pct").isNotNull())
    rows = rows.withColumn("rn", F.row_number().over(by.orderBy(F.desc("earnings_date"), F.desc("seq")))).where(F.col("rn") <= k).withColumn("n", F.count("*").over(by))
    half = F.floor(F.col("n") / 2)
    # Counted from the oldest: the earlier half has floor(n / 2) rows.
    later, earlier = (F.sum(F.when(c, F.col("pct")).otherwise(0.0)) for c in (F.col("n") - F.col("rn") >= half, F.col("n") - F.col("rn") < half))
    return rows.groupBy("ticker").agg(F.count_if(F.col("pct") > 0).alias("beats"), F.count_if(F.col("pct") < 0).alias("misses"), F.avg("pct").alias("mean_surprise"), F.max(F.when(F.col("rn") == 1, F.col("pct"))).alias("last_surprise"), F.when(F.count("*") >= 2, later - earlier).alias("trend"))


def trailing_dividends(payments: DataFrame, as_of: str, amount: Column | None = None) -> DataFrame:
    """Sum over the 365 days up to as_of, null where it isn't positive."""
    at = F.lit(as_of).cast("date")
    recent = (F.col("ex_date") > F.date_sub(at, 365)) & (F.col("ex_date") <= at)
    total = F.sum(F.when(recent, F.col("amount") if amount is None else amount))
    return payments.groupBy("ticker").agg(F.when(total > 0, total).alias("dividend_rate"))
