"""The ticker signal: scores of market and earnings features by tables of rules, for all tickers at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Condition, points, text; a text with positive or no points is a driver, with negative ones a risk. Null conditions don't hold.
POSITIVE = "(int(coalesce(return_1m > 0, false)) + int(coalesce(return_3m > 0, false)) + int(coalesce(return_1y > 0, false)))"
MARKET_RULES = [
    (f"{POSITIVE} = 3", 0.18, "price trend positive across 1m, 3m, and 1y windows"),
    (f"{POSITIVE} = 2", 0.10, "price trend positive across multiple windows"),
    (f"{POSITIVE} = 0 AND (return_1m IS NOT NULL OR return_3m IS NOT NULL)", -0.14, "price trend negative across short and medium windows"),
    *((f"dist_ma_{n} > 0", 0.02, f"price above {n}d moving average") for n in (20, 50, 200)),
    *((f"dist_ma_{n} <= 0", -0.02, f"price below {n}d moving average") for n in (20, 50, 200)),
    ("fall_from_high > -0.10", 0.05, "modest drawdown from trailing high"),
    ("fall_from_high < -0.25", -0.08, "deep drawdown from trailing high"),
    ("vol_20d > 0.45", -0.05, "elevated short-term volatility"),
    ("vol_20d < 0.25", 0.02, None),
    ("volume_ratio > 1.5", 0.0, "volume running above 20d average"),
]
EARNINGS_RULES = [
    ("beats >= 3", 0.10, "earnings beats outnumber misses over the last 4 quarters"),
    ("beats <= 1", -0.08, "earnings misses dominate recent quarters"),
    ("mean_surprise > 0", 0.07, "average earnings surprise is positive"),
    ("mean_surprise < 0", -0.07, "average earnings surprise is negative"),
    ("last_surprise > 0", 0.05, "last reported earnings surprise was positive"),
    ("last_surprise < 0", -0.05, "last reported earnings surprise was negative"),
    ("trend > 0", 0.04, "earnings surprise trend is improving"),
    ("trend < 0", -0.04, "earnings surprise trend is deteriorating"),
]
EVENT_RULES = [("days_until <= 7", 0.12, "elevated pre-earnings uncertainty"), ("days_until > 7 AND days_until <= 14", 0.07, "near-term earnings event risk"), ("days_until > 14 AND days_until <= 21", 0.03, "earnings event approaching")]
DOUBT_RULES = [("dist_ma_200 IS NULL", 0.10), ("dist_ma_50 IS NULL", 0.05), ("return_3m IS NULL", 0.05), ("mode = 'insufficient_history'", 0.15), ("mode = 'market_only'", 0.08), ("NOT fresh", 0.15), ("days_until IS NULL", 0.05)]
LABELS = [(0.75, "positive"), (0.60, "watch"), (0.40, "neutral")]
MARKET_SHARE, EARNINGS_SHARE = 0.65, 0.35


def clamp(c: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), c))


def points(rules: list[tuple], base: float = 0.5) -> Column:
    return reduce(lambda acc, r: acc + F.when(F.expr(r[0]), F.lit(float(r[1]))).otherwise(0.0), rules, F.lit(base))


def texts(rules: list[tuple], negative: bool) -> Column:
    return F.array_compact(F.array(*(F.when(F.expr(c), F.lit(t)) for c, p, t in rules if t and (p < 0) == negative)))


def signal(features: DataFrame) -> DataFrame:
    """A report row for each ticker, from market features (returns, distances, fall_from_high, vol_20d, volume_ratio), earnings features (beats, mean_surprise, last_surprise, trend; null without history), days_until the next event, supports_earnings and fresh.

    A ticker whose inputs aren't fresh is neutral and has no score.
    """
    mode = F.when(~F.col("supports_earnings"), "market_only").when(F.col("beats").isNull(), "insufficient_history").otherwise("full")
    rows = features.withColumn("mode", mode)
    earnings = F.when(F.col("mode") == "market_only", 0.5).when(F.col("mode") == "insufficient_history", 0.45).otherwise(clamp(points(EARNINGS_RULES)))
    rows = rows.withColumns({"market_score": clamp(points(MARKET_RULES)), "earnings_score": earnings, "confidence": F.bround(clamp(F.lit(1.0) - points(DOUBT_RULES, 0.0)), 4)})
    blend = F.col("market_score") * MARKET_SHARE + F.col("earnings_score") * EARNINGS_SHARE - points(EVENT_RULES, 0.0)
    rows = rows.withColumn("score", F.when(F.col("fresh"), F.bround(clamp(blend), 4)))
    label = reduce(lambda acc, x: acc.when(F.col("score") >= x[0], x[1]), LABELS, F.when(F.col("score").isNull(), "neutral")).otherwise("caution")
    rows = rows.withColumn("label", F.when((label == "positive") & (F.col("confidence") < 0.5), "watch").otherwise(label))
    m, e = F.col("market_score"), F.col("earnings_score")
    stance = F.when(F.col("confidence") < 0.40, "insufficient_data").when(F.col("mode") == "market_only", "market_only").when((F.col("days_until") <= 14) & F.col("label").isin("positive", "watch"), "positive_but_event_risk_near").when((m >= 0.6) & (e >= 0.6), "trend_and_earnings_aligned").when((m < 0.45) & (e < 0.45), "weak_trend_and_weak_earnings").otherwise("mixed_signal")
    full = F.col("mode") == "full"
    drivers = F.concat(texts(MARKET_RULES, False), F.when(full, texts(EARNINGS_RULES, False)).otherwise(F.expr("cast(array() as array<string>)")))
    why = F.when(F.col("mode") == "market_only", "earnings not applicable for instrument type").when(F.col("mode") == "insufficient_history", "recent earnings history unavailable")
    risks = F.concat(texts(MARKET_RULES, True), F.when(full, texts(EARNINGS_RULES, True)).otherwise(F.array_compact(F.array(why))), texts([(c, -p, t) for c, p, t in EVENT_RULES], True))
    rows = rows.withColumns({"stance": stance, "drivers": drivers, "risks": risks})
    first = lambda c, other: F.coalesce(F.get(F.col(c), F.lit(0)), F.lit(other))
    said = F.format_string("%s scores %s (%.2f) with %s, while %s (confidence=%.2f, stance=%s).", F.col("ticker"), F.col("label"), F.col("score"), first("drivers", "market and earnings inputs are mixed"), first("risks", "no immediate risk factors dominate"), F.col("confidence"), F.col("stance"))
    summary = F.when(F.col("score").isNull(), F.concat("ticker", F.lit(" is neutral because required upstream inputs are not fresh enough for a confident signal."))).otherwise(said)
    return rows.select("ticker", "market_score", "earnings_score", "score", "confidence", "label", "stance", "drivers", "risks", summary.alias("summary"))
