"""Registered queries of the ticker signal and of unpivoted statements and panels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import company, market, signal, statements
from ..sources import adapters as a
from .queries import RANKED, query

AT = "2001-06-01"


def _features(spark, sf):
    """Prices of a supplier beside the earnings of the customer of the same number."""
    prices = a.prices(spark, sf)
    number = lambda c: F.substring(c, 2, 20)
    own = market.trend_features(prices).join(market.market_stats(prices).select("symbol", "return_1m", "return_3m", "return_1y"), "symbol").withColumn("n", number("symbol"))
    earnings = a.earnings(spark, sf)
    stats = company.surprise_stats(earnings).withColumn("n", number("ticker")).drop("ticker")
    upcoming = company.next_earnings(earnings, AT, ("state",)).select(number("ticker").alias("n"), F.datediff("earnings_date", F.lit(AT).cast("date")).alias("days_until"))
    k = F.col("n").cast("long")
    return own.join(stats, "n", "left").join(upcoming, "n", "left").select(F.col("symbol").alias("ticker"), "return_1m", "return_3m", "return_1y", *(f"dist_ma_{x}" for x in (20, 50, 200)), "fall_from_high", "vol_20d", "volume_ratio", "beats", "mean_surprise", "last_surprise", "trend", "days_until", (k % 4 != 0).alias("supports_earnings"), (k % 9 != 0).alias("fresh"))


def _points(rules) -> str:
    return " + ".join(f"CASE WHEN {c.replace('int(', '(').replace(', false)', ', false)::INT')} THEN {p} ELSE 0 END" for c, p, *_ in rules)


FEATURES = f"""px AS (SELECT symbol, substr(symbol, 2) AS n, max(close) FILTER (rk = 1) / nullif(max(close) FILTER (rk = 22), 0) - 1 AS return_1m, max(close) FILTER (rk = 1) / nullif(max(close) FILTER (rk = 64), 0) - 1 AS return_3m, max(close) FILTER (rk = 1) / nullif(max(close) FILTER (rk = 253), 0) - 1 AS return_1y,
 {", ".join(f"CASE WHEN count(*) >= {n} THEN max(close) FILTER (rk = 1) / nullif(avg(close) FILTER (rk <= {n}), 0) - 1 END AS dist_ma_{n}" for n in (20, 50, 200))}, max(close) FILTER (rk = 1) / max(close) FILTER (rk <= 252) - 1 AS fall_from_high,
 CASE WHEN count(ret) FILTER (rk <= 20) >= 2 THEN stddev_samp(ret) FILTER (rk <= 20) * sqrt(252) END AS vol_20d, CASE WHEN count(volume) >= 20 THEN max(volume) FILTER (rk = 1) / nullif(avg(volume) FILTER (rk <= 20), 0) END AS volume_ratio FROM ranked GROUP BY symbol),
sp AS (SELECT *, (actual_eps - estimate_eps) / nullif(abs(estimate_eps), 0) AS pct FROM earnings), sr AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY earnings_date DESC, seq DESC) AS rn FROM sp WHERE pct IS NOT NULL), sk AS (SELECT *, count(*) OVER (PARTITION BY ticker) AS c FROM sr WHERE rn <= 4),
ss AS (SELECT substr(ticker, 2) AS n, count(*) FILTER (pct > 0) AS beats, avg(pct) AS mean_surprise, max(pct) FILTER (rn = 1) AS last_surprise, CASE WHEN count(*) >= 2 THEN sum(CASE WHEN c - rn >= c // 2 THEN pct ELSE -pct END) END AS trend FROM sk GROUP BY ticker),
nx AS (SELECT substr(ticker, 2) AS n, min(earnings_date) - DATE '{AT}' AS days_until FROM earnings WHERE earnings_date >= DATE '{AT}' GROUP BY ticker),
ft AS (SELECT px.*, beats, mean_surprise, last_surprise, trend, days_until, n::BIGINT % 9 <> 0 AS fresh, CASE WHEN n::BIGINT % 4 = 0 THEN 'market_only' WHEN beats IS NULL THEN 'insufficient_history' ELSE 'full' END AS mode FROM px LEFT JOIN ss USING (n) LEFT JOIN nx USING (n)),
sc AS (SELECT *, least(1, greatest(0, 0.5 + {_points(signal.MARKET_RULES)}))::DOUBLE AS market_score, CASE mode WHEN 'market_only' THEN 0.5 WHEN 'insufficient_history' THEN 0.45 ELSE least(1, greatest(0, 0.5 + {_points(signal.EARNINGS_RULES)})) END::DOUBLE AS earnings_score, least(1, greatest(0, 1 - ({_points(signal.DOUBT_RULES)})))::DOUBLE AS confidence FROM ft)"""


@query(
    f"""SELECT symbol AS ticker, market_score, earnings_score, CASE WHEN fresh THEN round(least(1, greatest(0, market_score * 0.65 + earnings_score * 0.35 - ({_points(signal.EVENT_RULES)}))), 4) END::DOUBLE AS score, confidence FROM sc""",
    a.PRICES, RANKED, a.EARNINGS, FEATURES,
)
def mk14_ticker_signal(spark, sf):
    return signal.signal(_features(spark, sf)).select("ticker", "market_score", "earnings_score", "score", "confidence")


def mk14_signal_report(spark, sf):
    return signal.signal(_features(spark, sf))


query(None)(mk14_signal_report)


@query("SELECT 'S' || s_suppkey AS symbol, m AS metric, v AS value FROM (SELECT s_suppkey, unnest(['revenue', 'net_income']) AS m, unnest([s_acctbal, s_suppkey * 2.0]) AS v FROM supplier) WHERE v IS NOT NULL")
def mk6_unpivoted_statements(spark, sf):
    wide = a.table(spark, sf, "supplier").select(F.concat(F.lit("S"), "s_suppkey").alias("symbol"), F.col("s_acctbal").alias("Total Revenue"), (F.col("s_acctbal") * 2).alias("Operating Revenue"), (F.col("s_suppkey") * 2.0).alias("Net Income"))
    return statements.unpivoted(wide, ["symbol"], {"revenue": ["Total Revenue", "Operating Revenue"], "net_income": ["Net Income"]})


@query("SELECT o_orderdate::DATE AS signal_date, 'C' || o_custkey AS symbol, o_totalprice AS score FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 7 <> 0")
def mk18_signal_panel(spark, sf):
    o = a.table(spark, sf, "orders")
    one = F.struct(F.when(F.col("o_orderkey") % 7 != 0, F.concat(F.lit("C"), "o_custkey")).alias("symbol"), F.col("o_totalprice").alias("score"))
    result = F.to_json(F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("signal_date"), F.array(one).alias("signals")))
    return statements.signal_panel(o.select(F.when(F.col("o_orderstatus") == "P", "failed").otherwise("success").alias("status"), result.alias("result"))).select("signal_date", "symbol", "score")
