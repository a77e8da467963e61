"""Registered queries of audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audits, identity, macro
from ..sources import adapters as a
from .more_queries import LISTINGS, _listings
from .queries import COVERAGE, OBS, _actions, _coverage, _daily_sql, _observations, query


@query(
    """, s AS (SELECT 'M' || (l_suppkey % 4) AS mic, list(DISTINCT l_shipdate::DATE) AS d, max(l_shipdate::DATE) AS expected_date FROM lineitem WHERE l_shipdate::DATE < DATE '2001-10-20' AND l_shipdate::DATE >= DATE '2001-10-06' AND isodow(l_shipdate) < 6 GROUP BY ALL),
l AS (SELECT symbol, 'M' || (substr(symbol, 2)::BIGINT % 4) AS mic, max(date) FILTER (date < DATE '2001-10-20') AS last_date FROM prices GROUP BY ALL),
m AS (SELECT l.*, expected_date, CASE WHEN last_date IS NOT NULL THEN len(list_filter(coalesce(s.d, []), lambda x: x > last_date)) END AS missing_sessions FROM l LEFT JOIN s USING (mic))
SELECT symbol, mic, last_date, expected_date, missing_sessions, CASE WHEN last_date IS NULL OR expected_date IS NULL THEN 'unknown' WHEN missing_sessions = 0 THEN 'fresh' WHEN missing_sessions <= 1 THEN 'stale_within_tolerance' ELSE 'failed_hard' END AS freshness_state FROM m""",
    a.PRICES,
)
def fr2_session_freshness(spark, sf):
    prices = a.prices(spark, sf)
    mic = lambda c: F.concat(F.lit("M"), F.substring(c, 2, 20).cast("long") % 4)
    sessions = prices.where("weekday(date) < 5").select(mic("symbol").alias("mic"), F.col("date").alias("session_date")).distinct()
    return audits.session_freshness(prices.where("date < date'2001-10-20'"), prices.select("symbol", mic("symbol").alias("mic")).distinct(), sessions, "2001-10-20")


@query(
    """, d AS (SELECT symbol, action, ex_date, count(DISTINCT provider) AS n FROM act GROUP BY ALL), p AS (SELECT symbol, action, count(DISTINCT provider) AS providers FROM act GROUP BY ALL)
SELECT symbol, action, providers, count(*) AS dates, count(*) FILTER (n = providers) AS shared_dates FROM d JOIN p USING (symbol, action) GROUP BY ALL""",
    "act AS (SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'first' ELSE 'second' END AS provider, 'P' || l_partkey AS symbol, CASE WHEN l_returnflag = 'R' THEN 'split' ELSE 'dividend' END AS action, date_trunc('month', l_shipdate)::DATE AS ex_date FROM lineitem)",
)
def xr1_ex_date_overlap(spark, sf):
    return audits.ex_date_overlap(_actions(spark, sf))


@query(
    """SELECT n, n_market_data_available, n_fundamentals_available, n_earnings_available, removed, first_removed FROM (SELECT count(*) AS n, count(*) FILTER (market_data_available) AS n_market_data_available, count(*) FILTER (fundamentals_available) AS n_fundamentals_available, count(*) FILTER (earnings_available) AS n_earnings_available FROM cov WHERE market_data_available OR fundamentals_available),
(SELECT count(*) AS removed, min(ticker) AS first_removed FROM cov WHERE NOT (market_data_available OR fundamentals_available))""",
    a.PRICES, a.FUNDAMENTALS, a.EARNINGS, COVERAGE,
)
def cv5_rebuild_summary(spark, sf):
    rows = _coverage(spark, sf)
    return audits.rebuild_summary(rows.where("market_data_available OR fundamentals_available"), rows)


@query(
    _daily_sql(False) + """, dd AS (SELECT days.series_key, days.as_of_date FROM days), r AS (SELECT dd.*, o.observation_date FROM dd ASOF LEFT JOIN o ON dd.series_key = o.series_key AND dd.as_of_date >= o.observation_date)
SELECT series_key, as_of_date, observation_date IS NULL OR """ + f"{a.weekdays('as_of_date')} - {a.weekdays('observation_date')} > 5 AS replayed_stale FROM r",
    a.MACRO, OBS, a.CATALOG,
)
def px3_staleness_replay(spark, sf):
    days = macro.spine(a.catalog(spark, sf), "2024-01-03", "2024-02-09")
    return audits.staleness_replay(_observations(spark, sf), days, 5)


TRACKED = "tr AS (SELECT symbol, lei AS entity_id, isin AS lei FROM listings WHERE substr(symbol, 2)::BIGINT % 5 = 0)"


@query(
    """, c AS (SELECT symbol, lei AS entity_id, isin AS lei FROM listings WHERE substr(symbol, 2)::BIGINT % 5 IN (0, 1)),
j AS (SELECT c.*, (SELECT min(symbol) FROM tr WHERE tr.symbol = c.symbol) AS m0, (SELECT min(symbol) FROM tr WHERE tr.entity_id = c.entity_id) AS m1, (SELECT min(symbol) FROM tr WHERE tr.lei = c.lei) AS m2 FROM c),
s AS (SELECT *, CASE WHEN m0 IS NOT NULL THEN 'already_tracked_symbol' WHEN coalesce(m1, m2) IS NOT NULL THEN 'already_tracked_entity' WHEN coalesce(entity_id, lei) IS NULL THEN 'unresolved' ELSE 'new_entity' END AS status FROM j)
SELECT symbol, coalesce(m0, m1, m2) AS matched_symbol, status, CASE WHEN status LIKE 'already%' THEN 'suppress' WHEN status = 'unresolved' THEN 'review' ELSE 'admit' END AS action FROM s""",
    LISTINGS, TRACKED,
)
def id16_frontier(spark, sf):
    rows = _listings(spark, sf).select("symbol", F.col("lei").alias("entity_id"), F.col("isin").alias("lei"))
    k = F.substring("symbol", 2, 20).cast("long") % 5
    return audits.frontier(rows.where(k.isin(0, 1)), rows.where(k == 0))


@query("SELECT symbol, CASE WHEN isin IS NULL THEN 'not_found' ELSE 'suspect' END AS isin_status, CASE WHEN isin IS NULL THEN 'no_isin' ELSE 'invalid_isin' END AS isin_reason FROM listings", LISTINGS)
def id2_isin_status(spark, sf):
    return identity.isin_status(_listings(spark, sf)).select("symbol", "isin_status", "isin_reason")
