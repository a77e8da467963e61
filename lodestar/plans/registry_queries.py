"""Registered queries of the registry, its clean-up, refresh gates, onboarding and dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import market, registry, statements
from ..sources import adapters as a
from .queries import query




@query("SELECT DISTINCT c_mktsegment, c_nationkey % 5 AS k, CASE c_nationkey % 5 WHEN 0 THEN 'us' WHEN 1 THEN 'eu' WHEN 2 THEN 'apac' WHEN 3 THEN 'all' ELSE 'global' END AS region FROM customer")
def rg2_regions(spark, sf):
    k = F.col("c_nationkey") % 5
    raw = F.when(k == 0, " NYSE").when(k == 1, "Europe ").when(k == 2, "asx").when(k == 3, "Global").otherwise(F.col("c_mktsegment"))
    return a.table(spark, sf, "customer").select("c_mktsegment", k.alias("k"), registry.refresh_region(raw).alias("region")).distinct()


@query("SELECT 'C' || (o_custkey % 200) AS symbol, min(o_orderkey) AS first_seq FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'F' AND o_custkey % 2 = 0 AND o_orderkey % 3 <> 0 GROUP BY ALL")
def rg3_validated_symbols(spark, sf):
    p, k = F.col("o_orderpriority"), F.col("o_orderkey")
    promotion = F.when(p == "1-URGENT", "validated_full").when(p == "2-HIGH", "VALIDATED_MARKET_ONLY").otherwise("candidate")
    rows = a.table(spark, sf, "orders").select(F.concat(F.lit(" c"), F.col("o_custkey") % 200).alias("normalized_symbol"), F.when(F.col("o_custkey") % 2 == 0, " US").otherwise("eu").alias("region"), F.when(F.col("o_orderstatus") == "F", "Active").otherwise("pending").alias("status"), promotion.alias("promotion_status"), (k % 3 != 0).alias("market_supported"), k.alias("seq"))
    return registry.validated_symbols(rows, "us")


@query("SELECT 'K' || o_custkey AS registry_key, upper(o_orderstatus) || o_orderkey AS input_symbol, CASE WHEN o_orderkey % 2 = 0 THEN lower(o_orderpriority) END AS region, o_orderkey AS seq FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1")
def rg4_registry_upsert(spark, sf):
    k = F.col("o_orderkey")
    rows = a.table(spark, sf, "orders").select(F.concat(F.lit("K"), "o_custkey").alias("registry_key"), F.concat(F.lit(" "), F.lower("o_orderstatus"), k).alias("input_symbol"), F.when(k % 2 == 0, F.concat("o_orderpriority", F.lit(" "))).otherwise("  ").alias("region"), k.alias("seq"))
    return registry.normalised_registry(rows, ("input_symbol",), ("region",))


@query(
    """, c AS (SELECT 'I' || o_custkey AS input_symbol, o_orderkey AS candidate, o_orderkey % 4 AS s, o_orderkey % 2 = 0 AS market, o_orderkey % 3 = 0 AS fundamentals, o_orderkey % 5 = 0 AS earnings FROM orders), d AS (SELECT *, [300, 200, 100, 0][s + 1] + CASE WHEN market THEN 50 ELSE 0 END + CASE WHEN fundamentals THEN 10 ELSE 0 END + CASE WHEN earnings THEN 10 ELSE 0 END AS score FROM c)
SELECT input_symbol, candidate, ['validated_full', 'validated_market_only', 'pending_validation', 'rejected'][s + 1] AS validation_status, market, fundamentals, earnings, score FROM d QUALIFY row_number() OVER (PARTITION BY input_symbol ORDER BY s, score DESC, candidate) = 1""",
    "one AS (SELECT 1)",
)
def rg6_best_candidates(spark, sf):
    k = F.col("o_orderkey")
    state = F.element_at(F.array(*map(F.lit, registry.STATE_POINTS)), (k % 4 + 1).cast("int"))
    return registry.best_candidates(a.table(spark, sf, "orders").select(F.concat(F.lit("I"), "o_custkey").alias("input_symbol"), k.alias("candidate"), state.alias("validation_status"), (k % 2 == 0).alias("market"), (k % 3 == 0).alias("fundamentals"), (k % 5 == 0).alias("earnings")))


@query(
    """, x AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 11 = 0 THEN lpad(c_custkey::VARCHAR, 9, '0') || 'A' ELSE 'L' || c_custkey END AS symbol, c_custkey % 2 = 0 AS av, c_custkey % 6 = 1 AS rej, c_custkey % 12 = 1 AS allrej, c_custkey % 5 = 0 AS cov, CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE c_custkey % 60 END AS p, CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 4 ELSE 0 END AS t, CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS s, CASE WHEN c_custkey % 13 = 0 THEN 'L' || (c_custkey + 1) END AS sup FROM customer),
i AS (SELECT *, CASE WHEN k % 11 = 0 THEN CASE WHEN p = 0 AND t = 0 AND s = 0 THEN CASE WHEN allrej AND NOT cov THEN 'already_cleaned' ELSE 'invalid_placeholder' END END WHEN sup IS NOT NULL THEN CASE WHEN allrej AND NOT cov THEN 'already_cleaned' ELSE 'superseded_alias' END
 WHEN av AND p = 0 AND t = 0 AND s = 0 THEN 'active_validated_without_materialized_data' WHEN rej AND p > 0 AND t > 0 THEN 'rejected_shadow_row_with_tracked_canonical' WHEN p > 0 AND t > 0 AND s = 0 THEN 'repairable_missing_scorecard' WHEN p > 0 AND t = 0 THEN CASE WHEN k % 17 = 0 OR p >= 30 THEN 'repairable_missing_technicals' ELSE 'partial_keep_review' END END AS issue_class FROM x)
SELECT symbol, issue_class, CASE issue_class WHEN 'superseded_alias' THEN 'mark_superseded_alias_and_clear_stale_coverage' WHEN 'rejected_shadow_row_with_tracked_canonical' THEN 'suppress_from_readiness_error_audit' WHEN 'repairable_missing_scorecard' THEN 'trigger_targeted_scorecard_build' WHEN 'repairable_missing_technicals' THEN 'trigger_technical_backfill_then_scorecard_build' WHEN 'partial_keep_review' THEN 'leave_partial_source_only_for_manual_review' WHEN 'already_cleaned' THEN 'no_action' ELSE 'reject_deactivate_registry_rows_and_clear_stale_coverage' END AS proposed_action, CASE WHEN k % 13 = 0 THEN sup END AS superseded_by FROM i WHERE issue_class IS NOT NULL""",
    "one AS (SELECT 1)",
)
def rd3_cleanup_plan(spark, sf):
    k = F.col("c_custkey")
    c = a.table(spark, sf, "customer").withColumn("symbol", F.when(k % 11 == 0, F.concat(F.lpad(k.cast("string"), 9, "0"), F.lit("A"))).otherwise(F.concat(F.lit("L"), k)))
    contexts = c.select(
        "symbol", (k % 2 == 0).alias("active_validated"), (k % 6 == 1).alias("rejected"), (k % 12 == 1).alias("all_rejected"), (k % 5 == 0).alias("has_coverage"), F.when(k % 4 == 0, 0).otherwise(k % 60).alias("price_rows"), F.when(k % 3 == 0, k % 4).alias("technical_rows"), F.when(k % 7 == 0, 1).alias("scorecard_rows"))
    return registry.cleanup_plan(contexts, c.where(k % 13 == 0).select("symbol", F.concat(F.lit("L"), k + 1).alias("superseded_by")), c.where(k % 17 == 0))


@query("SELECT count(*) FILTER (c_custkey % 9 <> 0) AS n_succeeded, count(*) FILTER (c_custkey % 9 = 0) AS n_failed, count(*) FILTER (c_custkey % 45 = 0) AS n_required_failed, count(*) FILTER (c_custkey % 9 = 0 AND c_custkey % 2 = 0) AS n_exhausted, 'partial' AS status FROM customer")
def fr4_refresh_status(spark, sf):
    k = F.col("c_custkey")
    c = a.table(spark, sf, "customer").withColumn("key", k.cast("string"))
    return registry.refresh_status(c.select("key", (k % 9 != 0).alias("succeeded"), (k % 2 == 0).alias("exhausted")), c.where(k % 5 == 0))


@query(
    """, t AS (SELECT 'market' AS domain, true AS blocking, max(l_shipdate::DATE) AS d, 40 AS g FROM lineitem UNION ALL SELECT 'orders', true, max(o_orderdate::DATE), 0 FROM orders UNION ALL SELECT 'events', false, max(ts::DATE), 0 FROM events)
SELECT domain, blocking, d AS latest_date, (DATE '2001-12-01' - d)::INT AS lag_days, coalesce(DATE '2001-12-01' - d <= g, false) AS ok, CASE WHEN DATE '2001-12-01' - d <= g THEN 'ready' WHEN blocking THEN 'blocked' ELSE 'degraded' END AS state FROM t""",
    "one AS (SELECT 1)",
)
def fr7_watermark_gate(spark, sf):
    t = lambda name: a.table(spark, sf, name)
    return registry.watermark_gate({"market": (t("lineitem"), "l_shipdate", True, 40), "orders": (t("orders"), "o_orderdate", True, 0), "events": (t("events"), "ts", False, 0)}, "2001-12-01")


@query(
    """SELECT 'C' || c_custkey AS ticker, coalesce(f.n, 0) AS fundamentals_rows, f.d AS fundamentals_latest, coalesce(e.n, 0) AS earnings_rows, e.d AS earnings_latest, e.nx AS next_earnings_date, CASE WHEN coalesce(f.n, 0) + coalesce(e.n, 0) > 0 THEN 'fresh' ELSE 'unknown' END AS coverage_status FROM customer
LEFT JOIN (SELECT ticker, count(*) AS n, max(period_end) AS d FROM facts WHERE metric = 'eps' GROUP BY ALL) f ON f.ticker = 'C' || c_custkey LEFT JOIN (SELECT ticker, count(*) AS n, max(earnings_date) AS d, min(earnings_date) FILTER (earnings_date >= DATE '2001-01-01') AS nx FROM earnings WHERE state = 'F' GROUP BY ALL) e ON e.ticker = 'C' || c_custkey""",
    a.FUNDAMENTALS, a.EARNINGS,
)
def cv6_rebuilt_coverage(spark, sf):
    symbols = a.table(spark, sf, "customer").select(F.concat(F.lit("C"), "c_custkey").alias("ticker"))
    return registry.rebuilt_coverage(symbols, {"fundamentals": (a.fundamentals(spark, sf).where("metric = 'eps'"), "ticker", "period_end"), "earnings": (a.earnings(spark, sf).where("state = 'F'"), "ticker", "earnings_date")}, "2001-01-01")


@query("SELECT event_type || x AS series_key, ts::DATE AS observation_date, count(*) AS n FROM events, (SELECT unnest(['_headline', '_core']) AS x) WHERE event_type <> 'view' GROUP BY ALL")
def rc5_series_schedule(spark, sf):
    rows = a.table(spark, sf, "events").groupBy(F.col("event_type").alias("anchor"), F.col("ts").cast("date").alias("observation_date")).agg(F.count("*").alias("n"))
    groups = rows.select("anchor").distinct().where("anchor <> 'view'").select("anchor", F.explode(F.array(F.concat("anchor", F.lit("_headline")), F.concat("anchor", F.lit("_core")))).alias("series_key"))
    return registry.series_schedule(rows, groups)


@query("SELECT count(*) AS n_rows, count(*) FILTER (event_id % 50 = 0) AS n_late, 1::BIGINT AS n_missing, 'partial' AS status FROM events")
def rc10_calendar_status(spark, sf):
    calendar = a.table(spark, sf, "events").select(F.col("event_type").alias("series_key"), F.when(F.col("event_id") % 50 == 0, "late_missing_observation").otherwise("observed_available").alias("availability_status"))
    asked = calendar.select("series_key").distinct().unionAll(calendar.select(F.concat("series_key", F.lit("?"))).orderBy(F.desc("series_key")).limit(1))
    return registry.calendar_status(calendar, asked)


@query("SELECT 'L' || c_custkey AS ticker, CASE WHEN c_custkey % 2 = 0 OR c_custkey % 10 = 3 THEN c_mktsegment END AS sector, CASE WHEN c_custkey % 10 = 5 THEN 'malformed_symbol' WHEN c_custkey % 2 = 1 AND c_custkey % 10 = 3 THEN 'filled' ELSE 'unchanged' END AS outcome FROM customer WHERE c_custkey % 10 <> 5 UNION ALL SELECT 'L ' || c_custkey, NULL, 'malformed_symbol' FROM customer WHERE c_custkey % 10 = 5")
def rg9_attribute_backfill(spark, sf):
    k = F.col("c_custkey")
    c = a.table(spark, sf, "customer").withColumn("ticker", F.when(k % 10 == 5, F.concat(F.lit("L "), k)).otherwise(F.concat(F.lit("L"), k)))
    return registry.backfilled(c.select("ticker", F.when(k % 2 == 0, F.col("c_mktsegment")).alias("sector")), c.where((k % 10).isin(3, 5)).select("ticker", F.col("c_mktsegment").alias("sector")), "ticker", ("sector",))


@query(
    """SELECT 'E' || (s_suppkey % 7) AS etf_ticker, CASE s_suppkey % 5 WHEN 0 THEN (s_suppkey % 1000)::VARCHAR WHEN 4 THEN '' ELSE 'Q' || s_suppkey END AS source_symbol, CASE s_suppkey % 5 WHEN 0 THEN 'HK' WHEN 1 THEN 'DE' WHEN 2 THEN 'US' ELSE 'FR' END AS source_country,
CASE s_suppkey % 5 WHEN 0 THEN lpad((s_suppkey % 1000)::VARCHAR, 4, '0') || '.HK' WHEN 1 THEN 'Q' || s_suppkey || '.DE' WHEN 2 THEN CASE WHEN s_suppkey % 3 = 0 THEN 'Q' || s_suppkey END END AS provider_symbol, s_suppkey % 5 < 2 OR (s_suppkey % 5 = 2 AND s_suppkey % 3 = 0) AS is_onboardable,
CASE s_suppkey % 5 WHEN 0 THEN 'source_country_numeric_mapping' WHEN 1 THEN CASE WHEN s_suppkey % 2 = 0 THEN 'entity_attributes_static' ELSE 'source_exchange' END WHEN 2 THEN CASE WHEN s_suppkey % 3 = 0 THEN 'ticker_registry' ELSE 'source_identity' END WHEN 3 THEN 'source_country' ELSE 'source_identity' END AS resolution_source,
CASE s_suppkey % 5 WHEN 0 THEN 0.84 WHEN 1 THEN CASE WHEN s_suppkey % 2 = 0 THEN 0.95 ELSE 0.86 END WHEN 2 THEN CASE WHEN s_suppkey % 3 = 0 THEN 0.92 ELSE 0.25 END WHEN 3 THEN 0.35 ELSE 0 END::DOUBLE AS resolution_confidence,
CASE s_suppkey % 5 WHEN 2 THEN CASE WHEN s_suppkey % 3 <> 0 THEN 'ambiguous_listing' END WHEN 3 THEN 'missing_provider_symbol' WHEN 4 THEN 'missing_source_symbol' END AS not_onboardable_reason FROM supplier"""
)
def et9_onboarding_identities(spark, sf):
    k = F.col("s_suppkey")
    s = a.table(spark, sf, "supplier")
    name = F.when(k % 5 == 0, (k % 1000).cast("string")).when(k % 5 == 4, "").otherwise(F.concat(F.lit("q"), k))
    place = F.when(k % 5 == 0, "HK").when(k % 5 == 1, "DE").when(k % 5 == 2, "US").otherwise("FR")
    holdings = s.select(F.concat(F.lit("E"), k % 7).alias("etf_ticker"), name.alias("source_symbol"), place.alias("source_country"), F.when(k % 5 == 1, "ETR").alias("source_exchange"))
    return registry.onboarding_identities(holdings, s.where((k % 5 == 1) & (k % 2 == 0)).select(F.concat(F.lit("Q"), k, F.lit(".DE")).alias("symbol")), s.where((k % 5 == 2) & (k % 3 == 0)).select(F.concat(F.lit("Q"), k).alias("symbol")))


@query(
    """, p AS (SELECT s_suppkey, '{' || CASE WHEN s_suppkey % 2 = 0 THEN '"currency":"USD",' ELSE '' END || CASE WHEN s_suppkey % 3 <> 0 AND s_suppkey % 5 = 0 THEN '"exchCode":"US",' ELSE '' END || '"idType":"TICKER","idValue":"Q' || s_suppkey || '"' || CASE WHEN s_suppkey % 3 = 0 THEN ',"micCode":"XETR"' ELSE '' END || '}' AS payload FROM supplier)
SELECT 'q' || s_suppkey || '.de' AS symbol, payload, sha256(payload) AS request_hash FROM p""",
    "one AS (SELECT 1)",
)
def sc36_request_keys(spark, sf):
    k = F.col("s_suppkey")
    return registry.request_keys(a.table(spark, sf, "supplier").select(F.concat(F.lit("q"), k, F.lit(".de")).alias("symbol"), F.when(k % 3 == 0, " xetr").alias("mic"), F.when(k % 5 == 0, "US").alias("exchange_code"), F.when(k % 2 == 0, "usd").alias("currency")))


@query(
    f"""SELECT symbol, 'Market price history ' || CASE WHEN expected > 0 THEN 'is ' || printf('%.2f', pct) || '% complete from ' || lo || ' to ' || hi || ', with ' || missing || ' missing business days.' ELSE 'window is from ' || lo || ' to ' || hi || '.' END || ' Assessment: ' ||
 CASE WHEN missing = 0 THEN 'acceptable (no missing business days in range).' WHEN pct IS NULL THEN 'needs review (completeness percentage unavailable).' WHEN pct >= 99 AND missing <= 3 THEN 'generally acceptable with minor gaps.' WHEN pct >= 95 THEN 'usable but gaps should be reviewed before strict analyses.' ELSE 'not acceptable for strict analyses until gaps are resolved.' END AS summary
FROM (SELECT *, greatest(0, expected - actual) AS missing, round(actual * 100.0::DOUBLE / nullif(expected, 0), 2) AS pct FROM (SELECT symbol, min(date) AS lo, max(date) AS hi, count(*) AS actual, {a.weekdays("(max(date) + 1)")} - {a.weekdays("min(date)")} AS expected FROM prices GROUP BY symbol))""",
    a.PRICES,
)
def mk16_completeness_text(spark, sf):
    return registry.completeness_text(market.data_windows(a.prices(spark, sf)))


@query(
    """, m AS (SELECT 'P' || p_partkey AS ticker, p_retailprice AS price, p_size AS eps, CASE WHEN p_partkey % 4 = 0 THEN -1.0 ELSE p_size / 10.0 END::DOUBLE AS h, p_partkey % 3 = 0 AS fund FROM part)
SELECT ticker, metric, round(value, 6) AS value FROM (SELECT ticker, unnest(['market_cap', 'eps', 'dividend_rate', 'dividend_yield', 'payout_ratio']) AS metric, unnest([CASE WHEN fund THEN price * 5 END, eps, CASE WHEN h > 0 THEN h ELSE 0.5 END, CASE WHEN h > 0 THEN h / price ELSE 0.01 END, CASE WHEN h > 0 THEN h / eps END])::DOUBLE AS value FROM m) WHERE value IS NOT NULL""",
    "one AS (SELECT 1)",
)
def mk7_point_metrics(spark, sf):
    k = F.col("p_partkey")
    rows = a.table(spark, sf, "part").select(F.concat(F.lit("P"), k).alias("ticker"), F.lit(0.0).alias("market_cap"), (k % 3 == 0).alias("is_fund"), (F.col("p_retailprice") * 5).alias("total_assets"), F.when(k % 4 == 0, -1.0).otherwise(F.col("p_size") / 10).alias("history_rate"), F.lit(0.5).alias("vendor_rate"), F.lit(0.01).alias("vendor_yield"), F.col("p_retailprice").alias("price"), F.col("p_size").cast("double").alias("eps"))
    return registry.point_metrics(rows)


@query("SELECT etf_ticker, theme, wave, active, coalesce(n, 0) AS holdings_count, d AS holdings_as_of, active AND coalesce(n, 0) = 0 AS contract_violated FROM themes LEFT JOIN (SELECT etf_ticker, count(DISTINCT holding_symbol) AS n, max(as_of) AS d FROM holdings WHERE etf_ticker NOT LIKE '%3' GROUP BY ALL) USING (etf_ticker)", a.HOLDINGS, a.THEMES)
def et12_theme_dimension(spark, sf):
    return registry.theme_dimension(a.themes(spark, sf), a.positions(spark, sf).where("etf_ticker NOT LIKE '%3'"))


@query("SELECT etf_ticker, sector, round(weight, 6) AS weight FROM (SELECT 'E' || l_suppkey AS etf_ticker, unnest(['r', 'a', 'n']) AS sector, unnest([sum(l_quantity) FILTER (l_returnflag = 'R'), sum(l_quantity) FILTER (l_returnflag = 'A'), sum(l_quantity) FILTER (l_returnflag = 'N')]) / sum(l_quantity) AS weight FROM lineitem GROUP BY l_suppkey) WHERE weight IS NOT NULL")
def et10_sector_weights(spark, sf):
    total = F.sum("l_quantity")
    wide = a.table(spark, sf, "lineitem").groupBy(F.concat(F.lit("E"), "l_suppkey").alias("etf_ticker")).agg(*((F.sum(F.when(F.col("l_returnflag") == flag, F.col("l_quantity"))) / total).alias(flag.lower()) for flag in "RAN"))
    return statements.weights_by_sector(wide, "etf_ticker")


@query(
    """, f AS (SELECT etf_ticker, holding_symbol, weight, 'K' || (substr(holding_symbol, 2)::BIGINT % 25) AS listing_key FROM holdings WHERE etf_ticker LIKE '%2' OR etf_ticker LIKE '%5')
SELECT etf_ticker, holding_symbol, round(weight, 6) AS weight FROM holdings WHERE etf_ticker NOT LIKE '%2' AND etf_ticker NOT LIKE '%5' UNION ALL SELECT etf_ticker, holding_symbol, round(weight, 6) FROM (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY etf_ticker, listing_key ORDER BY weight DESC, holding_symbol) = 1)""",
    a.HOLDINGS,
)
def et2_replaced_holdings(spark, sf):
    rows = a.holdings(spark, sf).select("etf_ticker", "holding_symbol", "weight")
    fresh = rows.where("etf_ticker LIKE '%2' OR etf_ticker LIKE '%5'").withColumn("listing_key", F.concat(F.lit("K"), F.substring("holding_symbol", 2, 20).cast("long") % 25))
    return registry.replaced_holdings(rows, fresh)


@query("SELECT 'E' || (c_custkey % 20) AS etf_ticker, count(*) AS n, count(*) FILTER (c_custkey % 3 <> 1) AS changed, count(*) FILTER (c_custkey % 3 <> 1) AS numeric_before, 0::BIGINT AS numeric_after, 0::BIGINT AS missing FROM customer GROUP BY ALL")
def et11_renormalised_holdings(spark, sf):
    k = F.col("c_custkey")
    name = F.when(k % 3 == 0, (1 + k % 900).cast("string")).when(k % 3 == 1, F.concat(F.lit("Q"), k)).otherwise((5000 + k % 900).cast("string"))
    return registry.renormalised_holdings(a.table(spark, sf, "customer").select(F.concat(F.lit("E"), k % 20).alias("etf_ticker"), name.alias("holding_symbol"), F.when(k % 3 == 0, "HK").when(k % 3 == 1, "US").otherwise("TW").alias("holding_country")))


@query("SELECT 'C' || o_custkey AS symbol, o_orderdate::DATE AS date, round(o_totalprice, 6) AS close, round(CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice / 2 ELSE o_totalprice END, 6) AS adj_close, o_orderkey::DOUBLE AS volume FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 7 <> 0")
def mk19_canonical_prices(spark, sf):
    k, p = F.col("o_orderkey"), F.col("o_totalprice")
    raw = a.table(spark, sf, "orders").select(F.concat(F.lit(" c"), "o_custkey").alias("Ticker"), F.when(k % 7 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("Date"), F.when(F.col("o_orderstatus") != "P", p).alias("Close"), F.when(k % 3 == 0, p / 2).alias("Adj Close"), k.alias("Volume"))
    return registry.canonical_prices(raw, {"symbol": ("symbol", "Ticker"), "date": ("Date", "Datetime"), "close": ("Close",), "adj_close": ("Adj Close",), "volume": ("Volume",)})


@query(
    """, r AS (SELECT ticker, min(status) AS status, min(promotion_status) AS promotion_status, min(CASE WHEN nation % 2 = 0 THEN 'fresh' END) AS cs FROM registry GROUP BY ticker), l AS (SELECT symbol AS ticker, count(*) AS n, max(date) AS d FROM prices GROUP BY ALL)
SELECT ticker, unnest(['registry', 'registry', 'coverage', 'availability', 'window']) AS section, unnest(['status', 'promotion_status', 'coverage_status', 'price_rows', 'last_date']) AS key, unnest([status, promotion_status, cs, coalesce(n, 0)::VARCHAR, d::VARCHAR]) AS value,
concat_ws(',', CASE WHEN cs IS NULL THEN 'coverage_row_missing' END, CASE WHEN n IS NULL THEN 'market_prices_missing' END, CASE WHEN d < DATE '2001-10-20' THEN 'market_prices_stale' END) AS warnings FROM r LEFT JOIN l USING (ticker)""",
    a.PRICES, a.REGISTRY,
)
def mk17_snapshot_report(spark, sf):
    rows = a.registry(spark, sf)
    return registry.snapshot_report(rows.select("ticker", "status", "promotion_status"), rows.where("nation % 2 = 0").select("ticker", F.lit("fresh").alias("coverage_status")), a.prices(spark, sf), "2001-10-20")
