"""Registered queries of published rows, canonical JSON, and mappings with retries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import casts
from ..operators import events, mapping, observations, published
from ..sources import adapters as a
from .more_queries import _payloads
from .queries import NOW, query

#: Orders with update texts of which each fourth is absent, and their time with the one that stands for them.
STAMPED = f"o AS (SELECT *, o_orderdate::DATE AS d, coalesce(CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate END, TIMESTAMP '{NOW}')::VARCHAR AS at_ FROM orders)"


def _orders(spark, sf, *columns):
    o = a.spread(a.table(spark, sf, "orders"), "o_orderkey").withColumns({"k": F.col("o_orderkey"), "c": F.col("o_custkey"), "d": F.date_format("o_orderdate", "yyyy-MM-dd")})
    return o.withColumn("at_", F.when(F.col("k") % 4 != 0, F.col("o_orderdate").cast("string"))).selectExpr(*columns)


def _published(f, rows: DataFrame) -> DataFrame:
    """The operator's rows with times as texts."""
    out = f(rows, F.lit(NOW).cast("timestamp"))
    return out.select(*(F.col(c).cast("string").alias(c) if t == "timestamp" else F.col(c) for c, t in out.dtypes))


@query(
    """SELECT 'C' || o_custkey AS symbol, d AS price_date, o_totalprice AS open, NULL::DOUBLE AS high, NULL::DOUBLE AS low, o_totalprice AS close, CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice / 2 END AS adj_close,
CASE WHEN o_orderkey % 9 > 0 THEN o_custkey + 1 END::BIGINT AS volume, at_ AS source_updated_at, at_ AS ingested_at FROM o WHERE o_orderkey % 11 > 1 AND o_orderkey % 13 > 0""",
    STAMPED,
)
def sk7_prices_payload(spark, sf):
    rows = _orders(spark, sf, "concat(' c', c) AS ticker", "if(k % 13 = 0, 'bad', d) AS date", "cast(o_totalprice AS string) AS open", "decode(k % 11, 0, 'n/a', 1, 'nan', cast(o_totalprice AS string)) AS close", "if(k % 5 = 0, double('NaN'), o_totalprice / 2) AS adj_close", "if(k % 9 > 0, concat(c + 1, '.75'), '') AS volume", "at_ AS fetched_at")
    return _published(published.prices, rows)


@query(
    """SELECT 'k' || (o_custkey % 40) AS series_key, 'p' || o_orderkey AS source_provider, o_orderpriority AS source_code, 'monthly' AS frequency, o_orderkey % 3 = 0 AS required_by_default, o_orderkey % 3 = 1 AS optional,
(o_orderkey % 6)::BIGINT AS staleness_max_bdays, CASE WHEN o_orderkey % 2 = 0 THEN 'cal' END AS release_calendar_source, NULL::VARCHAR AS description, at_ AS updated_at FROM o WHERE o_orderkey % 6 > 0
QUALIFY row_number() OVER (PARTITION BY o_custkey % 40 ORDER BY at_ DESC, 'p' || o_orderkey DESC) = 1""",
    STAMPED,
)
def sk7_series_catalog_payload(spark, sf):
    rows = _orders(spark, sf, "concat(' k', c % 40) AS series_key", "concat('p', k) AS source_provider", "o_orderpriority AS source_code", "'monthly ' AS frequency", "decode(k % 3, 0, 'true', 1, 'no') AS required_by_default", "k % 3 = 1 AS optional", "if(k % 6 = 0, 'none', cast(k % 6 AS string)) AS staleness_max_bdays", "if(k % 2 = 0, 'cal', '<NA>') AS release_calendar_source", "at_ AS updated_at")
    return _published(published.series_catalog, rows)


@query(
    f"""SELECT 'k' || (o_custkey % 40) AS series_key, year(d)::VARCHAR AS observation_period, d AS observation_date, 'yearly' AS frequency, o_totalprice AS value, 'p' AS source_provider, NULL::VARCHAR AS source_code, o_orderdate::VARCHAR AS release_timestamp_utc,
NULL::VARCHAR AS release_timezone, d AS release_date_local, NULL::VARCHAR AS release_calendar_source, NULL::VARCHAR AS source, at_ AS fetched_at, '{NOW}' AS ingested_at FROM o WHERE o_orderkey % 7 > 0 AND o_custkey % 40 > 0
QUALIFY row_number() OVER (PARTITION BY o_custkey % 40, year(d) ORDER BY at_ DESC, o_totalprice DESC) = 1""",
    STAMPED,
)
def sk7_macro_observations_payload(spark, sf):
    rows = _orders(spark, sf, "if(c % 40 = 0, ' ', concat('k', c % 40)) AS series_key", "substr(d, 1, 4) AS observation_period", "d AS observation_date", "'yearly' AS frequency", "if(k % 7 = 0, 'n/a', cast(o_totalprice AS string)) AS value", "'p' AS source_provider", "cast(o_orderdate AS string) AS release_timestamp_utc", "d AS release_date_local", "at_ AS fetched_at")
    return _published(published.macro_observations, rows)


@query(
    """SELECT d AS as_of_date, 'k' || (o_custkey % 40) AS series_key, CASE WHEN o_orderkey % 7 > 0 THEN o_totalprice END AS value, o_orderdate::VARCHAR AS source_updated_at, CASE WHEN o_orderkey % 2 = 0 THEN 'release_timed' ELSE 'period' END AS alignment_mode,
o_orderkey % 3 = 0 AS is_stale, CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 5 END::BIGINT AS staleness_bdays, at_ AS ingested_at FROM o WHERE o_orderkey % 11 > 0
QUALIFY row_number() OVER (PARTITION BY d, o_custkey % 40 ORDER BY at_ DESC, CASE WHEN o_orderkey % 7 > 0 THEN o_totalprice END DESC NULLS LAST) = 1""",
    STAMPED,
)
def sk7_macro_daily_payload(spark, sf):
    rows = _orders(spark, sf, "d AS as_of_date", "concat('k', c % 40) AS series_key", "if(k % 7 > 0, o_totalprice, double('NaN')) AS value", "if(k % 11 > 0, substr(d, 1, 7), 'nan') AS source_observation_period", "d AS source_observation_date", "o_orderdate AS available_at_utc", "if(k % 3 > 0, cast(k % 5 AS string), '') AS staleness_bdays", "if(k % 3 = 0, 'yes', null) AS is_stale", "if(k % 2 = 0, null, ' period') AS alignment_mode", "at_ AS ingested_at", "k AS seq")
    return _published(published.cached_macro_daily, rows)


@query(
    """SELECT 'X' || (o_custkey % 5) AS exchange_mic, d AS session_date, o_orderkey % 3 = 0 AS is_half_day, true AS is_trading_day, NULL::VARCHAR AS currency, 'exchange_calendars' AS source, at_ AS source_updated_at, at_ AS ingested_at FROM o WHERE o_custkey % 5 > 0
QUALIFY row_number() OVER (PARTITION BY o_custkey % 5, d ORDER BY at_ DESC, o_orderkey % 3 = 0 DESC) = 1""",
    STAMPED,
)
def sk7_trading_calendar_payload(spark, sf):
    return _published(published.cached_calendar, _orders(spark, sf, "if(c % 5 = 0, 'none', concat(' x', c % 5)) AS exchange_mic", "d AS session_date", "if(k % 3 = 0, '1', null) AS is_half_day", "at_ AS ingested_at"))


@query(
    f"""SELECT 'C' || o_custkey AS ticker, 'about ' || o_orderkey AS description, 'about ' || o_orderkey AS long_business_summary, o_orderpriority AS etf_category, NULL::VARCHAR AS fund_family, (o_orderkey % 9) / 100 AS expense_ratio, d AS inception_date, NULL::VARCHAR AS legal_type,
CASE WHEN o_orderkey % 2 = 0 THEN 1.5 END::DOUBLE AS beta, NULL::DOUBLE AS beta_3y, 'data_ops' AS source, at_ AS fetched_at, at_ AS updated_at FROM o QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY at_ DESC, 'about ' || o_orderkey DESC) = 1""",
    STAMPED,
)
def sk7_profiles_payload(spark, sf):
    rows = _orders(spark, sf, "concat('c', c) AS symbol", "concat('about ', k) AS long_business_summary", "o_orderpriority AS category_name", "(k % 9) / 100 AS fees_expense_ratio", "d AS fund_inception_date", "if(k % 2 = 0, '1.5', 'x') AS beta", "at_ AS updated_at")
    return _published(published.profiles, rows)


@query(
    f"""SELECT 'E' || (o_custkey % 30) AS etf_ticker, 'H' || (o_custkey % 400) AS holding_symbol, NULL::VARCHAR AS holding_name, country AS holding_country, coalesce('figi:' || figi, CASE WHEN mic IS NOT NULL THEN 'isin:' || isin || ':mic:' || mic ELSE 'isin:' || isin END, 'provider:' || own, 'mic:' || mic || ':symbol:' || h, 'country:' || country || ':symbol:' || h, 'symbol:' || h) AS holding_listing_key,
NULL::VARCHAR AS holding_exchange, mic AS holding_exchange_mic, isin AS holding_isin, figi AS holding_figi, own AS provider_symbol, o_totalprice AS weight, make_date(year(d), 1, 1) AS as_of, 's' AS source, at_ AS fetched_at, at_ AS updated_at
FROM (SELECT *, 'H' || (o_custkey % 400) AS h, CASE WHEN o_custkey % 7 = 0 THEN 'BBG' || (o_custkey % 400) END AS figi, CASE WHEN o_custkey % 7 < 3 THEN 'US' || (o_custkey % 400) END AS isin, CASE WHEN o_custkey % 7 IN (1, 4) THEN 'XNAS' END AS mic, CASE WHEN o_custkey % 7 = 3 THEN h || '.DE' END AS own, CASE WHEN o_custkey % 7 = 5 THEN 'DE' END AS country FROM o)
QUALIFY row_number() OVER (PARTITION BY o_custkey % 30, holding_listing_key, year(d) ORDER BY at_ DESC, o_totalprice DESC) = 1""",
    STAMPED,
)
def sk7_fund_holdings_payload(spark, sf):
    n = "c % 400"
    rows = _orders(spark, sf, "concat('e', c % 30) AS etf_ticker", f"concat(' h', {n}) AS holding_symbol", "if(c % 7 = 5, 'DE', null) AS holding_country", "if(c % 7 IN (1, 4), 'XNAS', 'nan') AS source_exchange_mic", f"if(c % 7 < 3, concat('US', {n}), null) AS source_isin", f"if(c % 7 = 0, concat('BBG', {n}), '') AS holding_figi", f"if(c % 7 = 3, concat('H', {n}, '.DE'), null) AS onboard_symbol", "cast(o_totalprice AS string) AS weight", "concat(substr(d, 1, 4), '-01-01') AS as_of", "'s' AS provider", "at_ AS updated_at")
    return _published(published.fund_holdings, rows)


@query(
    """SELECT 'E' || (o_custkey % 30) AS etf_ticker, o_orderpriority AS sector, o_totalprice AS weight, make_date(year(d), 1, 1) AS as_of, 's' AS source, at_ AS fetched_at, at_ AS updated_at FROM o WHERE o_orderkey % 6 > 0
QUALIFY row_number() OVER (PARTITION BY o_custkey % 30, o_orderpriority, year(d) ORDER BY at_ DESC, o_totalprice DESC) = 1""",
    STAMPED,
)
def sk7_sector_weights_payload(spark, sf):
    rows = _orders(spark, sf, "concat('e', c % 30) AS ticker", "o_orderpriority AS sector", "if(k % 6 = 0, '-', cast(o_totalprice AS string)) AS weight", "concat(substr(d, 1, 4), '-01-01') AS as_of", "'s' AS source", "at_ AS updated_at")
    return _published(published.sector_weights, rows)


# --- canonical JSON

_PLAIN = "regexp_replace({}::VARCHAR, '\\.0$', '')"


@query(
    f"""SELECT DISTINCT sha256('{{"action":"' || action || '","amount":' || coalesce({_PLAIN.format("amount")}, 'null') || ',"ex_date":"' || ex_date || '","factor":' || coalesce({_PLAIN.format("factor")}, 'null') || ',"provider":"p","symbol":"' || symbol || '"}}') AS observation_id, symbol, action, ex_date
FROM (SELECT 'C' || o_custkey AS symbol, CASE WHEN o_orderkey % 10 = 0 THEN 'split' ELSE 'dividend' END AS action, o_orderdate::DATE AS ex_date, CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS amount, CASE WHEN o_orderkey % 10 = 0 THEN (o_custkey % 4 + 1) / 2 END AS factor FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 20 <> 1)"""
)
def sc24_observation_ids(spark, sf):
    return observations.corporate_actions(_payloads(a.table(spark, sf, "orders"))).select("observation_id", "symbol", "action", "ex_date")


@query("""SELECT o_orderkey AS id, sha256('{"a":{"c":"' || o_orderpriority || '","n":[' || o_custkey || ',null,true]},"k":' || o_orderkey || ',"s":"x: 1.0, \\"y\\""}') AS forward, forward AS reordered FROM orders""")
def sc24_reordered_payloads(spark, sf):
    """The hash of a payload and of the same with keys in another order, spaces and other spellings of its numbers."""
    forward = """concat('{"a":{"c":"', o_orderpriority, '","n":[', c, ',null,true]},"k":', k, ',"s":"x: 1.0, \\\\"y\\\\""}')"""
    reordered = """concat('{ "s": "x: 1.0, \\\\"y\\\\"", "k": ', k, '.0, "a": {"n": [', c, '.00, null, true], "c":"', o_orderpriority, '"}}')"""
    rows = _orders(spark, sf, "k AS id", f"{forward} AS f", f"{reordered} AS r")
    return rows.select("id", casts.payload_hash(F.col("f")).alias("forward"), casts.payload_hash(F.col("r")).alias("reordered"))


# --- filings


@query(
    """SELECT symbol, cik, acc AS accession_number, d AS filing_date, doc AS primary_document, url AS filing_url, more AS more_files, sha256('{"acceptance_datetime":"' || d || 'T00:00:00","accession_number":"' || acc || '","cik":"' || cik || '","filing_date":"' || d || '","filing_url":' || coalesce('"' || url || '"', 'null')
 || ',"form_type":"' || o_orderpriority || '","primary_doc_description":null,"primary_document":' || coalesce('"' || doc || '"', 'null') || ',"provider":"sec_edgar","report_date":null,"symbol":"' || symbol || '"}') AS observation_hash
FROM (SELECT *, 'https://www.sec.gov/Archives/edgar/data/' || o_custkey || '/' || replace(acc, '-', '') || '/' || doc AS url FROM (SELECT *, 'C' || o_custkey AS symbol, lpad(o_custkey::VARCHAR, 10, '0') AS cik, '00-' || o_orderkey AS acc, o_orderdate::DATE AS d, CASE WHEN o_orderkey % 3 > 0 THEN 'd' || o_orderkey || '.htm' END AS doc, o_orderkey % 5 = 0 AS more FROM orders WHERE o_orderstatus <> 'P'))"""
)
def ob3_filing_observations(spark, sf):
    """Payloads as lists and as arrays, of which that of documents is absent or empty at times; each comes twice."""
    document, files = "if(k % 3 > 0, concat('d', k, '.htm'), null)", "if(k % 5 = 0, '[{\"name\":\"older\"}]', '[]')"
    listed = f"to_json(array(named_struct('accessionNumber', concat('00-', k), 'form', o_orderpriority, 'filingDate', d, 'acceptanceDateTime', d, 'primaryDocument', {document}), named_struct('accessionNumber', '', 'form', 'x', 'filingDate', d, 'acceptanceDateTime', d, 'primaryDocument', 'x')))"
    arrays = f"to_json(named_struct('accessionNumber', array(concat('00-', k), concat('01-', k)), 'form', array(o_orderpriority), 'filingDate', array(d), 'acceptanceDateTime', array(d), 'primaryDocument', if(k % 3 > 0, array({document}), null)))"
    payload = f"concat('{{\"filings\":{{\"recent\":', if(k % 2 = 0, {listed}, {arrays}), ',\"files\":', {files}, '}}}}') AS raw_payload"
    rows = _orders(spark, sf, "concat('c', c) AS symbol", "cast(c AS string) AS cik", "'2024-01-01' AS known_at", "if(o_orderstatus = 'P', 'error', 'success') AS status", payload)
    return observations.filing_observations(rows.unionAll(rows)).select("symbol", "cik", "accession_number", "filing_date", "primary_document", "filing_url", "more_files", "observation_hash")


# --- mappings

_JSON = """'{' || coalesce('"currency":"' || cur || '",', '') || CASE WHEN market IS NULL THEN coalesce('"exchCode":"' || code || '",', '') ELSE '' END || '"idType":"TICKER","idValue":"' || ticker || '"' || coalesce(',"micCode":"' || market || '"', '') || '}'"""
REQUESTS = f"""listed AS (SELECT s_suppkey AS k, CASE k % 7 WHEN 0 THEN k || '.KS' WHEN 1 THEN k || '.KQ' WHEN 2 THEN '00' || k || '.SZ' WHEN 3 THEN '0' || k || '.hk' WHEN 4 THEN 'no-' || k || '.CO' WHEN 5 THEN 'q' || k ELSE 'q' || k || '.DE' END AS symbol FROM supplier),
asked AS (SELECT symbol, k, 0 AS attempt, CASE k % 7 WHEN 0 THEN k || '' WHEN 1 THEN k || '' WHEN 2 THEN '00' || k WHEN 3 THEN k || '' WHEN 4 THEN 'NO' || k ELSE 'Q' || k END AS ticker, CASE k % 7 WHEN 0 THEN 'XKRX' WHEN 1 THEN 'XKOS' WHEN 2 THEN 'XSHE' WHEN 6 THEN 'XETR' END AS market,
 CASE k % 7 WHEN 3 THEN 'HK' WHEN 4 THEN 'DC' WHEN 5 THEN 'US' END AS code, CASE WHEN k % 2 = 0 THEN 'USD' END AS cur FROM listed
 UNION ALL SELECT symbol, k, 1, k || '', CASE k % 7 WHEN 0 THEN 'XKOS' WHEN 1 THEN 'XKRX' ELSE 'XSHE' END, NULL, CASE WHEN k % 2 = 0 THEN 'USD' END FROM listed WHERE k % 7 < 3),
variants AS (SELECT symbol, attempt, {_JSON} AS payload, sha256(payload) AS request_hash FROM asked)"""


def _variants(spark, sf):
    k = F.col("s_suppkey")
    forms = ("concat(s_suppkey, '.KS')", "concat(s_suppkey, '.KQ')", "concat('00', s_suppkey, '.SZ')", "concat('0', s_suppkey, '.hk')", "concat('no-', s_suppkey, '.CO')", "concat('q', s_suppkey)")
    symbol = F.coalesce(*(F.when(k % 7 == i, F.expr(f)) for i, f in enumerate(forms)), F.expr("concat('q', s_suppkey, '.DE')"))
    rows = a.table(spark, sf, "supplier").select(symbol.alias("symbol"), F.lit(None).cast("string").alias("provider_symbol"), F.when(k % 7 == 5, "nyse").alias("exchange"), F.when(k % 7 == 6, " xetr").when(k % 7 == 5, "XXXX").alias("exchange_mic"), F.lit(None).cast("string").alias("country"), F.when(k % 2 == 0, "usd").alias("currency"))
    return mapping.request_variants(rows)


@query("SELECT * FROM variants", REQUESTS)
def sc36_request_variants(spark, sf):
    return _variants(spark, sf)


@query(
    """, answered AS (SELECT *, ('0x' || substr(request_hash, 1, 2))::INT % 5 AS r FROM variants), known AS (SELECT *, CASE WHEN r < 2 THEN 'not_found' WHEN r = 2 THEN 'success' WHEN r = 3 THEN 'ambiguous' ELSE 'error' END AS status,
CASE r WHEN 0 THEN 'no_answer' WHEN 1 THEN 'No identifier found.' WHEN 3 THEN 'multiple_openfigi_matches' WHEN 4 THEN 'Too many requests' END AS error_message, CASE WHEN r IN (2, 3) THEN upper('bbg' || substr(request_hash, 1, 8)) END AS figi FROM answered)
SELECT symbol, attempt, request_hash, status, error_message, figi, count(*) OVER (PARTITION BY symbol) AS n_tried FROM known QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY status = 'not_found', attempt) = 1""",
    REQUESTS,
)
def sc36_settled_mappings(spark, sf):
    variants = _variants(spark, sf)
    r = F.conv(F.substring("request_hash", 1, 2), 16, 10).cast("int") % 5
    item = F.to_json(F.struct(F.concat(F.lit("bbg"), F.substring("request_hash", 1, 8)).alias("figi")))
    data = F.when(r == 2, F.concat(F.lit('{"data":['), item, F.lit("]}"))).when(r == 3, F.concat(F.lit('{"data":['), item, F.lit(","), item, F.lit("]}")))
    payload = F.when(r == 1, '{"error":"No identifier found."}').when(r == 4, '{"error":"Too many requests"}').otherwise(data)
    answers = variants.where(r > 0).select("request_hash", payload.alias("raw_payload"), F.lit(1).alias("fetched_at"))
    older = answers.select("request_hash", F.lit("<html>").alias("raw_payload"), F.lit(0).alias("fetched_at"))
    out = mapping.settled_mappings(variants, answers.unionAll(older))
    return out.select("symbol", "attempt", "request_hash", "status", "error_message", "figi", F.size("tried").cast("long").alias("n_tried"))


@query(
    """SELECT 'S' || s_suppkey AS symbol, 'success' AS status, NULL::VARCHAR AS error_message, 'F' || s_suppkey AS figi, 'CF' AS composite_figi, 'SC' AS share_class_figi, NULL::VARCHAR AS isin, 'L' || s_suppkey AS lei, CASE WHEN s_suppkey % 2 = 0 THEN 'ENT' ELSE 'ISS' END AS legal_entity_id,
'T' || s_suppkey AS ticker, s_name AS name, 'US' AS exchange, 'XNAS' AS exchange_mic, 'ORD' AS country, 'USD' AS currency, CASE WHEN s_suppkey % 3 = 0 THEN 'IE' ELSE 'DE' END AS home_country, 'COMMON' AS security_type FROM supplier"""
)
def ob12_mapping_fields(spark, sf):
    k = F.col("s_suppkey")
    given = {
        "figi": F.concat(F.lit("f"), k), "compositeFIGI": F.lit("cf"), "shareClassFigi": F.lit("sc"), "LEI": F.concat(F.lit("l"), k), "entityId": F.when(k % 2 == 0, "ent"), "issuerFigi": F.lit("iss"), "ticker": F.concat(F.lit("t"), k), "securityDescription": F.col("s_name"), "exchange": F.lit("us"), "exchangeMic": F.lit("xnas"),
        "marketSecDes": F.lit("ord"), "currency": F.lit("usd"), "homeCountry": F.when(k % 3 == 0, "ie").otherwise(""), "domicileCountry": F.lit("de"), "securityType2": F.lit("common"), "securityType": F.lit("other"),
    }
    item = F.to_json(F.struct(*(v.alias(c) for c, v in given.items())))
    return events.security_mappings(a.table(spark, sf, "supplier").select(F.concat(F.lit("S"), k).alias("symbol"), F.concat(F.lit('{"data":['), item, F.lit("]}")).alias("raw_payload")))
