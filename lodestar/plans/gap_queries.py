"""Registered queries of countries, classes, notes, payloads, home countries and parity.

The tables hold few of the texts that these rules are about, so raw texts are dealt to the tables' rows by key; the SQL gets the same
raw texts and computes the rule from them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import classify, geography, symbols
from ..operators import audits, chain, health, macro, observations, payloads, reconcile
from ..sources import adapters as a
from .queries import AS_OF, query


def pick(values, key: str) -> Column:
    """The raw text that a row's key is dealt."""
    return F.element_at(F.array(*(F.lit(v) for v in values)), (F.expr(key) % len(values) + 1).cast("int"))


def quoted(v) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


def picked(values, key: str) -> str:
    return f"(list_extract([{', '.join(map(quoted, values))}], (({key}) % {len(values)} + 1)::INT))"


def values(pairs) -> str:
    return ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in pairs)


PLACES = (
    "United States", "usa", "U.S.A.", "Germany", "germany ", "Korea, Republic of", "South Korea", "UK", "Great Britain", "Hong Kong SAR", "Europe", "Asia-Pacific", "nan", None, "", "de", "Cayman Islands, The",
    "Atlantis", "Türkiye", "TURKEY", "Czech  Republic", "jp", "Brazil", "Global", "ZZ", "United Arab Emirates", "NL", "Canada", "New-Zealand", "China",
)
LISTED = ("ABC", "0700.HK", "700 HK", "VOD.L", "SAP.DE", "6758 JP", "BHP.AX", "brk/b", "NYAX IM", "RELIANCE.NS", "7203.T", "ASML.AS", "AIR.PA", "XX.ZZ", "600519.SS", "NOVO.CO", "EDP.LS", "000001.SZ", "TCS.BO")
COUNTRIES_SQL = f"""codes AS (SELECT * FROM (VALUES {values(geography.COUNTRY_CODES.items())}) t(k, v)), zones AS (SELECT * FROM (VALUES {values((c, r) for r, own in geography.REGIONS.items() for c in own)}) t(k, v)),
suffixes AS (SELECT * FROM (VALUES {values(symbols.SUFFIX_COUNTRY.items())}) t(k, v))"""
_NONE_SQL = ", ".join(map(quoted, geography.NO_COUNTRY))


def token_sql(c: str) -> str:
    return f"coalesce(trim(regexp_replace(upper(trim({c})), '[^A-Z0-9]+', ' ', 'g')), '')"


def code_sql(c: str) -> str:
    return f"(CASE WHEN {token_sql(c)} IN ({_NONE_SQL}) THEN '' ELSE coalesce((SELECT v FROM codes WHERE k = {token_sql(c)}), {token_sql(c)}) END)"


@query(
    f"""SELECT p_partkey, raw, country, coalesce((SELECT v FROM zones WHERE k = country), 'OTHER') AS region
FROM (SELECT p_partkey, raw, {code_sql("raw")} AS country FROM (SELECT p_partkey, {picked(PLACES, "p_partkey")} AS raw FROM part))""",
    COUNTRIES_SQL,
)
def sc5_countries(spark, sf):
    rows = a.table(spark, sf, "part").select("p_partkey", pick(PLACES, "p_partkey").alias("raw"))
    return rows.select("p_partkey", "raw", geography.country_code(F.col("raw")).alias("country"), geography.region_of(F.col("raw")).alias("region"))


@query(
    f"""SELECT p_partkey, CASE WHEN given = 'US' AND suffix IS NOT NULL THEN suffix ELSE coalesce(nullif(given, ''), suffix, 'US') END AS country
FROM (SELECT p_partkey, {code_sql("raw")} AS given, (SELECT v FROM suffixes WHERE k = regexp_extract(listed, '\\.([A-Z]+)$', 1)) AS suffix
FROM (SELECT p_partkey, {picked(PLACES, "p_partkey")} AS raw, {picked([x for x in LISTED if " " not in x], "p_partkey + p_size")} AS listed FROM part))""",
    COUNTRIES_SQL,
)
def sc6_listing_countries(spark, sf):
    plain = [x for x in LISTED if " " not in x]
    country = geography.listing_country(pick(PLACES, "p_partkey"), pick(plain, "p_partkey + p_size"))
    return a.table(spark, sf, "part").select("p_partkey", country.alias("country"))


@query(
    f"""SELECT p_partkey, s AS symbol, CASE {" ".join(f"WHEN ends_with(upper(trim(s)), '{k}') THEN '{v}'" for k, v in geography.MARKETS.items())} ELSE 'XNYS' END AS mic
FROM (SELECT p_partkey, {picked(LISTED, "p_partkey")} AS s FROM part)"""
)
def sc7_markets(spark, sf):
    symbol = pick(LISTED, "p_partkey")
    return a.table(spark, sf, "part").select("p_partkey", symbol.alias("symbol"), geography.market_of(symbol).alias("mic"))


HELD = ("AAPL", "USD", "cash", "NAN", None, "-USD CASH-", "EUR CURNCY", "123456A", "700", "0700.HK", "CASH_USD", "JPY CASH", "12.5", "XTSLA", "BRK.B", "gbp")
TITLES = ("Apple Inc", "CASH", "US Dollar", "E-mini future", "Treasury Bill 0 1/1", "Total return swap", None, "Rights issue co", "Sony Group", "CSH FND treasury sl agency", "Receivables trust", "Optional Inc")
KINDS = ("Equity", "stock", None, "", "Bond", "Cash", "EQUITY ")


@query(
    f"""SELECT p_partkey, (k = '' OR k IN ('EQUITY', 'STOCK')) AND t NOT IN ('', {", ".join(map(quoted, classify.NO_SYMBOL + classify.CURRENCIES))}) AND NOT regexp_full_match(t, '[0-9]{{4,}}[A-Z]') AND NOT regexp_full_match(t, '-?[A-Z]{{3}}\\s*CASH-?')
 AND NOT regexp_full_match(t, '[A-Z]{{3}}\\s*(CURNCY|CURRENCY)') AND n NOT IN ({", ".join(map(quoted, classify.CASH_NAMES))}) AND NOT ({" OR ".join(f"contains(n, {quoted(m)})" for m in classify.NOT_EQUITY)})
 AND (regexp_matches(t, '[A-Z]') OR (k IN ('EQUITY', 'STOCK') AND regexp_full_match(t, '[0-9.\\-]+'))) AS equity_like
FROM (SELECT p_partkey, upper(trim(coalesce({picked(HELD, "p_partkey")}, ''))) AS t, upper(trim(coalesce({picked(TITLES, "p_partkey + p_size")}, ''))) AS n, upper(trim(coalesce({picked(KINDS, "p_size")}, ''))) AS k FROM part)"""
)
def sc18_equity_like(spark, sf):
    like = classify.equity_like(pick(HELD, "p_partkey"), pick(TITLES, "p_partkey + p_size"), pick(KINDS, "p_size"))
    return a.table(spark, sf, "part").select("p_partkey", like.alias("equity_like"))


TYPED = ("AAPL", "SPY", "EWJ", "EWXX", "^GSPC", "VOD.L", "XX.ZZ", "TSM", "MCHI", "BABA")
HINTS = (None, "ETF", "adr", "common", "", "equity", None)
QUOTES = (None, "ETF", "EQUITY", "MUTUAL FUND", "INDEX", "ADR", "common stock", None, "")
LONG = (None, "Alibaba Group ADR", "iShares MSCI Japan", "Apple Inc.", "Country fund of Chile", "S&P 500 Index", "Vanguard ETF")
PLACED = (None, "NYSE", "")
FLAGS = (None, "false", "true", "0", "yes", "")


def instrument_types(spark, sf):
    """p_partkey, type and source of parts that play listings."""
    said = F.map_from_arrays(F.array(F.lit("quoteType"), F.lit("longName"), F.lit("isAdr")), F.array(pick(QUOTES, "p_partkey + p_size"), pick(LONG, "p_partkey div 3"), pick(FLAGS, "p_partkey div 7")))
    rows = a.table(spark, sf, "part").select("p_partkey", "p_size")
    typed = classify.instrument_types(rows, pick(TYPED, "p_partkey"), pick(HINTS, "p_size"), pick(PLACED, "p_partkey div 2"), said, {"TSM": "adr", "SPY": "etf"}, pick(TYPED, "p_partkey div 11"))
    return typed.select("p_partkey", "type", "source")


@query(
    f"""SELECT p_partkey, coalesce(forced, hint, told, guess, 'unknown') AS type, CASE WHEN forced IS NOT NULL THEN 'explicit_override' WHEN hint IS NOT NULL THEN 'input_hint' WHEN told IS NOT NULL THEN 'provider_metadata' WHEN guess IS NOT NULL THEN 'symbol_heuristic' ELSE 'fallback_unknown' END AS source FROM (
SELECT p_partkey, CASE WHEN s = 'TSM' THEN 'adr' WHEN s = 'SPY' THEN 'etf' WHEN entered = 'TSM' THEN 'adr' WHEN entered = 'SPY' THEN 'etf' END AS forced, CASE WHEN lower(trim(h)) IN ({", ".join(map(quoted, classify.INSTRUMENT_TYPES))}) THEN lower(trim(h)) END AS hint,
 CASE WHEN q = 'INDEX' THEN 'index_proxy' WHEN q IN ('ETF', 'MUTUALFUND', 'FUND') THEN fund WHEN q = 'ADR' THEN 'adr' WHEN q IN ('EQUITY', 'COMMONSTOCK', 'STOCK') THEN CASE WHEN flag IN ('true', 'yes') OR contains(w, ' ADR') OR contains(w, ' ADS') THEN 'adr' ELSE 'equity' END
  WHEN contains(w, ' ETF') OR contains(w, ' FUND') THEN fund WHEN contains(w, ' INDEX') AND s IN ({", ".join(map(quoted, classify.INDEX_PROXIES))}) THEN 'index_proxy' WHEN contains(w, ' ADR') OR contains(w, ' ADS') THEN 'adr' END AS told,
 CASE WHEN s IN ({", ".join(map(quoted, classify.INDEX_PROXIES))}) OR s LIKE '^%' THEN 'index_proxy' WHEN s IN ({", ".join(map(quoted, classify.COUNTRY_FUNDS))}) OR (s LIKE 'EW%' AND length(s) <= 4) THEN 'country_fund'
  WHEN split_part(s, '.', 2) IN ({", ".join(map(quoted, sorted(set(symbols.EXCHANGE_SUFFIX.values()))))}) THEN 'equity' WHEN trim(coalesce(x, '')) <> '' THEN 'equity' END AS guess
FROM (SELECT *, CASE WHEN s IN ({", ".join(map(quoted, classify.COUNTRY_FUNDS))}) OR contains(w, ' MSCI ') OR contains(w, ' COUNTRY ') THEN 'country_fund' ELSE 'etf' END AS fund FROM (
 SELECT p_partkey, {picked(TYPED, "p_partkey")} AS s, {picked(HINTS, "p_size")} AS h, replace(upper(trim(coalesce({picked(QUOTES, "p_partkey + p_size")}, ''))), ' ', '') AS q, ' ' || upper(coalesce({picked(LONG, "p_partkey // 3")}, '')) || ' ' AS w, {picked(PLACED, "p_partkey // 2")} AS x, {picked(FLAGS, "p_partkey // 7")} AS flag, {picked(TYPED, "p_partkey // 11")} AS entered FROM part)))"""
)
def sc32_instrument_types(spark, sf):
    return instrument_types(spark, sf)


SOURCES = ("ALFRED vintage", "fred_release_calendar_v2", "BLS official page", "inferred_lag", "manual entry", "lapse_backfill", "canceled 2025", None, "other", " Missing row ")


@query(
    f"""SELECT p_partkey, CASE WHEN starts_with(s, 'alfred') THEN 'ALFRED-native' WHEN starts_with(s, 'fred_release_calendar') OR contains(s, 'official') THEN 'official release calendar' WHEN contains(s, 'inferred') THEN 'inferred'
 WHEN contains(s, 'manual') OR contains(s, 'fixture') OR contains(s, 'lapse') THEN 'fixture/manual exception' WHEN contains(s, 'missing') OR contains(s, 'canceled') OR contains(s, 'cancelled') THEN 'canceled/missing' ELSE 'unknown' END AS provenance
FROM (SELECT p_partkey, lower(trim(coalesce({picked(SOURCES, "p_partkey")}, ''))) AS s FROM part)"""
)
def sc33_provenance(spark, sf):
    return a.table(spark, sf, "part").select("p_partkey", classify.provenance(pick(SOURCES, "p_partkey")).alias("provenance"))


NOTES = ('{"b": 2, "c": "x y"}', "wave=3; themes=ai,fintech", "plain text", None, " null ", "[1, 2]", "{broken", "k = v=w;;x", '{"wave": "1"}')


@query(
    f"""SELECT event_id, CASE WHEN t IS NULL OR upper(t) IN ('', 'NONE', 'NULL', 'NAN') THEN '' WHEN json_valid(t) AND t[1] IN ('{{', '[') THEN json(t)::VARCHAR ELSE t END AS notes,
 CASE WHEN json_valid(t) AND t[1] = '{{' THEN t ->> 'wave' WHEN upper(t) IN ('', 'NONE', 'NULL', 'NAN') THEN NULL ELSE nullif(trim(regexp_extract(t, '(^|;)\\s*wave\\s*=([^;]*)', 2)), '') END AS wave, CASE WHEN json_valid(t) AND t[1] = '{{' THEN t ->> 'k' WHEN regexp_matches(t, '(^|;)\\s*k\\s*=') THEN trim(regexp_extract(t, '(^|;)\\s*k\\s*=([^;]*)', 2)) END AS k
FROM (SELECT event_id, trim(CASE WHEN event_id % 2 = 0 THEN props ELSE {picked(NOTES, "event_id // 2")} END) AS t FROM events)"""
)
def sc28_notes(spark, sf):
    raw = F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(pick(NOTES, "event_id div 2"))
    rows = a.table(spark, sf, "events").select("event_id", classify.notes_text(raw).alias("notes"), classify.note_fields(raw).alias("m"))
    return rows.select("event_id", "notes", F.try_element_at("m", F.lit("wave")).alias("wave"), F.try_element_at("m", F.lit("k")).alias("k"))


@query(
    """SELECT p_partkey, coalesce(CASE WHEN lower(trim(p_name)) NOT IN ('', 'none', 'nan', 'null') THEN trim(p_name) END, p_brand) AS name,
 CASE WHEN p_size % 3 > 0 THEN p_type END AS sector, CASE WHEN p_size % 3 = 0 THEN p_type END AS industry, CAST(NULL AS VARCHAR) AS description FROM (SELECT p_partkey, p_size, p_type, p_brand, CASE WHEN p_size % 5 = 0 THEN ' None ' ELSE p_name END AS p_name FROM part)"""
)
def sc35_described(spark, sf):
    name = F.when(F.col("p_size") % 5 == 0, " None ").otherwise(F.col("p_name"))
    keys = F.array(F.lit("name"), F.lit("longName"), F.when(F.col("p_size") % 3 > 0, "sectorKey").otherwise("industry_key"))
    rows = a.table(spark, sf, "part").select("p_partkey", F.map_from_arrays(keys, F.array(name, F.col("p_brand"), F.col("p_type"))).alias("m"))
    return rows.select("p_partkey", *(c.alias(n) for n, c in classify.described(F.col("m")).items()))


PERIODS = ("Q3 2020", "annual", None, "nan", "fy-q1", "TTM")


@query(
    f"""SELECT o_orderkey, year(d) AS fiscal_year, coalesce(nullif(regexp_extract(upper(p), 'Q[1-4]'), ''), 'Q' || quarter(d)) AS fiscal_quarter, coalesce(CASE WHEN lower(trim(p)) NOT IN ('', 'nan', 'none', 'nat', '<na>') THEN lower(trim(p)) END, 'unknown') AS period_type
FROM (SELECT o_orderkey, o_orderdate::DATE AS d, {picked(PERIODS, "o_orderkey")} AS p FROM orders)"""
)
def pf10_fiscal_fields(spark, sf):
    p, end = pick(PERIODS, "o_orderkey"), F.col("o_orderdate").cast("date")
    none = F.lit(None).cast("string")
    return a.table(spark, sf, "orders").select("o_orderkey", classify.fiscal_year(none, end).alias("fiscal_year"), classify.fiscal_quarter(p, end).alias("fiscal_quarter"), classify.period_type(none, p).alias("period_type"))


# --- coverage and readiness

_QUOTES_SQL = "quotes AS (SELECT DISTINCT CASE WHEN p_size > 48 THEN lpad(p_partkey::VARCHAR, 4, '9') || 'A' WHEN p_size = 48 THEN '700.HK' ELSE 'Q' || p_partkey END AS symbol FROM part)"


def _quotes(spark, sf):
    named = F.when(F.col("p_size") > 48, F.concat(F.lpad(F.col("p_partkey").cast("string"), 4, "9"), F.lit("A"))).when(F.col("p_size") == 48, "700.HK").otherwise(F.concat(F.lit("Q"), "p_partkey"))
    return a.table(spark, sf, "part").select(named.alias("symbol")).distinct()


COMPLETE_SQL = f"""complete AS (SELECT ticker, p.d IS NOT NULL AS market_data_available, f.d IS NOT NULL AS fundamentals_available, e.n IS NOT NULL AS earnings_available, p.d AS market_data_last_date, f.d AS fundamentals_last_date, e.d AS next_earnings_date,
 CASE WHEN p.d IS NOT NULL AND f.d IS NOT NULL AND e.n IS NOT NULL THEN 'fresh' WHEN p.d IS NULL AND f.d IS NULL AND e.n IS NULL THEN 'failed_hard' ELSE 'partial' END AS coverage_status,
 CASE WHEN p.d IS NOT NULL AND f.d IS NOT NULL AND e.n IS NOT NULL THEN 'market_fundamentals_earnings_available' ELSE 'missing_' || concat_ws('_', CASE WHEN p.d IS NULL THEN 'market_data' END, CASE WHEN f.d IS NULL THEN 'fundamentals' END, CASE WHEN e.n IS NULL THEN 'earnings' END) END AS reason
FROM (SELECT symbol AS ticker FROM prices UNION SELECT symbol FROM quotes UNION SELECT ticker FROM facts UNION SELECT ticker FROM earnings) u
LEFT JOIN (SELECT symbol AS ticker, max(date) AS d FROM prices GROUP BY ALL) p USING (ticker) LEFT JOIN (SELECT ticker, max(period_end) AS d FROM facts GROUP BY ALL) f USING (ticker)
LEFT JOIN (SELECT ticker, count(*) AS n, min(earnings_date) FILTER (earnings_date >= DATE '{AS_OF}') AS d FROM earnings GROUP BY ALL) e USING (ticker)
WHERE p.d IS NOT NULL OR NOT (regexp_full_match(ticker, '[0-9]{{4,}}[A-Z]') OR ticker = '700.HK'))"""


def _complete(spark, sf):
    return health.complete_coverage(a.prices(spark, sf), _quotes(spark, sf), a.fundamentals(spark, sf), a.earnings(spark, sf), AS_OF)


@query("SELECT * FROM complete", a.PRICES, a.FUNDAMENTALS, a.EARNINGS, _QUOTES_SQL, COMPLETE_SQL)
def cv4_complete_coverage(spark, sf):
    return _complete(spark, sf)


@query(
    """, cover AS (SELECT ticker, balance > 3000 AS market, CASE WHEN balance > 3000 THEN 'fresh' ELSE 'failed_hard' END AS state FROM registry WHERE balance > 1000),
p AS (SELECT symbol AS ticker, count(*) AS n FROM prices GROUP BY ALL), t AS (SELECT symbol AS ticker, count(*) AS n FROM prices WHERE volume > 60 GROUP BY ALL), s AS (SELECT symbol AS ticker, count(*) AS n FROM prices WHERE volume > 80 GROUP BY ALL),
reg AS (SELECT ticker, status, promotion_status FROM registry UNION ALL SELECT ticker, 'active', 'candidate' FROM registry WHERE status = 'rejected' AND balance < -500),
r AS (SELECT ticker, min(status) AS status, bool_or(status = 'active' AND promotion_status LIKE 'validated%') AS av, bool_or(status = 'rejected') AND bool_or(status <> 'rejected') AS both_ FROM reg GROUP BY ALL),
c AS (SELECT ticker, bool_or(market) AS market, max(state) AS state FROM cover GROUP BY ALL),
j AS (SELECT ticker, status, coalesce(av, false) AS av, coalesce(p.n, 0) > 0 AS hp, coalesce(t.n, 0) > 0 AS ht, coalesce(s.n, 0) > 0 AS hs, regexp_full_match(ticker, '[0-9]{6,}[A-Z]') AS ph, market, state, coalesce(both_ AND s.n > 0, false) AS shadow
 FROM r FULL JOIN p USING (ticker) FULL JOIN t USING (ticker) FULL JOIN s USING (ticker) LEFT JOIN c USING (ticker))
SELECT ticker, 'registry_active_validated_without_prices' AS issue_type FROM j WHERE av AND NOT hp UNION ALL SELECT ticker, 'prices_without_technicals' FROM j WHERE hp AND NOT ht UNION ALL SELECT ticker, 'technicals_without_scorecard' FROM j WHERE ht AND NOT hs
UNION ALL SELECT ticker, 'rejected_with_materialized_data' FROM j WHERE status = 'rejected' AND (hp OR ht OR hs) AND NOT shadow UNION ALL SELECT ticker, 'placeholder_like_symbol' FROM j WHERE ph AND NOT (coalesce(status = 'rejected', false) AND NOT hp AND NOT ht AND NOT hs AND market IS NULL AND coalesce(state, '') = '')
UNION ALL SELECT ticker, 'coverage_disagrees_with_materialized_rows' FROM j WHERE market <> hp""",
    a.PRICES, a.REGISTRY,
)
def rd2_issues_with_coverage(spark, sf):
    prices, listed = a.prices(spark, sf), a.registry(spark, sf)
    registry = listed.select("ticker", "status", "promotion_status").unionAll(listed.where("status = 'rejected' AND balance < -500").select("ticker", F.lit("active"), F.lit("candidate")))
    cover = listed.where("balance > 1000").select("ticker", (F.col("balance") > 3000).alias("market_data_available"), F.when(F.col("balance") > 3000, "fresh").otherwise("failed_hard").alias("coverage_status"))
    rows = health.ticker_readiness(registry, prices, prices.where("volume > 60"), prices.where("volume > 80"))
    readiness = rows.select("ticker", F.lit(True).alias("tracked"), (F.col("scorecard_rows") > 0).alias("scorecard_ready"))
    return health.readiness_issues(health.with_coverage(rows, cover, registry, readiness))


# --- macro and parity


@query(
    f"""SELECT series_key, frequency, coalesce(staleness_limit, CASE frequency {" ".join(f"WHEN '{k}' THEN {v}" for k, v in macro.STALE_AFTER.items())} END)::INT AS staleness_max_bdays, CASE series_key {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in macro.CALENDARS.items())} END AS release_calendar_source
FROM (SELECT series_key, staleness_limit, 'daily' AS frequency FROM catalog UNION ALL SELECT * FROM (VALUES {", ".join(f"('{k}', NULL, '{f}')" for k, _, _, f, *_ in macro.SERIES)}))""",
    a.CATALOG,
)
def ma4_series_catalog(spark, sf):
    own = a.catalog(spark, sf).withColumn("staleness_max_bdays", F.col("staleness_limit").cast("int"))
    specs = own.unionByName(macro.known_series(spark), allowMissingColumns=True)
    return macro.series_catalog(specs).select("series_key", "frequency", "staleness_max_bdays", "release_calendar_source")


@query(
    """, s AS (SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m') AS observation_period, min(o_orderdate)::DATE AS scheduled, min(o_orderdate) FILTER (o_orderstatus = 'F')::DATE AS observed FROM orders GROUP BY ALL),
o AS (SELECT strftime(date_trunc('month', l_shipdate), '%Y-%m') AS observation_period, max(l_shipdate)::DATE AS release_date FROM lineitem WHERE month(l_shipdate) = 1 GROUP BY ALL)
SELECT observation_period, coalesce(release_date, scheduled) AS scheduled, CASE WHEN observed IS NOT NULL THEN coalesce(release_date, observed) END AS observed, CASE WHEN release_date IS NOT NULL THEN 'override' ELSE 'calendar' END AS source FROM s LEFT JOIN o USING (observation_period)""",
    "one AS (SELECT 1)",
)
def jn16_release_overrides(spark, sf):
    orders, lines = a.table(spark, sf, "orders"), a.table(spark, sf, "lineitem")
    day = F.col("o_orderdate").cast("date")
    schedule = orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("observation_period")).agg(F.min(day).alias("scheduled"), F.min(F.when(F.col("o_orderstatus") == "F", day)).alias("observed"), F.lit("calendar").alias("source"))
    overrides = lines.where("month(l_shipdate) = 1").groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("observation_period")).agg(F.max(F.col("l_shipdate").cast("date")).alias("release_date"))
    return macro.with_overrides(schedule, overrides, "override")


_TIMES_SQL = "own AS (SELECT user_id, ts::DATE AS d, max(ts) AS available_at FROM events GROUP BY ALL), old AS (SELECT user_id, ts::DATE AS d, ts AS available_at, event_id AS seq FROM events WHERE event_type <> 'error')"


def _times(spark, sf):
    rows = a.table(spark, sf, "events").withColumn("d", F.col("ts").cast("date"))
    return rows.groupBy("user_id", "d").agg(F.max("ts").alias("available_at")), rows.where("event_type <> 'error'").select("user_id", "d", F.col("ts").alias("available_at"), F.col("event_id").alias("seq"))


@query(
    """, last AS (SELECT user_id, d, arg_max(available_at, seq) AS legacy FROM old GROUP BY ALL), c AS (SELECT count(*) AS compared, count(*) FILTER (legacy IS NULL) AS missing, count(*) FILTER (legacy <> available_at) AS mismatched FROM own LEFT JOIN last USING (user_id, d))
SELECT *, CASE WHEN missing = 0 AND mismatched = 0 THEN 'ok' ELSE 'fail' END AS status FROM c""",
    _TIMES_SQL,
)
def px2_timing_parity(spark, sf):
    own, old = _times(spark, sf)
    return reconcile.timing_parity(own, old, ["user_id", "d"])


@query(
    """, a1 AS (SELECT user_id, d, available_at AS at_, day(d) % 9 = 0 AS planned FROM own), b1 AS (SELECT user_id, d, CASE WHEN seq % 50 > 0 THEN available_at END AS at_ FROM old),
a2 AS (SELECT *, planned OR at_ IS NULL OR at_ > TIMESTAMP '2024-01-25 23:59:59' AS ph FROM a1), b2 AS (SELECT *, at_ IS NULL OR at_ > TIMESTAMP '2024-01-25 23:59:59' AS ph FROM b1),
x AS (SELECT user_id, d, max(at_) AS u FROM a2 WHERE NOT ph GROUP BY ALL), y AS (SELECT user_id, d, max(at_) AS v FROM b2 WHERE NOT ph GROUP BY ALL)
SELECT count(*) FILTER (u IS NOT NULL AND v IS NOT NULL) AS shared, count(*) FILTER (v IS NULL) AS only_canonical, count(*) FILTER (u IS NULL) AS only_legacy, count(*) FILTER (u <> v) AS timestamp_mismatches,
 (SELECT count(*) FROM a2 WHERE ph) AS placeholders_canonical, (SELECT count(*) FROM b2 WHERE ph) AS placeholders_legacy FROM x FULL JOIN y USING (user_id, d)""",
    _TIMES_SQL,
)
def px4_release_parity(spark, sf):
    own, old = _times(spark, sf)
    canonical = own.select("user_id", "d", F.col("available_at").alias("at"), (F.dayofmonth("d") % 9 == 0).alias("schedule_only"))
    legacy = old.select("user_id", "d", F.when(F.col("seq") % 50 > 0, F.col("available_at")).alias("at"))
    return reconcile.release_parity(canonical, legacy, ["user_id", "d"], "2024-01-25")


@query(
    f"""SELECT ticker, coalesce(pe, 0) AS provider_events, coalesce(ph, 0) AS provider_history, coalesce(fe, 0) AS filtered_events, coalesce(fh, 0) AS filtered_history, coalesce(fe, 0) + coalesce(fh, 0) AS rows_written,
 coalesce(reason, CASE WHEN coalesce(pe, 0) + coalesce(ph, 0) = 0 THEN 'provider_returned_empty' WHEN coalesce(fe, 0) + coalesce(fh, 0) = 0 THEN 'window_filter_no_matches' END) AS zero_reason
FROM (SELECT 'C' || c_custkey AS ticker, CASE WHEN c_acctbal < -900 THEN 'unsupported' END AS reason FROM customer) LEFT JOIN (SELECT ticker, count(*) AS pe, count(*) FILTER (earnings_date >= DATE '2001-01-01') AS fe FROM earnings WHERE state = 'O' GROUP BY ALL) USING (ticker)
LEFT JOIN (SELECT ticker, count(*) AS ph, count(*) FILTER (earnings_date >= DATE '2001-01-01') AS fh FROM earnings WHERE state <> 'O' GROUP BY ALL) USING (ticker)""",
    a.EARNINGS,
)
def ag17_row_breakdown(spark, sf):
    rows, customers = a.earnings(spark, sf), a.table(spark, sf, "customer")
    provider = {"events": rows.where("state = 'O'"), "history": rows.where("state <> 'O'")}
    filtered = {name: df.where("earnings_date >= date'2001-01-01'") for name, df in provider.items()}
    skipped = customers.where("c_acctbal < -900").select(F.concat(F.lit("C"), "c_custkey").alias("ticker"), F.lit("unsupported").alias("reason"))
    return audits.row_breakdown(customers.select(F.concat(F.lit("c"), "c_custkey").alias("ticker")), provider, filtered, skipped)


# --- payloads and entities


@query(
    f"""SELECT symbol, report_date, metric, value, value_text, period_end, period_type, fiscal_year, fiscal_quarter, currency FROM (
SELECT *, row_number() OVER (PARTITION BY symbol, metric, period_end, period_type, report_date ORDER BY at_ DESC, value DESC NULLS LAST) AS rk FROM (SELECT 'C' || o_custkey AS symbol, o_orderdate::DATE AS report_date, lower(o_orderpriority) AS metric, try_cast(v AS DOUBLE) AS value, CASE WHEN v = 'n/a' THEN v END AS value_text, o_orderdate::DATE AS period_end,
 coalesce(CASE WHEN lower(trim(p)) NOT IN ('', 'nan', 'none', 'nat', '<na>') THEN lower(trim(p)) END, 'unknown') AS period_type, year(o_orderdate)::INT AS fiscal_year, coalesce(nullif(regexp_extract(upper(p), 'Q[1-4]'), ''), 'Q' || quarter(o_orderdate)) AS fiscal_quarter, coalesce(upper(c), 'USD') AS currency, o_orderdate AS at_
FROM (SELECT *, {picked(PERIODS, "o_orderkey")} AS p, {picked((None, "eur", "nan", "USD"), "o_orderkey")} AS c0, CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' WHEN o_orderkey % 7 = 1 THEN 'nan' ELSE o_totalprice::VARCHAR END AS v FROM orders), LATERAL (SELECT CASE WHEN c0 <> 'nan' THEN c0 END AS c)) WHERE value_text IS NOT NULL OR (value IS NOT NULL AND NOT isnan(value))) WHERE rk = 1"""
)
def sk7_fundamentals_payload(spark, sf):
    at = F.col("o_orderdate").cast("string")
    value = F.when(F.col("o_orderkey") % 7 == 0, "n/a").when(F.col("o_orderkey") % 7 == 1, "nan").otherwise(F.col("o_totalprice").cast("string"))
    rows = a.table(spark, sf, "orders").select(
        F.concat(F.lit("c"), "o_custkey").alias("ticker"), F.col("o_orderpriority").alias("metric"), F.when(value != "nan", value).alias("value"), F.when(value == "n/a", value).alias("value_text"), F.substring(at, 1, 10).alias("period_end"),
        F.lit(None).cast("string").alias("period_type"), pick(PERIODS, "o_orderkey").alias("period"), F.lit(None).cast("string").alias("report_date"), pick((None, "eur", "nan", "USD"), "o_orderkey").alias("currency"), F.lit("s").alias("source"), at.alias("fetched_at"), F.col("o_orderkey").alias("seq"),
    )
    return payloads.fundamentals_payload(rows).select("symbol", "report_date", "metric", "value", "value_text", "period_end", "period_type", "fiscal_year", "fiscal_quarter", "currency")


@query(
    """SELECT ticker AS symbol, earnings_date, 'unknown' AS fiscal_period, arg_max(actual_eps, seq) FILTER (actual_eps IS NOT NULL) AS actual_eps, arg_max(estimate_eps, seq) FILTER (estimate_eps IS NOT NULL) AS estimate_eps, 'USD' AS currency FROM earnings GROUP BY ALL""",
    a.EARNINGS,
)
def sk7_earnings_payload(spark, sf):
    rows = a.earnings(spark, sf)
    own = rows.select("ticker", "earnings_date", F.lit(None).cast("string").alias("report_date"), F.lit("nan").alias("fiscal_period"), F.lit(None).cast("double").alias("actual_revenue"), F.lit(None).cast("double").alias("estimate_revenue"), F.lit(None).cast("string").alias("currency"), F.col("earnings_date").cast("timestamp").alias("fetched_at"), "state", "actual_eps", "estimate_eps", "seq")
    events, history = own.where("state = 'O'").drop("actual_eps", "state"), own.where("state <> 'O'").drop("state")
    out = payloads.earnings_payload(events.withColumn("actual_eps", F.lit(None).cast("double")), history)
    return out.select("symbol", "earnings_date", "fiscal_period", "actual_eps", "estimate_eps", "currency")


@query(
    f"""SELECT s AS symbol, isin, coalesce(substr(isin, 1, 2) IN ('US', 'DE'), false) AS isin_prefix_match, CASE WHEN lei IS NOT NULL AND substr(isin, 1, 2) IN ('US', 'DE') THEN 'direct_isin' END AS attach_method, CASE WHEN lei IS NOT NULL AND substr(isin, 1, 2) IN ('US', 'DE') THEN lei END AS entity_lei,
 CASE WHEN lei IS NULL THEN 'not_evaluated' WHEN substr(isin, 1, 2) IN ('US', 'DE') THEN 'passed' ELSE 'rejected' END AS gate_status, CASE WHEN lei IS NOT NULL AND substr(isin, 1, 2) NOT IN ('US', 'DE') THEN 'direct_isin_prefix_mismatch_name_unconfirmed' END AS reject_reason
FROM (SELECT p_brand || '-' || p_partkey AS s, CASE WHEN p_type <> 'SMALL' THEN upper({picked(("us", "DE", "fr", "US", "GB"), "p_size")}) || lpad((p_partkey % 400)::VARCHAR, 10, '0') END AS isin FROM part)
LEFT JOIN (SELECT upper({picked(("us", "DE", "fr", "US", "GB"), "s_suppkey")}) || lpad(s_suppkey::VARCHAR, 10, '0') AS isin, 'LEI' || s_suppkey AS lei FROM supplier) USING (isin)"""
)
def id6_direct_attach(spark, sf):
    isin = lambda key, n: F.concat(pick(("us", "DE", "fr", "US", "GB"), key), F.lpad(F.expr(n).cast("string"), 10, "0"))
    listings = a.table(spark, sf, "part").select(F.concat("p_brand", F.lit("-"), "p_partkey").alias("symbol"), isin("p_size", "p_partkey % 400").alias("isin"), F.when(F.col("p_type") != "SMALL", "success").otherwise("error").alias("isin_status"), F.array(F.lit("US"), F.lit("DE")).alias("allowed_prefixes"))
    leis = a.table(spark, sf, "supplier").select(F.upper(isin("s_suppkey", "s_suppkey")).alias("isin"), F.concat(F.lit("LEI"), "s_suppkey").alias("lei"), F.col("s_name").alias("legal_name"))
    return chain.direct_attach(listings, leis).select("symbol", "isin", "isin_prefix_match", "attach_method", "entity_lei", "gate_status", "reject_reason")


_HOME = (None, "us", "DE", "", "FR")


@query(
    f""", e AS (SELECT 'lei:L' || c_custkey AS entity_id, CASE WHEN c_acctbal < 0 THEN '' ELSE 'L' || c_custkey END AS own, upper(nullif({picked(_HOME, "c_custkey")}, '')) AS cur, c_mktsegment AS seg FROM customer WHERE c_mktsegment IN ('HOUSEHOLD', 'MACHINERY')),
ev AS (SELECT 'L' || o_custkey AS lei, upper(coalesce(nullif(l, ''), nullif(split_part(j, '-', 1), ''), nullif(h, ''))) AS home, CASE WHEN l <> '' THEN 'legal_country' WHEN j <> '' THEN 'jurisdiction' ELSE 'headquarters_country' END AS field, CASE WHEN o_orderstatus = 'F' THEN 'entities' ELSE 'isins' END AS src, o_orderkey AS seq
 FROM (SELECT *, coalesce({picked((None, "us", ""), "o_orderkey")}, '') AS l, coalesce({picked((None, "DE-BE", "us-de", ""), "o_orderkey // 3")}, '') AS j, coalesce({picked(("fr", None), "o_orderkey // 5")}, '') AS h FROM orders)),
best AS (SELECT lei, arg_min({{'h': home, 'f': field, 's': src}}, (src <> 'entities', seq)) AS b FROM ev WHERE home IS NOT NULL GROUP BY ALL)
SELECT entity_id, lei, cur AS current_home_country, b.h AS evidence_country, coalesce(cur, b.h) AS new_home_country, b.s AS source_table, b.f AS source_field,
 CASE WHEN b IS NULL THEN 'missing_evidence' WHEN cur IS NULL THEN 'changed' WHEN cur = b.h THEN 'already_set' ELSE 'non_empty_conflict_not_overwritten' END AS action
FROM (SELECT *, coalesce(nullif(own, ''), substr(entity_id, 5)) AS lei FROM e WHERE seg = 'HOUSEHOLD') LEFT JOIN best USING (lei)""",
    "one AS (SELECT 1)",
)
def id15_home_countries(spark, sf):
    key = F.col("c_custkey")
    entities = a.table(spark, sf, "customer").select(F.concat(F.lit("lei:L"), key).alias("entity_id"), F.when(F.col("c_acctbal") < 0, "").otherwise(F.concat(F.lit("L"), key)).alias("lei"), pick(_HOME, "c_custkey").alias("home_country"), F.when(F.col("c_mktsegment").isin("HOUSEHOLD", "MACHINERY"), "resolved").otherwise("open").alias("resolution_status"), F.col("c_mktsegment").alias("publication_batch_id"))
    rows = a.table(spark, sf, "orders").select(F.concat(F.lit("l"), "o_custkey").alias("lei"), F.lit("name").alias("legal_name"), pick((None, "us", ""), "o_orderkey").alias("legal_country"), pick((None, "DE-BE", "us-de", ""), "o_orderkey div 3").alias("jurisdiction"), pick(("fr", None), "o_orderkey div 5").alias("headquarters_country"), F.col("o_orderkey").alias("seq"), "o_orderstatus")
    evidence = chain.home_country_evidence([("entities", rows.where("o_orderstatus = 'F'")), ("isins", rows.where("o_orderstatus <> 'F'"))])
    return chain.home_country_plan(entities, evidence, "HOUSEHOLD")


_NAMES = ("Sony Group ADR", "Apple Inc", None, " ", "Novo American Depositary", "Toyota")
_FROM = (None, "Japan", "usa", "", "Denmark", "global")


@query(
    f""", r AS (SELECT p_partkey AS seq, 'A' || (p_partkey % 900) AS entity_id, {picked(_NAMES, "p_partkey")} AS name, {picked(_FROM, "p_partkey // 2")} AS hc, {picked(("Germany", None, "US"), "p_size")} AS c FROM part),
t AS (SELECT *, regexp_matches(upper(coalesce(name, '')), ' ADR| ADS|AMERICAN DEPOSIT') AS adr, {code_sql("hc")} AS hk, {code_sql("c")} AS ck, {code_sql("coalesce(nullif(trim(hc), ''), c)")} AS sk FROM r),
l AS (SELECT *, CASE WHEN adr THEN 'US' ELSE coalesce(nullif(sk, ''), 'US') END AS listed FROM t),
h AS (SELECT *, CASE WHEN NOT adr THEN listed WHEN hk NOT IN ('', 'US') THEN hk WHEN ck NOT IN ('', 'US') THEN ck ELSE {code_sql("coalesce(nullif(trim(hc), ''), c, listed)")} END AS home FROM l),
f AS (SELECT entity_id, arg_min({{'name': name, 'listed': listed, 'home': home}}, seq) AS v FROM h GROUP BY ALL)
SELECT entity_id, nullif(trim(v.name), '') AS name, v.listed AS country, v.home AS home_country, coalesce((SELECT v FROM zones WHERE k = f.v.listed), 'OTHER') AS region, coalesce((SELECT v FROM zones WHERE k = f.v.home), 'OTHER') AS home_region FROM f""",
    COUNTRIES_SQL,
)
def rg8_entity_attributes(spark, sf):
    rows = a.table(spark, sf, "part").select(
        F.concat(F.lit("a"), F.col("p_partkey") % 900).alias("normalized_symbol"), pick(_NAMES, "p_partkey").alias("name"), pick(("Germany", None, "US"), "p_size").alias("country"), pick(_FROM, "p_partkey div 2").alias("holding_country"),
        F.lit(None).cast("string").alias("home_country"), F.lit(None).cast("string").alias("instrument_type"), F.col("p_partkey").alias("seq"),
    )
    return payloads.entity_attributes(rows)


# --- filings

FORMS = ("8-K", "10-Q", " 6-k ", None, "8-K/A")
FILED = ("Item 2.02  Results of Operations", "EX-99.1 of the press release", "annual meeting", "Business OUTLOOK for the year", None, "we withdraw guidance; results follow", "Item 8.01 other events")


@query(
    f"""SELECT * FROM (SELECT event_id, CASE {" ".join(f"WHEN contains(lower(t), '{s}') THEN '{s}'" for s in observations.FILING_SIGNALS)} END AS signal, regexp_replace(t, '\\s+', ' ', 'g') AS snippet
FROM (SELECT event_id, {picked(FILED, "event_id // 5")} AS t, {picked(FORMS, "event_id")} AS f FROM events) WHERE upper(trim(f)) IN ('8-K', '6-K')) WHERE signal IS NOT NULL"""
)
def ob6_filing_guidance(spark, sf):
    filings = a.table(spark, sf, "events").select("event_id", pick(FORMS, "event_id").alias("form"), pick(FILED, "event_id div 5").alias("text"))
    return observations.filing_candidates(filings).select("event_id", "signal", "snippet")


@query(
    """, s AS (SELECT 'prices' AS asset, max(l_shipdate::DATE)::TIMESTAMP AS last, 48 AS f, 48 AS g FROM lineitem UNION ALL SELECT 'orders', max(o_orderdate::DATE)::TIMESTAMP, 26, 24 FROM orders),
r AS (SELECT asset, CASE WHEN h <= f THEN 'fresh' WHEN h <= f + g THEN 'stale_within_tolerance' ELSE 'failed_hard' END AS freshness_state FROM (SELECT *, (epoch(TIMESTAMP '2001-11-05 12:00:00') - epoch(last)) / 3600 AS h FROM s))
SELECT asset, freshness_state, CASE WHEN bool_or(freshness_state = 'failed_hard') OVER () THEN 'failed_hard' WHEN bool_or(freshness_state = 'stale_within_tolerance') OVER () THEN 'stale_within_tolerance' ELSE 'fresh' END AS overall_state FROM r""",
    "one AS (SELECT 1)",
)
def fr3_overall_state(spark, sf):
    orders = a.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    rows = health.asset_status({"prices": (a.prices(spark, sf), "date", 48, 48), "orders": (orders, "date", 26, 24)}, "2001-11-05 12:00:00")
    return health.overall_state(rows).select("asset", "freshness_state", "overall_state")
