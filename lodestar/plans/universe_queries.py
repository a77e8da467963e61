"""Registered queries of release-calendar rules, data windows and the reconciliation of the registry.

Raw rows come from expressions over the tables that both engines read alike; the rules are written twice, as operators and as SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import macro, market, registry, universe
from ..sources import adapters as a
from .gap_queries import COUNTRIES_SQL, code_sql, quoted, values
from .queries import query


def raw(spark, sf: str, table: str, columns: dict[str, str]) -> DataFrame:
    return a.table(spark, sf, table).select(*(F.expr(e).alias(c) for c, e in columns.items()))


def raw_sql(name: str, table: str, columns: dict[str, str]) -> str:
    return f"{name} AS (SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {table})"


# --- release calendars

_K, _DAY = "o_orderkey", "CAST(CAST(o_orderdate AS DATE) AS STRING)"
CALENDAR = {
    "series_key": f"CASE WHEN {_K} % 53 = 0 THEN ' ' ELSE concat('C', o_custkey) END",
    "observation_period": f"CASE WHEN {_K} % 59 = 1 THEN NULL ELSE {_DAY} END",
    "observation_date": f"CASE WHEN {_K} % 61 = 2 THEN '2024-13-01' ELSE {_DAY} END",
    "release_date_local": f"CASE WHEN {_K} % 61 = 3 THEN 'n/a' ELSE {_DAY} END",
    "scheduled_at": f"CASE WHEN {_K} % 67 = 3 THEN 'soon' ELSE concat({_DAY}, ' 12:30:00') END",
    "released_at": f"CASE WHEN {_K} % 71 = 4 THEN concat({_DAY}, ' 12:31:00') WHEN {_K} % 73 = 5 THEN NULL ELSE concat({_DAY}, ' 12:30:00') END",
    "observed_at": f"CASE WHEN o_orderstatus = 'F' THEN CASE WHEN {_K} % 79 = 6 THEN 'later' WHEN {_K} % 83 = 0 THEN '2031-01-01 00:00:00' ELSE concat({_DAY}, ' 12:32:00') END END",
    "ingested_at": f"CASE WHEN {_K} % 79 = 7 THEN '' ELSE concat({_DAY}, ' 13:00:00') END",
    "availability_status": f"CASE WHEN {_K} % 89 = 7 THEN '' WHEN {_K} % 97 = 8 THEN 'provisional' WHEN o_orderstatus = 'F' THEN 'observed_available' ELSE 'scheduled_provisional' END",
    "availability_source": f"CASE WHEN {_K} % 101 = 9 THEN ' ' ELSE 'agency' END",
    "is_schedule_based_only": f"CASE WHEN {_K} % 103 = 10 THEN 'maybe' WHEN {_K} % 107 = 11 THEN '0' WHEN {_K} % 109 = 12 THEN '1' WHEN o_orderstatus = 'F' THEN 'False' ELSE 'true' END",
    "delay_vs_schedule_seconds": f"CASE WHEN {_K} % 113 = 13 THEN 'x' WHEN {_K} % 127 = 14 THEN '119.6' WHEN {_K} % 131 = 15 THEN '60' WHEN o_orderstatus = 'F' THEN '120' END",
    "zone": f"CASE WHEN {_K} % 137 = 16 THEN NULL ELSE 'America/New_York' END",
}
_ONLY = "CASE WHEN lower(trim(is_schedule_based_only)) IN ('true', '1') THEN true WHEN lower(trim(is_schedule_based_only)) IN ('false', '0') THEN false END"
_SEEN, _STATUS = "observed IS NOT NULL", "trim(coalesce(availability_status, ''))"
RULES_SQL = {f"empty_{c}": f"trim(coalesce({c}, '')) = ''" for c in ("series_key", "observation_period", "zone", "availability_status", "availability_source")} | {
    "invalid_scheduled_at": "scheduled IS NULL",
    "invalid_released_at": "released IS NULL",
    "invalid_ingested_at": "try_cast(ingested_at AS TIMESTAMP) IS NULL",
    "invalid_observation_date": "try_cast(observation_date AS DATE) IS NULL",
    "invalid_release_date_local": "try_cast(release_date_local AS DATE) IS NULL",
    "invalid_observed_at": "observed_at IS NOT NULL AND observed IS NULL",
    "invalid_is_schedule_based_only": "schedule_only IS NULL",
    "invalid_delay": "delay_vs_schedule_seconds IS NOT NULL AND delay IS NULL",
    "released_is_not_scheduled": "released <> scheduled",
    "unknown_status": f"{_STATUS} NOT IN ('', {', '.join(map(quoted, macro.AVAILABILITY))})",
    "observed_but_schedule_only": f"{_SEEN} AND schedule_only",
    "neither_observed_nor_schedule_only": f"NOT ({_SEEN}) AND NOT schedule_only",
    "observed_status": f"{_SEEN} AND {_STATUS} <> 'observed_available'",
    "delay_value": f"{_SEEN} AND scheduled IS NOT NULL AND (delay IS NULL OR round_even(delay, 0) <> round_even(epoch(observed) - epoch(scheduled), 0))",
    "delay_on_schedule_only": f"NOT ({_SEEN}) AND delay IS NOT NULL",
    "observed_in_future": "observed > TIMESTAMP '2024-01-28 12:00:00'",
}


@query(
    f""", t AS (SELECT *, try_cast(scheduled_at AS TIMESTAMP) AS scheduled, try_cast(released_at AS TIMESTAMP) AS released, try_cast(observed_at AS TIMESTAMP) AS observed, try_cast(delay_vs_schedule_seconds AS DOUBLE) AS delay, {_ONLY} AS schedule_only FROM c),
r AS ({" UNION ALL ".join(f"SELECT '{r}' AS rule, count(*) FILTER ({w}) AS n FROM t" for r, w in RULES_SQL.items())}
UNION ALL SELECT 'duplicate_key', coalesce(sum(n), 0)::BIGINT FROM (SELECT count(*) AS n FROM t GROUP BY series_key, observation_period HAVING count(*) > 1))
SELECT rule, n FROM r WHERE n > 0""",
    raw_sql("c", "orders", CALENDAR),
)
def rc7_calendar_violations(spark, sf):
    return macro.calendar_violations(raw(spark, sf, "orders", CALENDAR), F.lit("2024-01-28 12:00:00").cast("timestamp"))


# --- data windows

FACTS = {"ticker": "concat('C', o_custkey)", "period_end": "CAST(o_orderdate AS DATE)", "updated_at": "CASE WHEN o_orderstatus <> 'P' THEN concat(CAST(CAST(o_orderdate AS DATE) AS STRING), ' 10:00:00') END", "fetched_at": "CASE WHEN o_orderkey % 3 = 0 THEN concat(CAST(CAST(o_orderdate AS DATE) AS STRING), ' 11:30:00') END"}


def _window_sql(gap: str, unit: str, expected: str) -> str:
    return f""", d AS (SELECT ticker, period_end AS d, max(greatest(try_cast(updated_at AS TIMESTAMP), try_cast(fetched_at AS TIMESTAMP))) AS upd FROM f GROUP BY ALL), g AS (SELECT *, lag(d) OVER (PARTITION BY ticker ORDER BY d) AS b FROM d),
w AS (SELECT ticker, min(d) AS first_date, max(d) AS last_date, max(upd) AS latest_update, {expected} AS expected, count(d) AS actual, arg_max({{'b': b, 'd': d, 'gap': greatest(0, {gap} - 1)}}, (greatest(0, coalesce({gap}, 0) - 1), -date_diff('day', DATE '1970-01-01', d))) AS w FROM g GROUP BY ticker)
SELECT ticker, first_date, last_date, latest_update, expected, actual, greatest(0, expected - actual) AS missing, round(actual * 100.0::DOUBLE / nullif(expected, 0), 2) AS completeness, CASE WHEN w.gap > 0 AND w.b IS NOT NULL THEN w.b || ' -> ' || w.d || ' ({unit}=' || w.gap || ')' END AS largest_gap FROM w"""


_Q = "(year({0}) * 4 + quarter({0}))".format


@query(_window_sql(f"({_Q('d')} - {_Q('b')})", "missing_quarters", f"{_Q('max(d)')} - {_Q('min(d)')} + 1"), raw_sql("f", "orders", FACTS))
def mk15_quarterly_windows(spark, sf):
    return market.period_windows(raw(spark, sf, "orders", FACTS), "ticker", "period_end", ("updated_at", "fetched_at"), quarterly=True)


@query(
    _window_sql("date_diff('day', b, d)", "missing_calendar_days", "NULL::BIGINT").replace("greatest(0, expected - actual) AS missing, round(actual * 100.0::DOUBLE / nullif(expected, 0), 2) AS completeness", "NULL::BIGINT AS missing, NULL::DOUBLE AS completeness"),
    raw_sql("f", "orders", FACTS),
)
def mk15_periodic_windows(spark, sf):
    return market.period_windows(raw(spark, sf, "orders", FACTS), "ticker", "period_end", ("updated_at", "fetched_at"))


# --- reconciliation of the registry


def _symbol(k: str, dash: str = "'.'") -> str:
    """S and a number; every seventh is a share class."""
    return f"CASE WHEN {k} % 7 = 0 THEN concat(chr(CAST(65 + {k} % 26 AS INT)), chr(CAST(65 + floor({k} / 26) % 26 AS INT)), {dash}, 'B') ELSE concat('S', {k}) END"


_PK = "(p_partkey % 1200)"
_PLACE = "CASE p_partkey % 5 WHEN 0 THEN 'us' WHEN 1 THEN 'eu' WHEN 2 THEN 'asx' WHEN 3 THEN 'LATAM' END"
_MARKET = "CASE p_partkey % 6 WHEN 0 THEN 'NMS' WHEN 1 THEN 'nasdaq' WHEN 2 THEN 'HKG' WHEN 3 THEN 'XPAR' WHEN 4 THEN 'none' END"
REGISTRY = {
    "input_symbol": f"lower({_symbol(_PK)})", "normalized_symbol": f"CASE WHEN p_size % 11 = 0 THEN 'NAN' ELSE {_symbol(_PK, dash=chr(39) + '-' + chr(39))} END", "region": _PLACE, "exchange": _MARKET,
    "registry_key": f"concat({_symbol(_PK, dash=chr(39) + '-' + chr(39))}, '|', CASE WHEN p_partkey % 5 = 2 THEN 'apac' ELSE coalesce(lower({_PLACE}), 'us') END, '|', CASE WHEN p_partkey % 6 = 5 THEN 'XLON' WHEN p_partkey % 6 = 4 THEN 'default' ELSE upper({_MARKET}) END)",
    "status": "CASE p_size % 6 WHEN 0 THEN 'rejected' WHEN 1 THEN 'pending_validation' ELSE ' Active' END", "promotion_status": "CASE p_size % 9 WHEN 0 THEN 'rejected' WHEN 1 THEN 'pending_validation' WHEN 2 THEN 'validated_market_only' WHEN 3 THEN 'candidate' ELSE 'validated_full' END",
    "market_supported": "p_size % 8 <> 5", "instrument_type": "CASE WHEN p_size % 3 = 0 THEN ' Equity' WHEN p_size % 3 = 1 THEN 'etf' END", "seq": "p_partkey",
}
ATTRIBUTES = {
    "symbol": _symbol("(c_custkey * 2)"), "country": "CASE c_custkey % 6 WHEN 0 THEN 'United States' WHEN 1 THEN 'Germany' WHEN 2 THEN 'israel' WHEN 3 THEN 'Brazil' WHEN 4 THEN '' END",
    "home_country": "CASE c_custkey % 4 WHEN 0 THEN 'Japan' WHEN 1 THEN 'South Africa' END", "region": "CASE WHEN c_custkey % 10 = 1 THEN 'Europe' WHEN c_custkey % 10 = 2 THEN 'OTHER' END", "exchange": "CASE c_custkey % 8 WHEN 0 THEN 'lse' WHEN 1 THEN 'TSX' WHEN 2 THEN 'null' END",
    "exchange_mic": "CASE WHEN c_custkey % 3 = 0 THEN 'xlon' END", "currency": "CASE WHEN c_custkey % 5 = 0 THEN 'usd' END", "seq": "c_custkey",
}
TRACKED = {"symbol": _symbol("c_custkey"), "is_tracked": "c_acctbal > 2500"}
SOURCE_SQL = {
    "readiness": f"SELECT {TRACKED['symbol']} AS symbol FROM customer WHERE {TRACKED['is_tracked']}", "prices": f"SELECT {_symbol('l_suppkey')} AS symbol FROM lineitem", "technicals": f"SELECT {_symbol('o_custkey')} FROM orders WHERE o_orderstatus = 'P'",
    "summaries": f"SELECT {_symbol('s_suppkey')} FROM supplier WHERE s_acctbal > 5000", "fundamentals": f"SELECT {_symbol('o_custkey')} FROM orders", "earnings": f"SELECT {_symbol('o_custkey')} FROM orders WHERE o_totalprice > 250000",
}
_NONE = "('', 'NONE', 'NULL', 'NAN')"


def _upper(c: str) -> str:
    return f"CASE WHEN upper(trim({c})) NOT IN {_NONE} THEN upper(trim({c})) END"


def _region(c: str) -> str:
    return f"(CASE WHEN lower(trim(coalesce({c}, 'all'))) IN ('', 'all', 'global') THEN 'all' ELSE coalesce((SELECT v FROM names WHERE k = lower(trim({c}))), 'global') END)"


def _market_region(c: str) -> str:
    return f"coalesce((SELECT v FROM markets WHERE k = {c}), CASE WHEN {c} IS NOT NULL AND {_region(c)} IN ('us', 'eu', 'apac') THEN {_region(c)} END)"


def _spellings(c: str) -> str:
    return f"CASE WHEN upper(trim({c})) IN {_NONE} OR {c} IS NULL THEN []::VARCHAR[] WHEN regexp_full_match(upper(trim({c})), '[A-Z]{{1,5}}[.-][A-Z]') THEN [replace(upper(trim({c})), '-', '.'), replace(upper(trim({c})), '.', '-')] ELSE [upper(trim({c}))] END"


PLAN_SQL = f"""names AS (SELECT * FROM (VALUES {values((k, r) for r, own in registry.REGION_ALIASES.items() for k in own)}) t(k, v)), markets AS (SELECT * FROM (VALUES {values((k, r) for r, own in universe.SCHEDULE_EXCHANGES.items() for k in own)}) t(k, v)),
s AS ({" UNION ALL ".join(f"SELECT upper(trim(symbol)) AS symbol, '{n}' AS src FROM ({q.replace(' FROM', ' AS symbol FROM', 1) if ' AS symbol' not in q else q})" for n, q in SOURCE_SQL.items())}),
cand AS (SELECT symbol, bool_or(src IN ('readiness', 'technicals', 'summaries')) AS refresh, bool_or(src = 'fundamentals') AND bool_or(src = 'earnings') AS whole, coalesce(string_agg(DISTINCT src, ',' ORDER BY src) FILTER (src NOT IN ('fundamentals', 'earnings')), '') AS sources FROM s GROUP BY symbol),
rev AS (SELECT DISTINCT {_symbol("s_suppkey")} AS symbol FROM supplier WHERE s_acctbal > 9000),
r0 AS (SELECT * REPLACE (lower(trim(status)) AS status), {_upper("normalized_symbol")} AS norm, coalesce({_upper("exchange")}, CASE WHEN split_part(registry_key, '|', 3) <> 'default' THEN split_part(registry_key, '|', 3) END) AS ex, {_region("region")} AS reg FROM reg0),
r1 AS (SELECT *, status = 'active' AND promotion_status IN ('validated_full', 'validated_market_only') AND market_supported AND norm IS NOT NULL AS sel, {_market_region("ex")} AS exreg FROM r0),
r AS (SELECT *, sel AND list_contains({_spellings("normalized_symbol")}, symbol) AS here FROM (SELECT *, unnest(list_distinct(list_concat({_spellings("normalized_symbol")}, {_spellings("input_symbol")}))) AS symbol FROM r1)),
e AS (SELECT symbol, coalesce(nullif(country, ''), nullif(home_country, '')) AS given, nullif(region, '') AS product, {_upper("exchange")} AS own, {_upper("exchange_mic")} AS exchange_mic, {_upper("currency")} AS currency FROM attr QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY seq DESC) = 1),
f AS (SELECT symbol, count(*) AS n_related, count(*) FILTER (here) AS n_selected, arg_max(reg, ((sel::INT * 3 + (status IN ('active', 'pending_validation'))::INT * 2 + (promotion_status IN ('validated_full', 'validated_market_only', 'pending_validation'))::INT), reg)) FILTER (reg IN ('us', 'eu', 'apac')) AS safe,
 arg_min(exreg, seq) FILTER (exreg IS NOT NULL) AS rowex, arg_max({{'k': registry_key, 'n': norm, 'r': reg}}, seq) FILTER (here) AS one,
 CASE WHEN bool_or(status = 'rejected') AND NOT bool_or(sel) THEN 'rejected_or_superseded_without_active_canonical' WHEN bool_and(norm IS NULL) THEN 'missing_normalized_symbol' WHEN bool_or(NOT market_supported) THEN 'market_supported_false' WHEN bool_or(status = 'pending_validation' OR promotion_status = 'pending_validation') THEN 'pending_validation' ELSE 'not_promoted' END AS why FROM r GROUP BY symbol),
c1 AS (SELECT cand.*, e.* EXCLUDE symbol, f.* EXCLUDE symbol, {code_sql("coalesce(given, 'US')")} AS country FROM cand LEFT JOIN e USING (symbol) LEFT JOIN f USING (symbol) WHERE refresh AND symbol NOT IN (SELECT symbol FROM rev)),
c2 AS (SELECT *, coalesce(product, coalesce((SELECT v FROM zones WHERE k = country), 'OTHER')) AS pr FROM c1),
c3 AS (SELECT *, CASE WHEN {_region("pr")} IN ('us', 'eu', 'apac') THEN {_region("pr")} WHEN country = 'IL' THEN 'apac' WHEN {_region("country")} IN ('us', 'eu', 'apac') THEN {_region("country")} ELSE coalesce(safe, {_market_region("own")}, rowex, 'us') END AS region FROM c2),
x AS (SELECT symbol, arg_max(ex, (rank, there, same, ex)) AS best FROM (SELECT r.symbol, ex, CASE ex {" ".join(f"WHEN '{k}' THEN {v}" for k, v in universe.EXCHANGE_RANKS.items())} ELSE 50 END AS rank, bool_or(r.reg = c3.region)::INT AS there, bool_or(coalesce(norm = r.symbol, false) OR sel)::INT AS same FROM r JOIN c3 USING (symbol) WHERE ex IS NOT NULL GROUP BY ALL) GROUP BY symbol),
c4 AS (SELECT c3.*, coalesce(own, best) AS exchange, symbol || '|' || c3.region || '|' || coalesce(own, best, 'default') AS registry_key FROM c3 LEFT JOIN x USING (symbol)),
c5 AS (SELECT * FROM c4 WHERE NOT (coalesce(n_selected, 0) = 1 AND coalesce(one.k = registry_key AND one.n = symbol AND one.r = region, false))),
rel AS (SELECT c5.symbol, c5.registry_key AS canon, c5.region AS cr, c5.exchange AS ce, r.registry_key AS k, r.reg, r.ex, r.norm, r.status, r.promotion_status, r.instrument_type, r.seq FROM r JOIN c5 USING (symbol)),
base AS (SELECT symbol, nullif(lower(trim(instrument_type)), '') AS type FROM rel QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY (k = canon) DESC, (reg = cr) DESC, (coalesce(ex, '') = coalesce(ce, '')) DESC, (status <> 'rejected') DESC, coalesce(norm = symbol, false) DESC, seq) = 1)"""
_CTES = (raw_sql("reg0", "part", REGISTRY), raw_sql("attr", "customer", ATTRIBUTES), COUNTRIES_SQL, PLAN_SQL)


def _reconciled(spark, sf):
    symbols = lambda table, k, where="true": a.table(spark, sf, table).where(where).select(F.expr(_symbol(k)).alias("symbol"))
    sources = {
        "readiness": raw(spark, sf, "customer", TRACKED), "prices": symbols("lineitem", "l_suppkey"), "technicals": symbols("orders", "o_custkey", "o_orderstatus = 'P'"),
        "summaries": symbols("supplier", "s_suppkey", "s_acctbal > 5000"), "fundamentals": symbols("orders", "o_custkey"), "earnings": symbols("orders", "o_custkey", "o_totalprice > 250000"),
    }
    reviewed = symbols("supplier", "s_suppkey", "s_acctbal > 9000")
    return universe.reconciliation(sources, raw(spark, sf, "part", REGISTRY), raw(spark, sf, "customer", ATTRIBUTES), reviewed)


@query(
    """SELECT symbol, CASE WHEN NOT refresh THEN 'residue' ELSE 'reviewed' END AS outcome, CASE WHEN NOT refresh THEN 'price_only_materialized_not_tracked' ELSE 'reviewed_exclusion' END AS reason, sources,
 NULL AS registry_key, NULL AS region, NULL AS exchange, NULL AS exchange_mic, NULL AS currency, NULL AS instrument_type, NULL AS validation_status, NULL AS n_related, NULL AS n_selected FROM cand WHERE NOT refresh OR symbol IN (SELECT symbol FROM rev)
UNION ALL SELECT symbol, 'upsert', CASE WHEN n_selected > 0 THEN 'duplicate/conflicting canonical rows' ELSE coalesce(why, 'no_registry_row') END, sources, registry_key, region, exchange, exchange_mic, currency, coalesce(type, 'unknown'),
 CASE WHEN whole THEN 'validated_full' ELSE 'validated_market_only' END, coalesce(n_related, 0), coalesce(n_selected, 0) FROM c5 LEFT JOIN base USING (symbol)""",
    *_CTES,
)
def rg7_reconciliation_plan(spark, sf):
    return _reconciled(spark, sf)[0]


@query("SELECT k AS registry_key, arg_max(canon, symbol) AS superseded_by FROM rel WHERE k <> canon AND NOT (status = 'rejected' AND promotion_status = 'rejected') GROUP BY k", *_CTES)
def rg7_superseded_rows(spark, sf):
    return _reconciled(spark, sf)[1]
