"""Registered queries of the gates that attach legal entities: suspect prefixes, foreign issuers, and all gates in turn."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import waterfall
from ..sources import adapters as a
from .queries import query
from .universe_queries import raw, raw_sql

_K = "c_custkey"
LISTED = {
    "symbol": f"concat('S', {_K})", "raw_isin": f"CASE {_K} % 7 WHEN 0 THEN concat('US', {_K}) WHEN 1 THEN ' ' WHEN 2 THEN NULL WHEN 3 THEN concat('fr', {_K}) ELSE concat('DE', {_K}) END", "isin_status": f"CASE {_K} % 5 WHEN 0 THEN 'success' WHEN 1 THEN 'not_found' ELSE 'suspect' END",
    "isin_error_reason": f"CASE {_K} % 4 WHEN 0 THEN 'isin_prefix_mismatch' WHEN 1 THEN 'provider_listing_mismatch' WHEN 2 THEN 'provider_returned_alternate_market_instrument' ELSE 'invalid_isin' END",
    "country": f"CASE WHEN {_K} % 9 < 4 THEN 'us' WHEN {_K} % 9 < 7 THEN 'DE' END", "provider_country": f"CASE WHEN {_K} % 11 = 0 THEN 'US' END", "exchange_code": f"CASE WHEN {_K} % 13 = 0 THEN 'US' ELSE 'GR' END",
    "name": f"concat('Name', {_K} % 97, CASE {_K} % 3 WHEN 0 THEN ' Public' WHEN 1 THEN ' Inc' ELSE '' END)", "provider_name": f"CASE WHEN {_K} % 6 = 1 THEN concat('Other', {_K} % 97) END",
}
RECORDS = {
    "isin": f"CASE WHEN {_K} % 7 = 3 THEN concat('FR', {_K}) WHEN {_K} % 7 = 0 THEN concat('US', {_K}) ELSE concat('DE', {_K}) END", "record_status": f"CASE WHEN {_K} % 10 = 4 THEN 'error' ELSE 'success' END", "lei": f"concat('LEI', {_K})",
    "legal_name": f"CASE WHEN {_K} % 12 = 1 THEN concat('OTHER', {_K} % 97) ELSE concat('NAME', {_K} % 97 + CASE WHEN {_K} % 8 = 0 THEN 1 ELSE 0 END, ' Inc') END",
}
_O = "o_orderkey"
CANDIDATES = {
    "symbol": "concat('S', o_custkey)", "place": _O, "lei": f"concat('L', {_O} % 300)", "legal_name": f"concat('Name', (o_custkey + CASE WHEN {_O} % 3 = 0 THEN 0 ELSE 1 END) % 97, CASE WHEN {_O} % 2 = 0 THEN ' Public' ELSE '' END)",
    "legal_country": f"CASE {_O} % 5 WHEN 0 THEN 'de' WHEN 1 THEN 'FR' WHEN 2 THEN 'Germany' END", "headquarters_country": f"CASE WHEN {_O} % 7 = 0 THEN 'GB' END", "jurisdiction": f"CASE WHEN {_O} % 11 = 0 THEN 'US' END",
}
_P = "p_partkey"
EXPANSIONS = {"lei": f"concat('L', {_P})", "expansion_status": f"CASE WHEN {_P} % 6 = 5 THEN 'error' ELSE 'success' END", "isins": f"CASE WHEN {_P} % 4 = 0 THEN array('FR1', concat('DE', {_P})) WHEN {_P} % 4 = 1 THEN array('US1', ' gb2 ') WHEN {_P} % 4 = 2 THEN array(concat('de', {_P} + 2), 'JP1') ELSE array('CA1') END"}
_EXPANSIONS_SQL = raw_sql("ex", "part", {**EXPANSIONS, "isins": EXPANSIONS["isins"].replace("array(", "list_value(")})


def _key(c: str) -> str:
    return rf"nullif(regexp_replace(regexp_replace(upper({c}), ' (INC)$', ''), ' PUBLIC$', ''), '')"


US = "(coalesce(upper(country) = 'US', false) OR coalesce(provider_country = 'US', false) OR coalesce(exchange_code = 'US', false))"
BASE = f"""u AS (SELECT *, {US} AS us, nullif(upper(trim(raw_isin)), '') AS own, list_filter([{_key("provider_name")}, {_key("name")}], lambda x: x IS NOT NULL) AS keys FROM ls),
direct AS (SELECT u.symbol, CASE WHEN isin_status <> 'success' THEN 'isin_' || isin_status WHEN r.lei IS NULL THEN 'valid_isin_no_gleif_lei' END AS why, r.lei FROM u LEFT JOIN rec r ON u.isin_status = 'success' AND u.own = r.isin AND r.record_status = 'success'),
pre AS (SELECT u.*, isin_status = 'suspect' AND isin_error_reason <> 'invalid_isin' AS applies, r.lei, {_key("r.legal_name")} AS legal FROM u LEFT JOIN rec r ON u.own = r.isin AND r.record_status = 'success'),
mis AS (SELECT symbol, applies, lei, CASE WHEN NOT us THEN 'direct_prefix_mismatch_non_us_listing' WHEN own IS NULL THEN 'missing_raw_isin' WHEN lei IS NULL THEN 'direct_prefix_mismatch_no_gleif_lei' WHEN NOT list_contains(keys, legal) THEN 'direct_prefix_mismatch_name_unconfirmed' END AS why FROM pre),
one AS (SELECT u.symbol, c.place, c.lei, list_contains(u.keys, {_key("c.legal_name")}) AS alike, ex.expansion_status AS st, list_distinct(list_transform(ex.isins, lambda x: upper(trim(x)))) AS isins, len(ex.isins) AS n, u.own,
   list_transform(list_filter([c.legal_country, c.headquarters_country, c.jurisdiction], lambda x: length(x) = 2), lambda x: upper(x)) AS pre FROM u JOIN cand c ON c.symbol = u.symbol AND u.us LEFT JOIN ex ON ex.lei = c.lei),
two AS (SELECT *, coalesce(len(list_filter(isins, lambda x: list_contains(pre, x[1:2]))), 0) AS n_issuer, coalesce(list_contains(isins, own) AND own NOT LIKE 'US%', false) AS by_own FROM one),
three AS (SELECT *, CASE WHEN NOT alike THEN 'name_unconfirmed' WHEN st IS NULL THEN 'lei_expansion_missing' WHEN st <> 'success' THEN 'lei_expansion_not_success' WHEN n_issuer = 0 AND NOT by_own THEN 'no_confirming_foreign_issuer_isin' END AS reason FROM two),
agg AS (SELECT symbol, count(*) FILTER (reason IS NULL) AS nc, string_agg(lei, ',' ORDER BY lei) FILTER (reason IS NULL) AS leis, arg_min(coalesce(reason, ''), place) AS first_reason,
   coalesce(min(place) FILTER (reason IS NULL), min(place)) AS shown FROM three GROUP BY symbol),
iss AS (SELECT u.symbol, CASE WHEN nc = 1 THEN leis END AS lei, CASE WHEN NOT us THEN 'not_us_listing' WHEN nc IS NULL THEN 'no_legal_name_candidate' WHEN nc > 1 THEN 'multiple_foreign_issuer_candidates' WHEN nc = 0 THEN first_reason END AS why,
   CASE WHEN nc > 1 THEN leis ELSE t.lei END AS issuer_lei, t.alike AS issuer_name_match, t.n AS n_expanded, CASE WHEN t.st = 'success' THEN t.n_issuer ELSE 0 END AS n_issuer_isins, t.symbol IS NOT NULL AS met
   FROM u LEFT JOIN agg USING (symbol) LEFT JOIN three t ON t.symbol = u.symbol AND t.place = agg.shown)"""
_CTES = (raw_sql("ls", "customer", LISTED), raw_sql("rec", "customer", RECORDS), raw_sql("cand", "orders", CANDIDATES), _EXPANSIONS_SQL, BASE)


def _inputs(spark, sf):
    listings, records, candidates, expansions = (raw(spark, sf, t, c) for t, c in (("customer", LISTED), ("customer", RECORDS), ("orders", CANDIDATES), ("part", EXPANSIONS)))
    return a.spread(listings, "symbol"), records, a.spread(candidates, "symbol"), expansions


@query("SELECT symbol, CASE WHEN applies AND why IS NULL THEN lei END AS entity_lei, CASE WHEN applies THEN why END AS reject_reason FROM mis", *_CTES)
def id9_prefix_mismatches(spark, sf):
    listings, records, _, _ = _inputs(spark, sf)
    return waterfall.prefix_mismatches(listings, records).select("symbol", F.col("_lei").alias("entity_lei"), F.col("_why").alias("reject_reason"))


@query("SELECT symbol, lei AS entity_lei, why AS reject_reason, issuer_lei, issuer_name_match, CASE WHEN met THEN coalesce(n_expanded, 0) END AS n_expanded, CASE WHEN met THEN n_issuer_isins END AS n_issuer_isins FROM iss", *_CTES)
def id9_foreign_issuers(spark, sf):
    listings, _, candidates, expansions = _inputs(spark, sf)
    found = waterfall.foreign_issuers(listings, candidates, expansions)
    met = F.col("issuer_lei").isNotNull()
    return found.select("symbol", F.col("_lei").alias("entity_lei"), F.col("_why").alias("reject_reason"), "issuer_lei", F.when(met, F.col("issuer_name_match")).alias("issuer_name_match"), F.when(met, F.col("n_expanded")).alias("n_expanded"), F.when(met, F.col("n_issuer_isins")).alias("n_issuer_isins"))


@query(
    """SELECT u.symbol, CASE WHEN d.why IS NULL THEN d.lei WHEN m.applies AND m.why IS NULL THEN m.lei ELSE i.lei END AS entity_lei,
 CASE WHEN d.why IS NULL THEN 'direct_isin' WHEN m.applies AND m.why IS NULL THEN 'isin_direct_prefix_mismatch_name_confirmed' WHEN i.lei IS NOT NULL THEN 'foreign_issuer_name_anchor_confirmed' ELSE 'unattached' END AS method,
 CASE WHEN d.why IS NULL THEN '' ELSE concat_ws(';', 'direct_isin=' || d.why, CASE WHEN m.applies THEN 'isin_direct_prefix_mismatch_name_confirmed=' || m.why END, CASE WHEN NOT (m.applies AND m.why IS NULL) THEN 'foreign_issuer_name_anchor_confirmed=' || i.why END) END AS refused
FROM u JOIN direct d USING (symbol) JOIN mis m USING (symbol) JOIN iss i USING (symbol)""",
    *_CTES,
)
def id9_waterfall(spark, sf):
    listings, records, candidates, expansions = _inputs(spark, sf)
    gates = [
        ("direct_isin", lambda rows: waterfall.direct_isins(rows, records)),
        ("isin_direct_prefix_mismatch_name_confirmed", lambda rows: waterfall.prefix_mismatches(rows, records)),
        ("foreign_issuer_name_anchor_confirmed", lambda rows: waterfall.foreign_issuers(rows, candidates, expansions)),
    ]
    refused = F.array_join(F.transform("refused", lambda r: F.concat_ws("=", r["gate"], r["reason"])), ";")
    return waterfall.waterfall(listings, gates).select("symbol", "entity_lei", "method", refused.alias("refused"))
