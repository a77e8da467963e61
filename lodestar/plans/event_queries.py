"""Registered queries of events and identifiers from payloads and filings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import events
from ..sources import adapters as a
from .queries import query

def key():
    return F.col("o_orderkey")


def _orders(spark, sf):
    return a.table(spark, sf, "orders").withColumn("symbol", F.concat(F.lit("C"), "o_custkey"))


def _earnings(spark, sf):
    item = F.to_json(F.struct(F.when(key() % 9 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("reportDate"), F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("epsActual"), F.when(key() % 2 == 0, F.col("o_totalprice") * 2).alias("estimatedEps"), F.when(key() % 10 == 0, F.lit(7.5)).alias("revenue")))
    payload = F.when(key() % 3 == 0, F.concat(F.lit("["), item, F.lit("]"))).when(key() % 3 == 1, F.concat(F.lit('{"earnings":['), item, F.lit("]}"))).otherwise(item)
    return events.earnings_events(_orders(spark, sf).select("symbol", F.when(key() % 5 == 0, "error").otherwise("success").alias("status"), payload.alias("raw_payload")))


EARNED = """ev AS (SELECT DISTINCT 'C' || o_custkey AS symbol, o_orderdate::DATE AS report_date, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS eps_actual, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice * 2 END AS eps_estimate, CASE WHEN o_orderkey % 10 = 0 THEN 7.5::DOUBLE END AS revenue_actual, NULL::DOUBLE AS revenue_estimate
FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 9 <> 0)"""


@query("SELECT symbol, report_date, round(eps_actual, 6) AS eps_actual, round(eps_estimate, 6) AS eps_estimate, revenue_actual, revenue_estimate, CASE WHEN coalesce(eps_actual, revenue_actual) IS NOT NULL THEN 'reported' WHEN coalesce(eps_estimate, revenue_estimate) IS NOT NULL THEN 'estimated' ELSE 'scheduled' END AS event_status FROM ev", EARNED)
def ob2_earnings_events(spark, sf):
    return _earnings(spark, sf)


@query("SELECT count(coalesce(eps_actual, eps_estimate)) AS eps, count(coalesce(revenue_actual, revenue_estimate)) AS revenue, count(*) FILTER ((symbol, report_date) IN (SELECT 'C' || o_custkey, o_orderdate::DATE FROM orders WHERE o_orderkey % 3 = 0)) AS overlap FROM ev", EARNED)
def xr6_earnings_coverage(spark, sf):
    others = _orders(spark, sf).where(key() % 3 == 0).select("symbol", F.col("o_orderdate").cast("date").alias("report_date"))
    return events.earnings_coverage(_earnings(spark, sf), others)


@query("SELECT 'S' || s_suppkey AS ticker, lpad(s_suppkey::VARCHAR, 10, '0') AS cik, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE s_name END AS company_name FROM supplier WHERE s_suppkey % 8 <> 0")
def ob4_filer_numbers(spark, sf):
    k = F.col("s_suppkey")
    item = F.to_json(F.struct(F.concat(F.lit(" s"), k).alias("ticker"), F.when(k % 8 != 0, F.lpad(k.cast("string"), 7, "0")).alias("cik_str"), F.when(k % 3 != 0, F.col("s_name")).alias("title")))
    payload = F.when(k % 2 == 0, F.concat(F.lit("["), item, F.lit("]"))).otherwise(F.concat(F.lit('{"0":'), item, F.lit("}")))
    return events.filer_numbers(a.table(spark, sf, "supplier").select(payload.alias("raw_payload")))


#: Filings: forms and texts of orders by key.
FORMS, TEXTS = ("8-K", "10-Q", "S-3", "424B2", "DEF 14A", "4"), ("Share repurchase program", "Sales agreement for an ATM offering", "Underwritten offering: prospectus supplement", "Results and webcast", "Issuer purchases of equity securities", "Nothing", "Accelerated share repurchase (ASR)")
FILINGS = f"fl AS (SELECT 'C' || o_custkey AS symbol, o_orderkey::VARCHAR AS accession, ({list(FORMS)})[o_orderkey % 6 + 1] AS form, lower(({list(TEXTS)})[o_orderkey % 7 + 1]) AS t FROM orders)"


def _filings(spark, sf):
    pick = lambda values, n: F.element_at(F.array(*map(F.lit, values)), (key() % n + 1).cast("int"))
    return _orders(spark, sf).select("symbol", key().cast("string").alias("accession"), pick(FORMS, 6).alias("form"), pick(TEXTS, 7).alias("text"))


@query(
    """, s AS (SELECT *, CASE WHEN contains(t, 'webcast') THEN 'webcast' WHEN contains(t, 'results') THEN 'results' END AS sig FROM fl)
SELECT symbol, accession, form, CASE WHEN form = 'DEF 14A' THEN 'shareholder_meeting_candidate' ELSE 'investor_material_candidate' END AS event_type, CASE WHEN form <> 'DEF 14A' THEN sig END AS signal, CASE WHEN form = 'DEF 14A' THEN 'medium' ELSE 'low' END AS confidence FROM s WHERE form = 'DEF 14A' OR (form = '8-K' AND sig IS NOT NULL)""",
    FILINGS,
)
def ob5_investor_events(spark, sf):
    return events.investor_events(_filings(spark, sf))


def _rule_sql(kind, forms, signals):
    first = " ".join(f"WHEN contains(t, '{s}') THEN '{s}'" for s in signals)
    allowed = " OR ".join([f"form IN ({', '.join(map(repr, forms))})"] + ["starts_with(form, '424B')"] * ("424B" in forms))
    return f"SELECT symbol, accession, form, '{kind}' AS event_type, CASE {first} END AS signal FROM fl WHERE {allowed}"


@query("SELECT *, CASE WHEN contains(signal, 'asr') THEN 'asr' END AS event_subtype FROM (" + " UNION ALL ".join(_rule_sql(*r) for r in events.CAPITAL_RULES) + ") WHERE signal IS NOT NULL", FILINGS)
def ob7_capital_events(spark, sf):
    return events.capital_events(_filings(spark, sf))


@query(
    """SELECT DISTINCT 'C' || o_custkey AS symbol, o_orderdate::DATE AS ex_date, round(CASE WHEN o_orderkey % 4 = 1 THEN -1 WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_totalprice END::DOUBLE, 6) AS amount, CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate::DATE + 10 END AS payable_date, CASE WHEN o_orderkey % 2 = 0 THEN 'medium' ELSE 'low' END AS confidence
FROM orders WHERE o_orderkey % 4 <> 1"""
)
def ob8_distributions(spark, sf):
    at = F.date_format("o_orderdate", "yyyy-MM-dd")
    own = F.to_json(F.struct(at.alias("exDate"), F.when(key() % 6 != 0, F.col("o_totalprice")).alias("distribution"), F.date_format(F.date_add("o_orderdate", 10), "yyyy-MM-dd").alias("paymentDate")))
    fallback = F.to_json(F.struct(at.alias("date"), F.when(key() % 4 == 1, F.lit(-1.0)).otherwise(F.col("o_totalprice")).alias("divCash")))
    payload = F.concat(F.lit("["), F.when(key() % 2 == 0, own).otherwise(fallback), F.lit("]"))
    return events.distributions(_orders(spark, sf).select("symbol", F.lit("success").alias("status"), payload.alias("raw_payload")))


@query(
    """SELECT DISTINCT o_orderdate::DATE AS announcement_date, o_orderdate::DATE + 20 AS effective_date, side AS change_side, sym AS constituent_symbol FROM (SELECT *, unnest(['add', 'remove']) AS side, unnest(['A' || o_custkey, 'R' || (o_custkey % 50)]) AS sym FROM orders WHERE o_orderkey % 4 <> 0 AND o_orderkey % 5 <> 0)"""
)
def ob9_rebalances(spark, sf):
    change = lambda side, sym: F.struct(F.lit(side).alias("side"), sym.alias("symbol"))
    changes = F.array(change("ADD", F.concat(F.lit("a"), "o_custkey")), change("remove", F.concat(F.lit("R"), F.col("o_custkey") % 50)), change("hold", F.lit("X")))
    payload = F.to_json(F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("announcement_date"), F.when(key() % 4 != 0, F.date_format(F.date_add("o_orderdate", 20), "yyyy-MM-dd")).alias("effective_date"), F.when(key() % 5 == 0, F.lit("[]")).alias("holdings"), changes.alias("changes")))
    return events.rebalances(_orders(spark, sf).select(F.lit("success").alias("status"), payload.alias("raw_payload")))


@query(
    r"""SELECT * FROM (SELECT page_id, trim(regexp_replace(regexp_replace(regexp_extract(html, '<h[1-4][^>]*>(.*?)</h[1-4]>', 1, 'is'), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS title, try_cast(nullif(regexp_extract(html, '\b([0-9]{4}-[0-9]{2}-[0-9]{2})\b', 1), '') AS DATE) AS event_date FROM pages) WHERE title <> ''"""
)
def ob11_page_events(spark, sf):
    return events.page_events(a.table(spark, sf, "pages"))


@query(
    """SELECT 'S' || s_suppkey AS symbol, CASE s_suppkey % 5 WHEN 0 THEN 'not_found' WHEN 1 THEN 'error' WHEN 2 THEN 'not_found' WHEN 3 THEN 'ambiguous' ELSE 'success' END AS status, CASE s_suppkey % 5 WHEN 0 THEN 'No identifier found.' WHEN 1 THEN 'Too many requests' WHEN 2 THEN 'no_openfigi_data' WHEN 3 THEN 'multiple_openfigi_matches' END AS error_message,
CASE WHEN s_suppkey % 5 > 2 THEN 'BBG' || s_suppkey END AS figi, CASE WHEN s_suppkey % 5 > 2 THEN 'CF' || s_suppkey END AS composite_figi, CASE WHEN s_suppkey % 5 > 2 THEN 'IS' || s_suppkey END AS isin, NULL::VARCHAR AS lei FROM supplier"""
)
def ob12_security_mappings(spark, sf):
    k = F.col("s_suppkey")
    item = F.to_json(F.struct(F.concat(F.lit("bbg"), k).alias("figi"), F.concat(F.lit("CF"), k).alias("compositeFigi"), F.concat(F.lit("IS"), k).alias("ID_ISIN")))
    error = lambda text: F.lit('{"error":"' + text + '"}')
    payload = F.when(k % 5 == 0, error("No identifier found.")).when(k % 5 == 1, error("Too many requests")).when(k % 5 == 2, F.lit('{"data":[]}')).when(k % 5 == 3, F.concat(F.lit('{"data":['), item, F.lit(","), item, F.lit("]}"))).otherwise(F.concat(F.lit('{"data":['), item, F.lit("]}")))
    return events.security_mappings(a.table(spark, sf, "supplier").select(F.concat(F.lit("S"), k).alias("symbol"), payload.alias("raw_payload"))).select("symbol", "status", "error_message", "figi", "composite_figi", "isin", "lei")


@query(
    """SELECT 'LEI' || p_partkey AS lei, p_name AS legal_name, CASE WHEN p_partkey % 2 = 0 THEN 'US' ELSE 'DE' END AS country, x || CASE WHEN p_partkey % 3 = 0 THEN ',US' || lpad(p_partkey::VARCHAR, 10, '0') ELSE '' END AS isins, CASE WHEN p_partkey % 3 = 0 THEN 2 ELSE 1 END::BIGINT AS n_isins FROM (SELECT *, 'DE' || lpad(p_partkey::VARCHAR, 10, '0') AS x FROM part)"""
)
def ob13_entity_records(spark, sf):
    k = F.col("p_partkey")
    isin = lambda prefix: F.concat(F.lit(prefix), F.lpad(k.cast("string"), 10, "0"))
    entity = F.struct(F.struct(F.col("p_name").alias("name")).alias("legalName"), F.when(k % 2 == 0, "US-DE").otherwise("DE").alias("jurisdiction"))
    nested = F.to_json(F.struct(F.struct(F.struct(F.concat(F.lit("LEI"), k).alias("lei"), entity.alias("entity")).alias("attributes")).alias("data"), F.array(isin("DE"), F.when(k % 3 == 0, isin("US")), isin("DE")).alias("included")))
    return events.entity_records(a.table(spark, sf, "part").select(nested.alias("raw_payload")))
