"""Registered queries of the publication plan and of events that pages embed."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import events, publication
from .gap_queries import COUNTRIES_SQL
from .queries import query
from .universe_queries import raw, raw_sql

_K = "c_custkey"
MEASURED = {
    "symbol": f"concat('S', {_K})", "entity_lei": f"CASE WHEN {_K} % 3 = 0 THEN concat('LEI', {_K} % 200) WHEN {_K} % 11 = 1 THEN ' ' END", "lei": f"CASE WHEN {_K} % 17 = 4 THEN concat('LEI', {_K} % 50) END",
    "entity_attach_method": f"CASE {_K} % 5 WHEN 0 THEN 'direct_isin' WHEN 1 THEN 'name_anchor_confirmed' WHEN 2 THEN 'curated' WHEN 3 THEN 'lei_expansion' END", "attachment_confidence": f"CASE WHEN {_K} % 13 = 0 THEN 'medium' WHEN {_K} % 13 = 3 THEN 'unknown' END",
    "candidate_legal_name": f"CASE WHEN {_K} % 4 <> 0 THEN c_name END", "legal_name": f"CASE WHEN {_K} % 8 = 0 THEN concat(c_name, ' Inc') END", "openfigi_name": f"CASE WHEN {_K} % 16 = 4 THEN upper(c_name) END", "internal_candidate_name": "c_mktsegment",
    "candidate_legal_country": f"CASE {_K} % 6 WHEN 0 THEN 'de' WHEN 1 THEN 'US' WHEN 2 THEN 'Germany' END", "home_country": f"CASE WHEN {_K} % 6 = 3 THEN 'gb' END", "candidate_lei": f"CASE WHEN {_K} % 7 < 2 THEN concat('CAND', {_K}) END",
    "foreign_issuer_candidate_lei": f"CASE WHEN {_K} % 7 = 2 THEN concat('LEI', {_K} % 40) END", "foreign_issuer_candidate_legal_name": "upper(c_name)", "listing_group_kind": f"CASE WHEN {_K} % 2 = 0 THEN 'single_listing' ELSE 'multi_listing' END",
    "decision_bucket": "CASE WHEN c_acctbal > 2000 THEN 'needs_manual_review' ELSE 'wait' END", "entity_attach_reason": f"CASE WHEN {_K} % 9 < 4 THEN c_mktsegment END", "country": f"CASE {_K} % 4 WHEN 0 THEN 'DE' WHEN 1 THEN 'us' WHEN 2 THEN 'GB' END",
    "currency": f"CASE WHEN {_K} % 5 < 3 THEN 'EUR' END", "exchange_mic": f"CASE WHEN {_K} % 10 < 6 THEN 'XETR' END", "security_type": f"CASE WHEN {_K} % 12 = 0 THEN 'adr' ELSE 'Common' END", "has_prices": f"{_K} % 5 <> 1", "has_technicals": "c_acctbal > 0", "seq": f"-{_K}",
}
AUDIT = {"symbol": "concat('S', s_suppkey)", "entity_id": "concat('lei:LEI', s_suppkey % 50)", "candidate_lei": "CASE WHEN s_suppkey % 2 = 0 THEN concat('LEI', s_suppkey) END", "attach_method": "'name_anchor_confirmed'", "review_status": "CASE s_suppkey % 3 WHEN 0 THEN 'machine_verifiably_safe' WHEN 1 THEN 'needs_review' END", "review_reason": "CASE WHEN s_suppkey % 4 = 0 THEN 'short_name' END"}
HOMES = {"lei": "concat('lei', s_suppkey % 100)", "home_country": "CASE WHEN s_nationkey < 8 THEN 'JP' WHEN s_nationkey < 16 THEN 'US' ELSE '' END", "seq": "s_suppkey"}
_METHODS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in publication.METHOD_CONFIDENCE.items())


def _text(c: str) -> str:
    return f"nullif(trim({c}), '')"


def _score(c: str) -> str:
    return f"CASE {c} {' '.join(f'WHEN {chr(39)}{k}{chr(39)} THEN {v}::DOUBLE' for k, v in publication.SCORES.items())} ELSE 0::DOUBLE END"


PLAN = f"""k AS (SELECT *, coalesce({_text("entity_lei")}, {_text("lei")}) AS own, coalesce({_text("candidate_lei")}, {_text("foreign_issuer_candidate_lei")}) AS cand FROM m),
s AS (SELECT *, CASE WHEN own IS NOT NULL THEN 'resolved' WHEN listing_group_kind = 'single_listing' AND cand IS NOT NULL THEN 'provisional' WHEN decision_bucket = 'needs_manual_review' THEN 'needs_manual_review' END AS state FROM k),
l AS (SELECT *, CASE state WHEN 'resolved' THEN 'lei:' || own ELSE 'provisional:' || symbol END AS entity_id, CASE state WHEN 'resolved' THEN coalesce({_text("attachment_confidence")}, CASE entity_attach_method {_METHODS} END, 'low') ELSE 'provisional' END AS conf,
 CASE state WHEN 'resolved' THEN coalesce({_text("candidate_legal_name")}, {_text("legal_name")}) ELSE coalesce({_text("candidate_legal_name")}, {_text("foreign_issuer_candidate_legal_name")}) END AS name,
 upper(CASE state WHEN 'resolved' THEN coalesce({_text("candidate_legal_country")}, {_text("home_country")}) ELSE {_text("candidate_legal_country")} END) AS place FROM s WHERE state IN ('resolved', 'provisional')),
h AS (SELECT upper(lei) AS hl, arg_max(home_country, seq) AS hc FROM home GROUP BY ALL),
first AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY seq, symbol) = 1),
e AS (SELECT entity_id, name AS legal_name, coalesce(name, {_text("openfigi_name")}, {_text("internal_candidate_name")}) AS display_name, coalesce(own, cand) AS lei, state AS resolution_status, coalesce(CASE WHEN regexp_full_match(place, '[A-Z]{{2}}') THEN place END, nullif(hc, '')) AS home_country, {_score("conf")} AS resolution_confidence FROM first LEFT JOIN h ON upper(coalesce(own, cand)) = hl),
c AS (SELECT l.*, coalesce(has_prices AND has_technicals, false) AS whole, coalesce(upper({_text("l.country")}) = e.home_country, false) AS near FROM l JOIN e USING (entity_id)),
p AS (SELECT entity_id, symbol AS primary_listing_symbol, CASE WHEN (CASE WHEN whole THEN nc ELSE n END) = 1 THEN CASE WHEN whole THEN 'only_complete_listing' ELSE 'only_available_listing' END WHEN near THEN CASE WHEN whole THEN 'complete_home_listing' ELSE 'home_listing' END WHEN whole THEN 'deterministic_complete_listing' ELSE 'deterministic_available_listing' END AS primary_listing_reason
 FROM (SELECT *, count(*) OVER w AS n, count(*) FILTER (whole) OVER w AS nc, row_number() OVER (PARTITION BY entity_id ORDER BY whole DESC, near DESC, contains(upper(coalesce(security_type, '')), 'ADR'), exchange_mic IS NULL, currency IS NULL, symbol) AS rn FROM c WINDOW w AS (PARTITION BY entity_id)) WHERE rn = 1)"""
_CTES = (raw_sql("m", "customer", MEASURED), raw_sql("audit", "supplier", AUDIT), raw_sql("home", "supplier", HOMES), COUNTRIES_SQL, PLAN)


def _plan(spark, sf):
    homes = raw(spark, sf, "supplier", HOMES).groupBy("lei").agg(F.max_by("home_country", "seq").alias("home_country"))
    return publication.publication_plan(raw(spark, sf, "customer", MEASURED), raw(spark, sf, "supplier", AUDIT), homes)


@query("SELECT e.*, CASE WHEN home_country IS NOT NULL THEN coalesce((SELECT v FROM zones WHERE k = home_country), 'OTHER') END AS home_region, primary_listing_symbol, primary_listing_reason FROM e JOIN p USING (entity_id)", *_CTES)
def id14_entity_master(spark, sf):
    return _plan(spark, sf)[0]


@query(
    f"""SELECT symbol, entity_id, coalesce(own, {_text("candidate_lei")}) AS lei, state AS resolution_status, CASE state WHEN 'resolved' THEN coalesce(entity_attach_method, '') ELSE 'provisional_single_listing_candidate' END AS attach_method, conf AS attach_confidence, {_score("conf")} AS resolution_confidence,
 symbol = primary_listing_symbol AS is_primary_listing, CASE WHEN symbol = primary_listing_symbol THEN primary_listing_reason END AS primary_listing_reason FROM l JOIN p USING (entity_id)""",
    *_CTES,
)
def id14_entity_listings(spark, sf):
    return _plan(spark, sf)[1]


@query(
    f"""SELECT symbol, NULL AS entity_id, cand AS candidate_lei, {_text("entity_attach_method")} AS attach_method, coalesce({_text("entity_attach_reason")}, decision_bucket) AS review_reason FROM s WHERE state = 'needs_manual_review'
UNION ALL SELECT symbol, entity_id, candidate_lei, attach_method, coalesce(review_reason, 'heuristic_attach_requires_review') FROM audit WHERE review_status IS DISTINCT FROM 'machine_verifiably_safe'""",
    *_CTES,
)
def id14_identity_reviews(spark, sf):
    return _plan(spark, sf)[2]


_P = "page_id"
PAGE = {
    "page_id": _P,
    "html": f"""CASE WHEN {_P} % 3 = 0 THEN concat(html, '<script type="text/javascript">var broken = {{oops; var data = {{"items": [{{"EventId": ', {_P} * 7, ', "Title": " Call ', {_P}, ' ", "StartDate": "2024-03-0', {_P} % 9 + 1, ' 10:00:00", "Attachments": [{{"Url": "/a/', {_P}, '"}}, "/b"]}}, {{"EventTitle": "Day", "StartDate": "soon"}}, {{"EventId": "x"}}]}};</script>') ELSE html END""",
}


@query(
    r"""SELECT page_id, coalesce(x->>'$.EventId', '') AS provider_event_id, trim(coalesce(x->>'$.Title', x->>'$.EventTitle')) AS title, try_cast(x->>'$.StartDate' AS TIMESTAMP) AS starts_at, coalesce(array_to_string(list_transform(CAST(x->'$.Attachments' AS JSON[]), lambda u: coalesce(u->>'$.Url', u->>'$')), ','), '') AS attachments, 'high' AS confidence
FROM (SELECT page_id, unnest(CAST(regexp_extract(html, 'var data = (\{.*\});</script>', 1)::JSON->'$.items' AS JSON[])) AS x FROM pg WHERE contains(html, '<script type="text/javascript">var broken')) WHERE coalesce(x->>'$.Title', x->>'$.EventTitle') IS NOT NULL
UNION ALL SELECT page_id, '', title, try_cast(nullif(d, '') AS DATE)::TIMESTAMP, '', 'low' FROM (SELECT page_id, trim(regexp_replace(regexp_replace(regexp_extract(html, '<h[1-4][^>]*>(.*?)</h[1-4]>', 1, 'is'), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS title, regexp_extract(html, '\b([0-9]{4}-[0-9]{2}-[0-9]{2})\b', 1) AS d FROM pg WHERE NOT contains(coalesce(html, ''), 'var broken')) WHERE title <> ''""",
    raw_sql("pg", "pages", PAGE),
)
def ob11_embedded_events(spark, sf):
    found = events.embedded_events(raw(spark, sf, "pages", PAGE))
    return found.select("page_id", F.coalesce("provider_event_id", F.lit("")).alias("provider_event_id"), "title", "starts_at", F.coalesce(F.array_join("attachment_urls", ","), F.lit("")).alias("attachments"), "confidence")
