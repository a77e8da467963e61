"""Registered queries of names, provider symbols, entity attachment and its audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names
from ..operators import chain
from ..sources import adapters as a
from .queries import query

NAMES = "nm AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 3 THEN 'UNIT ' || c_custkey || ' AND SONS' ELSE 'UNIT ' || c_custkey END AS legal_name FROM customer)"


def _named(spark, sf):
    k = F.col("c_custkey")
    of = lambda before, after: F.concat(F.lit(before), k, F.lit(after))
    raw = F.when(k % 4 == 0, of("The Unit ", " Co Ltd")).when(k % 4 == 1, of("unit ", " N.V. NY Reg Shs")).when(k % 4 == 2, of("Unit-", " A/S Class B")).otherwise(of("Unit ", " & Sons Inc. Sponsored ADR"))
    return a.spread(a.table(spark, sf, "customer").select("c_custkey", raw.alias("raw")), "c_custkey")


@query("SELECT c_custkey, legal_name, false AS normalized_name_too_short, regexp_full_match(legal_name, '[A-Z0-9]{2,4}( [A-Z0-9]{2,4})*') AS normalized_name_acronym_only, false AS cjk_name_collapsed_to_latin_acronym, false AS distinctive_tokens_removed FROM nm", NAMES)
def sc20_legal_names(spark, sf):
    rows = _named(spark, sf).withColumn("legal_name", names.legal_name(F.col("raw")))
    return rows.select("c_custkey", "legal_name", *(c.alias(n) for n, c in names.name_flags(F.col("raw"), F.col("legal_name")).items()))


@query(
    """SELECT c_custkey, unnest(CASE c_custkey % 4 WHEN 0 THEN [u || c_custkey || z FOR z IN [' Company Limited', ' Company Ltd', ' Co Limited', ' Co Ltd']] || ['The ' || u || c_custkey || z FOR z IN [' Company Limited', ' Company Ltd', ' Co Limited', ' Co Ltd']] || [u || c_custkey]
WHEN 1 THEN [u || c_custkey || z FOR z IN [' Nv', ' N.V.', '']] WHEN 2 THEN [u || c_custkey || ' As', u || c_custkey] ELSE [u || c_custkey || ' And Sons' || z FOR z IN [' Inc', ' Incorporated', '']] END) AS search_name FROM (SELECT c_custkey, 'Unit ' AS u FROM customer)"""
)
def sc21_search_names(spark, sf):
    return _named(spark, sf).select("c_custkey", F.explode(names.search_names(F.col("raw"))).alias("search_name"))


@query(
    """SELECT s_suppkey, p - 1 AS place, l[p] AS candidate FROM (SELECT *, unnest(range(1, len(l) + 1)) AS p FROM (SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN ['Q' || s_suppkey] WHEN 1 THEN ['Q' || s_suppkey || x FOR x IN ['.DE', '.L', '.AS', '.PA', '.LS', '.CO', '.MI', '']] ELSE ['Q' || s_suppkey || '.TO'] END AS l FROM supplier))"""
)
def sc31_provider_symbols(spark, sf):
    k = F.col("s_suppkey")
    raw = F.concat(F.lit("q"), k, F.when(k % 3 == 2, ".to").otherwise(""))
    found = names.provider_symbols(raw, F.when(k % 3 == 0, "us").otherwise("eu"), F.when(k % 3 == 1, "etr"))
    return a.table(spark, sf, "supplier").select("s_suppkey", F.posexplode(found).alias("place", "candidate"))


LISTED = "ch AS (SELECT 'L' || c_custkey AS symbol, CASE WHEN c_custkey % 9 <> 0 THEN 'NAME' || (c_custkey % 997) ELSE '' END AS name_key, CASE WHEN c_nationkey % 10 <> 7 THEN 'C' || (c_nationkey % 3) END AS country, 'C' || (c_custkey % 3) || c_custkey AS isin FROM customer)"
FOUND = "ent AS (SELECT 'E' || p_partkey AS lei, 'NAME' || (p_partkey % 1500) AS name_key, CASE WHEN p_size % 4 = 0 THEN 'LAPSED' ELSE 'ACTIVE' END AS state, 'C' || (p_size % 3) AS legal_country, ['C' || (p_partkey % 3) || 'X', 'C' || (p_size % 3) || 'Y'] AS isins FROM part)"


def _listed(spark, sf):
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    return a.table(spark, sf, "customer").select(F.concat(F.lit("L"), k).alias("symbol"), F.when(k % 9 != 0, F.concat(F.lit("NAME"), k % 997)).otherwise("").alias("name_key"), F.when(n % 10 != 7, F.concat(F.lit("C"), n % 3)).alias("country"), F.concat(F.lit("C"), k % 3, k).alias("isin"))


def _found(spark, sf):
    k, s = F.col("p_partkey"), F.col("p_size")
    return a.table(spark, sf, "part").select(F.concat(F.lit("E"), k).alias("lei"), F.concat(F.lit("NAME"), k % 1500).alias("name_key"), F.when(s % 4 == 0, "LAPSED").otherwise("ACTIVE").alias("state"), F.concat(F.lit("C"), s % 3).alias("legal_country"), F.array(F.concat(F.lit("C"), k % 3, F.lit("X")), F.concat(F.lit("C"), s % 3, F.lit("Y"))).alias("isins"))


HAS = "len(list_filter(isins, lambda x: x[1:2] = country)) > 0"


@query(
    f""", f AS (SELECT symbol, count(DISTINCT lei) AS n, min(lei) AS lei FROM ch JOIN ent USING (name_key) WHERE {HAS} GROUP BY symbol)
SELECT symbol, CASE WHEN n = 1 THEN lei END AS entity_lei, coalesce(n, 0) AS n_matches, CASE WHEN n = 1 THEN 'lei_expansion' WHEN n > 1 THEN 'unattached_ambiguous' ELSE 'unattached' END AS entity_attach_method, CASE WHEN n = 1 THEN 'high' WHEN n > 1 THEN 'manual' END AS confidence FROM ch LEFT JOIN f USING (symbol)""",
    LISTED, FOUND,
)
def id7_expansion_matches(spark, sf):
    return chain.expansion_matches(_listed(spark, sf), _found(spark, sf).select("lei", "name_key", "isins"))


ANCHORS = f"""g AS (SELECT symbol, count(*) FILTER (state = 'ACTIVE') AS n1, count(*) FILTER (state = 'ACTIVE' AND legal_country = country) AS n2, count(DISTINCT lei) FILTER (state = 'ACTIVE' AND legal_country = country AND {HAS}) AS n3, min(lei) FILTER (state = 'ACTIVE' AND legal_country = country AND {HAS}) AS lei FROM ch JOIN ent USING (name_key) GROUP BY symbol),
anc AS (SELECT symbol, country, lei, CASE WHEN name_key = '' THEN 'no_listing_name_for_legal_name_search' WHEN coalesce(n1, 0) = 0 THEN 'legal_name_search_no_match' WHEN country IS NULL THEN 'missing_listing_country_for_isin_gate' WHEN n2 = 0 THEN 'legal_name_match_country_incompatible' WHEN n3 = 0 THEN 'gleif_lei_found_but_no_compatible_isin' WHEN n3 > 1 THEN 'legal_name_search_ambiguous' END AS reject_reason FROM ch LEFT JOIN g USING (symbol))"""


@query("SELECT symbol, CASE WHEN reject_reason IS NULL THEN lei END AS entity_lei, CASE WHEN reject_reason IS NULL THEN 'confirmed' WHEN reject_reason = 'legal_name_search_ambiguous' THEN 'ambiguous' ELSE 'rejected' END AS status, reject_reason FROM anc", LISTED, FOUND, ANCHORS)
def id8_name_anchors(spark, sf):
    return chain.name_anchors(_listed(spark, sf), _found(spark, sf))


@query("SELECT country, count(*) AS n, min(symbol) AS first_symbol FROM anc WHERE reject_reason IS NULL AND country IN ('C1', 'C2') GROUP BY country", LISTED, FOUND, ANCHORS)
def id21_anchor_audit(spark, sf):
    rows = chain.name_anchors(_listed(spark, sf), _found(spark, sf)).join(_listed(spark, sf).select("symbol", "country", "name_key"), "symbol")
    return chain.anchor_slices(rows, ("C1", "C2")).groupBy("country").agg(F.count("*").alias("n"), F.min("symbol").alias("first_symbol"))


RECORDS = "rec AS (SELECT 'C' || (c_custkey % 3) || c_custkey AS isin, 'E' || c_custkey AS lei, 'NAME' || (c_custkey % 997 + CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END) AS entity_name FROM customer WHERE c_custkey % 5 <> 0)"


def _records(spark, sf):
    k = F.col("c_custkey")
    return a.table(spark, sf, "customer").where(k % 5 != 0).select(F.concat(F.lit("C"), k % 3, k).alias("isin"), F.concat(F.lit("E"), k).alias("lei"), F.concat(F.lit("NAME"), k % 997 + F.when(k % 4 == 0, 1).otherwise(0)).alias("name_key"))


@query(
    """, d AS (SELECT o_custkey, 'D' || o_orderkey AS lei, o_orderpriority AS nm FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderstatus <> 'P' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
SELECT symbol, coalesce(d.lei, 'E' || c_custkey) AS entity_lei, coalesce(d.nm, c_name) AS entity_legal_name, CASE WHEN d.lei IS NULL THEN 'direct_isin' ELSE 'curated_identity' END AS entity_attach_method, CASE WHEN d.lei IS NOT NULL THEN 'reviewed_safe' END AS review_state
FROM (SELECT 'L' || c_custkey AS symbol, c_custkey, c_name FROM customer) LEFT JOIN d ON c_custkey = o_custkey""",
    "one AS (SELECT 1)",
)
def id10_curated_decisions(spark, sf):
    c = a.table(spark, sf, "customer").select(F.concat(F.lit("L"), "c_custkey").alias("symbol"), F.concat(F.lit("E"), "c_custkey").alias("entity_lei"), F.col("c_name").alias("entity_legal_name"), F.lit("direct_isin").alias("entity_attach_method"))
    o = F.col("o_orderkey")
    decisions = a.table(spark, sf, "orders").select(F.concat(F.lit("L"), "o_custkey").alias("symbol"), F.when(o % 3 != 0, F.concat(F.lit("D"), o)).alias("lei"), F.col("o_orderpriority").alias("legal_name"), F.when(F.col("o_orderstatus") == "P", "draft").when(F.col("o_orderstatus") == "F", "active").alias("lifecycle_state"), o.alias("seq"))
    return chain.curated(c, decisions)


GROUPED = "gr AS (SELECT 'L' || c_custkey AS symbol, CASE WHEN c_custkey % 3 = 0 THEN 'LEI' || (c_custkey % 40) END AS lei, CASE WHEN c_custkey % 5 <> 0 THEN 'NAME' || (c_custkey % 70) END AS name_key FROM customer), pr AS (SELECT 'L' || c_custkey AS l, 'L' || (c_custkey + 20) AS r FROM customer WHERE c_custkey % 10 = 1)"


@query(
    """, e AS (SELECT DISTINCT x.symbol, y.symbol AS other FROM gr x JOIN gr y ON x.lei = y.lei UNION SELECT x.symbol, y.symbol FROM gr x JOIN gr y ON x.name_key = y.name_key UNION SELECT l, r FROM pr WHERE r IN (SELECT symbol FROM gr) UNION SELECT r, l FROM pr WHERE r IN (SELECT symbol FROM gr) UNION SELECT symbol, symbol FROM gr)
SELECT symbol, CASE WHEN count(*) > 1 THEN 'multi_listing_candidate' ELSE 'single_listing' END AS listing_group_kind, count(*) AS group_size, min(other) AS group_first_symbol FROM e GROUP BY symbol""",
    GROUPED,
)
def id11_group_profile(spark, sf):
    k = F.col("c_custkey")
    c = a.table(spark, sf, "customer")
    rows = c.select(F.concat(F.lit("L"), k).alias("symbol"), F.when(k % 3 == 0, F.concat(F.lit("LEI"), k % 40)).alias("lei"), F.when(k % 5 != 0, F.concat(F.lit("NAME"), k % 70)).alias("name_key"))
    return chain.group_profile(rows, c.where(k % 10 == 1).select(F.concat(F.lit("L"), k).alias("left"), F.concat(F.lit("L"), k + 20).alias("right")))


@query(
    """, r AS (SELECT symbol, list_filter([CASE WHEN k % 4 = 0 THEN 'openfigi_not_found' END, CASE k % 5 WHEN 0 THEN 'legal_name_search_no_match' WHEN 1 THEN 'legal_name_search_ambiguous' END, CASE WHEN k % 7 = 0 THEN 'no_compatible_expanded_isin_for_listing_country' END, CASE k % 6 WHEN 0 THEN 'valid_isin_no_gleif_lei' WHEN 1 THEN 'yfinance_isin_suspect' WHEN 2 THEN 'provider_isin_missing' WHEN 3 THEN 'provider_isin_error' END], lambda x: x IS NOT NULL) AS l FROM (SELECT 'L' || c_custkey AS symbol, c_custkey AS k FROM customer)),
n AS (SELECT symbol, CASE WHEN len(l) = 0 THEN ['needs_manual_review'] ELSE l END AS l FROM r)
SELECT symbol, array_to_string(l, ',') AS reasons, CASE """
    + " ".join(f"WHEN list_contains(l, '{r}') THEN '{r}'" for r in chain.REASONS)
    + " ELSE l[1] END AS primary_reason, CASE WHEN list_has_any(l, ['legal_name_search_ambiguous', 'needs_manual_review']) THEN 'needs_manual_review' WHEN list_has_any(l, ['valid_isin_no_gleif_lei', 'no_compatible_expanded_isin_for_listing_country']) THEN 'requires_provider_or_curated_identity' ELSE 'fixable_free' END AS decision_bucket FROM n",
    "one AS (SELECT 1)",
)
def id12_unattached_reasons(spark, sf):
    k = F.col("c_custkey")
    isin = F.when(k % 6 == 0, "success").when(k % 6 == 1, "suspect").when(k % 6 == 2, "not_found").when(k % 6 == 3, "error").otherwise("success")
    rows = a.table(spark, sf, "customer").select(
        F.concat(F.lit("L"), k).alias("symbol"), F.when(k % 4 == 0, "not_found").otherwise("success").alias("mapping_status"), F.when(k % 5 == 0, "legal_name_search_no_match").when(k % 5 == 1, "legal_name_search_ambiguous").alias("name_reject"),
        F.when(k % 7 == 0, "no_compatible_expanded_isin_for_listing_country").alias("gate_reject"), F.lit("").alias("direct_reject"), isin.alias("isin_status"), F.when(k % 6 > 3, "E").alias("direct_lei"))
    return chain.unattached_reasons(rows)


@query(
    """, att AS (SELECT 'L' || c_custkey AS symbol, c_custkey AS k, 'E' || (c_custkey % 90) AS entity_lei, CASE WHEN c_custkey % 2 = 0 THEN 'AB ' || (c_custkey % 90 % 10) ELSE 'LONGER NAME ' || (c_custkey % 90) END AS nm FROM customer WHERE c_custkey % 4 <> 0),
cf AS (SELECT entity_lei, count(DISTINCT nm) > 1 AS c FROM att GROUP BY ALL)
SELECT symbol, k % 2 = 0 AS name_risk, c AS entity_conflict, CASE WHEN k % 10 = 3 THEN 'reviewed_safe' WHEN k % 2 = 0 OR c THEN 'needs_review' ELSE 'machine_safe' END AS audit_state FROM att JOIN cf USING (entity_lei)""",
    "one AS (SELECT 1)",
)
def id13_attach_audit(spark, sf):
    return _audit(spark, sf)


def _audit(spark, sf):
    k = F.col("c_custkey")
    rows = a.table(spark, sf, "customer").select(F.concat(F.lit("L"), k).alias("symbol"), F.concat(F.lit("E"), k % 90).alias("entity_lei"), F.when(k % 2 == 0, F.concat(F.lit("Ab "), k % 90 % 10, F.lit(" Inc"))).otherwise(F.concat(F.lit("Longer Name "), k % 90, F.lit(" PLC"))).alias("name"), F.when(k % 4 == 0, "direct_isin").otherwise("name_anchor_confirmed").alias("method"), (k % 10 == 3).alias("reviewed"))
    return chain.attach_audit(rows)


@query("SELECT count(*) AS n, count(*) FILTER (c_custkey % 2 = 0 AND c_custkey % 10 <> 3) AS n_needs_review, count(*) FILTER (c_custkey % 10 = 3) AS n_reviewed, count(*) FILTER (c_custkey % 2 = 0) = 0 AS publishable FROM customer WHERE c_custkey % 4 <> 0")
def id13_publication_gate(spark, sf):
    return chain.publication_gate(_audit(spark, sf))


@query(
    """, s AS (SELECT 'S' || s_suppkey AS symbol, s_suppkey AS k, CASE WHEN s_suppkey % 4 <> 0 THEN 'E' || (s_suppkey // 3) END AS lei FROM supplier), p AS (SELECT k, 'S' || k AS "left", 'S' || (k + 1) AS "right" FROM s)
SELECT p."left", p."right", 'cross_listing' AS pair_type, coalesce(x.lei = y.lei, false) AS "grouped", CASE WHEN x.lei = y.lei THEN CASE WHEN x.k % 5 = 0 OR y.k % 5 = 0 THEN 'direct_anchor_plus_lei_expansion' ELSE 'direct_lei' END ELSE '' END AS grouping_path,
CASE WHEN x.lei = y.lei THEN '' WHEN y.symbol IS NULL THEN 'symbol_missing_from_measurement' WHEN x.lei IS NOT NULL AND y.lei IS NOT NULL THEN 'different_lei' WHEN x.k % 6 <> 0 AND y.k % 6 <> 0 THEN 'no_valid_anchor_isin' WHEN x.k % 7 = 0 OR y.k % 7 = 0 THEN 'missing_isin_or_anchor' ELSE 'missing_lei' END AS not_grouped_reason FROM p JOIN s x ON p."left" = x.symbol LEFT JOIN s y ON p."right" = y.symbol""",
    "one AS (SELECT 1)",
)
def id17_pair_report(spark, sf):
    k = F.col("s_suppkey")
    s = a.table(spark, sf, "supplier")
    rows = s.select(F.concat(F.lit("S"), k).alias("symbol"), F.when(k % 4 != 0, F.concat(F.lit("E"), F.floor(k / 3))).alias("entity_lei"), F.when(k % 6 == 0, "E").alias("direct_lei"), F.when(k % 7 != 0, "I").alias("isin"), F.when(k % 5 == 0, "lei_expansion").otherwise("direct_isin").alias("method"))
    return chain.pair_report(s.select(F.concat(F.lit("S"), k).alias("left"), F.concat(F.lit("S"), k + 1).alias("right"), F.lit("cross_listing").alias("pair_type")), rows)


@query(
    """, q AS (SELECT 'C' || o_custkey AS symbol, o_orderkey AS variant, CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus END AS status FROM orders)
SELECT symbol, variant, coalesce(status, 'cache_miss') AS status FROM q QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY status IS NOT NULL DESC, variant) = 1""",
    "one AS (SELECT 1)",
)
def id19_cached_facts(spark, sf):
    o = a.table(spark, sf, "orders").select(F.concat(F.lit("C"), "o_custkey").alias("symbol"), F.col("o_orderkey").alias("variant"), F.col("o_orderstatus").alias("status"))
    return chain.cached_facts(o.select("symbol", "variant"), o.where("variant % 4 = 0"), ["symbol"])


@query(
    """, ki AS (SELECT isin, lei, CASE WHEN substr(lei, 2)::BIGINT % 7 = 0 THEN 'error' ELSE 'success' END AS status FROM rec), kl AS (SELECT 'E' || p_partkey AS lei FROM part WHERE p_partkey % 2 = 0)
SELECT 'isin' AS kind, isin AS id, 'listing' AS origin FROM ch WHERE isin NOT IN (SELECT isin FROM ki WHERE status = 'success')
UNION ALL SELECT 'lei', lei, CASE WHEN min(o) = 0 THEN 'direct_anchor' ELSE 'legal_name_candidate' END FROM (SELECT lei, 0 AS o FROM ki UNION ALL SELECT lei, 1 FROM ent) WHERE lei NOT IN (SELECT lei FROM kl) GROUP BY lei""",
    LISTED, FOUND, RECORDS,
)
def id20_lookup_work(spark, sf):
    status = F.when(F.substring("lei", 2, 20).cast("long") % 7 == 0, "error").otherwise("success")
    leis = a.table(spark, sf, "part").where("p_partkey % 2 = 0").select(F.concat(F.lit("E"), "p_partkey").alias("lei"), F.lit("success").alias("status"))
    return chain.lookup_work(_listed(spark, sf).select("isin"), _records(spark, sf).select("isin", "lei", status.alias("status")), _found(spark, sf).select("lei"), leis)
