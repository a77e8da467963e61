"""Registered queries of tables, payloads, identifiers and entities."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import symbols
from ..operators import identity, observations
from ..sources import adapters as a
from ..sources import tables
from .queries import query

OLD_NEW = "old AS (SELECT o_custkey AS k, o_orderkey AS seq, o_totalprice AS v, o_orderstatus AS s FROM orders WHERE o_orderkey % 3 <> 0), new AS (SELECT o_custkey AS k, o_orderkey AS seq, -o_totalprice AS v, o_orderstatus AS s FROM orders WHERE o_orderkey % 3 = 0)"


def _old_new(spark, sf):
    rows = a.table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("seq"), F.col("o_totalprice").alias("v"), F.col("o_orderstatus").alias("s"))
    return rows.where("seq % 3 <> 0"), rows.where("seq % 3 = 0").withColumn("v", -F.col("v"))


@query("SELECT k, seq, v, s FROM (SELECT *, 0 AS n FROM old UNION ALL SELECT *, 1 FROM new) QUALIFY row_number() OVER (PARTITION BY k ORDER BY n DESC, seq DESC) = 1", OLD_NEW)
def sk1_keyed_append(spark, sf):
    return tables.keyed_append(*_old_new(spark, sf), ["k"], ["seq"])


@query(
    """, o AS (SELECT * FROM old QUALIFY row_number() OVER (PARTITION BY k ORDER BY seq DESC) = 1), n AS (SELECT * FROM new QUALIFY row_number() OVER (PARTITION BY k ORDER BY seq DESC) = 1)
SELECT k, CASE WHEN n.k IS NOT NULL THEN n.v ELSE o.v END AS v, coalesce(o.s, n.s) AS s, o.seq AS seq FROM o FULL JOIN n USING (k)""",
    OLD_NEW,
)
def sk3_upsert(spark, sf):
    old, new = (tables.latest_by_key(df, ["k"], "seq") for df in _old_new(spark, sf))
    return tables.upsert(old, new.drop("seq"), ["k"], keep_existing=["s"])


@query("SELECT * FROM old WHERE k NOT IN (SELECT k FROM new WHERE s = 'F') UNION ALL SELECT * FROM new WHERE s = 'F'", OLD_NEW)
def sk6_replaced_slice(spark, sf):
    old, new = _old_new(spark, sf)
    fresh = new.where("s = 'F'")
    return tables.replace_slice(old, fresh, fresh, ["k"])


@query("SELECT DISTINCT o_orderdate::DATE AS date FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1997-03-01' AND DATE '1999-03-01'")
def sr2_dates(spark, sf):
    return tables.scan_dates(a.table(spark, sf, "orders"), "o_orderdate", "1997-03-01", "1999-03-01")


@query("SELECT DISTINCT o_custkey, o_orderdate::DATE AS date FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1997-03-01' AND DATE '1999-03-01' AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def sr3_pairs(spark, sf):
    keys = a.table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return tables.scan_pairs(a.table(spark, sf, "orders"), "o_custkey", "o_orderdate", keys, "1997-03-01", "1999-03-01")


def _payloads(o):
    """Orders as payloads of three shapes: a list, a list under a key, a single object."""
    split = F.col("o_orderkey") % 10 == 0
    item = F.to_json(F.struct(F.when(F.col("o_orderkey") % 20 != 1, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("exDate"), F.when(~split, F.col("o_totalprice")).alias("amount"), F.when(split, F.concat((F.col("o_custkey") % 4 + 1).cast("string"), F.lit(":2"))).alias("ratio")))
    shape = F.col("o_orderkey") % 3
    payload = F.when(shape == 0, F.concat(F.lit("["), item, F.lit(","), item, F.lit("]"))).when(shape == 1, F.concat(F.lit('{"data":['), item, F.lit("]}"))).otherwise(item)
    return o.select(F.lit("p").alias("provider"), F.concat(F.lit("C"), "o_custkey").alias("symbol"), F.when(F.col("o_orderstatus") == "P", "error").otherwise("success").alias("status"), payload.alias("raw_payload"))


@query("SELECT DISTINCT 'p' AS provider, 'C' || o_custkey AS symbol, CASE WHEN o_orderkey % 10 = 0 THEN 'split' ELSE 'dividend' END AS action, o_orderdate::DATE AS ex_date, CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS amount, CASE WHEN o_orderkey % 10 = 0 THEN (o_custkey % 4 + 1) / 2 END AS factor FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 20 <> 1")
def ob1_corporate_actions(spark, sf):
    return observations.corporate_actions(_payloads(a.table(spark, sf, "orders"))).drop("observation_id")


FILED = "filed AS (SELECT 'C' || o_custkey AS symbol, o_orderkey::VARCHAR AS accession, o_orderpriority AS form, o_orderdate::DATE AS filing_date FROM orders)"


def _filings(spark, sf):
    o = a.table(spark, sf, "orders").groupBy(F.concat(F.lit("C"), "o_custkey").alias("symbol")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority", "o_orderdate"))).alias("x"))
    arrays = F.struct(F.transform("x", lambda r: r["o_orderkey"].cast("string")).alias("accessionNumber"), F.transform("x", lambda r: r["o_orderpriority"]).alias("form"), F.transform("x", lambda r: F.date_format(r["o_orderdate"], "yyyy-MM-dd")).alias("filingDate"))
    return observations.filings(o.select("symbol", F.lit("success").alias("status"), F.to_json(F.struct(F.struct(arrays.alias("recent")).alias("filings"))).alias("raw_payload")))


@query("SELECT * FROM filed", FILED)
def ob3_filings(spark, sf):
    return _filings(spark, sf)


@query("SELECT form, count(*) AS n, min(filing_date) AS first_date, max(filing_date) AS last_date FROM filed GROUP BY form", FILED)
def ob3_form_counts(spark, sf):
    return observations.form_counts(_filings(spark, sf))


SIGNALS = ("apache license", "token", "secret", "copyright")


@query("SELECT doc_id, CASE " + " ".join(f"WHEN contains(lower(text), '{s}') THEN '{s}'" for s in SIGNALS) + " END AS signal FROM documents WHERE " + " OR ".join(f"contains(lower(text), '{s}')" for s in SIGNALS))
def ob6_signal_candidates(spark, sf):
    return observations.signal_candidates(a.table(spark, sf, "documents").select("doc_id", "text"), SIGNALS).select("doc_id", "signal")


@query("SELECT 'C' || o_custkey AS symbol, CASE WHEN bool_or(o_orderpriority = '5-LOW') THEN 'skipped' WHEN bool_and(o_orderstatus IN ('P', 'O')) THEN 'unresolved' ELSE 'resolved' END AS outcome, count(*) AS n FROM orders GROUP BY ALL")
def ob10_outcomes(spark, sf):
    status = F.when(F.col("o_orderpriority") == "5-LOW", "skipped").when(F.col("o_orderstatus") == "P", "error").when(F.col("o_orderstatus") == "O", "not_found").otherwise("success")
    return observations.outcomes(a.table(spark, sf, "orders").select(F.concat(F.lit("C"), "o_custkey").alias("symbol"), status.alias("status")))


@query(
    """SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN lpad((s_suppkey % 1000)::VARCHAR, 4, '0') || '.HK' WHEN 1 THEN 'S' || s_suppkey || '.L' WHEN 2 THEN 'S' || s_suppkey || '-A' WHEN 3 THEN '600' || lpad((s_suppkey % 1000)::VARCHAR, 3, '0') || '.SS' ELSE 'S' || s_suppkey END AS listing,
CASE s_suppkey % 5 WHEN 0 THEN 'HK' WHEN 1 THEN 'GB' WHEN 3 THEN 'CN' END AS country FROM supplier"""
)
def sc1_listing_symbols(spark, sf):
    k = F.col("s_suppkey")
    low = F.lpad((k % 1000).cast("string"), 3, "0")
    raw = F.when(k % 5 == 0, F.concat(k % 1000, F.lit("  hk"))).when(k % 5 == 1, F.concat(F.lit(" s"), k, F.lit(" ln"))).when(k % 5 == 2, F.concat(F.lit("s"), k, F.lit("/a"))).when(k % 5 == 3, F.concat(F.lit("600"), low)).otherwise(F.concat(F.lit("s"), k))
    return a.table(spark, sf, "supplier").select("s_suppkey", symbols.listing_symbol(raw).alias("listing"), symbols.country_of(raw).alias("country"))


LISTINGS = """listings AS (SELECT 'L' || c_custkey AS symbol, CASE WHEN c_custkey % 3 = 0 THEN 'LEI' || (c_custkey % 40) END AS lei, CASE WHEN c_custkey % 2 = 0 THEN 'IS' || (c_custkey % 70) END AS isin, CASE WHEN c_nationkey < 8 THEN 'US' ELSE 'N' || c_nationkey END AS country, CASE WHEN c_custkey % 11 = 0 THEN 'N3' END AS home_country,
 c_mktsegment AS name, CASE WHEN c_custkey % 4 <> 0 THEN 'M' || (c_custkey % 5) END AS mic, CASE WHEN c_custkey % 7 <> 0 THEN 'USD' END AS currency FROM customer)"""


def _listings(spark, sf):
    k = F.col("c_custkey")
    has = lambda c, x: F.when(c, x)
    return a.table(spark, sf, "customer").select(
        F.concat(F.lit("L"), k).alias("symbol"), F.lit(None).cast("string").alias("legal_entity_id"), has(k % 3 == 0, F.concat(F.lit("LEI"), k % 40)).alias("lei"), has(k % 2 == 0, F.concat(F.lit("IS"), k % 70)).alias("isin"),
        F.when(F.col("c_nationkey") < 8, "US").otherwise(F.concat(F.lit("N"), "c_nationkey")).alias("country"), has(k % 11 == 0, F.lit("N3")).alias("home_country"), F.col("c_mktsegment").alias("name"),
        has(k % 4 != 0, F.concat(F.lit("M"), k % 5)).alias("mic"), has(k % 7 != 0, F.lit("USD")).alias("currency"))


KEYED = "keyed AS (SELECT *, CASE WHEN lei IS NOT NULL THEN 'lei' WHEN isin IS NOT NULL THEN 'isin' END AS key_kind, coalesce(lei, isin) AS key FROM listings WHERE coalesce(lei, isin) IS NOT NULL)"


@query(
    """SELECT key_kind, key, count(*) AS n_listings, count(DISTINCT country) AS n_countries, coalesce(arg_min(home_country, symbol) FILTER (home_country IS NOT NULL), min(country) FILTER (country <> 'US'), min(country)) AS home_country, count(DISTINCT name) AS n_names, min(symbol) AS first_symbol,
'ofg_' || substr(sha1(key_kind || ':' || key), 1, 16) AS entity_id, CASE key_kind WHEN 'lei' THEN 0.98 ELSE 0.9 END::DOUBLE AS confidence, count(DISTINCT name) > 1 AS conflict FROM keyed GROUP BY key_kind, key""",
    LISTINGS, KEYED,
)
def id3_entities(spark, sf):
    return identity.entities(_listings(spark, sf))


@query("SELECT 'name' AS kind, name AS bucket, count(DISTINCT symbol) AS n_symbols FROM listings WHERE lei IS NULL AND isin IS NULL GROUP BY name HAVING count(DISTINCT symbol) >= 2", LISTINGS)
def id4_unresolved_suggestions(spark, sf):
    return identity.unresolved_suggestions(_listings(spark, sf))


@query(
    """SELECT key, symbol, CASE WHEN n = 1 THEN 'only_listing' WHEN c AND h THEN 'complete_home_listing' WHEN c THEN 'complete_listing' WHEN h THEN 'home_listing' ELSE 'first_symbol' END AS reason
FROM (SELECT *, count(*) OVER (PARTITION BY key) AS n, mic IS NOT NULL AND currency IS NOT NULL AS c, coalesce(country = home_country, false) AS h FROM keyed) QUALIFY row_number() OVER (PARTITION BY key ORDER BY c DESC, h DESC, mic NULLS LAST, currency NULLS LAST, symbol) = 1""",
    LISTINGS, KEYED,
)
def id5_primary_listings(spark, sf):
    return identity.primary_listings(_listings(spark, sf).withColumn("key", F.coalesce("lei", "isin")).where("key IS NOT NULL"), "key")


@query(
    """SELECT symbol, arg_min(name, o) FILTER (name IS NOT NULL) AS name, arg_min(country, o) FILTER (country IS NOT NULL) AS country, array_to_string(list_sort(list(DISTINCT src)), ',') AS sources FROM (
SELECT 'K' || s_suppkey AS symbol, s_name AS name, NULL AS country, 0 AS o, 'registry' AS src FROM supplier UNION ALL SELECT 'K' || c_custkey, CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_name END, 'N' || c_nationkey, 1, 'holdings' FROM customer) GROUP BY symbol"""
)
def id1_merged_candidates(spark, sf):
    reg = a.table(spark, sf, "supplier").select(F.concat(F.lit("K"), "s_suppkey").alias("symbol"), F.col("s_name").alias("name"))
    own = a.table(spark, sf, "customer").select(F.concat(F.lit("K"), "c_custkey").alias("symbol"), F.when(F.col("c_custkey") % 2 == 0, " ").otherwise(F.col("c_name")).alias("name"), F.concat(F.lit("N"), "c_nationkey").alias("country"))
    return identity.merged_candidates({"registry": reg, "holdings": own}, ("name", "country"))


@query("SELECT count(*) AS n, count(lei) AS n_lei, round(count(lei) / count(*), 6) AS lei_rate, count(isin) AS n_isin, round(count(isin) / count(*), 6) AS isin_rate, 0::BIGINT AS n_none, 0::DOUBLE AS none_rate FROM listings", LISTINGS)
def id18_measures(spark, sf):
    return identity.measures(_listings(spark, sf), {"lei": "lei IS NOT NULL", "isin": "isin IS NOT NULL", "none": "symbol IS NULL"})


UNIVERSE = "uni AS (SELECT *, CASE WHEN status <> 'active' THEN 'inactive' WHEN promotion_status NOT LIKE 'validated%' THEN 'not_promoted' WHEN nation % 6 = 0 THEN 'market_unsupported' WHEN nation >= 12 THEN 'other_region' END AS exclusion FROM registry QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY balance) = 1)"


def _universe(spark, sf):
    rows = a.registry(spark, sf).select("ticker", "status", "promotion_status", (F.col("nation") % 6 != 0).alias("market_supported"), F.when(F.col("nation") < 12, "us").otherwise("eu").alias("region"), F.col("balance").alias("seq"))
    return identity.universe(rows, "us")


@query("SELECT ticker, exclusion FROM uni", a.REGISTRY, UNIVERSE)
def rg1_universe(spark, sf):
    return _universe(spark, sf).select("ticker", "exclusion")


@query("SELECT coalesce(exclusion, 'selected') AS reason, count(*) AS n FROM uni GROUP BY ALL", a.REGISTRY, UNIVERSE)
def ag10_exclusion_counts(spark, sf):
    return identity.exclusion_counts(_universe(spark, sf))
