"""From listings to entities: grouping, primary listings, reasons and measures; and the registry's universe."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.symbols import isin_is_valid
from .timeseries import first_value, top_k

# Confidence of each strong key.
CONFIDENCE = {"legal_entity_id": 0.98, "lei": 0.98, "isin": 0.90}
REGIONS = ("us", "eu", "apac", "global")


def merged_candidates(sources: dict[str, DataFrame], columns: tuple[str, ...]) -> DataFrame:
    """One row for each symbol of the sources: the first value of each column that isn't empty, by source order, and the sources' list."""
    rows = None
    for i, (name, df) in enumerate(sources.items()):
        one = df.select("symbol", *(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).alias(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns), F.lit(i).alias("_order"), F.lit(name).alias("_source"))
        rows = one if rows is None else rows.unionAll(one)
    return rows.groupBy("symbol").agg(*(first_value(c, "_order", c).alias(c) for c in columns), F.array_join(F.array_sort(F.collect_set("_source")), ",").alias("sources"))


def isin_status(listings: DataFrame) -> DataFrame:
    """success, suspect (form, check digit or a prefix that isn't the listing's country) or not_found."""
    token = F.nullif(F.upper(F.trim("isin")), F.lit(""))
    reason = F.when(token.isNull(), "no_isin").when(~isin_is_valid(token), "invalid_isin").when(F.substring(token, 1, 2) != F.col("country"), "prefix_mismatch").otherwise("ok")
    return listings.withColumns({"isin_reason": reason, "isin_status": F.when(reason == "no_isin", "not_found").when(reason == "ok", "success").otherwise("suspect")})


def entities(listings: DataFrame) -> DataFrame:
    """Listings grouped by their strongest key: one row for each entity, with listings, countries, home country and confidence.

    Home is the first explicit one by symbol, else the first country by name that isn't the US, else any. A key over several
    legal names is a conflict.
    """
    kind = F.coalesce(*(F.when(F.nullif(F.trim(c), F.lit("")).isNotNull(), F.lit(c)) for c in CONFIDENCE))
    rows = listings.withColumn("key_kind", kind).where(F.col("key_kind").isNotNull()).withColumn("key", F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in CONFIDENCE)))
    home = F.coalesce(first_value("home_country", "symbol"), F.min(F.when(F.col("country") != "US", F.col("country"))), F.min("country"))
    out = rows.groupBy("key_kind", "key").agg(F.count("*").alias("n_listings"), F.countDistinct("country").alias("n_countries"), home.alias("home_country"), F.countDistinct("name").alias("n_names"), F.min("symbol").alias("first_symbol"))
    confidence = F.coalesce(*(F.when(F.col("key_kind") == k, F.lit(v)) for k, v in CONFIDENCE.items()))
    return out.withColumns({"entity_id": F.concat(F.lit("ofg_"), F.substring(F.sha1(F.concat_ws(":", "key_kind", "key").cast("binary")), 1, 16)), "confidence": confidence, "conflict": F.col("n_names") > 1})


def unresolved_suggestions(listings: DataFrame) -> DataFrame:
    """Buckets of listings without a strong key that share a bare symbol or a name, of two symbols or more."""
    rows = listings.where(F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in CONFIDENCE)).isNull())
    bare = F.regexp_replace("symbol", r"\..*$", "")
    both = rows.select("symbol", F.explode(F.array(F.struct(F.lit("symbol").alias("kind"), bare.alias("bucket")), F.struct(F.lit("name").alias("kind"), F.col("name").alias("bucket")))).alias("b")).select("symbol", "b.*").where("bucket IS NOT NULL")
    return both.groupBy("kind", "bucket").agg(F.countDistinct("symbol").alias("n_symbols")).where("n_symbols >= 2")


def primary_listings(listings: DataFrame, key: str) -> DataFrame:
    """The primary listing of each entity: complete, then at home, then with a market, then with a currency, then by symbol; and which of these decided."""
    complete = F.col("mic").isNotNull() & F.col("currency").isNotNull()
    home = F.coalesce(F.col("country") == F.col("home_country"), F.lit(False))
    order = [F.desc(complete), F.desc(home), F.asc_nulls_last("mic"), F.asc_nulls_last("currency"), F.asc("symbol")]
    best = top_k(listings.withColumn("n", F.count("*").over(Window.partitionBy(key))), [key], order, 1)
    reason = F.when(F.col("n") == 1, "only_listing").when(complete & home, "complete_home_listing").when(complete, "complete_listing").when(home, "home_listing").otherwise("first_symbol")
    return best.select(key, "symbol", reason.alias("reason"))


def measures(listings: DataFrame, flags: dict[str, str]) -> DataFrame:
    """One row: listings, and of each condition the count and the rate (0 of none)."""
    counts = listings.agg(F.count("*").alias("n"), *(F.count_if(F.expr(e)).alias(f"n_{k}") for k, e in flags.items()))
    return counts.select("n", *(c for k in flags for c in (F.col(f"n_{k}"), F.coalesce(F.try_divide(F.col(f"n_{k}").cast("double"), F.col("n")), F.lit(0.0)).alias(f"{k}_rate"))))


def universe(registry: DataFrame, region: str) -> DataFrame:
    """Each ticker of a region's registry with the first reason why it isn't refreshed, null for those that are; the first row of a ticker counts."""
    rows = top_k(registry, ["ticker"], [F.asc("seq")], 1)
    reason = F.when(F.col("status") != "active", "inactive").when(~F.col("promotion_status").startswith("validated"), "not_promoted").when(~F.col("market_supported"), "market_unsupported")
    if region not in ("all", "global"):
        reason = reason.when(F.col("region") != region, "other_region")
    return rows.withColumn("exclusion", reason)


def exclusion_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.coalesce("exclusion", F.lit("selected")).alias("reason")).agg(F.count("*").alias("n"))
