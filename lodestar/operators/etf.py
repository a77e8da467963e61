"""ETF holdings, themes and universe waves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.casts import ratio, weight
from ..functions.classify import equity_like
from ..functions.geography import country_code, listing_country
from ..functions.symbols import listing_symbol, listing_symbol_in
from .timeseries import top_k

MIN_CONSTITUENTS, MIN_RATIO = 5, 0.10
MAX_WEIGHT, MAX_TOTAL = 0.50, 1.35


def normalised_weights(holdings: DataFrame) -> DataFrame:
    """Weights as shares: a fund with any %, a total over MAX_TOTAL or a weight over 1 is in per cent. Decided from all rows of a fund."""
    by = Window.partitionBy("etf_ticker")
    rows = holdings.withColumns({"w": weight(F.col("weight")), "pct": F.col("weight").contains("%")}).where(F.col("w").isNotNull())
    percent = F.bool_or("pct").over(by) | (F.sum("w").over(by) > MAX_TOTAL) | (F.max("w").over(by) > 1.0)
    return rows.select("etf_ticker", "holding_symbol", F.round(F.when(percent, F.col("w") / 100).otherwise(F.col("w")), 10).alias("weight"))


def normalised_holdings(rows: DataFrame, fetched: Column) -> DataFrame:
    """etf_ticker, holding_symbol, holding_name, holding_country, weight, as_of of the shares among raw rows (etf_ticker, symbol, name, weight,
    asset_class, country, as_of and stated as dates, seq).

    Cash, currencies, derivatives, placeholders and other asset classes go before weights are judged, as do rows without a weight; of a fund's
    rows of one symbol and date the last (seq) stays. A fund is in per cent if any weight has a %, if they sum to over MAX_TOTAL or one is
    over 1; that is one row a fund, joined to its rows, so a fund may have any number. Rows are judged and shuffled once for both.
    """
    placed = rows.withColumns({"_given": country_code(F.col("country")), "_w": weight(F.col("weight")), "_named": F.nullif(F.trim("name"), F.lit(""))})
    held = F.when(F.col("_given") != "", listing_symbol_in(F.col("symbol"), F.col("_given"))).otherwise(listing_symbol(F.col("symbol")))
    placed = placed.withColumn("_held", F.nullif(held, F.lit("")))
    # A filter on a column would move below the projections and repeat their rules; nothing moves below a generator.
    share = F.array(equity_like(F.col("_held"), F.col("_named"), F.col("asset_class")) & F.col("_w").isNotNull())
    own = placed.select("*", F.explode(share).alias("_share")).where("_share").select(
        F.upper("etf_ticker").alias("etf_ticker"), F.col("_held").alias("holding_symbol"), F.col("_named").alias("holding_name"), listing_country(F.col("_given"), F.col("_held")).alias("holding_country"),
        "_w", F.coalesce(F.col("weight").contains("%"), F.lit(False)).alias("_pct"), F.coalesce("as_of", "stated", fetched).alias("as_of"), "seq",
    )
    # The last row as one value, so that both uses need the same columns and share its shuffle.
    last = own.groupBy("etf_ticker", "holding_symbol", "as_of").agg(F.max(F.struct("seq", "holding_name", "holding_country", "_w", "_pct")).alias("_r"))
    funds = last.groupBy("etf_ticker").agg((F.bool_or("_r._pct") | (F.sum("_r._w") > MAX_TOTAL) | (F.max("_r._w") > 1.0)).alias("_percent"))
    share = F.round(F.when(F.col("_percent"), F.col("_r._w") / 100).otherwise(F.col("_r._w")), 10)
    return last.join(funds.hint("shuffle_hash"), "etf_ticker").select("etf_ticker", "holding_symbol", "_r.holding_name", "_r.holding_country", share.alias("weight"), "as_of")


def plausibility(holdings: DataFrame) -> DataFrame:
    """Largest and total weight of each fund, and whether they can be right."""
    out = holdings.groupBy("etf_ticker").agg(F.max("weight").alias("max_weight"), F.sum("weight").alias("total_weight"))
    return out.withColumn("plausible", (F.col("max_weight") <= MAX_WEIGHT) & (F.col("total_weight") <= MAX_TOTAL))


def theme_readiness(holdings: DataFrame, themes: DataFrame, priced: DataFrame, technical: DataFrame) -> DataFrame:
    """Whether each theme has enough constituents with technical features, or why not."""
    flags = holdings.select("etf_ticker", F.col("holding_symbol").alias("symbol")).distinct()
    flags = flags.join(priced.select("symbol", F.lit(1).alias("p")).distinct(), "symbol", "left").join(technical.select("symbol", F.lit(1).alias("t")).distinct(), "symbol", "left")
    counts = flags.groupBy("etf_ticker").agg(F.count("*").alias("holdings_count"), F.count("p").alias("priced_constituent_count"), F.count("t").alias("technical_constituent_count"))
    rows = themes.join(counts, "etf_ticker", "left").na.fill(0, ["holdings_count", "priced_constituent_count", "technical_constituent_count"])
    share = F.coalesce(ratio(F.col("technical_constituent_count"), F.col("holdings_count")), F.lit(0.0))
    reason = F.when(~F.col("active"), "theme_inactive").when(F.col("holdings_count") == 0, "no_holdings").when((F.col("technical_constituent_count") < MIN_CONSTITUENTS) | (share < MIN_RATIO), "insufficient_constituent_coverage")
    return rows.select("etf_ticker", "theme", "active", "holdings_count", "priced_constituent_count", "technical_constituent_count", share.alias("coverage_ratio"), reason.isNull().alias("relationship_map_eligible"), reason.alias("ineligible_reason"))


def theme_health(readiness: DataFrame, edges: DataFrame) -> DataFrame:
    """inactive, pendingCoverage, noEdges (red) or ok by readiness and edge counts."""
    rows = readiness.join(edges, "etf_ticker", "left").withColumn("n_edges", F.coalesce("n_edges", F.lit(0)))
    state = F.when(~F.col("active"), "inactive").when(~F.col("relationship_map_eligible"), "pendingCoverage").when(F.col("n_edges") == 0, "noEdges").otherwise("ok")
    return rows.select("etf_ticker", "n_edges", state.alias("health"), (state == "noEdges").alias("red"))


def wave_candidates(holdings: DataFrame, themes: DataFrame, wave: int) -> DataFrame:
    """Holdings of a wave's funds: total weight (negatives as 0), funds and themes they are in."""
    rows = holdings.join(themes.where(F.col("wave") == wave).select("etf_ticker", "theme"), "etf_ticker").withColumn("w", F.greatest(F.lit(0.0), F.col("weight")))
    return rows.groupBy("holding_symbol").agg(F.sum("w").alias("total_weight"), F.countDistinct("etf_ticker").alias("n_etfs"), F.array_join(F.array_sort(F.collect_set("theme")), ",").alias("themes"))


def wave_additions(candidates: DataFrame, registered: DataFrame, most: int, batch: int, offset: int = 0) -> DataFrame:
    """The heaviest candidates that aren't registered, at most `most`, numbered in batches. most is the feature's own limit."""
    new = candidates.join(registered.select(F.col("symbol").alias("holding_symbol")).distinct(), "holding_symbol", "left_anti")
    order = [F.desc(F.round("total_weight", 9)), F.desc("n_etfs"), F.asc("holding_symbol")]
    top = new.orderBy(*order).limit(most).withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    return top.withColumn("batch", (F.floor((F.col("rank") - 1) / batch) + 1 + offset).cast("int"))


def inactive_themes(before: DataFrame, refreshed: DataFrame) -> DataFrame:
    """Tombstones of themes that were active and are not refreshed."""
    return before.where("active").join(refreshed.select("etf_ticker").distinct(), "etf_ticker", "left_anti").select("etf_ticker", "theme", F.lit(False).alias("active"), F.lit(0).alias("holdings_count"))


def latest_holdings(holdings: DataFrame) -> DataFrame:
    last = Window.partitionBy("etf_ticker")
    return holdings.withColumn("_last", F.max("as_of").over(last)).where(F.col("as_of") == F.col("_last")).drop("_last")


def largest_holdings(holdings: DataFrame, k: int) -> DataFrame:
    return top_k(holdings, ["etf_ticker"], [F.desc("weight"), F.asc("holding_symbol")], k)
