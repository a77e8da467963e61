"""Reconciliation of the ticker registry with the symbols that are materialised or tracked.

Every step is a join or an aggregate by symbol; no symbol's rows are collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.casts import symbol
from ..functions.geography import country_code, listing_country, region_of
from ..functions.symbols import let, listing_symbol_in, lookup, registry_key
from .registry import PROMOTED, refresh_region
from .timeseries import top_k

# Refresh regions, exchanges of each, countries of their own region, ranks of exchanges (50 for others), texts of nothing.
SCHEDULED = ("us", "eu", "apac")
SCHEDULE_EXCHANGES = {
    "us": ("AMEX", "ASE", "B3", "BMF", "BVMF", "NASDAQ", "NMS", "NYQ", "NYSE", "PCX", "SAO", "TOR", "TSX", "XASE", "XBMF", "XNYS", "XNAS", "XTSE"),
    "eu": ("AMS", "CPH", "EPA", "ETR", "HEL", "LIS", "LSE", "MIL", "OSL", "PAR", "STO", "SWX", "XAMS", "XCSE", "XETR", "XLIS", "XLON", "XMIL", "XPAR", "XSTO", "XSWX"),
    "apac": ("ASX", "HKG", "HKEX", "JPX", "KSC", "NSE", "SES", "SHH", "SHZ", "TASE", "TLV", "TSE", "XASX", "XHKG", "XJPX", "XSES", "XTAE", "XTKS"),
}
APAC_COUNTRIES = ("IL",)
EXCHANGE_RANKS = {"NMS": "100", "NYQ": "95", "ASE": "90", "PCX": "85", "CPH": "80", "LIS": "80", "ASX": "80", "HKG": "80", "NASDAQ": "10"}
NOTHING = ("NONE", "NULL", "NAN")
#: The sources of candidates, and which of them alone make a symbol one to refresh.
SOURCES = {"readiness": True, "prices": False, "technicals": True, "summaries": True, "fundamentals": False, "earnings": False}
#: Sources that are named in the plan.
NAMED = ("prices", "readiness", "summaries", "technicals")


def _token(c: Column) -> Column:
    """Trimmed upper case; null for texts of nothing."""
    return let(symbol(c), lambda t: F.when(~t.isin(*NOTHING), t))


def alias_keys(raw: Column) -> Column:
    """array: the symbol, and for a share class (ABC.D, ABC-D) its other spelling; empty for texts of nothing."""
    share_class = lambda t: F.array(F.translate(t, "-", "."), F.translate(t, ".", "-"))
    keys = let(_token(raw), lambda t: F.when(t.rlike(r"^[A-Z]{1,5}[.-][A-Z]$"), share_class(t)).when(t.isNotNull(), F.array(t)))
    return F.coalesce(keys, F.array().cast("array<string>"))


def candidates(sources: dict[str, DataFrame]) -> DataFrame:
    """One row for each symbol of the sources (see SOURCES; readiness has is_tracked): has_<source>, sources and should_refresh."""
    rows = []
    for name in SOURCES:
        if name not in sources:
            continue
        own = sources[name].where("is_tracked") if name == "readiness" else sources[name]
        rows.append(own.select(symbol(F.col("symbol")).alias("symbol"), F.lit(name).alias("_source")))
    found = reduce(DataFrame.unionAll, rows).where(F.col("symbol").isNotNull())
    out = found.groupBy("symbol").agg(*(F.bool_or(F.col("_source") == n).alias(f"has_{n}") for n in SOURCES))
    refresh = reduce(Column.__or__, (F.col(f"has_{n}") for n, alone in SOURCES.items() if alone))
    named = F.concat_ws(",", *(F.when(F.col(f"has_{n}"), n) for n in NAMED))
    return out.where(reduce(Column.__or__, (F.col(f"has_{n}") for n in SOURCES))).withColumns({"should_refresh": refresh, "sources": named})


def _exchange_region(exchange: Column) -> Column:
    listed = lookup({e: region for region, own in SCHEDULE_EXCHANGES.items() for e in own}, exchange)
    other = refresh_region(exchange)
    return F.when(exchange.isNotNull(), F.coalesce(listed, F.when(other.isin(*SCHEDULED), other)))


def registry_rows(registry: DataFrame) -> DataFrame:
    """Registry rows once for each symbol that they are about (by normalised or input symbol), with what the plan asks of them.

    registry: registry_key, input_symbol, normalized_symbol, region, exchange, status, promotion_status, market_supported,
    instrument_type, seq (order of rows).
    """
    low = {c: F.coalesce(F.lower(F.trim(c)), F.lit("")) for c in ("status", "promotion_status")}
    own, parts = _token(F.col("normalized_symbol")), F.split("registry_key", r"\|")
    in_key = F.when((F.size(parts) == 3) & (F.lower(F.trim(parts[2])) != "default"), symbol(F.get(parts, 2)))
    rows = registry.withColumns({**low, "_normalized": own, "market_supported": F.coalesce("market_supported", F.lit(False)), "_exchange": F.coalesce(_token(F.col("exchange")), in_key), "_region": refresh_region(F.col("region"))})
    selected = (F.col("status") == "active") & F.col("promotion_status").isin(*PROMOTED) & F.col("market_supported") & F.col("_normalized").isNotNull()
    rows = rows.withColumns({"_selected": selected, "_exchange_region": _exchange_region(F.col("_exchange"))})
    keys = F.array_distinct(F.concat(alias_keys(F.col("normalized_symbol")), alias_keys(F.col("input_symbol"))))
    return rows.withColumn("symbol", F.explode(keys)).withColumn("_selected_here", F.col("_selected") & F.array_contains(alias_keys(F.col("normalized_symbol")), F.col("symbol")))


def _safe_region() -> Column:
    """Aggregate: the region of the best row that has a refresh region."""
    known = F.col("promotion_status").isin(*PROMOTED, "pending_validation")
    rank = F.when(F.col("_selected"), 3).otherwise(0) + F.when(F.col("status").isin("active", "pending_validation"), 2).otherwise(0) + F.when(known, 1).otherwise(0)
    return F.max(F.when(F.col("_region").isin(*SCHEDULED), F.struct(rank.alias("rank"), F.col("_region").alias("region"))))["region"]


def _missing_reason() -> Column:
    """Aggregate over rows of which none is selected: why the symbol has no canonical row; the first that holds."""
    pending = F.bool_or((F.col("status") == "pending_validation") | (F.col("promotion_status") == "pending_validation"))
    rejected = F.bool_or(F.col("status") == "rejected") & ~F.bool_or("_selected")
    reasons = {
        "rejected_or_superseded_without_active_canonical": rejected,
        "missing_normalized_symbol": F.bool_and(F.col("_normalized").isNull()),
        "market_supported_false": F.bool_or(~F.col("market_supported")),
        "pending_validation": pending,
    }
    return F.coalesce(*(F.when(c, r) for r, c in reasons.items()), F.lit("not_promoted"))


def canonical(wanted: DataFrame, rows: DataFrame, attributes: DataFrame) -> DataFrame:
    """wanted (symbol) with the region, exchange and registry_key that its registry row should have, and facts of its rows.

    Region: the attributes' region, the country's, that of existing rows, of the attributes' exchange, of the rows' exchanges (the first
    by seq), else us. Exchange: the attributes', else the best of the rows' by rank, region, symbol and name.
    """
    entity = top_k(attributes.withColumn("symbol", symbol(F.coalesce("symbol", F.lit("")))).where(F.col("symbol").isNotNull()), ["symbol"], [F.desc("seq")], 1)
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    entity = entity.select("symbol", F.coalesce(blank("country"), blank("home_country")).alias("_given"), blank("region").alias("_product"), _token(F.col("exchange")).alias("_own"), _token(F.col("exchange_mic")).alias("exchange_mic"), _token(F.col("currency")).alias("currency"))
    facts = rows.groupBy("symbol").agg(
        F.count("*").alias("n_related"), F.count_if("_selected_here").alias("n_selected"), _safe_region().alias("_safe"), _missing_reason().alias("_missing"),
        F.min_by("_exchange_region", F.when(F.col("_exchange_region").isNotNull(), F.struct("seq", "registry_key"))).alias("_row_exchange"),
        F.max_by(F.struct("registry_key", "_normalized", "_region"), F.when(F.col("_selected_here"), F.struct("seq", "registry_key"))).alias("_one"),
    )
    out = wanted.join(entity, "symbol", "left").join(facts, "symbol", "left").fillna(0, ["n_related", "n_selected"])
    out = out.withColumn("_country", country_code(F.coalesce("_given", listing_country(F.lit(None).cast("string"), F.col("symbol")))))
    product, place = refresh_region(F.coalesce("_product", region_of(F.col("_country")))), refresh_region(F.col("_country"))
    region = F.coalesce(
        F.when(product.isin(*SCHEDULED), product), F.when(F.col("_country").isin(*APAC_COUNTRIES), "apac"), F.when(place.isin(*SCHEDULED), place), F.col("_safe"),
        _exchange_region(F.col("_own")), F.col("_row_exchange"), F.lit("us"),
    )
    out = out.withColumns({"region": region, "_spelled": F.coalesce(symbol(listing_symbol_in(F.col("symbol"), F.col("_country"))), F.col("symbol"))})
    by_exchange = rows.where(F.col("_exchange").isNotNull()).select("symbol", "_exchange", "_region", "_normalized", "_selected").join(out.select("symbol", "region", "_spelled"), "symbol")
    here = (F.col("_normalized") == F.col("_spelled")) | F.col("_selected")
    scored = by_exchange.groupBy("symbol", "_exchange").agg(F.bool_or(F.col("_region") == F.col("region")).alias("_there"), F.coalesce(F.bool_or(here), F.lit(False)).alias("_same"))
    rank = F.coalesce(lookup(EXCHANGE_RANKS, F.col("_exchange")).cast("int"), F.lit(50))
    best = scored.groupBy("symbol").agg(F.max(F.struct(rank.alias("rank"), "_there", "_same", "_exchange"))["_exchange"].alias("_best"))
    out = out.join(best, "symbol", "left").withColumn("exchange", F.coalesce("_own", "_best"))
    return out.withColumn("registry_key", registry_key(F.col("symbol"), F.col("region"), F.col("exchange")))


def reconciliation(sources: dict[str, DataFrame], registry: DataFrame, attributes: DataFrame, exclusions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The plan and the superseded rows.

    plan: one row for each candidate that is not in order. outcome residue (only materialised), reviewed (in exclusions) or upsert
    (its canonical row is to be written), the reason, and for upserts the row: registry_key, region, exchange, exchange_mic, currency,
    instrument_type of the row that it is based on, validation_status. superseded: registry_key of each row that a canonical row takes
    the place of, with superseded_by (the last by symbol), but not rows that are rejected already.
    """
    found = candidates(sources).join(exclusions.select(symbol(F.col("symbol")).alias("symbol"), F.lit(True).alias("_reviewed")).distinct(), "symbol", "left")
    early = F.when(~F.col("should_refresh"), "residue").when(F.col("_reviewed"), "reviewed")
    found = found.withColumn("outcome", early)
    rows = registry_rows(registry)
    full = canonical(found.where("outcome IS NULL").drop("outcome"), rows, attributes)
    fits = (F.col("_one.registry_key") == F.col("registry_key")) & (F.col("_one._normalized") == F.col("symbol")) & (F.col("_one._region") == F.col("region"))
    full = full.where(~((F.col("n_selected") == 1) & F.coalesce(fits, F.lit(False))))
    reason = F.when(F.col("n_selected") > 0, "duplicate/conflicting canonical rows").otherwise(F.coalesce("_missing", F.lit("no_registry_row")))
    status = F.when(F.col("has_fundamentals") & F.col("has_earnings"), PROMOTED[0]).otherwise(PROMOTED[1])
    full = full.withColumns({"reason": reason, "validation_status": status})
    related = rows.select("symbol", F.col("registry_key").alias("_key"), "_region", "_exchange", "_normalized", "status", "promotion_status", "instrument_type", "seq").join(full.select("symbol", "registry_key", "region", "exchange"), "symbol")
    same = lambda a, b: F.coalesce(a == b, F.lit(False))
    order = [
        F.desc(same(F.trim("_key"), F.col("registry_key"))), F.desc(F.col("_region") == F.col("region")), F.desc(F.coalesce("_exchange", F.lit("")) == F.coalesce("exchange", F.lit(""))),
        F.desc(F.col("status") != "rejected"), F.desc(same(F.col("_normalized"), F.col("symbol"))), F.asc("seq"),
    ]
    base = related.withColumn("_rank", F.row_number().over(Window.partitionBy("symbol").orderBy(*order))).where("_rank = 1").select("symbol", F.nullif(F.lower(F.trim("instrument_type")), F.lit("")).alias("_type"))
    upserts = full.join(base, "symbol", "left").select(
        "symbol", F.lit("upsert").alias("outcome"), "reason", "sources", "registry_key", "region", "exchange", "exchange_mic", "currency",
        F.coalesce("_type", F.lit("unknown")).alias("instrument_type"), "validation_status", "n_related", "n_selected",
    )
    why = F.when(F.col("outcome") == "residue", "price_only_materialized_not_tracked").otherwise("reviewed_exclusion")
    rest = found.where("outcome IS NOT NULL").select("symbol", "outcome", why.alias("reason"), "sources")
    done = (F.col("status") == "rejected") & (F.col("promotion_status") == "rejected")
    old = related.where((F.trim(F.coalesce("_key", F.lit(""))) != "") & (F.trim("_key") != F.col("registry_key")) & ~done)
    superseded = old.groupBy(F.trim("_key").alias("superseded")).agg(F.max_by("registry_key", "symbol").alias("superseded_by"))
    return rest.unionByName(upserts, allowMissingColumns=True), superseded.withColumnRenamed("superseded", "registry_key")
