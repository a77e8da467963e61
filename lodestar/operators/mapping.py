"""Identifier mappings of listings: ordered requests, their answers, and the first answer that settles a listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.symbols import lookup
from .events import MAPPED, security_mappings
from .timeseries import keep_last

# Exchange codes and markets that listing suffixes stand for, exchanges of the US, market codes that say nothing.
SUFFIX_CODES = {"AX": "AU", "AS": "NA", "CO": "DC", "DE": "GY", "HK": "HK", "L": "LN", "T": "JT", "TO": "CN"}
SUFFIX_MARKETS = {"KQ": "XKOS", "KS": "XKRX", "LS": "XLIS", "MI": "XMIL", "NS": "XNSE", "PA": "XPAR", "SS": "XSHG", "SZ": "XSHE", "TA": "XTAE"}
US_EXCHANGES, US_CODE = ("AMEX", "ASE", "NASDAQ", "NMS", "NYQ", "NYSE", "PCX", "US"), "US"
NO_MARKET = ("XXXX", "XUNK")


def _clean(c: str) -> Column:
    text = F.nullif(F.upper(F.trim(c)), F.lit(""))
    return F.nullif(text, F.lit("NAN"))


def _unpadded(digits: Column) -> Column:
    return F.regexp_replace(digits, r"^0+(?=\d)", "")


def _request(ticker: Column, code: Column, market: Column, currency: Column) -> Column:
    """The request as JSON with sorted keys; absent fields are left out, and the code where there is a market."""
    return F.to_json(F.struct(currency.alias("currency"), F.when(market.isNull(), code).alias("exchCode"), F.lit("TICKER").alias("idType"), F.nullif(ticker, F.lit("")).alias("idValue"), market.alias("micCode")))


def request_variants(listings: DataFrame) -> DataFrame:
    """(symbol, attempt, payload, request_hash) of listings (symbol, provider_symbol, exchange, exchange_mic, country, currency).

    Attempt 0 asks for the symbol without its listing suffix on the given market, else the suffix's market, else by exchange code from
    suffix, exchange or country. Attempt 1 exists for Korean listings on the suffix's own market (the other one) and for Chinese
    numbers with leading zeros (without them). Rows without a symbol go.
    """
    own = listings.select("symbol", F.coalesce(_clean("provider_symbol"), _clean("symbol")).alias("full"), _clean("exchange").alias("exchange"), _clean("exchange_mic").alias("given"), _clean("country").alias("country"), _clean("currency").alias("currency")).where("full IS NOT NULL")
    last = F.regexp_extract("full", r"\.([A-Z]+)$", 1)
    own = own.withColumn("suffix", F.when(last.isin(*SUFFIX_CODES, *SUFFIX_MARKETS), last))
    own = own.withColumn("bare", F.when(F.col("suffix").isNull(), F.col("full")).otherwise(F.expr("substring(full, 1, length(full) - length(suffix) - 1)")))
    numeric = F.col("bare").rlike(r"^\d+$")
    ticker = F.when((F.col("suffix") == "HK") & numeric, _unpadded(F.col("bare"))).when(F.col("suffix") == "CO", F.regexp_replace("bare", "[-.]", "")).otherwise(F.col("bare"))
    valid = F.col("given").rlike(r"^[\p{L}\p{N}]{4}$") & ~F.col("given").isin(*NO_MARKET)
    market = F.coalesce(F.when(valid, F.col("given")), lookup(SUFFIX_MARKETS, F.col("suffix")))
    code = F.coalesce(lookup(SUFFIX_CODES, F.col("suffix")), F.when(F.col("exchange").isin(*US_EXCHANGES) | F.col("country").isin(*US_EXCHANGES), F.lit(US_CODE)))
    own = own.withColumns({"ticker": ticker, "market": market, "code": code})
    other = F.when((F.col("suffix") == "KS") & (F.col("market") == "XKRX"), F.lit("XKOS")).when((F.col("suffix") == "KQ") & (F.col("market") == "XKOS"), F.lit("XKRX"))
    padded = F.col("suffix").isin("SS", "SZ") & F.col("bare").rlike(r"^0\d*$")
    first = _request(F.col("ticker"), F.col("code"), F.col("market"), F.col("currency"))
    second = F.when(other.isNotNull(), _request(F.col("ticker"), F.col("code"), other, F.col("currency"))).when(padded, _request(_unpadded(F.col("bare")), F.col("code"), F.col("market"), F.col("currency")))
    asked = own.select("symbol", F.posexplode(F.array_distinct(F.array_compact(F.array(first, second)))).alias("attempt", "payload"))
    return asked.withColumn("request_hash", F.sha2("payload", 256))


def settled_mappings(variants: DataFrame, answers: DataFrame) -> DataFrame:
    """One row a symbol of variants: the answer of the first attempt that is not not_found, else that of attempt 0; tried holds every attempt with its status.

    answers (request_hash, raw_payload, fetched_at): of one request the answer fetched last counts. A request without answer is not_found.
    Answers are joined by request, so a listing asked for often meets its answer once; a listing has at most two attempts.
    """
    known = security_mappings(keep_last(answers, ["request_hash"], ["fetched_at", "raw_payload"]).select("request_hash", "raw_payload"), strict=True)
    rows = variants.join(known, "request_hash", "left")
    rows = rows.withColumns({"status": F.coalesce("status", F.lit("not_found")), "error_message": F.when(F.col("status").isNull(), "no_answer").otherwise(F.col("error_message"))})
    order = F.struct(F.col("status") == "not_found", "attempt", "request_hash")
    best = rows.groupBy("symbol").agg(
        F.min_by(F.struct("attempt", "request_hash", "status", "error_message", *MAPPED), order).alias("r"),
        F.array_sort(F.collect_set(F.struct("attempt", "request_hash", "status"))).alias("tried"),
    )
    return best.select("symbol", "r.*", "tried")
