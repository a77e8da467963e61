"""Rows as they are published: conformed, cleaned, with defaults, and one for each key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import day, first_present, instant, no_null_tokens, number, symbol
from ..functions.classify import fiscal_quarter, fiscal_year, period_type
from ..functions.geography import country_code, listing_country, region_of
from ..functions.symbols import is_placeholder, listing_symbol_in
from .timeseries import keep_last, last_value

# What stands where nothing is given.
CURRENCY, PERIOD = "USD", "unknown"


def fundamentals_payload(rows: DataFrame) -> DataFrame:
    """Fundamentals (ticker, metric, value, value_text, period_end, period_type, period, report_date, currency, source, fetched_at; all texts) as published.

    Rows without symbol, metric, period end or report date (the period end where none is given), or with neither value nor text, are
    left out. Of a symbol, metric, period, type and report date the row fetched last stays, ties by value and text, then the first in
    order of seq, if rows have it, so that repeated runs keep the same row.
    """
    clean = lambda c: F.trim(no_null_tokens(F.col(c)))
    end = day(F.col("period_end"))
    out = rows.select(
        symbol(no_null_tokens(F.col("ticker"))).alias("symbol"), F.coalesce(day(F.col("report_date")), end).alias("report_date"), F.lower(clean("metric")).alias("metric"),
        number(F.col("value")).alias("value"), clean("value_text").alias("value_text"), end.alias("period_end"), period_type(F.col("period_type"), F.col("period")).alias("period_type"),
        fiscal_year(F.lit(None), end).alias("fiscal_year"), fiscal_quarter(F.col("period"), end).alias("fiscal_quarter"),
        F.upper(F.coalesce(clean("currency"), F.lit(CURRENCY))).alias("currency"), clean("source").alias("source"), instant(F.col("fetched_at")).alias("source_updated_at"),
        first_present(rows, "seq").alias("_seq"),
    )
    out = out.dropna(subset=["symbol", "report_date", "metric", "period_end"]).where("value IS NOT NULL OR value_text IS NOT NULL")
    return keep_last(out, ["symbol", "metric", "period_end", "period_type", "report_date"], ["source_updated_at", "value", "value_text", F.asc_nulls_last("_seq")]).drop("_seq")


def earnings_payload(events: DataFrame, history: DataFrame) -> DataFrame:
    """Earnings events and history as published: of a symbol, report date, earnings date and fiscal period the last value of each column that is there."""
    both = events.unionByName(history, allowMissingColumns=True)
    clean = lambda c: F.trim(no_null_tokens(F.col(c)))
    at = day(F.col("earnings_date"))
    values = ["actual_eps", "estimate_eps", "actual_revenue", "estimate_revenue"]
    out = both.select(
        symbol(no_null_tokens(F.col("ticker"))).alias("symbol"), F.coalesce(day(F.col("report_date")), at).alias("report_date"), at.alias("earnings_date"),
        F.coalesce(clean("fiscal_period"), F.lit(PERIOD)).alias("fiscal_period"), *(number(F.col(c)).alias(c) for c in values),
        F.upper(F.coalesce(clean("currency"), F.lit(CURRENCY))).alias("currency"), instant(F.col("fetched_at")).alias("source_updated_at"), "seq",
    )
    out = out.dropna(subset=["symbol", "report_date", "earnings_date"])
    keys = ["symbol", "report_date", "earnings_date", "fiscal_period"]
    return out.groupBy(*keys).agg(*(last_value(c, "source_updated_at", "seq").alias(c) for c in (*values, "currency", "source_updated_at")))


def entity_attributes(rows: DataFrame) -> DataFrame:
    """One row a listing (normalized_symbol, name, country, holding_country, home_country, instrument_type, seq): listing and home country with their regions.

    The symbol takes its country's suffix. A depositary receipt is listed where its symbol says, and its home is the first given
    country outside the US; any other listing is at home where it is listed. Placeholders and empty symbols are left out; the first
    row of a symbol counts.
    """
    given = country_code(F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in ("holding_country", "country", "home_country"))))
    own = rows.withColumn("entity_id", listing_symbol_in(F.upper(F.trim("normalized_symbol")), given))
    own = own.where(~F.col("entity_id").isin("", "NONE", "NULL", "NAN") & ~is_placeholder(F.col("entity_id")))
    title = F.upper(F.coalesce("name", F.lit("")))
    receipt = (F.upper(F.coalesce("instrument_type", F.lit(""))) == "ADR") | title.rlike(" ADR| ADS|AMERICAN DEPOSIT")
    source = F.coalesce(F.nullif(F.trim("holding_country"), F.lit("")), F.nullif(F.trim("country"), F.lit("")))
    country = F.when(receipt, listing_country(F.lit(None).cast("string"), F.col("entity_id"))).otherwise(listing_country(source, F.col("entity_id")))
    own = own.withColumns({"receipt": receipt, "listed": country})
    abroad = F.filter(F.array(*(country_code(F.col(c)) for c in ("holding_country", "country", "home_country", "listed"))), lambda c: ~c.isin("", "US"))
    fallback = country_code(F.coalesce(F.nullif(F.trim("holding_country"), F.lit("")), F.nullif(F.trim("country"), F.lit("")), F.nullif(F.trim("home_country"), F.lit("")), F.col("listed")))
    home = F.when(F.col("receipt"), F.coalesce(F.try_element_at(abroad, F.lit(1)), fallback)).otherwise(F.col("listed"))
    first = own.withColumn("home", home).groupBy("entity_id").agg(F.min_by(F.struct("name", "listed", "home"), "seq").alias("r"))
    return first.select("entity_id", F.nullif(F.trim("r.name"), F.lit("")).alias("name"), F.col("r.listed").alias("country"), F.col("r.home").alias("home_country"), region_of(F.col("r.listed")).alias("region"), region_of(F.col("r.home")).alias("home_region"))
