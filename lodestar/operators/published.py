"""Published price, macro, calendar and fund rows: conformed, defaults filled in, rows without their required values left out.

Each function takes rows with any of the named columns; one that is absent counts as null. Texts that stand for null are null, and
a number that is no number (NaN) is null. `now` stands for update times that are absent. Rows of one key: the one updated last stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import day, first_present, instant, no_null_tokens, number, symbol, tri_state
from ..functions.symbols import listing_key
from .timeseries import keep_last

# What stands where nothing is given.
ALIGNMENT, SOURCE, CALENDAR_SOURCE = "release_timed", "data_ops", "exchange_calendars"


def _text(rows: DataFrame, *names: str) -> Column:
    return F.trim(no_null_tokens(first_present(rows, *names).cast("string")))


def _symbol(rows: DataFrame, *names: str) -> Column:
    return symbol(no_null_tokens(first_present(rows, *names).cast("string")))


def _value(rows: DataFrame, *names: str) -> Column:
    v = number(first_present(rows, *names))
    return F.when(~F.isnan(v), v)


def _whole(rows: DataFrame, name: str) -> Column:
    """The number without its fraction; null where there is none or it is too large."""
    return _value(rows, name).try_cast("bigint")


def _day(rows: DataFrame, *names: str) -> Column:
    return day(first_present(rows, *names))


def _at(rows: DataFrame, now: Column | None, *names: str) -> Column:
    return F.coalesce(instant(first_present(rows, *names)), F.current_timestamp() if now is None else now)


def _flag(rows: DataFrame, name: str) -> Column:
    return F.coalesce(tri_state(first_present(rows, name)), F.lit(False))


def prices(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """Daily prices by symbol and date. Rows without symbol, date or close go; repeats stay, since the table's upsert decides on them."""
    updated = _at(rows, now, "fetched_at", "ingested_at")
    ingested = F.coalesce(instant(first_present(rows, "created_at", "fetched_at", "ingested_at")), updated)
    values = (_value(rows, c).alias(c) for c in ("open", "high", "low", "close", "adj_close"))
    out = rows.select(_symbol(rows, "ticker", "symbol").alias("symbol"), _day(rows, "date").alias("price_date"), *values, _whole(rows, "volume").alias("volume"), updated.alias("source_updated_at"), ingested.alias("ingested_at"))
    return out.dropna(subset=["symbol", "price_date", "close"])


def series_catalog(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """One row a series. Those without key, provider, code, frequency or limit of staleness go."""
    needed = ["series_key", "source_provider", "source_code", "frequency"]
    out = rows.select(
        *(_text(rows, c).alias(c) for c in needed), _flag(rows, "required_by_default").alias("required_by_default"), _flag(rows, "optional").alias("optional"), _whole(rows, "staleness_max_bdays").alias("staleness_max_bdays"),
        _text(rows, "release_calendar_source").alias("release_calendar_source"), _text(rows, "description").alias("description"), _at(rows, now, "updated_at").alias("updated_at"),
    )
    return keep_last(out.dropna(subset=[*needed, "staleness_max_bdays"]), ["series_key"], ["updated_at", "source_provider", "source_code"])


def macro_observations(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """One row a series and period. Rows without series, period, date or value go."""
    text = lambda *names: (_text(rows, c).alias(c) for c in names)
    out = rows.select(
        *text("series_key", "observation_period"), _day(rows, "observation_date").alias("observation_date"), *text("frequency"), _value(rows, "value").alias("value"), *text("source_provider", "source_code"),
        instant(first_present(rows, "release_timestamp_utc")).alias("release_timestamp_utc"), *text("release_timezone"), _day(rows, "release_date_local").alias("release_date_local"), *text("release_calendar_source", "source"),
        _at(rows, now, "fetched_at").alias("fetched_at"), _at(rows, now, "ingested_at").alias("ingested_at"),
    )
    return keep_last(out.dropna(subset=["series_key", "observation_period", "observation_date", "value"]), ["series_key", "observation_period"], ["fetched_at", "ingested_at", "value"])


def macro_daily(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """One row a day and series: the value that could be known then. Rows without day, series, observation or time of availability go; a null value stays. Of equal times and values the first in order of seq stays, if rows have it."""
    out = rows.select(
        _day(rows, "as_of_date").alias("as_of_date"), _text(rows, "series_key").alias("series_key"), _value(rows, "value").alias("value"), _text(rows, "source_observation_period").alias("source_observation_period"),
        _day(rows, "source_observation_date").alias("source_observation_date"), instant(first_present(rows, "available_at_utc")).alias("available_at_utc"), _whole(rows, "staleness_bdays").alias("staleness_bdays"),
        _flag(rows, "is_stale").alias("is_stale"), F.coalesce(_text(rows, "alignment_mode"), F.lit(ALIGNMENT)).alias("alignment_mode"), _at(rows, now, "ingested_at").alias("ingested_at"), first_present(rows, "seq").alias("_seq"),
    )
    needed = ["as_of_date", "series_key", "source_observation_period", "source_observation_date", "available_at_utc"]
    return keep_last(out.dropna(subset=needed), ["as_of_date", "series_key"], ["ingested_at", "available_at_utc", "value", F.asc_nulls_last("_seq")]).drop("_seq")


def cached_macro_daily(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """macro_daily as the source cache holds it: when it was available is when its source was updated."""
    own = macro_daily(rows, now)
    return own.select("as_of_date", "series_key", "value", F.col("available_at_utc").alias("source_updated_at"), "alignment_mode", "is_stale", "staleness_bdays", "ingested_at")


def trading_calendar(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """One row an exchange and session; rows without either go."""
    out = rows.select(_symbol(rows, "exchange_mic").alias("exchange_mic"), _day(rows, "session_date").alias("session_date"), _flag(rows, "is_half_day").alias("is_half_day"), _at(rows, now, "ingested_at").alias("ingested_at"))
    return keep_last(out.dropna(subset=["exchange_mic", "session_date"]), ["exchange_mic", "session_date"], ["ingested_at", "is_half_day"])


def cached_calendar(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """trading_calendar as the source cache holds it: every row is a trading day."""
    fixed = {"is_trading_day": F.lit(True), "currency": F.lit(None).cast("string"), "source": F.lit(CALENDAR_SOURCE), "source_updated_at": F.col("ingested_at")}
    return trading_calendar(rows, now).withColumns(fixed)


def _stamps(rows: DataFrame, now: Column | None) -> list[Column]:
    source = F.coalesce(_text(rows, "source", "provider"), F.lit(None if {"source", "provider"} & set(rows.columns) else SOURCE))
    return [source.alias("source"), _at(rows, now, "fetched_at", "updated_at").alias("fetched_at"), _at(rows, now, "updated_at").alias("updated_at")]


def profiles(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """One row a ticker: description, fund data, beta. Description and long summary stand in for each other."""
    out = rows.select(
        _symbol(rows, "ticker", "symbol").alias("ticker"), _text(rows, "description", "long_business_summary").alias("description"), _text(rows, "long_business_summary", "description").alias("long_business_summary"),
        _text(rows, "etf_category", "category_name").alias("etf_category"), _text(rows, "fund_family").alias("fund_family"), _value(rows, "expense_ratio", "fees_expense_ratio").alias("expense_ratio"),
        _day(rows, "inception_date", "fund_inception_date").alias("inception_date"), _text(rows, "legal_type").alias("legal_type"), _value(rows, "beta").alias("beta"), _value(rows, "beta_3y").alias("beta_3y"), *_stamps(rows, now),
    )
    return keep_last(out.dropna(subset=["ticker"]), ["ticker"], ["updated_at", "fetched_at", "description"])


def fund_holdings(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """One row a fund, listing key and day. The key is the one given, else figi, ISIN with market, ISIN, provider's symbol, or symbol with market or country."""
    given = {"holding_exchange": "source_exchange", "holding_exchange_mic": "source_exchange_mic", "holding_isin": "source_isin", "holding_figi": "source_figi", "provider_symbol": "onboard_symbol"}
    own = {c: _text(rows, c, other) for c, other in given.items()}
    holding, country = _symbol(rows, "holding_symbol"), _text(rows, "holding_country")
    built = listing_key(own["holding_figi"], own["holding_isin"], own["holding_exchange_mic"], own["provider_symbol"], country, holding)
    out = rows.select(
        _symbol(rows, "etf_ticker", "ticker").alias("etf_ticker"), holding.alias("holding_symbol"), _text(rows, "holding_name").alias("holding_name"), country.alias("holding_country"),
        F.coalesce(_text(rows, "holding_listing_key", "canonical_listing_key"), built).alias("holding_listing_key"), *(c.alias(n) for n, c in own.items()), _value(rows, "weight").alias("weight"), _day(rows, "as_of").alias("as_of"), *_stamps(rows, now),
    )
    return keep_last(out.dropna(subset=["etf_ticker", "holding_symbol", "as_of"]), ["etf_ticker", "holding_listing_key", "as_of"], ["updated_at", "fetched_at", "weight", "holding_symbol"])


def sector_weights(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """One row a fund, sector and day; rows without one of them or a weight go."""
    out = rows.select(_symbol(rows, "etf_ticker", "ticker").alias("etf_ticker"), _text(rows, "sector").alias("sector"), _value(rows, "weight").alias("weight"), _day(rows, "as_of").alias("as_of"), *_stamps(rows, now))
    return keep_last(out.dropna(subset=["etf_ticker", "sector", "as_of", "weight"]), ["etf_ticker", "sector", "as_of"], ["updated_at", "fetched_at", "weight"])
