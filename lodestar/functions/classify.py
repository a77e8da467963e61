"""What an instrument, a holding, a source label or a note stands for, as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .casts import number, symbol, tri_state
from .symbols import EXCHANGE_SUFFIX, is_placeholder, let, lookup

# Names of instrument types, proxies, country funds; currencies and markers of what is no equity; aliases of described fields.
INSTRUMENT_TYPES = ("equity", "adr", "etf", "index_proxy", "country_fund", "unknown")
INDEX_PROXIES = ("SPY", "QQQ", "DIA", "IWM", "VOO", "VTI")
COUNTRY_FUNDS = ("VGK", "EZU", "FEZ", "EWJ", "EWT", "MCHI", "KWEB", "FXI", "ILF", "EWZ", "EWW", "EZA", "AFK", "EIS", "EPHE", "THD", "EIDO", "EWY", "EWA", "EWS", "EWM")
CURRENCIES = ("USD", "EUR", "GBP", "JPY", "CAD", "AUD", "CHF", "HKD", "SEK", "NOK", "DKK", "KRW", "CNY")
NO_SYMBOL = ("NAN", "NONE", "NULL", "CASH", "CASH_USD")
CASH_NAMES = ("CASH", "US DOLLAR", "U.S. DOLLAR")
NOT_EQUITY = (
    "CASH", "CSH FND", "TREASURY BILL", "TREASURY SL AGENCY", "MONEY MARKET", "REPURCHASE AGREEMENT", "COLLATERAL", "FUTURE", "SWAP", "WARRANT", "OPTION", "RIGHTS", "RECEIVABLE", "PAYABLE",
)
DESCRIBED = {
    "name": ("name", "shortName", "longName"),
    "sector": ("sector", "sectorKey", "sector_key"),
    "industry": ("industry", "industryKey", "industry_key"),
    "description": ("description", "longBusinessSummary", "long_business_summary"),
}
_SUFFIXES = tuple(sorted(set(EXCHANGE_SUFFIX.values())))


def _text(c: Column) -> Column:
    return F.upper(F.trim(F.coalesce(c, F.lit(""))))


def equity_like(raw_symbol: Column, name: Column, asset_class: Column) -> Column:
    """Whether a holding is a share: no other asset class, no cash, currency or placeholder as symbol, no marker of cash or a derivative in the name."""
    token, title, kind = _text(raw_symbol), _text(name), _text(asset_class)
    bad_symbol = token.isin("", *NO_SYMBOL, *CURRENCIES) | is_placeholder(raw_symbol) | token.rlike(r"^-?[A-Z]{3}\s*CASH-?$") | token.rlike(r"^[A-Z]{3}\s*(CURNCY|CURRENCY)$")
    marked = title.isin(*CASH_NAMES) | title.rlike("|".join(NOT_EQUITY))
    shares = kind.isin("EQUITY", "STOCK")
    return ((kind == "") | shares) & ~bad_symbol & ~marked & (token.rlike("[A-Z]") | (shares & token.rlike(r"^[0-9.\\-]+$")))


def instrument_types(df: DataFrame, candidate: Column, hint: Column, exchange: Column, metadata: Column, overrides: Mapping[str, str] | None = None, entered: Column | None = None) -> DataFrame:
    """df with type and source: by override of the candidate symbol and then the entered one, by hint, by what a provider says (a map of
    texts), or by the candidate symbol and exchange, in this order.

    Texts that several rules read are columns of their own, so the plan stays as small as the rules are.
    """
    field = lambda *names: F.coalesce(*(F.nullif(F.try_element_at(F.col("_said"), F.lit(n)), F.lit("")) for n in names))
    words = (("shortName", "short_name"), ("longName", "long_name"), ("category",), ("fundFamily", "fund_family"))
    given = lambda c: F.coalesce(symbol(c), F.lit(""))
    told = df.withColumns({"_token": given(candidate), "_entered": given(candidate if entered is None else entered), "_hint": F.lower(F.trim(hint)), "_said": metadata, "_exchange": _text(exchange)})
    told = told.withColumns(
        {
            "_quoted": F.replace(_text(field("quoteType", "quote_type", "securityType", "security_type")), F.lit(" "), F.lit("")),
            "_words": F.concat(F.lit(" "), F.concat_ws(" ", *(F.nullif(F.upper(field(*n)), F.lit("")) for n in words)), F.lit(" ")),
            "_flagged": F.coalesce(tri_state(field("isAdr", "is_adr")), F.lit(False)),
        }
    )
    token, quoted, padded = F.col("_token"), F.col("_quoted"), F.col("_words")
    told = told.withColumns(
        {
            "_fund": F.when(token.isin(*COUNTRY_FUNDS) | padded.contains(" MSCI ") | padded.contains(" COUNTRY "), "country_fund").otherwise("etf"),
            "_receipt": padded.contains(" ADR") | padded.contains(" ADS"),
            "_proxy": token.isin(*INDEX_PROXIES),
        }
    )
    by_provider = (
        F.when(quoted == "INDEX", "index_proxy")
        .when(quoted.isin("ETF", "MUTUALFUND", "FUND"), F.col("_fund"))
        .when(quoted == "ADR", "adr")
        .when(quoted.isin("EQUITY", "COMMONSTOCK", "STOCK"), F.when(F.col("_flagged") | F.col("_receipt"), "adr").otherwise("equity"))
        .when(padded.contains(" ETF") | padded.contains(" FUND"), F.col("_fund"))
        .when(padded.contains(" INDEX") & F.col("_proxy"), "index_proxy")
        .when(F.col("_receipt"), "adr")
    )
    by_symbol = (
        F.when(F.col("_proxy") | token.startswith("^"), "index_proxy")
        .when(token.isin(*COUNTRY_FUNDS) | (token.startswith("EW") & (F.length(token) <= 4)), "country_fund")
        .when(token.contains(".") & F.element_at(F.split(token, r"\."), -1).isin(*_SUFFIXES), "equity")
        .when(F.col("_exchange") != "", "equity")
    )
    forced = F.coalesce(lookup(dict(overrides), token), lookup(dict(overrides), F.col("_entered"))) if overrides else F.lit(None).cast("string")
    found = told.withColumns({"_forced": forced, "_known": F.when(F.col("_hint").isin(*INSTRUMENT_TYPES), F.col("_hint")), "_by_provider": by_provider, "_by_symbol": by_symbol})
    ways = {"_forced": "explicit_override", "_known": "input_hint", "_by_provider": "provider_metadata", "_by_symbol": "symbol_heuristic"}
    source = F.coalesce(*(F.when(F.col(c).isNotNull(), F.lit(s)) for c, s in ways.items()), F.lit("fallback_unknown"))
    return found.select(*(F.col(f"`{c}`") for c in df.columns), F.coalesce(*ways, F.lit("unknown")).alias("type"), source.alias("source"))


def provenance(source: Column) -> Column:
    """Class of a release source by how its label begins or what it holds."""
    token = F.lower(_text(source))
    holds = lambda *words: token.rlike("|".join(words))
    return (
        F.when(token.startswith("alfred"), "ALFRED-native")
        .when(token.startswith("fred_release_calendar") | holds("official"), "official release calendar")
        .when(holds("inferred"), "inferred")
        .when(holds("manual", "fixture", "lapse"), "fixture/manual exception")
        .when(holds("missing", "canceled", "cancelled"), "canceled/missing")
        .otherwise("unknown")
    )


def notes_text(raw: Column) -> Column:
    """Notes as stored: empty for texts that stand for null, JSON objects and lists with sorted keys and no blanks, any other text trimmed."""
    token = F.trim(raw)
    stored = lambda t: F.when(F.substring(t, 1, 1).isin("{", "["), F.to_json(F.try_parse_json(t)))
    return let(token, lambda t: F.when(t.isNull() | F.upper(t).isin("", "NONE", "NULL", "NAN"), "").otherwise(F.coalesce(stored(t), t)))


def note_fields(raw: Column) -> Column:
    """Notes as a map of texts: a JSON object's fields, else the parts of "k=v;k=v", else the whole text as `raw`; empty for null."""
    text = notes_text(raw)
    parts = F.filter(F.transform(F.split(text, ";"), F.trim), lambda p: p.rlike(r"^[^=]*[^=\s][^=]*="))
    pairs = F.transform(parts, lambda p: F.struct(F.trim(F.regexp_extract(p, "^([^=]*)=", 1)).alias("k"), F.trim(F.regexp_extract(p, "(?s)^[^=]*=(.*)$", 1)).alias("v")))
    last = F.filter(pairs, lambda p: F.element_at(F.filter(pairs, lambda q: q["k"] == p["k"]), -1) == p)
    as_map = F.map_from_entries(F.array_distinct(last))
    whole = F.create_map(F.lit("raw"), text)
    none = F.map_from_entries(F.expr("cast(array() as array<struct<k:string,v:string>>)"))
    return F.when(text == "", none).when(text.startswith("{"), F.coalesce(F.from_json(text, "map<string,string>"), whole)).otherwise(F.when(F.size(pairs) > 0, as_map).otherwise(whole))


def described(metadata: Column) -> dict[str, Column]:
    """name, sector, industry and description from a map of texts: the first alias with a text that doesn't stand for null."""
    own = lambda key: let(F.trim(F.try_element_at(metadata, F.lit(key))), lambda t: F.when(~F.lower(t).isin("", "none", "nan", "null"), t))
    return {field: F.coalesce(*map(own, names)) for field, names in DESCRIBED.items()}


def fiscal_year(given: Column, period_end: Column) -> Column:
    return F.coalesce(number(given).cast("int"), F.year(period_end))


def fiscal_quarter(period: Column, period_end: Column) -> Column:
    """Q1 to Q4 as the period says, else by the month of its end."""
    said = F.nullif(F.regexp_extract(F.upper(period), "(Q[1-4])", 1), F.lit(""))
    return F.coalesce(said, F.concat(F.lit("Q"), F.quarter(period_end).cast("string")))


def period_type(given: Column, period: Column) -> Column:
    """The given type, else the period's text, else unknown; lower case."""
    token = lambda c: let(F.lower(F.trim(c)), lambda t: F.when(~t.isin("", "nan", "none", "nat", "<na>"), t))
    return F.coalesce(token(given), token(period), F.lit("unknown"))
