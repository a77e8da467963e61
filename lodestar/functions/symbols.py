"""Listing symbols, countries and identifiers as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import symbol

# What listing suffixes and exchange codes stand for.
SUFFIX_COUNTRY = {
    "AT": "AT", "DE": "DE", "E": "TR", "AS": "NL", "PA": "FR", "LS": "PT", "L": "GB", "R": "RU", "CO": "DK", "AX": "AU", "T": "JP", "HK": "HK", "NS": "IN", "BO": "IN", "SS": "CN", "SZ": "CN",
    "KS": "KR", "KQ": "KR", "TW": "TW", "SI": "SG", "KL": "MY", "JK": "ID", "BK": "TH", "SW": "CH", "ST": "SE", "TO": "CA", "MI": "IT", "MC": "ES", "OL": "NO",
}
EXCHANGE_SUFFIX = {"ASX": "AX", "HKEX": "HK", "TSE": "T", "NSE": "NS", "BSE": "BO", "LSE": "L", "TSX": "TO", "ETR": "DE", "AMS": "AS", "EPA": "PA", "LIS": "LS", "CSE": "CO", "BIT": "MI", "SHG": "SS", "SHE": "SZ"}
CODE_SUFFIX = {
    "US": "", "UW": "", "UN": "", "UR": "", "UQ": "", "LN": "L", "L": "L", "GR": "DE", "GY": "DE", "GA": "AT", "DE": "DE", "FP": "PA", "NA": "AS", "SW": "SW", "SE": "ST", "SS": "SS", "CH": "SW", "HK": "HK", "JP": "T", "JT": "T",
    "AU": "AX", "AT": "AX", "AB": "ST", "C1": "SS", "C2": "SZ", "CN": "TO", "CT": "TO", "KS": "KS", "KQ": "KQ", "TT": "TW", "TW": "TW", "IT": "MI", "IM": "MI", "SM": "MC", "DC": "CO", "NO": "OL",
}
HONG_KONG_NUMBERS = ("700", "9988", "3690")
TOKYO_NUMBERS = ("6758", "6501", "6503", "6861", "7203", "7267", "7974", "8035", "8058", "8306", "9432")


def lookup(values: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in values.items() for x in pair)), key)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _number_suffix(token: Column) -> Column:
    bare = F.regexp_replace(token, "^0+(?=.)", "")
    return F.when(bare.isin(*HONG_KONG_NUMBERS), "HK").when(bare.isin(*TOKYO_NUMBERS), "T")


def _code_as_suffix(token: Column) -> Column:
    base = F.regexp_replace(token, " [^ ]+$", "")
    with_suffix = lambda suffix: F.when(suffix.isNull(), token).when(suffix == "", base).otherwise(F.concat(base, F.lit("."), suffix))
    return F.when(token.contains(" "), let(lookup(CODE_SUFFIX, F.regexp_extract(token, " ([^ ]+)$", 1)), with_suffix)).otherwise(token)


def _number_with_suffix(token: Column) -> Column:
    six = F.when(token.startswith("600"), "SS").when(token.rlike("^(000|002|300)"), "SZ")
    return F.when(token.rlike("^[0-9]+$"), F.concat_ws(".", token, F.when(F.length(token) == 6, six).otherwise(_number_suffix(token)))).otherwise(token)


def _four_digits(token: Column) -> Column:
    return F.when(token.rlike(r"^[0-9]{1,3}\.HK$"), F.lpad(token, 7, "0")).otherwise(token)


def _unless_plain(raw: Column, otherwise: Column) -> Column:
    """Upper case alone for a symbol without blank, / and leading digit, on which no rule acts, country's or other; most are such."""
    token = F.upper(F.trim(raw))
    return F.when(token.rlike(r"^[^0-9\s/][^\s/]*\z"), token).otherwise(otherwise)


def listing_symbol(raw: Column) -> Column:
    """Canonical listing symbol: upper case, / as -, a spaced exchange code or a known bare number as a suffix, Hong Kong numbers of four digits."""
    out = F.regexp_replace(F.translate(F.upper(F.trim(raw)), "/", "-"), r"\s+", " ")
    for step in (_code_as_suffix, _number_with_suffix, _four_digits):
        out = let(out, step)
    return _unless_plain(raw, F.coalesce(out, F.lit("")))


def listing_symbol_on(raw: Column, exchange: Column) -> Column:
    suffix = lookup(EXCHANGE_SUFFIX, F.upper(F.trim(exchange)))
    return listing_symbol(F.when(suffix.isNotNull(), F.concat_ws(".", F.trim(raw), suffix)).otherwise(raw))


def listing_symbol_in(raw: Column, country: Column) -> Column:
    """listing_symbol; a number without a suffix takes that of its country."""
    place = F.upper(F.trim(country))

    def with_suffix(token: Column) -> Column:
        suffix = F.when(place.isin("HK", "HONG KONG", "HONG KONG SAR") & token.rlike("^[0-9]{1,4}$"), "HK").when(place.isin("JP", "JAPAN") & token.rlike("^[0-9]{4}$"), "T").when(place.isin("TW", "TAIWAN") & token.rlike("^[0-9]{4}$"), "TW")
        return _four_digits(F.concat_ws(".", token, suffix))

    return _unless_plain(raw, let(listing_symbol(raw), with_suffix))


def country_of(raw: Column) -> Column:
    """The country that a symbol's suffix or spaced exchange code says; one without dot, blank or bare number has none, which is cheap to see."""
    suffix = F.regexp_extract(listing_symbol(raw), r"\.([A-Z]+)$", 1)
    return F.when(raw.rlike(r"[.\s]|^[0-9]+$"), lookup(SUFFIX_COUNTRY, F.nullif(suffix, F.lit(""))))


def is_placeholder(raw: Column, digits: int = 4) -> Column:
    """At least so many digits and one letter: an identifier that stands in for a symbol."""
    return F.coalesce(symbol(raw).rlike(f"^[0-9]{{{digits},}}[A-Z]$"), F.lit(False))


def isin_is_valid(isin: Column) -> Column:
    """Form and check digit: letters count as two digits, every second digit from the right is doubled."""
    token = F.upper(F.trim(isin))
    digits = F.split(F.array_join(F.transform(F.split(F.substring(token, 1, 11), ""), lambda c: F.conv(c, 36, 10)), ""), "")
    doubled = F.transform(F.reverse(digits), lambda d, i: F.when(i % 2 == 0, F.floor(d.cast("int") * 2 / 10) + d.cast("int") * 2 % 10).otherwise(d.cast("int")).cast("int"))
    total = F.aggregate(doubled, F.lit(0), lambda a, x: a + x)
    ok = F.when(token.rlike("^[A-Z]{2}[A-Z0-9]{9}[0-9]$"), (10 - total % 10) % 10 == F.substring(token, 12, 1).try_cast("int"))
    return F.coalesce(ok, F.lit(False))


def listing_key(figi: Column, isin: Column, mic: Column, provider: Column, country: Column, token: Column) -> Column:
    """The first of figi, isin and mic, isin, provider symbol, mic and symbol, country and symbol, symbol that is there."""
    own = [F.nullif(F.upper(F.trim(c)), F.lit("")) for c in (figi, isin, mic, provider, country, token)]
    figi, isin, mic, provider, country, token = own
    return F.coalesce(F.concat(F.lit("figi:"), figi), F.concat(F.lit("isin:"), isin, F.lit(":mic:"), mic), F.concat(F.lit("isin:"), isin), F.concat(F.lit("provider:"), provider), F.concat(F.lit("mic:"), mic, F.lit(":symbol:"), token), F.concat(F.lit("country:"), country, F.lit(":symbol:"), token), F.concat(F.lit("symbol:"), token))


def registry_key(token: Column, region: Column, exchange: Column) -> Column:
    """SYMBOL|region|EXCHANGE; a region that isn't there is global, an exchange default, a symbol empty."""
    place = F.nullif(F.lower(F.trim(region)), F.lit(""))
    return F.concat_ws("|", F.coalesce(symbol(token), F.lit("")), F.coalesce(place, F.lit("global")), F.coalesce(symbol(exchange), F.lit("default")))
