"""Countries, regions and markets as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .symbols import SUFFIX_COUNTRY, country_of, let, lookup

# Names of countries, one alias of a code, the countries of each region, texts that name no country, and markets of suffixes.
COUNTRY_CODES = {
    "ARGENTINA": "AR", "AUSTRALIA": "AU", "AUSTRIA": "AT", "BAHAMAS": "BS", "BELGIUM": "BE", "BERMUDA": "BM", "BRAZIL": "BR", "CANADA": "CA",
    "CAYMAN ISLANDS": "KY", "CAYMAN ISLANDS THE": "KY", "CHILE": "CL", "CHINA": "CN", "COLOMBIA": "CO", "CZECH REPUBLIC": "CZ", "CZECHIA": "CZ",
    "DENMARK": "DK", "FINLAND": "FI", "FRANCE": "FR", "GERMANY": "DE", "GREAT BRITAIN": "GB", "GREECE": "GR", "HONG KONG": "HK", "HONG KONG SAR": "HK",
    "INDIA": "IN", "INDONESIA": "ID", "IRELAND": "IE", "ISRAEL": "IL", "ITALY": "IT", "JAPAN": "JP", "KOREA": "KR", "KOREA REPUBLIC OF": "KR",
    "KOREA REPUBLIC": "KR", "KOREA SOUTH": "KR", "LUXEMBOURG": "LU", "MALAYSIA": "MY", "MEXICO": "MX", "NETHERLANDS": "NL", "NEW ZEALAND": "NZ",
    "NORWAY": "NO", "PERU": "PE", "PHILIPPINES": "PH", "POLAND": "PL", "PORTUGAL": "PT", "PUERTO RICO": "PR", "RUSSIA": "RU", "RUSSIAN FEDERATION": "RU",
    "SINGAPORE": "SG", "SOUTH AFRICA": "ZA", "SOUTH KOREA": "KR", "SPAIN": "ES", "SWEDEN": "SE", "SWITZERLAND": "CH", "TAIWAN": "TW", "THAILAND": "TH",
    "TURKEY": "TR", "TURKIYE": "TR", "UNITED KINGDOM": "GB", "UNITED ARAB EMIRATES": "AE", "UNITED STATES": "US", "UNITED STATES OF AMERICA": "US",
    "URUGUAY": "UY", "UAE": "AE", "USA": "US", "UK": "GB",
}
REGIONS = {
    "US": ("US",),
    "AMER": ("AR", "BM", "BR", "BS", "CA", "CL", "CO", "KY", "MX", "PE", "PR", "UY"),
    "EU": ("AT", "BE", "CH", "CZ", "DE", "DK", "ES", "FI", "FR", "GB", "GR", "IE", "IT", "LU", "NL", "NO", "PL", "PT", "SE", "TR"),
    "APAC": ("AU", "CN", "HK", "ID", "IN", "JP", "KR", "MY", "NZ", "PH", "SG", "TH", "TW"),
}
NO_COUNTRY = (
    "", "NAN", "NONE", "NULL", "ALL", "AMER", "AMERICAS", "APAC", "ASIA PACIFIC", "EMEA", "EU", "EUROPE", "GLOBAL", "INTL", "INTERNATIONAL", "LATAM", "OTHER", "WORLD",
)
MARKETS = {".AX": "XASX", ".L": "XLON", ".DE": "XETR", ".HK": "XHKG", ".NS": "XBOM", ".BO": "XBOM", ".T": "XTKS", ".AS": "XAMS", ".PA": "XPAR", ".LS": "XLIS", ".CO": "XCSE", ".SS": "XSHG", ".SZ": "XSHG"}
DEFAULT_MARKET, OTHER_REGION = "XNYS", "OTHER"


def name_token(raw: Column) -> Column:
    """Upper case, anything but A-Z and digits as one space, trimmed; empty for null."""
    return F.coalesce(F.trim(F.regexp_replace(F.upper(F.trim(raw.cast("string"))), "[^A-Z0-9]+", " ")), F.lit(""))


def country_code(raw: Column) -> Column:
    """ISO code of a country's name or code; empty for null, regions and aggregates; an unknown name as its token."""
    return let(name_token(raw), lambda t: F.when(t.isin(*NO_COUNTRY), "").otherwise(F.coalesce(lookup(COUNTRY_CODES, t), t)))


def region_of(country: Column) -> Column:
    code = country_code(country)
    return F.coalesce(lookup({c: region for region, own in REGIONS.items() for c in own}, code), F.lit(OTHER_REGION))


def listing_country(source: Column, raw_symbol: Column, default: str = "US") -> Column:
    """The source's country, but the suffix's where the source says US and the suffix does not; else the suffix's, else the default."""
    told = lambda c: F.when((c["given"] == "US") & c["inferred"].isNotNull(), c["inferred"]).otherwise(F.coalesce(F.nullif(c["given"], F.lit("")), c["inferred"], F.lit(default)))
    return let(F.struct(country_code(source).alias("given"), country_of(raw_symbol).alias("inferred")), told)


def market_of(raw_symbol: Column) -> Column:
    """MIC of the market by the symbol's suffix; XNYS for any other."""
    token = F.upper(F.trim(raw_symbol))
    return F.coalesce(lookup(MARKETS, F.regexp_extract(token, r"(\.[A-Z]+)$", 1)), F.lit(DEFAULT_MARKET))


__all__ = ["COUNTRY_CODES", "DEFAULT_MARKET", "MARKETS", "NO_COUNTRY", "OTHER_REGION", "REGIONS", "SUFFIX_COUNTRY", "country_code", "listing_country", "market_of", "name_token", "region_of"]
