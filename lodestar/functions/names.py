"""Legal and listing names as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .symbols import EXCHANGE_SUFFIX, let, listing_symbol, listing_symbol_on, lookup

# Legal forms, what listings add to a name, East Asian legal forms, spellings that a search tries, characters of East Asian scripts.
SUFFIXES = ("CO", "COMPANY", "INC", "INCORPORATED", "CORP", "CORPORATION", "PLC", "SE", "AG", "NV", "N V", "AS", "A S", "LTD", "LIMITED")
LISTING_PHRASES = ("SPONSORED ADR", "SPONS ADR", "SPON ADR", "DEPOSITARY RECEIPT", "NY REG SHS", "REG SHS", "COMMON STOCK", "CLASS A", "CLASS B", "CLASS C", "CL A", "CL B", "CL C", "ADR", "ADS", "SHS")
CJK_SUFFIXES = ("株式会社", "有限会社", "合同会社", "股份有限公司", "有限公司", "有限责任公司", "股份有限会社", "주식회사")
SPELLINGS = {"CO": ("COMPANY", "CO"), "COMPANY": ("COMPANY", "CO"), "CORP": ("CORPORATION", "CORP"), "CORPORATION": ("CORPORATION", "CORP"), "LTD": ("LIMITED", "LTD"), "LIMITED": ("LIMITED", "LTD"), "INC": ("INC", "INCORPORATED"), "INCORPORATED": ("INCORPORATED", "INC"), "NV": ("NV", "N.V.")}
CJK = r"぀-ヿ㐀-䶿一-鿿豈-﫿가-힯"

# Symbols that a provider knows under given names, and the exchanges that are tried in a region.
OVERRIDES = {"ANZ": ("ANZ.AX", "ANZ"), "WBC": ("WBC.AX", "WBC"), "WOW": ("WOW.AX", "WOW")}
REGION_EXCHANGES = {"eu": ("LSE", "ETR", "AMS", "EPA", "LIS", "CSE", "BIT"), "apac": ("ASX", "HKEX", "TSE", "NSE", "SHG", "SHE")}

_LEGAL_FORMS = "|".join(sorted((*SUFFIXES, "THE"), key=len, reverse=True))


def _without(c: Column, *patterns: str) -> Column:
    for p in patterns:
        c = F.regexp_replace(c, p, " ")
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def cleaned_name(raw: Column) -> Column:
    """Upper case, & as AND, marks as blanks, Latin and East Asian words apart; null tokens are empty."""
    text = F.upper(F.trim(raw.cast("string")))
    text = F.replace(F.replace(F.replace(text, F.lit("&"), F.lit(" AND ")), F.lit("N.V."), F.lit(" NV ")), F.lit("A/S"), F.lit(" AS "))
    spaced = _without(text, r"[-_/.,()]+", rf"[^\p{{L}}\p{{N}}\s{CJK}]", rf"(?<=[A-Za-z0-9])(?=[{CJK}])|(?<=[{CJK}])(?=[A-Za-z0-9])")
    return F.when(F.upper(F.trim(raw.cast("string"))).isin("NAN", "NONE", "NULL", "N/A") | raw.isNull(), "").otherwise(spaced)


def listing_base(raw: Column) -> Column:
    """A cleaned name without what its listing adds: receipts, share classes, registrations."""
    base = _without(cleaned_name(raw), rf"\b(?:{'|'.join(LISTING_PHRASES)})\b", r"\b(?:NY|REG)\b", r"\bCL\b\s+\b[A-Z]\b", r"\bCLASS\b\s+\b[A-Z]\b")
    return _without(base, r"(?:(?:^|\s)[ABC])+$")


def _without_legal_forms(name: Column) -> Column:
    return _without(name, r"^(?:THE(?:\s|$))+", rf"(?:(?:^|\s)(?:{_LEGAL_FORMS}))+$")


def legal_name(raw: Column) -> Column:
    """The conservative key of a name: without listing words, articles at its ends, share classes and legal forms."""
    base = _without(listing_base(raw), rf"(?:\s*(?:{'|'.join(CJK_SUFFIXES)}))+$", r"^(?:THE(?:\s|$))+", r"(?:(?:^|\s)THE)+$", r"(?:(?:^|\s)[ABC])+$")
    return _without_legal_forms(base)


def has_cjk(c: Column) -> Column:
    return F.coalesce(c.rlike(f"[{CJK}]"), F.lit(False))


def name_flags(raw: Column, normalised: Column) -> dict[str, Column]:
    """Risks of a normalised name: too short, an acronym only, an East Asian name of which only an acronym or no own word is left."""
    compact = F.regexp_replace(normalised, "[^A-Z0-9]+", "")
    acronym = normalised.rlike("^[A-Z0-9]{2,4}(?: [A-Z0-9]{2,4})*$")
    lost = has_cjk(raw) & ~has_cjk(normalised)
    return {
        "normalized_name_too_short": F.length(compact).between(1, 3) & ~has_cjk(normalised),
        "normalized_name_acronym_only": acronym,
        "cjk_name_collapsed_to_latin_acronym": lost & acronym,
        "distinctive_tokens_removed": lost & has_cjk(F.regexp_replace(raw, f"(?:{'|'.join(CJK_SUFFIXES)})$", "")),
    }


def _titled(c: Column) -> Column:
    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(r"\p{L}+|\P{L}+"), F.lit(0)), F.initcap), "")


def search_names(raw: Column) -> Column:
    """Names to search for, in order: spellings of the listing's legal forms, each also without them, each also without or with a moved article."""
    spelled = F.create_map(*(x for k, v in SPELLINGS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    ways = lambda token: F.coalesce(F.try_element_at(spelled, token), F.array(token))
    join = lambda acc, token: F.flatten(F.transform(acc, lambda left: F.transform(ways(token), lambda w: F.concat_ws(" ", F.nullif(left, F.lit("")), w))))
    all_ways = F.aggregate(F.split(listing_base(raw), " "), F.array(F.lit("")), join)
    # Names without an article, as most are, need no search for one.
    edge = lambda c: F.when(c.contains("THE"), _without(c, r"^(?:THE(?:\s|$))+", r"(?:(?:^|\s)THE)+$")).otherwise(c)
    moved = lambda c: F.when(c.endswith("THE") & c.rlike(r"(?:^|\s)THE$"), F.concat(F.lit("THE "), _without(c, r"(?:^|\s)THE$")))
    # N.V. is a spelling of a search only; as a legal form it counts as N V.
    bare = lambda c: _without_legal_forms(_without(c, r"(?:(?:^|\s)N\.V\.)+$"))
    forms = lambda c: F.array(c, edge(c), moved(c), edge(moved(c)), bare(c))
    found = F.array_distinct(F.transform(F.array_distinct(F.array_compact(F.flatten(F.transform(all_ways, forms)))), lambda c: _titled(F.trim(c))))
    return F.filter(found, lambda c: c != "")


def provider_symbols(raw: Column, region: Column, exchange: Column) -> Column:
    """Symbols to ask a provider for, in order: fixed ones, the exchange's suffix, those of the region's exchanges, the bare symbol. A symbol with a suffix has no more."""
    none = F.expr("cast(array() as array<string>)")

    def named(symbol: Column) -> Column:
        fixed = F.coalesce(F.try_element_at(F.create_map(*(x for k, v in OVERRIDES.items() for x in (F.lit(k), F.array(*map(F.lit, v))))), symbol), none)
        places = F.coalesce(F.try_element_at(F.create_map(*(x for k, v in REGION_EXCHANGES.items() for x in (F.lit(k), F.array(*map(F.lit, v))))), F.lower(F.trim(region))), none)
        places = F.concat(F.coalesce(F.array(F.nullif(F.upper(F.trim(exchange)), F.lit(""))), none), places)
        tried = F.filter(F.transform(F.array_compact(places), lambda e: F.when(lookup(EXCHANGE_SUFFIX, e).isNotNull(), listing_symbol_on(symbol, e))), lambda s: s.isNotNull())
        return F.array_distinct(F.when(symbol == "", none).when(symbol.contains("."), F.concat(fixed, F.array(symbol))).otherwise(F.concat(fixed, tried, F.array(symbol))))

    return let(listing_symbol(raw), named)
