"""Lenient casts and text clean-up as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that stand for null, true and false.
NULL_TOKENS = ("", "nan", "none", "nat", "<na>")
TRUE_TOKENS, FALSE_TOKENS = ("true", "t", "1", "yes", "y"), ("false", "f", "0", "no", "n")


def number(c: Column) -> Column:
    """The value as double, null where it can't be parsed."""
    return c.try_cast("double")


def day(c: Column) -> Column:
    return c.try_cast("date")


def instant(c: Column) -> Column:
    return c.try_cast("timestamp")


def first_present(df: DataFrame, *names: str) -> Column:
    """The first of the named columns that df has, else a null text."""
    return next((F.col(n) for n in names if n in df.columns), F.lit(None).cast("string"))


def no_null_tokens(c: Column) -> Column:
    """Null for texts that stand for null; other texts as they are, untrimmed."""
    return F.when(~F.lower(F.trim(c)).isin(*NULL_TOKENS), c)


def tri_state(c: Column) -> Column:
    token = F.lower(F.trim(c.cast("string")))
    return F.when(token.isin(*TRUE_TOKENS), True).when(token.isin(*FALSE_TOKENS), False)


def symbol(c: Column) -> Column:
    """Trimmed upper case; null where nothing is left."""
    return F.nullif(F.upper(F.trim(c.cast("string"))), F.lit(""))


def weight(c: Column) -> Column:
    """A weight text without % and commas, as double."""
    return number(F.regexp_replace(c, "[%,]", ""))


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, null where bottom is zero or null."""
    return F.try_divide(top.cast("double"), F.nullif(bottom.cast("double"), F.lit(0.0)))


def split_factor(c: Column) -> Column:
    """"4:1" or "3/2" as a factor; null for anything else or a zero denominator."""
    parts = F.split(c, "[:/]")
    return F.when(F.size(parts) == 2, ratio(number(F.trim(parts[0])), number(F.trim(F.get(parts, 1)))))


def near(a: Column, b: Column, tolerance: float) -> Column:
    """Whether two values are equal up to a share of the larger one."""
    return F.abs(a - b) <= tolerance * F.greatest(F.abs(a), F.abs(b), F.lit(1e-300))


def scale_factor(a: Column, b: Column) -> Column:
    """1e3, 1e6 or 1e9 where one value is that many times the other within 1 %, else null."""
    r = F.greatest(F.abs(ratio(a, b)), F.abs(ratio(b, a)))
    return F.coalesce(*(F.when(F.abs(r / f - 1) <= 0.01, F.lit(f)) for f in (1e3, 1e6, 1e9)))


def canonical_json(c: Column) -> Column:
    """A JSON text with its keys sorted at every depth, no spaces and one form of a number (1, 1.0 and 1.00 are 1); null where it is no JSON.

    Letters are not escaped. Numbers with an exponent are doubles, so those of 10^7 or more keep one (1e10 is 1.0E10 and not 10000000000).
    """
    return F.regexp_replace(F.to_json(F.try_parse_json(c)), r'("(?:[^"\\]|\\.)*+")|(-?\d+)\.0(?=[,}\]]|$)', "$1$2")


def payload_hash(c: Column) -> Column:
    """SHA-256 of a JSON text's canonical form: the same for reordered keys and other spellings of a number."""
    return F.sha2(canonical_json(c), 256)
