"""One scan over text files whose headers differ: header and columns are found for each file."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import day

#: A comma outside quotes.
_COMMA = r',(?=(?:[^"]*+"[^"]*+")*+[^"]*+$)'

# Names of the columns of holdings files, in the order in which they are looked for, and what a header line holds.
HOLDINGS = {
    "symbol": ("ticker", "symbol", "holding_symbol", "Holding Ticker", "Stock Ticker", "Identifier"),
    "name": ("company", "name", "holding_name", "Security Name", "Security Description", "Description", "Issuer Name", "Issue Name"),
    "weight": ("Weight (%)", "% of Net Assets", "Holding Percent", "Percent", "Pct", "Portfolio Weight %", "Weighting", "Weightings"),
    "as_of": ("date", "as_of", "asOfDate", "Fund Holdings Data as of"),
    "asset_class": ("asset_class", "Class", "Security Type", "Type"),
    "country": ("country", "location", "Country/Region", "Domicile", "Geography", "Market"),
}
HEADER = (("ticker", "symbol", "identifier"), ("weight", "netassets", "pct"))
_MARKS = "[^a-z0-9]*"
_AS_OF = r"(?i)(?:as\s+of|data\s+as\s+of|holdings\s+as\s+of)[^0-9]*([0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{4}-[0-9]{1,2}-[0-9]{1,2})"


def _token(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def any_day(c: Column) -> Column:
    """A date written as ISO or as month/day/year."""
    return F.coalesce(day(c), F.try_to_timestamp(c, F.lit("M/d/yyyy")).cast("date"))


def read_layouts(spark: SparkSession, path: str, aliases: Mapping[str, Sequence[str]] = HOLDINGS, header: Sequence[Sequence[str]] = HEADER) -> DataFrame:
    """file, seq, all columns of aliases as text, and stated (the date that lines above the header say) of each line below a file's header.

    The header is a file's first line with a word of each group of `header`; names are compared without case, blanks and marks, and an
    absent column is null. A file without a header gives no rows. Lines are scanned twice, once for headers, of which there is one a file;
    large files are split. A field may hold commas in quotes, but no line break.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n")).alias("seq"))
    lines = lines.where(F.trim("value") != "")
    low = F.lower("value")
    is_header = F.lit(True)
    for group in header:
        is_header &= low.rlike("|".join(_MARKS.join(word) for word in group))
    found = F.when(low.contains("as"), F.regexp_extract("value", _AS_OF, 1))
    unquoted = lambda x: F.when(x.contains('"'), F.replace(F.regexp_replace(F.trim(x), '^"|"$', ""), F.lit('""'), F.lit('"'))).otherwise(F.trim(x))
    fields = lambda c: F.transform(F.split(c, _COMMA, -1), unquoted)
    marked = lines.where(is_header | (found != "")).groupBy("file").agg(F.min(F.when(is_header, F.struct("seq", "value"))).alias("h"), F.min(F.when(found != "", F.struct("seq", found.alias("found")))).alias("s"))
    heads = marked.where("h IS NOT NULL").select(
        "file", F.col("h.seq").alias("_header"), F.transform(fields(F.col("h.value")), lambda x: _token(F.coalesce(x, F.lit("")))).alias("_names"), F.when(F.col("s.seq") <= F.col("h.seq"), any_day(F.col("s.found"))).alias("stated"),
    )
    place = lambda names: F.coalesce(*(F.nullif(F.array_position("_names", "".join(x for x in n.lower() if x.isalnum())), F.lit(0).cast("long")) for n in names))
    heads = heads.select("file", "_header", *(place(names).cast("int").alias(f"_{c}") for c, names in aliases.items()), "stated")
    # Heads are one row a file, so they are what a task keeps, and lines need no sort. A line is split once: nothing moves below a generator.
    below = lines.join(heads.hint("shuffle_hash"), "file").where(F.col("seq") > F.col("_header"))
    below = below.select("file", "seq", "stated", *(f"_{c}" for c in aliases), fields(F.col("value")).alias("_fields"))
    named = F.struct(*(F.get("_fields", F.col(f"_{c}") - 1).alias(c) for c in aliases))
    return below.select("file", "seq", "stated", F.inline(F.array(named))).select("file", "seq", *aliases, "stated")
