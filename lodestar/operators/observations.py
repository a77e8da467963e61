"""Raw provider payloads as observation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import day, instant, number, payload_hash, ratio, split_factor, symbol
from .timeseries import top_k

# Forms of filings that may hold guidance, and the signal words that are looked for in them, in order.
GUIDANCE_FORMS = ("8-K", "6-K")
FILING_SIGNALS = ("item 2.02", "item 7.01", "item 8.01", "ex-99.", "press release", "earnings release", "guidance", "outlook", "results")
#: Fields of a filing and their keys, who gives them, and where documents of filings are.
FILED = {"accession_number": "accessionNumber", "form_type": "form", "filing_date": "filingDate", "report_date": "reportDate", "acceptance_datetime": "acceptanceDateTime", "primary_document": "primaryDocument", "primary_doc_description": "primaryDocDescription"}
FILINGS_PROVIDER, FILING_ADDRESS = "sec_edgar", "https://www.sec.gov/Archives/edgar/data"
#: Signal words of other texts, in the order in which they are looked for.
GUIDANCE_SIGNALS = ("raises guidance", "lowers guidance", "reaffirms guidance", "withdraws guidance", "guidance", "outlook", "forecast")


def payload_items(payload: Column, keys: tuple[str, ...]) -> Column:
    """The objects of a payload as maps: a list, the first list under one of the keys, or a single object."""
    maps = "array<map<string,string>>"
    under = [F.from_json(F.get_json_object(payload, f"$.{k}"), maps) for k in keys]
    listed = F.when(F.ltrim(payload).startswith("["), F.from_json(payload, maps))
    return F.coalesce(listed, *under, F.array(F.from_json(payload, "map<string,string>")))


def first_key(item: Column, *names: str) -> Column:
    return F.coalesce(*(F.nullif(F.trim(F.try_element_at(item, F.lit(n))), F.lit("")) for n in names))


def observation_id(*columns: str) -> Column:
    """A digest of the columns as canonical JSON, nulls included: the same for the same values."""
    return payload_hash(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}))


def broken_payloads(raw: DataFrame) -> DataFrame:
    """(payload_id, provider, symbol, raw_payload) of successful payloads that are no JSON object or array."""
    broken = F.try_parse_json("raw_payload").isNull() | ~F.ltrim("raw_payload").rlike(r"^[\[{]")
    rows = raw.where((F.col("status") == "success") & F.coalesce(broken, F.lit(True)))
    return rows.select(F.sha2(F.concat_ws("|", "provider", "symbol", F.coalesce("raw_payload", F.lit(""))), 256).alias("payload_id"), "provider", "symbol", "raw_payload")


def corporate_actions(raw: DataFrame) -> DataFrame:
    """Dividends and splits of successful payloads (provider, symbol, status, raw_payload): one row for each id, rows without an ex-date go."""
    return top_k(corporate_action_rows(raw), ["observation_id"], [F.asc("ex_date")], 1)


def corporate_action_rows(raw: DataFrame) -> DataFrame:
    """corporate_actions with repeats: row by row, so that it runs on a stream as well."""
    items = raw.where("status = 'success'").select("provider", "symbol", F.explode(payload_items(F.col("raw_payload"), ("data", "results", "historical"))).alias("item"))
    i = F.col("item")
    factor = F.coalesce(split_factor(first_key(i, "ratio", "splitRatio")), ratio(number(first_key(i, "numerator")), number(first_key(i, "denominator"))))
    rows = items.select("provider", "symbol", day(first_key(i, "ex_date", "exDate", "date")).alias("ex_date"), number(first_key(i, "amount", "dividend", "adjDividend")).alias("amount"), factor.alias("factor")).where(F.col("ex_date").isNotNull())
    rows = rows.withColumn("action", F.when(F.col("factor").isNotNull(), "split").otherwise("dividend"))
    return rows.withColumn("observation_id", observation_id("provider", "symbol", "action", "ex_date", "amount", "factor"))


def filings(raw: DataFrame) -> DataFrame:
    """Filings of column-oriented payloads: arrays under one key, zipped by place, short ones filled with null."""
    own = "struct<accessionNumber:array<string>,form:array<string>,filingDate:array<string>>"
    zipped = F.from_json(F.get_json_object("raw_payload", "$.filings.recent"), own)
    rows = raw.where("status = 'success'").select("symbol", zipped.alias("z")).select("symbol", F.explode(F.arrays_zip(F.col("z.accessionNumber").alias("accession"), F.col("z.form").alias("form"), F.col("z.filingDate").alias("date"))).alias("f"))
    return rows.select("symbol", "f.accession", "f.form", day(F.col("f.date")).alias("filing_date")).where(F.col("accession").isNotNull())


def filing_observations(raw: DataFrame, provider: str = FILINGS_PROVIDER) -> DataFrame:
    """Filings with their addresses and hashes from payloads (symbol, cik, known_at, status, raw_payload), one row each observation.

    Recent filings are a list of objects or arrays under one key, zipped by place. Payloads without symbol, number or day of knowledge,
    and filings without accession, form or date, go. The address needs a document and an accession of letters and digits. The hash
    is of the canonical JSON of what was filed, the id of it with the day on which it was known; more_files says that older filings
    are in files of their own, which are not read.
    """
    # Each text is parsed once, into a column of its own, before the rows are taken apart.
    recent = F.col("_recent")
    arrays = F.from_json(recent, f"struct<{', '.join(f'{k}: array<string>' for k in FILED.values())}>")
    by_place = F.arrays_zip(*(F.coalesce(F.col("_arrays")[k], F.array().cast("array<string>")).alias(k) for k in FILED.values()))
    listed = F.from_json(recent, f"array<struct<{', '.join(f'{k}: string' for k in FILED.values())}>>")
    filer = F.trim("cik")
    more = F.coalesce(F.json_array_length(F.get_json_object("raw_payload", "$.filings.files")) > 0, F.lit(False))
    listing = F.ltrim(recent).startswith("[")
    parsed = raw.where("status = 'success'").withColumn("_recent", F.get_json_object("raw_payload", "$.filings.recent"))
    parsed = parsed.withColumns({"_listed": F.when(listing, listed), "_arrays": F.when(~listing, arrays)})
    own = parsed.select(
        symbol(F.col("symbol")).alias("symbol"), F.when(filer.rlike(r"^\d+$"), F.when(F.length(filer) < 10, F.lpad(filer, 10, "0")).otherwise(filer)).alias("cik"), day(F.col("known_at")).alias("known_at"), F.nullif(F.trim(F.get_json_object("raw_payload", "$.name")), F.lit("")).alias("company_name"),
        more.alias("more_files"), F.explode(F.when(listing, F.col("_listed")).otherwise(by_place)).alias("f"),
    )
    text = {c: F.nullif(F.trim(F.col("f")[k]), F.lit("")) for c, k in FILED.items()}
    typed = {"filing_date": day, "report_date": day, "acceptance_datetime": instant}
    rows = own.select("symbol", "cik", "known_at", "company_name", "more_files", *(typed.get(c, lambda x: x)(v).alias(c) for c, v in text.items()))
    rows = rows.dropna(subset=["symbol", "cik", "known_at", "accession_number", "form_type", "filing_date"])
    bare = F.regexp_replace("accession_number", "-", "")
    url = F.when(bare.rlike(r"^[\p{L}\p{N}]+$"), F.concat(F.lit(f"{FILING_ADDRESS}/"), F.regexp_replace("cik", r"^0+(?=\d)", ""), F.lit("/"), bare, F.lit("/"), F.col("primary_document")))
    rows = rows.withColumns({"filing_url": url, "provider": F.lit(provider)})
    accepted = F.date_format("acceptance_datetime", "yyyy-MM-dd'T'HH:mm:ss").alias("acceptance_datetime")
    body = F.struct("provider", "symbol", "cik", *(accepted if c == "acceptance_datetime" else c for c in FILED), "filing_url")
    rows = rows.withColumn("observation_hash", payload_hash(F.to_json(body, {"ignoreNullFields": "false"})))
    return rows.withColumn("observation_id", observation_id("observation_hash", "known_at")).dropDuplicates(["observation_id"])


def form_counts(rows: DataFrame) -> DataFrame:
    """Filings of each form: how many, first and last date."""
    return rows.groupBy("form").agg(F.count("*").alias("n"), F.min("filing_date").alias("first_date"), F.max("filing_date").alias("last_date"))


def signal_candidates(texts: DataFrame, signals: tuple[str, ...] = GUIDANCE_SIGNALS, before: int = 110, after: int = 150, most: int = 280) -> DataFrame:
    """Texts with a signal word: the first of the list that occurs, and what stands around it."""
    low = F.lower("text")
    found = texts.withColumn("signal", F.coalesce(*(F.when(low.contains(s), F.lit(s)) for s in signals))).where(F.col("signal").isNotNull())
    start = F.greatest(F.lit(1), F.instr(low, F.col("signal")) - before)
    end = F.instr(low, F.col("signal")) + F.length("signal") + after
    return found.withColumn("snippet", F.substring(F.regexp_replace(F.substring(F.col("text"), start, end - start), r"\s+", " "), 1, most))


def filing_candidates(filings: DataFrame) -> DataFrame:
    """Filings (form, text) of GUIDANCE_FORMS with a signal word: signal_candidates with FILING_SIGNALS."""
    return signal_candidates(filings.where(F.upper(F.trim("form")).isin(*GUIDANCE_FORMS)), FILING_SIGNALS)


def outcomes(results: DataFrame) -> DataFrame:
    """For each symbol: skipped if any provider was, unresolved if none found it, else resolved."""
    lost = F.bool_and(F.col("status").isin("not_found", "error"))
    return results.groupBy("symbol").agg(F.when(F.bool_or(F.col("status") == "skipped"), "skipped").when(lost, "unresolved").otherwise("resolved").alias("outcome"), F.count("*").alias("n"))
