"""Published rows, canonical JSON and mappings, on small rows with known results."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from lodestar.functions import casts
from lodestar.operators import events, mapping, observations, payloads, published

def now():
    return F.lit("2024-05-01 00:00:00").cast("timestamp")


def rows(spark, names, *values):
    return spark.createDataFrame(list(values), ", ".join(f"{n} string" for n in names.split()))


def test_prices_need_symbol_date_and_close(spark):
    given = rows(spark, "symbol date close volume ingested_at", ("a", "2024-01-02", "5", "10.9", None), ("a", "2024-01-02", "5", "x", "2024-02-01"), ("nan", "2024-01-02", "5", "1", None), ("b", "soon", "5", "1", None), ("b", "2024-01-02", "NaN", "1", None))
    got = published.prices(given, now()).orderBy("source_updated_at").collect()
    assert [(r.symbol, str(r.price_date), r.close, r.open, r.volume, str(r.source_updated_at), str(r.ingested_at)) for r in got] == [
        ("A", "2024-01-02", 5.0, None, None, "2024-02-01 00:00:00", "2024-02-01 00:00:00"),
        ("A", "2024-01-02", 5.0, None, 10, "2024-05-01 00:00:00", "2024-05-01 00:00:00"),
    ]


def test_the_row_updated_last_is_published_and_an_absent_time_is_now(spark):
    given = rows(spark, "series_key observation_period observation_date value fetched_at", ("k", "p", "2024-01-01", "1", "2024-04-01"), ("k", "p", "2024-01-01", "2", None), ("k", "p", "2024-01-01", None, "2025-01-01"), (" ", "p", "2024-01-01", "3", None))
    assert [(r.series_key, r.value) for r in published.macro_observations(given, now()).collect()] == [("k", 2.0)]
    empty = given.limit(0)
    for f in (published.prices, published.series_catalog, published.macro_observations, published.macro_daily, published.cached_macro_daily, published.trading_calendar, published.cached_calendar, published.profiles, published.fund_holdings, published.sector_weights):
        assert f(empty, now()).collect() == []


def test_a_value_of_a_day_may_be_null_but_not_its_source(spark):
    names = "as_of_date series_key value source_observation_period source_observation_date available_at_utc is_stale"
    full = ("2024-01-02", "k", None, "2024-01", "2024-01-01", "2024-01-01 12:00:00", "maybe")
    got = published.macro_daily(rows(spark, names, full, ("2024-01-03", *full[1:5], None, "true")), now()).collect()
    assert [(str(r.as_of_date), r.value, r.is_stale, r.alignment_mode, r.staleness_bdays) for r in got] == [("2024-01-02", None, False, "release_timed", None)]


@pytest.mark.parametrize(
    ("change", "key"),
    [
        ({}, "symbol:H"),
        ({"holding_country": "de"}, "country:DE:symbol:H"),
        ({"holding_country": "de", "source_exchange_mic": "xetr"}, "mic:XETR:symbol:H"),
        ({"onboard_symbol": "h.de", "source_exchange_mic": "xetr"}, "provider:H.DE"),
        ({"holding_isin": "de1", "onboard_symbol": "h.de"}, "isin:DE1"),
        ({"holding_isin": "de1", "source_exchange_mic": "xetr"}, "isin:DE1:mic:XETR"),
        ({"holding_isin": "de1", "source_figi": "bbg"}, "figi:BBG"),
        ({"canonical_listing_key": "Own", "source_figi": "bbg"}, "Own"),
        ({"canonical_listing_key": "nan", "source_figi": "bbg"}, "figi:BBG"),
    ],
)
def test_listing_keys_of_holdings(spark, change, key):
    base = {"etf_ticker": "e", "holding_symbol": "h", "as_of": "2024-01-01"} | change
    assert [r.holding_listing_key for r in published.fund_holdings(rows(spark, " ".join(base), tuple(base.values())), now()).collect()] == [key]


def test_canonical_json_sorts_at_every_depth(spark):
    texts = ['{"b": 1.50, "a": {"z": [1, {"y": 2.0, "x": null}], "c": "1.0, \\" 2.0}"}}', '{"a":{"c":"1.0, \\" 2.0}","z":[1.00,{"x":null,"y":2}]},"b":1.5}', "{", None, "", "[3.0]", '"é"']
    got = rows(spark, "t", *((t,) for t in texts)).select("t", casts.canonical_json(F.col("t")).alias("c"), casts.payload_hash(F.col("t")).alias("h")).collect()
    plain = '{"a":{"c":"1.0, \\" 2.0}","z":[1,{"x":null,"y":2}]},"b":1.5}'
    assert [r.c for r in got] == [plain, plain, None, None, None, "[3]", '"é"']
    assert got[0].h == got[1].h == hashlib.sha256(plain.encode()).hexdigest() and got[2].h is None
    long = json.dumps({"t": "x\\\" 7.0," * 50_000, "n": 7.0})
    assert rows(spark, "t", (long,)).select(casts.canonical_json(F.col("t"))).first()[0] == json.dumps({"n": 7, "t": "x\\\" 7.0," * 50_000}, separators=(",", ":"))


LISTED = "symbol provider_symbol exchange exchange_mic country currency"


@pytest.mark.parametrize(
    ("listing", "payloads"),
    [
        (("x", "005930.KS", None, None, None, None), [{"idValue": "005930", "micCode": "XKRX"}, {"idValue": "005930", "micCode": "XKOS"}]),
        (("035720.KQ", None, None, None, None, "krw"), [{"currency": "KRW", "idValue": "035720", "micCode": "XKOS"}, {"currency": "KRW", "idValue": "035720", "micCode": "XKRX"}]),
        (("005930.KS", None, None, "XNAS", None, None), [{"idValue": "005930", "micCode": "XNAS"}]),
        (("000001.SZ", None, None, None, None, None), [{"idValue": "000001", "micCode": "XSHE"}, {"idValue": "1", "micCode": "XSHE"}]),
        (("600519.SS", None, None, None, None, None), [{"idValue": "600519", "micCode": "XSHG"}]),
        (("0700.hk", None, None, "XXXX", None, None), [{"exchCode": "HK", "idValue": "700"}]),
        (("NOVO-B.CO", None, None, None, None, None), [{"exchCode": "DC", "idValue": "NOVOB"}]),
        (("BRK.B", None, "nyse", None, None, None), [{"exchCode": "US", "idValue": "BRK.B"}]),
        (("A", None, None, None, "us", "nan"), [{"exchCode": "US", "idValue": "A"}]),
        (("A", None, None, "XNY", None, None), [{"idValue": "A"}]),
        ((" ", None, None, None, None, None), []),
        ((None, None, "NYSE", None, None, None), []),
    ],
)
def test_requests_of_a_listing(spark, listing, payloads):
    got = mapping.request_variants(rows(spark, LISTED, listing)).orderBy("attempt").collect()
    want = [json.dumps({"idType": "TICKER"} | p, sort_keys=True, separators=(",", ":")) for p in payloads]
    assert [r.payload for r in got] == want and [r.attempt for r in got] == list(range(len(want)))
    assert [r.request_hash for r in got] == [hashlib.sha256(p.encode()).hexdigest() for p in want]


@pytest.mark.parametrize(
    ("first", "second", "settled"),
    [
        ('{"data":[{"figi":"f1"}]}', '{"data":[{"figi":"f2"}]}', (0, "success", None, "F1")),
        ('{"error":"No identifier found."}', '{"data":[{"figi":"f2"}]}', (1, "success", None, "F2")),
        ('{"data":[]}', '{"data":[{"figi":"f2"},{"figi":"f3"}]}', (1, "ambiguous", "multiple_openfigi_matches", "F2")),
        (None, '{"error":"Too many requests"}', (1, "error", "Too many requests", None)),
        ('{"error":"Too many requests"}', '{"data":[{"figi":"f2"}]}', (0, "error", "Too many requests", None)),
        ('{"data":[]}', None, (0, "not_found", "no_openfigi_data", None)),
        (None, None, (0, "not_found", "no_answer", None)),
        ("[]", None, (0, "error", "unexpected_openfigi_item_shape", None)),
    ],
)
def test_first_answer_that_settles(spark, first, second, settled):
    asked = mapping.request_variants(rows(spark, LISTED, ("1.KS", None, None, None, None, None))).cache()
    hashes = {r.attempt: r.request_hash for r in asked.collect()}
    known = [(hashes[i], p, t) for i, p in enumerate((first, second)) if p for t in ("1", "0")]
    answers = rows(spark, "request_hash raw_payload fetched_at", *known, ("other", "{}", "1"), *((h, "<html>", "0") for h, _, _ in known))
    (got,) = mapping.settled_mappings(asked.unionAll(asked), answers).collect()
    assert (got.attempt, got.status, got.error_message, got.figi) == settled and [t.attempt for t in got.tried] == [0, 1]


def test_columns_beside_a_mapping_stay(spark):
    got = events.security_mappings(rows(spark, "symbol raw_payload _n", ("s", '{"data":[{"name":"Own Name","securityType":"adr","homeCountry":"","domicileCountry":"ie"}],"error":""}', "kept"))).first()
    assert (got.symbol, got.status, got.name, got.security_type, got.home_country, got["_n"]) == ("s", "success", "Own Name", "ADR", "IE", "kept")


@pytest.mark.parametrize(
    ("accession", "document", "cik", "url"),
    [
        ("0001-24-7", "a.htm", "0000320193", "https://www.sec.gov/Archives/edgar/data/320193/0001247/a.htm"),
        ("0001-24-7", "", "320193", None),
        ("0001/24", "a.htm", "320193", None),
        ("-", "a.htm", "320193", None),
    ],
)
def test_address_of_a_filing(spark, accession, document, cik, url):
    filing = {"accessionNumber": accession, "form": "8-K", "filingDate": "2024-01-02", "primaryDocument": document}
    payloads = [json.dumps({"name": " Own ", "filings": {"recent": shape}}) for shape in ([filing], {k: [v] for k, v in filing.items()})]
    given = rows(spark, "symbol cik known_at status raw_payload", *(("s", cik, "2024-01-03", "success", p) for p in payloads))
    (got,) = observations.filing_observations(given).collect()
    assert (got.symbol, got.cik, got.company_name, got.form_type, got.filing_url, got.more_files, got.report_date) == ("S", "0000320193", "Own", "8-K", url, False, None)


def test_payloads_that_give_no_filing(spark):
    whole = json.dumps({"filings": {"recent": {"accessionNumber": ["1", "2", None], "form": ["8-K"], "filingDate": ["2024-01-02", "2024-01-02"]}}})
    base = ("s", "1", "2024-01-03", "success", whole)
    bad = [("s", "1.0", *base[2:]), ("s", "x", *base[2:]), (" ", *base[1:]), (*base[:2], "soon", *base[3:]), (*base[:3], "error", whole), *((*base[:4], p) for p in (None, "", "{", "[]", '{"filings":{"recent":"x"}}', '{"filings":[]}'))]
    assert [r.accession_number for r in observations.filing_observations(rows(spark, "symbol cik known_at status raw_payload", base, base, *bad)).collect()] == ["1"]


def test_ties_keep_the_first_row(spark):
    """Rows that agree in key, time and value: the first in order of seq stays, in whatever order they come."""
    row = ("c1", "m", None, "n/a", "2024-03-31", None, "fy", None, "2024-04-01", "s")
    facts = spark.createDataFrame([(*row, "eur", 2), (*row, "usd", 1)], "ticker string, metric string, value string, value_text string, period_end string, period_type string, period string, report_date string, fetched_at string, source string, currency string, seq long").coalesce(1)
    assert [r.currency for r in payloads.fundamentals_payload(facts).collect()] == ["USD"]
    days = spark.createDataFrame([("2024-01-02", "k", 1.0, "p", "2024-01-02", "2024-01-02 01:00:00", "2024-01-03", m, n) for m, n in (("b", 2), ("a", 1))], "as_of_date string, series_key string, value double, source_observation_period string, source_observation_date string, available_at_utc string, ingested_at string, alignment_mode string, seq long").coalesce(1)
    assert [r.alignment_mode for r in published.macro_daily(days).collect()] == ["a"]


def test_filings_are_parsed_before_they_are_taken_apart(spark):
    raw = spark.createDataFrame([], "symbol string, cik string, known_at string, status string, raw_payload string").repartition(2)
    plan = observations.filing_observations(raw)._jdf.queryExecution().optimizedPlan().toString()
    apart = [line for line in plan.splitlines() if "Generate explode" in line]
    assert apart and not any("from_json" in line or "get_json_object" in line for line in apart)
