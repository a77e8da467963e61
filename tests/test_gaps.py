"""Golden values of countries, classes and coverage, and the streamed append at each crash point."""

import pytest
from pyspark.sql import functions as F

from lodestar.functions import classify, geography
from lodestar.operators import chain, health


def column(spark, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v"))).collect()]


def test_countries_and_regions(spark):
    raw = ["United States", "Korea, Republic of", "UK", "europe", None, "Atlantis", "de", "Cayman Islands (The)"]
    assert column(spark, raw, geography.country_code) == ["US", "KR", "GB", "", "", "ATLANTIS", "DE", "KY"]
    assert column(spark, raw, geography.region_of) == ["US", "APAC", "EU", "OTHER", "OTHER", "OTHER", "EU", "AMER"]
    assert column(spark, ["0700.HK", "AAPL", "700 HK"], lambda s: geography.listing_country(F.lit("US"), s)) == ["HK", "US", "HK"]
    assert column(spark, ["SAP.DE", "x.ns", "AAPL"], geography.market_of) == ["XETR", "XBOM", "XNYS"]


def test_notes(spark):
    raw = ["{\"b\": 1, \"a\": [2]}", "wave=1; k = v=w", "text", None, "nan", "{broken"]
    assert column(spark, raw, classify.notes_text) == ["{\"a\":[2],\"b\":1}", "wave=1; k = v=w", "text", "", "", "{broken"]
    assert column(spark, raw, classify.note_fields) == [{"a": "[2]", "b": "1"}, {"wave": "1", "k": "v=w"}, {"raw": "text"}, {}, {}, {"raw": "{broken"}]


def test_complete_coverage_is_rebuilt_from_the_rows(spark):
    frame = lambda rows, schema: spark.createDataFrame(rows, schema).withColumn("d", F.col("d").cast("date"))
    prices = frame([("AEM", "2026-07-09"), ("LOW", "2026-07-09")], "symbol string, d string").withColumnRenamed("d", "date")
    quotes = spark.createDataFrame([("QUOTEONLY",), ("1234A",), ("700.HK",)], "symbol string")
    facts = frame([("AEM", "2026-03-31"), ("DHI", "2026-03-31")], "ticker string, d string").withColumnRenamed("d", "period_end")
    earnings = frame([("AEM", "2026-08-01"), ("DHI", "2026-05-01")], "ticker string, d string").withColumnRenamed("d", "earnings_date")
    got = {r.ticker: r for r in health.complete_coverage(prices, quotes, facts, earnings, "2026-07-10").collect()}
    assert set(got) == {"AEM", "LOW", "DHI", "QUOTEONLY"} and str(got["AEM"].next_earnings_date) == "2026-08-01"
    assert [got[s].market_data_available for s in ("AEM", "LOW", "DHI", "QUOTEONLY")] == [True, True, False, False]
    assert (got["AEM"].coverage_status, got["QUOTEONLY"].reason) == ("fresh", "missing_market_data_fundamentals_earnings")


def test_blank_names_attach_to_nothing(spark):
    listings = spark.createDataFrame([("A", "", "US"), ("B", "acme", "US")], "symbol string, name_key string, country string")
    records = spark.createDataFrame([("L1", "", ["US1"]), ("L2", "acme", ["US2", "US3"]), ("L3", "acme", ["DE1"])], "lei string, name_key string, isins array<string>")
    assert {r.symbol: (r.n_matches, r.entity_lei) for r in chain.expansion_matches(listings, records).collect()} == {"A": (0, None), "B": (1, "L2")}


