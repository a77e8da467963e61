"""Names, entity attachment, events and the registry on small frames with known values."""

import pytest
from pyspark.sql import functions as F

from lodestar.functions import names
from lodestar.operators import chain, events, registry
from lodestar.plans import chain_queries


@pytest.mark.parametrize(
    ("raw", "want"),
    [("The Coca-Cola Co", "COCA COLA"), ("ASML Holding N.V. NY Reg Shs", "ASML HOLDING"), ("Novo Nordisk A/S Class B", "NOVO NORDISK"), ("Toyota株式会社", "TOYOTA"), ("AT&T Inc. Common Stock", "AT AND T"), ("The", ""), ("Co", ""), ("nan", ""), (None, "")],
)
def test_legal_names(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "raw string")
    assert df.select(names.legal_name(F.col("raw"))).first()[0] == want


def test_search_names_and_flags(spark):
    df = spark.createDataFrame([("Gap Inc The",), ("三菱",), (None,)], "raw string")
    found = [r[0] for r in df.select(names.search_names(F.col("raw"))).collect()]
    assert found == [["Gap Inc The", "Gap Inc", "The Gap Inc", "Gap", "Gap Incorporated The", "Gap Incorporated", "The Gap Incorporated"], ["三菱"], []]
    flags = names.name_flags(F.lit("ABC三菱株式会社"), F.lit("ABC"))
    assert spark.range(1).select(*flags.values()).first() == (True, True, True, True)


def test_provider_symbols(spark):
    rows = [("anz", "apac", "ASX"), ("700", "apac", None), ("SAP.DE", "eu", ""), ("SPY", "us", None), (None, None, None)]
    df = spark.createDataFrame(rows, "raw string, region string, exchange string")
    found = [r[0] for r in df.select(names.provider_symbols(F.col("raw"), F.col("region"), F.col("exchange"))).collect()]
    assert found[0][:2] == ["ANZ.AX", "ANZ"] and found[1:] == [["0700.HK"], ["SAP.DE"], ["SPY"], []]


def test_groups_are_one_hop(spark):
    rows = spark.createDataFrame([("A", "L1", "N1"), ("B", "L1", "N2"), ("C", None, "N2"), ("D", None, None), ("E", None, None)], "symbol string, lei string, name_key string")
    pairs = spark.createDataFrame([("A", "D"), ("A", "B"), ("E", "Z")], "left string, right string")
    got = {r.symbol: (r.group_size, r.listing_group_kind[:6]) for r in chain.group_profile(rows, pairs).collect()}
    assert got == {"A": (3, "multi_"), "B": (3, "multi_"), "C": (2, "multi_"), "D": (2, "multi_"), "E": (1, "single")}


def test_known_pairs(spark):
    rows = [("SAP", "X", "X", "I", "direct_isin"), ("SAP.DE", "X", "X", "J", "lei_expansion"), ("GOOG", "G", "G", "I", "direct_isin"), ("GOOGL", "H", "H", "I", "direct_isin"), ("LEN", None, None, None, "unattached"), ("LENB", None, None, None, "unattached")]
    got = {r.left: r for r in chain.pair_report(spark.createDataFrame(list(chain.PAIRS), "left string, right string, pair_type string"), spark.createDataFrame(rows, "symbol string, entity_lei string, direct_lei string, isin string, method string")).collect()}
    assert (got["SAP"].grouped, got["SAP"].grouping_path) == (True, "direct_anchor_plus_lei_expansion")
    assert [got[s].not_grouped_reason for s in ("GOOG", "LEN", "RIO")] == ["different_lei", "no_valid_anchor_isin", "symbol_missing_from_measurement"]


def test_capital_events_of_one_filing(spark):
    rows = [("S", "1", "8-K", "Underwritten offering and share repurchase program"), ("S", "2", "424B3", "Prospectus supplement"), ("S", "3", "4", "share repurchase program"), ("S", "4", "8-K", None)]
    got = {(r.accession, r.event_type) for r in events.capital_events(spark.createDataFrame(rows, "symbol string, accession string, form string, text string")).collect()}
    assert got == {("1", "buyback_authorization"), ("1", "secondary_offering"), ("2", "shelf_registration")}


def test_broken_payloads_give_no_rows(spark):
    raw = spark.createDataFrame([("S", "success", "{"), ("S", "success", None), ("S", "success", "[]")], "symbol string, status string, raw_payload string")
    assert not any(f(raw).count() for f in (events.earnings_events, events.distributions, events.rebalances, events.filer_numbers, events.entity_records))
    assert {r.status for r in events.security_mappings(raw).collect()} == {"not_found"}


def test_refresh_status_without_rows(spark):
    none = spark.createDataFrame([], "key string, succeeded boolean, exhausted boolean")
    assert registry.refresh_status(none, none).first().status == "fresh"
    failed = spark.createDataFrame([("a", False, True)], none.schema)
    assert registry.refresh_status(failed, failed).first().status == "failed_retrying" and registry.refresh_status(failed, none).first().status == "partial"


def test_completeness_sentences(spark):
    rows = spark.createDataFrame([("A", "2026-01-01", "2026-01-09", 7, 7, 0, 100.0), ("B", "2026-01-01", "2026-01-09", 7, 6, 1, 85.71), ("C", None, None, 0, 0, 0, 0.0)], "symbol string, first_date string, last_date string, expected int, actual int, missing int, completeness double")
    got = {r.symbol: r.summary for r in registry.completeness_text(rows).collect()}
    assert got["A"].endswith("acceptable (no missing business days in range).") and "85.71% complete from 2026-01-01 to 2026-01-09, with 1 missing" in got["B"] and "not available" in got["C"]


def test_bare_numbers_are_their_countrys(spark):
    held = spark.createDataFrame([("E", "700", "HK", None), ("E", "701", "HK", None), ("E", "700", "US", None), ("E", "700.HK", "HK", None)], "etf_ticker string, source_symbol string, source_country string, source_exchange string")
    none = spark.createDataFrame([], "symbol string")
    got = {(r.source_symbol, r.source_country): (r.provider_symbol, r.resolution_source) for r in registry.onboarding_identities(held, none, none).collect()}
    by_number, given = "source_country_numeric_mapping", "provider_symbol_already_qualified"
    assert got == {("700", "HK"): ("0700.HK", by_number), ("701", "HK"): ("0701.HK", by_number), ("700", "US"): ("0700.HK", given), ("700.HK", "HK"): ("0700.HK", given)}


def test_search_names_are_dealt_to_all_cores(spark):
    """A small file of names is one task's; the work on them is not."""
    plan = chain_queries._named(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
