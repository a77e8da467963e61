"""Registry reconciliation, calendar rules and data windows on small frames."""

import pytest
from pyspark.sql import functions as F

from lodestar.operators import macro, market, universe

REGISTRY = "registry_key string, input_symbol string, normalized_symbol string, region string, exchange string, status string, promotion_status string, market_supported boolean, instrument_type string, seq int"
ATTRIBUTES = "symbol string, country string, home_country string, region string, exchange string, exchange_mic string, currency string, seq int"


def symbols(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "symbol string")


def plan(spark, registry, tracked=(), prices=(), attributes=(), reviewed=(), **more):
    readiness = symbols(spark, *tracked).withColumn("is_tracked", F.lit(True))
    sources = {"readiness": readiness, "prices": symbols(spark, *prices)} | {n: symbols(spark, *s) for n, s in more.items()}
    rows, old = universe.reconciliation(sources, spark.createDataFrame(registry, REGISTRY), spark.createDataFrame(list(attributes), ATTRIBUTES), symbols(spark, *reviewed))
    return {r.symbol: r for r in rows.collect()}, {r.registry_key: r.superseded_by for r in old.collect()}


def test_one_fitting_row_is_in_order_and_prices_alone_are_residue(spark):
    rows = [("AAA|us|NMS", "aaa", "AAA", "us", "NMS", "active", "validated_full", True, "equity", 1)]
    found, old = plan(spark, rows, tracked=["aaa", "BBB", "CCC"], prices=["AAA", "PPP", None, " "], reviewed=["bbb"])
    assert set(found) == {"BBB", "CCC", "PPP"} and old == {}
    assert (found["PPP"].outcome, found["PPP"].sources) == ("residue", "prices")
    assert found["BBB"].outcome == "reviewed"
    assert (found["CCC"].reason, found["CCC"].registry_key, found["CCC"].instrument_type) == ("no_registry_row", "CCC|us|default", "unknown")


def test_spellings_of_a_share_class_are_one_symbol_and_old_rows_are_superseded(spark):
    rows = [
        ("BRK.B|us|NYQ", "BRK.B", "BRK.B", "us", "NYQ", "active", "validated_full", True, "Equity", 1),
        ("BRK-B|us|NASDAQ", "BRK-B", "BRK-B", "us", "NASDAQ", "active", "validated_market_only", True, None, 2),
        ("BRK-B|eu|default", "BRK-B", "BRK-B", "eu", None, "rejected", "rejected", False, None, 3),
    ]
    found, old = plan(spark, rows, tracked=["BRK-B"], fundamentals=["BRK-B"], earnings=["BRK-B"])
    row = found["BRK-B"]
    assert (row.outcome, row.reason, row.registry_key, row.validation_status) == ("upsert", "duplicate/conflicting canonical rows", "BRK-B|us|NYQ", "validated_full")
    assert (row.n_related, row.n_selected, row.instrument_type) == (3, 2, "equity")
    assert old == {"BRK.B|us|NYQ": "BRK-B|us|NYQ", "BRK-B|us|NASDAQ": "BRK-B|us|NYQ"}


@pytest.mark.parametrize(
    ("status", "promotion", "market", "normalized", "reason"),
    [
        ("rejected", "rejected", False, "X", "rejected_or_superseded_without_active_canonical"),
        ("active", "candidate", True, "nan", "missing_normalized_symbol"),
        ("active", "candidate", None, "X", "market_supported_false"),
        ("pending_validation", None, True, "X", "pending_validation"),
        ("active", "candidate", True, "X", "not_promoted"),
    ],
)
def test_first_reason_of_a_missing_row(spark, status, promotion, market, normalized, reason):
    found, _ = plan(spark, [("X|us|default", "x", normalized, "us", None, status, promotion, market, None, 1)], tracked=["X"])
    assert found["X"].reason == reason


def test_region_and_exchange_of_the_canonical_row(spark):
    attributes = [
        ("D", "Germany", None, None, None, None, None, 1), ("I", "Israel", None, "OTHER", "tase", None, None, 1), ("Z", "South Africa", None, None, "lse", "xlon", "gbp", 1),
        ("B", "Brazil", None, "AMER", None, None, None, 1), ("D", "Japan", None, None, None, None, None, 0),
    ]
    found, _ = plan(spark, [], tracked=["D", "I", "Z", "B", "700.HK"], attributes=attributes)
    assert {s: (r.region, r.exchange) for s, r in found.items()} == {"D": ("eu", None), "I": ("apac", "TASE"), "Z": ("eu", "LSE"), "B": ("us", None), "700.HK": ("apac", None)}
    assert (found["Z"].exchange_mic, found["Z"].currency) == ("XLON", "GBP")


GOOD = {
    "series_key": "UNRATE", "observation_period": "2024-01", "observation_date": "2024-01-01", "release_date_local": "2024-02-02", "scheduled_at": "2024-02-02 13:30:00", "released_at": "2024-02-02 13:30:00",
    "observed_at": "2024-02-02 13:31:00", "ingested_at": "2024-02-03 00:00:00", "availability_status": "observed_available", "availability_source": "agency", "is_schedule_based_only": "false",
    "delay_vs_schedule_seconds": "60", "zone": "America/New_York",
}
UNSEEN = {"observed_at": None, "availability_status": "scheduled_provisional", "is_schedule_based_only": "True", "delay_vs_schedule_seconds": None}


@pytest.mark.parametrize(
    ("change", "broken"),
    [
        ({}, set()),
        (UNSEEN, set()),
        ({"delay_vs_schedule_seconds": "60.4"}, set()),
        ({"zone": " "}, {"empty_zone"}),
        ({"scheduled_at": "soon"}, {"invalid_scheduled_at"}),
        ({"released_at": "2024-02-02 13:30:01"}, {"released_is_not_scheduled"}),
        ({"released_at": None}, {"invalid_released_at"}),
        ({"observed_at": "later"}, {"invalid_observed_at", "neither_observed_nor_schedule_only", "delay_on_schedule_only"}),
        ({"observed_at": "2099-01-01 00:00:00"}, {"observed_in_future", "delay_value"}),
        ({"availability_status": "provisional"}, {"unknown_status", "observed_status"}),
        ({"is_schedule_based_only": "perhaps"}, {"invalid_is_schedule_based_only"}),
        ({"is_schedule_based_only": "1"}, {"observed_but_schedule_only"}),
        ({"delay_vs_schedule_seconds": "61"}, {"delay_value"}),
        ({"delay_vs_schedule_seconds": None}, {"delay_value"}),
        (UNSEEN | {"delay_vs_schedule_seconds": "0"}, {"delay_on_schedule_only"}),
        ({"series_key": None, "observation_period": ""}, {"empty_series_key", "empty_observation_period"}),
        ({"observation_date": "2024-02-30", "release_date_local": None, "ingested_at": ""}, {"invalid_observation_date", "invalid_release_date_local", "invalid_ingested_at"}),
    ],
)
def test_each_calendar_rule(spark, change, broken):
    schema = ", ".join(f"{c} string" for c in GOOD)
    rows = spark.createDataFrame([tuple((GOOD | change).values())], schema)
    assert {r.rule for r in macro.calendar_violations(rows).collect()} == broken


def test_calendar_as_a_whole(spark):
    rows = spark.createDataFrame([tuple(GOOD.values())] * 3, ", ".join(f"{c} string" for c in GOOD))
    assert [tuple(r) for r in macro.calendar_violations(rows).collect()] == [("duplicate_key", 3)]
    assert [r.rule for r in macro.calendar_violations(rows.limit(0)).collect()] == ["empty_calendar"]
    assert macro.calendar_violations(rows.limit(0), allow_empty=True).collect() == []
    assert [r.rule for r in macro.calendar_violations(rows.limit(1).drop("zone")).collect()] == ["missing_zone"]


def test_quarterly_and_periodic_windows(spark):
    rows = spark.createDataFrame(
        [("A", "2023-02-01", "2023-02-02", None), ("A", "2023-02-01", None, "2023-05-01"), ("A", "2023-11-15", None, None), ("A", "bad", "2024-01-01", None), ("B", None, "2024-03-01", None)],
        "k string, d string, updated_at string, fetched_at string",
    )
    a, b = market.period_windows(rows, "k", "d", ("updated_at", "fetched_at"), quarterly=True).orderBy("k").collect()
    assert (a.expected, a.actual, a.missing, a.completeness, a.largest_gap, str(a.latest_update)) == (4, 2, 2, 50.0, "2023-02-01 -> 2023-11-15 (missing_quarters=2)", "2024-01-01 00:00:00")
    assert (b.first_date, b.expected, b.actual, b.missing, b.largest_gap, str(b.latest_update)) == (None, None, 0, None, None, "2024-03-01 00:00:00")
    a, _ = market.period_windows(rows, "k", "d").orderBy("k").collect()
    assert (a.expected, a.actual, a.missing, a.largest_gap, a.latest_update) == (None, 2, None, "2023-02-01 -> 2023-11-15 (missing_calendar_days=286)", None)
