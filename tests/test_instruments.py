"""Instrument types and promotion by policy, against literal rows."""

from pyspark.sql import functions as F

from lodestar.functions import classify
from lodestar.operators import audits

SCHEMA = "candidate string, entered string, hint string, exchange string, said map<string,string>"
ROWS = [
    (("AAPL", "AAPL", None, "NASDAQ", {"quoteType": "EQUITY", "isAdr": "false"}), ("equity", "provider_metadata")),
    (("AAPL", "AAPL", None, None, {"quoteType": "EQUITY", "isAdr": "True"}), ("adr", "provider_metadata")),
    (("AAPL", "AAPL", None, None, {"quoteType": "Common Stock", "longName": "Some Bank ADR"}), ("adr", "provider_metadata")),
    (("X", "TSM", "etf", None, None), ("adr", "explicit_override")),  # the entered symbol
    (("SPY", "TSM", "etf", None, None), ("etf", "explicit_override")),  # the candidate goes first
    (("X", "X", " ETF ", None, {"quoteType": "EQUITY"}), ("etf", "input_hint")),
    (("VTI", "VTI", "fund", None, {"quote_type": "mutual fund"}), ("etf", "provider_metadata")),
    (("EWJ", "EWJ", None, None, {"category": "Japan ETF"}), ("country_fund", "provider_metadata")),
    (("ABC", "ABC", None, None, {"quoteType": "INDEX"}), ("index_proxy", "provider_metadata")),
    (("^GSPC", "^GSPC", None, None, {}), ("index_proxy", "symbol_heuristic")),
    (("VOD.L", "VOD.L", None, "", None), ("equity", "symbol_heuristic")),
    ((None, None, None, None, None), ("unknown", "fallback_unknown")),
]


def test_instrument_types(spark):
    df = spark.createDataFrame([(i, *r[0]) for i, r in enumerate(ROWS)], f"i int, {SCHEMA}")
    c = F.col
    got = classify.instrument_types(df, c("candidate"), c("hint"), c("exchange"), c("said"), {"TSM": "adr", "SPY": "etf"}, c("entered"))
    assert [(r.type, r.source) for r in got.orderBy("i").collect()] == [r[1] for r in ROWS]
    assert got.columns == [*df.columns, "type", "source"]


def test_the_plan_of_instrument_types_stays_small(spark):
    df = spark.createDataFrame([r[0] for r in ROWS], SCHEMA)
    c = F.col
    plan = classify.instrument_types(df, c("candidate"), c("hint"), c("exchange"), c("said"), {"TSM": "adr"}, c("entered"))._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 20_000, len(plan)


def test_promotion_of_the_six_types_and_of_others(spark):
    kinds = ["equity", "adr", "etf", "country_fund", "index_proxy", "unknown", "bond", None]
    rows = [(f"{t}-{m}{f}{e}", t, m, f, e) for t in kinds for m, f, e in ((True, True, True), (True, False, True), (True, None, False), (False, True, True))]
    got = {r.ticker: (r.promotion_status, r.reasons) for r in audits.promotion_status(spark.createDataFrame(rows, "ticker string, instrument_type string, market boolean, fundamentals boolean, earnings boolean")).collect()}
    for ticker, kind, market, fundamentals, earnings in rows:
        if not market:
            want = ("rejected", "missing_market")
        elif fundamentals and earnings:
            want = ("validated_full", "all_domains_supported")
        elif kind in ("equity", "adr"):
            want = ("validated_market_only", ",".join([*["missing_fundamentals"] * (not fundamentals), *["missing_earnings"] * (not earnings)]))
        else:
            want = ("validated_market_only", "market_supported_index_proxy" if kind == "index_proxy" else "market_supported")
        assert got[ticker] == want, ticker
