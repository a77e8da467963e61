"""Operators on small frames with known results."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from lodestar.functions import casts, dates, symbols
from lodestar.operators import company, etf, health, macro, market, reconcile, timeseries


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first().x


@pytest.mark.parametrize(("raw", "want"), [("700 HK", "0700.HK"), ("6763 TT", "6763.TW"), ("NYAX IM", "NYAX.MI"), ("6758 JP", "6758.T"), ("000001 C2", "000001.SZ"), ("600519 C1", "600519.SS"), ("VOD LN", "VOD.L"), ("600900", "600900.SS"), ("300750", "300750.SZ"), ("brk/b", "BRK-B"), (" aapl  us ", "AAPL"), (None, "")])
def test_listing_symbols(spark, raw, want):
    assert one(spark, symbols.listing_symbol(F.col("s")), s=raw) == want


@pytest.mark.parametrize(("raw", "country", "want"), [("700", "HK", "0700.HK"), ("700", "US", "0700.HK"), ("6758", "JP", "6758.T"), ("1", "HK", "0001.HK"), ("2330", "TW", "2330.TW"), ("ABC", "JP", "ABC")])
def test_listing_symbols_by_country(spark, raw, country, want):
    assert one(spark, symbols.listing_symbol_in(F.col("s"), F.col("c")), s=raw, c=country) == want


def test_identifiers(spark):
    assert [one(spark, symbols.isin_is_valid(F.col("s")), s=x) for x in ("US0378331005", "US0378331006", "DE0007164600", "GB0002634946", "x", None)] == [True, False, True, True, False, False]
    assert [one(spark, symbols.country_of(F.col("s")), s=x) for x in ("VOD LN", "0700.HK", "AAPL")] == ["GB", "HK", None]
    assert [one(spark, symbols.is_placeholder(F.col("s")), s=x) for x in ("1234A", "123A", None)] == [True, False, False]
    assert one(spark, symbols.registry_key(F.col("s"), F.col("r"), F.col("e")), s=" abc", r=None, e="xnys") == "ABC|global|XNYS"


def test_lenient_casts(spark):
    c = F.col("s")
    assert [one(spark, casts.number(c), s=x) for x in ("1.5", "x", "")] == [1.5, None, None]
    assert [one(spark, casts.tri_state(c), s=x) for x in ("Yes", " 0", "maybe", None)] == [True, False, None, None]
    assert [one(spark, casts.no_null_tokens(c), s=x) for x in ("NaN", " a ", "")] == [None, " a ", None]
    assert [one(spark, casts.split_factor(c), s=x) for x in ("4:1", "3/2", "2:0", "x")] == [4.0, 1.5, None, None]
    assert one(spark, casts.weight(c), s="1,049.5%") == 1049.5
    assert [one(spark, casts.scale_factor(c.cast("double"), F.lit(0.1)), s=x) for x in ("100", "0.1", "1e8")] == [1000.0, None, 1e9]


def test_business_days(spark):
    numpy = pytest.importorskip("numpy")
    rng = numpy.random.default_rng(0)
    pairs = sorted(tuple(sorted((int(a), int(b)))) for a, b in rng.integers(0, 20000, (300, 2)))
    df = spark.createDataFrame(pairs, "a int, b int").select(F.expr("date_from_unix_date(a)").alias("a"), F.expr("date_from_unix_date(b)").alias("b"))
    for r in df.withColumn("n", dates.business_days(F.col("a"), F.col("b"))).collect():
        assert r.n == numpy.busday_count(r.a, r.b)
    day = lambda f, s: one(spark, f(F.col("s").cast("date")), s=s)
    assert day(dates.saturday_on_or_before, "2026-01-02") == date(2025, 12, 27) and day(dates.saturday_on_or_before, "2026-01-03") == date(2026, 1, 3)
    assert day(dates.thursday_after, "2026-01-01") == date(2026, 1, 8) and day(dates.thursday_after, "2026-01-03") == date(2026, 1, 8)
    at = lambda s: one(spark, dates.release_day(F.col("s").cast("timestamp"), F.lit("America/New_York")), s=s)
    assert [at("2026-01-07 21:00:00"), at("2026-01-07 21:00:01"), at("2026-01-09 22:00:00")] == [date(2026, 1, 7), date(2026, 1, 8), date(2026, 1, 12)]


def test_market_stats_on_a_line(spark):
    days = spark.sql("SELECT explode(sequence(date'2025-01-01', date'2026-01-27')) AS date").where("weekday(date) < 5").orderBy("date").limit(280)
    rows = [(" spy", r.date, 100 + 40 * i / 279) for i, r in enumerate(days.collect())]
    got = market.market_stats(spark.createDataFrame([*rows, (None, rows[0][1], 1.0), ("X", rows[0][1], None)], "symbol string, date date, close double")).collect()
    assert len(got) == 1 and None not in got[0] and got[0].symbol == "SPY" and got[0].drawdown_1y <= 0 and got[0].dist_high_52w <= 0 <= got[0].dist_low_52w


def test_fundamentals_summary(spark):
    at = [date(2024, 12, 31), date(2025, 12, 31)]
    facts = [("revenue", 500.0, at[0]), ("revenue", 550.0, at[1]), ("net_income", 100.0, at[0]), ("net_income", 110.0, at[1]), ("eps", 10.0, at[1]), ("market_cap", 2200.0, at[1])]
    got = company.fundamentals_summary(spark.createDataFrame([("SPY", m, v, d, "s", i) for i, (m, v, d) in enumerate(facts)], "ticker string, metric string, value double, period_end date, source string, seq long")).first()
    assert (got.latest_revenue, got.latest_eps, got.market_cap, got.trailing_pe, got.latest_period_end) == (550, 10, 2200, 20, at[1])
    assert got.revenue_growth_yoy == pytest.approx(0.1) and got.earnings_growth_yoy == pytest.approx(0.1)


def test_next_earnings(spark):
    rows = [("SPY", date(2026, 5, 1), None), ("SPY", date(2026, 8, 1), "x"), ("QQQ", date(2026, 4, 20), "y"), ("QQQ", date(2026, 1, 1), "old")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "ticker string, earnings_date date, state string, seq long")
    got = {r.ticker: (r.earnings_date, r.state) for r in company.next_earnings(df, "2026-04-11", ("state",)).collect()}
    assert got == {"SPY": (date(2026, 5, 1), "x"), "QQQ": (date(2026, 4, 20), "y")}


def macro_obs(spark, rows):
    return spark.createDataFrame(rows, "series_key string, observation_period string, observation_date date, value double, scheduled_at timestamp, observed_at timestamp, zone string")


def test_daily_macro_goes_stale(spark):
    from datetime import datetime

    obs = macro_obs(spark, [("WTI", "2026-01-02", date(2026, 1, 2), 70.0, None, None, None), ("CPI", "2026-04", date(2026, 4, 30), 300.0, datetime(2026, 5, 13, 12, 30), None, "America/New_York"), ("ICSA", "2026-01-02", date(2026, 1, 2), 1.0, None, None, None)])
    catalog = spark.createDataFrame([("WTI", "daily", 2), ("CPI", "monthly", 10), ("ICSA", "weekly", None)], "series_key string, frequency string, staleness_limit int")
    got = {(r.series_key, r.as_of_date): r for r in macro.daily_alignment(obs, catalog, "2025-12-30", "2026-05-29").collect()}
    assert (got["WTI", date(2026, 1, 7)].value, got["WTI", date(2026, 1, 7)].staleness_bdays, got["WTI", date(2026, 1, 7)].is_stale) == (70, 3, True)
    assert got["CPI", date(2026, 5, 29)].value == 300 and got["CPI", date(2026, 5, 29)].staleness_bdays > 10 and ("CPI", date(2026, 5, 12)) not in got
    assert min(d for k, d in got if k == "ICSA") == date(2026, 1, 2)


def test_freshness_states(spark):
    df = spark.createDataFrame([(2, False, False), (40, False, False), (96, True, False), (None, False, True), (None, False, False), (200, False, False)], "hours int, delayed boolean, failed boolean")
    now = F.lit("2026-01-10 00:00:00").cast("timestamp")
    state = health.freshness(now - F.make_dt_interval(hours=F.col("hours")), now, failure=F.col("failed"), delayed=F.col("delayed"))
    assert [r.x for r in df.select(state.alias("x")).collect()] == ["fresh", "stale_within_tolerance", "delayed_expected", "failed_retrying", "unknown", "failed_hard"]


def test_gap_plans(spark):
    plan = lambda days, end, back: health.gap_plan(spark.createDataFrame([("SPY", date(2026, 4, d)) for d in days], "symbol string, date date"), spark.createDataFrame([("SPY",)], "symbol string"), end, back).first()
    got = plan([14, 15, 17], "2026-04-17", 3)
    assert (got["mode"], got.earliest_missing_date, got.start_date) == ("gap-repair", date(2026, 4, 16), date(2026, 4, 16))
    got = plan([14, 15], "2026-04-16", 1)
    assert (got["mode"], got.start_date) == ("catch-up", date(2026, 4, 16))


def test_theme_eligibility(spark):
    hold = spark.createDataFrame([(e, f"H{i}") for e in "ABC" for i in range(20)], "etf_ticker string, holding_symbol string")
    themes = spark.createDataFrame([(e, "t", True) for e in "ABCD"], "etf_ticker string, theme string, active boolean")
    for n, want in ((4, "insufficient_constituent_coverage"), (5, None)):
        have = spark.createDataFrame([(f"H{i}",) for i in range(n)], "symbol string")
        got = {r.etf_ticker: r for r in etf.theme_readiness(hold, themes, have, have).collect()}
        assert got["A"].ineligible_reason == want and got["A"].coverage_ratio == n / 20 and got["D"].ineligible_reason == "no_holdings"


def test_weights_in_per_cent(spark):
    df = spark.createDataFrame([("KRE", "A", "49.50"), ("KRE", "B", "49.57"), ("KRE", "C", "0.93"), ("X", "MCHP", "0.93%"), ("X", "ON", "0.62%"), ("Y", "A", "0.5")], "etf_ticker string, holding_symbol string, weight string")
    assert {(r.etf_ticker, r.holding_symbol): r.weight for r in etf.normalised_weights(df).collect()} == {("KRE", "A"): 0.495, ("KRE", "B"): 0.4957, ("KRE", "C"): 0.0093, ("X", "MCHP"): 0.0093, ("X", "ON"): 0.0062, ("Y", "A"): 0.5}


def test_action_conflicts(spark):
    d = [date(2026, 1, i) for i in (1, 2, 3)]
    rows = [("a", "AAPL", "dividend", d[0], 0.30), ("b", "AAPL", "dividend", d[0], 0.25), ("a", "AAPL", "split", d[1], 4.0), ("b", "AAPL", "split", d[2], 4.0), ("a", "MSFT", "split", d[1], 2.0)]
    got = reconcile.action_conflicts(spark.createDataFrame(rows, "provider string, symbol string, action string, ex_date date, amount double"), "a", "b")
    assert sorted(r.kind for r in got.collect()) == ["amount_mismatch", "first_only_date", "second_only_date"]


def test_as_of_ties_and_sides(spark):
    left = spark.createDataFrame([("k", date(2026, 1, d), d) for d in (1, 3, 5)] + [("z", date(2026, 1, 1), 9)], "k string, at date, n int")
    points = spark.createDataFrame([("k", date(2026, 1, 3), 30, 1), ("k", date(2026, 1, 3), 31, 2), ("k", date(2025, 1, 1), None, 0)], "k string, p date, v int, o int")
    back = {(r.k, r.n): (r.v, r.p) for r in timeseries.as_of(left, points, ["k"], "at", "p", ["v"], ["o"]).collect()}
    assert back == {("k", 1): (None, date(2025, 1, 1)), ("k", 3): (31, date(2026, 1, 3)), ("k", 5): (31, date(2026, 1, 3)), ("z", 9): (None, None)}
    ahead = {(r.k, r.n): r.v for r in timeseries.as_of(left, points, ["k"], "at", "p", ["v"], ["o"], forward=True).collect()}
    assert ahead == {("k", 1): 30, ("k", 3): 30, ("k", 5): None, ("z", 9): None}


def test_tables_and_versions(spark, tmp_path):
    from lodestar.sources import tables

    path = f"file://{tmp_path}/t"
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert tables.read_table(spark, f"{path}/none", df.schema).count() == 0
    tables.write_version(df, path, "1")
    tables.write_version(tables.keyed_append(tables.read_current(spark, path), spark.createDataFrame([(2, "b"), (2, "c"), (3, "d")], df.schema), ["k"], ["v"]), path, "2")
    want = {1: "a", 2: "c", 3: "d"}
    again = tables.keyed_append(tables.read_current(spark, path), tables.read_current(spark, path), ["k"])
    assert {r.k: r.v for r in tables.read_current(spark, path).collect()} == want == {r.k: r.v for r in again.collect()}
    (tmp_path / "h.csv").write_text("Ticker ,% of Net Assets\nA,1.5%\n")
    assert tuple(tables.read_aliased(spark, f"file://{tmp_path}/h.csv", {"symbol": ["symbol", "ticker"], "weight": ["Weight", "% of net assets"], "isin": ["isin"]}).first()) == ("A", "1.5%", None)


def test_streamed_batches_merge_by_key(spark, tmp_path):
    from lodestar.sources import commits
    from lodestar.streaming import incremental

    source, path = f"file://{tmp_path}/in", f"file://{tmp_path}/t"
    schema = "symbol string, ts timestamp, price double"
    for i in range(2):
        spark.sql(f"SELECT 'A' AS symbol, timestamp'2026-01-01 00:00:00' AS ts, {i}.0D AS price UNION ALL SELECT 'B{i}', timestamp'2026-01-01 00:00:0{i}', 5.0D").coalesce(1).write.mode("append").parquet(source)
        stream = incremental.deduplicated(spark.readStream.schema(schema).parquet(source), ["symbol", "ts"], "ts", "1 hour")
        incremental.append_stream(stream, path, f"file://{tmp_path}/c", ["symbol", "ts"], transform=lambda df: df.withColumn("price", F.col("price") * 2)).awaitTermination()
    got = sorted((r.symbol, r.price) for r in commits.read_bucketed(spark, path).collect())
    assert got == [("A", 0.0), ("B0", 10.0), ("B1", 10.0)]


def test_isin_status_and_snippets(spark):
    from lodestar.operators import identity, observations

    df = spark.createDataFrame([("US0378331005", "US"), ("US0378331006", "US"), ("DE0007164600", "US"), (" ", "US")], "isin string, country string")
    assert [(r.isin_status, r.isin_reason) for r in identity.isin_status(df).collect()] == [("success", "ok"), ("suspect", "invalid_isin"), ("suspect", "prefix_mismatch"), ("not_found", "no_isin")]
    text = "x" * 300 + " The company Raises\nGuidance for the year" + "y" * 300
    got = observations.signal_candidates(spark.createDataFrame([(text.replace("\n", " "),), ("none",), (None,)], "text string")).collect()
    assert len(got) == 1 and got[0].signal == "raises guidance" and "Raises Guidance" in got[0].snippet and len(got[0].snippet) <= 280
