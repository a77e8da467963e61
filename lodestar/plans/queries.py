"""Registered queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..operators import company, etf, health, macro, market, reconcile, timeseries
from ..sources import adapters as a

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
AS_OF, NOW = "2001-06-01", "2001-11-05 12:00:00"


def query(sql: str | None, *ctes: str):
    """Register a function by its name, with its SQL after the named common tables. Doubles are rounded to six places on both sides."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(spark, sf_dir)
            return df.select(*(F.round(c, 6).alias(c) if isinstance(df.schema[c].dataType, DoubleType) else F.col(c) for c in df.columns))

        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = f"WITH {', '.join(ctes)} {sql}" if ctes else sql
        return f

    return add


# --- market

RANKED = f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS rk, close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY date), 0) - 1 AS ret FROM prices)"""


def _at(n: int) -> str:
    return f"max(close) FILTER (rk = {n})"


@query(
    f"""SELECT symbol, max(date) AS as_of_date, {_at(1)} AS last_price, round({_at(1)} / nullif({_at(2)}, 0) - 1, 6) AS return_1d, round({_at(1)} / nullif({_at(22)}, 0) - 1, 6) AS return_1m,
 round({_at(1)} / nullif({_at(64)}, 0) - 1, 6) AS return_3m, round({_at(1)} / nullif({_at(253)}, 0) - 1, 6) AS return_1y,
 round(CASE WHEN count(ret) FILTER (rk <= 30) >= 2 THEN stddev_samp(ret) FILTER (rk <= 30) * sqrt(252) END, 6) AS vol_30d,
 round(min(close / top - 1) FILTER (rk <= 252), 6) AS drawdown_1y, round({_at(1)} / max(close) FILTER (rk <= 252) - 1, 6) AS dist_high_52w, round({_at(1)} / min(close) FILTER (rk <= 252) - 1, 6) AS dist_low_52w
FROM (SELECT *, max(CASE WHEN rk <= 252 THEN close END) OVER (PARTITION BY symbol ORDER BY date) AS top FROM ranked) GROUP BY symbol""",
    a.PRICES, RANKED,
)
def mk1_market_stats(spark, sf):
    return market.market_stats(a.prices(spark, sf))


@query(
    f"""SELECT symbol, {", ".join(f"round(CASE WHEN count(*) >= {n} THEN {_at(1)} / nullif(avg(close) FILTER (rk <= {n}), 0) - 1 END, 6) AS dist_ma_{n}" for n in (20, 50, 200))},
 round({_at(1)} / max(close) FILTER (rk <= 252) - 1, 6) AS fall_from_high, round(CASE WHEN count(ret) FILTER (rk <= 20) >= 2 THEN stddev_samp(ret) FILTER (rk <= 20) * sqrt(252) END, 6) AS vol_20d,
 round(CASE WHEN count(volume) >= 20 THEN max(volume) FILTER (rk = 1) / nullif(avg(volume) FILTER (rk <= 20), 0) END, 6) AS volume_ratio FROM ranked GROUP BY symbol""",
    a.PRICES, RANKED,
)
def wn6_trend_features(spark, sf):
    return market.trend_features(a.prices(spark, sf))


@query(
    f"""SELECT symbol, {_at(1)} AS price, {_at(2)} AS previous_close, round({_at(1)} - {_at(2)}, 6) AS change, round(({_at(1)} / nullif({_at(2)}, 0) - 1) * 100, 6) AS change_pct,
 CASE WHEN {_at(2)} IS NULL THEN 'previous_close' ELSE '' END AS missing FROM ranked GROUP BY symbol""",
    a.PRICES, RANKED,
)
def mk4_quote_changes(spark, sf):
    return market.quote_changes(a.prices(spark, sf))


@query("SELECT symbol, date, close, volume FROM prices QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1", a.PRICES)
def mk3_latest_prices(spark, sf):
    return market.latest_and_history(a.prices(spark, sf))


@query(
    """SELECT * FROM (SELECT u.symbol, coalesce(n_rows, 0) AS n_rows, latest_date, CASE WHEN latest_date IS NULL THEN 'no_history' WHEN n_rows < 400 THEN 'too_few_rows' WHEN latest_date < DATE '2001-10-01' THEN 'stale' END AS reason
FROM (SELECT DISTINCT ticker AS symbol FROM registry) u LEFT JOIN (SELECT symbol, count(*) AS n_rows, max(date) AS latest_date FROM prices GROUP BY symbol) p USING (symbol)) WHERE reason IS NOT NULL""",
    a.PRICES, a.REGISTRY,
)
def mk5_history_repairs(spark, sf):
    return market.history_repairs(a.registry(spark, sf).withColumnRenamed("ticker", "symbol"), a.prices(spark, sf), 400, "2001-10-01")


@query(
    f"""SELECT symbol, first_date, last_date, expected, actual, missing, round(completeness, 6) AS completeness, largest_gap, CASE WHEN largest_gap > 0 THEN w.b END AS gap_after, CASE WHEN largest_gap > 0 THEN w.d END AS gap_before,
 CASE WHEN missing = 0 THEN 'complete' WHEN completeness >= 99 AND missing <= 3 THEN 'nearly complete' WHEN completeness >= 95 THEN 'usable' ELSE 'incomplete' END AS assessment
FROM (SELECT *, greatest(0, expected - actual) AS missing, round(actual * 100.0::DOUBLE / nullif(expected, 0), 2) AS completeness FROM (
 SELECT symbol, min(date) AS first_date, max(date) AS last_date, {a.weekdays("(max(date) + 1)")} - {a.weekdays("min(date)")} AS expected, count(*) AS actual, max(gap) AS largest_gap, arg_max({{'b': before, 'd': date}}, (gap, -date_diff('day', DATE '1970-01-01', date))) AS w
 FROM (SELECT *, coalesce(greatest(0, {a.weekdays("date")} - {a.weekdays("(before + 1)")}), 0) AS gap FROM (SELECT symbol, date, lag(date) OVER (PARTITION BY symbol ORDER BY date) AS before FROM prices)) GROUP BY symbol))""",
    a.PRICES,
)
def mk15_data_windows(spark, sf):
    return market.data_windows(a.prices(spark, sf))


# --- companies


@query(
    """, last AS (SELECT *, max(period_end) OVER (PARTITION BY ticker, metric) AS last_end, row_number() OVER (PARTITION BY ticker, metric ORDER BY period_end DESC, seq DESC) AS rn FROM facts),
each AS (SELECT ticker, metric, max(value) FILTER (rn = 1) AS latest, coalesce(arg_max(value, (period_end, seq)) FILTER (period_end <= last_end - 330), max(value) FILTER (rn = 2)) AS prior, max((period_end, seq)) AS at_, arg_max(source, (period_end, seq)) AS source FROM last GROUP BY ALL),
g AS (SELECT *, (latest - prior) / nullif(abs(prior), 0) AS growth FROM each),
w AS (SELECT ticker, max(latest) FILTER (metric = 'revenue') AS revenue, max(latest) FILTER (metric = 'eps') AS eps, max(latest) FILTER (metric = 'market_cap') AS market_cap, max(latest) FILTER (metric = 'net_income') AS net_income, max(latest) FILTER (metric = 'shares_outstanding') AS shares,
 max(growth) FILTER (metric = 'revenue') AS rg, coalesce(max(growth) FILTER (metric = 'net_income'), max(growth) FILTER (metric = 'eps')) AS eg, arg_max(source, at_) AS source FROM g GROUP BY ticker)
SELECT ticker, revenue AS latest_revenue, eps AS latest_eps, round(CASE WHEN net_income > 0 THEN market_cap / net_income WHEN shares > 0 AND eps > 0 THEN market_cap / shares / eps END, 6) AS trailing_pe, market_cap,
 round(rg, 6) AS revenue_growth_yoy, round(eg, 6) AS earnings_growth_yoy, (SELECT max(period_end) FROM facts f WHERE f.ticker = w.ticker) AS latest_period_end, source FROM w""".lstrip(),
    a.FUNDAMENTALS,
)
def mk9_fundamentals_summary(spark, sf):
    return company.fundamentals_summary(a.fundamentals(spark, sf))


@query(
    f"""SELECT ticker, min(earnings_date) AS earnings_date, arg_min(actual_eps, (earnings_date, seq)) FILTER (actual_eps IS NOT NULL) AS actual_eps, arg_min(estimate_eps, (earnings_date, seq)) FILTER (estimate_eps IS NOT NULL) AS estimate_eps, arg_min(state, (earnings_date, seq)) FILTER (state IS NOT NULL) AS state
FROM earnings WHERE earnings_date >= DATE '{AS_OF}' GROUP BY ticker""",
    a.EARNINGS,
)
def mk11_next_earnings(spark, sf):
    return company.next_earnings(a.earnings(spark, sf), AS_OF, ("actual_eps", "estimate_eps", "state"))


@query(
    """, merged AS (SELECT ticker, earnings_date, NULL::DOUBLE AS actual_eps, estimate_eps, NULL::DOUBLE AS surprise_eps, 0 AS o, seq FROM earnings UNION ALL SELECT ticker, earnings_date, actual_eps, NULL, actual_eps * 0.01, 1, seq FROM earnings WHERE actual_eps IS NOT NULL),
l AS (SELECT ticker, earnings_date, arg_max(actual_eps, (o, seq)) FILTER (actual_eps IS NOT NULL) AS actual_eps, arg_max(estimate_eps, (o, seq)) FILTER (estimate_eps IS NOT NULL) AS estimate_eps, arg_max(surprise_eps, (o, seq)) FILTER (surprise_eps IS NOT NULL) AS s FROM merged GROUP BY ALL)
SELECT ticker, earnings_date, actual_eps, estimate_eps, round(coalesce(actual_eps - estimate_eps, s), 6) AS surprise_eps FROM l""",
    a.EARNINGS,
)
def mk12_merged_earnings(spark, sf):
    rows = a.earnings(spark, sf)
    none = F.lit(None).cast("double")
    events = rows.select("ticker", "earnings_date", none.alias("actual_eps"), "estimate_eps", none.alias("surprise_eps"), "seq")
    return company.merged_earnings(events, rows.where("actual_eps IS NOT NULL").select("ticker", "earnings_date", "actual_eps", (F.col("actual_eps") * 0.01).alias("surprise_eps"), "seq"))


@query(
    """SELECT ticker, earnings_date, actual_eps, estimate_eps, state, seq, CASE WHEN actual_eps IS NULL THEN 'upcoming' ELSE 'history' END AS kind FROM earnings
QUALIFY actual_eps IS NOT NULL OR row_number() OVER (PARTITION BY ticker, actual_eps IS NULL ORDER BY earnings_date, seq) = 1""",
    a.EARNINGS,
)
def mk13_upcoming_and_history(spark, sf):
    return company.upcoming_and_history(a.earnings(spark, sf))


@query(
    """, s AS (SELECT *, (actual_eps - estimate_eps) / nullif(abs(estimate_eps), 0) AS pct FROM earnings), r AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY earnings_date DESC, seq DESC) AS rn FROM s WHERE pct IS NOT NULL),
k AS (SELECT *, count(*) OVER (PARTITION BY ticker) AS n FROM r WHERE rn <= 4)
SELECT ticker, count(*) FILTER (pct > 0) AS beats, count(*) FILTER (pct < 0) AS misses, round(avg(pct), 6) AS mean_surprise, round(max(pct) FILTER (rn = 1), 6) AS last_surprise,
 round(CASE WHEN count(*) >= 2 THEN sum(CASE WHEN n - rn >= n // 2 THEN pct ELSE -pct END) END, 6) AS trend FROM k GROUP BY ticker""",
    a.EARNINGS,
)
def wn12_surprise_stats(spark, sf):
    return company.surprise_stats(a.earnings(spark, sf))


@query(
    f"""SELECT ticker, CASE WHEN sum(value) FILTER (period_end > DATE '{AS_OF}' - 365 AND period_end <= DATE '{AS_OF}') > 0 THEN round(sum(value) FILTER (period_end > DATE '{AS_OF}' - 365 AND period_end <= DATE '{AS_OF}'), 6) END AS dividend_rate FROM facts WHERE metric = 'eps' GROUP BY ticker""",
    a.FUNDAMENTALS,
)
def ag15_trailing_dividends(spark, sf):
    return company.trailing_dividends(a.fundamentals(spark, sf).where("metric = 'eps'").select("ticker", F.col("period_end").alias("ex_date"), F.col("value").alias("amount")), AS_OF)


# --- macro

OBS = "o AS (SELECT *, strftime(observation_date, '%Y-%m-%d') AS observation_period FROM obs)"


def _observations(spark, sf):
    raw = a.macro_series(spark, sf)
    return macro.observations(raw).join(raw.select("series_key", "observation_date", "scheduled_at", "observed_at", "zone", "released_at"), ["series_key", "observation_date"])


@query("SELECT series_key, 'daily' AS frequency, observation_date, value, seq, observation_period FROM o", a.MACRO, OBS)
def ma1_observations(spark, sf):
    return macro.observations(a.macro_series(spark, sf))


@query(
    """SELECT series_key, strftime(d, '%Y-%m-%d') AS observation_period, d AS observation_date, value, seq FROM (
SELECT series_key, observation_date - ((isodow(observation_date) + 1) % 7)::INT AS d, value, seq FROM obs QUALIFY row_number() OVER (PARTITION BY series_key, d ORDER BY seq DESC) = 1)""",
    a.MACRO,
)
def sc13_weekly_observations(spark, sf):
    return macro.observations(a.macro_series(spark, sf).withColumn("frequency", F.lit("weekly"))).drop("frequency")


def _daily_sql(release_timed: bool) -> str:
    local = "(coalesce(observed_at, scheduled_at) AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York')"
    day = f"({local}::DATE + CASE WHEN {local}::TIME > TIME '16:00:00' AND isodow({local}::DATE) < 6 THEN 1 ELSE 0 END)" if release_timed else "observation_date"
    return f""", e0 AS (SELECT *, {day} AS d0 FROM o), e AS (SELECT *, (d0 + CASE WHEN isodow(d0) > 5 THEN (8 - isodow(d0))::INT ELSE 0 END)::DATE AS effective FROM e0),
p AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY series_key, effective ORDER BY observation_date DESC, value DESC) = 1),
days AS (SELECT c.*, d::DATE AS as_of_date FROM catalog c, generate_series(DATE '2024-01-03', DATE '2024-02-09', INTERVAL 1 DAY) t(d) WHERE isodow(d::DATE) < 6),
f AS (SELECT days.*, p.value, p.observation_date, p.observation_period FROM days ASOF JOIN p ON days.series_key = p.series_key AND days.as_of_date >= p.effective),
daily AS (SELECT as_of_date, series_key, value, observation_period AS source_observation_period, observation_date AS source_observation_date, {a.weekdays("as_of_date")} - {a.weekdays("observation_date")} AS staleness_bdays, {a.weekdays("as_of_date")} - {a.weekdays("observation_date")} > coalesce(staleness_limit, 5) AS is_stale FROM f)"""


@query(_daily_sql(True) + " SELECT * FROM daily", a.MACRO, OBS, a.CATALOG)
def ma3_release_timed_daily(spark, sf):
    return macro.daily_alignment(_observations(spark, sf), a.catalog(spark, sf), "2024-01-03", "2024-02-09")


@query(_daily_sql(False) + " SELECT * FROM daily", a.MACRO, OBS, a.CATALOG)
def ma3_observation_daily(spark, sf):
    return macro.daily_alignment(_observations(spark, sf), a.catalog(spark, sf), "2024-01-03", "2024-02-09", release_timed=False)


@query("SELECT series_key, observation_date, value FROM obs QUALIFY row_number() OVER (PARTITION BY series_key ORDER BY observation_date DESC, released_at DESC NULLS LAST, seq DESC) = 1", a.MACRO)
def ma5_latest_observations(spark, sf):
    return macro.latest_observations(a.macro_series(spark, sf)).select("series_key", "observation_date", "value")


@query(
    _daily_sql(False) + """, half AS (SELECT * FROM daily WHERE NOT (day(as_of_date) % 4 = 0 AND length(series_key) % 2 = 0))
SELECT d.as_of_date, c.series_key FROM (SELECT DISTINCT as_of_date FROM half) d, catalog c JOIN (SELECT series_key, min(as_of_date) AS first FROM half GROUP BY ALL) f USING (series_key)
WHERE d.as_of_date >= active_from AND d.as_of_date >= first AND NOT EXISTS (SELECT 1 FROM half h WHERE h.as_of_date = d.as_of_date AND h.series_key = c.series_key AND value IS NOT NULL)""",
    a.MACRO, OBS, a.CATALOG,
)
def ma7_missing_required(spark, sf):
    daily = macro.daily_alignment(_observations(spark, sf), a.catalog(spark, sf), "2024-01-03", "2024-02-09", release_timed=False)
    return macro.missing_in_window(daily.where("NOT (day(as_of_date) % 4 = 0 AND length(series_key) % 2 = 0)"), a.catalog(spark, sf))


@query(
    _daily_sql(False) + """, twice AS (SELECT * FROM daily UNION ALL SELECT * FROM daily WHERE day(as_of_date) = 10)
SELECT 'duplicate_key' AS rule, series_key, count(*) AS n FROM (SELECT series_key, as_of_date FROM twice GROUP BY ALL HAVING count(*) > 1) GROUP BY ALL
UNION ALL SELECT 'null_value', series_key, count(*) FROM twice WHERE value IS NULL GROUP BY ALL UNION ALL SELECT 'forward_dated', series_key, count(*) FROM twice WHERE source_observation_date > as_of_date GROUP BY ALL""",
    a.MACRO, OBS, a.CATALOG,
)
def ma6_contract_violations(spark, sf):
    daily = macro.daily_alignment(_observations(spark, sf), a.catalog(spark, sf), "2024-01-03", "2024-02-09", release_timed=False)
    return macro.contract_violations(daily.unionAll(daily.where("day(as_of_date) = 10")), a.catalog(spark, sf))


# --- release calendars

RELEASES = "releases AS (SELECT 'C' || o_custkey AS series_key, o_orderdate::DATE AS release_date FROM orders)"


def _releases(spark, sf):
    return a.table(spark, sf, "orders").select(F.concat(F.lit("C"), "o_custkey").alias("series_key"), F.col("o_orderdate").cast("date").alias("release_date"), F.col("o_orderstatus").alias("state"))


@query(
    """, f AS (SELECT series_key, date_trunc('month', release_date)::DATE AS m, min(release_date) AS release_date FROM releases GROUP BY ALL),
b AS (SELECT *, coalesce(lag(m) OVER (PARTITION BY series_key ORDER BY m), (m - INTERVAL 1 MONTH)::DATE) AS from_month FROM f),
x AS (SELECT series_key, release_date, unnest(generate_series(from_month::TIMESTAMP, m::TIMESTAMP - INTERVAL 1 MONTH, INTERVAL 1 MONTH))::DATE AS om FROM b),
seen AS (SELECT DISTINCT 'C' || o_custkey AS series_key, date_trunc('month', o_orderdate)::DATE AS om FROM orders WHERE o_orderstatus = 'F')
SELECT x.series_key, strftime(x.om, '%Y-%m') AS observation_period, release_date, seen.om IS NOT NULL AS observed FROM x LEFT JOIN seen ON x.series_key = seen.series_key AND x.om = seen.om""",
    RELEASES,
)
def rc1_monthly_schedule(spark, sf):
    rows = _releases(spark, sf)
    return macro.monthly_schedule(rows, rows.where("state = 'F'").select("series_key", F.col("release_date").alias("observation_date")))


@query("SELECT 'C' || o_custkey AS series_key, date_trunc('month', o_orderdate)::DATE AS observation_date, min(o_orderdate::DATE) AS first_vintage FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL")
def rc2_first_appearance(spark, sf):
    rows = a.table(spark, sf, "orders").select(F.concat(F.lit("C"), "o_custkey").alias("series_key"), F.trunc("o_orderdate", "month").alias("observation_date"), F.col("o_orderdate").cast("date").alias("vintage_date"), F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("value"))
    return macro.first_appearance(rows)


@query(
    """, weeks AS (SELECT DISTINCT series_key, observation_date - ((isodow(observation_date) + 1) % 7)::INT AS d FROM obs), vendor AS (SELECT DISTINCT series_key, observation_date + 5 AS vw, observation_date + 6 AS vd FROM obs WHERE day(observation_date) % 9 = 1)
SELECT w.series_key, w.d AS observation_date, CASE WHEN v.vw - w.d <= 14 THEN v.vd ELSE w.d + ((10 - isodow(w.d)) % 7 + 1)::INT END AS release_date, CASE WHEN v.vw - w.d <= 14 THEN 'vendor' ELSE 'inferred' END AS release_source
FROM weeks w ASOF LEFT JOIN vendor v ON w.series_key = v.series_key AND w.d <= v.vw""",
    a.MACRO,
)
def rc3_weekly_schedule(spark, sf):
    raw = a.macro_series(spark, sf)
    weeks = macro.observations(raw.withColumn("frequency", F.lit("weekly"))).select("series_key", "observation_date")
    vendor = raw.where("day(observation_date) % 9 = 1").select("series_key", F.date_add("observation_date", 5).alias("vendor_week"), F.date_add("observation_date", 6).alias("vendor_date"))
    return macro.weekly_schedule(weeks, vendor)


CALENDAR_SQL = """cal AS (SELECT series_key, observation_period, scheduled_at, observed_at, CASE WHEN observed_at IS NOT NULL THEN 'observed_available' WHEN scheduled_at < TIMESTAMP '2024-01-05' THEN 'schedule_only_unsupported_history' WHEN TIMESTAMP '2024-01-28 12:00:00' > scheduled_at + INTERVAL 4 HOUR THEN 'late_missing_observation' ELSE 'scheduled_provisional' END AS availability_status,
 CASE WHEN observed_at IS NOT NULL THEN epoch(observed_at)::BIGINT - epoch(scheduled_at)::BIGINT END AS delay_vs_schedule_seconds, observed_at IS NULL AS is_schedule_based_only FROM o)"""


def _calendar(spark, sf):
    rows = _observations(spark, sf).select("series_key", "observation_period", "scheduled_at", "observed_at")
    return macro.availability(rows, F.lit("2024-01-28 12:00:00").cast("timestamp"), "2024-01-05")


@query("SELECT * FROM cal", a.MACRO, OBS, CALENDAR_SQL)
def rc4_availability(spark, sf):
    return _calendar(spark, sf)


@query("SELECT series_key, observation_period, availability_status FROM cal QUALIFY row_number() OVER (PARTITION BY series_key ORDER BY coalesce(observed_at, scheduled_at) DESC, observation_period DESC) = 1", a.MACRO, OBS, CALENDAR_SQL)
def rc6_latest_releases(spark, sf):
    return macro.latest_releases(_calendar(spark, sf)).select("series_key", "observation_period", "availability_status")


@query("SELECT availability_status, series_key, count(*) AS n FROM cal GROUP BY ALL", a.MACRO, OBS, CALENDAR_SQL)
def rc8_status_counts(spark, sf):
    return _calendar(spark, sf).groupBy("availability_status", "series_key").agg(F.count("*").alias("n"))


@query("SELECT coalesce(max(t) FILTER (t <= TIMESTAMP '2024-01-20'), max(t)) AS latest_effective_at FROM (SELECT coalesce(observed_at, scheduled_at) AS t FROM cal)", a.MACRO, OBS, CALENDAR_SQL)
def rc9_latest_effective(spark, sf):
    return macro.latest_effective(_calendar(spark, sf), F.lit("2024-01-20 00:00:00").cast("timestamp"))


# --- freshness, plans, coverage, readiness


def _freshness_sql(last: str, now: str, fresh: float, grace: float) -> str:
    age = f"((epoch(TIMESTAMP '{now}') - epoch({last})) / 3600.0)"
    return f"CASE WHEN {last} IS NULL THEN 'unknown' WHEN {age} <= {fresh} THEN 'fresh' WHEN {age} <= {fresh + grace} THEN 'stale_within_tolerance' ELSE 'failed_hard' END"


@query(f"SELECT symbol, last_date, {_freshness_sql('last_date::TIMESTAMP', NOW, 48, 48)} AS freshness_state FROM (SELECT symbol, max(date) AS last_date FROM prices GROUP BY symbol)", a.PRICES)
def fr1_symbol_freshness(spark, sf):
    rows = a.prices(spark, sf).groupBy("symbol").agg(F.max("date").alias("last_date"))
    return rows.withColumn("freshness_state", health.freshness(F.col("last_date").cast("timestamp"), F.lit(NOW).cast("timestamp"), 48, 48))


@query(
    ", ".join(["SELECT 'prices' AS asset, count(*) AS n_rows, max(date) AS last_available_date, " + _freshness_sql("max(date)::TIMESTAMP", NOW, 48, 48) + " AS freshness_state FROM prices UNION ALL SELECT 'orders', count(*), max(o_orderdate)::DATE, " + _freshness_sql("max(o_orderdate)", NOW, 26, 24) + " FROM orders UNION ALL SELECT 'events', count(*), max(ts)::DATE, " + _freshness_sql("max(ts)", NOW, 26, 24) + " FROM events"]),
    a.PRICES,
)
def fr3_asset_status(spark, sf):
    return health.asset_status({"prices": (a.prices(spark, sf), "date", 48, 48), "orders": (a.table(spark, sf, "orders"), "o_orderdate", 26, 24), "events": (a.table(spark, sf, "events"), "ts", 26, 24)}, NOW)


@query(
    f"""SELECT nation, coalesce(min(s) FILTER (r = 1), min(s) FILTER (r = 4), min(s) FILTER (r = 7)) AS overall FROM (SELECT r.nation, f.s, CASE f.s WHEN 'failed_hard' THEN 1 WHEN 'stale_within_tolerance' THEN 4 ELSE 7 END AS r
FROM registry r JOIN (SELECT symbol, {_freshness_sql('max(date)::TIMESTAMP', NOW, 48, 48)} AS s FROM prices GROUP BY symbol) f ON r.ticker = f.symbol) GROUP BY nation""",
    a.PRICES, a.REGISTRY,
)
def ag16_worst_status(spark, sf):
    rows = fr1_symbol_freshness(spark, sf).join(a.registry(spark, sf), F.col("symbol") == F.col("ticker"))
    return rows.groupBy("nation").agg(health.worst(F.col("freshness_state")).alias("overall"))


@query(
    """, days AS (SELECT d::DATE AS d FROM generate_series(DATE '2001-10-01' - 120, DATE '2001-10-01', INTERVAL 1 DAY) t(d) WHERE isodow(d::DATE) < 6), u AS (SELECT DISTINCT ticker AS symbol FROM registry WHERE ticker LIKE 'S%'),
have AS (SELECT DISTINCT symbol, date FROM prices WHERE date BETWEEN DATE '2001-10-01' - 120 AND DATE '2001-10-01' AND symbol IN (SELECT symbol FROM u)), m AS (SELECT u.symbol, days.d FROM u, days ANTI JOIN have ON u.symbol = have.symbol AND days.d = have.date),
l AS (SELECT u.symbol, max(date) AS latest FROM u LEFT JOIN have USING (symbol) GROUP BY u.symbol), c AS (SELECT CASE WHEN count(*) = count(latest) THEN min(latest) END AS complete FROM l), s AS (SELECT min(d) AS first, count(DISTINCT d) AS n, count(DISTINCT symbol) AS k, count(*) AS kn FROM m)
SELECT CASE WHEN first IS NULL THEN 'normal' WHEN first <= complete THEN 'gap-repair' ELSE 'catch-up' END AS mode, greatest(DATE '2001-10-01' - 120, coalesce(first, DATE '2001-10-01') - 2) AS start_date, DATE '2001-10-01' AS end_date, complete AS latest_complete_date, first AS earliest_missing_date, n AS missing_dates, k AS stale_symbols, kn AS missing_symbol_dates FROM c, s""",
    a.PRICES, a.REGISTRY,
)
def fr5_gap_plan(spark, sf):
    universe = a.registry(spark, sf).where("ticker LIKE 'S%'").select(F.col("ticker").alias("symbol"))
    return health.gap_plan(a.prices(spark, sf), universe, "2001-10-01", 120, 2)


def _watermark_sql(name: str, date: str, source: str) -> str:
    return f"""SELECT '{name}' AS table_name, latest AS latest_date, gap AS gap_exists, CASE WHEN gap THEN 'catch-up' ELSE 'normal' END AS mode, greatest(DATE '2001-10-20' - 400, CASE WHEN gap THEN coalesce(latest + 1, DATE '2001-10-20' - 400) ELSE DATE '2001-10-20' END - 3) AS start_date,
 CASE WHEN gap THEN greatest(1, DATE '2001-10-20' - coalesce(latest + 1, DATE '2001-10-20' - 400) + 1) ELSE 0 END::BIGINT AS missing_dates FROM (SELECT latest, coalesce(latest < DATE '2001-10-20' - 2, true) AS gap FROM (SELECT max({date}::DATE) AS latest FROM {source} WHERE {date}::DATE BETWEEN DATE '2001-10-20' - 400 AND DATE '2001-10-20'))"""


@query(" UNION ALL ".join(_watermark_sql(*x) for x in (("prices", "l_shipdate", "lineitem"), ("orders", "o_orderdate", "orders"), ("events", "ts", "events"))))
def fr6_watermark_plan(spark, sf):
    return health.watermark_plan({"prices": (a.table(spark, sf, "lineitem"), "l_shipdate"), "orders": (a.table(spark, sf, "orders"), "o_orderdate"), "events": (a.table(spark, sf, "events"), "ts")}, "2001-10-20", 400, 2, 3)


COVERAGE = f"""cov AS (SELECT s.symbol AS ticker, p.d IS NOT NULL AS market_data_available, f.d IS NOT NULL AS fundamentals_available, e.ticker IS NOT NULL AS earnings_available, p.d AS market_data_last_date, f.d AS fundamentals_last_date, e.d AS next_earnings_date
FROM (SELECT DISTINCT 'S' || s_suppkey AS symbol FROM supplier UNION SELECT DISTINCT 'C' || c_custkey FROM customer) s LEFT JOIN (SELECT symbol, max(date) AS d FROM prices GROUP BY ALL) p ON p.symbol = s.symbol LEFT JOIN (SELECT ticker, max(period_end) AS d FROM facts GROUP BY ALL) f ON f.ticker = s.symbol
LEFT JOIN (SELECT ticker, min(earnings_date) FILTER (earnings_date >= DATE '{AS_OF}') AS d FROM earnings WHERE seq % 2 = 0 GROUP BY ALL) e ON e.ticker = s.symbol)"""


def _coverage(spark, sf):
    required = a.table(spark, sf, "supplier").select(F.concat(F.lit("S"), "s_suppkey").alias("symbol")).unionAll(a.table(spark, sf, "customer").select(F.concat(F.lit("C"), "c_custkey")))
    return health.symbol_coverage(required, a.prices(spark, sf), a.fundamentals(spark, sf), a.earnings(spark, sf).where("seq % 2 = 0"), AS_OF)


@query(
    """SELECT *, CASE WHEN n = 3 THEN 'fresh' WHEN n = 0 THEN 'failed_hard' ELSE 'partial' END AS coverage_status, CASE WHEN n = 3 THEN 'all_domains_available' ELSE 'missing_' || concat_ws('_', CASE WHEN NOT market_data_available THEN 'market_data' END, CASE WHEN NOT fundamentals_available THEN 'fundamentals' END, CASE WHEN NOT earnings_available THEN 'earnings' END) END AS reason
FROM (SELECT *, market_data_available::INT + fundamentals_available::INT + earnings_available::INT AS n FROM cov)""".replace("SELECT *, CASE", "SELECT * EXCLUDE (n), CASE", 1),
    a.PRICES, a.FUNDAMENTALS, a.EARNINGS, COVERAGE,
)
def cv1_symbol_coverage(spark, sf):
    return _coverage(spark, sf)


@query(
    """SELECT ticker, o.ticker IS NOT NULL OR market_data_available AS market_data_available, CASE WHEN o.ticker IS NOT NULL THEN o.d ELSE market_data_last_date END AS market_data_last_date, fundamentals_available FROM cov FULL JOIN (SELECT 'C' || o_custkey AS ticker, max(o_orderdate)::DATE AS d FROM orders WHERE o_custkey % 2 = 0 GROUP BY ALL) o USING (ticker)""",
    a.PRICES, a.FUNDAMENTALS, a.EARNINGS, COVERAGE,
)
def cv2_merged_coverage(spark, sf):
    own = a.table(spark, sf, "orders").where("o_custkey % 2 = 0").groupBy(F.concat(F.lit("C"), "o_custkey").alias("ticker")).agg(F.max("o_orderdate").cast("date").alias("market_data_last_date")).withColumn("market_data_available", F.lit(True))
    return health.merge_coverage(own, _coverage(spark, sf).select("ticker", "market_data_available", "market_data_last_date", "fundamentals_available"), ["market_data_available", "market_data_last_date"])


@query(
    """SELECT *, CASE WHEN coverage_ratio = 1 THEN 'fresh' WHEN coverage_ratio > 0 THEN 'partial' ELSE 'failed_hard' END AS status FROM (SELECT count(*) AS required, count(p.symbol) AS covered, count(*) - count(p.symbol) AS missing, round(count(p.symbol) / count(*), 6) AS coverage_ratio
FROM (SELECT DISTINCT ticker AS symbol FROM registry) r LEFT JOIN (SELECT DISTINCT symbol FROM prices) p USING (symbol))""",
    a.PRICES, a.REGISTRY,
)
def cv3_coverage_assessment(spark, sf):
    return health.coverage_assessment(a.registry(spark, sf).withColumnRenamed("ticker", "symbol"), a.prices(spark, sf))


READINESS = """rows_ AS (SELECT coalesce(r.ticker, p.ticker, t.ticker, s.ticker) AS ticker, registry_status, coalesce(rav, false) AS registry_active_validated, coalesce(pn, 0) AS pn, coalesce(tn, 0) AS tn, coalesce(sn, 0) AS sn
FROM (SELECT ticker, min(status) AS registry_status, bool_or(status = 'active' AND promotion_status LIKE 'validated%') AS rav FROM registry GROUP BY ticker) r
FULL JOIN (SELECT symbol AS ticker, count(*) AS pn FROM prices GROUP BY ALL) p ON r.ticker = p.ticker FULL JOIN (SELECT symbol AS ticker, count(*) AS tn FROM prices WHERE length(symbol) % 2 = 0 AND day(date) = 1 GROUP BY ALL) t ON coalesce(r.ticker, p.ticker) = t.ticker
FULL JOIN (SELECT ticker, count(*) AS sn FROM registry WHERE balance > 2000 GROUP BY ALL) s ON coalesce(r.ticker, p.ticker, t.ticker) = s.ticker), st AS (SELECT *, regexp_full_match(ticker, '[0-9]{6,}[A-Z]') AS ph FROM rows_)"""


def _readiness(spark, sf):
    prices, reg = a.prices(spark, sf), a.registry(spark, sf)
    return health.ticker_readiness(reg, prices, prices.where("length(symbol) % 2 = 0 AND day(date) = 1"), reg.where("balance > 2000").withColumnRenamed("ticker", "symbol"))


@query(
    """SELECT ticker, registry_status, registry_active_validated, pn AS source_price_rows, tn AS technical_feature_rows, sn AS scorecard_rows, ph AS is_placeholder_symbol,
CASE WHEN ph THEN 'invalid_placeholder' WHEN pn = 0 THEN 'not_materialized' WHEN tn = 0 THEN 'source_only' WHEN sn = 0 THEN 'tracked_without_scorecard' ELSE 'tracked_with_scorecard' END AS readiness_state, pn > 0 AND tn > 0 AND NOT ph AS tracked FROM st""",
    a.PRICES, a.REGISTRY, READINESS,
)
def rd1_ticker_readiness(spark, sf):
    return _readiness(spark, sf)


@query(
    """SELECT ticker, i AS issue_type FROM (SELECT ticker, unnest([CASE WHEN registry_active_validated AND pn = 0 THEN 'registry_active_validated_without_prices' END, CASE WHEN pn > 0 AND tn = 0 THEN 'prices_without_technicals' END, CASE WHEN tn > 0 AND sn = 0 THEN 'technicals_without_scorecard' END,
 CASE WHEN registry_status = 'rejected' AND pn + tn + sn > 0 THEN 'rejected_with_materialized_data' END, CASE WHEN ph AND NOT (coalesce(registry_status = 'rejected', false) AND pn + tn + sn = 0) THEN 'placeholder_like_symbol' END]) AS i FROM st) WHERE i IS NOT NULL""",
    a.PRICES, a.REGISTRY, READINESS,
)
def rd2_readiness_issues(spark, sf):
    return health.readiness_issues(_readiness(spark, sf))


# --- ETFs


@query(
    """, w AS (SELECT etf_ticker, holding_symbol, round(weight * 100, 4) AS weight, etf_ticker LIKE '%1' AS pct FROM holdings), s AS (SELECT *, pct OR sum(weight) OVER (PARTITION BY etf_ticker) > 1.35 OR max(weight) OVER (PARTITION BY etf_ticker) > 1 AS percent FROM w)
SELECT etf_ticker, holding_symbol, round(CASE WHEN percent THEN weight / 100 ELSE weight END, 6) AS weight FROM s""",
    a.HOLDINGS,
)
def et1_normalised_weights(spark, sf):
    w = F.format_string("%.4f", F.round(F.col("weight") * 100, 4))
    return etf.normalised_weights(a.holdings(spark, sf).withColumn("weight", F.when(F.col("etf_ticker").endswith("1"), F.concat(w, F.lit("%"))).otherwise(w)))


@query("SELECT etf_ticker, round(max(weight), 6) AS max_weight, round(sum(weight), 6) AS total_weight, max(weight) <= 0.5 AND sum(weight) <= 1.35 AS plausible FROM holdings GROUP BY etf_ticker", a.HOLDINGS)
def ag14_weight_plausibility(spark, sf):
    return etf.plausibility(a.holdings(spark, sf))


READY_ETF = """cnt AS (SELECT etf_ticker, count(*) AS hc, count(*) FILTER (substr(holding_symbol, 2)::BIGINT % 2 = 0) AS pc, count(*) FILTER (substr(holding_symbol, 2)::BIGINT % 9 = 0) AS tc FROM (SELECT DISTINCT etf_ticker, holding_symbol FROM holdings WHERE etf_ticker NOT LIKE '%7') GROUP BY ALL),
rd AS (SELECT t.etf_ticker, theme, active, coalesce(hc, 0) AS holdings_count, coalesce(pc, 0) AS priced_constituent_count, coalesce(tc, 0) AS technical_constituent_count, coalesce(tc / nullif(hc, 0), 0) AS coverage_ratio,
 CASE WHEN NOT active THEN 'theme_inactive' WHEN coalesce(hc, 0) = 0 THEN 'no_holdings' WHEN tc < 5 OR tc / hc < 0.1 THEN 'insufficient_constituent_coverage' END AS ineligible_reason FROM themes t LEFT JOIN cnt USING (etf_ticker))"""


def _theme_readiness(spark, sf):
    parts = a.table(spark, sf, "part").select(F.concat(F.lit("P"), "p_partkey").alias("symbol"), "p_partkey")
    return etf.theme_readiness(a.positions(spark, sf).where("etf_ticker NOT LIKE '%7'"), a.themes(spark, sf).drop("wave"), parts.where("p_partkey % 2 = 0"), parts.where("p_partkey % 9 = 0"))


@query("SELECT etf_ticker, theme, active, holdings_count, priced_constituent_count, technical_constituent_count, round(coverage_ratio, 6) AS coverage_ratio, ineligible_reason IS NULL AS relationship_map_eligible, ineligible_reason FROM rd", a.HOLDINGS, a.THEMES, READY_ETF)
def et5_theme_readiness(spark, sf):
    return _theme_readiness(spark, sf)


@query(
    """SELECT etf_ticker, coalesce(n, 0) AS n_edges, CASE WHEN NOT active THEN 'inactive' WHEN ineligible_reason IS NOT NULL THEN 'pendingCoverage' WHEN coalesce(n, 0) = 0 THEN 'noEdges' ELSE 'ok' END AS health, active AND ineligible_reason IS NULL AND coalesce(n, 0) = 0 AS red
FROM rd LEFT JOIN (SELECT etf_ticker, count(*) AS n FROM holdings WHERE weight > 0.003 AND etf_ticker NOT LIKE '%3' GROUP BY ALL) USING (etf_ticker)""",
    a.HOLDINGS, a.THEMES, READY_ETF,
)
def et6_theme_health(spark, sf):
    edges = a.holdings(spark, sf).where("weight > 0.003 AND etf_ticker NOT LIKE '%3'").groupBy("etf_ticker").agg(F.count("*").alias("n_edges"))
    return etf.theme_health(_theme_readiness(spark, sf), edges)


CANDIDATES = "cand AS (SELECT holding_symbol, sum(greatest(0, weight)) AS total_weight, count(DISTINCT etf_ticker) AS n_etfs, array_to_string(list_sort(list(DISTINCT theme)), ',') AS themes FROM holdings JOIN themes USING (etf_ticker) WHERE wave = 2 GROUP BY holding_symbol)"


@query("SELECT holding_symbol, round(total_weight, 6) AS total_weight, n_etfs, themes FROM cand", a.HOLDINGS, a.THEMES, CANDIDATES)
def et7_wave_candidates(spark, sf):
    return etf.wave_candidates(a.holdings(spark, sf), a.themes(spark, sf), 2)


@query(
    """SELECT holding_symbol, round(total_weight, 6) AS total_weight, n_etfs, themes, rank::INT AS rank, (floor((rank - 1) / 25) + 1)::INT AS batch FROM (SELECT *, row_number() OVER (ORDER BY round(total_weight, 9) DESC, n_etfs DESC, holding_symbol) AS rank FROM cand WHERE substr(holding_symbol, 2)::BIGINT % 5 <> 0) WHERE rank <= 100""",
    a.HOLDINGS, a.THEMES, CANDIDATES,
)
def et8_wave_additions(spark, sf):
    registered = a.table(spark, sf, "part").where("p_partkey % 5 = 0").select(F.concat(F.lit("P"), "p_partkey").alias("symbol"))
    return etf.wave_additions(etf.wave_candidates(a.holdings(spark, sf), a.themes(spark, sf), 2), registered, 100, 25)


@query("SELECT etf_ticker, theme, false AS active, 0 AS holdings_count FROM themes WHERE active AND etf_ticker NOT IN (SELECT etf_ticker FROM themes WHERE wave = 1)", a.THEMES)
def et3_inactive_themes(spark, sf):
    rows = a.themes(spark, sf)
    return etf.inactive_themes(rows, rows.where("wave = 1"))


# --- differences

DIFF = """l AS (SELECT symbol, date, close AS v FROM prices), r AS (SELECT 'S' || l_suppkey AS symbol, l_shipdate::DATE AS date, max(l_extendedprice * (1 + CASE WHEN l_tax > 0.07 THEN 0.001 ELSE 0 END)) AS v FROM lineitem WHERE l_linenumber <> 3 GROUP BY ALL),
d AS (SELECT coalesce(l.symbol, r.symbol) AS symbol, coalesce(l.date, r.date) AS date, l.v AS left_value, r.v AS right_value, CASE WHEN l.symbol IS NULL THEN 'right_only' WHEN r.symbol IS NULL THEN 'left_only' ELSE 'both' END AS presence, coalesce(abs(l.v - r.v) > 0.00001, false) AS differs FROM l FULL JOIN r ON l.symbol = r.symbol AND l.date = r.date)"""


def _second(spark, sf):
    rows = a.table(spark, sf, "lineitem").where("l_linenumber <> 3")
    return rows.groupBy(F.concat(F.lit("S"), "l_suppkey").alias("symbol"), F.col("l_shipdate").cast("date").alias("date")).agg(F.max(F.col("l_extendedprice") * (1 + F.when(F.col("l_tax") > 0.07, 0.001).otherwise(0.0))).alias("close"))


def _compared(spark, sf):
    return reconcile.compared(a.prices(spark, sf), _second(spark, sf), ["symbol", "date"], "close")


@query("SELECT *, CASE WHEN mismatches + left_only + right_only > 0 THEN 'fail' ELSE 'ok' END AS status FROM (SELECT count(*) FILTER (presence = 'both') AS compared, count(*) FILTER (differs) AS mismatches, count(*) FILTER (presence = 'left_only') AS left_only, count(*) FILTER (presence = 'right_only') AS right_only, round(max(abs(left_value - right_value)), 6) AS max_difference FROM d)", a.PRICES, DIFF)
def px1_value_parity(spark, sf):
    return reconcile.parity(_compared(spark, sf))


@query("SELECT symbol, date, round(left_value, 6) AS left_value, round(right_value, 6) AS right_value, presence, differs, CASE WHEN differs THEN 'value' WHEN presence <> 'both' THEN presence END AS kind FROM d WHERE differs OR presence <> 'both' QUALIFY row_number() OVER (PARTITION BY kind ORDER BY symbol, date) <= 25", a.PRICES, DIFF)
def px5_samples(spark, sf):
    return reconcile.samples(_compared(spark, sf), ["symbol", "date"])


@query("SELECT symbol, a.n AS left_rows, b.n AS right_rows, a.n - b.n AS delta FROM (SELECT symbol, count(*) AS n FROM l GROUP BY ALL) a JOIN (SELECT symbol, count(*) AS n FROM r GROUP BY ALL) b USING (symbol) WHERE a.n <> b.n", a.PRICES, DIFF)
def ag11_count_deltas(spark, sf):
    return reconcile.count_deltas(a.prices(spark, sf), _second(spark, sf), "symbol")


ACTIONS = """act AS (SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'first' ELSE 'second' END AS provider, 'P' || l_partkey AS symbol, CASE WHEN l_returnflag = 'R' THEN 'split' ELSE 'dividend' END AS action, date_trunc('month', l_shipdate)::DATE AS ex_date, l_discount AS amount FROM lineitem),
bs AS (SELECT symbol, action FROM act GROUP BY ALL HAVING count(DISTINCT provider) = 2), fa AS (SELECT symbol, action, ex_date, max(amount) AS x FROM act SEMI JOIN bs USING (symbol, action) WHERE provider = 'first' GROUP BY ALL), sa AS (SELECT symbol, action, ex_date, max(amount) AS y FROM act SEMI JOIN bs USING (symbol, action) WHERE provider = 'second' GROUP BY ALL),
cf AS (SELECT symbol, action, ex_date, x AS first_amount, y AS second_amount, CASE WHEN y IS NULL THEN 'first_only_date' WHEN x IS NULL THEN 'second_only_date' WHEN abs(x - y) <= 0.000001 * greatest(abs(x), abs(y), 1e-300) THEN 'match' ELSE 'amount_mismatch' END AS kind FROM fa FULL JOIN sa USING (symbol, action, ex_date))"""


def _actions(spark, sf):
    return a.table(spark, sf, "lineitem").select(F.when(F.col("l_linenumber") % 2 == 0, "first").otherwise("second").alias("provider"), F.concat(F.lit("P"), "l_partkey").alias("symbol"), F.when(F.col("l_returnflag") == "R", "split").otherwise("dividend").alias("action"), F.trunc("l_shipdate", "month").alias("ex_date"), F.col("l_discount").alias("amount"))


@query("SELECT * FROM cf", ACTIONS)
def xr2_action_conflicts(spark, sf):
    return reconcile.action_conflicts(_actions(spark, sf), "first", "second")


@query("SELECT action, kind, count(*) AS n FROM cf GROUP BY GROUPING SETS ((action, kind), (kind), ())", ACTIONS)
def ag8_conflict_counts(spark, sf):
    return reconcile.conflict_counts(reconcile.action_conflicts(_actions(spark, sf), "first", "second"))


ER = """e1 AS (SELECT ticker, year(earnings_date) || 'Q' || quarter(earnings_date) AS fiscal_period, earnings_date AS report_date, actual_eps AS eps, seq FROM earnings WHERE seq % 2 = 0), e2 AS (SELECT ticker, year(earnings_date) || 'Q' || quarter(earnings_date) AS fiscal_period, earnings_date AS report_date, round(actual_eps * CASE WHEN seq % 3 = 0 THEN 1 ELSE 1.0000001 END, 4) AS eps, seq FROM earnings WHERE seq % 5 <> 0)"""


def _reports(spark, sf):
    rows = a.earnings(spark, sf).select("ticker", F.concat(F.year("earnings_date"), F.lit("Q"), F.quarter("earnings_date")).alias("fiscal_period"), F.col("earnings_date").alias("report_date"), F.col("actual_eps").alias("eps"), "seq")
    return rows.where("seq % 2 = 0"), rows.where("seq % 5 <> 0").withColumn("eps", F.round(F.col("eps") * F.when(F.col("seq") % 3 == 0, 1.0).otherwise(1.0000001), 4))


@query(
    """, m AS (SELECT e1.ticker, e1.seq, 1 AS p, e2.* EXCLUDE (ticker) RENAME (seq AS bseq, fiscal_period AS bf, report_date AS br, eps AS be) FROM e1 JOIN e2 ON e1.ticker = e2.ticker AND e1.fiscal_period = e2.fiscal_period UNION ALL SELECT e1.ticker, e1.seq, 2, e2.* EXCLUDE (ticker) FROM e1 JOIN e2 ON e1.ticker = e2.ticker AND e1.report_date = e2.report_date),
b AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY ticker, seq ORDER BY p, bseq) = 1)
SELECT e1.ticker, e1.seq, CASE WHEN br IS NULL THEN 'unmatched' WHEN abs(eps - be) IS NULL THEN 'no_value' WHEN abs(eps - be) <= 1e-12 THEN 'exact' WHEN abs(eps - be) <= 0.02 THEN 'small' WHEN abs(eps - be) <= 0.05 THEN 'medium' ELSE 'large' END AS bucket, report_date <> br AS report_date_differs, fiscal_period <> bf AS fiscal_period_differs
FROM e1 LEFT JOIN b ON e1.ticker = b.ticker AND e1.seq = b.seq""",
    a.EARNINGS, ER,
)
def xr3_earnings_conflicts(spark, sf):
    return reconcile.earnings_conflicts(*_reports(spark, sf))


SANITY = """rep AS (SELECT ticker AS symbol, earnings_date AS report_date, actual_eps AS revenue, seq, row_number() OVER (PARTITION BY ticker ORDER BY earnings_date DESC, seq DESC) AS rank FROM earnings),
st0 AS (SELECT ticker AS symbol, earnings_date AS period_end, actual_eps * CASE WHEN seq % 7 = 0 THEN 0.001 WHEN seq % 11 = 0 THEN 1.5 ELSE 1 END AS value, seq AS known_at FROM earnings QUALIFY row_number() OVER (PARTITION BY symbol, period_end ORDER BY known_at DESC, value DESC NULLS LAST) = 1),
stm AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY period_end DESC) AS rank FROM st0),
san AS (SELECT rep.symbol, rep.rank::INT AS rank, revenue, value AS statement, CASE WHEN greatest(abs(revenue / nullif(value, 0)), abs(value / nullif(revenue, 0))) BETWEEN 990 AND 1010 THEN 1000.0 END AS f, abs(revenue - value) <= 0.02 * greatest(abs(revenue), abs(value)) AS near
FROM rep LEFT JOIN stm ON rep.symbol = stm.symbol AND rep.rank = stm.rank AND stm.rank <= 8 WHERE rep.rank <= 8), sk AS (SELECT symbol, rank, revenue, round(statement, 6) AS statement, CASE WHEN revenue IS NULL OR statement IS NULL THEN 'missing' WHEN near THEN 'exact' WHEN f IS NOT NULL THEN 'scale_anomaly' ELSE 'mismatch' END AS kind, f::DOUBLE AS factor FROM san)"""


def _sanity(spark, sf):
    rows = a.earnings(spark, sf)
    off = F.when(F.col("seq") % 7 == 0, 0.001).when(F.col("seq") % 11 == 0, 1.5).otherwise(1.0)
    return reconcile.revenue_sanity(rows.select(F.col("ticker").alias("symbol"), F.col("earnings_date").alias("report_date"), F.col("actual_eps").alias("revenue"), "seq"), rows.select(F.col("ticker").alias("symbol"), F.col("earnings_date").alias("period_end"), (F.col("actual_eps") * off).alias("value"), F.col("seq").alias("known_at")))


@query("SELECT symbol, kind, count(*) AS n FROM sk GROUP BY ALL", a.EARNINGS, SANITY)
def xr4_revenue_sanity(spark, sf):
    return _sanity(spark, sf).groupBy("symbol", "kind").agg(F.count("*").alias("n"))


@query("SELECT symbol, CASE WHEN bool_or(kind IN ('mismatch', 'scale_anomaly')) THEN 'blocked' WHEN bool_or(kind = 'exact') THEN 'passed' ELSE 'unverified' END AS status, count(*) FILTER (kind = 'exact') AS exact FROM sk GROUP BY symbol", a.EARNINGS, SANITY)
def xr5_sanity_status(spark, sf):
    return reconcile.sanity_status(_sanity(spark, sf))


@query("SELECT p.symbol, p.date, close, value FROM prices p ASOF LEFT JOIN (SELECT 'S' || (o_custkey % 100 + 1) AS symbol, o_orderdate::DATE AS d, max(o_totalprice) AS value FROM orders GROUP BY ALL) q ON p.symbol = q.symbol AND p.date >= q.d", a.PRICES)
def jn5_as_of_join(spark, sf):
    points = a.table(spark, sf, "orders").groupBy(F.concat(F.lit("S"), F.col("o_custkey") % 100 + 1).alias("symbol"), F.col("o_orderdate").cast("date").alias("d")).agg(F.max("o_totalprice").alias("value"))
    return timeseries.as_of(a.prices(spark, sf), points, ["symbol"], "date", "d", ["value"]).select("symbol", "date", "close", "value")
