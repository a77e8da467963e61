"""The test tables in the shapes of the domain, as DataFrames and as SQL with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Which order priority plays which metric, and which event type has which frequency.
METRICS = {"1-URGENT": "revenue", "2-HIGH": "net_income", "3-MEDIUM": "eps", "4-NOT SPECIFIED": "market_cap", "5-LOW": "shares_outstanding"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by key to four tasks a core: for much work on each row of a small file, which is read by few tasks."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, *keys)


def dealt(rows: DataFrame, source: DataFrame, *keys: str) -> DataFrame:
    """rows dealt by key to four tasks for each core or split of the source table, whichever are more: a split has a largest size, so what
    a task must keep of its keys stays the same however large the table is."""
    return rows.repartition(4 * max(rows.sparkSession.sparkContext.defaultParallelism, source.rdd.getNumPartitions()), *keys)


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("S"), "l_suppkey").alias("symbol"), F.col("l_shipdate").cast("date").alias("date"), "l_extendedprice", "l_quantity")
    return rows.groupBy("symbol", "date").agg(F.max("l_extendedprice").alias("close"), F.sum("l_quantity").alias("volume"))


def fundamentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    metric = F.element_at(F.create_map(*(F.lit(x) for p in METRICS.items() for x in p)), F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select(F.concat(F.lit("C"), "o_custkey").alias("ticker"), metric.alias("metric"), F.col("o_orderdate").cast("date").alias("period_end"), F.col("o_totalprice").alias("value"), F.concat(F.lit("src"), F.col("o_orderkey") % 3).alias("source"), F.col("o_orderkey").alias("seq"))


def earnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = F.lag("o_totalprice").over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    return table(spark, sf_dir, "orders").select(F.concat(F.lit("C"), "o_custkey").alias("ticker"), F.col("o_orderdate").cast("date").alias("earnings_date"), F.when(F.col("o_orderstatus") != "O", F.col("o_totalprice")).alias("actual_eps"), before.alias("estimate_eps"), F.col("o_orderstatus").alias("state"), F.col("o_orderkey").alias("seq"))


def macro_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily maxima of each event type; the last event of a day is its release, seen late on every third day."""
    rows = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("series_key"), F.col("ts").cast("date").alias("observation_date")).agg(F.max("value").alias("value"), F.max("ts").alias("scheduled_at"), F.max("event_id").alias("seq"))
    observed = F.when(F.dayofmonth("observation_date") % 3 != 0, F.col("scheduled_at") + F.expr("interval 90 seconds"))
    return rows.select("series_key", F.lit("daily").alias("frequency"), "observation_date", "value", F.date_trunc("second", "scheduled_at").alias("scheduled_at"), F.date_trunc("second", observed).alias("observed_at"), F.lit("America/New_York").alias("zone"), F.col("scheduled_at").alias("released_at"), "seq")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each event type; a limit of its own for those of even length."""
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("series_key")).distinct()
    return rows.select("series_key", F.lit("daily").alias("frequency"), F.when(F.length("series_key") % 2 == 0, 1).alias("staleness_limit"), F.lit("2024-01-05").cast("date").alias("active_from"))


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").groupBy(F.concat(F.lit("E"), "l_suppkey").alias("etf_ticker"), F.concat(F.lit("P"), "l_partkey").alias("holding_symbol")).agg(F.sum("l_extendedprice").alias("amount"), F.max(F.col("l_shipdate").cast("date")).alias("as_of"))
    share = F.col("amount") / F.sum("amount").over(Window.partitionBy("etf_ticker"))
    return rows.select("etf_ticker", "holding_symbol", share.alias("weight"), "as_of")


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holdings are made of: a row for each line, so a holding and its dates repeat."""
    lines = table(spark, sf_dir, "lineitem")
    rows = lines.select(F.concat(F.lit("E"), "l_suppkey").alias("etf_ticker"), F.concat(F.lit("P"), "l_partkey").alias("holding_symbol"), F.col("l_shipdate").cast("date").alias("as_of"))
    return dealt(rows, lines, "etf_ticker", "holding_symbol")


def themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(F.concat(F.lit("E"), s).alias("etf_ticker"), F.concat(F.lit("theme"), s % 7).alias("theme"), (s % 3 + 1).cast("int").alias("wave"), (s % 5 != 0).alias("active"))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as listings: S, P and a placeholder symbol by key, states by balance."""
    k, b = F.col("s_suppkey"), F.col("s_acctbal")
    ticker = F.when(k % 10 == 0, F.concat(F.lpad(k.cast("string"), 6, "1"), F.lit("A"))).otherwise(F.concat(F.lit("S"), k))
    status = F.when(b < 0, "rejected").when(b < 5000, "active").otherwise("pending")
    promotion = F.when(k % 2 == 0, "validated_full").otherwise("candidate")
    return table(spark, sf_dir, "supplier").select(ticker.alias("ticker"), status.alias("status"), promotion.alias("promotion_status"), F.col("s_nationkey").alias("nation"), b.alias("balance"))


PRICES = "prices AS (SELECT 'S' || l_suppkey AS symbol, l_shipdate::DATE AS date, max(l_extendedprice) AS close, sum(l_quantity) AS volume FROM lineitem GROUP BY ALL)"
FUNDAMENTALS = "facts AS (SELECT 'C' || o_custkey AS ticker, CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in METRICS.items()) + " END AS metric, o_orderdate::DATE AS period_end, o_totalprice AS value, 'src' || (o_orderkey % 3) AS source, o_orderkey AS seq FROM orders)"
EARNINGS = "earnings AS (SELECT 'C' || o_custkey AS ticker, o_orderdate::DATE AS earnings_date, CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END AS actual_eps, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS estimate_eps, o_orderstatus AS state, o_orderkey AS seq FROM orders)"
MACRO = "raw AS (SELECT event_type AS series_key, ts::DATE AS observation_date, max(value) AS value, max(ts) AS released_at, max(event_id) AS seq FROM events GROUP BY ALL), obs AS (SELECT series_key, observation_date, value, date_trunc('second', released_at) AS scheduled_at, CASE WHEN day(observation_date) % 3 <> 0 THEN date_trunc('second', released_at + INTERVAL 90 SECOND) END AS observed_at, released_at, seq FROM raw)"
CATALOG = "catalog AS (SELECT DISTINCT event_type AS series_key, CASE WHEN length(event_type) % 2 = 0 THEN 1 END AS staleness_limit, DATE '2024-01-05' AS active_from FROM events)"
HOLDINGS = "h0 AS (SELECT 'E' || l_suppkey AS etf_ticker, 'P' || l_partkey AS holding_symbol, sum(l_extendedprice) AS amount, max(l_shipdate::DATE) AS as_of FROM lineitem GROUP BY ALL), holdings AS (SELECT etf_ticker, holding_symbol, amount / sum(amount) OVER (PARTITION BY etf_ticker) AS weight, as_of FROM h0)"
THEMES = "themes AS (SELECT 'E' || s_suppkey AS etf_ticker, 'theme' || (s_suppkey % 7) AS theme, (s_suppkey % 3 + 1)::INT AS wave, s_suppkey % 5 <> 0 AS active FROM supplier)"
REGISTRY = "registry AS (SELECT CASE WHEN s_suppkey % 10 = 0 THEN lpad(s_suppkey::VARCHAR, 6, '1') || 'A' ELSE 'S' || s_suppkey END AS ticker, CASE WHEN s_acctbal < 0 THEN 'rejected' WHEN s_acctbal < 5000 THEN 'active' ELSE 'pending' END AS status, CASE WHEN s_suppkey % 2 = 0 THEN 'validated_full' ELSE 'candidate' END AS promotion_status, s_nationkey AS nation, s_acctbal AS balance FROM supplier)"


def weekdays(d: str) -> str:
    """SQL for functions.dates.weekdays_before."""
    n = f"(date_diff('day', DATE '1969-12-29', {d}))"
    return f"(5 * floor({n} / 7.0)::BIGINT + least((({n} % 7) + 7) % 7, 5))"
