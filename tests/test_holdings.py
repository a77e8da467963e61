"""Holdings files of several layouts in one scan, and shares without cash."""

import datetime
from collections import Counter

from pyspark.sql import functions as F

from lodestar.operators import etf, registry
from lodestar.plans import queries, registry_queries
from lodestar.sources import adapters, layouts

FILES = {
    "a.csv": 'The fund\n"Data as of: 01/31/2024"\n\nTicker,Name,Weight (%),Asset Class\nAAPL,"Apple, Inc.",60.5,Equity\nUSD,US Dollar,39,Cash\n AAPL ,Apple again,61,Equity\n',
    "b.csv": 'Holding Ticker,"% of Net Assets",Country/Region\n700,1.5%,Hong Kong\nVOD.L,0.5%,United States\n-,,\n',
    "c.csv": "Identifier,Weight,Security Description,As Of\nMSFT,0.4,Microsoft,2024-02-01\nESH4,0.3,E-mini Future,2024-02-01\nQ,n/a,No weight,2024-02-01\n",
    "d.csv": "no header here\nAAPL,1\n",
}


def test_three_layouts_in_one_scan(spark, tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text)
    rows = layouts.read_layouts(spark, f"file://{tmp_path}")
    got = sorted((r.file.rsplit("/", 1)[-1], r.symbol, r["name"], r.weight, r.country, str(r.stated)) for r in rows.collect() if r.symbol != "-")
    assert got[:3] == [("a.csv", "AAPL", "Apple again", "61", None, "2024-01-31"), ("a.csv", "AAPL", "Apple, Inc.", "60.5", None, "2024-01-31"), ("a.csv", "USD", "US Dollar", "39", None, "2024-01-31")]
    assert got[3] == ("b.csv", "700", None, "1.5%", "Hong Kong", "None") and len(got) == 8

    funds = rows.select(F.regexp_extract("file", r"([a-z])\.csv", 1).alias("etf_ticker"), "symbol", "name", "weight", "asset_class", "country", layouts.any_day(F.col("as_of")).alias("as_of"), "stated", "seq")
    out = {(r.etf_ticker, r.holding_symbol): (r.holding_country, r.weight, r.as_of) for r in etf.normalised_holdings(funds, F.lit("2024-03-01").cast("date")).collect()}
    day = datetime.date
    assert out == {
        ("A", "AAPL"): ("US", 0.61, day(2024, 1, 31)),  # the last row; cash is out of the sum
        ("B", "0700.HK"): ("HK", 0.015, day(2024, 3, 1)), ("B", "VOD.L"): ("GB", 0.005, day(2024, 3, 1)),
        ("C", "MSFT"): ("US", 0.4, day(2024, 2, 1)),
    }


def test_theme_dimension_keeps_less_in_a_task_the_more_splits_its_table_has(spark, tmp_path):
    """What a task keeps is its share of the pairs of fund and holding, once for each aggregate by pair: two, and four tasks a split."""
    for name in ("lineitem", "supplier"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").repartition(20 if name == "lineitem" else 1).write.parquet(f"file://{tmp_path}/{name}.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        n = adapters.table(spark, f"file://{tmp_path}", "lineitem").rdd.getNumPartitions()
        df = registry_queries.et12_theme_dimension(spark, f"file://{tmp_path}")
        plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
        each = adapters.positions(spark, f"file://{tmp_path}").groupBy(F.spark_partition_id().alias("task")).count().collect()
        got = Counter(df.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert n >= 20 and sum("REPARTITION_BY_NUM" in line and f", {4 * n})" in line for line in plan) == 1
    assert sum("HashAggregate(keys=[" in line and "," in line.split("]")[0] for line in plan) == 2
    rows = sum(r["count"] for r in each)
    assert rows == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count() and max(r["count"] for r in each) < 3 * rows / (4 * n)
    assert got == Counter(registry_queries.et12_theme_dimension(spark, "/root/testdata/sf0.001").collect())


def test_theme_dimension_of_repeated_holdings(spark):
    day = datetime.date
    held = [("A", "x", day(2024, 1, 1)), ("A", "x", day(2024, 3, 1)), ("A", "y", None), ("A", None, day(2024, 5, 1)), ("B", None, None), (None, "x", day(2024, 1, 1)), ("Z", "x", day(2024, 1, 1))]
    holdings = spark.createDataFrame(held, "etf_ticker string, holding_symbol string, as_of date")
    themes = spark.createDataFrame([("A", "t", True), ("A", "u", False), ("B", "t", True), ("C", "t", True), ("C", "u", False), (None, "t", True)], "etf_ticker string, theme string, active boolean")
    want = Counter({("A", "t", True, 2, day(2024, 5, 1), False): 1, ("A", "u", False, 2, day(2024, 5, 1), False): 1, ("B", "t", True, 0, None, True): 1, ("C", "t", True, 0, None, True): 1, ("C", "u", False, 0, None, False): 1, (None, "t", True, 0, None, True): 1})
    for rows in (holdings, holdings.repartition(7, "etf_ticker", "holding_symbol")):
        assert Counter(map(tuple, registry.theme_dimension(themes, rows).collect())) == want


def test_theme_readiness_counts_the_same_dealt_pairs(spark):
    """Neither readiness nor health sums lines by fund and holding before they take pairs once; health needs sums for its edges alone."""
    for query in (queries.et5_theme_readiness, queries.et6_theme_health):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("REPARTITION_BY_NUM") == 1


def test_files_are_scanned_twice_and_holdings_judged_once(spark, tmp_path):
    """Lines are read for headers and for rows, and no filter repeats the rules of a holding or the splitting of a line below it."""
    (tmp_path / "a.csv").write_text(FILES["a.csv"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = layouts.read_layouts(spark, f"file://{tmp_path}").withColumns({"etf_ticker": F.lit("a"), "as_of": layouts.any_day(F.col("as_of"))})
        plan = etf.normalised_holdings(rows, F.lit("2024-03-01").cast("date"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert (plan.count("FileScan text"), plan.count("REPURCHASE AGREEMENT"), plan.count("split(value")) == (2, 1, 1)
