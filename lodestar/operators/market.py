"""Products over daily prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.casts import day, instant, number, ratio, symbol
from ..functions.dates import business_days_inclusive, quarter_index
from .timeseries import largest_gap, top_k

YEAR = 252


def clean_prices(prices: DataFrame) -> DataFrame:
    """symbol, date, close, volume with lenient casts; rows without symbol, date or close go."""
    volume = number(F.col("volume")) if "volume" in prices.columns else F.lit(None).cast("double")
    return prices.select(symbol(F.col("symbol")).alias("symbol"), day(F.col("date")).alias("date"), number(F.col("close")).alias("close"), volume.alias("volume")).dropna(subset=["symbol", "date", "close"])


def _ranked(prices: DataFrame, most: int | None = None) -> DataFrame:
    """Prices with rk (1: latest) and ret (change to the row before), over one shuffle and sort; the latest `most` rows of a symbol, whose
    last has no ret. That limit is applied before the shuffle and again after it, so older rows are neither sent on nor kept."""
    by = Window.partitionBy("symbol").orderBy(F.desc("date"))
    rows = clean_prices(prices).withColumn("rk", F.row_number().over(by))
    rows = rows if most is None else rows.where(F.col("rk") <= most)
    return rows.withColumn("ret", ratio(F.col("close"), F.lead("close").over(by)) - 1)


def _at(rank: int, c: str = "close") -> Column:
    return F.max(F.when(F.col("rk") == rank, F.col(c)))


def _within(n: int, c: str | Column) -> Column:
    return F.when(F.col("rk") <= n, F.col(c) if isinstance(c, str) else c)


def market_stats(prices: DataFrame) -> DataFrame:
    """One row for each symbol: last price, returns over 1, 21, 63 and 252 rows, volatility of 30 returns, drawdown and distances over 252 rows."""
    top = F.max(_within(YEAR, "close")).over(Window.partitionBy("symbol").orderBy("date").rowsBetween(Window.unboundedPreceding, 0))
    rows = _ranked(prices, YEAR + 1).withColumn("fall", _within(YEAR, ratio(F.col("close"), top) - 1))
    vol = F.when(F.count(_within(30, "ret")) >= 2, F.stddev_samp(_within(30, "ret")) * F.sqrt(F.lit(float(YEAR))))
    back = {f"return_{name}": ratio(_at(1), _at(n + 1)) - 1 for name, n in (("1d", 1), ("1m", 21), ("3m", 63), ("1y", 252))}
    stats = {"last_price": _at(1), **back, "vol_30d": vol, "drawdown_1y": F.min("fall"), "dist_high_52w": ratio(_at(1), F.max(_within(YEAR, "close"))) - 1, "dist_low_52w": ratio(_at(1), F.min(_within(YEAR, "close"))) - 1}
    return rows.groupBy("symbol").agg(F.max("date").alias("as_of_date"), *(c.alias(n) for n, c in stats.items()))


def trend_features(prices: DataFrame) -> DataFrame:
    """Distances from moving averages of 20, 50 and 200 rows, fall from the 252-row high, 20-return volatility, volume against its 20-row mean."""
    far = {f"dist_ma_{n}": F.when(F.count(_within(n, "close")) >= n, ratio(_at(1), F.avg(_within(n, "close"))) - 1) for n in (20, 50, 200)}
    vol = F.when(F.count(_within(20, "ret")) >= 2, F.stddev_samp(_within(20, "ret")) * F.sqrt(F.lit(float(YEAR))))
    volume = F.when(F.count("volume") >= 20, ratio(_at(1, "volume"), F.avg(_within(20, "volume"))))
    return _ranked(prices).groupBy("symbol").agg(*(c.alias(n) for n, c in far.items()), (ratio(_at(1), F.max(_within(YEAR, "close"))) - 1).alias("fall_from_high"), vol.alias("vol_20d"), volume.alias("volume_ratio"))


def quote_changes(prices: DataFrame) -> DataFrame:
    """Latest price against the one before: change and per cent, and the list of fields that are missing."""
    rows = _ranked(prices, 2).groupBy("symbol").agg(_at(1).alias("price"), _at(2).alias("previous_close"), _at(1, "volume").alias("volume"))
    fields = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in ("price", "previous_close", "volume"))))
    return rows.select("symbol", "price", "previous_close", (F.col("price") - F.col("previous_close")).alias("change"), ((ratio(F.col("price"), F.col("previous_close")) - 1) * 100).alias("change_pct"), F.array_join(fields, ",").alias("missing"))


def history_repairs(universe: DataFrame, prices: DataFrame, min_rows: int, stale_before: str) -> DataFrame:
    """Symbols of the universe with too few rows, no date, or an old latest date, and why (the first that holds)."""
    stats = clean_prices(prices).groupBy("symbol").agg(F.count("*").alias("n_rows"), F.max("date").alias("latest_date"))
    rows = universe.select("symbol").distinct().join(stats, "symbol", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    reason = F.when(F.col("latest_date").isNull(), "no_history").when(F.col("n_rows") < min_rows, "too_few_rows").when(F.col("latest_date") < F.lit(stale_before).cast("date"), "stale")
    return rows.withColumn("reason", reason).where(F.col("reason").isNotNull())


def data_windows(prices: DataFrame) -> DataFrame:
    """Dates, expected and missing business days, completeness and its tier, and the largest gap of each symbol."""
    rows = largest_gap(clean_prices(prices), "symbol", "date").withColumnRenamed("n_dates", "actual")
    rows = rows.withColumn("expected", business_days_inclusive(F.col("first_date"), F.col("last_date")))
    rows = rows.withColumns({"missing": F.greatest(F.lit(0), F.col("expected") - F.col("actual")), "completeness": F.round(ratio(F.col("actual") * 100.0, F.col("expected")), 2)})
    tier = F.when(F.col("missing") == 0, "complete").when((F.col("completeness") >= 99) & (F.col("missing") <= 3), "nearly complete").when(F.col("completeness") >= 95, "usable").otherwise("incomplete")
    return rows.select("symbol", "first_date", "last_date", "expected", "actual", "missing", "completeness", "largest_gap", "gap_after", "gap_before", tier.alias("assessment"))


def period_windows(rows: DataFrame, key: str, date: str, updates: tuple[str, ...] = (), quarterly: bool = False) -> DataFrame:
    """Dates of each key, its latest update over the time columns, and the widest gap (the earliest of equal ones) as a text.

    quarterly: quarters from the first to the last date are expected, and those not there are missing; otherwise nothing is expected.
    A key without a date has no window, but a latest update.
    """
    stamp = F.array_max(F.array(*(instant(F.col(c)) for c in updates))) if updates else F.lit(None).cast("timestamp")
    days = rows.groupBy(key, day(F.col(date)).alias("_day")).agg(F.max(stamp).alias("_at"))
    days = days.withColumn("_before", F.lag("_day").over(Window.partitionBy(key).orderBy("_day")))
    between = (quarter_index(F.col("_day")) - quarter_index(F.col("_before")) if quarterly else F.datediff("_day", "_before")) - 1
    days = days.withColumn("_gap", F.greatest(F.lit(0), between))
    widest = F.max_by(F.struct("_gap", "_before", "_day"), F.struct("_gap", -F.unix_date("_day"))).alias("_w")
    found = days.groupBy(key).agg(F.min("_day").alias("first_date"), F.max("_day").alias("last_date"), F.max("_at").alias("latest_update"), F.count("_day").alias("actual"), widest)
    expected = (quarter_index(F.col("last_date")) - quarter_index(F.col("first_date")) + 1 if quarterly else F.lit(None)).cast("long")
    unit = "missing_quarters" if quarterly else "missing_calendar_days"
    summary = F.when(F.col("_w._gap") > 0, F.format_string(f"%s -> %s ({unit}=%d)", F.col("_w._before").cast("string"), F.col("_w._day").cast("string"), "_w._gap"))
    found = found.withColumn("expected", expected)
    missing = F.when(F.col("expected").isNotNull(), F.greatest(F.lit(0), F.col("expected") - F.col("actual")))
    completeness = F.round(ratio(F.col("actual") * 100.0, F.col("expected")), 2)
    return found.select(key, "first_date", "last_date", "latest_update", "expected", "actual", missing.alias("missing"), completeness.alias("completeness"), summary.alias("largest_gap"))


def latest_and_history(prices: DataFrame) -> DataFrame:
    """The latest row of each symbol."""
    return top_k(clean_prices(prices), ["symbol"], [F.desc("date"), F.desc("close")], 1)
