"""Keyed and ordered operators: as-of joins, spines, first and last values, top k, gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import business_days_between, is_weekend


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row for each key, the last in the given order."""
    return top_k(df, keys, [F.desc_nulls_last(c) if isinstance(c, str) else c for c in order], 1)


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_rank") <= k).drop("_rank")


def last_value(c: str, *order: str) -> Column:
    """Aggregate: the last value of c that isn't null, by order."""
    return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*order)))


def first_value(c: str, *order: str) -> Column:
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*order)))


def spine(df: DataFrame, start: str, end: str, out: str = "as_of_date", business: bool = True) -> DataFrame:
    """df's rows, each repeated for every (business) day from start to end."""
    days = df.withColumn(out, F.explode(F.expr(f"sequence(date'{start}', date'{end}', interval 1 day)")))
    return days.where(~is_weekend(F.col(out))) if business else days


#: Days of a time bucket of as_of.
BUCKET_DAYS = 64


def as_of(left: DataFrame, points: DataFrame, keys: Sequence[str], left_date: str, point_date: str, values: Sequence[str], order: Sequence[str] = (), forward: bool = False, bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """left with the values of the latest point on or before left_date (forward: the earliest on or after), null where there is none.

    Both sides meet in one union, shuffled once by key and bucket of bucket_days days and ordered by date: no range join, rows only pass
    on what they saw last, and a key that holds all rows spreads over as many tasks as it has buckets. What a bucket begins with, the last
    point of the buckets before it, comes from a pass over one row a key and bucket, as a row that stands before all others.
    order breaks ties among points of one date; the last wins (forward: the first). Null dates come before all others.
    """
    kept = F.struct(F.col(point_date).alias("_date"), *values)
    p = points.select(*keys, F.col(point_date).alias("_at"), F.lit(1 if forward else 0).alias("_side"), F.struct(*order).alias("_tie") if order else F.lit(None).alias("_tie"), F.lit(None).cast(left.select(F.struct(*left.columns)).schema[0].dataType).alias("_left"), kept.alias("_point"))
    rows = left.select(*keys, F.col(left_date).alias("_at"), F.lit(0 if forward else 1).alias("_side"), F.lit(None).cast(p.schema["_tie"].dataType).alias("_tie"), F.struct(*left.columns).alias("_left"), F.lit(None).cast(p.schema["_point"].dataType).alias("_point"))
    bucket = F.coalesce(F.floor(F.unix_date(F.col("_at").cast("date")) / bucket_days).cast("int"), F.lit(-(1 << 31)))
    both = p.unionAll(rows).withColumn("_bucket", bucket)
    at = F.struct(F.col("_at").isNotNull(), "_at", "_tie")
    best = (F.min_by if forward else F.max_by)("_point", F.when(F.col("_point").isNotNull(), at))
    ends = both.groupBy(*keys, "_bucket").agg(best.alias("_point"))
    by_bucket = Window.partitionBy(*keys).orderBy("_bucket")
    before = F.first("_point", ignorenulls=True).over(by_bucket.rowsBetween(1, Window.unboundedFollowing)) if forward else F.last("_point", ignorenulls=True).over(by_bucket.rowsBetween(Window.unboundedPreceding, -1))
    carried = ends.withColumn("_point", before).where(F.col("_point").isNotNull())
    types = {c: both.schema[c].dataType for c in ("_at", "_tie", "_left")}
    carried = carried.select(*keys, *(F.lit(None).cast(types["_at"]).alias("_at"),), F.lit(2 if forward else -1).alias("_side"), F.lit(None).cast(types["_tie"]).alias("_tie"), F.lit(None).cast(types["_left"]).alias("_left"), "_point", "_bucket")
    edge = F.col("_side") == 2 if forward else F.col("_side") != -1  # the carried row comes last, or first
    by = Window.partitionBy(*keys, "_bucket").orderBy(edge, "_at", "_side", "_tie")
    seen = F.first("_point", ignorenulls=True).over(by.rowsBetween(0, Window.unboundedFollowing)) if forward else F.last("_point", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0))
    return both.unionAll(carried).withColumn("_seen", seen).where(F.col("_left").isNotNull()).select("_left.*", F.col("_seen._date").alias(point_date), *(F.col(f"_seen.{v}").alias(v) for v in values))


def largest_gap(df: DataFrame, key: str, date: str, *more: Column) -> DataFrame:
    """For each key its first and last date, the number of dates, more aggregates over the distinct dates, and the widest run of missing
    business days with the dates around it (the earliest of equal ones)."""
    days = df.select(key, date).where(F.col(date).isNotNull()).distinct()
    before = F.lag(date).over(Window.partitionBy(key).orderBy(date))
    gaps = days.withColumn("_before", before).withColumn("_gap", F.coalesce(business_days_between(F.col("_before"), F.col(date)), F.lit(0)))
    widest = F.max_by(F.struct("_before", date), F.struct("_gap", -F.unix_date(F.col(date))))
    found = gaps.groupBy(key).agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"), F.count("*").alias("n_dates"), F.max("_gap").alias("largest_gap"), widest.alias("_w"), *more)
    return found.select("*", F.when(F.col("largest_gap") > 0, F.col("_w._before")).alias("gap_after"), F.when(F.col("largest_gap") > 0, F.col(f"_w.{date}")).alias("gap_before")).drop("_w")
