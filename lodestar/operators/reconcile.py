"""Differences between providers and versions of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import near, scale_factor
from .timeseries import top_k

TOLERANCE = 1e-5


def compared(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str, tolerance: float = TOLERANCE) -> DataFrame:
    """Rows of both sides by key: left and right value, where they are, and whether they differ."""
    a, b = left.select(*keys, F.col(value).alias("left_value"), F.lit(True).alias("in_left")), right.select(*keys, F.col(value).alias("right_value"), F.lit(True).alias("in_right"))
    rows = a.join(b, list(keys), "full_outer")
    where = F.when(F.col("in_left") & F.col("in_right"), "both").when(F.col("in_left"), "left_only").otherwise("right_only")
    differ = F.when(where == "both", (F.abs(F.col("left_value") - F.col("right_value")) > tolerance) | (F.col("left_value").isNull() != F.col("right_value").isNull())).otherwise(False)
    return rows.select(*keys, "left_value", "right_value", where.alias("presence"), F.coalesce(differ, F.lit(False)).alias("differs"))


def parity(rows: DataFrame) -> DataFrame:
    """One row: counts of compared's rows, mismatches and the largest difference; fail if anything differs."""
    c = rows.agg(F.count_if(F.col("presence") == "both").alias("compared"), F.count_if("differs").alias("mismatches"), F.count_if(F.col("presence") == "left_only").alias("left_only"), F.count_if(F.col("presence") == "right_only").alias("right_only"), F.max(F.abs(F.col("left_value") - F.col("right_value"))).alias("max_difference"))
    return c.withColumn("status", F.when(F.col("mismatches") + F.col("left_only") + F.col("right_only") > 0, "fail").otherwise("ok"))


def samples(rows: DataFrame, keys: Sequence[str], k: int = 25) -> DataFrame:
    """The first k rows by key of each kind of difference; k is the report's own limit."""
    kind = F.when(F.col("differs"), "value").when(F.col("presence") != "both", F.col("presence"))
    return top_k(rows.withColumn("kind", kind).where(F.col("kind").isNotNull()), ["kind"], [F.asc(x) for x in keys], k)


def count_deltas(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys whose row counts differ."""
    a, b = (df.groupBy(key).agg(F.count("*").alias(n)) for df, n in ((left, "left_rows"), (right, "right_rows")))
    rows = a.join(b, key, "full_outer").na.fill(0, ["left_rows", "right_rows"])
    return rows.where("left_rows <> right_rows").withColumn("delta", F.col("left_rows") - F.col("right_rows"))


def action_conflicts(actions: DataFrame, first: str, second: str, tolerance: float = 1e-6) -> DataFrame:
    """Of (provider, symbol, action, ex_date, amount): symbols and actions that both providers have, by ex-date: match, amount_mismatch, or a date of one side."""
    both = actions.groupBy("symbol", "action").agg(F.bool_or(F.col("provider") == first).alias("a"), F.bool_or(F.col("provider") == second).alias("b")).where("a AND b").select("symbol", "action")
    side = lambda p, n: actions.where(F.col("provider") == p).join(both, ["symbol", "action"], "left_semi").groupBy("symbol", "action", "ex_date").agg(F.max("amount").alias(n))
    rows = side(first, "first_amount").join(side(second, "second_amount"), ["symbol", "action", "ex_date"], "full_outer")
    kind = F.when(F.col("second_amount").isNull(), "first_only_date").when(F.col("first_amount").isNull(), "second_only_date").when(near(F.col("first_amount"), F.col("second_amount"), tolerance), "match").otherwise("amount_mismatch")
    return rows.withColumn("kind", kind)


def conflict_counts(conflicts: DataFrame) -> DataFrame:
    """Rows by action and kind, by kind, and in all."""
    return conflicts.groupingSets([["action", "kind"], ["kind"], []], "action", "kind").agg(F.count("*").alias("n"))


def earnings_conflicts(first: DataFrame, second: DataFrame) -> DataFrame:
    """Each row of first with its match in second, by fiscal period or else by report date (first by seq), and the size of the EPS difference."""
    # The first row of second for each period and for each date, so that a row of first meets one of either.
    match = F.struct(F.col("report_date").alias("b_report_date"), F.col("fiscal_period").alias("b_fiscal_period"), F.col("eps").alias("b_eps"))
    one = lambda key: second.where(F.col(key).isNotNull()).groupBy("ticker", key).agg(F.min_by(match, "seq").alias(f"_{key}"))
    met = first.join(one("fiscal_period"), ["ticker", "fiscal_period"], "left").join(one("report_date"), ["ticker", "report_date"], "left")
    rows = met.withColumn("_b", F.coalesce("_fiscal_period", "_report_date")).select(*first.columns, "_b.*")
    delta = F.abs(F.col("eps") - F.col("b_eps"))
    bucket = F.when(F.col("b_report_date").isNull(), "unmatched").when(delta.isNull(), "no_value").when(delta <= 1e-12, "exact").when(delta <= 0.02, "small").when(delta <= 0.05, "medium").otherwise("large")
    return rows.select("ticker", "seq", bucket.alias("bucket"), (F.col("report_date") != F.col("b_report_date")).alias("report_date_differs"), (F.col("fiscal_period") != F.col("b_fiscal_period")).alias("fiscal_period_differs"))


def revenue_sanity(reports: DataFrame, statements: DataFrame, k: int = 8, tolerance: float = 0.02) -> DataFrame:
    """The k latest reports of a symbol against its k latest statements, rank by rank: exact, mismatch, missing or a scale anomaly."""
    from pyspark.sql import Window

    latest = top_k(statements, ["symbol", "period_end"], [F.desc("known_at"), F.desc("value")], 1)
    ranked = lambda df, *by: df.withColumn("rank", F.row_number().over(Window.partitionBy("symbol").orderBy(*by))).where(F.col("rank") <= k)
    rows = ranked(reports, F.desc("report_date"), F.desc("seq")).select("symbol", "rank", "revenue").join(ranked(latest, F.desc("period_end")).select("symbol", "rank", F.col("value").alias("statement")), ["symbol", "rank"], "left")
    factor = scale_factor(F.col("revenue"), F.col("statement"))
    kind = F.when(F.col("revenue").isNull() | F.col("statement").isNull(), "missing").when(near(F.col("revenue"), F.col("statement"), tolerance), "exact").when(factor.isNotNull(), "scale_anomaly").otherwise("mismatch")
    return rows.withColumns({"kind": kind, "factor": factor})


def sanity_status(rows: DataFrame) -> DataFrame:
    """blocked if a symbol has a mismatch or a scale anomaly, passed if any rank is exact, else unverified."""
    bad = F.bool_or(F.col("kind").isin("mismatch", "scale_anomaly"))
    return rows.groupBy("symbol").agg(F.when(bad, "blocked").when(F.bool_or(F.col("kind") == "exact"), "passed").otherwise("unverified").alias("status"), F.count_if(F.col("kind") == "exact").alias("exact"))


def timing_parity(canonical: DataFrame, legacy: DataFrame, keys: Sequence[str], at: str = "available_at") -> DataFrame:
    """One row: canonical rows, those without a legacy time, and those whose time differs, exactly in UTC. The last legacy row of a key counts.

    legacy has a column seq that orders its rows.
    """
    last = legacy.groupBy(*keys).agg(F.max_by(at, "seq").alias("_legacy"))
    rows = canonical.join(last, list(keys), "left")
    own, other = F.col(at), F.col("_legacy")
    missing, different = own.isNotNull() & other.isNull(), own.isNotNull() & other.isNotNull() & (own != other)
    counts = rows.agg(F.count("*").alias("compared"), F.count_if(missing).alias("missing"), F.count_if(different).alias("mismatched"))
    return counts.withColumn("status", F.when((F.col("missing") == 0) & (F.col("mismatched") == 0), "ok").otherwise("fail"))


def placeholder_reason(at: Column, end: str, schedule_only: Column | None = None) -> Column:
    """Why a release is no release yet: only scheduled, after the end of the window's last day, or without a time; null for the others."""
    last = F.lit(f"{end} 23:59:59").cast("timestamp")
    planned = F.coalesce(schedule_only, F.lit(False)) if schedule_only is not None else F.lit(False)
    return F.when(planned, "schedule_based_only_no_observation").when(at > last, "forward_unrealized_release_timestamp").when(at.isNull(), "missing_release_timestamp")


def release_parity(canonical: DataFrame, legacy: DataFrame, keys: Sequence[str], end: str) -> DataFrame:
    """One row: both tables' effective releases (key, at, schedule_only) by key: shared, only in one, with another time; and placeholders left out."""
    def split(df: DataFrame, side: str) -> tuple[DataFrame, DataFrame]:
        rows = df.withColumn("_why", placeholder_reason(F.col("at"), end, F.col("schedule_only") if "schedule_only" in df.columns else None))
        return rows.where("_why IS NULL").groupBy(*keys).agg(F.max("at").alias(f"at_{side}")), rows.where("_why IS NOT NULL").agg(F.count("*").alias(f"placeholders_{side}"))

    (a, left_out_a), (b, left_out_b) = split(canonical, "canonical"), split(legacy, "legacy")
    one, other = F.col("at_canonical").isNotNull(), F.col("at_legacy").isNotNull()
    counts = a.join(b, list(keys), "full_outer").agg(
        F.count_if(one & other).alias("shared"), F.count_if(one & ~other).alias("only_canonical"), F.count_if(~one & other).alias("only_legacy"),
        F.count_if(F.col("at_canonical") != F.col("at_legacy")).alias("timestamp_mismatches"),
    )
    return counts.crossJoin(left_out_a).crossJoin(left_out_b)
