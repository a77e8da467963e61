"""Macro series: observations, alignment to business days, and release calendars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.casts import day, instant, number
from ..functions.dates import business_days, on_business_day, period_label, release_day, saturday_on_or_before, thursday_after
from ..functions.symbols import lookup
from .timeseries import as_of, keep_last, spine

# Business days after which a value is stale, by frequency; grace of a release; longest lag of a vendor's week.
STALE_AFTER = {"daily": 5, "weekly": 10, "monthly": 45}
GRACE_HOURS, VENDOR_LAG_DAYS = 4, 14
# States of availability.
AVAILABILITY = ("observed_available", "scheduled_provisional", "late_missing_observation", "schedule_only_unsupported_history")


def observations(series: DataFrame) -> DataFrame:
    """(series_key, frequency, observation_date, value, seq) as observations: weekly dates go back to Saturday, the last value of a date stays."""
    rows = series.select("series_key", "frequency", day(F.col("observation_date")).alias("observation_date"), number(F.col("value")).alias("value"), "seq").dropna(subset=["observation_date", "value"])
    rows = rows.withColumn("observation_date", F.when(F.col("frequency") == "weekly", saturday_on_or_before(F.col("observation_date"))).otherwise(F.col("observation_date")))
    return keep_last(rows, ["series_key", "observation_date"], ["seq"]).withColumn("observation_period", period_label(F.col("observation_date"), F.col("frequency")))


def attach_releases(obs: DataFrame, calendar: DataFrame, timed: tuple[str, ...]) -> DataFrame:
    """obs with what the calendar says of each release: all its columns but seq, null for series that are not timed by releases and for
    periods that it doesn't hold. The last calendar row (by seq) of a series and period counts; keys are compared trimmed."""
    keys = ["series_key", "observation_period"]
    said = [c for c in calendar.columns if c not in (*keys, "seq")]
    known = calendar.select(*(F.trim(k).alias(f"_{k}") for k in keys), *said, "seq").where(F.col("_series_key").isin(*timed))
    known = keep_last(known, ["_series_key", "_observation_period"], ["seq"]).drop("seq")
    return obs.join(known, [F.trim(k) == F.col(f"_{k}") for k in keys], "left").select(*obs.columns, *said)


def daily_alignment(obs: DataFrame, catalog: DataFrame, start: str, end: str, release_timed: bool = True) -> DataFrame:
    """One row for each series and business day: the latest value that could be known, and how stale it is.

    A value counts from the business day of its release (observed, else scheduled), or from its own date where it has none;
    values from before the start still fill into the window, stale values stay and are flagged, days before the first value go.
    """
    release = F.coalesce("observed_at", "scheduled_at")
    effective = on_business_day(F.col("observation_date"))
    if release_timed:
        effective = F.when(release.isNotNull(), release_day(release, F.coalesce("zone", F.lit("America/New_York")))).otherwise(effective)
    points = keep_last(obs.withColumn("effective_date", effective), ["series_key", "effective_date"], ["observation_date", "value"])
    days = spine(catalog.select("series_key", "frequency", "staleness_limit"), start, end)
    rows = as_of(days, points, ["series_key"], "as_of_date", "effective_date", ["value", "observation_date", "observation_period"])
    limit = F.coalesce("staleness_limit", *(F.when(F.col("frequency") == f, n) for f, n in STALE_AFTER.items()))
    stale = business_days(F.col("observation_date"), F.col("as_of_date"))
    return rows.where(F.col("observation_date").isNotNull()).select("as_of_date", "series_key", "value", F.col("observation_period").alias("source_observation_period"), F.col("observation_date").alias("source_observation_date"), stale.alias("staleness_bdays"), (stale > limit).alias("is_stale"))


def latest_observations(obs: DataFrame) -> DataFrame:
    return keep_last(obs, ["series_key"], ["observation_date", "released_at", "seq"])


def missing_in_window(daily: DataFrame, required: DataFrame) -> DataFrame:
    """(as_of_date, series_key) of required series that have begun and are not null on no row of a published date."""
    begun = required.where("active_from IS NOT NULL").join(daily.groupBy("series_key").agg(F.min("as_of_date").alias("first_date")), "series_key")
    dates = daily.select("as_of_date").distinct()
    wanted = dates.join(begun, (F.col("as_of_date") >= F.col("active_from")) & (F.col("as_of_date") >= F.col("first_date"))).select("as_of_date", "series_key")
    return wanted.join(daily.where(F.col("value").isNotNull()).select("as_of_date", "series_key"), ["as_of_date", "series_key"], "left_anti")


def contract_violations(daily: DataFrame, required: DataFrame) -> DataFrame:
    """(rule, series_key, n) of every broken rule of the published table."""
    doubled = daily.groupBy("series_key", "as_of_date").count().where("count > 1").groupBy("series_key").agg(F.count("*").alias("n"))
    empty = daily.where(F.col("value").isNull() | F.isnan("value")).groupBy("series_key").agg(F.count("*").alias("n"))
    forward = daily.where(F.col("source_observation_date") > F.col("as_of_date")).groupBy("series_key").agg(F.count("*").alias("n"))
    last = daily.agg(F.max("as_of_date").alias("last"))
    at_last = daily.join(F.broadcast(last), F.col("as_of_date") == F.col("last")).where(F.col("value").isNotNull()).select("series_key")
    absent = required.join(at_last, "series_key", "left_anti").select("series_key", F.lit(1).cast("long").alias("n"))
    parts = {"duplicate_key": doubled, "null_value": empty, "forward_dated": forward, "required_missing_at_latest": absent}
    out = [df.select(F.lit(rule).alias("rule"), "series_key", "n") for rule, df in parts.items()]
    return out[0].unionAll(out[1]).unionAll(out[2]).unionAll(out[3])


# --- release calendars


def monthly_schedule(releases: DataFrame, present: DataFrame) -> DataFrame:
    """Observation months of each series by the month's first release: a release covers all months since the one before it."""
    first = releases.groupBy("series_key", F.trunc("release_date", "month").alias("month")).agg(F.min("release_date").alias("release_date"))
    covers = F.add_months("month", -1)
    before = F.lag(covers).over(Window.partitionBy("series_key").orderBy("month"))
    months = first.withColumn("from_month", F.coalesce(F.add_months(before, 1), covers)).withColumn("observation_month", F.explode(F.expr("sequence(from_month, add_months(month, -1), interval 1 month)")))
    seen = present.select("series_key", F.trunc("observation_date", "month").alias("observation_month"), F.lit(True).alias("observed")).distinct()
    return months.join(seen, ["series_key", "observation_month"], "left").select("series_key", F.date_format("observation_month", "yyyy-MM").alias("observation_period"), "release_date", F.coalesce("observed", F.lit(False)).alias("observed"))


def first_appearance(vintages: DataFrame) -> DataFrame:
    """The first vintage in which each observation had a value."""
    return vintages.where(F.col("value").isNotNull()).groupBy("series_key", "observation_date").agg(F.min("vintage_date").alias("first_vintage"))


def weekly_schedule(weeks: DataFrame, vendor: DataFrame, official: DataFrame | None = None) -> DataFrame:
    """Release date of each week: an official one, else the first vendor week within VENDOR_LAG_DAYS, else the next Thursday."""
    rows = as_of(weeks, vendor, ["series_key"], "observation_date", "vendor_week", ["vendor_date"], forward=True)
    lag = F.datediff("vendor_week", "observation_date")
    found = F.when(lag <= VENDOR_LAG_DAYS, F.col("vendor_date"))
    if official is not None:
        rows = rows.join(official.select("series_key", "observation_date", "official_date"), ["series_key", "observation_date"], "left")
    own = F.col("official_date") if official is not None else F.lit(None).cast("date")
    source = F.when(own.isNotNull(), "official").when(found.isNotNull(), "vendor").otherwise("inferred")
    return rows.select("series_key", "observation_date", F.coalesce(own, found, thursday_after(F.col("observation_date"))).alias("release_date"), source.alias("release_source"))


def availability(calendar: DataFrame, now: Column, supported_from: str) -> DataFrame:
    """Status of each scheduled release, and its delay in seconds where it was observed."""
    observed = F.col("observed_at").isNotNull()
    delay = F.unix_timestamp("observed_at") - F.unix_timestamp("scheduled_at")
    late = now > F.col("scheduled_at") + F.expr(f"interval {GRACE_HOURS} hours")
    status = F.when(observed, "observed_available").when(F.col("scheduled_at") < F.lit(supported_from).cast("timestamp"), "schedule_only_unsupported_history").when(late, "late_missing_observation").otherwise("scheduled_provisional")
    return calendar.withColumns({"availability_status": status, "delay_vs_schedule_seconds": F.when(observed, delay), "is_schedule_based_only": ~observed})


def latest_releases(calendar: DataFrame) -> DataFrame:
    return keep_last(calendar.withColumn("effective_at", F.coalesce("observed_at", "scheduled_at")), ["series_key"], ["effective_at", "observation_period"])


def latest_effective(calendar: DataFrame, now: Column) -> DataFrame:
    """The latest effective time that isn't in the future, else the latest of all."""
    at = F.coalesce("observed_at", "scheduled_at")
    return calendar.agg(F.coalesce(F.max(F.when(at <= now, at)), F.max(at)).alias("latest_effective_at"))


def calendar_rules(now: Column) -> dict[str, tuple[tuple[str, ...], Column]]:
    """What each rule of a release calendar reads, and the condition of a row that breaks it. Columns may hold texts or typed values."""
    times = ("scheduled_at", "released_at", "observed_at", "ingested_at")
    at = {c: instant(F.col(c)) for c in times}
    text = {c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in ("series_key", "observation_period", "zone", "availability_status", "availability_source", "is_schedule_based_only")}
    token = F.lower(text["is_schedule_based_only"])
    schedule_only = F.when(token.isin("true", "1"), True).when(token.isin("false", "0"), False)
    observed, status, delay = at["observed_at"].isNotNull(), text["availability_status"], number(F.col("delay_vs_schedule_seconds"))
    due = F.rint((F.unix_micros(at["observed_at"]) - F.unix_micros(at["scheduled_at"])) / 1e6)
    flag, late = ("observed_at", "is_schedule_based_only"), ("observed_at", "delay_vs_schedule_seconds")
    rules = {f"empty_{c}": ((c,), text[c] == "") for c in ("series_key", "observation_period", "zone", "availability_status", "availability_source")}
    rules |= {f"invalid_{c}": ((c,), at[c].isNull()) for c in ("scheduled_at", "released_at", "ingested_at")}
    rules |= {f"invalid_{c}": ((c,), day(F.col(c)).isNull()) for c in ("observation_date", "release_date_local")}
    return rules | {
        "invalid_observed_at": (("observed_at",), F.col("observed_at").isNotNull() & ~observed),
        "invalid_is_schedule_based_only": (("is_schedule_based_only",), schedule_only.isNull()),
        "invalid_delay": (("delay_vs_schedule_seconds",), F.col("delay_vs_schedule_seconds").isNotNull() & delay.isNull()),
        "released_is_not_scheduled": (("released_at", "scheduled_at"), at["released_at"] != at["scheduled_at"]),
        "unknown_status": (("availability_status",), ~status.isin("", *AVAILABILITY)),
        "observed_but_schedule_only": (flag, observed & schedule_only),
        "neither_observed_nor_schedule_only": (flag, ~observed & ~schedule_only),
        "observed_status": (("observed_at", "availability_status"), observed & (status != AVAILABILITY[0])),
        "delay_value": ((*late, "scheduled_at"), observed & at["scheduled_at"].isNotNull() & (delay.isNull() | (F.rint(delay) != due))),
        "delay_on_schedule_only": (late, ~observed & delay.isNotNull()),
        "observed_in_future": (("observed_at",), at["observed_at"] > now),
    }


def calendar_violations(calendar: DataFrame, now: Column | None = None, allow_empty: bool = False) -> DataFrame:
    """(rule, n): every broken rule of a release calendar with the number of rows that break it.

    Blank and null texts are empty. A column that is not there is reported as missing_<column>, and the rules that read it are left
    out. duplicate_key counts all rows of a repeated key. All rules but that one are counted in one pass.
    """
    rules = calendar_rules(F.current_timestamp() if now is None else now)
    wanted = sorted({c for needs, _ in rules.values() for c in needs})
    missing = [c for c in wanted if c not in calendar.columns]
    conditions = {name: broken for name, (needs, broken) in rules.items() if not set(needs) & set(missing)}
    empty = F.lit(0) if allow_empty else (F.count("*") == 0).cast("int")
    named = {"empty_calendar": empty.cast("long"), **{f"missing_{c}": F.lit(1).cast("long") for c in missing}, **{r: F.count_if(c) for r, c in conditions.items()}}
    counts = calendar.agg(F.count("*").alias("_rows"), *(c.alias(r) for r, c in named.items()))
    each = counts.select(F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).alias("n")) for r in named))).alias("x")).select("x.*")
    if not {"series_key", "observation_period"} & set(missing):
        doubled = calendar.groupBy("series_key", "observation_period").count().where("count > 1").agg(F.sum("count").alias("n"))
        each = each.unionAll(doubled.select(F.lit("duplicate_key").alias("rule"), "n"))
    return each.where("n > 0")


# The series with provider, code, frequency, whether required, since when, whether optional; calendars.
SERIES = (
    ("VIX", "yfinance", "^VIX", "daily", True, "1990-01-02", False),
    ("VIX3M", "fred", "VXVCLS", "daily", True, "2007-12-04", False),
    ("VVIX", "yfinance", "^VVIX", "daily", True, "2007-01-03", False),
    ("10Y_Treasury_Yield", "fred", "DGS10", "daily", True, None, False),
    ("2Y_Treasury_Yield", "fred", "DGS2", "daily", True, None, False),
    ("High_Yield_Spread", "fred", "BAMLH0A0HYM2", "daily", True, None, False),
    ("TED_Spread", "fred", "TEDRATE", "daily", False, None, True),
    ("CPI_Headline", "fred", "CPIAUCSL", "monthly", False, None, False),
    ("CPI_Core", "fred", "CPILFESL", "monthly", False, None, False),
    ("UNRATE", "fred", "UNRATE", "monthly", True, None, False),
    ("U6RATE", "fred", "U6RATE", "monthly", False, None, False),
    ("ICSA", "fred", "ICSA", "weekly", False, None, False),
    ("CIVPART", "fred", "CIVPART", "monthly", False, None, False),
    ("WTI", "fred", "DCOILWTICO", "daily", False, None, False),
    ("Gasoline_US_Regular", "fred", "GASREGW", "weekly", False, None, False),
    ("NatGas_HenryHub", "fred", "DHHNGSP", "daily", False, None, False),
    ("DBC", "yfinance", "DBC", "daily", False, None, False),
)
CALENDARS = {
    "CPI_Headline": "bls_cpi_release_calendar_v1", "CPI_Core": "bls_cpi_release_calendar_v1", "UNRATE": "bls_unrate_release_calendar_v1",
    "U6RATE": "bls_unrate_release_calendar_v1", "CIVPART": "bls_unrate_release_calendar_v1", "ICSA": "fred_icsa_release_calendar_v2",
}


def series_catalog(specs: DataFrame) -> DataFrame:
    """Catalog rows of series specs (series_key, source_provider, source_code, frequency, required_by_default, required_from_date, optional,
    staleness_max_bdays): the limit of age is the series' own, else that of its frequency; the calendar goes by the key."""
    limit = F.coalesce("staleness_max_bdays", lookup({k: str(v) for k, v in STALE_AFTER.items()}, F.col("frequency")).cast("int"))
    calendar = lookup(CALENDARS, F.trim("series_key"))
    return specs.withColumns({"staleness_max_bdays": limit, "release_calendar_source": calendar})


def known_series(spark: SparkSession) -> DataFrame:
    """SERIES as specs."""
    schema = "series_key string, source_provider string, source_code string, frequency string, required_by_default boolean, required_from_date string, optional boolean"
    rows = spark.createDataFrame(list(SERIES), schema)
    return rows.withColumns({"required_from_date": F.col("required_from_date").cast("date"), "staleness_max_bdays": F.lit(None).cast("int")})


def with_overrides(schedule: DataFrame, overrides: DataFrame, source: str) -> DataFrame:
    """Release dates of a schedule (observation_period, scheduled, observed, source) corrected by overrides (observation_period, release_date).

    An override takes the place of the scheduled date, and of an observed one that is there; the row then names the override's source.
    Overrides have one row a period.
    """
    own = overrides.select("observation_period", F.col("release_date").alias("_date"))
    out = schedule.join(own, "observation_period", "left")
    given = F.col("_date").isNotNull()
    observed = F.when(given & F.col("observed").isNotNull(), F.col("_date")).otherwise(F.col("observed"))
    return out.withColumns({"scheduled": F.coalesce("_date", "scheduled"), "observed": observed, "source": F.when(given, source).otherwise(F.col("source"))}).drop("_date")
