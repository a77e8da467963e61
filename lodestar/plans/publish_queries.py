"""Registered queries of commit logs: streamed appends, observation streams, snapshots and bundles; and of what is published with them."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import casts, dates
from ..operators import audits, etf, macro, observations, publication
from ..sources import adapters as a
from ..sources import commits, layouts, tables
from ..streaming import incremental
from .gap_queries import COUNTRIES_SQL, code_sql, instrument_types
from .more_queries import OLD_NEW, _payloads
from .publication_queries import AUDIT, _plan
from .queries import SQL, query
from .universe_queries import raw, raw_sql


def _streamed(spark, sf, name):
    """A table as a stream of its files; the pattern lets the table be one file as well as a folder."""
    return spark.readStream.schema(a.table(spark, sf, name).schema).parquet(f"{sf}/{name}.parque[t]")


@query("SELECT k, seq, v, s FROM (SELECT *, 0 AS n FROM old UNION ALL SELECT *, 1 FROM new) QUALIFY row_number() OVER (PARTITION BY k ORDER BY n DESC, seq DESC) = 1", OLD_NEW)
def ss1_streamed_append(spark, sf):
    """Two streams, one after the other, into one bucketed table."""
    at = commits.scratch(spark, "ss1")
    rows = _streamed(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("seq"), F.col("o_totalprice").alias("v"), F.col("o_orderstatus").alias("s"))
    for n, part in enumerate((rows.where("seq % 3 <> 0"), rows.where("seq % 3 = 0").withColumn("v", -F.col("v")))):
        incremental.append_stream(part, f"{at}/table", f"{at}/checkpoint{n}", ["k"], ["seq"], buckets=16).awaitTermination()
    return commits.read_bucketed(spark, f"{at}/table")


ACTIONS = "SELECT DISTINCT 'p' AS provider, 'C' || o_custkey AS symbol, CASE WHEN o_orderkey % 10 = 0 THEN 'split' ELSE 'dividend' END AS action, o_orderdate::DATE AS ex_date, CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS amount, CASE WHEN o_orderkey % 10 = 0 THEN (o_custkey % 4 + 1) / 2 END AS factor FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 20 <> 1"


def _observed(spark, sf):
    """Where the payloads of orders, with each seventh cut short and so broken, went through the stream twice."""
    at = commits.scratch(spark, "ss2")
    orders = _streamed(spark, sf, "orders")
    broken = _payloads(orders.where("o_orderkey % 7 = 3")).withColumn("raw_payload", F.concat(F.lit("<html>"), "raw_payload"))
    raw_rows = _payloads(orders.where("o_orderkey % 7 <> 3")).unionAll(broken)
    for run in range(2):
        for q in incremental.observation_stream(raw_rows, observations.corporate_action_rows, ["observation_id"], at, f"{at}/checkpoint{run}", buckets=16):
            q.awaitTermination()
    return at


@query(f"{ACTIONS} AND o_orderkey % 7 <> 3")
def ss2_streamed_observations(spark, sf):
    return commits.read_bucketed(spark, f"{_observed(spark, sf)}/observations").drop("observation_id")


@query("SELECT 'C' || o_custkey AS symbol, count(DISTINCT o_orderkey) AS n FROM orders WHERE o_orderkey % 7 = 3 AND o_orderstatus <> 'P' GROUP BY ALL")
def ss2_broken_payloads(spark, sf):
    at = commits.scratch(spark, "ss2")
    rows = _streamed(spark, sf, "orders").where("o_orderkey % 7 = 3")
    broken = rows.select(F.lit("p").alias("provider"), F.concat(F.lit("C"), "o_custkey").alias("symbol"), F.when(F.col("o_orderstatus") == "P", "error").otherwise("success").alias("status"), F.concat(F.lit("<html>"), "o_orderkey").alias("raw_payload"))
    for q in incremental.observation_stream(broken, observations.corporate_action_rows, ["observation_id"], at, f"{at}/checkpoint", buckets=16):
        q.awaitTermination()
    return commits.read_bucketed(spark, f"{at}/broken").groupBy("symbol").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def sk5_snapshot(spark, sf):
    at, rows = commits.scratch(spark, "sk5"), a.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    tables.replace_snapshot(rows.drop("o_orderstatus"), at, "1")
    return tables.replace_snapshot(rows.where("o_orderstatus = 'F'").drop("o_orderstatus"), at, "2")


# --- bundles

_GATE = {
    "status": "CASE s_suppkey % 3 WHEN 0 THEN 'ready_machine_safe' WHEN 1 THEN 'needs_review' END", "review_required": "CASE WHEN s_suppkey % 4 > 0 THEN s_suppkey % 4 - 1 END", "group_conflicts": "s_suppkey % 5 - 3",
    "unresolved_groups": "CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey END", "guardrails_unmerged": "CASE WHEN s_suppkey % 6 < 5 THEN s_suppkey % 6 < 4 END",
}


@query(
    """SELECT blocker, count(*) AS n FROM (SELECT unnest([CASE WHEN status IS DISTINCT FROM 'ready_machine_safe' THEN 'publication_gate_not_ready' END, CASE WHEN review_required > 0 THEN 'heuristic_review_required' END,
 CASE WHEN group_conflicts > 0 THEN 'group_conflicts_present' END, CASE WHEN unresolved_groups > 0 THEN 'unresolved_multi_listing_entities_present' END, CASE WHEN NOT guardrails_unmerged THEN 'guardrail_pair_merged' END]) AS blocker FROM gate) WHERE blocker IS NOT NULL GROUP BY ALL""",
    raw_sql("gate", "supplier", _GATE),
)
def id14_blockers(spark, sf):
    return publication.blockers(raw(spark, sf, "supplier", _GATE)).groupBy("blocker").agg(F.count("*").alias("n"))


_COUNTED = " UNION ALL ".join(f"SELECT '{t}' AS part, count(*) AS n, count(DISTINCT entity_id) AS entities FROM ({SQL[q]}) AS {t}" for t, q in (("master", "id14_entity_master"), ("listings", "id14_entity_listings"), ("reviews", "id14_identity_reviews")))


@query(_COUNTED)
def id14_published_bundle(spark, sf):
    """A batch whose audit is safe is published; the next one has unsafe attachments, so the bundle still shows the first."""
    at, audit = commits.scratch(spark, "id14"), raw(spark, sf, "supplier", AUDIT)
    safe = F.coalesce(F.col("review_status") == publication.SAFE, F.lit(False))
    gate = lambda rows: rows.agg(F.lit(publication.READY).alias("status"), F.count_if(~safe).alias("review_required"), F.lit(0).alias("group_conflicts"), F.lit(0).alias("unresolved_groups"), F.lit(True).alias("guardrails_unmerged"))
    frames = dict(zip(("master", "listings", "reviews"), _plan(spark, sf), strict=True))
    commits.publish(spark, at, frames, publication.blockers(gate(audit.where(safe))))
    commits.publish(spark, at, {t: df.where("entity_id LIKE 'lei:%'") for t, df in frames.items()}, publication.blockers(gate(audit)))
    shown = commits.read_bundle(spark, at)
    counted = [df.agg(F.lit(t).alias("part"), F.count("*").alias("n"), F.countDistinct("entity_id").alias("entities")) for t, df in shown.items()]
    return counted[0].unionAll(counted[1]).unionAll(counted[2])


# --- promotion, releases, casts


@query(
    f"""SELECT 'L' || p_partkey AS ticker, CASE WHEN NOT m THEN 'rejected' WHEN f AND e THEN 'validated_full' ELSE 'validated_market_only' END AS promotion_status,
CASE WHEN NOT m THEN 'missing_market' WHEN f AND e THEN 'all_domains_supported' WHEN type IN ('equity', 'adr') THEN concat_ws(',', CASE WHEN NOT f THEN 'missing_fundamentals' END, CASE WHEN NOT e THEN 'missing_earnings' END)
 WHEN type = 'index_proxy' THEN 'market_supported_index_proxy' ELSE 'market_supported' END AS reasons
FROM (SELECT p_partkey, type, p_partkey % 7 <> 0 AS m, p_partkey % 3 <> 0 AS f, p_partkey % 2 = 0 AS e FROM ({SQL["sc32_instrument_types"]}) AS typed)"""
)
def rg5_promotion_status(spark, sf):
    k = F.col("p_partkey")
    typed = instrument_types(spark, sf).select(F.concat(F.lit("L"), k).alias("ticker"), F.col("type").alias("instrument_type"), (k % 7 != 0).alias("market"), (k % 3 != 0).alias("fundamentals"), (k % 2 == 0).alias("earnings"))
    return audits.promotion_status(typed)


TIMED = ("click", "purchase", "view")


@query(
    """, r AS (SELECT series_key, observation_date, value, seq, scheduled_at, observed_at, day(observation_date) % 4 <> 0 AND series_key IN ('click', 'purchase', 'view') AS timed FROM obs)
SELECT series_key, observation_date, value, CASE WHEN timed THEN scheduled_at END AS scheduled_at, CASE WHEN timed THEN observed_at END AS observed_at, CASE WHEN timed THEN 'America/New_York' END AS zone,
 CASE WHEN timed THEN CASE WHEN observed_at IS NULL THEN 'scheduled_provisional' ELSE 'observed_available' END END AS availability_status, CASE WHEN timed THEN date_diff('second', scheduled_at, observed_at) END AS delay_vs_schedule_seconds, CASE WHEN timed THEN observed_at IS NULL END AS is_schedule_based_only FROM r""",
    a.MACRO,
)
def ma2_attached_releases(spark, sf):
    """Each release stands twice in the calendar, an outdated row first; every fourth day is absent from it."""
    series = a.macro_series(spark, sf)
    late = F.col("observed_at").isNull()
    last = series.where("day(observation_date) % 4 <> 0").select(
        F.concat(F.lit(" "), "series_key").alias("series_key"), F.date_format("observation_date", "yyyy-MM-dd").alias("observation_period"), "scheduled_at", "observed_at", "zone", F.when(late, "scheduled_provisional").otherwise("observed_available").alias("availability_status"),
        F.timestamp_diff("SECOND", "scheduled_at", "observed_at").alias("delay_vs_schedule_seconds"), late.alias("is_schedule_based_only"), F.col("seq"),
    )
    outdated = last.withColumns({"observed_at": F.lit(None).cast("timestamp"), "availability_status": F.lit("outdated"), "seq": F.col("seq") - 1})
    found = macro.attach_releases(macro.observations(series), outdated.unionAll(last), TIMED)
    return found.select("series_key", "observation_date", "value", "scheduled_at", "observed_at", "zone", "availability_status", "delay_vs_schedule_seconds", "is_schedule_based_only")


@query(
    """SELECT o_orderkey, o_clerk IS NOT NULL AS named, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN NULL ELSE NULL END AS told, (o_orderdate::DATE + TIME '08:30:00') AT TIME ZONE 'America/New_York' AT TIME ZONE 'UTC' AS released_at FROM (SELECT *, o_orderpriority AS o_clerk FROM orders)"""
)
def sc15_release_times(spark, sf):
    """Local release times as UTC, the first column there is of several names (PF3) and a flag in three states (SC9)."""
    o = a.table(spark, sf, "orders").withColumn("named", F.col("o_orderpriority"))
    flag = F.when(F.col("o_orderstatus") == "F", " Yes").when(F.col("o_orderstatus") == "O", "maybe")
    return o.select("o_orderkey", casts.first_present(o, "o_clerk", "named", "o_orderpriority").isNotNull().alias("named"), casts.tri_state(flag).alias("told"), dates.local_time_utc(F.col("o_orderdate").cast("date")).alias("released_at"))


# --- holdings files of three layouts

_P = "substr(holding_symbol, 2)::BIGINT"


@query(
    f"""SELECT etf_ticker, sym AS holding_symbol, name AS holding_name, country AS holding_country, round(CASE WHEN layout = 1 OR s > 1.35 OR m > 1 THEN w / 100 ELSE w END, 6) AS weight, day AS as_of
FROM (SELECT *, sum(w) OVER (PARTITION BY etf_ticker) AS s, max(w) OVER (PARTITION BY etf_ticker) AS m,
  CASE WHEN given = 'US' AND sym LIKE '%.L' THEN 'GB' WHEN given = '' THEN CASE WHEN sym LIKE '%.L' THEN 'GB' ELSE 'US' END ELSE given END AS country
 FROM (SELECT etf_ticker, layout, CASE WHEN p % 10 = 0 THEN 'P' || p || '.L' ELSE 'P' || p END AS sym, 'Part, ' || p AS name, CASE layout WHEN 2 THEN round(weight, 6) ELSE round(weight * 100, 4) END AS w,
   CASE layout WHEN 0 THEN DATE '2024-01-31' WHEN 1 THEN as_of ELSE DATE '2024-02-02' END AS day, CASE WHEN layout = 1 THEN '' ELSE {code_sql("place")} END AS given
  FROM (SELECT *, {_P} AS p, (substr(etf_ticker, 2)::BIGINT % 3)::INT AS layout, CASE {_P} % 4 WHEN 0 THEN 'Germany' WHEN 1 THEN 'USA' WHEN 2 THEN 'jp' ELSE '' END AS place FROM holdings)
  WHERE p % 11 <> 0 AND p % 12 <> 5 AND p % 13 <> 0 AND (layout = 1 OR p % 17 <> 0)))""",
    a.HOLDINGS, COUNTRIES_SQL,
)
def et1_holdings_of_files(spark, sf):
    """Funds' holdings written in three layouts, one file a fund, with cash and derivatives among them, and read back in one scan."""
    at, p = commits.scratch(spark, "holdings"), F.substring("holding_symbol", 2, 20).cast("long")
    held = a.holdings(spark, sf).withColumns({"p": p, "layout": F.substring("etf_ticker", 2, 20).cast("long") % 3})
    held = held.withColumns({
        "sym": F.when(F.col("p") % 11 == 0, "CASH").when(F.col("p") % 12 == 5, "usd").when(F.col("p") % 10 == 0, F.concat("holding_symbol", F.lit(".L"))).otherwise(F.lower("holding_symbol")),
        "name": F.when(F.col("p") % 13 == 0, "E-mini future").otherwise(F.concat(F.lit("Part, "), "p")), "kind": F.when(F.col("p") % 17 == 0, "Bond").otherwise("Equity"),
        "place": F.when(F.col("p") % 4 == 0, "Germany").when(F.col("p") % 4 == 1, "USA").when(F.col("p") % 4 == 2, "jp").otherwise(""), "pct": F.format_string("%.4f", F.round(F.col("weight") * 100, 4)), "share": F.format_string("%.6f", F.round("weight", 6)),
    })
    quoted = F.concat(F.lit('"'), "name", F.lit('"'))
    line = F.when(F.col("layout") == 0, F.concat_ws(",", "sym", quoted, "pct", "kind", "place")).when(F.col("layout") == 1, F.concat_ws(",", F.date_format("as_of", "yyyy-MM-dd"), quoted, F.concat("pct", F.lit("%")), "sym")).otherwise(F.concat_ws(",", "place", "kind", "share", "sym", quoted))
    heads = F.when(F.col("layout") == 0, F.array(F.lit("Some fund"), F.lit("Fund holdings as of 01/31/2024"), F.lit("Ticker,Name,Weight (%),Asset Class,Location"))).when(F.col("layout") == 1, F.array(F.lit('Date,"Security Name","% of Net Assets","Holding Ticker"'))).otherwise(F.array(F.lit("Country / Region,Security Type,Weight,Identifier,Description")))
    first = F.row_number().over(Window.partitionBy("etf_ticker").orderBy("holding_symbol")) == 1
    text = held.select("etf_ticker", "holding_symbol", F.when(first, F.concat_ws("\n", heads, line)).otherwise(line).alias("value")).sortWithinPartitions("etf_ticker", "holding_symbol")
    text.select("etf_ticker", "value").write.partitionBy("etf_ticker").text(at)
    rows = layouts.read_layouts(spark, f"{at}/*")
    fund = F.substring_index(F.substring_index("file", "/etf_ticker=", -1), "/", 1)
    rows = rows.select(fund.alias("etf_ticker"), "symbol", "name", "weight", "asset_class", "country", layouts.any_day(F.col("as_of")).alias("as_of"), "stated", "seq")
    return etf.normalised_holdings(rows, F.lit("2024-02-02").cast("date"))
