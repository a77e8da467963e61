"""Wide statements and JSON panels as long tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import day, number


def unpivoted(wide: DataFrame, keys: Sequence[str], aliases: dict[str, Sequence[str]]) -> DataFrame:
    """(keys, metric, value): the first alias of each metric, in order of priority, that a row has a number for."""
    cells = [F.struct(F.lit(metric).alias("metric"), F.coalesce(*(number(F.col(f"`{c}`")) for c in names if c in wide.columns)).alias("value")) for metric, names in aliases.items() if set(names) & set(wide.columns)]
    return wide.select(*keys, F.explode(F.array(*cells)).alias("cell")).select(*keys, "cell.*").where(F.col("value").isNotNull())


def weights_by_sector(rows: DataFrame, key: str) -> DataFrame:
    """A fund's wide row of sector weights as (key, sector, weight); sectors without a weight go."""
    sectors = [c for c in rows.columns if c != key]
    return rows.unpivot(key, sectors, "sector", "weight").where(F.col("weight").isNotNull())


def signal_panel(runs: DataFrame) -> DataFrame:
    """Rows of the signals array of successful runs (status, result as JSON); rows without a whole key go."""
    shape = "struct<signal_date:string,strategy_family:string,universe:string,signals:array<struct<symbol:string,score:double,rank:int,percentile:double>>>"
    rows = runs.where("status = 'success'").select(F.from_json("result", shape).alias("r")).select("r.signal_date", "r.strategy_family", "r.universe", F.explode("r.signals").alias("s"))
    out = rows.select(day(F.col("signal_date")).alias("signal_date"), F.coalesce("strategy_family", F.lit("default")).alias("strategy_family"), F.coalesce("universe", F.lit("default")).alias("universe"), F.upper(F.trim("s.symbol")).alias("symbol"), "s.score", "s.rank", "s.percentile")
    return out.dropna(subset=["signal_date", "symbol"])
