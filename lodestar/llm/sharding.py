"""Weighted rendezvous hashing of record keys over shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

BUCKETS = 256


def rendezvous_shard(key: Column, weights: Sequence[float], first: int = 0) -> Column:
    """The shard, first .. first + len(weights) - 1, whose score -weight / ln(u) is largest; u in (0, 1) is a hash of shard and key.

    A shard's score depends on nothing but the key, its number and its weight: adding a shard moves rows only into it, removing
    one moves only its own rows. Equal scores go to the lower shard; null is a key like any other. A weight of 0 takes nothing.
    """
    if not any(w > 0 for w in weights):
        raise ValueError("at least one weight must be positive")
    unit = lambda i: (F.shiftrightunsigned(F.xxhash64(F.lit(i), key), 11).cast("double") + 0.5) * F.lit(2.0**-53)
    scores = [F.struct((F.lit(-float(w)) / F.log(unit(i))).alias("score"), F.lit(-i).alias("shard")) for i, w in enumerate(weights, first) if w > 0]
    return -(F.greatest(*scores) if len(scores) > 1 else scores[0])["shard"]


def assign_shards(df: DataFrame, key: str, weights: Sequence[float], shard_col: str = "shard") -> DataFrame:
    """df with the shard of each row: a projection, without a shuffle. A column named shard_col is replaced; all others stay."""
    return df.withColumn(shard_col, rendezvous_shard(F.col(key), weights).cast("int"))


def add_slots(df: DataFrame, key: str, n_shards: int, shard_col: str = "shard", slot_col: str = "slot", buckets: int = BUCKETS) -> DataFrame:
    """df with a number 0, 1, ... without gaps inside each shard. A shard outside 0 .. n_shards - 1 is an error, as is null.

    Rows are numbered in buckets of a shard and moved up by the rows in the buckets before. The bucket comes from the key and the
    row's place in its input file, so neither a shard nor a key that holds a third of the rows meets in one task. Rows and their
    places are written once, so counting and numbering see the same. Only the counts (n_shards * buckets rows) are shuffled for the
    join. Numbers follow no order that callers may rely on. Pass narrow rows: df is written and shuffled once.
    """
    outside = F.raise_error(F.concat(F.lit(f"shard outside 0 .. {n_shards - 1}: "), F.coalesce(F.col(shard_col).cast("string"), F.lit("null"))))
    checked = df.withColumn(shard_col, F.when(F.col(shard_col).between(0, n_shards - 1), F.col(shard_col)).otherwise(outside.cast(df.schema[shard_col].dataType)))
    rows = checked.withColumn("_row", F.monotonically_increasing_id())
    placed = cut(rows.withColumn("_bucket", F.pmod(F.xxhash64(key, "_row"), F.lit(buckets)).cast("int")), "placed")
    before = Window.partitionBy(shard_col).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(shard_col, "_bucket").count().select(F.col(shard_col), "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(shard_col, "_bucket").orderBy(key, "_row"))
    numbered = placed.withColumn("_inside", inside).join(counts, [shard_col, "_bucket"])
    return numbered.withColumn(slot_col, F.col("_before") + F.col("_inside") - 1).drop("_row", "_bucket", "_inside", "_before")


def write_shards(df: DataFrame, key: str, weights: Sequence[float], path: str, splits: int = 8) -> None:
    """Write whole rows in one folder per shard. Each shard is dealt to `splits` tasks by row, so a hot key is spread as well."""
    placed = assign_shards(df, key, weights).withColumn("_split", F.pmod(F.monotonically_increasing_id(), F.lit(splits)))
    placed.repartition(len(weights) * splits, "shard", "_split").drop("_split").write.partitionBy("shard").parquet(path)


def shard_documents(docs: DataFrame, n_shards: int = 40, overhead: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of all documents over equal shards.

    Null text counts as empty (size = overhead, crc32 0), a null doc_id is a key of its own, repeated rows are rows of their own,
    other columns are ignored and an empty table gives an empty result. grown_shard is the shard with one shard more.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = docs.select("doc_id", (F.octet_length(text) + overhead).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"))
    placed = assign_shards(assign_shards(narrow, "doc_id", [1.0] * n_shards), "doc_id", [1.0] * (n_shards + 1), "grown_shard")
    return add_slots(placed, "doc_id", n_shards).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
