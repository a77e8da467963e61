"""Keyed parquet tables: scans, appends, upserts and versions behind a pointer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.timeseries import keep_last


def read_table(spark: SparkSession, path: str, schema: StructType, required: bool = False) -> DataFrame:
    """The parquet table at path; if it is absent, an empty one, or an error where it is required."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not required and not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def scan_dates(df: DataFrame, date: str, start: str, end: str) -> DataFrame:
    """Distinct dates in [start, end]; the range reaches the scan."""
    return df.where(F.col(date).between(F.lit(start).cast(df.schema[date].dataType), F.lit(f"{end} 23:59:59.999999").cast("timestamp").cast(df.schema[date].dataType))).select(F.col(date).cast("date").alias("date")).distinct()


def scan_pairs(df: DataFrame, key: str, date: str, keys: DataFrame, start: str, end: str) -> DataFrame:
    """Distinct (key, date) of the wanted keys in [start, end]."""
    day = F.col(date).cast("date")
    return df.where(day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))).select(key, day.alias("date")).distinct().join(keys.select(key).distinct(), key, "left_semi")


def read_aliased(spark: SparkSession, path: str, aliases: dict[str, Sequence[str]]) -> DataFrame:
    """A CSV file whose columns go by any of several names, compared without case and punctuation; absent ones are null."""
    df = spark.read.csv(path, header=True)
    plain = lambda s: "".join(c for c in s.lower() if c.isalnum())
    have = {plain(c): c for c in df.columns}
    pick = lambda names: next((F.col(f"`{have[plain(n)]}`") for n in names if plain(n) in have), F.lit(None).cast("string"))
    return df.select(*(pick(names).alias(out) for out, names in aliases.items()))


def keyed_append(existing: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Both tables by key; new rows win over existing ones, then the last in order."""
    both = existing.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return keep_last(both, keys, ["_new", *order]).drop("_new")


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str], keep_existing: Sequence[str] = ()) -> DataFrame:
    """existing with the columns that new supplies; those of keep_existing only where existing has none. Other columns stay.

    new has one row for each key. A key of existing with several rows keeps them all.
    """
    given = [c for c in new.columns if c not in keys]
    n = new.select(*keys, *(F.col(c).alias(f"_n_{c}") for c in given), F.lit(True).alias("_given"))

    def column(c: str) -> Column:
        if c not in given:
            return F.col(c)
        return (F.coalesce(c, f"_n_{c}") if c in keep_existing else F.when(F.col("_given"), F.col(f"_n_{c}")).otherwise(F.col(c))).alias(c)

    return existing.join(n, list(keys), "full_outer").select(*keys, *(column(c) for c in existing.columns if c not in keys))


def replace_slice(existing: DataFrame, new: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """existing without the rows of the refreshed keys, and the new rows."""
    return existing.join(keys.select(*on).distinct(), list(on), "left_anti").unionByName(new, allowMissingColumns=True)


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def write_version(df: DataFrame, path: str, version: str) -> None:
    """Write a version of a table beside the others; then the pointer, as the last step, names it as the current one.

    Nothing that is being read is overwritten, and a failed write leaves the pointer as it was. A version that was written whole
    (its success marker is there) is not written again, a half-written one is; so a rerun after a crash at any point ends with the
    version whole and the pointer on it.
    """
    spark = df.sparkSession
    if not _exists(spark, f"{path}/version={version}/_SUCCESS"):
        df.write.mode("overwrite").parquet(f"{path}/version={version}")
    if version not in pointed_versions(spark, path):
        place = len(pointed_versions(spark, path))
        spark.range(1).select(F.lit(version).alias("version"), F.lit(place).alias("place")).coalesce(1).write.mode("append").parquet(f"{path}/_current")


def pointed_versions(spark: SparkSession, path: str) -> list[str]:
    """The versions that the pointer has named, in order; one row a version."""
    if not _exists(spark, f"{path}/_current"):
        return []
    return [r.version for r in spark.read.schema("version string, place int").parquet(f"{path}/_current").orderBy("place").collect()]


def read_current(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The version that the pointer names; without one an empty table of the schema, or an error where none is given."""
    versions = pointed_versions(spark, path)
    if not versions and schema is not None:
        return spark.createDataFrame([], schema)
    if not versions:
        raise ValueError(f"{path} has no current version")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{path}/version={versions[-1]}")


def replace_snapshot(df: DataFrame, path: str, version: str) -> DataFrame:
    """The whole table as df's rows: a new version behind the pointer, read back from its files."""
    write_version(df, path, version)
    return read_current(df.sparkSession, path, df.schema)


def latest_by_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))).where("_rank = 1").drop("_rank")
