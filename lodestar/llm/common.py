"""Helpers that several corpus operators share."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK = 256


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir. Only a local session without one gets a folder of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lodestar-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


#: Folders that this process has written, for clear().
_WRITTEN: list[str] = []


def store(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write df to the shared folder and read it back; the frame and its folder."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def cut(df: DataFrame, name: str) -> DataFrame:
    """df from files in the shared folder: later stages start from what survives a lost executor."""
    return store(df, name)[0]


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove folders that no result reads any more."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        if path in _WRITTEN:
            _WRITTEN.remove(path)


def clear(spark: SparkSession) -> None:
    """Remove all that store(), cut() and the archives wrote in this process. Call it when the results are written or no longer needed."""
    discard(spark, *_WRITTEN)


def aside(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """docs with all columns but `used` under names that no operator has, and what gives a result its columns back.

    A result has the columns of docs first, in order; columns after them keep their names.
    """
    names = [c if c in used else f"user_column_{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), lambda out: out.toDF(*docs.columns, *out.columns[len(names) :])


def any_columns(*used: str) -> Callable:
    """A function of docs that returns rows of docs, made to take columns of any name: only those of `used` are named inside."""

    def made(f: Callable) -> Callable:
        @functools.wraps(f)
        def run(docs: DataFrame, *args, **options) -> DataFrame:
            own, back = aside(docs, *used)
            return back(f(own, *args, **options))

        return run

    return made


def crc_remainder(col: str, n: int) -> Column:
    """crc32 of the column as text, modulo n; null for null."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(n)


def hash_share(key: Column, share: float) -> Column:
    """Whether a 64-bit hash falls in a share of all hashes; fine enough for a few thousand of 10**14 rows."""
    return F.pmod(key, F.lit(1 << 52)) < F.lit(int(min(1.0, share) * (1 << 52)))


def components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node index reachable from each of n nodes over the links a[i]-b[i]."""
    label = np.arange(n)
    while True:
        la, lb = label[a], label[b]
        low, new = np.minimum(la, lb), label.copy()
        np.minimum.at(new, la, low)
        np.minimum.at(new, lb, low)
        while not np.array_equal(new[new], new):
            new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def running(values: Column, first: Column, step: Callable[[Column, Column], Column]) -> Column:
    """What step has gathered before each element of an array (exclusive prefix), as an array of the same length.

    Works in blocks of BLOCK elements, so that a long array costs BLOCK copies an element and not its own length.
    """
    grow = lambda acc, x: F.concat(acc, F.array(step(F.element_at(acc, -1), x)))
    blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(values) / BLOCK).cast("int") - 1), lambda b: F.slice(values, b * BLOCK + 1, BLOCK))
    inner = F.transform(blocks, lambda block: F.aggregate(block, F.array(first), grow))
    outer = F.aggregate(F.transform(inner, lambda p: F.element_at(p, -1)), F.array(first), grow)
    out = F.flatten(F.transform(F.arrays_zip(inner.alias("p"), F.slice(outer, 1, F.size(outer) - 1).alias("o")), lambda z: F.transform(F.slice(z["p"], 1, F.size(z["p"]) - 1), lambda v: step(z["o"], v))))
    return F.when(F.size(values) > 0, out).otherwise(F.slice(F.array(first), 1, 0))


def spans(text: Column, pattern: str, keep: Callable[[Column], Column] | None = None, match: Column | None = None) -> Column:
    """array<struct<start, end>> (code points, end exclusive) of the pattern's leftmost, non-overlapping matches.

    match is all_matches(text, pattern); given as a column of an earlier projection, it is found once. keep judges each match after
    all are found. split() gives what lies between the matches, so lengths give positions without a UDF; texts without a match are
    not split.
    """
    match = all_matches(text, pattern) if match is None else match
    gaps = F.split(text, pattern, -1)
    parts = F.transform(F.arrays_zip(F.slice(gaps, 1, F.size(match)).alias("gap"), match.alias("hit")), lambda z: F.struct(F.length(z["gap"]).alias("gap"), F.length(z["hit"]).alias("hit"), (keep(z["hit"]) if keep else F.lit(True)).alias("ok")))
    before = running(F.transform(parts, lambda p: p["gap"] + p["hit"]), F.lit(0), lambda acc, x: acc + x)
    placed = F.transform(F.arrays_zip(parts.alias("p"), before.alias("b")), lambda z: F.struct((z["b"] + z["p"]["gap"]).alias("start"), (z["b"] + z["p"]["gap"] + z["p"]["hit"]).alias("end"), z["p"]["ok"].alias("ok")))
    out = F.transform(F.filter(placed, lambda s: s["ok"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return F.when(F.size(match) > 0, out).otherwise(F.expr("cast(array() as array<struct<start:int,end:int>>)"))


def all_matches(text: Column, pattern: str, guard: Column | None = None) -> Column:
    """The text of all matches, in order; none for null. The pattern must not match an empty string. guard: whether there can be a match."""
    found = F.coalesce(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.expr("cast(array() as array<string>)"))
    return found if guard is None else F.when(guard, found).otherwise(F.expr("cast(array() as array<string>)"))


def numbered(df: DataFrame, order: list[Column], name: str, folder: str) -> DataFrame:
    """df with the column name: 0, 1, ... in the given order, null first as the order says; equal rows in any order. df is written once.

    Rows are range-partitioned, sorted and written; a row's number is its place in its file after all rows of earlier files. The
    row's place in the input is the last key of the order, so equal keys, however many, spread over tasks. Only one count a file is
    sent to every task (as many as there are shuffle partitions).
    """
    placed = df.withColumn("_tie", F.monotonically_increasing_id())
    sorted_rows = placed.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie").withColumn("_part", F.spark_partition_id())
    rows = cut(sorted_rows, folder).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    earlier = Window.orderBy("_part", "_file").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("_part", "_file").count().select("_part", "_file", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(files), ["_part", "_file"]).withColumn(name, F.col("_before") + F.col("_place")).drop("_part", "_file", "_place", "_before")
