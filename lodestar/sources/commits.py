"""A commit log of small JSON manifests; over it bucketed keyed tables, and bundles of tables that move as one."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .tables import keyed_append

LOG, DIGITS = "_log", 12


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share, under spark.checkpoint.dir; only a local session without one gets a local folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lodestar-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _place(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, in order; none if there is no folder."""
    fs, where = _place(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is no such file."""
    fs, where = _place(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole or not at all: beside its place first, then by a rename. A file that is there already is an error."""
    fs, where = _place(spark, path)
    _, beside = _place(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    stream = fs.create(beside, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    if fs.exists(where) or not fs.rename(beside, where):
        fs.delete(beside, False)
        raise FileExistsError(f"{path} was written by another")


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _place(spark, path)
    fs.delete(where, True)


# --- the log


def versions(spark: SparkSession, path: str) -> list[int]:
    return [int(n.removesuffix(".json")) for n in names(spark, f"{path}/{LOG}") if n.endswith(".json") and not n.startswith(".")]


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """The manifest of a version, or the last one; None of a table without a commit."""
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        return None
    return json.loads(read_text(spark, f"{path}/{LOG}/{known[-1] if version is None else version:0{DIGITS}d}.json"))


def commit(spark: SparkSession, path: str, state: dict) -> int:
    """Make state the current version. Of two writers that start from one version, the later one fails."""
    put_text(spark, f"{path}/{LOG}/{state['version']:0{DIGITS}d}.json", json.dumps(state, sort_keys=True))
    return state["version"]


def expire(spark: SparkSession, path: str, keep: int = 10) -> list[str]:
    """Drop all but the last `keep` versions, and the folders that no version left refers to: the names of these. Run it when no write
    is under way: a folder that is not committed yet is referred to by nothing."""
    known = versions(spark, path)
    for v in known[: -keep or None]:
        remove(spark, f"{path}/{LOG}/{v:0{DIGITS}d}.json")
    used = {f.split("/")[0] for v in known[-keep:] for f in manifest(spark, path, v)["folders"].values()} if keep else set()
    gone = [n for n in names(spark, f"{path}/data") if n not in used]
    for n in gone:
        remove(spark, f"{path}/data/{n}")
    return gone


# --- keyed tables in buckets


def bucket_of(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def read_bucketed(spark: SparkSession, path: str, schema: StructType | None = None, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
    """A version of a bucketed table, the last one unless told, all of it or some buckets. A table without a commit is empty, of the
    schema given, or an error."""
    state = manifest(spark, path, version)
    if state is None:
        if schema is None or version is not None:
            raise ValueError(f"{path} has no such version")
        return spark.createDataFrame([], schema)
    own = StructType.fromJson(json.loads(state["schema"]))
    folders = [f"{path}/data/{f}" for b, f in state["folders"].items() if buckets is None or int(b) in set(buckets)]
    return spark.read.schema(own).parquet(*folders) if folders else spark.createDataFrame([], own)


def append_bucketed(new: DataFrame, path: str, keys: Sequence[str], order: Sequence[str] = (), buckets: int = 256, run: str = "", number: int = 0) -> list[int]:
    """Merge rows into a keyed table, new ones over old ones: the buckets that were written anew.

    Only buckets with a key of new are read and rewritten, beside the old ones; the manifest then names the new folder of each, so a
    reader sees the table before or after, and a crash at any point leaves it as it was. A batch (run, number) that is in the log is
    not merged again. The number of buckets is fixed by the first commit; rows of a large bucket are written by several tasks.
    """
    spark = new.sparkSession
    state = manifest(spark, path) or {"version": 0, "n_buckets": buckets, "keys": list(keys), "runs": {}, "folders": {}, "schema": new.schema.json()}
    if state["runs"].get(run, -1) >= number and run:
        return []
    if state["keys"] != list(keys):
        raise ValueError(f"{path} is keyed by {state['keys']}")
    placed = new.withColumn("_bucket", bucket_of(keys, state["n_buckets"]))
    touched = sorted(r[0] for r in placed.select("_bucket").distinct().collect())  # at most n_buckets
    state["version"] += 1
    if run:
        state["runs"][run] = number
    if touched:
        old = read_bucketed(spark, path, new.schema, buckets=touched) if state["folders"] else spark.createDataFrame([], new.schema)
        merged = keyed_append(old, new, keys, order)
        name = f"{state['version']:0{DIGITS}d}-{uuid.uuid4().hex[:12]}"
        merged.withColumn("_bucket", bucket_of(keys, state["n_buckets"])).hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(f"{path}/data/{name}")
        state["schema"] = merged.schema.json()
        state["folders"] |= {str(b): f"{name}/_bucket={b}" for b in touched}
    commit(spark, path, state)
    return touched


# --- bundles


def publish(spark: SparkSession, path: str, frames: Mapping[str, DataFrame], blockers: DataFrame | None = None, label: str = "") -> list[str]:
    """Make the frames the current tables of a bundle, all at once: the blockers that held it back, none if it moved.

    With any row of blockers (blocker) nothing is written and the bundle stays as it was. The tables are written beside the current ones
    first; one manifest then names all of them, so no reader sees tables of two batches, whatever fails in between. A table that frames
    doesn't hold stays in the bundle as it is.
    """
    held = sorted(r[0] for r in blockers.select("blocker").distinct().collect()) if blockers is not None else []
    if held:
        return held
    state = manifest(spark, path) or {"version": 0, "folders": {}, "schemas": {}}
    state["version"] += 1
    state["label"] = label
    name = f"{state['version']:0{DIGITS}d}-{uuid.uuid4().hex[:12]}"
    for table, df in frames.items():
        df.write.parquet(f"{path}/data/{name}/{table}")
        state["folders"][table], state["schemas"][table] = f"{name}/{table}", df.schema.json()
    commit(spark, path, state)
    return []


def read_bundle(spark: SparkSession, path: str, version: int | None = None) -> dict[str, DataFrame]:
    """All tables of one version of a bundle, the last one unless told: one look at the log serves them all. Without one, none."""
    state = manifest(spark, path, version)
    if state is None:
        return {}
    return {t: spark.read.schema(StructType.fromJson(json.loads(state["schemas"][t]))).parquet(f"{path}/data/{f}") for t, f in state["folders"].items()}
