"""Bucketed tables, streams into them and bundles: crashes, restarts, wiped checkpoints, blockers."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from lodestar.operators import observations, timeseries
from lodestar.sources import commits
from lodestar.streaming import incremental

SCHEMA = "k string, v double"


def keys(spark, path, **kw):
    return sorted(r.k for r in commits.read_bucketed(spark, path, **kw).collect())


@pytest.mark.parametrize("crash", ["half the data", "no commit", "after the commit", "no crash"])
def test_streamed_append_survives_crashes_and_new_checkpoints(spark, tmp_path, monkeypatch, crash):
    source, path = f"file://{tmp_path}/in", f"file://{tmp_path}/t"
    put = lambda k: spark.createDataFrame([(k, 1.0)], SCHEMA).coalesce(1).write.mode("append").parquet(source)

    def run(checkpoint):
        incremental.append_stream(spark.readStream.schema(SCHEMA).parquet(source), path, f"file://{tmp_path}/{checkpoint}", ["k"], buckets=4).awaitTermination()

    put("a")
    run("one")
    put("b")
    real = commits.commit
    if crash != "no crash":

        def broken(session, where, state):
            if crash == "half the data":
                data = tmp_path / "t" / "data"
                folder = max(os.listdir(data))
                shutil.rmtree(data / folder)
                (data / folder).mkdir()
            if crash == "after the commit":
                real(session, where, state)
            raise RuntimeError("crash")

        monkeypatch.setattr(commits, "commit", broken)
        with pytest.raises(Exception, match="crash"):
            run("one")
        assert keys(spark, path) == (["a", "b"] if crash == "after the commit" else ["a"])
        monkeypatch.setattr(commits, "commit", real)
    run("one")
    assert keys(spark, path) == ["a", "b"] and len(commits.versions(spark, path)) == 2
    put("c")
    run("two")
    assert keys(spark, path) == ["a", "b", "c"]


def test_a_wiped_checkpoint_at_the_same_path_loses_no_row(spark, tmp_path):
    source, path, checkpoint = (f"file://{tmp_path}/{x}" for x in ("in", "t", "c"))
    for k in "ab":
        spark.createDataFrame([(k, 1.0)], SCHEMA).coalesce(1).write.mode("overwrite").parquet(source)
        incremental.append_stream(spark.readStream.schema(SCHEMA).parquet(source), path, checkpoint, ["k"]).awaitTermination()
        shutil.rmtree(tmp_path / "c")
    assert keys(spark, path) == ["a", "b"]


def test_a_batch_of_one_key_writes_one_bucket_and_old_versions_go(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    first = spark.range(5000).select(F.col("id").cast("string").alias("k"), F.lit(0.0).alias("v"))
    assert len(commits.append_bucketed(first, path, ["k"])) == 256
    before = commits.manifest(spark, path)["folders"]
    written = commits.append_bucketed(spark.createDataFrame([("7", 1.0)], SCHEMA), path, ["k"])
    now = commits.manifest(spark, path)["folders"]
    assert len(written) == 1 and [b for b in now if now[b] != before[b]] == [str(written[0])]
    assert os.listdir(tmp_path / "t" / "data" / now[str(written[0])].split("/")[0]) != [] and keys(spark, path) == sorted(map(str, range(5000)))
    assert commits.read_bucketed(spark, path).agg(F.sum("v")).first()[0] == 1.0 and commits.read_bucketed(spark, path, version=1).agg(F.sum("v")).first()[0] == 0.0
    assert commits.append_bucketed(first.limit(0), path, ["k"], run="r", number=3) == []
    assert commits.append_bucketed(first, path, ["k"], run="r", number=3) == [] and commits.versions(spark, path) == [1, 2, 3]
    commits.append_bucketed(first, path, ["k"])
    assert len(commits.expire(spark, path, keep=1)) == 2 and commits.versions(spark, path) == [4]
    assert keys(spark, path) == sorted(map(str, range(5000)))
    with pytest.raises(ValueError, match="no such version"):
        commits.read_bucketed(spark, path, version=1)
    with pytest.raises(ValueError, match="keyed by"):
        commits.append_bucketed(first, path, ["v"])


def test_two_writers_from_one_version(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    commits.append_bucketed(spark.createDataFrame([("a", 1.0)], SCHEMA), path, ["k"])
    with pytest.raises(FileExistsError):
        commits.commit(spark, path, {"version": 1, "folders": {}})
    assert keys(spark, path) == ["a"] and all(not n.startswith(".") or n.endswith(".crc") for n in os.listdir(tmp_path / "t" / commits.LOG))


RAW = "provider string, symbol string, status string, raw_payload string"
PAYLOADS = [
    [("p", "A", "success", '[{"exDate": "2024-01-02", "amount": 1.5}, {"exDate": "2024-01-02", "amount": 1.5}]'), ("p", "B", "error", '[{"exDate": "2024-01-02"}]')],
    [("p", "A", "success", '{"data": [{"date": "2024-01-02", "amount": "1.5"}]}'), ("p", "C", "success", '{"exDate": "2024-02-01", "ratio": "4:1"}'), ("p", "D", "success", "<html>oops")],
    [("p", "D", "success", "<html>oops"), ("p", "E", "success", None), ("p", "C", "success", '{"exDate": "1999-02-01", "amount": 2}'), ("p", "F", "success", "[]")],
]


def test_payloads_through_the_stream_equal_the_batch(spark, tmp_path):
    source, path, checkpoint = (f"file://{tmp_path}/{x}" for x in ("in", "t", "c"))
    for part in PAYLOADS:  # a restart for each part, with repeats and an old date among them
        spark.createDataFrame(part, RAW).coalesce(1).write.mode("append").parquet(source)
        for q in incremental.observation_stream(spark.readStream.schema(RAW).parquet(source), observations.corporate_action_rows, ["observation_id"], path, checkpoint, buckets=4):
            q.awaitTermination()
    batch = observations.corporate_actions(spark.createDataFrame([r for part in PAYLOADS for r in part], RAW))
    plain = lambda df: sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())
    assert plain(commits.read_bucketed(spark, f"{path}/observations").fillna(-1.0)) == plain(batch.fillna(-1.0)) and batch.count() == 3
    assert sorted((r.symbol, r.raw_payload) for r in commits.read_bucketed(spark, f"{path}/broken").collect()) == [("D", "<html>oops"), ("E", None)]


def test_filings_through_the_stream_equal_the_batch(spark, tmp_path):
    source, path, checkpoint = (f"file://{tmp_path}/{x}" for x in ("in", "t", "c"))
    payload = lambda *a: '{"filings": {"recent": {"accessionNumber": [%s], "form": ["8-K"], "filingDate": ["2024-03-01", "2024-03-02"]}}}' % ", ".join(f'"{x}"' for x in a)
    rows = [("s", "A", "success", payload("1", "2")), ("s", "B", "success", payload("3")), ("s", "A", "success", payload("1", "2", "4")), ("s", "B", "success", payload("3"))]
    for part in (rows[:1], rows[1:3], rows[3:]):
        spark.createDataFrame(part, RAW).coalesce(1).write.mode("append").parquet(source)
        for q in incremental.observation_stream(spark.readStream.schema(RAW).parquet(source), observations.filings, ["symbol", "accession"], path, checkpoint, buckets=4):
            q.awaitTermination()
    got = sorted(map(str, commits.read_bucketed(spark, f"{path}/observations").collect()))
    assert got == sorted(map(str, observations.filings(spark.createDataFrame(rows, RAW)).distinct().collect())) and len(got) == 4


def test_bundles_move_as_one_and_only_without_blockers(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/b"
    frames = lambda n: {t: spark.createDataFrame([(n,)], "batch int") for t in ("master", "listings", "reviews")}
    shown = lambda **kw: {t: df.first()[0] for t, df in commits.read_bundle(spark, path, **kw).items()}
    none, some = (spark.createDataFrame(x, "blocker string") for x in ([], [("group_conflicts_present",), ("guardrail_pair_merged",)]))
    assert commits.read_bundle(spark, path) == {} and commits.publish(spark, path, frames(1), none) == []
    held = commits.read_bundle(spark, path)  # a reader that looked before the next batch
    assert commits.publish(spark, path, frames(2), some) == ["group_conflicts_present", "guardrail_pair_merged"]
    assert shown() == dict.fromkeys(("master", "listings", "reviews"), 1) and len(os.listdir(tmp_path / "b" / "data")) == 1

    def broken(*_):
        raise RuntimeError("crash")

    with monkeypatch.context() as m, pytest.raises(RuntimeError, match="crash"):
        m.setattr(commits, "commit", broken)
        commits.publish(spark, path, frames(3), none)
    assert set(shown().values()) == {1}
    assert commits.publish(spark, path, frames(4)) == [] and commits.publish(spark, path, {"reviews": frames(5)["reviews"]}) == []
    assert shown() == {"master": 4, "listings": 4, "reviews": 5} and {df.first()[0] for df in held.values()} == {1} and set(shown(version=1).values()) == {1}
    commits.expire(spark, path, keep=1)
    assert shown() == {"master": 4, "listings": 4, "reviews": 5}


@pytest.mark.parametrize("forward", [False, True])
def test_as_of_over_buckets_equals_one_bucket(spark, forward):
    day = F.expr("date_add(date'2023-01-01', cast(pmod(xxhash64(id), 900) as int))")
    null = lambda c, n: F.when(F.col("id") % n != 0, c)
    left = spark.range(600).select("id", F.lit("hot").alias("k"), null(day, 97).alias("at"))
    points = spark.range(1000, 1060).select(F.lit("hot").alias("k"), null(day, 41).alias("p"), F.col("id").alias("v"), (F.col("id") % 3).alias("o"))
    out = [sorted(map(str, timeseries.as_of(left, points, ["k"], "at", "p", ["v"], ["o", "v"], forward, days).collect())) for days in (7, 100_000)]
    assert out[0] == out[1] and len(out[0]) == 600
    joined = timeseries.as_of(left, points, ["k"], "at", "p", ["v"], [], forward, 7)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "_bucket" in plan
