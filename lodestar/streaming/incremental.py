"""Incremental appends and observation jobs with Structured Streaming."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.observations import broken_payloads
from ..sources.commits import append_bucketed, put_text, read_text


def deduplicated(stream: DataFrame, keys: Sequence[str], at: str, delay: str) -> DataFrame:
    """A stream without repeats of a key that come within the watermark's delay; the state is bounded by it."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(keys))


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of the run that a checkpoint folder holds, drawn once and kept in the folder: a wiped folder is another run."""
    at = f"{checkpoint}/_run"
    if read_text(spark, at) is None:
        put_text(spark, at, uuid.uuid4().hex)
    return read_text(spark, at)


def append_stream(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: Sequence[str] = (), transform: Callable[[DataFrame], DataFrame] | None = None, buckets: int = 256) -> StreamingQuery:
    """Merge each micro-batch into the bucketed keyed table at path, one commit a batch that rewrites the buckets it touches.

    transform is the same function that a batch job uses. The log holds the last batch of each run, a run being what one checkpoint
    folder has seen: a batch that runs again after a crash is merged once, and a new or wiped checkpoint, which numbers its batches from
    0 again, is a run of its own whose rows are all merged by key. One stream at a time may write a table; a second one fails.
    """
    run = run_of(stream.sparkSession, checkpoint)

    def merge(batch: DataFrame, number: int) -> None:
        append_bucketed(transform(batch) if transform else batch, path, keys, order, buckets, run, number)

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(merge).start()


def observation_stream(raw: DataFrame, rows_of: Callable[[DataFrame], DataFrame], keys: Sequence[str], path: str, checkpoint: str, delay: str = "1 day", buckets: int = 256) -> tuple[StreamingQuery, StreamingQuery]:
    """Payloads (provider, symbol, status, raw_payload) as observations at path/observations; broken ones at path/broken, by their digest.

    rows_of is the parsing step of the batch job and gives the keys (a content id). Repeats that arrive within delay are dropped by the
    stream's state, which holds no older keys; the watermark follows arrival and not the payloads' own times, so that no payload is
    too late; what is repeated later than that is merged by key. So the table is that of the batch job, however payloads are split,
    repeated or delayed.
    """
    arriving = lambda df, ids: deduplicated(df.withColumn("_arrived", F.current_timestamp()), ids, "_arrived", delay).drop("_arrived")
    good = append_stream(arriving(rows_of(raw), keys), f"{path}/observations", f"{checkpoint}/observations", keys, buckets=buckets)
    bad = append_stream(arriving(broken_payloads(raw), ["payload_id"]), f"{path}/broken", f"{checkpoint}/broken", ["payload_id"], buckets=buckets)
    return good, bad
