"""Importance resampling towards a target distribution: hashed word n-grams through Arrow kernels, gains by bucket, Gumbel top-k."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, numbered

# What separates words (of lower-cased text), and the scale of gains, weights and scores.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SCALE = 1000
_GAP, _WORD = re.compile(GAPS.encode()), re.compile(GAPS.replace("[", "[^", 1).encode())

#: UTF-8 bytes of text that the kernels hold at a time; longer texts are cut between words.
SLICE_BYTES = 4 << 20


def pieces(text: str, n: int, size: int = SLICE_BYTES) -> Iterator[tuple[str, int]]:
    """A text cut between words into parts of about size bytes, each with how many words it repeats from the part before (n - 1 at most)."""
    raw, at, repeated = text.encode(), 0, []
    while at < len(raw):
        gap = _GAP.search(raw, at + size) if len(raw) - at > size else None
        end = gap.start() if gap else len(raw)
        part = raw[at:end]
        yield b" ".join([*repeated, part]).decode(), len(repeated)
        repeated = (repeated + _WORD.findall(part.lower()))[-(n - 1) :] if n > 1 else []
        at = end


def slices(texts: pa.Array, n: int) -> Iterator[tuple[int, pa.Array, int]]:
    """(first row, texts, repeated words) in order, of about SLICE_BYTES each; the parts of a longer text come one by one under its row."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for row, size in enumerate(sizes):
        if held + size > SLICE_BYTES and row > first:
            yield first, texts[first:row], 0
            first, held = row, 0
        if size > SLICE_BYTES:
            for part, repeated in pieces(texts[row].as_py(), n):
                yield row, pa.array([part]), repeated
            first, held = row + 1, 0
        else:
            held += size
    if first < len(texts):
        yield first, texts[first:], 0


def features(texts: pa.Array, n: int, buckets: int, repeated: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 1 to n words: the row and the bucket of each run of so many words, in order. repeated: words at the start that only begin runs.

    Words are numbered by their first occurrence; a run of k words is a pair of a numbered run of k - 1 words and a word, and is
    numbered in turn. The CRC goes on from the shorter run's, once for each distinct pair.
    """
    words = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), pattern=GAPS)
    flat, rows = pc.list_flatten(words), pc.list_parent_indices(words)
    full = pc.not_equal(pc.binary_length(flat), 0)
    encoded, rows = pc.filter(flat, full).dictionary_encode(), pc.filter(rows, full).to_numpy(zero_copy_only=False)
    word, vocabulary = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary.cast(pa.binary()).to_pylist()
    run, crc = word, [zlib.crc32(w) for w in vocabulary]
    for k in range(1, n + 1):
        if k > 1:
            paired = pa.array(run[:-1] * len(vocabulary) + word[k - 1 :]).dictionary_encode()
            crc = [zlib.crc32(b" " + vocabulary[pair % len(vocabulary)], crc[pair // len(vocabulary)]) for pair in paired.dictionary.to_pylist()]
            run = paired.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        bucket = pc.take(pa.array(np.array(crc, np.int64) % buckets), pa.array(run)).to_numpy(zero_copy_only=False)
        whole = np.arange(len(run)) >= repeated - k + 1
        if k > 1:
            whole &= rows[: len(run)] == rows[k - 1 :]
        yield rows[: len(run)][whole], bucket[whole]
        if not len(run):
            return


def bucket_counts(docs: DataFrame, n: int, buckets: int) -> DataFrame:
    """(bucket, n): features of all texts by bucket. A task adds up its own first and sends a row a bucket at most."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts, repeated in slices(batch.column(0), n):
                for _, bucket in features(texts, n, buckets, repeated):
                    total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["bucket", "n"])

    return docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = 10_000) -> np.ndarray:
    """floor(1000 * log-likelihood ratio), target to docs, of each bucket with one feature more in each. A row a bucket reaches the driver."""
    of = lambda df, name: bucket_counts(df, n, buckets).select("bucket", *(F.col("n").alias(c) if c == name else F.lit(0).alias(c) for c in ("s", "t")))
    s, t = [0] * buckets, [0] * buckets
    for row in of(docs, "s").unionAll(of(target, "t")).groupBy("bucket").agg(F.sum("s"), F.sum("t")).collect():
        s[row[0]], t[row[0]] = row[1], row[2]
    all_s, all_t = float(sum(s) + buckets), float(sum(t) + buckets)
    return np.array([math.floor(SCALE * math.log((b + 1) * all_s / ((a + 1) * all_t))) for a, b in zip(s, t, strict=True)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, n: int = 1, id_col: str = "doc_id") -> DataFrame:
    """(id, n_words, n_features, weight) of every row of docs: weight is the floored mean gain of its features, 0 without one."""
    kind = docs.schema[id_col].dataType.simpleString()
    id_type = docs.select(id_col).limit(0).toArrow().schema.field(0).type

    def weighed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(gain)
        for batch in batches:
            words, count, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for first, texts, repeated in slices(batch.column(1), n):
                for k, (rows, bucket) in enumerate(features(texts, n, len(gain), repeated), 1):
                    upto = np.concatenate([[0], np.cumsum(pc.take(table, pa.array(bucket)).to_numpy(zero_copy_only=False))])
                    ends = np.searchsorted(rows, np.arange(len(texts) + 1))  # rows stand in order: a segment each
                    at = slice(first, first + len(texts))
                    total[at] += upto[ends[1:]] - upto[ends[:-1]]
                    count[at] += np.diff(ends)
                    if k == 1:
                        words[at] += np.diff(ends)
            weight = np.where(count > 0, total // np.maximum(count, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(id_type), *map(pa.array, (words, count, weight))], [id_col, "n_words", "n_features", "weight"])

    return docs.select(id_col, "text").mapInArrow(weighed, f"`{id_col}` {kind}, n_words long, n_features long, weight long")


def gumbel(key: Column, seed: int) -> Column:
    """floor(1000 * standard Gumbel noise) of a key, from the first 32 bits of sha256(seed:key); a null key counts as an empty one."""
    h = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(seed), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = 10_000, seed: int = 2024, least_words: int = 20, percent: int = 10, id_col: str = "doc_id") -> DataFrame:
    """id, n_features, weight, score, rank of every row of docs; rank 1, 2, ... are the draw of percent of the rows with least_words words.

    Gumbel noise on log weights makes the highest scores a draw without replacement, with odds in proportion to the weights. Null and
    empty texts have no features and weight 0; rows of one id share their noise and are ranked in any order, a null id before others;
    an empty target pulls towards equal buckets, and empty docs give no rows. Other columns are ignored. Texts are never shuffled:
    tasks send counts by bucket, and rows without their text. A task holds 4 MB of text at a time, long texts in parts.

    Scores are whole numbers between two bounds (about 60 000 apart at any size: gains are logarithms, noise has 32 bits), so a
    histogram of them finds the least score drawn; only rows from there on are sorted and numbered, over all tasks.
    """
    scored = cut(weigh(docs, gains(docs, target, n, buckets), n, id_col).withColumn("score", F.col("weight") + gumbel(F.col(id_col), seed)), "scores")
    able = F.col("n_words") >= least_words
    counts = sorted(((r[0], r[1]) for r in scored.where(able).groupBy("score").count().collect()), reverse=True)
    draw = sum(c for _, c in counts) * percent // 100
    least, seen = math.inf, 0
    for score, c in counts:
        if seen >= draw:
            break
        least, seen = score, seen + c
    reached = able & (F.col("score") >= F.lit(least)) if draw else F.lit(False)
    out = [id_col, "n_features", "weight", "score"]
    place = numbered(scored.where(reached), [F.desc("score"), F.asc_nulls_first(id_col)], "place", "drawn")
    drawn = place.select(*out, F.when(F.col("place") < draw, F.col("place") + 1).alias("rank"))
    return drawn.unionAll(scored.where(~reached).select(*out, F.lit(None).cast("long").alias("rank")))
