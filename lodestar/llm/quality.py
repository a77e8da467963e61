"""Quality scores by a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import hash_share

#: Buckets of hashed words, bins of a statistic, factors of a feature, labelled rows that a model is fitted on at most.
WORDS, BINS, FACTORS, FIT_ROWS = 1 << 14, 12, 8, 6000
EPOCHS, RATE, DECAY, SEED = 8, 0.05, 1e-5, 7

_NOT_WORD = re.compile(r"[^\w\s]+")
#: Statistics by name; each is cut to BINS equal bins of its range.
STATISTICS = ("upper", "digits", "marks", "spaces", "bars", "marked words", "word length", "repeated words", "repeated lines", "line length", "log words", "log n_chars")
SIZE = WORDS + BINS * len(STATISTICS) + 1


def statistics(text: str, words: list[str], counts: Counter, n_chars: int | None) -> list[float]:
    """Values from 0 to 1, in the order of STATISTICS. n_chars is the table's own column; null is 0."""
    n, m, lines = max(1, len(text)), max(1, len(words)), text.split("\n")
    marks = _NOT_WORD.findall(text)
    return [
        sum(map(str.isupper, words)) / m,
        sum(w.isdigit() for w in words) / m,
        min(1.0, 4 * sum(map(len, marks)) / n),
        min(1.0, 2 * len(words) / n),
        counts["|"] / m,
        sum(len(x) > 1 for x in marks) / m if len(marks) < m else 1.0,
        min(1.0, sum(map(len, words)) / m / 16),
        1 - len(counts) / m,
        1 - len(set(lines)) / len(lines),
        min(1.0, m / len(lines) / 100),
        min(1.0, np.log1p(len(words)) / 12),
        min(1.0, np.log1p(max(0, n_chars or 0)) / 14),
    ]


def features(text: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Indexes and values: one bin of each statistic (1), and the hashed words by log count, of length 1 together."""
    text = text or ""
    words = text.split()
    counts = Counter(words)
    stats = statistics(text, words, counts, n_chars)
    bins = [WORDS + BINS * i + min(BINS - 1, int(s * BINS)) for i, s in enumerate(stats)]
    hashed = np.fromiter((zlib.crc32(w.lower().encode("utf-8", "surrogatepass")) % WORDS for w in counts), np.int64, len(counts))
    value = np.log1p(np.fromiter(counts.values(), float, len(counts)))
    return np.concatenate([hashed, bins, [SIZE - 1]]), np.concatenate([value / max(1e-12, np.sqrt((value**2).sum())), np.ones(len(bins) + 1)])


class Machine:
    """w0 + sum w x + 1/2 sum_f ((sum v x)^2 - sum v^2 x^2), through the logistic function."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.bias, self.w, self.v = 0.0, np.zeros(SIZE), rng.normal(0, 0.01, (SIZE, FACTORS))

    def raw(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sums of rows that lie one after another, each from its start; also the factors' sums and each feature's v x."""
        vx = self.v[index] * value[:, None]
        sums = np.add.reduceat(vx, starts)
        pair = (sums**2 - np.add.reduceat(vx**2, starts)).sum(axis=1) / 2
        return self.bias + np.add.reduceat(self.w[index] * value, starts) + pair, sums, vx

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        if not rows:
            return np.zeros(0)
        starts = np.cumsum([0, *(len(i) for i, _ in rows[:-1])])
        z = self.raw(np.concatenate([i for i, _ in rows]), np.concatenate([x for _, x in rows]), starts)[0]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, batch: int = 64) -> Machine:
        """Adagrad on the logistic loss. One label only gives that label's smoothed share; no row leaves a score of 0.5."""
        if len(labels):
            share = (labels.sum() + 0.5) / (len(labels) + 1)
            self.bias = float(np.log(share / (1 - share)))
        if len(set(labels.tolist())) < 2:
            return self
        rng, gw, gv = np.random.default_rng(SEED), np.full(SIZE, 1e-8), np.full((SIZE, FACTORS), 1e-8)
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), batch):
                own = [rows[i] for i in order[at : at + batch]]
                sizes = np.array([len(i) for i, _ in own])
                index, value = np.concatenate([i for i, _ in own]), np.concatenate([x for _, x in own])
                z, sums, vx = self.raw(index, value, np.cumsum(np.r_[0, sizes[:-1]]))
                error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels[order[at : at + batch]]) / len(own)
                each = np.repeat(error, sizes) * value
                unique, where = np.unique(index, return_inverse=True)
                dw = np.bincount(where, each, len(unique)) + DECAY * self.w[unique]
                dv = np.zeros((len(unique), FACTORS))
                np.add.at(dv, where, each[:, None] * (np.repeat(sums, sizes, axis=0) - vx))
                dv += DECAY * self.v[unique]
                gw[unique] += dw**2
                gv[unique] += dv**2
                self.w[unique] -= rate * dw / np.sqrt(gw[unique])
                self.v[unique] -= rate * dv / np.sqrt(gv[unique])
                self.bias -= rate * error.sum()
        return self


def labelled(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> DataFrame:
    """label, text, n_chars of at most about `most` labelled rows: all, or those with the smallest hashes of their id.

    The share is taken from the number of distinct labels, so the sample is bounded at any size. An id that stands on several rows
    gives one, that of the smallest hash of its text and n_chars, so neither copies of an id nor labels that repeat outweigh others;
    ids with both labels teach both. Labels other than 0 and 1 and null ids are left out.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "quality").distinct()
    by = F.xxhash64("doc_id")
    picked = known.where(hash_share(by, most / max(1, known.count()))).orderBy(by, "doc_id", "quality").limit(2 * most)
    found = docs.join(F.broadcast(picked.select("doc_id").distinct()), "doc_id", "left_semi").select("doc_id", "text", "n_chars")
    one = found.groupBy("doc_id").agg(F.min_by(F.struct("text", "n_chars"), F.struct(F.xxhash64("text", "n_chars"), "text", "n_chars")).alias("row"))
    return one.join(F.broadcast(picked), "doc_id").select("doc_id", F.col("quality").cast("double").alias("label"), "row.text", "row.n_chars")


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> Machine:
    """A machine fitted on a bounded sample of labelled rows (see labelled). Features are made in tasks; the driver gets only them."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t.as_py(), n.as_py()) for t, n in zip(batch.column("text"), batch.column("n_chars"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.string()), batch.column("label"), pa.array([i.astype(np.int32).tobytes() for i, _ in rows], pa.binary()), pa.array([v.astype(np.float32).tobytes() for _, v in rows], pa.binary())], names=["doc_id", "label", "i", "v"])

    schema = StructType([StructField("doc_id", StringType()), StructField("label", DoubleType())])
    rows = sorted(map(tuple, labelled(docs, labels, most).mapInArrow(made, schema.add("i", "binary").add("v", "binary")).collect()))
    return Machine().fit([(np.frombuffer(i, np.int32).astype(np.int64), np.frombuffer(v, np.float32).astype(float)) for _, _, i, v in rows], np.array([r[1] for r in rows]))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """All columns of docs and quality_score, 0 to 1; null text scores as empty. A column of that name is replaced.

    Inputs are text and n_chars alone.
    """
    kept = docs.select(*(c for c in docs.columns if c != "quality_score"))
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, n = batch.column("text"), batch.column("n_chars")
            out = [sent.value.scores([features(text[i].as_py(), n[i].as_py()) for i in range(a, min(a + 64, len(batch)))]) for a in range(0, len(batch), 64)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([np.zeros(0), *out]))], names=[*batch.schema.names, "quality_score"])

    return kept.mapInArrow(of, StructType([*kept.schema.fields, StructField("quality_score", DoubleType())]))
