"""Language identification by rank-order n-gram profiles."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

#: N-grams in a profile, and the most distinct n-grams a task holds before it passes its counts on.
PROFILE, HELD = 400, 1 << 20
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(sys.maxunicode + 1)])


def ngrams(text: str | None) -> np.ndarray:
    """Codes of all 1-, 2- and 3-grams of lower-cased words, a word's ends counting as a blank (0); n-grams of blanks only are left out.

    A code holds up to three code points of 21 bits each, so different n-grams have different codes.
    """
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    c = np.concatenate([[0], np.where(letters()[c], c, 0), [0]])
    c = c[np.r_[True, (c[1:] != 0) | (c[:-1] != 0)]]
    one, two, three = c[c != 0], c[:-1] << 21 | c[1:], (c[:-2] << 42 | c[1:-1] << 21 | c[2:])[c[1:-1] != 0]
    return np.concatenate([one, two + (1 << 62), three]) if len(one) else one


def ranked(codes: np.ndarray, k: int) -> np.ndarray:
    """The k most frequent codes, most frequent first; ties go to the smaller code."""
    code, n = np.unique(codes, return_counts=True)
    return code[np.lexsort((code, -n))][:k]


class Profiles:
    """Rank lists of languages, and out-of-place distances to them."""

    def __init__(self, lists: dict[str, list[int]], k: int):
        self.names, self.k = sorted(lists), k
        self.codes = np.unique(np.concatenate([np.array(lists[x], np.int64) for x in self.names])) if lists else np.zeros(0, np.int64)
        self.rank = np.full((len(self.codes), len(self.names)), -1)
        for j, x in enumerate(self.names):
            self.rank[np.searchsorted(self.codes, np.array(lists[x], np.int64)), j] = np.arange(len(lists[x]))

    def nearest(self, text: str | None) -> tuple[str, float]:
        """The nearest language (ties: first by name) and 1 less its distance over the largest possible one."""
        own = ranked(ngrams(text), self.k)
        if not len(own) or not self.names or not len(self.codes):
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        rank = np.where((self.codes[at] == own)[:, None], self.rank[at], -1)
        place = np.arange(len(own))[:, None]
        distance = np.where(rank >= 0, np.minimum(np.abs(rank - place), self.k), self.k).sum(axis=0)
        best = int(distance.argmin())
        return self.names[best], float(1 - distance[best] / (self.k * len(own)))


def learn(docs: DataFrame, k: int = PROFILE, lang_col: str = "lang") -> Profiles:
    """Profiles from all rows with text and a language: n-grams are counted in tasks, summed by key, and the k first of each language kept.

    What reaches the driver is k numbers for each language. Null text or language teaches nothing.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def fold(parts: list) -> list:
            codes, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            unique, inverse = np.unique(codes, return_inverse=True)
            return [(unique, np.bincount(inverse, n, len(unique)).astype(np.int64))]

        def flush() -> pa.RecordBatch:
            rows = [(lang, *fold(parts)[0]) for lang, parts in held.items()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([x for lang, c, _ in rows for x in [lang] * len(c)], pa.string()), *(pa.array(np.concatenate([r[i] for r in rows]) if rows else [], pa.int64()) for i in (1, 2))], names=["lang", "code", "n"])

        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                parts = held.setdefault(lang.as_py(), [])
                parts.append(np.unique(ngrams(text.as_py()), return_counts=True))
                if sum(len(p[0]) for p in parts[1:]) > HELD // 4:
                    parts[:] = fold(parts)
                    if sum(len(p[0]) for x in held.values() for p in x) > HELD:
                        yield flush()
        if held:
            yield flush()

    known = docs.where(F.col("text").isNotNull() & F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), "text")
    sums = known.mapInArrow(counted, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    top = sums.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))).where(F.col("rank") <= k)
    lists: dict[str, dict[int, int]] = {}
    for lang, code, rank in top.select("lang", "code", "rank").collect():
        lists.setdefault(lang, {})[rank] = code
    return Profiles({lang: [own[r] for r in sorted(own)] for lang, own in lists.items()}, k)


def predict(docs: DataFrame, profiles: Profiles, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All columns of docs, the language and its score. Null text, text without a letter, or no profile at all give `und` and 0.

    Columns of these names are replaced.
    """
    kept = docs.select(*(c for c in docs.columns if c not in names))
    sent = docs.sparkSession.sparkContext.broadcast(profiles)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.nearest(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], names=[*batch.schema.names, *names])

    return kept.mapInArrow(of, StructType([*kept.schema.fields, StructField(names[0], StringType()), StructField(names[1], DoubleType())]))
