"""Benchmark decontamination by Wu-Manber multi-pattern search over words."""

from __future__ import annotations

import bisect
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import any_columns, cut

#: Words in a window; bytes of memory that the matcher of one block of the benchmark may take in a Python worker, which holds one at a time;
#: bytes it takes for each word, at most (tests measure them).
WINDOW, BLOCK_BYTES, WORD_BYTES = 10, 128 << 20, 600

_ASCII = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Runs of a-z, 0-9 and characters outside ASCII, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_ASCII).split()


class WuManber:
    """Finds all occurrences of patterns of one length of words; patterns are places in one array of word numbers.

    The block is the last two words of a window (one for patterns of one word). shift tells how far the window may move when a
    block is seen; where that is nowhere, the block's bucket lists the patterns that end with it by their first word, and comparing
    the words confirms an occurrence.
    """

    def __init__(self, length: int, flat: np.ndarray, runs: list[tuple[int, int, int]], known: int):
        """runs: first and last place (exclusive) of windows that follow each other, and their item."""
        starts = np.concatenate([np.arange(a, z, dtype=np.int32) for a, z, _ in runs])
        owner = np.concatenate([np.full(z - a, i, np.int32) for a, z, i in runs])
        self.length, self.block, self.known = length, min(2, length), known
        self.far = length - self.block + 1
        view = np.lib.stride_tricks.sliding_window_view(flat, length)[starts]
        # By block, then word after word, so that equal windows lie together.
        order = np.lexsort((owner, *(view[:, i] for i in range(length - 1, -1, -1)), *(view[:, i] for i in range(length - self.block, length))))
        view, owner = view[order], owner[order]
        new = np.r_[True, (view[1:] != view[:-1]).any(axis=1)] if len(view) else np.zeros(0, bool)
        pair = np.r_[True, new[1:] | (owner[1:] != owner[:-1])] if len(view) else new
        at = np.flatnonzero(new)
        self.start, self.first = starts[order][at], view[at, 0].tolist()
        self.items = owner[pair]
        self.item_ends = np.r_[np.cumsum(pair)[at] - 1, len(self.items)]
        del view
        key = lambda end: flat[end - 1].astype(np.int64) * known + flat[end] if self.block == 2 else flat[end].astype(np.int64)
        # The least distance of a block to the end of a window: nought from the first window's end on, more before it.
        places = np.concatenate([np.arange(a + self.block - 1, z + length - 1, dtype=np.int32) for a, z, _ in runs])
        steps = np.concatenate([np.maximum(0, length - 1 - np.arange(self.block - 1, z - a + length - 1, dtype=np.int32)) for a, z, _ in runs])
        keys = key(places)
        by = np.lexsort((steps, keys))
        unique, where = np.unique(keys[by], return_index=True)
        least = steps[by][where].astype(np.int64)
        del keys, by, places, steps
        # Where that is nought, the bucket's number, as -1, -2, ...
        bucket, begin = np.unique(key(self.start + length - 1), return_index=True)
        by_begin = np.sort(begin)
        self.bucket = np.r_[by_begin, len(at)].tolist()
        least[np.searchsorted(unique, bucket)] = -1 - np.searchsorted(by_begin, begin)
        self.shift = dict(zip(unique.tolist(), least.tolist(), strict=True))
        self.flat = flat

    def search(self, text: list[int]) -> Iterator[tuple[int, np.ndarray]]:
        """(start, numbers of items) of each occurrence, by start. text: word numbers, known for words of no pattern."""
        shift, far, length, known, n = self.shift.get, self.far, self.length, self.known, len(text)
        at, pair = length - 1, self.block == 2
        while at < n:
            b = text[at]
            step = far if b == known or (pair and text[at - 1] == known) else shift(text[at - 1] * known + b if pair else b, far)
            if step > 0:
                at += step
                continue
            start, low, high = at - length + 1, self.bucket[-1 - step], self.bucket[-step]
            low = bisect.bisect_left(self.first, text[start], low, high)
            high = bisect.bisect_right(self.first, text[start], low, high)
            if low < high:
                own = text[start : at + 1]
                # Windows of a bucket with one first word are in order of their words.
                i = low + bisect.bisect_left(range(low, high), own, key=lambda i: self.flat[self.start[i] : self.start[i] + length].tolist())
                if i < high and self.flat[self.start[i] : self.start[i] + length].tolist() == own:
                    yield start, self.items[self.item_ends[i] : self.item_ends[i + 1]]
            at += 1


class Matcher:
    """All windows of a block of (item id, text): every `window` consecutive words, or all words of a shorter item."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.ids = sorted({item for item, _ in items})
        number, vocabulary, flat = {x: i for i, x in enumerate(self.ids)}, {}, []
        places: dict[int, list[tuple[int, int, int]]] = {}
        for item, text in items:
            own = words(text)
            length = min(window, len(own))
            if own:
                places.setdefault(length, []).append((len(flat), len(flat) + len(own) - length + 1, number[item]))
            flat += [vocabulary.setdefault(w, len(vocabulary)) for w in own]
        self.vocabulary, self.known = vocabulary, len(vocabulary)
        numbers = np.array(flat, np.int32)
        del flat
        self.found_by = [WuManber(length, numbers, own, self.known) for length, own in sorted(places.items())]

    def occurrences(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges hit (merged, in order) and the items with occurring windows."""
        hits, items = [], set()
        if self.found_by:
            get, known = self.vocabulary.get, self.known
            numbers = [get(w, known) for w in text]
            for m in self.found_by:
                for start, own in m.search(numbers):
                    hits.append((start, start + m.length))
                    items.update(own.tolist())
        return merged(hits), {self.ids[i] for i in items}


#: The matcher of the block that this worker searched last.
_HELD: dict = {}


def held_matcher(key: str, items: list[tuple[str, str]], window: int) -> Matcher:
    if (key, window) not in _HELD:
        _HELD.clear()
        _HELD[key, window] = Matcher(items, window)
    return _HELD[key, window]


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def benchmark_blocks(benchmark: DataFrame, block_bytes: int, window: int = WINDOW) -> tuple[int, Callable[[int], list[tuple[str, str]]]]:
    """The number of blocks of the benchmark, and block i: (item id as text, words), whose matcher takes at most block_bytes.

    Longer items are cut to pieces that share window - 1 words, so no window is lost. Pieces are dealt to blocks by hash; there are
    more blocks until none is too large.
    """
    block_words = max(64 * window, block_bytes // WORD_BYTES)
    most = block_words // 16

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, text in zip(batch.column("item_id"), batch.column("text"), strict=True):
                own = words(text.as_py())
                for at in range(0, max(1, len(own) - window + 1), max(1, most - window + 1)):
                    part = own[at : at + most]
                    if part:
                        out.append((item.as_py(), b" ".join(part).decode("utf-8", "surrogatepass"), len(part)))
            ids, texts, n = zip(*out, strict=True) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.string()), pa.array(n, pa.int64())], names=["item_id", "text", "n"])

    known = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(F.col("item_id").cast("string").alias("item_id"), "text")
    pieces = cut(known.mapInArrow(cut_up, "item_id string, text string, n long").distinct(), "benchmark-pieces")
    n = -(-(pieces.agg(F.sum("n")).first()[0] or 0) // block_words)
    by = lambda: F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    while n > 1 and (pieces.groupBy(by().alias("b")).agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0) > block_words:
        n = n + 1 + n // 2
    return n, lambda i: [tuple(r) for r in pieces.where(by() == i).select("item_id", "text").collect()]


_SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])
_FOUND = StructType([StructField("n_words", LongType()), StructField("hits", ArrayType(_SPAN)), StructField("items", ArrayType(StringType()))])
_ARROW = (pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.list_(pa.string()))


def search_block(docs: DataFrame, block: list[tuple[str, str]], window: int, all_rows: bool) -> DataFrame:
    """docs with n_words, hits and items of one block; all rows, or those with a hit."""
    sent, name = docs.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = held_matcher(name, sent.value, window)
        for batch in batches:
            rows, own = [], []
            for i, text in enumerate(batch.column("text")):
                text = words(text.as_py())
                hits, items = matcher.occurrences(text)
                if all_rows or hits:
                    own.append(i)
                    rows.append((len(text), [{"start": a, "end": b} for a, b in hits], sorted(items)))
            found = list(zip(*rows, strict=True)) or [[]] * 3
            kept = batch if len(own) == len(batch) else batch.take(pa.array(own, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, *(pa.array(v, t) for v, t in zip(found, _ARROW, strict=True))], names=[*batch.schema.names, *_FOUND.names])

    return docs.mapInArrow(search, StructType([*docs.schema.fields, *_FOUND.fields]))


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs with n_words, hits (array of word ranges: start, end) and items (sorted array of item ids as strings).

    A benchmark whose matcher takes at most block_bytes (WORD_BYTES bytes a word) is one block: the matcher is built once in each
    worker, and docs go by it in one pass. A larger one has more blocks: docs are written once with a row number, each block is
    a pass of its own over them, so a worker never holds two, and the passes' hits are put together by row. Null text has no words;
    items with null id, null text or no word have no windows; an empty benchmark hits nothing. Columns of docs stay, but for those
    with the names added.
    """
    kept = docs.select(*(c for c in docs.columns if c not in _FOUND.names))
    n, block = benchmark_blocks(benchmark, block_bytes, window)
    if n < 2:
        return search_block(kept, block(0) if n else [], window, True)
    numbered = cut(kept.withColumn("_lodestar_row", F.monotonically_increasing_id()), "numbered")
    passes = [search_block(numbered.select("_lodestar_row", "text"), block(i), window, i == 0).drop("text") for i in range(n)]
    each = cut(reduce(DataFrame.unionAll, passes), "block-hits")
    gathered = each.groupBy("_lodestar_row").agg(F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    joined = lambda out, h: F.when((F.size(out) > 0) & (h["start"] <= F.element_at(out, -1)["end"]), F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(F.element_at(out, -1)["start"].alias("start"), F.greatest(F.element_at(out, -1)["end"], h["end"]).alias("end"))))).otherwise(F.concat(out, F.array(h)))
    gathered = gathered.withColumn("hits", F.aggregate("hits", F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)"), joined))
    return numbered.join(gathered, "_lodestar_row").select(*kept.columns, *_FOUND.names)


def n_hit() -> Column:
    return F.aggregate("hits", F.lit(0).cast("long"), lambda acc, h: acc + h["end"] - h["start"])


def items_digest() -> Column:
    return F.sha2(F.concat_ws(",", "items").cast("binary"), 256)


@any_columns("text")
def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs without any word inside an occurrence of a benchmark window; all columns."""
    return find_contamination(docs, benchmark).where(F.size("hits") == 0).select(docs.columns)


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row."""
    found = find_contamination(docs.select("doc_id", "text"), benchmark)
    return found.select("doc_id", "n_words", n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"), items_digest().alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))
