"""Packing of token sequences by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import cut
from .tokens import encoder

#: Windows that one group of tails is meant to fill; lengths cut off the end of a longer tail, whose small pieces even out the sums.
GROUP_WINDOWS, GRAINS = 128, (96, 32)
#: Pieces of fewer tokens are packed in bundles of at most so many, so that a group has at most two bundles for every BUNDLE tokens.
BUNDLE = 32


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """k lists of indexes of sizes with near-equal sums: the two partial partitions of widest spread are merged, largest with smallest.

    A partial partition is its sums, falling and less the smallest, and for each sum one piece that stands for its set (-1: none).
    """
    n = len(sizes)
    parent = np.arange(n)
    sums, stands = np.zeros((n, k), np.int64), np.full((n, k), -1)
    sums[:, 0], stands[:, 0] = sizes, np.arange(n)
    heap = [(-s, i, sums[i], stands[i]) for i, s in enumerate(sizes)] if k > 1 else []
    if k == 1:
        return [list(range(n))]
    heapq.heapify(heap)
    for order in range(n, 2 * n - 1):
        _, _, a, own = heapq.heappop(heap)
        _, _, b, other = heapq.heappop(heap)
        total, other = a + b[::-1], other[::-1]
        both = (own >= 0) & (other >= 0)
        parent[other[both]] = own[both]
        by = np.argsort(-total, kind="stable")
        total = total[by]
        heapq.heappush(heap, (int(total[-1] - total[0]), order, total - total[-1], np.where(own >= 0, own, other)[by]))
    while not np.array_equal(parent[parent], parent):
        parent = parent[parent]
    slot = {int(x): i for i, x in enumerate(heap[0][3] if heap else ()) if x >= 0}
    out: list[list[int]] = [[] for _ in range(k)]
    for i in range(n):
        out[slot[int(parent[i])]].append(i)
    return out


def bundles(sizes: list[int], most: int = BUNDLE) -> list[list[int]]:
    """Indexes of sizes in bundles: sizes of at least `most` alone, smaller ones together, in order, up to `most`."""
    out, own, total = [], [], 0
    for i, s in enumerate(sizes):
        if s >= most:
            out.append([i])
            continue
        if total + s > most:
            out.append(own)
            own, total = [], 0
        own.append(i)
        total += s
    return [*out, own] if own else out


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows of at most capacity each; as few as the sum allows, one more whenever differencing exceeds the capacity."""
    if not sizes:
        return []
    if any(s > capacity for s in sizes):
        raise ValueError("a piece is larger than a window")
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        found = difference(sizes, k)
        if max(sum(sizes[i] for i in own) for own in found) <= capacity:
            return found
        k += 1


def pieces(docs: DataFrame, tokenizer: str, capacity: int, grains: tuple[int, ...] = GRAINS, end_id: int = 1) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: each document's ids and end_id, cut at multiples of the capacity.

    What is left after the last full window is one piece, or if it is longer than four times the grains, a long piece and the grains.
    """
    schema = StructType([docs.schema["doc_id"], *(StructField(c, LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens"))])

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).encode_to_numpy, np.array([end_id], np.uint32)
        for batch in batches:
            row, out = [], []
            for i, text in enumerate(batch.column("text")):
                ids = np.concatenate([encode(text.as_py() or "", allowed_special="all"), end]).astype("<u4")
                n = len(ids)
                cuts = list(range(0, n, capacity))
                if 4 * sum(grains) < n - cuts[-1] < capacity:
                    cuts += [n - sum(grains[g:]) for g in range(len(grains))]
                for a, b in zip(cuts, [*cuts[1:], n], strict=True):
                    row.append(i)
                    out.append((a, b - a, zlib.crc32(ids[a:b].tobytes()), n))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row, pa.int64())), *(pa.array(c, pa.int64()) for c in columns)], names=[f.name for f in schema])

    return docs.select("doc_id", "text").mapInArrow(cut_up, schema)


def pack(cut_pieces: DataFrame, capacity: int, group_windows: int = GROUP_WINDOWS) -> DataFrame:
    """The pieces with sequence_id and offset.

    A full piece is a sequence of its own. The others are dealt by a hash of piece and file row to groups of about group_windows
    windows, each of which one task differences, so no document or key meets in one task. Small pieces move in bundles, so a task's
    partial partitions take some 2 * tokens / BUNDLE * windows * 16 bytes (32 MB), whatever the pieces are. Sequence ids are
    unique, with gaps: full pieces have even ids, groups odd ones.
    """
    columns = cut_pieces.columns
    placed = cut_pieces.withColumn("_row", F.monotonically_increasing_id())
    full = placed.where(F.col("length") == capacity).select(*columns, (F.col("_row") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = placed.where(F.col("length") < capacity)
    groups = max(1, -(-(rest.agg(F.sum("length")).first()[0] or 0) // (capacity * group_windows)))
    schema = StructType([*cut_pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def group(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("_row", "ascending")])
        sizes = table.column("length").to_pylist()
        sequence, offset = [0] * len(sizes), [0] * len(sizes)
        together = bundles(sizes, min(BUNDLE, capacity))
        for w, own in enumerate(windows([sum(sizes[i] for i in x) for x in together], capacity)):
            at = 0
            for i in (i for x in own for i in together[x]):
                sequence[i], offset[i] = (w * groups + key[0].as_py()) * 2 + 1, at
                at += sizes[i]
        return table.select(columns).append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    dealt = rest.withColumn("_group", F.pmod(F.xxhash64("doc_id", "start", "_row"), F.lit(groups)))
    return full.unionByName(dealt.groupBy("_group").applyInArrow(group, schema))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048) -> DataFrame:
    """All documents packed into sequences of at most capacity tokens; one row per piece.

    Null text is empty and gives end_id alone; repeated rows are documents of their own; other columns are ignored; an empty
    table gives no rows. Tokens are encoded once: the pieces, without their ids, are written to the shared folder.
    """
    return pack(cut(pieces(docs, tokenizer, capacity), "pieces"), capacity)
