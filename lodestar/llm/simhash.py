"""SimHash fingerprints and near-duplicate components by BK-trees."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import any_columns, components, cut
from .graph import connected_components

#: Shingles whose bits are counted at once; fingerprints of a shard tree at most; queries that go down a tree at once.
CHUNK, TREE, QUERIES = 1 << 16, 1024, 4096
#: Fingerprints that a shard is meant to hold when they are spread evenly.
SHARD = 64


def shingle_hashes(text: str | None, width: int) -> Iterator[np.ndarray]:
    """XXH64 of the word shingles, repeats included, at most CHUNK at once. A-Z count as a-z; words are split at ASCII white space.

    A shorter text is one shingle, one without words has none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    joined, starts = b" ".join(words), list(accumulate((len(w) + 1 for w in words), initial=0))
    width = min(width, len(words))
    for at in range(0, len(words) - width + 1, CHUNK):
        ends = starts[at + width : at + width + CHUNK]
        yield np.array([xxhash.xxh64_intdigest(joined[a : z - 1], 42) for a, z in zip(starts[at:], ends)], "<u8")  # noqa: B905


def over_half(hashes: Iterable[np.ndarray]) -> int:
    """64 bits: 1 where over half of all hashes have 1."""
    n, ones = 0, np.zeros(64, np.int64)
    for part in hashes:
        n += len(part)
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprint(text: str | None, width: int = 4) -> int:
    return over_half(shingle_hashes(text, width))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """The id, fp, the fingerprint as a signed long, and text_hash. Null and empty texts have fingerprint 0."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), width) for t in batch.column(text_col)], "u8")
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(fps.view(np.int64)), batch.column("text_hash")], names=[id_col, "fp", "text_hash"])

    schema = StructType([docs.schema[id_col], StructField("fp", LongType()), StructField("text_hash", LongType())])
    return docs.select(id_col, text_col, text_hash(text_col).alias("text_hash")).mapInArrow(of, schema)


def text_hash(text_col: str = "text") -> Column:
    return F.xxhash64(F.coalesce(text_col, F.lit("")))


def grow(fp: np.ndarray, tree: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """BK-trees over distinct fingerprints, one for each value of tree (rising): the root of each node, and children by key.

    A child's key is parent * 65 + its Hamming distance to the parent; a parent has one child for each distance. All nodes go down
    one level at a time: the first that takes a free place stays there, the others compare with it next.
    """
    first = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]]) if len(tree) else np.zeros(0, np.int64)
    root = np.repeat(first, np.diff(np.r_[first, len(tree)]))
    at, moving = root.copy(), np.setdiff1d(np.arange(len(fp)), first)
    keys, nodes = [], []
    while len(moving):
        place = at[moving] * 65 + np.bitwise_count(fp[moving] ^ fp[at[moving]])
        taken, where, inverse = np.unique(place, return_index=True, return_inverse=True)
        keys.append(taken)
        nodes.append(moving[where])
        at[moving] = moving[where][inverse]
        moving = np.delete(moving, where)
    key, node = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, nodes))
    by = np.argsort(key)
    return root, key[by], node[by]


def search(fp: np.ndarray, key: np.ndarray, child: np.ndarray, query: np.ndarray, start: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, node) within the radius. query: indexes of fp; start: where each begins. Only edges within the radius of the distance are followed."""
    found = []
    for a in range(0, len(query), QUERIES):
        q, node = query[a : a + QUERIES], start[a : a + QUERIES]
        while len(q):
            d = np.bitwise_count(fp[q] ^ fp[node]).astype(np.int64)
            near = (d <= radius) & (q != node)
            found.append((q[near], node[near]))
            low = np.searchsorted(key, node * 65 + np.maximum(d - radius, 1))
            n = np.searchsorted(key, node * 65 + np.minimum(d + radius, 64), "right") - low
            q, node = np.repeat(q, n), child[np.repeat(low - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())]
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


def plan_blocks(n: int, radius: int, shard: int = SHARD) -> int:
    """Blocks to cut 64 bits into. Fingerprints within the radius agree on all but `radius` blocks; more blocks mean longer keys and smaller shards, and more keys."""
    for blocks in range(radius + 1, 2 * radius):
        if n <= shard * 2 ** (64 * (blocks - radius) // blocks):
            return blocks
    return 2 * radius


def shard_keys(fp: Column, blocks: int, radius: int) -> list[Column]:
    """One key for each choice of blocks - radius blocks: the choice's number and those blocks' bits."""
    ends = [64 * i // blocks for i in range(blocks + 1)]
    block = [F.shiftrightunsigned(fp, ends[i]).bitwiseAND(F.lit((1 << ends[i + 1] - ends[i]) - 1)) for i in range(blocks)]
    return [F.xxhash64(F.lit(i), *(block[j] for j in own)) for i, own in enumerate(combinations(range(blocks), blocks - radius))]


def linked(fps: DataFrame, radius: int = 4) -> DataFrame:
    """Edges (a, b) of a forest that joins all distinct fingerprints (one column fp) at most `radius` bits apart.

    Fingerprints are dealt to shards by agreeing blocks. A shard of over TREE fingerprints is dealt to parts, and each pair of its
    parts is a task's work: a BK-tree of the first part is sent to the second one's queries. Each task returns, for each
    fingerprint, one edge to the smallest it is joined with there, so edges grow with the fingerprints and not with the pairs.
    """
    keys = shard_keys(F.col("fp"), plan_blocks(fps.count(), radius), radius)
    keyed = fps.select("fp", F.explode(F.array(*keys)).alias("shard"))
    large = cut(keyed.groupBy("shard").count().where(F.col("count") > TREE).select("shard", F.ceil(F.col("count") / TREE).cast("int").alias("parts")), "large-shards")
    parts = F.coalesce(F.col("parts"), F.lit(1))
    own = F.pmod(F.xxhash64("fp"), parts).cast("int")
    dealt = keyed.join(large, "shard", "left").select("fp", "shard", own.alias("own"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
    dealt = dealt.select("fp", "shard", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") <= F.col("other")).alias("tree"))
    n = max(1, int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def edges(batch: pa.Table) -> pa.RecordBatch:
        fp = batch.column("fp").to_numpy().view(np.uint64)
        shard, i, j, tree = (batch.column(c).to_numpy() for c in ("shard", "i", "j", "tree"))
        group = np.r_[0, np.cumsum((shard[1:] != shard[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))]
        first = np.flatnonzero(tree)
        root, key, child = grow(fp[first], group[first])
        # Queries are the second part, or all where a shard is one part; nodes are numbered within the trees.
        at = np.full(int(group[-1]) + 1, -1)
        at[group[first]] = root
        query = np.flatnonzero((~tree | (i == j)) & (at[group] >= 0))
        place = np.full(len(fp), -1)
        place[first] = np.arange(len(first))
        values = np.r_[fp[first], fp[query[place[query] < 0]]]
        place[query[place[query] < 0]] = np.arange(len(first), len(values))
        a, b = search(values, key, child, place[query], at[group[query]], radius)
        label = components(len(values), a, b)
        moved = np.flatnonzero(label != np.arange(len(values)))
        return pa.RecordBatch.from_arrays([pa.array(values[x].view(np.int64)) for x in (moved, label[moved])], names=["a", "b"])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole (shard, i, j) groups of the sorted rows: a batch's last group waits for the next batch."""
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])])
            last = [table.column(c)[-1].as_py() for c in ("shard", "i", "j")] if len(table) else None
            if last is None:
                continue
            ends = np.flatnonzero(np.logical_or.reduce([table.column(c).to_numpy() != x for c, x in zip(("shard", "i", "j"), last, strict=True)]))
            whole = int(ends[-1]) + 1 if len(ends) else 0
            if whole:
                yield edges(table.slice(0, whole).combine_chunks())
            kept = table.slice(whole)
        if kept is not None and len(kept):
            yield edges(kept.combine_chunks())

    return dealt.repartition(n, "shard", "i", "j").sortWithinPartitions("shard", "i", "j", "fp").mapInArrow(shards, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = 4, width: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable over links, for every row.

    Rows whose fingerprints differ in at most `radius` bits are linked; equal fingerprints are one node, so copies make no pairs.
    Null and empty texts share fingerprint 0. A null doc_id is never a component_id unless its component has no other. Repeated
    rows stay; other columns are ignored; an empty table gives no rows.
    """
    fps = cut(fingerprints(docs, width=width), "fingerprints")
    nodes, joined = fingerprint_components(fps, radius)
    members = cut(nodes.join(joined, "fp"), "members")
    least = cut(members.groupBy("root").agg(F.min("least").alias("component_id")), "least-ids")
    found = members.join(least, "root").select("fp", "component_id")
    known = cut(nodes.join(found, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id")), "component-ids")
    return fps.join(known, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def fingerprint_components(fps: DataFrame, radius: int) -> tuple[DataFrame, DataFrame]:
    """Distinct fingerprints with their least doc_id, and fp and root of those that are linked."""
    nodes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    return nodes, connected_components(linked(nodes.select("fp"), radius)).withColumnsRenamed({"node": "fp", "component": "root"})


@any_columns("doc_id", "text")
def keep_one(docs: DataFrame, radius: int = 4, width: int = 4) -> DataFrame:
    """One row of docs, all columns, for each component of near_duplicates (see keep_rows)."""
    fps = cut(fingerprints(docs, width=width), "fingerprints")
    joined = fingerprint_components(fps, radius)[1]
    return keep_rows(docs, fps.withColumnRenamed("fp", "node"), joined.select(F.col("fp").alias("node"), F.col("root").alias("component")))


def keep_rows(docs: DataFrame, rows: DataFrame, joined: DataFrame) -> DataFrame:
    """One row of docs for each component: that of the smallest doc_id (no id comes last), then of the smallest text hash.

    rows: doc_id, text_hash and node of every row; joined: node and component of the linked nodes, any other is a component of its
    own. Rows are known by id and text hash, so an id may stand on different texts. Rows alike in both give one, chosen by a hash.
    """
    first = lambda key: F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "n")).alias(key)
    known = rows.groupBy("doc_id", "text_hash", "node").agg(F.count("*").alias("n"))
    nodes = cut(known.groupBy("node").agg(first("k")).select("node", "k.doc_id", "k.text_hash", "k.n"), "node-rows")
    placed = nodes.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    kept = cut(placed.groupBy("component").agg(first("k")).select(F.col("k.doc_id").alias("_id"), F.col("k.text_hash").alias("_hash"), F.col("k.n").alias("_n")), "kept-rows")
    found = docs.join(kept, docs["doc_id"].eqNullSafe(kept["_id"]) & (text_hash("text") == kept["_hash"]))
    hashed = [f.name for f in docs.schema if "map<" not in f.dataType.simpleString()]
    one = found.where("_n > 1").groupBy("_id", "_hash").agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*hashed)).alias("row")).select("row.*")
    return found.where("_n = 1").select(docs.columns).unionByName(one)
