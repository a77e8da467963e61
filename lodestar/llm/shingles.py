"""Near copies by the similarity of word shingles: SimHash trees and MinHash bands propose, exact Jaccard similarity decides.

BK-trees over fingerprints (simhash.linked) find what lies within their radius; a pair at similarity 0.8 is 10 bits of 64 apart on
average and seldom that close, so bands propose the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from .common import any_columns, components, cut
from .graph import SALTS, connected_components
from .simhash import keep_rows, linked, over_half, shingle_hashes, text_hash

#: Words of a shingle; least similarity of a link.
WIDTH, LEAST = 5, 0.8
#: Bits by which fingerprints of shingles may differ for the trees to propose a pair.
RADIUS = 4
#: Bands of MinHash values and values of a band: a pair of similarity 0.8 shares no band in 3 of 10**6 cases, one of 0.9 in 10**12.
BANDS, DEEP = 32, 5
#: Shingles hashed at once; shingles that one part of a group of candidates is meant to hold.
CHUNK, PART = 1 << 12, 1 << 16

_RNG = np.random.default_rng(11)
_MUL, _ADD = _RNG.integers(0, 2**63, (2, BANDS * DEEP)).astype(np.uint64)
_MUL = _MUL * np.uint64(2) + np.uint64(1)


def distinct(hashes: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *hashes]))


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Distinct hashes of the word shingles, rising (see simhash.shingle_hashes)."""
    return distinct(list(shingle_hashes(text, width)))


def bands(own: np.ndarray) -> list[int]:
    """One key for each band of MinHash values; none for an empty set."""
    if not len(own):
        return []
    least = np.full(BANDS * DEEP, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), CHUNK):
        x = own[at : at + CHUNK, None] * _MUL + _ADD
        least = np.minimum(least, (x ^ x >> np.uint64(32)).min(axis=0))
    data, size = least.tobytes(), 8 * DEEP
    return [xxhash.xxh64_intdigest(data[size * i : size * (i + 1)], i) for i in range(BANDS)]


def signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def links(sets: list[np.ndarray], least: float = LEAST, query: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Edges (a, b) over the indexes of sets that join all pairs of at least the similarity, exactly.

    Each set is compared with all by an inverted index. The members of one large star are joined already, so pairs within it are
    not looked for; every other pair has a member that is compared with all. query: which sets are compared with all (then there is
    no star), by default each.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets])
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), size)[np.argsort(code, kind="stable")]
    ends = np.cumsum(np.bincount(code))
    begins, at = np.r_[0, ends[:-1]], np.r_[0, np.cumsum(size)]
    star, a, b = np.zeros(n, bool), [], []
    for q in range(n) if query is None else np.flatnonzero(query):
        if star[q]:
            continue
        own = code[at[q] : at[q + 1]]
        length = ends[own] - begins[own]
        hit = np.repeat(begins[own] - np.r_[0, np.cumsum(length)[:-1]], length) + np.arange(length.sum())
        both = np.bincount(owner[hit], minlength=n)
        near = both >= least * (size + size[q] - both) - 1e-9
        if query is None and not star.any() and 4 * near.sum() >= n:
            star = near.copy()
        near[q] = False
        other = np.flatnonzero(near)
        a.append(np.full(len(other), q))
        b.append(other)
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64),) * 2


def sketches(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, text_hash, node (a hash of the set of shingles), size, fp (the fingerprint) and bands of every row."""
    schema = StructType([docs.schema["doc_id"]]).add("text_hash", "long").add("node", "long").add("size", "long").add("fp", "long").add("bands", ArrayType(LongType()))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, size, fp, keys = [], [], [], []
            for text in batch.column("text"):
                hashes = list(shingle_hashes(text.as_py(), width))
                own = distinct(hashes)
                node.append(xxhash.xxh64_intdigest(own.tobytes(), 42))
                size.append(len(own))
                fp.append(over_half(hashes))
                keys.append(bands(own))
            listed = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(k) for k in keys])], pa.int32()), signed([x for k in keys for x in k]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), signed(node), pa.array(size, pa.int64()), signed(fp), listed], names=schema.names)

    return docs.select("doc_id", "text", text_hash("text").alias("text_hash")).mapInArrow(of, schema)


def contracted(banded: DataFrame) -> DataFrame:
    """Edges (a, b) with the same components as node-first over all rows (node, band, first; first is a node of the band).

    Each node hooks to the least of its bands' firsts, and each band joins the hooks of its nodes. A large group has few hooks, so its
    edges are about one a node and not one a band of each node.
    """
    hooks = banded.groupBy("node").agg(F.min("first").alias("low"), F.collect_set("band").alias("bands"))
    hooks = cut(hooks, "hooks")
    met = cut(hooks.select("low", F.explode("bands").alias("band")).distinct(), "hooks-of-bands")
    least = met.groupBy("band").agg(F.min("low").alias("least"), F.max("low").alias("most")).where("least <> most").select("band", "least")
    return hooks.select(F.col("node").alias("a"), F.col("low").alias("b")).unionAll(met.join(least.hint("merge"), "band").select(F.col("low").alias("a"), F.col("least").alias("b")).where("a <> b").distinct())


def candidates(nodes: DataFrame) -> DataFrame:
    """node and component: distinct sets (node, fp, bands) that a tree or a band brings together, over any steps.

    A band of very many sets is dealt to SALTS tasks.
    """
    keyed = cut(nodes.select("node", F.explode(F.concat("bands", F.array(F.xxhash64(F.lit("fp"), "fp")))).alias("band")), "bands")
    shared = keyed.groupBy("band").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first <> last")
    least = shared.select("band", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = keyed.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    banded = contracted(cut(salted.join(least.hint("merge"), ["band", "salt"]).select("node", "band", "first"), "shared-bands"))
    # Sets of one fingerprint share a band of their own, so a tree's edge between two fingerprints joins one set of each.
    prints = cut(nodes.groupBy("fp").agg(F.min("node").alias("node")), "set-prints")
    near = linked(prints.select("fp"), RADIUS)
    a, b = (prints.select(F.col("fp").alias(f"fp_{c}"), F.col("node").alias(f"node_{c}")) for c in "ab")
    treed = near.join(a.hint("merge"), near["a"] == a["fp_a"]).join(b.hint("merge"), near["b"] == b["fp_b"]).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    return connected_components(banded.unionAll(treed))


def similar(docs: DataFrame, rows: DataFrame, least: float = LEAST, width: int = WIDTH) -> DataFrame:
    """node and component of the sets that are linked: similarity of at least `least`, over any steps.

    A group of candidates of at most PART shingles is one task's work. A larger one is dealt to parts. First all its sets are
    compared with one of them, its centre; then those that are not like the centre are compared with all, each part of them with
    each part of the group. So a group of copies of any size costs one comparison a set, and no pair is left out.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "size")).alias("k")
    nodes = cut(rows.groupBy("node").agg(first, F.min_by(F.struct("fp", "bands"), "text_hash").alias("s")).select("node", "k.doc_id", "k.text_hash", "k.size", "s.fp", "s.bands"), "shingle-sets")
    group = cut(candidates(nodes).withColumnRenamed("component", "of"), "candidate-sets")
    wanted = cut(nodes.join(group, "node").select("node", "of", "size", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")), "wanted-sets")
    keys = docs["doc_id"].eqNullSafe(wanted["_id"]) & (text_hash("text") == wanted["_hash"])
    large = cut(wanted.groupBy("of").agg(F.ceil(F.sum("size") / PART).cast("int").alias("parts"), F.min("node").alias("centre")).where("parts > 1"), "large-groups")
    texts = cut(docs.join(wanted.hint("merge"), keys).select("node", "of", "size", "text").dropDuplicates(["node"]).join(large, "of", "left"), "candidate-texts")
    edge = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        node, query = table.column("node").to_numpy(), table.column("query").to_numpy()
        a, b = links([shingles(t, width) for t in table.column("text").to_pylist()], least, None if query.all() else query)
        # A forest of what is linked here: edges grow with the sets and not with their pairs.
        label = components(len(node), a, b)
        moved = np.flatnonzero(label != np.arange(len(node)))
        return pa.table({"a": node[moved], "b": node[label[moved]]}, edge)

    def with_centre(key: tuple, table: pa.Table, centre: pa.Table) -> pa.Table:
        """Edges of the sets like the centre; a loop for each of the others."""
        own, node = shingles(centre.column("text")[0].as_py(), width), table.column("node").to_numpy()
        sets = (shingles(t.as_py(), width) for t in table.column("text"))
        near = np.array([(both := len(np.intersect1d(x, own, True))) >= least * (len(x) + len(own) - both) - 1e-9 for x in sets])
        return pa.table({"a": node, "b": np.where(near, int(key[2].as_py()), node)}, edge)

    members = texts.where("parts IS NOT NULL").withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    centres = members.where("node = centre").select("of", "centre", "text", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    central = cut(members.groupBy("of", "part", "centre").cogroup(centres.groupBy("of", "part", "centre")).applyInArrow(with_centre, "a long, b long"), "central-sets")
    others = cut(members.join(central.where("a = b").select(F.col("a").alias("node")), "node", "left_semi").where("node <> centre"), "other-sets")
    rest = cut(others.groupBy("of").agg(F.ceil(F.sum("size") / PART).cast("int").alias("rest")), "other-parts")
    asked = others.join(rest, "of").select("of", F.pmod(F.xxhash64("node", F.lit(1)), "rest").cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("j"), "node", "text", F.lit(True).alias("query"))
    answering = members.join(rest, "of").select("of", F.explode(F.sequence(F.lit(0), F.col("rest") - 1)).alias("i"), F.col("part").alias("j"), "node", "text", F.lit(False).alias("query"))
    small = texts.where("parts IS NULL").select("of", F.lit(0).alias("i"), F.lit(0).alias("j"), "node", "text", F.lit(True).alias("query"))
    found = small.unionAll(asked).unionAll(answering).groupBy("of", "i", "j").applyInArrow(compare, "a long, b long")
    return connected_components(cut(found.unionAll(central), "similar-sets"))


@any_columns("doc_id", "text")
def keep_one(docs: DataFrame, least: float = LEAST, width: int = WIDTH) -> DataFrame:
    """One row of docs, all columns, for each group of near copies (see keep_rows). Texts without words are copies of each other."""
    rows = cut(sketches(docs, width), "sketches")
    return keep_rows(docs, rows.select("doc_id", "text_hash", "node"), similar(docs, rows, least, width))
