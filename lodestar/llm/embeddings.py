"""Near-duplicate embeddings by PCA-ordered tiled comparison."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut
from .graph import connected_components

#: Vectors in a tile, rows of a tile compared at once, dimensions after which residuals are bounded, and those with bounds of a tile.
TILE, STRIP, STEPS, BOX = 1024, 256, (8, 16, 32), 8
#: Tiles in a group at most (two groups are a task's work); larger vectors than this are not rotated.
GROUP, WIDEST = 128, 2048
#: Products within this of the threshold are decided by the cosine of the vectors as they are.
SLACK = 1e-9


def moments(df: DataFrame) -> dict[int, np.ndarray]:
    """Sum of outer products of the unit vectors (column vec) of each size, over all rows: at most 16 matrices a size reach the driver."""

    def summed(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array([m.tobytes() for m in parts.values()], pa.binary())], names=["dim", "m"])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in by_size(batch.column("vec")):
                if dim <= WIDEST:
                    x = unit(x)
                    parts[dim] = parts.get(dim, 0) + x.T @ x
        yield summed(parts)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, m in zip(*(batch.column(c).to_pylist() for c in ("dim", "m")), strict=True):
                parts[dim] = parts.get(dim, 0) + np.frombuffer(m).reshape(dim, dim)
        yield summed(parts)

    total: dict[int, np.ndarray] = {}
    for dim, m in df.select("vec").mapInArrow(made, "dim int, m binary").repartition(16).mapInArrow(added, "dim int, m binary").collect():
        total[dim] = total.get(dim, 0) + np.frombuffer(m).reshape(dim, dim)
    return total


def rotation(moment: np.ndarray) -> np.ndarray:
    """Orthogonal axes by falling share of the unit vectors' second moment. Any orthogonal matrix gives the same links; this one gives early bounds."""
    return np.linalg.eigh(moment)[1][:, ::-1]


def by_size(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, rows, vectors) for each vector size in an array of lists without nulls."""
    sizes, flat = np.diff(column.offsets.to_numpy()), column.flatten().to_numpy(zero_copy_only=False)
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        yield int(dim), rows, flat[starts[rows][:, None] + np.arange(dim)].astype(float)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of each row of x with the same row of y, of the vectors as they are."""
    dot = lambda a, b: (a * b).sum(axis=1)
    return dot(x, y) / (np.sqrt(dot(x, x)) * np.sqrt(dot(y, y)))


def strips(a: np.ndarray, b: np.ndarray, threshold: float, same: bool, raw: tuple[np.ndarray, np.ndarray] | None = None, steps: tuple[int, ...] = STEPS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Strips (rows of a, rows of b, matrix of which link) of unit vectors with cosine of at least threshold; for the same tile each pair once.

    After each step, products of the dimensions so far plus the product of the suffix norms bound the cosine. Rows and columns
    without a pair that can still reach the threshold leave the strip; a strip without pairs ends there. Whole products within SLACK
    of the threshold are replaced by the cosine of the vectors as they are (raw, where the rows of a and b are rotated).
    """
    ends = [s for s in steps if s < a.shape[1]] + [a.shape[1]]
    suffix = lambda x, e: np.sqrt(np.maximum(0, (x[:, e:] ** 2).sum(axis=1)))
    left, right = [suffix(a, e) for e in ends], [suffix(b, e) for e in ends]
    for at in range(0, len(a), STRIP):
        rows, cols = np.arange(at, min(len(a), at + STRIP)), np.arange(at if same else 0, len(b))
        total, begin = np.zeros((len(rows), len(cols))), 0
        for k, end in enumerate(ends):
            total += a[rows, begin:end] @ b[cols, begin:end].T
            begin = end
            alive = total + np.outer(left[k][rows], right[k][cols]) >= threshold - SLACK
            if same:
                alive &= rows[:, None] < cols[None, :]
            keep_r, keep_c = alive.any(axis=1), alive.any(axis=0)
            rows, cols, total, alive = rows[keep_r], cols[keep_c], total[np.ix_(keep_r, keep_c)], alive[np.ix_(keep_r, keep_c)]
            if not len(rows):
                break
        else:
            i, j = np.nonzero(alive & (np.abs(total - threshold) <= SLACK))
            if len(i):
                x, y = raw or (a, b)
                total[i, j] = cosines(x[rows[i]], y[cols[j]])
            alive &= total >= threshold
            if alive.any():
                yield rows, cols, alive


def compare(a: np.ndarray, b: np.ndarray, threshold: float, same: bool, raw: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All linked pairs (row of a, row of b)."""
    found = [(rows[i], cols[j]) for rows, cols, linked in strips(a, b, threshold, same, raw) for i, j in [np.nonzero(linked)]]
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


def usable(vec: str, label: str):
    """Whether a row can link at all: label and vector not null, no null or non-finite component, not zero."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(label).isNotNull() & (F.size(vec) > 0) & ~bad & F.exists(vec, lambda x: x != 0), F.lit(False))


class Links:
    """Counts and connections of the vectors of a task, gathered strip by strip; memory grows with the vectors, not with the pairs."""

    def __init__(self, weight: np.ndarray):
        self.weight, self.count, self.label = weight, np.zeros(len(weight), np.int64), np.arange(len(weight))
        self.a, self.b = [], []

    def add(self, rows: np.ndarray, cols: np.ndarray, linked: np.ndarray) -> None:
        """Each vector of the strip takes the least label that it reaches within the strip; where that is new, an edge is kept."""
        self.count[rows] += linked @ self.weight[cols]
        self.count[cols] += self.weight[rows] @ linked
        r, c, none = self.label[rows], self.label[cols], len(self.label)
        while True:
            new_r = np.minimum(r, np.where(linked, c[None, :], none).min(axis=1))
            new_c = np.minimum(c, np.where(linked, new_r[:, None], none).min(axis=0))
            if np.array_equal(new_r, r) and np.array_equal(new_c, c):
                break
            r, c = new_r, new_c
        for own, new in ((rows, r), (cols, c)):
            moved = self.label[own] != new
            self.a.append(self.label[own][moved])
            self.b.append(new[moved])
            self.label[own] = np.minimum(self.label[own], new)

    def roots(self) -> np.ndarray:
        """The least vector that each is joined with."""
        edges = [np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (self.a, self.b)]
        return components(len(self.label), np.r_[edges[0], np.arange(len(self.label))], np.r_[edges[1], self.label])


def near_duplicate_vectors(df: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", tile: int = TILE) -> DataFrame:
    """id, n_links, component_id, kept for every row: vectors of equal label and size link at a cosine of at least threshold.

    Vectors that are null, zero or not finite, and rows without a label, link with nothing. Equal vectors of a label are one
    node with a count, so copies make no pairs; repeated rows count as vectors of their own, and rows that share an id but not a
    vector stay apart. A row without an id is never kept, though others count it. Other columns are ignored.

    Vectors in the order of their leading coordinates are cut to tiles, and successive tiles to about as many groups as the root of
    the number of tiles. A task compares two groups of a label, so a tile is sent about root-of-tiles times; within a task, tiles
    whose bounding boxes of BOX leading coordinates lie too far apart are not compared.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.select("id", "label", F.when(usable("vec", "label"), F.col("vec")).alias("vec"))
    rows = rows.withColumns({"h1": F.xxhash64("label", "vec"), "h2": F.xxhash64(F.lit(1), "vec", "label")})
    able = rows.where("vec IS NOT NULL")
    # Two hashes of 64 bits stand for label and vector, so that keys stay narrow.
    nodes = cut(able.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("vec").alias("vec"), F.xxhash64("h1", "h2").alias("node")), "vectors")
    total = nodes.count()
    axes = spark.sparkContext.broadcast({d: rotation(m) for d, m in moments(nodes).items()})
    turn = lambda x: unit(x) @ axes.value[x.shape[1]] if x.shape[1] in axes.value else unit(x)

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dim, first, raw = np.zeros(len(batch), np.int32), np.zeros(len(batch)), np.empty(len(batch), object)
            for d, own, x in by_size(batch.column("vec")):
                dim[own], first[own] = d, turn(x)[:, 0]
                raw[own] = [v.tobytes() for v in x]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("label", "node", "n")), pa.array(dim), pa.array(first), pa.array(raw, pa.binary())], names=["label", "node", "n", "dim", "lead", "x"])

    label_type = nodes.schema["label"].dataType.simpleString()
    led = nodes.select("label", "vec", "node", "n").mapInArrow(lead, f"label {label_type}, node long, n long, dim int, lead double, x binary")

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of at most `tile` rows of one label and size."""
        part, held = TaskContext.get().partitionId(), None

        def done(own: pa.Table) -> pa.RecordBatch:
            dim, node, n = own.column("dim")[0].as_py(), own.column("node").to_numpy(), own.column("n").to_numpy()
            x = b"".join(own.column("x").to_pylist())
            z = turn(np.frombuffer(x).reshape(-1, dim))[:, :BOX]
            box = pa.list_(pa.float64())
            values = [(own.column("label")[0].as_py(), own.schema.field("label").type), (dim, pa.int32()), (part, pa.int32()), (int(node[0]), pa.int64()), (z.min(axis=0).tolist(), box), (z.max(axis=0).tolist(), box), *((v, pa.binary()) for v in (node.tobytes(), n.tobytes(), x))]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in values], names=["label", "dim", "part", "tile", "low", "high", "nodes", "counts", "x"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            label, dim = held.column("label").to_pylist(), held.column("dim").to_pylist()
            at = 0
            for i in range(1, len(held)):
                if i - at >= tile or label[i] != label[at] or dim[i] != dim[at]:
                    yield done(held.slice(at, i - at))
                    at = i
            held = held.slice(at).combine_chunks()
        if held is not None and len(held):
            yield done(held)

    n_parts = max(1, -(-total // tile))
    ordered = led.repartitionByRange(n_parts, "label", "dim", "lead", "node").sortWithinPartitions("label", "dim", "lead", "node")
    cut_up = cut(ordered.mapInArrow(tiles, f"label {label_type}, dim int, part int, tile long, low array<double>, high array<double>, nodes binary, counts binary, x binary"), "tiles")
    n_tiles, last = cut_up.agg(F.count("*"), F.max("part")).first()
    groups = max(1, int(np.ceil(np.sqrt(n_tiles))), -(-n_tiles // GROUP))
    grouped = cut_up.withColumn("g", F.floor(F.col("part") * F.lit(groups) / F.lit((last or 0) + 1)).cast("int"))
    # Unit vectors with cosine >= t are at most sqrt(2 - 2t) apart; so are boxes that hold them.
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    apart = lambda low, high: (np.maximum(0, np.maximum(low[0] - high[1], low[1] - high[0])) ** 2).sum() > reach**2
    a, b = (grouped.select("label", "dim", F.col("g").alias(x)).distinct() for x in "ij")
    pairs = a.join(b, ["label", "dim"]).where("i <= j")
    sent = pairs.select("label", "dim", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("g"))

    def links(key: tuple, table: pa.Table) -> pa.Table:
        """For each vector with a link between the two groups: how many vectors it links to there, and the first it is joined with."""
        own = sorted(table.to_pylist(), key=lambda r: r["tile"])
        both = key[2].as_py() != key[3].as_py()
        raw = [np.frombuffer(r["x"]).reshape(-1, r["dim"]) for r in own]
        z, at = [turn(x) for x in raw], np.cumsum([0, *map(len, raw)])
        node, n = (np.concatenate([np.frombuffer(r[c], np.int64) for r in own]) for c in ("nodes", "counts"))
        found = Links(n)
        for p in range(len(own)):
            for q in range(p, len(own)):
                if (both and own[p]["g"] == own[q]["g"]) or apart(*((np.array(own[p][c]), np.array(own[q][c])) for c in ("low", "high"))):
                    continue
                for rows_, cols, linked in strips(z[p], z[q], threshold, p == q, (raw[p], raw[q])):
                    found.add(at[p] + rows_, at[q] + cols, linked)
        root, own_ = found.roots(), np.flatnonzero(found.count)
        return pa.table({"a": node[own_], "b": node[root[own_]], "links": found.count[own_]})

    joined = cut(sent.join(grouped.select("label", "dim", "g", "tile", "low", "high", "nodes", "counts", "x"), ["label", "dim", "g"]).groupBy("label", "dim", "i", "j").applyInArrow(links, "a long, b long, links long"), "links")
    counts = joined.groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "node")
    roots = connected_components(joined.select("a", "b")).withColumnRenamed("component", "root")
    linked = cut(nodes.select("node", "rep").join(counts, "node").join(roots, "node"), "linked-vectors")
    least = cut(linked.groupBy("root").agg(F.min("rep").alias("least")), "least-vectors")
    found = linked.join(least, "root").select("node", "links", "least")
    per_node = cut(nodes.select("node", "h1", "h2", "n", "rep").join(found, "node", "left").select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("least", "rep").alias("least")), "vector-results")
    out = rows.select("id", "h1", "h2", F.col("vec").isNotNull().alias("able")).join(per_node, ["h1", "h2"], "left")
    component = F.when(F.col("able"), F.col("least")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.when(F.col("able"), F.col("links")).otherwise(F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
