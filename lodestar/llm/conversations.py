"""Prefix trie of conversations, rolled up by centroid decomposition of its parent-edge forest."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Prefixes are hashed as polynomials over this prime at this base, so that hashes of neighbouring stretches can be joined.
PRIME, BASE = (1 << 127) - 1, int.from_bytes(hashlib.sha256(b"prefix").digest()[:15], "big")
ROOT = bytes(16)
#: Nodes of a component that one task decomposes; larger ones are split by joins first.
LOCAL = 256
#: Conversation ids whose text is one row of a node's list.
RANGE = 1024


def _bytes(h: int) -> bytes:
    return h.to_bytes(16, "big")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, prev, cur, n_bytes): turns in order, from 1, with the hash of the conversation before and after each.

    Order: turn (null first), role, text; null role and text are empty, rows without a conv_id are left out. Rows are range-partitioned
    and sorted, and each task hashes its stretch; what a conversation has in earlier tasks (a number and a hash a task, from one row a
    task) is added afterwards. So a conversation that holds a third of all rows spreads over tasks, and no task keeps more than a row.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", text("role").alias("role"), text("text").alias("text"))
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text", "_row"]
    turns = turns.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    digest = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.lit(":"), F.col("text")), 256))

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, pos, h = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            prev, cur, place = [], [], []
            for c, d in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if c != conv:
                    conv, pos, h = c, 0, 0
                prev.append(_bytes(h))
                h, pos = (h * BASE + int.from_bytes(d[:16], "big")) % PRIME, pos + 1
                cur.append(_bytes(h))
                place.append(pos)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([part] * len(cur), pa.int32()), pa.array(place, pa.int64()), pa.array(prev, pa.binary()), pa.array(cur, pa.binary()), batch.column(2)], ["conv_id", "part", "pos", "prev", "cur", "n_bytes"])

    schema = "conv_id long, part int, pos long, prev binary, cur binary, n_bytes long"
    found = cut(turns.select("conv_id", digest.alias("d"), F.octet_length("text").cast("long").alias("n_bytes")).mapInArrow(hashed, schema), "turns")
    # Conversations in several tasks: a task has at most two of them, the one that it begins in and the one that it ends in.
    stretch = found.groupBy("conv_id", "part").agg(F.max("pos").alias("n"), F.max_by("cur", "pos").alias("h"))
    several = stretch.groupBy("conv_id").agg(F.count("*").alias("parts")).where("parts > 1").select("conv_id")
    carried, before = [], {}
    for r in stretch.join(several, "conv_id").orderBy("conv_id", "part").collect():  # two rows a task at most
        n, h = before.get(r.conv_id, (0, 0))
        carried.append((r.conv_id, r.part, n, _bytes(h)))
        before[r.conv_id] = n + r.n, (h * pow(BASE, r.n, PRIME) + int.from_bytes(r.h, "big")) % PRIME
    carry = conversations.sparkSession.createDataFrame(carried, "conv_id long, part int, n long, h binary")
    joined = found.join(F.broadcast(carry), ["conv_id", "part"], "left")
    moved = joined.select("conv_id", (F.col("pos") + F.coalesce("n", F.lit(0))).alias("pos"), after(F.col("prev"), F.col("h"), F.col("pos") - 1).alias("prev"), after(F.col("cur"), F.col("h"), F.col("pos")).alias("cur"), "n_bytes")
    return moved


def after(h: Column, before: Column, n: Column) -> Column:
    """The hash h of a stretch of n turns when a stretch of hash `before` stands in front of it; h where that is null or nothing."""

    @F.arrow_udf("binary")
    def joined(h: pa.Array, before: pa.Array, n: pa.Array) -> pa.Array:
        number = lambda b: int.from_bytes(b, "big")
        return pa.array([_bytes((number(a) + number(b) * pow(BASE, k, PRIME)) % PRIME) for a, b, k in zip(h.to_pylist(), before.to_pylist(), n.to_pylist(), strict=True)], pa.binary())

    return F.when(before.isNull() | (before == F.lit(ROOT)), h).otherwise(joined(h, F.coalesce(before, F.lit(ROOT)), n))


def difference(a: Column, b: Column) -> Column:
    """The hash that must stand before a stretch in place of b for it to be as after a."""

    @F.arrow_udf("binary")
    def less(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([_bytes((int.from_bytes(x, "big") - int.from_bytes(y, "big")) % PRIME) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.binary())

    return F.when(a == b, F.lit(ROOT)).otherwise(less(a, b))


def rebuilt(turns: DataFrame, every: int = 5, modulus: int = 9) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: (conv_id, depth, key, parent, first, n_bytes) a turn, and (conv_id, length, key) a conversation.

    A conversation begins with the first h turns of conversation c - c % every (all if it has fewer), h = crc32(c) % modulus, and goes on
    with its own turns after its first h. key and parent hash the prefix with and without the turn, first its first turn.
    """
    most = modulus  # turns up to h, and one more
    head = F.array_sort(F.collect_list(F.when(F.col("pos") <= most, F.struct("pos", "prev", "cur", "n_bytes"))))
    convs = cut(turns.groupBy("conv_id").agg(F.max("pos").alias("n"), head.alias("head")).withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % modulus), "heads")
    base = convs.select(F.col("conv_id").alias("base"), F.col("head").alias("base_head"), F.col("n").alias("base_n"))
    both = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).join(base, "base", "left").withColumn("base_n", F.coalesce("base_n", F.lit(0)))
    m, at = F.least(F.col("h"), F.col("base_n")), lambda array, i, part: F.coalesce(F.when(i > 0, F.get(array, (i - 1).cast("int"))[part]), F.lit(ROOT))
    both = both.withColumn("m", m).withColumn("taken", F.slice("base_head", 1, F.col("m").cast("int")))
    own = F.greatest(F.col("n") - F.col("h"), F.lit(0))
    joint = difference(at("base_head", F.col("m"), "cur"), at("head", F.least("h", "n"), "cur"))
    plan = cut(both.select("conv_id", "h", "m", (F.col("m") + own).alias("length"), joint.alias("joint"), "taken", at("head", F.col("h") + 1, "cur").alias("own_first")), "plan")
    first = F.when(F.col("m") > 0, F.col("taken")[0]["cur"]).otherwise(after(F.col("own_first"), F.col("joint"), F.lit(1).cast("long")))
    known = plan.where("length > 0").withColumn("first", first)
    given = known.select("conv_id", "first", F.inline("taken")).select("conv_id", F.col("pos").alias("depth"), F.col("cur").alias("key"), F.col("prev").alias("parent"), "first", "n_bytes")
    kept = turns.join(known.select("conv_id", "h", "m", "joint", "first").hint("merge"), "conv_id").where(F.col("pos") > F.col("h")).withColumn("k", F.col("pos") - F.col("h"))
    moved = kept.select("conv_id", (F.col("m") + F.col("k")).alias("depth"), after(F.col("cur"), F.col("joint"), F.col("k")).alias("key"), after(F.col("prev"), F.col("joint"), F.col("k") - 1).alias("parent"), "first", "n_bytes")
    rows = cut(given.unionAll(moved), "rebuilt")
    ends = rows.join(plan.select("conv_id", "length").hint("merge"), "conv_id").where("depth = length").select("conv_id", "length", "key")
    return rows, ends.unionAll(plan.where("length = 0").select("conv_id", "length", F.lit(ROOT).alias("key")))


def digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of each node's conv_ids, ascending and comma-joined.

    Ids are joined in ranges of RANGE ids first, each at most one row; the ranges of a node then stream through one task in order,
    since the digest of a text needs it from start to end. A task keeps one range.
    """
    ids = F.array_sort(F.collect_list("conv_id")).cast("array<string>")
    ranges = ends.withColumn("range", F.floor(F.col("conv_id") / RANGE)).groupBy("key", "range").agg(F.array_join(ids, ",").alias("ids"))

    def digested(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            out = []
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k != key:
                    if digest:
                        out.append((key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.binary()), pa.array([d for _, d in out], pa.string())], ["key", "ends_sha256"])
        if digest:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()], pa.string())], ["key", "ends_sha256"])

    return ranges.repartition("key").sortWithinPartitions("key", "range").select("key", "ids").mapInArrow(digested, "key binary, ends_sha256 string")


def decompose(parent: list[int], values: list[list[int]]) -> None:
    """Roll values (lists of equal length, one a node) up a tree in place: each node gets the sum of its subtree.

    Nodes are numbered from the top, parents first; parent[0] is not looked at. The centroid of a component is its deepest node with at
    least half of it below; the total of what it has below it in the component is added to it and to all nodes from it to the top (which got
    what was cut from below it before). What remains, one component a child and the upper part, is decomposed in turn, so a node is in at most log2(n) + 1 components, however deep the tree.
    """
    totals, size = [[0] * len(values) for _ in parent], [0] * len(parent)
    open_components = [list(range(len(parent)))]
    while open_components:
        nodes = open_components.pop()
        top = nodes[0]
        for v in nodes:
            size[v] = 1
        for v in reversed(nodes):
            if v != top:
                size[parent[v]] += size[v]
        centroid = [v for v in nodes if 2 * size[v] >= len(nodes)][-1]
        under, parts, total = {}, {}, [0] * len(values)
        for v in nodes:
            if v == centroid:
                continue
            side = None if v == top else v if parent[v] == centroid else under.get(parent[v])
            under[v] = side
            parts.setdefault(side, []).append(v)
            if side is not None:
                total = [t + x[v] for t, x in zip(total, values, strict=True)]
        total = [t + x[centroid] for t, x in zip(total, values, strict=True)]
        totals[centroid] = [a + b for a, b in zip(totals[centroid], total, strict=True)]
        v = centroid
        while v != top:
            v = parent[v]
            totals[v] = [a + b for a, b in zip(totals[v], total, strict=True)]
        open_components += parts.values()
    for i, x in enumerate(values):
        x[:] = [t[i] for t in totals]


def small_components(nodes: DataFrame, values: list[str]) -> DataFrame:
    """nodes with `values` rolled up inside each component (column top) and added to what they hold from larger ones (columns acc_...)."""
    columns = nodes.columns

    def solved(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def settle(rows: list[dict]) -> list[dict]:
            place = {r["key"]: i for i, r in enumerate(rows)}
            sums = [[r[v] for r in rows] for v in values]
            decompose([place.get(r["parent"], -1) for r in rows], sums)
            return [r | {v: s[i] + r[f"acc_{v}"] for v, s in zip(values, sums, strict=True)} for i, r in enumerate(rows)]

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if held and held[0]["top"] != row["top"]:
                    out += settle(held)
                    held = []
                held.append(row)
            yield pa.RecordBatch.from_pylist(out, batch.schema)
            schema = batch.schema
        if held:
            yield pa.RecordBatch.from_pylist(settle(held), schema)

    dealt = nodes.repartition("top").sortWithinPartitions("top", "depth")
    return dealt.mapInArrow(solved, nodes.schema).select(columns)


def rollup(nodes: DataFrame, paths: DataFrame, values: list[str], local: int = LOCAL) -> DataFrame:
    """nodes (key, parent, owner, depth, first, ...) with `values` summed over subtrees, by centroid decomposition of the forest under the root.

    paths: (conv_id, depth, key, parent) of all prefixes of the owners; a node is a prefix of its owner, so its ancestors are there.
    Trees of over `local` nodes are split by joins: each round takes the centroid of every such component out, settles it, adds its
    total to the nodes from it to the top, and names the remaining parts by their tops. Sizes, which find the centroids, come from one
    aggregate: a node's subtree is what its conversations own below it; they shrink along the same paths. Components halve, so rounds
    are logarithmic in the largest tree; what has at most `local` nodes is decomposed whole inside tasks. Rounds are written to the
    shared folder.
    """
    carried = nodes.columns
    acc = [f"acc_{v}" for v in values]
    start = nodes.select(*carried, F.col("first").alias("top"), *(F.lit(0).cast("long").alias(a) for a in acc))
    large = nodes.groupBy("first").agg(F.count("*").alias("total")).where(F.col("total") > local).select(F.col("first").alias("top"), "total")
    large = cut(large, "large")
    if large.isEmpty():
        return small_components(start, values).select(carried)
    ready = start.join(large.select("top").hint("merge"), "top", "left_anti")
    owned = nodes.groupBy(F.col("owner").alias("conv_id")).agg(F.min("depth").alias("lo"), F.max("depth").alias("hi"))
    member = paths.join(large.withColumnRenamed("top", "first").hint("merge"), "first").join(owned.hint("merge"), "conv_id")
    paths = cut(member.select("conv_id", "depth", "key", "parent", "lo", "hi"), "paths")
    sizes = paths.groupBy("key").agg(F.sum(F.col("hi") - F.greatest("lo", "depth") + 1).alias("size"))
    active = cut(start.join(large.hint("merge"), "top").join(sizes.hint("merge"), "key"), "active")
    settled, rest = [], [ready.select(*carried, "top", *acc)]
    while not active.isEmpty():
        middle = active.where(F.col("size") * 2 >= F.col("total")).groupBy("top").agg(F.max(F.struct("depth", "key", "owner", "size")).alias("c"))
        middle = middle.select("top", F.col("c.depth").alias("c_depth"), F.col("c.key").alias("c_key"), F.col("c.owner").alias("c_owner"), F.col("c.size").alias("c_size"))
        middle = cut(middle, "middle")  # apart from the join, so that the join's rows of a large component can be split
        told = active.join(middle.hint("merge"), "top")
        # The part of a deeper node: its ancestor just below the centroid, if that is the centroid's child.
        below = paths.select(F.col("conv_id").alias("owner"), (F.col("depth") - 1).alias("c_depth"), F.col("key").alias("part"), F.col("parent").alias("c_key"))
        told = told.join(below.hint("merge"), ["owner", "c_depth", "c_key"], "left").withColumn("part", F.when(F.col("depth") > F.col("c_depth"), F.col("part")))
        told = cut(told, "told")
        inside = (F.col("key") == F.col("c_key")) | F.col("part").isNotNull()
        total = told.where(inside).groupBy("top", "c_key", "c_owner", "c_depth", "c_size").agg(*(F.sum(v).alias(f"sum_{v}") for v in values))
        total = cut(total, "totals")
        sums = [f"sum_{v}" for v in values]
        done = told.where(F.col("key") == F.col("c_key")).join(total.select("c_key", *sums).hint("merge"), "c_key")
        settled.append(done.select(*((F.col(f"sum_{c}") + F.col(f"acc_{c}")).alias(c) if c in values else F.col(c) for c in carried)))
        # From the centroid to the top: prefixes of its owner that are nodes of the component.
        way = paths.withColumnRenamed("conv_id", "c_owner").join(total.hint("merge"), "c_owner").where(F.col("depth") < F.col("c_depth")).select("key", "top", F.lit(True).alias("on_way"), *sums)
        left = told.where(F.col("key") != F.col("c_key")).join(way.hint("merge"), ["key", "top"], "left")
        left = left.select(
            *carried, F.coalesce("part", "top").alias("top"), *((F.col(a) + F.coalesce(s, F.lit(0))).alias(a) for a, s in zip(acc, sums, strict=True)),
            (F.col("size") - F.when(F.col("on_way"), F.col("c_size")).otherwise(0)).alias("size"),
        )
        left = cut(left, "left")
        tops = left.where(F.col("key") == F.col("top")).select("top", F.col("size").alias("total"))
        rest.append(left.join(tops.where(F.col("total") <= local).select("top").hint("merge"), "top", "left_semi").select(*carried, "top", *acc))
        active = cut(left.join(tops.where(F.col("total") > local).hint("merge"), "top"), "active")
    pieces = rest[0]
    for r in rest[1:]:
        pieces = pieces.unionAll(r)
    out = small_components(pieces, values).select(carried)
    for s in settled:
        out = out.unionAll(s.select(carried))
    return out


def prefix_trie(conversations: DataFrame, local: int = LOCAL) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node of the trie of rebuilt conversations.

    Nodes are distinct sequences of (role, text); conversations, turns and nulls are as in ordered_turns and rebuilt. Repeated rows are
    turns of their own, other columns are ignored, and a table without a conversation gives no rows, not even a root.
    """
    rows, ends = rebuilt(ordered_turns(conversations))
    ends = cut(ends, "ends")
    owner, n_convs = ends.agg(F.min("conv_id"), F.count("*")).first()
    nodes = cut(rows.groupBy("key", "parent", "first", "depth", "n_bytes").agg(F.min("conv_id").alias("owner"), F.count("*").alias("n_convs")), "nodes")
    children = nodes.where("depth > 1").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    sha = cut(digests(ends), "digests")
    above = nodes.select(F.col("key").alias("parent"), F.col("owner").alias("parent_conv_id"))
    told = nodes.join(children.hint("merge"), "key", "left").join(sha.hint("merge"), "key", "left").join(above.hint("merge"), "parent", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    told = told.select(
        "key", "parent", "owner", "depth", "first", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), F.coalesce("parent_conv_id", F.lit(owner).cast("long")).alias("parent_conv_id"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"), F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"),
    )
    whole = cut(rollup(cut(told, "told"), rows, ["n_leaves", "saved_tokens"], local), "trie")
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    result = whole.withColumnRenamed("owner", "conv_id").select(out)
    if owner is None:
        return result
    # The root holds every conversation; its subtree is the sum of the trees under it.
    trees = whole.where("depth = 1").agg(F.count("*"), F.coalesce(F.sum("n_leaves"), F.lit(1)), F.coalesce(F.sum("saved_tokens"), F.lit(0))).first()
    at_root = sha.where(F.col("key") == F.lit(ROOT)).agg(F.coalesce(F.max("ends_sha256"), F.lit(nothing))).first()
    root = conversations.sparkSession.createDataFrame([(owner, 0, None, n_convs, *trees, *at_root)], result.schema)
    return result.unionAll(root)
