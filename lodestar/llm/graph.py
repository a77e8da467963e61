"""Connected components over edge tables, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, store

#: Tasks that a heavy node is dealt to. A node is heavy if it has over a MOST_HEAVY-th of all pairs, and at least HEAVY: so at most MOST_HEAVY rows are broadcast.
SALTS, HEAVY, MOST_HEAVY = 16, 256, 100_000


def _with_least(pairs: DataFrame, least: DataFrame, heavy: DataFrame) -> DataFrame:
    """(u, v, m): each pair with m, the least of u and all its v. Only heavy nodes are dealt to SALTS tasks; both sides are shuffled."""
    dealt = pairs.join(F.broadcast(heavy), "u", "left").select("u", "v", F.when(F.col("heavy"), F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).otherwise(0).alias("salt"))
    salts = F.when(F.col("heavy"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    spread = least.join(F.broadcast(heavy), "u", "left").select("u", "m", F.explode(salts).alias("salt"))
    return dealt.join(spread.hint("merge"), ["u", "salt"])


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of edges (a long, b long); the component is its smallest node.

    Edges with a null end, loops and repeats are ignored; an empty table gives an empty one. Each round is written to the
    shared folder, and the files of the round before are removed. Rounds are logarithmic in the size of a component; reaching
    max_rounds raises.
    """
    spark = edges.sparkSession
    ends = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    at, path = store(ends.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "components")
    for _ in range(max_rounds):
        both = at.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(at.select("lo", "hi"))
        parents = F.count(F.when(F.col("v") < F.col("u"), 1)).alias("parents")
        least, used = store(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("n"), parents), "least")
        # Settled: no node has two parents, or is both parent and child.
        unfinished, n = least.agg(F.bool_or((F.col("parents") > 1) | ((F.col("parents") == 1) & (F.col("n") > 1))), F.sum("parents")).first()
        if not unfinished:
            discard(spark, used)
            return at.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(at.select("lo", "lo").distinct())
        # A node has no more pairs in the small star than in both, so the same nodes are heavy.
        heavy = least.where(F.col("n") > max(HEAVY, 2 * n // MOST_HEAVY)).select("u", F.lit(True).alias("heavy"))
        large = _with_least(both, least.select("u", "m"), heavy).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _with_least(large, large.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), heavy)
        before, (at, path) = path, store(small.select(F.col("u").alias("hi"), F.col("m").alias("lo")).unionAll(small.where("v <> m").select("v", "m")).distinct(), "components")
        discard(spark, before, used)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
