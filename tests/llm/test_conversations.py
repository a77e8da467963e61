"""The prefix trie against a plain version: small limits that split trees by joins, hot and long conversations, awkward rows."""

import hashlib
import random
import zlib

import pytest

from lodestar.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def plain_trie(rows):
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = tuple(turns.get(base, [])[:h] + own[h:])
    nodes = {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    out = {p: [min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), 0, 0, 0] for p, m in nodes.items()}
    for p in nodes:
        if p:
            out[p[:-1]][4] += 1
    for p, m in nodes.items():
        for d in range(len(p) + 1):
            out[p[:d]][5] += out[p][4] == 0
            out[p[:d]][6] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    ids = lambda p, m: ",".join(str(c) for c in sorted(m) if built[c] == p)
    return sorted(((*out[p], hashlib.sha256(ids(p, m).encode()).hexdigest()) for p, m in nodes.items()), key=str)


def trie(spark, rows, **kw):
    return sorted((tuple(r) for r in conversations.prefix_trie(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA), **kw).collect()), key=str)


@pytest.mark.parametrize("local", [3, 256])
def test_trie_equals_a_plain_version(spark, local):
    rng = random.Random(local)
    rows = [(c, t, rng.choice(["user", "bot"]), rng.choice(["a", "b", "é"])) for c in range(-12, 60) for t in range(rng.randrange(1, 12))]
    rows += [(c, t, "user", "same") for c in range(100, 160) for t in range(6)]  # copies
    rows += [(c, t, "user", f"{t % 7}" if t < 60 else f"{c}") for c in (200, 205) for t in range(70)]  # long ones
    rng.shuffle(rows)
    assert trie(spark, rows, local=local) == plain_trie(rows)


def test_awkward_rows(spark):
    rows = [(5, None, None, None), (5, 2, "user", "x"), (5, 2, "user", "x"), (None, 1, "user", "lost"), (8, 1, "a", ""), (9, 1, "", "a"), (33, 7, "user", "absent base")]
    assert trie(spark, rows) == plain_trie(rows)
    turnless = [c for c in range(1, 60) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1][:2]
    assert trie(spark, [(c, 0, "user", "gone") for c in turnless]) == plain_trie([(c, 0, "user", "gone") for c in turnless])
    assert trie(spark, []) == []


def test_a_conversation_over_several_tasks(spark):
    rows = [(c, t, "user", f"{t}") for c in (0, 3, 5) for t in range(9 if c else 400)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    turns = conversations.ordered_turns(df.repartition(8))
    got = {(r.conv_id, r.pos): (r.prev, r.cur) for r in turns.collect()}
    assert len(got) == len(rows)
    for c, n in ((0, 400), (3, 9), (5, 9)):
        h = 0
        for t in range(n):
            before, h = h, (h * conversations.BASE + int.from_bytes(hashlib.sha256(f"4:user:{t}".encode()).digest()[:16], "big")) % conversations.PRIME
            assert got[c, t + 1] == (before.to_bytes(16, "big"), h.to_bytes(16, "big"))


def test_centroids_settle_deep_trees_in_few_components():
    n, rng = 3000, random.Random(1)
    for parent in ([-1] + list(range(n - 1)), [-1] + [rng.randrange(max(0, i - 5), i) for i in range(1, n)], [-1] + [0] * (n - 1)):
        value, want = [rng.randrange(9) for _ in range(n)], None
        want = list(value)
        for v in range(n - 1, 0, -1):
            want[parent[v]] += want[v]
        got = [list(value)]
        conversations.decompose(parent, got)
        assert got[0] == want
