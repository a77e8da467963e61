"""Consistent weighted samples against a plain version, the similarity they estimate, and awkward rows."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

from lodestar.llm import fingerprints, queries

from test_llm import AWKWARD, SCHEMA, rows

M = (1 << 64) - 1


def xx(*values):
    """Spark's xxhash64 of strings and integers, unsigned."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else (v & M).to_bytes(8, "little") if abs(v) >= 1 << 31 or v < 0 else v.to_bytes(8, "little"), seed)
    return seed


def words(text):
    return Counter(w for w in re.split(r"[ \t-\r]+", text or "") if w)


def jaccard(a, b):
    a, b = words(a), words(b)
    return sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0


def ordered(docs):
    """What the contract says of each document, without fingerprints."""
    at = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, hashlib.md5((d[1] or "").encode()).hexdigest()))
    out = []
    for i, (doc_id, text) in enumerate(at):
        text, after = text or "", at[(i + 1) % len(at)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), text, edited, after))
    return out


def test_samples_equal_a_plain_version(spark):
    text = "one two two three three three four " * 3 + "five"
    got = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = fingerprints.fingerprints(got, ["doc_id"], F.col("text"), 8).first()["fingerprint"]
    hashes = {r[0]: r[1] for r in spark.createDataFrame([(w,) for w in words(text)], "w string").select("w", F.xxhash64("w")).collect()}
    pairs = spark.createDataFrame([(h, k) for h in hashes.values() for k in range(8)], "h long, k int").select("h", "k", F.xxhash64("h", "k")).collect()
    draws, want = {(r[0], r[1]): r[2] & M for r in pairs}, ""
    for k in range(8):
        best = None
        for w, n in words(text).items():
            x = draws[hashes[w], k]
            unit = lambda first, bits, x=x: ((x >> first & ((1 << bits) - 1)) + 0.5) / (1 << bits)
            c, r, beta = -math.log(unit(0, 14) * unit(14, 14)), -math.log(unit(28, 12) * unit(40, 12)), unit(52, 12)
            t = math.floor(math.log(n) / r + beta)
            a = math.log(c) - r * (t - beta + 1)
            best = min(best or (math.inf, ""), (a, f"{(hashes[w] ^ t << 8) & 0xFFFFFFFF:08x}"))
        want += best[1]
    assert got == want


def test_rate_of_equal_samples_is_the_generalised_jaccard_similarity(spark):
    a = " ".join(f"a{i % 40}" for i in range(400)) + " " + " ".join(f"b{i}" for i in range(60))
    b = " ".join(f"a{i % 40}" for i in range(160)) + " " + " ".join(f"c{i}" for i in range(90))
    marks = fingerprints.fingerprints(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string"), ["doc_id"], F.col("text"), 256)
    x, y = (r["fingerprint"] for r in marks.orderBy("doc_id").collect())
    rate = sum(x[i : i + 8] == y[i : i + 8] for i in range(0, len(x), 8)) / 256
    assert abs(rate - jaccard(a, b)) < 4 * math.sqrt(0.25 / 256)


def test_query_against_the_texts(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in rows(queries.op11_document_fingerprints(spark, "/root/testdata/sf0.01"))}
    want = {x[0]: x for x in ordered(docs)}
    assert {k: (r["n_chars"], r["edited_sha256"]) for k, r in got.items()} == {k: x[1:3] for k, x in want.items()}
    error = [(r["near_edited"] - jaccard(want[k][3], want[k][4]), r["near_next"] - jaccard(want[k][3], want[k][5])) for k, r in got.items()]
    for way in (0, 1):
        assert abs(sum(e[way] for e in error) / len(error)) < 0.02  # unbiased
        assert sum(e[way] ** 2 for e in error) / len(error) < 0.25 / fingerprints.SAMPLES
    same = defaultdict(set)
    for k, r in got.items():
        same[want[k][3]].add(r["fingerprint"])
    assert all(len(x) == 1 for x in same.values())
    assert all(len(r["fingerprint"]) == len(r["edited_fingerprint"]) == 8 * fingerprints.SAMPLES for r in got.values())


def test_awkward_rows(spark):
    docs = spark.createDataFrame(AWKWARD, SCHEMA)
    got = rows(fingerprints.document_fingerprints(docs))
    want = ordered([r[:2] for r in AWKWARD])
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=str) == sorted((x[:3] for x in want), key=str)
    of = {r["doc_id"]: r for r in got}
    assert of[1]["fingerprint"] == of[2]["fingerprint"] == of[3]["fingerprint"] and of[1]["near_next"] == 1.0
    assert of[4]["fingerprint"] == of[7]["fingerprint"] != of[5]["fingerprint"]
    assert sum(r["near_next"] == 1.0 for r in got if r["doc_id"] == 7) == 1  # the first of two equal rows is followed by the second
    alone = rows(fingerprints.document_fingerprints(docs.where("doc_id = 6")))
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0
    assert fingerprints.document_fingerprints(docs.limit(0)).count() == 0


def test_no_python_workers(spark):
    plan = fingerprints.document_fingerprints(spark.createDataFrame(AWKWARD, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
