"""Importance resampling against a plain version, for runs of one to three words, and on awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from lodestar.llm import resampling

from test_llm import AWKWARD, SCHEMA, rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text, n):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)], len(words)


def plain_resample(docs, target, n, buckets=10_000, least=20, percent=10):
    of = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(of(f) for text in texts for f in plain_features(text, n)[0]) for texts in ([x for _, x in docs], target))
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t)))
    out = []
    for doc_id, text in docs:
        found, n_words = plain_features(text, n)
        weight = sum(gain(of(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, n_words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], -1 if x[0] is None else x[0]))
    ranks = defaultdict(list)
    for i, x in enumerate(able[: len(able) * percent // 100]):
        ranks[x[0]].append(i + 1)
    return sorted(((x[0], x[2], x[3], x[4], ranks[x[0]].pop() if ranks[x[0]] and x[1] >= least else None) for x in out), key=str)


@pytest.mark.parametrize("n", [1, 3])
def test_resampling_equals_plain_version(spark, n):
    docs, target = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    got = resampling.resample(docs, target, n)
    want = plain_resample([tuple(r) for r in docs.select("doc_id", "text").collect()], [r[0] for r in target.select("text").collect()], n)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    drawn = sorted(r[4] for r in want if r[4])
    assert drawn == list(range(1, len(drawn) + 1)) and drawn


def test_resampling_of_awkward_rows(spark):
    docs, target = spark.createDataFrame(AWKWARD, SCHEMA), spark.createDataFrame([(1, "the lazy DOG"), (2, None)], "item_id long, text string")
    got = rows(resampling.resample(docs, target, 2, least_words=1, percent=50))
    want = plain_resample([r[:2] for r in AWKWARD], ["the lazy DOG", None], 2, least=1, percent=50)
    assert [x[:4] for x in sorted((tuple(r.values()) for r in got), key=str)] == [x[:4] for x in want]
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3] and len(got) == len(AWKWARD)
    nothing = docs.limit(0)
    assert resampling.resample(nothing, target).count() == 0
    assert all(r["weight"] <= 0 or r["n_features"] for r in rows(resampling.resample(docs, target.limit(0))))


def test_long_texts_go_in_parts(monkeypatch):
    text = "One two, three. FOUR five\x00six éé seven " * 50 + "last"
    whole = [sorted(b.tolist()) for _, b in resampling.features(pa.array([text]), 3, 997)]
    monkeypatch.setattr(resampling, "SLICE_BYTES", 64)
    monkeypatch.setattr(resampling.pieces, "__defaults__", (64,))
    parts, found = list(resampling.slices(pa.array(["short", text, None, "end"]), 3)), defaultdict(list)
    assert max(len(x.encode()) for _, texts, _ in parts for x in texts.to_pylist() if x) < 128 and len(parts) > 10
    for row, texts, repeated in parts:
        for k, (at, b) in enumerate(resampling.features(texts, 3, 997, repeated)):
            for i, bucket in zip(at.tolist(), b.tolist(), strict=True):
                found[row + i, k].append(bucket)
    assert [sorted(found[1, k]) for k in range(3)] == whole
    assert len(found[0, 0]) == len(found[3, 0]) == 1 and not found[2, 0]
