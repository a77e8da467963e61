"""Bounds of memory, rounds of edits, archives of others, and plain versions over whole tables."""

import hashlib
import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestar.llm import common, decontaminate, embeddings, language, packing, quality, queries, sharding, tokens, warc

SMALL = "/root/testdata/sf0.001"


def peak_mb(work):
    tracemalloc.start()
    out = work()
    peak = tracemalloc.get_traced_memory()[1] / 2**20
    tracemalloc.stop()
    return out, peak


# --- sharding


def test_no_shard_is_lost(spark):
    df = sharding.assign_shards(spark.range(1000).withColumnRenamed("id", "k"), "k", [1.0] * 40)
    assert sharding.add_slots(df, "k", 40).count() == 1000
    with pytest.raises(Exception, match="shard outside"):
        sharding.add_slots(df, "k", 1).collect()


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://somewhere:7077"

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        common.shared_dir(Session())


# --- embeddings


def test_pairs_at_the_threshold_follow_the_cosine_of_the_vectors_as_they_are(spark):
    rng = np.random.default_rng(8)
    items = []
    for k in range(400):
        a, b = rng.normal(size=(2, 16))
        b -= a * (a @ b) / (a @ a)
        c = 0.93 + rng.integers(-4, 5) * 1e-13
        items += [(2 * k, a.tolist(), k), (2 * k + 1, (c * a / np.linalg.norm(a) + math.sqrt(1 - c * c) * b / np.linalg.norm(b)).tolist(), k)]
    got = {r["vec_id"]: r["n_links"] for r in embeddings.near_duplicate_vectors(spark.createDataFrame(items, "vec_id long, embedding array<double>, label int")).collect()}
    for k in range(400):
        x, y = (np.array(items[2 * k + i][1]) for i in (0, 1))
        assert got[2 * k] == int((x * y).sum() / (math.sqrt((x * x).sum()) * math.sqrt((y * y).sum())) >= 0.93)


def test_links_of_a_strip_join_what_all_pairs_join():
    rng = np.random.default_rng(1)
    linked = rng.random((60, 60)) < 0.015
    weight = rng.integers(1, 4, 60)
    found = embeddings.Links(weight)
    for at in range(0, 60, 20):
        found.add(np.arange(at, at + 20), np.arange(60), np.triu(linked, 1)[at : at + 20])
    i, j = np.nonzero(np.triu(linked, 1))
    assert (found.roots() == common.components(60, i, j)).all()
    assert found.count.tolist() == [int(weight[j[i == k]].sum() + weight[i[j == k]].sum()) for k in range(60)]


# --- archives


def test_records_of_other_archives(tmp_path):
    import gzip

    def raw(kind, block, length=True, name="<urn:uuid:5d1e0a4c-0000-4000-8000-000000000001>", more=""):
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {name}\r\n{more}".encode() + (f"Content-Length: {len(block)}\r\n".encode() if length else b"") + b"\r\n" + block + (b"\r\n\r\n" if length else b"")

    page = warc.record(7, "u", b"p" * 300, hashlib.sha256(b"p" * 300).hexdigest(), None, False)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<html>"
    members = [gzip.compress(raw("warcinfo", b"software: x\r\n")), gzip.compress(raw("request", b"GET / HTTP/1.1\r\n\r\n", more="Content-Type: application/http;\r\n msgtype=request\r\n") + raw("metadata", b"a: b")), gzip.compress(raw("response", http, False, more="Content-Type: application/http\r\nWARC-Target-URI: http://a\r\n")), page, page[:-30]]
    data = b"".join(members)
    read = lambda split, broken: [r for a in range(0, len(data), split) for r in warc.records(pa.BufferReader(data), len(data), a, min(len(data), a + split), broken)]
    for split in (5, 64, len(data)):
        got = read(split, True)
        assert [r["record_type"] for r in got] == ["warcinfo", "request", "metadata", "response", "response", "broken"]
        assert [r["page_id"] for r in got] == [None] * 4 + [7, None] and got[3]["payload"] == b"<html>" and got[0]["record_id"].startswith("<urn:uuid:")
        assert len(read(split, False)) == 5
    assert warc.header(b"WARC/1.junk\r\n\r\n") is None and warc.header(b"WARC/1.0\r\nno field\r\n\r\n") is None


def test_archives_inside_archives_give_the_same_rows_at_every_split_size(spark, tmp_path):
    rng = np.random.default_rng(11)
    made = lambda i, html: warc.record(i, "u", html, hashlib.sha256(html).hexdigest(), None, False)
    inner = b"".join(made(100 + i, rng.bytes(n)) for i, n in enumerate((900, 40_000, 300, 120_000, 500)))
    # Twice inside: an archive in an archive in an archive; and an archive that is cut short.
    deeper = made(200, inner) + made(201, rng.bytes(2000))
    data = [made(1, b"p" * 300), made(2, inner), made(3, b"q" * 300), made(4, deeper), made(5, inner[:-200]), made(6, b"r" * 300)]
    path = tmp_path / "nested.warc.gz"
    path.write_bytes(b"".join(data))
    plain = tmp_path / "plain.warc.gz"
    plain.write_bytes(data[0] + data[5])
    files = spark.createDataFrame([(f"file://{p}", p.stat().st_size) for p in (path, plain)], "path string, bytes long")
    read = lambda split, **more: sorted((r["page_id"], r["record_type"], r["payload_bytes"], r["payload_digest"]) for r in warc.read_archives(files, split, **more).collect())
    whole = read(1 << 30)
    assert [r[:2] for r in whole] == [(i, "response") for i in (1, 1, 2, 3, 4, 5, 6, 6)]
    # A range by itself does show what lies inside.
    ends = path.stat().st_size
    assert any((r["page_id"] or 0) >= 100 for a in range(0, ends, 4096) for r in warc.records(pa.BufferReader(path.read_bytes()), ends, a, min(ends, a + 4096)))
    for split in (4096, 50_000, 65_536):
        assert read(split) == whole
    assert read(4096, payload=False) == whole


# --- benchmarks


def test_blocks_of_a_benchmark_are_passes_of_their_own(spark, monkeypatch):
    from test_llm import plain_contamination

    monkeypatch.setattr(decontaminate, "WORD_BYTES", 400)
    rng = np.random.default_rng(6)
    say = lambda n: " ".join(f"w{i}" for i in rng.integers(0, 40, n))
    items = [(i, say(int(rng.integers(5, 60)))) for i in range(60)] + [(100, say(900)), (101, None), (102, "w1 w2")]
    texts = [say(20) + " " + " ".join(items[i % 61][1].split()[3:40]) + " " + say(20) for i in range(60)] + [None, "", items[60][1]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(i % 50, t, i) for i, t in enumerate(texts)], "doc_id long, text string, items long")
    n, block = decontaminate.benchmark_blocks(bench, 1)
    assert n >= 3 and all(sum(len(t.split()) for _, t in block(i)) <= 640 for i in range(n))
    docs = docs.withColumnRenamed("items", "place")
    got = {r["place"]: r for r in decontaminate.find_contamination(docs, bench, block_bytes=1).collect()}
    for i, t in enumerate(texts):
        want = plain_contamination(items, t)
        assert (got[i]["n_words"], sum(h["end"] - h["start"] for h in got[i]["hits"]), got[i]["items"]) == want, i


def test_a_matcher_stays_in_its_bytes():
    rng = np.random.default_rng(0)
    n = 60000
    for text in (" ".join(f"{i:x}" for i in rng.integers(0, 2**40, n)), " ".join(f"w{i}" for i in rng.integers(0, 500, n)), "a " * n):
        matcher, mb = peak_mb(lambda: decontaminate.Matcher([("x", text)]))  # noqa: B023
        assert mb * 2**20 / n < decontaminate.WORD_BYTES and matcher.occurrences(decontaminate.words(text))[0] == [(0, n)]


# --- packing


def test_groups_of_tiny_pieces_stay_small():
    sizes = [1] * 262_144
    together, mb = peak_mb(lambda: packing.bundles(sizes))
    assert len(together) <= 2 * sum(sizes) / packing.BUNDLE + 1 and sum(map(len, together)) == len(sizes)
    rng = np.random.default_rng(0)
    mixed = sorted(rng.integers(1, 60, 5000).tolist(), reverse=True)
    found, mb = peak_mb(lambda: packing.windows([sum(mixed[i] for i in x) for x in packing.bundles(mixed)], 2048))
    assert mb < 64 and len(found) <= -(-sum(mixed) // 2048) + 1


def test_many_empty_documents(spark):
    docs = spark.range(300_000).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    got = packing.pack_documents(docs, queries.tokenizer()).groupBy("sequence_id").agg(F.count("*").alias("n"), F.countDistinct("offset").alias("places"), F.max("offset").alias("last")).collect()
    assert sum(r.n for r in got) == 300_000 and len(got) <= 300_000 / 2048 + 4 and all(r.n == r.places == r.last + 1 <= 2048 for r in got)


# --- rounds of edits


def test_five_rounds_of_edits_match_counting_anew(spark):
    from tokenizers import Tokenizer

    path = queries.tokenizer()
    plain = Tokenizer.from_file(path)
    words = tokens.pre_tokens(path)
    rng = np.random.default_rng(9)
    texts = [r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()[:120]]
    texts += ["", "a", "<|endoftext|> a<|endoftext|>", "word <|endo" + "ftext|> more " * 30, "語言模型。" * 200, "x" * 3000, "it's  \n\n a 12 test!! " * 60]
    new = ["", " ", "new words", "\n", "<|endoftext|>", "endoftext|>", "<|", "'s", "12", "  ", "語"]
    encoded = total = 0
    for text in texts:
        chars, toks = words.leaves(text)
        for _ in range(5):
            edits, at = [], int(rng.integers(0, 40))
            while at <= len(text) and len(edits) < 6:
                end = min(len(text), at + int(rng.choice([0, 1, 3, 40])))
                edits.append((at, end, new[rng.integers(len(new))]))
                at = end + int(rng.integers(0, 300))
            got = tokens.recount(text, chars, toks, edits, words)
            after, at = "", 0
            for a, b, x in edits:
                after += text[at:a] + x
                at = b
            text = after + text[at:]
            chars, toks = got["chars"], got["tokens"]
            assert (got["n_chars"], got["n_tokens"]) == (len(text), len(plain.encode(text, add_special_tokens=False).ids))
            assert [c.tolist() for c in words.leaves(text)] == [chars.tolist(), toks.tolist()]
            encoded, total = encoded + got["encoded"], total + len(text)
    assert encoded < total


# --- plain versions over whole tables


def plain_features(text, n_chars):
    words = (text or "").split()
    counts, lines, marks = Counter(words), (text or "").split("\n"), re.findall(r"[^\w\s]+", text or "")
    n, m = max(1, len(text or "")), max(1, len(words))
    stats = [sum(w.isupper() for w in words) / m, sum(w.isdigit() for w in words) / m, min(1, 4 * len("".join(marks)) / n), min(1, 2 * len(words) / n), counts["|"] / m, sum(len(x) > 1 for x in marks) / m if len(marks) < m else 1, min(1, len("".join(words)) / m / 16), 1 - len(counts) / m, 1 - len(set(lines)) / len(lines), min(1, m / len(lines) / 100), min(1, math.log1p(len(words)) / 12), min(1, math.log1p(max(0, n_chars or 0)) / 14)]
    size = math.sqrt(sum(math.log1p(c) ** 2 for c in counts.values())) or 1
    out = [(zlib.crc32(w.lower().encode()) % quality.WORDS, math.log1p(c) / size) for w, c in counts.items()]
    return out + [(quality.WORDS + quality.BINS * i + min(quality.BINS - 1, int(s * quality.BINS)), 1.0) for i, s in enumerate(stats)] + [(quality.SIZE - 1, 1.0)]


def test_quality_scores_match_all_pairs_of_plain_features(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    machine = quality.fit(docs, labels.where(common.crc_remainder("doc_id", 3) != 1))
    got = {r.doc_id: r for r in queries.op3_quality(spark, SMALL).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        x = plain_features(r.text, r.n_chars)
        gram = machine.v[[i for i, _ in x]] @ machine.v[[i for i, _ in x]].T
        v = np.array([v for _, v in x])
        pairs = (np.triu(gram, 1) * np.outer(v, v)).sum()
        z = machine.bias + sum(machine.w[i] * a for i, a in x) + pairs
        assert got[r.doc_id].score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)


def plain_ngrams(text):
    found = Counter()
    for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
        padded = [0, *map(ord, word), 0]
        found.update((c,) for c in padded[1:-1])
        found.update(zip(padded, padded[1:]))
        found.update(zip(padded, padded[1:], padded[2:]))
    return found


def plain_code(gram):
    return gram[0] if len(gram) == 1 else (gram[0] << 21 | gram[1]) + (1 << 62) if len(gram) == 2 else gram[0] << 42 | gram[1] << 21 | gram[2]


def plain_ranks(counts, k=400):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], (plain_code(x[0]) + 2**63) % 2**64 - 2**63))][:k]


def test_languages_match_a_plain_version_over_the_whole_table(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    counts = {}
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.lang is not None and r.text is not None:
            counts.setdefault(r.lang, Counter()).update(plain_ngrams(r.text))
    profiles = {lang: {g: i for i, g in enumerate(plain_ranks(c))} for lang, c in counts.items()}
    got = {r.doc_id: r for r in queries.op4_language(spark, SMALL).collect()}
    for r in rows:
        own = plain_ranks(plain_ngrams(r.text))
        if not own:
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0)
            continue
        distance = {lang: sum(min(400, abs(p[g] - i)) if g in p else 400 for i, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(sorted(distance), key=distance.get)
        assert got[r.doc_id].lang_pred == best and got[r.doc_id].score == pytest.approx(1 - distance[best] / 400 / len(own))
