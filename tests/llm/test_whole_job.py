"""Cases where an operator once did less than its whole job."""

import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import packing, quality, queries, secrets, shingles, simhash, tokens

DATA = "/root/testdata/sf0.01"


# --- near copies by shingles


def plain_shingles(text):
    words = (text or "").lower().encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_kept(items, least=0.8):
    """The smallest id of each component of (id, text) items."""
    sets, root = [plain_shingles(t) for _, t in items], list(range(len(items)))
    find = lambda i: i if root[i] == i else find(root[i])
    for a, b in combinations(range(len(items)), 2):
        if (len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])) and bool(sets[a]) == bool(sets[b]):
            root[find(a)] = find(b)
    return {min(i for k, (i, _) in enumerate(items) if find(k) == r) for r in {find(k) for k in range(len(items))}}


@pytest.mark.parametrize("part", [1 << 19, 150])
def test_pipeline_drops_near_copies_of_similarity_08(spark, monkeypatch, part):
    import corpus_pipeline

    monkeypatch.setattr(shingles, "PART", part)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    items = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    kept = {r[0] for r in corpus_pipeline.near_dedup(spark, docs, DATA).select("doc_id").collect()}
    assert kept == plain_kept(items)
    # Alike at 0.81 and 0.84, but more than 4 bits apart.
    assert {709, 643} <= kept and not {944, 770} & kept


def test_links_join_what_all_pairs_join():
    rng = np.random.default_rng(4)
    base = [rng.integers(0, 2**62, 60).astype(np.uint64) for _ in range(4)]
    sets = [np.unique(np.r_[base[i % 3 if i % 2 else 3][rng.permutation(60)[: 60 - i % 9]], rng.integers(0, 2**62, i % 5).astype(np.uint64)]) for i in range(120)]
    want = [(i, j) for i, j in combinations(range(120), 2) if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))]
    from lodestar.llm.common import components

    a, b = np.array(want).T
    assert (components(120, *shingles.links(sets)) == components(120, a, b)).all()


# --- rows that share an id, or have none


@pytest.mark.parametrize("keep_one", [simhash.keep_one, shingles.keep_one])
def test_one_row_of_each_component_is_kept_by_row(spark, keep_one):
    say = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    items = [(1, say(0)), (5, say(0)), (5, say(1)), (5, say(2)), (5, say(2)), (9, say(2)), (None, say(3)), (None, say(3)), (None, say(1)), (None, say(4)), (7, None), (8, " "), (None, "")]
    df = spark.createDataFrame([(*x, "extra") for x in items], "doc_id long, text string, more string")
    got = keep_one(df)
    want = [(1, say(0)), (5, say(1)), (5, say(2)), (7, None), (None, say(3)), (None, say(4))]
    assert got.columns == df.columns and sorted((tuple(r)[:2] for r in got.collect()), key=str) == sorted(want, key=str)
    assert keep_one(df.limit(0)).collect() == []


# --- the ordinary class


def test_ordinary_model_counts_all_texts(spark):
    """Every text teaches, and each of its strings once, however many copies of it there are."""
    letters = F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")
    docs = spark.range(2500).select(F.concat(F.lit("qzv"), letters, F.lit(" "), F.col("id").cast("string")).alias("text"))
    copies = spark.range(20000).select(F.lit("some shared words").alias("text"))
    counts = secrets.pair_counts(secrets.ordinary_strings(docs.unionAll(copies)))
    assert counts["qz"] == 2500 and counts["sh"] == 1


# --- added tokens


def test_added_tokens_in_a_text_have_their_ids(spark):
    from tokenizers import Tokenizer

    path = queries.tokenizer()
    plain = Tokenizer.from_file(path)
    reference = lambda s: plain.encode(s, add_special_tokens=False).ids
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|><|endoftext|>\n y", "<|endoftext", "word " * 200 + "a<|endoftext|> b " + "word " * 200]
    for text in texts:
        assert tokens.encode(path, text) == reference(text)
    assert 50256 in reference(texts[0])
    df = spark.createDataFrame([(i, t, [(0, 1, "<|endoftext|> ")]) for i, t in enumerate(texts)], "doc_id long, text string, edits array<struct<start:int,end:int,replacement:string>>")
    packed = {r["doc_id"]: r for r in packing.pack_documents(df, path).collect()}
    counted = {r["doc_id"]: r for r in tokens.apply_edits(tokens.build_trees(df, path), path).collect()}
    for i, text in enumerate(texts):
        ids = np.array([*reference(text), 1], "<u4")
        assert (packed[i]["doc_tokens"], packed[i]["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))
        assert (counted[i]["n_tokens"], counted[i]["n_tokens_edited"]) == (len(ids) - 1, len(reference("<|endoftext|> " + text[1:])))


# --- the labelled sample


def test_an_id_on_many_rows_teaches_once(spark):
    docs = spark.range(500).select(F.when(F.col("id") < 400, 1).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit(9).alias("n_chars"))
    labels = spark.range(500).select(F.when(F.col("id") < 50, 1).otherwise(F.col("id")).alias("doc_id"), F.lit(1).alias("quality"))
    got = Counter(r["doc_id"] for r in quality.labelled(docs, labels).collect())
    assert set(got) == {1, *range(400, 500)} and set(got.values()) == {1}
    few = [[tuple(r) for r in quality.labelled(docs.repartition(n, "text"), labels.repartition(n, "doc_id")).orderBy("doc_id").collect()] for n in (2, 7)]
    assert few[0] == few[1]
