"""Stages keep the user's columns whatever they are called."""

import re
from pathlib import Path

import pytest

import corpus_pipeline
from lodestar.llm import simhash

LLM = Path(corpus_pipeline.__file__).parent / "lodestar" / "llm"
#: All names of columns that the operators of the stages write in their code.
INTERNAL = sorted({n for f in ("common", "language", "simhash", "shingles", "graph", "decontaminate", "secrets") for n in re.findall(r'"(_?[a-z][a-z_]*)"', (LLM / f"{f}.py").read_text())} | {"_assign", "_access", "_hex", "_random", "_may_assign", "_may_random", "_secrets", "_lang", "_likeness", "_row"})
TAKEN = ("doc_id", "text", "lang", "source", "n_chars")


@pytest.fixture(scope="module")
def docs(spark):
    names = [n for n in INTERNAL if n not in TAKEN]
    texts = ["the quick brown fox jumps over the lazy dog and runs away from here at once", "a password = hunter2secret stands in this text that is long enough to be known", "and another text about nothing in particular but with words of the same language"]
    rows = [(i, t, "en", "s", len(t), *[f"{n}-{i}" for n in names], (i, "x")) for i, t in enumerate([*texts, texts[0]])]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names) + ", `a struct` struct<a:int,b:string>")


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]] + [lambda spark, docs, sf_dir: simhash.keep_one(docs)], ids=[n for n, _ in corpus_pipeline.STAGES[:-1]] + ["simhash"])
def test_columns_of_any_name_stay_as_they_are(spark, docs, stage):
    given = {r["doc_id"]: r for r in docs.collect()}
    out = stage(spark, docs, "/root/testdata/sf0.001")
    assert out.columns == docs.columns and len(docs.columns) > 60
    rows = out.collect()
    assert len(rows) >= 3
    for r in rows:
        for c in docs.columns:
            assert r[c] == given[r["doc_id"]][c] or (c in ("text", "n_chars") and r["doc_id"] == 1)
