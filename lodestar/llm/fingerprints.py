"""Document fingerprints by consistent weighted sampling, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, numbered

#: Samples in a fingerprint, and the hex digits that each takes in it.
SAMPLES, DIGITS = 32, 8
_LOW = 0xFFFFFFFF


def hashed_words(text: Column) -> Column:
    """Sorted array of the XXH64 of each word of a text, repeats included; words are what blanks part."""
    hashes = F.transform(F.split(text, "[ \\t-\\r]+"), lambda w: F.xxhash64(w))
    return F.sort_array(F.array_remove(hashes, F.xxhash64(F.lit(""))))


def weighted_terms(texts: DataFrame, by: list[str], hashes: str) -> DataFrame:
    """(by, h, w): each distinct hash of a sorted array column and how often it stands there; (0, 1) for an empty one.

    The weight of a hash is the distance between the places where its run and the next begin. Arrays that a lambda or two
    expressions need are columns of their own, so that each is made once a row.
    """
    beside = F.arrays_zip(F.col(hashes).alias("x"), F.concat(F.array(F.lit(None).cast("long")), F.col(hashes)).alias("before"))
    starts = F.array_compact(F.transform(beside, lambda z, i: F.when(z["x"] == z["before"], F.lit(None)).otherwise(i)))
    placed = texts.select(*by, hashes, starts.alias("_starts"))  # the last start is the end of the last run
    weights = F.zip_with(F.slice("_starts", 1, F.size("_starts") - 1), F.slice("_starts", 2, F.size("_starts")), lambda a, b: b - a)
    none = F.array(F.struct(F.lit(0).cast("long").alias("h"), F.lit(1).alias("w")))
    return placed.select(*by, F.inline(F.when(F.size(hashes) > 0, F.arrays_zip(F.array_distinct(hashes).alias("h"), weights.alias("w"))).otherwise(none)))


def sample(h: Column, ln_w: Column, k: int) -> Column:
    """Sample k of a weighted term as one long, whose least value in a document is the document's sample.

    r and c are Gamma(2, 1), each from two uniforms, and beta is uniform, all from one hash of term and k;
    t = floor(ln w / r + beta), and the term with the least a = c exp(-r (t - beta + 1)) is drawn. ln a fills the high half of the long
    and an id of (term, t) the low half, so that one least long is both. Two documents draw the same (term, t) with the probability of
    their generalised Jaccard similarity: the sum of the least weights over that of the greatest.
    """
    x = F.xxhash64(h, F.lit(k))
    unit = lambda first, bits: (F.shiftrightunsigned(x, first).bitwiseAND(F.lit((1 << bits) - 1)).cast("double") + 0.5) * F.lit(2.0**-bits)
    c, r, beta = -F.log(unit(0, 14) * unit(14, 14)), -F.log(unit(28, 12) * unit(40, 12)), unit(52, 12)
    t = F.floor(ln_w / r + beta)
    ln_a = F.log(c) - r * (t - beta + 1.0)
    return F.shiftleft(((ln_a + 128.0) * 8388608.0).cast("long"), 32).bitwiseOR(h.bitwiseXOR(F.shiftleft(t, 8)).bitwiseAND(F.lit(_LOW)))


def fingerprints(texts: DataFrame, by: list[str], text: Column, samples: int = SAMPLES) -> DataFrame:
    """The columns `by` of texts and fingerprint, one row for each of their values: `samples` numbers of 8 hex digits, joined.

    Rows of equal `by` must have equal texts. Words become rows only between a row's array and the hash aggregate in the same task,
    which keeps one long a sample; so no word is shuffled, and a row of longs at most where texts are not dealt by a column of `by`.
    A task holds the hashes of one text at a time (about 100 bytes a word).
    """
    hashed = texts.select(*by, hashed_words(text).alias("_hashes"))
    terms = weighted_terms(hashed, by, "_hashes").withColumn("_ln_w", F.log(F.col("w").cast("double")))
    least = terms.groupBy(*by).agg(*(F.min(sample(F.col("h"), F.col("_ln_w"), k)).alias(f"_{k}") for k in range(samples)))
    return least.select(*by, F.concat(*(F.lower(F.lpad(F.hex(F.col(f"_{k}").bitwiseAND(F.lit(_LOW))), DIGITS, "0")) for k in range(samples))).alias("fingerprint"))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples of two fingerprints: 0 to 1, an estimate of the generalised Jaccard similarity of word counts."""
    at = lambda s, k: F.substring(s, k * DIGITS + 1, DIGITS)
    return sum(((at(a, k) == at(b, k)).cast("int") for k in range(samples)), F.lit(0)) / F.lit(float(samples))


def neighbours(docs: DataFrame) -> DataFrame:
    """(key, doc_id, n_chars, copies, next_key): each text of an id and what follows it in the order of doc_id, then of the text's digest.

    Equal rows stand in a row: all but the last are followed by themselves. So an id and text has one row, or two of which one has
    copies - 1. The last row is followed by the first. Only ids, digests and lengths are sorted, over all tasks.
    """
    known = cut(docs.groupBy("key", "doc_id", "dg", "n_chars").agg(F.count("*").alias("n")), "known")
    placed = numbered(known, [F.asc_nulls_first("doc_id"), F.asc("dg")], "place", "ordered").drop("dg")
    total = known.count()
    after = placed.select(((F.col("place") - 1 + total) % F.lit(max(total, 1))).alias("place"), F.col("key").alias("next_key"))
    ways = F.array(
        F.struct(F.lit(1).cast("long").alias("copies"), F.col("next_key")),
        F.struct((F.col("n") - 1).alias("copies"), F.col("key").alias("next_key")),
    )
    return placed.join(after, "place").select("key", "doc_id", "n_chars", F.inline(F.filter(ways, lambda w: w["copies"] > 0)))


def document_fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row of docs.

    The edited text is the text whose last half (rounded down) gives way to as much of the start of the next document's. Null text is
    empty; texts without words are alike and like no other; rows of one id follow each other by the MD5 of their texts, equal rows give
    equal results but for the last of them; a single row follows itself; other columns are ignored and an empty table gives no rows.

    Texts are shuffled once, by a digest of id and text, equal rows as one, and at most half of each once more to the document before
    it. Everything that grows with the words of a text stays in the task that holds the text.
    """
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("dg", F.md5("text"))
    keyed = keyed.withColumn("key", F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), "dg"))))
    texts = keyed.groupBy("key").agg(F.first("text").alias("text"))
    pairs = cut(neighbours(keyed.select("key", "doc_id", "dg", F.char_length("text").cast("long").alias("n_chars"))), "pairs")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    next_text = texts.select(F.col("key").alias("next_key"), F.col("text").alias("next_text"))
    ends = pairs.join(next_text.hint("merge"), "next_key").select(*pairs.columns, F.substring(F.col("next_text"), F.lit(1), half).alias("end"))
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")), F.col("end"))
    both = texts.join(ends.hint("merge"), "key").select(*pairs.columns, "text", edited.alias("edited"))
    told = both.select(*pairs.columns, F.sha2("edited", 256).alias("edited_sha256"), F.posexplode(F.array("text", "edited")).alias("which", "own"))
    by = [*pairs.columns, "edited_sha256"]
    marks = fingerprints(told, [*by, "which"], F.col("own"), samples)
    of = lambda which: F.max(F.when(F.col("which") == which, F.col("fingerprint")))
    found = cut(marks.groupBy(*by).agg(of(0).alias("fingerprint"), of(1).alias("edited_fingerprint")), "marks")
    others = found.groupBy(F.col("key").alias("next_key")).agg(F.max("fingerprint").alias("next_fingerprint"))
    result = found.join(others, "next_key").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint"), samples).alias("near_next"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy"),
    )
    return result.drop("_copy")
