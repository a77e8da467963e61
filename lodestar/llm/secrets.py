"""Secret scans with DataFrame functions only: patterns, and character Markov models compared by log-likelihood ratio."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import all_matches, any_columns, running, spans

# The base patterns, the group that is judged, and its least length, in the order of their kinds.
BASE = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
#: The same matches found faster: runs that can't pass are never matched. (Not so for assign, where a failing match hides others.)
SCAN = BASE | {"access": (r"AKIA[A-Z0-9]{16,}", 0, 20), "hex": (r"[0-9a-f]{24,}", 0, 24)}
KINDS = (*BASE, "random")
#: Characters of the models; strings that are compared, and by how much a character must be likelier in random strings on average.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
CANDIDATE, MARGIN = r"[A-Za-z0-9+/_-]{20,}", 1.0
#: Names by form, not chance: numbered identifiers in groups of 8-4-4-4-12 hex digits.
NAMED = r"^[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$"
#: Strings that teach the random model; pairs that each model has seen of every kind before.
FIT_STRINGS, PRIOR = 2000, 0.5

SPAN = "array<struct<start:int,rank:int,end:int>>"
#: A run of CANDIDATE, tried once a run: every match of access, hex and random lies in one.
_LONG_RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20}"


def guards(text: Column) -> dict[str, Column]:
    """For each kind, a cheap test that all texts with a match pass: key words for assign, a long run for the others."""
    long_run, lower = text.rlike(_LONG_RUN), F.lower(text)
    named = lower.contains("passw") | lower.contains("secret") | lower.contains("token") | lower.contains("api")
    return {kind: named if kind == "assign" else long_run for kind in KINDS}


def with_matches(docs: DataFrame) -> DataFrame:
    """docs with _assign, _access, _hex and _random: the text of each kind's matches, each found in one pass over the texts that pass its guard."""
    tested = docs.withColumns({f"_may_{kind}": guard for kind, guard in guards(F.col("text")).items() if kind in ("assign", "random")})
    pattern = {kind: SCAN[kind][0] for kind in BASE} | {"random": CANDIDATE}
    found = {f"_{kind}": all_matches(F.col("text"), pattern[kind], F.col("_may_assign" if kind == "assign" else "_may_random")) for kind in KINDS}
    return tested.withColumns(found).drop("_may_assign", "_may_random")


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of each base kind in rows of with_matches. The judged group is taken from the match itself, which the pattern matches alike alone."""
    judged = lambda s, pattern, group: F.regexp_extract(s, pattern, group) if group else s
    return {kind: spans(text, pattern, lambda s, p=pattern, g=group, least=least: F.length(judged(s, p, g)) >= least, F.col(f"_{kind}")) for kind, (pattern, group, least) in SCAN.items()}


def pair_counts(strings: DataFrame) -> Counter:
    """How often each pair of characters of ALPHABET stands together in strings (one column s): at most len(ALPHABET) ** 2 rows reach the driver."""
    known = strings.groupBy("s").agg(F.count("*").alias("n"))
    pairs = known.select("n", F.split("s", "").alias("c")).where("size(c) > 1").select("n", F.explode(F.transform(F.sequence(F.lit(1), F.size("c") - 1), lambda i: F.concat(F.element_at("c", i), F.element_at("c", i + 1)))).alias("pair"))
    return Counter({r[0]: r[1] for r in pairs.groupBy("pair").agg(F.sum("n")).where(F.col("pair").rlike("^[A-Za-z0-9+/_-]{2}$")).collect()})


def transitions(counts: Counter) -> list[float]:
    """log P(second | first) by place in ALPHABET, row after row."""
    n = {a: sum(counts[a + b] for b in ALPHABET) + PRIOR * len(ALPHABET) for a in ALPHABET}
    return [math.log((counts[a + b] + PRIOR) / n[a]) for a in ALPHABET for b in ALPHABET]


def random_strings(spark, n: int = FIT_STRINGS, first: int = 0) -> DataFrame:
    """Labelled samples of the random class: n base64, hex and upper-case key strings each, from digests of first, first + 1, ..."""
    digest = F.sha2(F.col("id").cast("string").cast("binary"), 256)
    upper = F.upper(F.regexp_replace(F.base64(F.unhex(digest)), "[^A-Za-z0-9]", ""))
    return spark.range(first, first + n).select(F.explode(F.array(F.regexp_replace(F.base64(F.unhex(digest)), "=", ""), digest, upper)).alias("s"))


#: Strings of ALPHABET that are words by form: up to three humps, or words, paths and short numbers joined by marks.
_WORDY = r"^(?:(?:[A-Za-z]?[a-z_-]+|[A-Z_-]+){1,3}|(?:/?(?:[A-Za-z]?[a-z]+|[A-Z]+|[0-9]{1,4})(?:[/_+-]|$)){1,12})$"
#: ASCII characters outside ALPHABET.
_MARKS = "".join(chr(i) for i in range(1, 128) if chr(i) not in ALPHABET)


def ordinary_strings(docs: DataFrame) -> DataFrame:
    """The ordinary class: the distinct strings between ASCII marks in all texts that are identifiers, words, paths or names by form, each once.

    Texts are not shuffled, only their distinct strings; no copy, however often it stands in the corpus, outweighs the others.
    (translate and a split at a blank take a tenth of the time of a split by pattern.)
    """
    words = docs.select(F.explode(F.split(F.translate("text", _MARKS, " " * len(_MARKS)), " ")).alias("s")).where(F.length("s") >= 3)
    return words.distinct().where(F.col("s").rlike(_WORDY) & F.col("s").rlike("[A-Za-z]{2}") & ~F.col("s").rlike("|".join(SCAN[kind][0] for kind in ("access", "hex"))))


def fit(docs: DataFrame, ordinary: DataFrame | None = None) -> list[float]:
    """Log-likelihood ratio, random to ordinary, of each transition between characters of ALPHABET. ordinary: labelled strings (s) instead of those of docs."""
    random, plain = (transitions(pair_counts(s)) for s in (random_strings(docs.sparkSession), ordinary_strings(docs) if ordinary is None else ordinary))
    return [round(a - b, 4) for a, b in zip(random, plain, strict=True)]


def likeness(s: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio of a string's transitions."""
    table = F.lit(",".join(map(str, model)))
    table = F.split(table, ",").cast("array<double>")
    place = F.transform(F.split(s, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    n = F.size(place) - 1
    steps = F.zip_with(F.slice(place, 1, n), F.slice(place, 2, n), lambda a, b: F.element_at(table, a * len(ALPHABET) + b + 1))
    return F.aggregate(steps, F.lit(0.0), lambda acc, x: acc + x) / n


def find_secrets(docs: DataFrame, model: list[float] | None = None, margin: float = MARGIN) -> DataFrame:
    """docs with secrets: array of (start, rank, end) by start, then kind in the order of KINDS; code points, end exclusive.

    Base patterns give kinds assign, access and hex; candidate strings that the models find likelier random than ordinary give
    kind random, which may lie over a base span. Null text has none. A column named secrets is replaced, all others stay.
    """
    model = fit(docs) if model is None else model
    kept = [c for c in docs.columns if c != "secrets"]
    looksrandom = lambda s: ~s.rlike(NAMED) & (likeness(s, model) > margin)
    found = base_spans(F.col("text")) | {"random": spans(F.col("text"), CANDIDATE, looksrandom, F.col("_random"))}
    with_rank = lambda own, i: F.transform(own, lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("rank"), s["end"].alias("end")))
    ranked = [with_rank(found[kind], i) for i, kind in enumerate(KINDS)]
    none = F.expr(f"cast(array() as {SPAN})")
    some = F.size("_assign") + F.size("_access") + F.size("_hex") + F.size("_random") > 0
    return with_matches(docs.select(*kept)).withColumn("secrets", F.when(some, F.array_sort(F.concat(*ranked))).otherwise(none)).select(*docs.columns, *(["secrets"] if len(kept) == len(docs.columns) else []))


def listed(secrets: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(",", F.transform(secrets, lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["rank"] + 1), s["start"], s["end"])))


def secrets_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row; other columns are ignored, an empty table gives no rows."""
    found = find_secrets(docs.select("doc_id", "text"))
    count = lambda i: F.size(F.filter("secrets", lambda s: s["rank"] == i)).cast("long")
    base = F.filter("secrets", lambda s: s["rank"] < len(BASE))
    return found.select("doc_id", *(count(i).alias(f"n_{kind}") for i, kind in enumerate(BASE)), F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"))


@any_columns("text", "n_chars")
def redact(docs: DataFrame, placeholder: str = "[SECRET]") -> DataFrame:
    """docs, all columns, with the union of each document's spans replaced; n_chars follows where there is such a column. Other texts stay as they are."""
    found = find_secrets(docs)
    ends = running(F.transform("secrets", lambda s: s["end"]), F.lit(0), lambda acc, x: F.greatest(acc, x))
    placed = F.transform(F.arrays_zip(F.col("secrets").alias("s"), ends.alias("b")), lambda z: F.struct(z["b"].alias("before"), z["s"]["start"].alias("start")))
    text = F.col("text")
    # A span that starts within the one before adds nothing; any other adds the text between and one placeholder.
    parts = F.transform(placed, lambda p: F.when(p["start"] >= p["before"], F.concat(F.substring(text, p["before"] + 1, p["start"] - p["before"]), F.lit(placeholder))).otherwise(F.lit("")))
    rest = F.substring(text, F.array_max(F.transform("secrets", lambda s: s["end"])) + 1, F.length(text))
    out = found.withColumn("text", F.when(F.size("secrets") > 0, F.concat(F.array_join(parts, ""), rest)).otherwise(text)).drop("secrets")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(docs.columns)
