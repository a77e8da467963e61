"""Byte-level BPE ids and edit-aware token counts.

The vocabulary is a tokenizer file in the tokenizers format, whose path is a parameter. Its merges are run by tiktoken, which
gives the same ids as the tokenizers library at several times its speed (tests compare the two).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from .common import all_matches, spans

# Fixed value: the pre-token pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space as that pattern means it (the white space of Unicode); Python's has four control characters more.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Pre-tokens whose counts a worker remembers (at most 40 code points each: some 40 MB).
REMEMBERED = 1 << 18


@lru_cache(maxsize=2)
def encoder(path: str):
    """The encoder of a byte-level BPE file, with the file's added tokens."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    if any(t.get(k) for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")) or any(re.search(r"\s", t) for t in special):
        raise ValueError("added tokens with white space or with rules of their own are not supported")
    ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def encode(path: str, text: str) -> list[int]:
    """The ids that the tokenizers library gives with add_special_tokens=False: a string of an added token in the text is that token."""
    return encoder(path).encode(text, allowed_special="all")


class PreTokens:
    """Cuts texts to pre-tokens and counts the tokens of each. An added token is a pre-token of its own."""

    def __init__(self, path: str):
        own = encoder(path)
        self.special = sorted(own.special_tokens_set, key=len, reverse=True)
        self.longest = max(map(len, self.special), default=0)
        self.encode = own.encode_ordinary
        self.around = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.find = regex.compile(PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"[^{_SPACE}\p{{L}}\p{{N}}]").replace(r"\s", f"[{_SPACE}]").replace(r"\S", f"[^{_SPACE}]")).findall
        self.known: dict[str, int] = dict.fromkeys(self.special, 1)

    def cut(self, text: str) -> list[str]:
        if self.around is None or not any(s in text for s in self.special):
            return self.find(text)
        return [w for i, part in enumerate(self.around.split(text)) for w in ([part] if i % 2 else self.find(part))]

    def count(self, words: list[str]) -> list[int]:
        """Tokens of each pre-token. At most REMEMBERED short ones are known at once."""
        out = [*map(self.known.get, words)]
        if None in out:
            new = {w: len(self.encode(w)) for w in {w for w, n in zip(words, out, strict=True) if n is None}}
            out = [new[w] if n is None else n for w, n in zip(words, out, strict=True)]
            if len(self.known) + len(new) > REMEMBERED:
                self.known = dict.fromkeys(self.special, 1)
            self.known.update((w, n) for w, n in islice(new.items(), REMEMBERED) if len(w) <= 40)
        return out

    def leaves(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Code points and tokens of each pre-token."""
        words = self.cut(text)
        return np.array(list(map(len, words)), np.int32), np.array(self.count(words), np.int32)


@lru_cache(maxsize=2)
def pre_tokens(path: str) -> PreTokens:
    return PreTokens(path)


class SegmentTree:
    """Sums of (code points, tokens) over the pre-tokens of one document, the leaves. Empty leaves are places without a pre-token."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.n = 1 << max(0, (len(chars) - 1).bit_length())
        self.sums = np.zeros((2, 2 * self.n), np.int64)
        self.sums[0, self.n : self.n + len(chars)], self.sums[1, self.n : self.n + len(tokens)] = chars, tokens
        self._update(self.n, 2 * self.n)

    def _update(self, low: int, high: int) -> None:
        """Sums of all nodes over places low to high."""
        while low > 1:
            low, high = low // 2, (high + 1) // 2
            self.sums[:, low:high] = self.sums[:, 2 * low : 2 * high : 2] + self.sums[:, 2 * low + 1 : 2 * high + 1 : 2]

    def leaves(self) -> np.ndarray:
        """(code points, tokens) of the pre-tokens in order, without the empty places."""
        own = self.sums[:, self.n :]
        return own[:, own[0] > 0]

    def replace(self, low: int, high: int, chars: np.ndarray, tokens: np.ndarray) -> None:
        """New pre-tokens for the leaves low to high. Where they fit in, only the sums above them change; else the tree gets more places."""
        if len(chars) > high - low:
            own = self.sums[:, self.n :]
            both = np.concatenate([own[:, :low], [chars, tokens], own[:, high:]], axis=1)
            self.__init__(*both[:, both[0] > 0])
            return
        own = self.sums[:, self.n + low : self.n + high]
        own[:] = 0
        own[:, : len(chars)] = chars, tokens
        self._update(self.n + low, self.n + high)


def _kind(c: str) -> str:
    return "space" if re.match(f"[{_SPACE}]", c) else "letter" if regex.match(r"\p{L}", c) else "number" if regex.match(r"\p{N}", c) else "mark"


def _sure(text: str, at: int) -> bool:
    """Whether pre-tokens end at this place whatever lies further off: the character before is no white space, the next is of another kind
    (after an apostrophe, no letter)."""
    if at in (0, len(text)):
        return True
    before, after = _kind(text[at - 1]), _kind(text[at])
    return before != "space" and before != after and not (text[at - 1] == "'" and after == "letter")


def recount(text: str, chars: np.ndarray, tokens: np.ndarray, edits: list[tuple[int, int, str]], words: PreTokens) -> dict:
    """Token count after edits (start, end, replacement; sorted, apart), given the pre-tokens of the text before.

    Each edit is widened to a region that begins and ends where pre-tokens end in any case, with at least one unchanged character,
    and as many as the longest added token has, between it and the edit. Regions that meet are one. Only a region is cut and
    encoded anew. Where a text has no such place (one long run of letters), the region is the run.
    """
    tree, ends = SegmentTree(chars, tokens), np.r_[0, np.cumsum(chars)]
    least = max(1, words.longest)
    regions: list[list] = []
    for edit in edits:
        low, high = np.searchsorted(ends, edit[0] - least, "right") - 1, np.searchsorted(ends, edit[1] + least)
        low, high = max(0, int(low)), min(len(ends) - 1, int(high))
        while low and not _sure(text, int(ends[low])):
            low -= 1
        while high < len(ends) - 1 and not _sure(text, int(ends[high])):
            high += 1
        if regions and low <= regions[-1][1]:
            regions[-1][1] = max(high, regions[-1][1])
            regions[-1][2].append(edit)
        else:
            regions.append([low, high, [edit]])
    encoded = 0
    # From the last region on, so that places before stay as they are.
    for low, high, own in reversed(regions):
        at, parts = int(ends[low]), []
        for start, stop, new in own:
            parts += [text[at:start], new]
            at = stop
        region = "".join(parts) + text[at : int(ends[high])]
        encoded += len(region)
        tree.replace(low, high, *words.leaves(region))
    new = tree.leaves()
    return {"chars": new[0], "tokens": new[1], "n_chars": int(tree.sums[0, 1]), "n_tokens": int(tree.sums[1, 1]), "encoded": encoded}


def clean_edits(edits: list[dict] | None, length: int) -> list[tuple[int, int, str]]:
    """Edits in order, clipped to the text; one that starts before the end of the one before is dropped, as are null bounds."""
    out, at = [], 0
    for e in sorted((e for e in edits or [] if e and e["start"] is not None and e["end"] is not None), key=lambda e: (e["start"], e["end"])):
        start, end = max(0, e["start"]), min(length, e["end"])
        if at <= start <= end:
            out.append((start, end, e["replacement"] or ""))
            at = max(end, at)
    return out


_INTS = pa.list_(pa.int32())


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *arrays]), pa.int32()))


def build_trees(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """docs with leaf_chars and leaf_tokens (code points and tokens of each pre-token, the leaves of the document's tree) and n_tokens.

    Null text has no leaf and no token. Columns of these names are replaced; all others stay, repeated rows too.
    """
    own = ["leaf_chars", "leaf_tokens", "n_tokens"]
    keep = [c for c in docs.columns if c not in own]
    docs = docs.select(*keep)

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = pre_tokens(tokenizer)
        for batch in batches:
            chars, tokens = zip(*(words.leaves(text.as_py() or "") for text in batch.column(text_col)), strict=True) if len(batch) else ([], [])
            yield pa.RecordBatch.from_arrays([*batch.columns, _lists(chars), _lists(tokens), pa.array([int(t.sum()) for t in tokens], pa.int64())], names=[*keep, *own])

    return docs.mapInArrow(leaves, StructType([*docs.schema.fields, *(StructField(c, ArrayType(IntegerType())) for c in own[:2]), StructField("n_tokens", LongType())]))


def apply_edits(trees: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", edits_col: str = "edits", leaves: bool = True) -> DataFrame:
    """Counts after edits from build_trees' rows with an edits column, array<struct<start, end, replacement>> in code points.

    Returns the id, n_tokens (before), n_edits, n_chars_edited, n_tokens_edited, n_encoded_chars (what was encoded anew), and, if
    leaves, the new leaf_chars and leaf_tokens: with the edited text they take the next edits. Null edits are none; see clean_edits
    for edits that overlap or lie outside the text.
    """

    def recounted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = pre_tokens(tokenizer)
        for batch in batches:
            rows = []
            for i in range(len(batch)):
                text, edits = batch.column(text_col)[i].as_py() or "", batch.column(edits_col)[i].as_py()
                chars, tokens = (np.zeros(0, np.int32) if (v := batch.column(c)[i].values) is None else v.to_numpy() for c in ("leaf_chars", "leaf_tokens"))
                todo = clean_edits(edits, len(text))
                rows.append({"n_edits": len(todo), **recount(text, chars, tokens, todo, words)})
            get = lambda k: pa.array([r[k] for r in rows], pa.int64())
            new = [_lists([r[c] for r in rows]) for c in ("chars", "tokens")] if leaves else []
            yield pa.RecordBatch.from_arrays([batch.column(id_col), batch.column("n_tokens"), get("n_edits"), get("n_chars"), get("n_tokens"), get("encoded"), *new], names=[f.name for f in schema])

    long = lambda c: StructField(c, LongType())
    schema = StructType([StructField(id_col, trees.schema[id_col].dataType), long("n_tokens"), long("n_edits"), long("n_chars_edited"), long("n_tokens_edited"), long("n_encoded_chars")])
    schema = StructType([*schema.fields, *(StructField(c, ArrayType(IntegerType())) for c in ("leaf_chars", "leaf_tokens") if leaves)])
    return trees.select(id_col, text_col, edits_col, "leaf_chars", "leaf_tokens", "n_tokens").mapInArrow(recounted, schema)


#: The edits of the registered query: long numbers are masked, a heading is put first, and some code points in the middle are cut out.
MASK, MASKED, HEADING, CUT = "[0-9]{6,}", "<number>", "Document: ", 12


def edited(docs: DataFrame) -> DataFrame:
    """doc_id, text and edits: an insertion, a deletion and the replacements of long numbers.

    HEADING is put before the text, CUT code points from half its length on are cut out (as many as there are), and each match of
    MASK is replaced. Of edits that overlap, the one that starts first is made. Null text has edits like an empty one.
    """
    edit = lambda start, end, new: F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), F.lit(new).alias("replacement"))
    found = docs.select("doc_id", "text", all_matches(F.col("text"), MASK, F.col("text").rlike(MASK)).alias("_long"))
    masks = F.transform(spans(F.col("text"), MASK, match=F.col("_long")), lambda s: edit(s["start"], s["end"], MASKED))
    middle = F.floor(F.length(F.coalesce("text", F.lit(""))) / 2)
    fixed = F.array(edit(F.lit(0), F.lit(0), HEADING), edit(middle, middle + CUT, ""))
    return found.select("doc_id", "text", F.when(F.size("_long") > 0, F.concat(fixed, masks)).otherwise(fixed).alias("edits"))


def count_after_edits(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Token counts of all documents before and after the edits of edited(). Repeated rows stay; an empty table gives no rows."""
    return apply_edits(build_trees(edited(docs), tokenizer), tokenizer, leaves=False)
