"""Edit-aware token counts.

A document keeps a segment tree: its leaves hold up to ``LEAF`` pre-tokens
(pieces of the pattern that splits text before the merges) with their token
counts, its inner nodes the sums of characters and tokens below.  An edit finds
its place by descending over the character sums, splits the text anew from the
last pre-token that ends two characters before it (what the pattern may look
ahead) until a new pre-token ends where an old one did, encodes only those, and
updates the sums above the leaves it touched.

Edits are applied in order, each to the text that the one before it left:
``start`` and ``length`` of what goes, in code points, and ``text`` that comes.
They are cut to the text's bounds; NULL counts as 0 or no text.

Edge cases: a NULL or empty text has no token and takes edits as an empty text;
a row without edits is only counted; repeated rows are treated one by one; an
empty table gives no row; texts are counted whole.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftscore.llm.common import Remembered, documents, text_batches

LEAF = 64
#: Characters after a pre-token that can decide where it ends.
AHEAD = 2
CACHE_WORDS = 400_000
EDITS = "array<struct<start:bigint,length:bigint,text:string>>"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Splits text into pre-tokens and counts their tokens; counts are remembered."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex
        import tiktoken

        with open(path, "rb") as f:  # a vocabulary that every executor has
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encode = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.counts = Remembered(lambda part: len(encode(part)))

    def split(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def count(self, parts: list[str]) -> list[int]:
        found = list(map(self.counts.__getitem__, parts))
        self.counts.rotate(CACHE_WORDS)
        return found


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> Encoder:
    """The encoder of this Python worker, which serves many tasks."""
    return Encoder(path)


class TokenTree:
    """The segment tree of one document."""

    def __init__(self, encoder: Encoder, parts: list[str], counts: list[int]):
        self.encoder, self.reencoded = encoder, 0
        self._build(parts, counts)

    @classmethod
    def of(cls, encoder: Encoder, text: str) -> TokenTree:
        parts = encoder.split(text)
        return cls(encoder, parts, encoder.count(parts))

    def _build(self, parts: list[str], counts: list[int]) -> None:
        self.parts = [parts[k:k + LEAF] for k in range(0, len(parts), LEAF)] or [[]]
        self.counts = [counts[k:k + LEAF] for k in range(0, len(parts), LEAF)] or [[]]
        self.width = 1 << (len(self.parts) - 1).bit_length()
        # Node k has the children 2k and 2k + 1; the leaves start at `width`.
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for k, (p, c) in enumerate(zip(self.parts, self.counts)):
            self.chars[self.width + k], self.tokens[self.width + k] = sum(map(len, p)), sum(c)
        for k in range(self.width - 1, 0, -1):
            self.chars[k], self.tokens[k] = self.chars[2 * k] + self.chars[2 * k + 1], self.tokens[2 * k] + self.tokens[2 * k + 1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character at ``place`` (the last leaf, if none does), and how far into it."""
        node = 1
        while node < self.width:
            node *= 2
            if place >= self.chars[node] and node - self.width < len(self.parts):
                place -= self.chars[node]
                node += 1
        leaf = min(node - self.width, len(self.parts) - 1)
        return leaf, place + sum(self.chars[self.width + k] for k in range(leaf, node - self.width))

    def tokens_before(self, place: int) -> int:
        """Tokens of all pre-tokens that end at ``place`` or before it."""
        leaf, inside = self.leaf_at(place)
        total, node = 0, self.width + leaf
        while node > 1:
            if node & 1:
                total += self.tokens[node - 1]
            node //= 2
        for part, count in zip(self.parts[leaf], self.counts[leaf]):
            inside -= len(part)
            if inside < 0:
                break
            total += count
        return total

    def _changed(self, first: int, last: int) -> None:
        """Bring the sums of these leaves, and of all nodes above them, up to date."""
        for k in range(first, last + 1):
            self.chars[self.width + k], self.tokens[self.width + k] = sum(map(len, self.parts[k])), sum(self.counts[k])
        lo, hi = (self.width + first) // 2, (self.width + last) // 2
        while lo:
            for k in range(lo, hi + 1):
                self.chars[k], self.tokens[k] = self.chars[2 * k] + self.chars[2 * k + 1], self.tokens[2 * k] + self.tokens[2 * k + 1]
            lo, hi = lo // 2, hi // 2

    def edit(self, start: int, length: int, text: str) -> None:
        start = min(max(start, 0), self.n_chars)
        stop = min(start + max(length, 0), self.n_chars)
        # Split anew from the last boundary that is AHEAD characters before the edit.
        first, inside = self.leaf_at(max(start - AHEAD, 0))
        head = at = 0
        for part in self.parts[first]:
            if at + len(part) > inside:
                break
            at += len(part)
            head += 1
        begin = max(start - AHEAD, 0) - (inside - at)  # where the first pre-token to be replaced starts
        # The old text from there on, leaf by leaf, until the new split meets an old boundary.
        old, ends, last = "", [], first
        fresh = self.parts[first][head:]
        while True:
            for part in fresh:
                old += part
                ends.append(begin + len(old))
            complete = last == len(self.parts) - 1
            if complete or begin + len(old) >= stop + AHEAD:
                new = old[:start - begin] + text + old[stop - begin:]
                met = self._met(new, begin, start + len(text), (stop - start) - len(text), stop, set(ends), complete)
                if met is not None:
                    break
            last += 1
            fresh = self.parts[last]
        parts, resumed = met
        counts = self.encoder.count(parts)
        self.reencoded += len(parts)
        # Old pre-tokens after the meeting point stay in the last leaf that was looked at.
        stay = sum(1 for e in ends if e > resumed)
        tail_parts = self.parts[last][len(self.parts[last]) - stay:]
        tail_counts = self.counts[last][len(self.counts[last]) - stay:]
        while stay > len(self.parts[last]):  # the meeting point is in an earlier leaf
            stay -= len(self.parts[last])
            last -= 1
            tail_parts = self.parts[last][len(self.parts[last]) - stay:]
            tail_counts = self.counts[last][len(self.counts[last]) - stay:]
        head_parts, head_counts = self.parts[first][:head], self.counts[first][:head]
        for k in range(first + 1, last + 1):
            self.parts[k], self.counts[k] = [], []
        if first == last:
            self.parts[first], self.counts[first] = head_parts + parts + tail_parts, head_counts + counts + tail_counts
        else:
            self.parts[first], self.counts[first] = head_parts + parts, head_counts + counts
            self.parts[last], self.counts[last] = tail_parts, tail_counts
        if len(self.parts[first]) > 8 * LEAF:  # spread the leaves again; nothing is encoded
            self._build([p for leaf in self.parts for p in leaf], [c for leaf in self.counts for c in leaf])
        else:
            self._changed(first, last)

    def _met(self, new: str, begin: int, past: int, shrunk: int, stop: int, ends: set[int], complete: bool) -> tuple[list[str], int] | None:
        """Pre-tokens of ``new`` up to the first one past the edit that ends where an old one did, and that place in the old text."""
        parts = []
        for m in self.encoder.pattern.finditer(new):
            if m.end() + AHEAD > len(new) and not complete:
                return None  # where this one ends may depend on what follows
            parts.append(m.group())
            place = begin + m.end() + shrunk
            if begin + m.end() >= past and place >= stop and place in ends:
                return parts, place
        return (parts, begin + len(new) + shrunk) if complete else None

    def text(self) -> str:
        return "".join(p for leaf in self.parts for p in leaf)


def counted(docs: DataFrame, vocabulary: str | None = None, with_text: bool = False) -> DataFrame:
    """``docs`` (with ``text`` and ``edits``) less these two columns, with the counts before and after the edits.

    Adds ``n_tokens, n_pretokens, n_edited_tokens, n_edited_chars, n_reencoded``
    (pre-tokens encoded for the edits), and ``edited_text`` if asked for, in place of
    columns of these names.
    """
    text_batches(docs.sparkSession)
    path = vocabulary or default_vocabulary()
    numbers = ["n_tokens", "n_pretokens", "n_edited_tokens", "n_edited_chars", "n_reencoded"]
    others = [c for c in docs.columns if c not in ("text", "edits", "edited_text", *numbers)]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path)
        for batch in batches:
            rows, texts = [], []
            k = batch.num_columns
            for text, edits in zip(batch.column(k - 2).to_pylist(), batch.column(k - 1).to_pylist()):
                tree = TokenTree.of(encoder, text or "")
                before = (tree.n_tokens, sum(map(len, tree.parts)))
                for e in edits or []:
                    if e is not None:
                        tree.edit(e["start"] or 0, e["length"] or 0, e["text"] or "")
                rows.append((*before, tree.n_tokens, tree.n_chars, tree.reencoded))
                if with_text:
                    texts.append(tree.text())
            found = np.array(rows, dtype=np.int64).reshape(-1, len(numbers)).T
            more = [pa.array(texts, pa.string())] if with_text else []
            yield pa.RecordBatch.from_arrays([*batch.columns[:k - 2], *map(pa.array, found), *more],
                                             [*others, *numbers, *(["edited_text"] if with_text else [])])

    rows = docs.select(*others, "text", F.col("edits").cast(EDITS).alias("edits"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*others).schema] + [f"{n} long" for n in numbers]
    return rows.mapInArrow(of, ", ".join(fields + ["edited_text string"] * with_text))


def usual_edits(text: str = "text"):
    """Three edits of a text of n characters: 20 go at the half, its first 12 come at the third for 16, a mark at three quarters."""
    n = F.coalesce(F.length(text), F.lit(0)).cast("long")

    def one(start, length, new):
        return F.struct(start.cast("long").alias("start"), F.lit(length).cast("long").alias("length"), new.alias("text"))

    return F.array(one(F.floor(n / 2), 20, F.lit("")),
                   one(F.floor(n / 3), 16, F.coalesce(F.substring(F.col(text), F.lit(1), F.lit(12)), F.lit(""))),
                   one(F.floor(n * 3 / 4), 0, F.lit(" [revised] ")))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all ``documents``, and after three edits of each."""
    return counted(documents(spark, sf_dir).select("doc_id", "text", usual_edits().alias("edits")))
