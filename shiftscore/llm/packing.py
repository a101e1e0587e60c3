"""Packing documents into windows of a fixed number of tokens, by minimum bin slack.

A document is cut into full windows and one remainder.  How remainders share
windows depends on their lengths alone, and there are fewer than ``capacity``
lengths, so the plan is made from the histogram of lengths: each window starts
with the longest length left; a subset-sum dynamic programme over bitsets (bit
``s`` is set if ``s`` tokens can be reached) finds the multiset of remaining
lengths that fills it closest to capacity, and the counts are read back from
the bitsets.  The same window is then used as often as the counts allow.  The
histogram and the plan don't grow with the number of documents.

Pieces find their window by their rank among the pieces of their length, a
two-level running count, so that a length which a third of all pieces share is
spread over many tasks.

Edge cases: a NULL or empty text is the end id alone; repeated rows are packed
one by one; an empty table gives no piece; texts of any length are cut whole.
"""

from __future__ import annotations

import json
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftscore.llm.common import Remembered, documents, keep, running_sum, slots_for, text_batches

CAPACITY = 4096
END_ID = 2
#: Words and parts a worker remembers before it starts anew (it then still looks into the last lot); results don't depend on it.
CACHE_WORDS, CACHE_PARTS = 400_000, 250_000


class CachedTokenizer:
    """Token ids of whole texts, as little-endian 32-bit bytes.

    The vocabulary drops white space and never merges across it, so a text's
    ids are those of its words, one after the other.  Words are remembered, and
    so are the parts that the vocabulary's own pattern splits them into.  A part
    in normal form goes straight to the merges; other words and vocabularies
    with other steps go through the whole tokenizer.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        steps = json.loads(self.tokenizer.to_str())
        normal = [x["type"] for x in (steps["normalizer"] or {}).get("normalizers", [])]
        split = (steps["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.direct = (normal == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in split] == ["Split", "ByteLevel"]
                       and split[0]["behavior"] == "Removed" and split[0]["invert"] and not split[1]["add_prefix_space"])
        self.pattern = regex.compile(split[0]["pattern"]["Regex"]) if self.direct else None
        self.special = [x["content"] for x in steps["added_tokens"]]
        # Byte-level alphabet: printable bytes stand for themselves, the n-th other one for the code point 256 + n.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.letters = {**{b: chr(b) for b in shown}, **{b: chr(256 + n) for n, b in enumerate(hidden)}}
        self.words, self.parts = Remembered(self._word), Remembered(self._part)

    def _plain(self, word: str) -> bool:
        """Lower-casing letter by letter and by word agree, nothing is to be composed, no special token is inside."""
        if not word.isascii() and ("\u03a3" in word or "\u0130" in word or not unicodedata.is_normalized("NFC", word)):
            return False
        return word.isalpha() or not any([x in word for x in self.special])

    def _part(self, part: str) -> bytes:
        mapped = part if part.isascii() and part.isalnum() else "".join([self.letters[b] for b in part.encode()])
        return _packed([t.id for t in self.tokenizer.model.tokenize(mapped)])

    def _word(self, word: str) -> bytes:
        if not (self.direct and self._plain(word)):
            return _packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        low = word.lower()
        return self.parts[low] if low.isalpha() else b"".join([self.parts[p] for p in self.pattern.findall(low)])

    def encode(self, text: str) -> bytes:
        ids = b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))
        self.words.rotate(CACHE_WORDS)
        self.parts.rotate(CACHE_PARTS)
        return ids


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=1)
def worker_tokenizer(path: str) -> CachedTokenizer:
    """The tokenizer of this Python worker, which serves many tasks."""
    return CachedTokenizer(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every document's ids, cut into pieces: ``doc_id, start, length, doc_tokens, ids``.

    ``ids`` are little-endian unsigned 32-bit values.  ``tokenizer`` is the path
    of a vocabulary that every executor has.
    """
    text_batches(docs.sparkSession)
    path = tokenizer or default_tokenizer()
    end = np.array([end_id], dtype="<u4").tobytes()
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                        ("doc_tokens", pa.int64()), ("ids", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_tokenizer(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # the ids of a few documents at a time
                some = batch.slice(at, 256)
                rows: list[tuple] = []
                for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    ids = encoder.encode(text or "") + end
                    n = len(ids) // 4
                    rows += [(doc_id, s, min(capacity, n - s), n, ids[4 * s:4 * (s + capacity)]) for s in range(0, n, capacity)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        cut, "doc_id long, start long, length long, doc_tokens long, ids binary")


def best_fill(room: int, items: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of ``items`` (length, count), by length from the longest, those that fill ``room`` best: (length, copies)."""
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length, count in items:
        if length > room:
            continue
        steps.append((length, reach))
        left, copies = min(count, room // length), 1
        while left:
            copies = min(copies, left)
            reach |= (reach << (copies * length)) & mask
            left -= copies
            copies *= 2
        if reach >> room & 1:
            break
    at, used = reach.bit_length() - 1, []
    for length, before in reversed(steps):
        copies = 0
        while not before >> at & 1:
            at -= length
            copies += 1
        if copies:
            used.append((length, copies))
    return used


def plan_windows(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Windows for a histogram of lengths: (how often, [(length, copies in each)])."""
    left, plan = {k: v for k, v in sorted(histogram.items(), reverse=True) if v}, []
    while left:
        longest = next(iter(left))
        left[longest] -= 1
        used = dict(best_fill(capacity - longest, [x for x in left.items() if x[1]]))
        left[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        times = min(left[k] // n for k, n in used.items())
        plan.append((times, sorted(used.items(), reverse=True)))
        for k, n in used.items():
            left[k] -= times * n
            if not left[k]:
                del left[k]
    return plan


def plan_table(plan: list[tuple[int, list[tuple[int, int]]]]) -> pd.DataFrame:
    """Where the pieces of a length go: from rank ``first`` on, ``copies`` a window from ``sequence`` on, at ``offset``."""
    rows, used, sequence = [], {}, 0
    for times, window in plan:
        offset = 0
        for length, copies in window:
            first = used.get(length, 0)
            rows.append((length, first, copies, sequence, offset))
            used[length] = first + times * copies
            offset += length * copies
        sequence += times
    table = pd.DataFrame(rows, columns=["length", "first", "copies", "sequence", "offset"], dtype="int64")
    return table.sort_values(["length", "first"], ignore_index=True)


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (``doc_id, start, length`` and any more columns).

    ``cut`` is read several times: pass a checkpoint or a written table, which
    gives the same rows each time.
    """
    spark = cut.sparkSession
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # up to `capacity` rows
    table = plan_table(plan_windows(histogram, capacity))
    shared = spark.sparkContext.broadcast(table.to_numpy())  # as large as the plan, not as the data

    slots = slots_for(sum(histogram.values()), spark)
    others = [c for c in cut.columns if c not in ("doc_id", "start", "length", "ids")]
    order = ["doc_id", "start", *others]
    ranked = running_sum(
        cut.withColumn("_slot", F.pmod(F.xxhash64("doc_id", "start"), F.lit(slots))).withColumn("_one", F.lit(1).cast("long")),
        ["length"], "_slot", order, "_one", "_rank").drop("_slot", "_one")

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        length, first, copies, sequence, offset = shared.value.T
        for f in frames:
            own, rank = f["length"].to_numpy(), f.pop("_rank").to_numpy() - 1
            # The table is in order of (length, first): count the entries that are no greater.
            at = np.empty(len(f), dtype=np.int64)
            for k in np.unique(own):
                lo, hi = np.searchsorted(length, [k, k + 1])
                mine = own == k
                at[mine] = lo + np.searchsorted(first[lo:hi], rank[mine], side="right") - 1
            nth = rank - first[at]
            f["sequence_id"] = sequence[at] + nth // copies[at]
            f["offset"] = offset[at] + nth % copies[at] * own
            yield f

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return ranked.mapInPandas(place, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """The windows themselves: ``sequence_id, n_tokens, ids`` from packed pieces that still hold ``ids``."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most `capacity` tokens
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), inside.alias("_in")).select(
        "sequence_id", "n_tokens", F.aggregate("_in", F.lit(b""), lambda s, x: F.concat(s, x["ids"])).alias("ids"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` in windows of 4096 tokens."""
    return packed_documents(documents(spark, sf_dir))


def packed_documents(docs: DataFrame) -> DataFrame:
    """Pieces of all documents with their place and the CRC-32 of their ids; only digests are kept between the steps."""
    cut = keep(pieces(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return pack(cut).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
