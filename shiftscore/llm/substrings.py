"""Substring dedup by level-wise doubling.

A window of ``window`` words can only repeat if each window of half its length
inside it does.  Level one finds repeated half windows: not all of them travel,
but in each full window the one with the least hash (equal windows choose the
same one), about one word in a dozen.  Only full windows whose half window
repeats in another document are extended to twice that length and hashed; those
that start in a document with a smaller doc_id are removed.  Longer windows
remove nothing more, as they are made of repeated windows; ``longest_repeats``
goes on doubling until no candidate survives.

Documents with equal texts are one until the end: all but the first are removed
whole if they have a window.  A passage that a third of all documents hold is
combined in partial aggregates (least and greatest doc_id), never gathered.

Windows are compared by two 64-bit hashes, made of 64-bit word hashes by the
same doubling.

Edge cases: a NULL or empty text has no words; rows that repeat a doc_id never
remove one another's words; a NULL doc_id comes before all others, and a text
under NULL removes from all that have an id; an empty table gives no row; texts
of any length are treated whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftscore.llm.common import Remembered, documents, store, text_batches

WINDOW = 50
CACHE_WORDS = 400_000
#: Multipliers of the two hash lanes.
LANES = ((0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9), (0xD6E8FEB86659FD93, 0x94D049BB133111EB))
#: Stands for a NULL doc_id while ids are compared.
NO_ID = -(1 << 63)


@lru_cache(maxsize=1)
def _word_hashes() -> Remembered:
    """Word hashes of this Python worker, which serves many tasks."""
    return Remembered(xxhash.xxh64_intdigest)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").split()  # of bytes: ASCII white space only


def word_hashes(words: list[bytes]) -> np.ndarray:
    known = _word_hashes()
    found = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    known.rotate(CACHE_WORDS)
    return found


def join_hashes(a: np.ndarray, b: np.ndarray, lane: int = 0) -> np.ndarray:
    """Hashes of windows made of two, element by element."""
    first, second = (np.uint64(x) for x in LANES[lane])
    h = a * first + b
    h ^= h >> np.uint64(29)
    h *= second
    h ^= h >> np.uint64(32)
    return h


def window_hashes(h: np.ndarray, length: int, lane: int = 0) -> np.ndarray:
    """Hashes of all windows of ``length`` words, by doubling; the last step may overlap."""
    have = 1
    while have < length:
        step = min(have, length - have)
        h = join_hashes(h[:-step], h[step:], lane) if len(h) > step else h[:0]
        have += step
    return h


def chosen_halves(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all half windows, and for each full window the place of the least one in it."""
    half = window_hashes(words, (window + 1) // 2)
    inside = window - (window + 1) // 2 + 1
    if len(words) < window:
        return half, np.zeros(0, dtype=np.int64)
    view = np.lib.stride_tricks.sliding_window_view(half, inside)
    return half, view.argmin(axis=1) + np.arange(len(view))


def _sha256(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _digests(texts: DataFrame, window: int) -> DataFrame:
    """Of each row: ``doc_id, text_key, n_words, sha256`` of its words, and ``halves``: the chosen half windows' hashes."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sha, halves = [], [], []
            for text in batch.column(2).to_pylist():
                words = words_of(text)
                n.append(len(words))
                sha.append(_sha256(words))
                half, at = chosen_halves(word_hashes(words), window)
                halves.append(np.unique(half[np.unique(at)]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(sha), pa.array(halves, pa.list_(pa.int64()))],
                ["doc_id", "text_key", "n_words", "sha256", "halves"])

    return texts.mapInArrow(of, "doc_id long, text_key binary, n_words long, sha256 string, halves array<long>")


def _windows(texts: DataFrame, window: int) -> DataFrame:
    """All full windows whose chosen half is in the row's ``repeated``: ``h0, h1, doc_id, text_key, at``."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, key, text, repeated in zip(*(c.to_pylist() for c in batch.columns)):
                words = word_hashes(words_of(text))
                half, chosen = chosen_halves(words, window)
                at = np.flatnonzero(np.isin(half.view(np.int64)[chosen], np.array(repeated, dtype=np.int64)))
                step = window - (window + 1) // 2
                for some in np.split(at, range(100_000, len(at), 100_000)):
                    full = join_hashes(half[some], half[some + step])
                    other = window_hashes(words, (window + 1) // 2, 1)
                    full1 = join_hashes(other[some], other[some + step], 1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(full.view(np.int64)), pa.array(full1.view(np.int64)), pa.array([doc_id] * len(some), pa.int64()),
                         pa.array([key] * len(some), pa.binary()), pa.array(some.astype(np.int32))],
                        ["h0", "h1", "doc_id", "text_key", "at"])

    return texts.mapInArrow(of, "h0 long, h1 long, doc_id long, text_key binary, at int")


def _cut(texts: DataFrame, window: int) -> DataFrame:
    """``doc_id, text_key, n_removed, kept_sha256, kept`` from rows with the places ``removed`` of their windows."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sha, kept = [], [], []
            for text, removed in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = words_of(text)
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                places = np.unique(np.array(removed, dtype=np.int64))
                edge[places] += 1
                edge[places + window] -= 1
                covered = np.cumsum(edge[:-1]) > 0
                left = [words[k] for k in np.flatnonzero(~covered)]
                n.append(int(covered.sum()))
                sha.append(_sha256(left))
                kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(sha), pa.array(kept, pa.string())],
                ["doc_id", "text_key", "n_removed", "kept_sha256", "kept"])

    return texts.mapInArrow(of, "doc_id long, text_key binary, n_removed long, kept_sha256 string, kept string")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
                       F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("text_key"), "text")


def _repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The windows that two doc_ids hold, with the least of these.

    Written out, so that a join with ``rows`` deals both sides anew and Spark
    can split the rows of a window that many documents hold.
    """
    return store(rows.groupBy(*keys).agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("_last")).filter(
        "first_doc < _last").drop("_last"), "repeated")


def _with_first(digests: DataFrame) -> DataFrame:
    """Add ``is_first``: whether the row has the least doc_id of its text; the ids are written out for the same reason."""
    first = store(digests.groupBy("text_key").agg(F.min("doc_id").alias("first_id")), "first")
    return digests.join(first, "text_key").withColumn("is_first", F.col("doc_id") == F.col("first_id")).drop("first_id")


def candidates(texts: DataFrame, digests: DataFrame, window: int) -> DataFrame:
    """Windows whose half repeats, of one document for each text."""
    halves = digests.filter("is_first").select("doc_id", "text_key", F.explode("halves").alias("half"))
    both = halves.join(_repeated(halves, ["half"]), "half").groupBy("doc_id", "text_key").agg(F.collect_set("half").alias("repeated"))
    return store(_windows(texts.join(both, ["doc_id", "text_key"]).select("doc_id", "text_key", "text", "repeated"), window), "windows")


def removals(docs: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Digests of all documents, and of those that lose some words: what is left of them.

    The digests have ``doc_id, text_key, n_words, sha256, is_first``; documents
    that are not the first of their text lose all words if they have a window.
    """
    text_batches(docs.sparkSession)
    texts = _keyed(docs)
    digests = store(_digests(texts, window), "digests")
    digests = _with_first(digests)
    found = candidates(texts, digests, window)
    least = _repeated(found, ["h0", "h1"])
    removed = found.join(least, ["h0", "h1"]).filter("doc_id > first_doc").groupBy("doc_id", "text_key").agg(
        F.collect_list("at").alias("removed"))
    cut = _cut(texts.join(removed, ["doc_id", "text_key"]).select("doc_id", "text_key", "text", "removed"), window)
    return digests.drop("halves"), cut


def longest_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, longest``: the longest of ``window``, twice that, ... words at which a window repeats in another document.

    Documents without a repeated window are not returned; copies of a text
    count as their first document.
    """
    text_batches(docs.sparkSession)
    texts = _keyed(docs)
    digests = store(_digests(texts, window), "digests")
    digests = _with_first(digests)
    found, length, levels = candidates(texts, digests, window), window, None
    while True:
        alive = store(found.join(_repeated(found, ["h0", "h1"]).drop("first_doc"), ["h0", "h1"]), "alive")
        if alive.isEmpty():
            break
        level = alive.select("doc_id").distinct().withColumn("longest", F.lit(length).cast("long"))
        levels = level if levels is None else levels.union(level)
        after = alive.select(F.col("h0").alias("n0"), F.col("h1").alias("n1"), "doc_id", "text_key", (F.col("at") - length).alias("at"))
        found = alive.join(after, ["doc_id", "text_key", "at"]).select(
            F.xxhash64("h0", "n0").alias("h0"), F.xxhash64("n1", "h1").alias("h1"), "doc_id", "text_key", "at")
        length *= 2
    empty = docs.sparkSession.createDataFrame([], "doc_id long, longest long")
    return (levels if levels is not None else empty).groupBy("doc_id").agg(F.max("longest").alias("longest"))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` without the 50-word windows that a document with a smaller doc_id holds."""
    digests, cut = removals(documents(spark, sf_dir))
    cut = cut.drop("kept").distinct()
    whole = ~F.col("is_first") & (F.col("n_words") >= WINDOW)
    return digests.join(cut, ["doc_id", "text_key"], "left").select(
        F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"))


ORACLE = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (
  SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS pos FROM words WHERE len(w) >= 50),
windows AS (
  SELECT doc_id, pos, md5(array_to_string(w[pos:pos + 49], ' ')) AS h FROM places),
first AS (SELECT h, min(doc_id) AS first_doc FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(pos, pos + 49)) AS k
  FROM windows JOIN first USING (h) WHERE doc_id > first_doc),
removed AS (SELECT doc_id, count(*) AS n, list(k) AS ks FROM gone GROUP BY doc_id),
spelled AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM words),
kept AS (
  SELECT s.doc_id, string_agg(word, ' ' ORDER BY s.k) AS text
  FROM spelled s ANTI JOIN gone g ON s.doc_id = g.doc_id AND s.k = g.k GROUP BY s.doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(r.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM words w LEFT JOIN removed r USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""
