"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint is the bitwise majority of the XXH64 values of a document's word
shingles.  Two fingerprints within ``radius`` bits share a variant within half
the radius of each.  So every distinct fingerprint emits all variants within
half the radius, the variants are shuffled, and fingerprints that meet at one
are verified by their bit distance.  A variant can be met by no more
fingerprints than the ball around it holds (65 for radius 2), however many
documents are copies: equal fingerprints are one.

With an even radius any two fingerprints at one variant are within the radius,
so neighbours in order are linked and no group is paired with itself.

Edge cases: a NULL text or one without words has fingerprint zero and is linked
like any other; a row without doc_id takes part, and a group of such rows alone
has a NULL component; repeated rows give repeated results; an empty table none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiftscore.llm.common import documents, keep, set_apart, text_batches
from shiftscore.llm.components import components

SHINGLE_WORDS, RADIUS, SEED = 3, 2, 42


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a whole text, as a signed integer."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # of bytes: A-Z, and ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts, ends = [0, *(gaps + 1).tolist()], [*gaps.tolist(), len(joined)]
    ends = ends[shingle_words - 1:] or [len(joined)]
    digest, counts = xxhash.xxh64_digest, np.zeros(64, dtype=np.int64)
    for at in range(0, len(ends), 65_536):
        hashes = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[at:at + 65_536], ends[at:at + 65_536])])
        counts += np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(ends))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_key, fingerprint`` of every document; text_key is a hash of the text."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([fingerprint(t, shingle_words) for t in batch.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], ["doc_id", "text_key", "fingerprint"])

    text_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        of, "doc_id long, text_key long, fingerprint long")


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``a, b`` between distinct ``fingerprint`` values that connect all pairs within ``radius`` bits, none beyond it."""
    def emitted(bits: int) -> DataFrame:
        masks = [sum(1 << b for b in c) for n in range(bits + 1) for c in combinations(range(64), n)]
        signed = [m - (1 << 64) if m >> 63 else m for m in masks]
        return distinct.select("fingerprint", F.explode(F.array(*[F.lit(m) for m in signed])).alias("_mask")).select(
            F.col("fingerprint").bitwiseXOR(F.col("_mask")).alias("variant"), "fingerprint")

    if radius % 2 == 0:
        at = Window.partitionBy("variant").orderBy("fingerprint")
        pairs = emitted(radius // 2).select(F.col("fingerprint").alias("a"), F.lag("fingerprint").over(at).alias("b")).filter("b IS NOT NULL")
    else:
        # One side goes the longer half; both sides of a variant are bounded by a ball.
        far, near = emitted(radius // 2 + 1), emitted(radius // 2).withColumnRenamed("fingerprint", "b")
        pairs = far.withColumnRenamed("fingerprint", "a").join(near, "variant").filter("a <> b").select("a", "b")
    return pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).distinct()


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """``doc_id, text_key, fingerprint, group_key, component_id`` of every document; group_key is a group's least fingerprint."""
    found = keep(fingerprints(docs, shingle_words))
    distinct = keep(found.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")))
    groups = components(links(distinct, radius))
    member = distinct.join(groups, distinct["fingerprint"] == groups["node"], "left").select(
        "fingerprint", "first_id", "component")
    # Fingerprints without a link are alone; the others take the least doc_id of their component.
    linked = keep(member.filter("component IS NOT NULL"))
    least = linked.groupBy("component").agg(F.min("first_id").alias("component_id"))
    alone = member.filter("component IS NULL").select("fingerprint", F.col("fingerprint").alias("group_key"), F.col("first_id").alias("component_id"))
    classes = alone.union(linked.join(least, "component").select("fingerprint", F.col("component").alias("group_key"), "component_id"))
    return found.join(classes, "fingerprint").select("doc_id", "text_key", "fingerprint", "group_key", "component_id")


def one_of_each(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each group left: the one with the least doc_id (then text hash), one without an id only if all are."""
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    kept = near_duplicates(docs, shingle_words, radius).groupBy("group_key").agg(least).select(
        F.col("first.doc_id").alias("_id"), F.col("first.text_key").alias("_key"))
    named = set_apart(docs, ("doc_id", "text"))
    keyed = named.withColumn("_text", F.xxhash64("text"))
    left = keyed.join(kept, keyed["doc_id"].eqNullSafe(kept["_id"]) & (keyed["_text"] == kept["_key"]), "left_semi")
    # Rows that repeat both the id and the text are one.
    return left.dropDuplicates(["doc_id", "_text"]).select(*named.columns).toDF(*docs.columns)


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all of ``documents``: 3-word shingles, 2 bits."""
    return near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
