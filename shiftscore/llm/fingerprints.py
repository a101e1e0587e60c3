"""Document fingerprints: weighted SimHash, and search by permuted block tables, all as DataFrame work.

A term is a pair of adjacent words (lower case), its weight the number of its
characters, at most 32.  Each term's 64-bit hash votes with its weight on every
bit; a bit is 1 if the weights of the ones are over half of all.  The 64 sums
are kept as 32 long sums of two 32-bit lanes, so one partial aggregation over
the exploded terms does the work and no document's terms are gathered.

The search cuts fingerprints into blocks.  Two fingerprints within ``radius``
bits agree on all but ``radius`` of the blocks, so there is a table for each
choice of blocks to agree on; candidates meet in a table, are verified by their
bit distance, and count in the first table where they meet.

Edge cases: a NULL text is empty; a text without words has fingerprint zero, one
with a single word has that word as its term; rows without doc_id come first in
order; rows that repeat a doc_id are in order of their text hash; rows that are
equal in both have one result each, all with the same next document, which is the
first that differs from them; an empty table gives no row, a document without
another one is its own next document.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiftscore.llm.common import WORD, documents, keep, shuffle_partitions

MAX_WEIGHT = 32
RADIUS, BLOCKS = 3, 6
#: Characters of text in one block of documents that stand together in order, and the most blocks.
BLOCK_CHARS, MOST_BLOCKS = 16_000_000, 20_000
#: Rows for each block in the sample that its bounds are drawn from; bounds change the layout only.
BLOCK_SAMPLE = 60

LANES = (1 << 32) | 1
LOW = (1 << 32) - 1


def terms(words: Column) -> Column:
    """Array of the terms of an array of words, repeats included: neighbours joined by a space, or the only word."""
    n = F.size(words)
    pairs = F.zip_with(words, F.slice(words, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))  # NULL after the last word
    return F.when(n > 1, F.slice(pairs, F.lit(1), F.greatest(n - 1, F.lit(0)))).otherwise(words)


def vote_sums() -> list[Column]:
    """32 sums over ``_hash`` and ``_weight``: lane sums of bit k and of bit k + 32; and the sum of all weights."""
    return [F.sum(F.shiftright("_hash", k).bitwiseAND(F.lit(LANES)) * F.col("_weight")).alias(f"_v{k}") for k in range(32)] + [
        F.sum("_weight").alias("_all")]


def majority() -> Column:
    """The fingerprint from ``vote_sums``."""
    bits = F.lit(0).cast("long")
    for k in range(32):
        for lane, value in ((k, F.col(f"_v{k}").bitwiseAND(F.lit(LOW))), (k + 32, F.shiftrightunsigned(f"_v{k}", 32))):
            one = 1 << lane
            bits = bits.bitwiseOR(F.when(value * 2 > F.col("_all"), F.lit(one - (1 << 64) if lane == 63 else one)).otherwise(F.lit(0).cast("long")))
    return F.coalesce(bits, F.lit(0).cast("long"))


def fingerprints(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys``, ``fingerprint`` and ``copies``: rows equal in ``keys`` count as one text, ``copies`` times."""
    words = df.select(*keys, F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)).alias("_words"))
    exploded = words.select(*keys, F.posexplode_outer(terms(F.col("_words"))).alias("_at", "_term"))
    weighted = exploded.select(
        *keys, F.xxhash64("_term").alias("_hash"), (F.coalesce("_at", F.lit(0)) == 0).cast("long").alias("_first"),
        F.when(F.col("_term").isNull(), 0).otherwise(F.least(F.length("_term"), F.lit(MAX_WEIGHT))).cast("long").alias("_weight"))
    return weighted.groupBy(*keys).agg(*vote_sums(), F.sum("_first").alias("copies")).select(
        *keys, majority().alias("fingerprint"), "copies")


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, 0 for opposite ones."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / 64.0


def block_of(value: tuple[Column, Column], bounds: list[tuple[int, int]]) -> Column:
    """How many of the ascending pairs ``bounds`` are no greater than the pair ``value``, by binary search."""
    if not bounds:
        return F.lit(0)
    first, second = (F.array(*[F.lit(b[k]).cast("long") for b in bounds]) for k in range(2))
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])

    def reached(k: Column) -> Column:
        return (F.get(first, k) < value[0]) | ((F.get(first, k) == value[0]) & (F.get(second, k) <= value[1]))

    return F.aggregate(steps, F.lit(0), lambda at, s: F.when((at + s <= len(bounds)) & reached(at + s - 1), at + s).otherwise(at))


def block_bounds(pairs: DataFrame, n: int, blocks: int) -> tuple[list[tuple[int, int]], dict[int, int]]:
    """Ascending bounds that cut ``pairs`` (two longs, ``n`` rows) into about ``blocks`` blocks; and into how many parts the blocks of hot pairs are dealt.

    The bounds come from a sample of at most ``BLOCK_SAMPLE`` rows a block in
    expectation.  A pair that has more of it than a block should have is a block
    of its own, and is dealt into parts.
    """
    drawn = pairs.filter(F.rand(42) < BLOCK_SAMPLE * blocks / max(n, 1)).toArrow()
    first, second = (drawn.column(k).to_numpy() for k in range(2))
    order = np.lexsort((second, first))
    chosen, counts = np.unique(np.stack((first, second), axis=1), axis=0, return_counts=True)
    each = max(1.0, len(first) / blocks)
    bounds = {(int(first[k]), int(second[k])) for k in order[[len(order) * k // blocks for k in range(1, blocks)]]} if len(order) else set()
    hot = {(int(a), int(b)): math.ceil(c / each) for (a, b), c in zip(chosen[counts > each], counts[counts > each])}
    bounds |= hot.keys() | {(a, b + 1) for a, b in hot if b + 1 < 1 << 63}
    bounds = sorted(bounds)
    return bounds, {bounds.index(p) + 1: parts for p, parts in hot.items()}


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, text, next_id, next_key, next_text``: each document and the next one by doc_id (after the last: the first).

    Documents are dealt into blocks of adjacent (doc_id, text hash), and each
    block is also sent the first document of the one after it.  One shuffle
    moves each text once, and only block bounds and the first pair of each block
    come to the driver.  Rows without an id, or with one that repeats, are cut
    by their text hash, and rows that are equal in both are dealt into parts.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns({"order_id": F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")), "text_key": F.xxhash64("text")})
    chars, n = rows.agg(F.sum(F.length("text").cast("long")), F.count("*")).first()
    blocks = min(MOST_BLOCKS, max(shuffle_partitions(spark), math.ceil((chars or 0) / BLOCK_CHARS)), max(1, n or 0))
    bounds, parts = block_bounds(rows.select("order_id", "text_key"), n or 0, blocks)
    blocked = rows.withColumn("block", block_of((F.col("order_id"), F.col("text_key")), bounds))
    first = blocked.groupBy("block").agg(F.min(F.struct("order_id", "text_key")).alias("first")).orderBy("block").collect()  # a row for each block

    # Each part of a block gets a copy of the next block's first document; it stands last and is only looked at.
    heads = [(first[k - 1]["block"], r["first"]["order_id"], r["first"]["text_key"], parts.get(first[k - 1]["block"], 1))
             for k, r in enumerate(first)]
    head = spark.createDataFrame(heads, "to_block int, _id long, _key long, _parts int")
    tails = rows.join(F.broadcast(head), (rows["order_id"] == head["_id"]) & (rows["text_key"] == head["_key"])).groupBy(
        "to_block", "_parts", "doc_id", "order_id", "text_key").agg(F.first("text").alias("text"))
    columns = ["doc_id", "order_id", "text_key", "text", "block", "part", "tail"]
    part = F.lit(0)
    if parts:
        dealt = F.create_map(*[F.lit(x) for pair in parts.items() for x in pair])
        part = F.pmod(F.monotonically_increasing_id(), F.coalesce(F.element_at(dealt, F.col("block")), F.lit(1))).cast("int")
    dealt = blocked.select("*", part.alias("part"), F.lit(0).alias("tail")).select(columns).union(
        tails.select("*", F.col("to_block").alias("block"), F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("part"),
                     F.lit(1).alias("tail")).select(columns))

    # Backwards, so that the next one that differs is the last one seen.
    order = Window.partitionBy("block", "part").orderBy(F.desc("tail"), F.desc("order_id"), F.desc("text_key"))
    # Plain columns, not one of structs, which would be made before the shuffle and move each text twice.
    seen = dealt.withColumns({f"_{c}": F.lag(c).over(order) for c in ("tail", "doc_id", "text_key", "text")})
    differs = ~F.col("_doc_id").eqNullSafe(F.col("doc_id")) | (F.col("_text_key") != F.col("text_key"))
    other = F.struct(F.col("_doc_id").alias("doc_id"), F.col("_text_key").alias("text_key"), F.col("_text").alias("text"))
    after = F.last(F.when(F.col("_tail").isNotNull() & differs, other), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    here = F.struct("doc_id", "text_key", "text")
    return seen.withColumn("_next", F.coalesce(after, here)).filter("tail = 0").select(
        "doc_id", "text_key", "text", F.col("_next.doc_id").alias("next_id"), F.col("_next.text_key").alias("next_key"),
        F.col("_next.text").alias("next_text"))


def block_masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """A mask for each choice of ``blocks - radius`` blocks that must agree."""
    cuts = [round(k * 64 / blocks) for k in range(blocks + 1)]
    block = [((1 << (cuts[k + 1] - cuts[k])) - 1) << cuts[k] for k in range(blocks)]
    return [sum(block[k] for k in c) for c in combinations(range(blocks), blocks - radius)]


def within_radius(queries: DataFrame, table: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``fingerprint, other, distance`` for all distinct fingerprints of ``table`` within ``radius`` bits of one of ``queries``.

    Both hold a column ``fingerprint`` without repeats.
    """
    masks = [F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in block_masks(blocks, radius)]

    def tabled(df: DataFrame, name: str) -> DataFrame:
        keys = F.array(*[F.col("fingerprint").bitwiseAND(m) for m in masks])
        return df.select(F.col("fingerprint").alias(name), F.posexplode(keys).alias("table", "key"))

    met = tabled(queries, "fingerprint").join(tabled(table, "other"), ["table", "key"])
    differ = F.col("fingerprint").bitwiseXOR(F.col("other"))
    first = F.coalesce(*[F.when(differ.bitwiseAND(m) == 0, F.lit(k)) for k, m in enumerate(masks)])
    return met.filter((F.bit_count(differ) <= radius) & (F.col("table") == first)).select(
        "fingerprint", "other", F.bit_count(differ).alias("distance"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all ``documents`` and of their edited texts, with what the documents divisible by 100 find.

    ``n_near`` is the number of other documents whose fingerprint is within 3
    bits, for documents whose doc_id is divisible by 100; NULL for the others.
    """
    chained = with_next(documents(spark, sf_dir))
    n = F.length("text").cast("long")
    part = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n.cast("int") - part), F.substring(F.col("next_text"), F.lit(1), part))
    both = chained.select("doc_id", "text_key", "next_id", "next_key", n.alias("n_chars"), "text", edited.alias("edited"))
    keys = ["doc_id", "text_key", "next_id", "next_key", "n_chars", "edited_hash", "is_edited"]
    sides = both.withColumn("edited_hash", F.unhex(F.sha2("edited", 256))).withColumn(
        "_side", F.explode(F.array(F.struct(F.lit(False).alias("is_edited"), F.col("text").alias("body")),
                                   F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("body"))))).select(
        *keys[:-1], "_side.is_edited", "_side.body")
    voted = fingerprints(sides, keys, "body")
    per_doc = keep(voted.groupBy(*keys[:-1]).agg(  # one row for rows that are equal in id and text
        F.max("copies").alias("copies"),
        F.max(F.when(~F.col("is_edited"), F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("is_edited"), F.col("fingerprint"))).alias("edited_fingerprint")))

    following = per_doc.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("fingerprint").alias("_next"))
    linked = per_doc.join(following, per_doc["next_id"].eqNullSafe(following["_id"]) & (per_doc["next_key"] == following["_key"]))

    distinct = keep(per_doc.groupBy("fingerprint").agg(
        F.sum("copies").alias("n"), F.max((F.pmod("doc_id", F.lit(100)) == 0).cast("int")).alias("asked")))
    near = within_radius(distinct.filter("asked = 1").select("fingerprint"), distinct.select("fingerprint"))
    weights = distinct.select(F.col("fingerprint").alias("other"), "n")
    found = near.join(weights, "other").groupBy("fingerprint").agg(F.sum("n").alias("n_near"))
    asked = F.when(F.pmod("doc_id", F.lit(100)) == 0, F.col("n_near") - 1)

    def text_of(c: Column) -> Column:
        return F.lower(F.lpad(F.hex(c), 16, "0"))

    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return linked.join(found, "fingerprint", "left").withColumn("_copy", each).select(
        "doc_id", "n_chars", F.lower(F.hex("edited_hash")).alias("edited_sha256"),
        text_of(F.col("fingerprint")).alias("fingerprint"), text_of(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next")).alias("near_next"), asked.alias("n_near"))
