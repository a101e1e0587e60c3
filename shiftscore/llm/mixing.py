"""Mixing sources to target weights by weighted fair queueing.

Each source is shuffled.  A document's virtual finish time is the source's
words up to and including it, divided by the source's target.  All documents
of all sources are then put in order of finish time, and the mix is the part
of that order which fits the total budget.  A source whose target exceeds its
size is queued again, up to ``max_repeats`` times.

Everything is DataFrame work.  Both running sums (within a source, and over
the whole order) are two-level: sums per slot, then sums inside a slot.  A
source that holds a third of all rows is spread over all slots.

Edge cases: a NULL text has size 0; a NULL source is a source of its own, after
all others; documents of size 0 and of sources without words are never taken;
repeated rows are queued one by one; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiftscore.llm.common import WORD, documents, keep, n_words, running_sum, set_apart, slots_for

MAX_REPEATS = 3


def cyclic_weights(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Add ``weight``: ``weights`` repeating over the sources in code point order, NULL last.

    The rank is built from ranges of sources, each numbered on its own, so no
    task holds all sources.
    """
    order = F.col("source").asc_nulls_last()
    ranged = keep(sources.repartitionByRange(order).sortWithinPartitions(order)
                  .withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    rank = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    cycle = F.array(*[F.lit(w) for w in weights])
    return (ranged.withColumn("_part", part).join(starts, "_part")
            .select(*sources.columns, F.element_at(cycle, (rank % len(weights) + 1).cast("int")).alias("weight")))


def with_targets(sources: DataFrame, budget: int, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Add ``target``: the budget shared by ``weight``, at most ``max_repeats`` times ``source_size``.

    What a capped source leaves is shared again by weight until no source is
    above its cap.  Each round is one sum over the sources; only the level (the
    target of weight 1) comes to the driver.
    """
    cap = F.col("source_size") * max_repeats
    level = 0.0
    while True:
        over = F.lit(level) * F.col("weight") > cap
        taken, weight = (x or 0 for x in sources.agg(
            F.sum(F.when(over, cap).otherwise(0)), F.sum(F.when(over, 0).otherwise(F.col("weight")))).first())
        new = (budget - taken) / weight if weight else level  # no weight is left, or there is no source
        if new <= level:
            break
        level = new
    share = F.lit(level) * F.col("weight")
    return sources.withColumn("target", F.when(share > cap, cap).otherwise(share).cast("double"))


def schedule(sized: DataFrame, targets: DataFrame, budget: int, n_rows: int, seed: int = 42) -> DataFrame:
    """One row per queued copy of a document: its columns, ``epoch``, ``finish`` and ``taken_copy``.

    ``sized`` holds ``doc_id, source, size, row``, with ``row`` unique.  Documents
    without words and sources with target 0 are never queued.
    """
    slots = slots_for(n_rows, sized.sparkSession)
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = sized.filter("size > 0").withColumn("key", key)
    first_bits = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("slot", F.shiftright(first_bits * slots, 32))
    rows = running_sum(rows, ["source"], "slot", ["key", "doc_id", "row"], "size", "through").drop("slot")

    t = targets.filter("target > 0").select(F.col("source").alias("_source"), "source_size", "target")
    rows = rows.join(t, rows["source"].eqNullSafe(t["_source"])).drop("_source")
    epochs = F.ceil(F.col("target") / F.col("source_size")).cast("int")
    rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(1), epochs)))
    words = (F.col("epoch") - 1) * F.col("source_size") + F.col("through")
    rows = rows.withColumn("finish", words / F.col("target"))

    # Slots of equal width up to time 1, where all targets are met, and ever wider ones after it.
    place = F.when(F.col("finish") <= 1, F.col("finish")).otherwise(2 - 1 / F.col("finish"))
    rows = rows.withColumn("slot", F.floor(place * slots))
    order = ["finish", F.col("source").asc_nulls_last(), "epoch", "key", "doc_id", "row"]
    rows = running_sum(rows, [], "slot", order, "size", "total")
    return rows.withColumn("taken_copy", F.col("total") <= budget).drop("slot", "through", "total", "key")


def size_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, row`` of every document; the only pass over the texts."""
    return docs.select("doc_id", "source", n_words(F.col("text")).alias("size"),
                       F.monotonically_increasing_id().alias("row"), F.xxhash64("text", "source").alias("ident"))


def mix(docs: DataFrame, weights: DataFrame | None = None, budget: int | None = None, seed: int = 42) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, times, taken, ident``.

    ``weights`` has ``source, weight`` (default: 1, 2, 3 repeating); ``budget``
    is in words (default: all words).
    """
    sized = keep(size_documents(docs))
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    if weights is None:
        weighted = cyclic_weights(sources)
    else:
        w = weights.select(F.col("source").alias("_source"), "weight")
        weighted = sources.join(w, sources["source"].eqNullSafe(w["_source"])).drop("_source")
    weighted = keep(weighted)
    total, n_rows = weighted.agg(F.sum("source_size"), F.sum("source_rows")).first()
    budget = int(total or 0) if budget is None else budget
    targets = with_targets(weighted, budget)
    columns = ["row", "doc_id", "source", "size", "source_size", "target", "ident"]
    queued = schedule(sized, targets, budget, n_rows or 0, seed).groupBy(*columns).agg(
        F.sum(F.col("taken_copy").cast("long")).alias("times"))
    t = targets.select(F.col("source").alias("_source"), "source_size", "target")
    left = sized.join(t, sized["source"].eqNullSafe(t["_source"])).filter("size = 0 OR NOT target > 0").select(
        *columns, F.lit(0).cast("long").alias("times"))
    return queued.union(left).withColumn("taken", F.col("times") * F.col("size")).drop("row")


def mixed_documents(docs: DataFrame, seed: int = 42) -> DataFrame:
    """The mix itself: every document as many times as it is taken, with the columns of ``docs``."""
    times = (mix(docs, seed=seed).groupBy("doc_id", "ident").agg(F.sum("times").alias("_times"))
             .filter("_times > 0").withColumnsRenamed({"doc_id": "_doc_id", "ident": "_ident"}))
    named = set_apart(docs, ("doc_id", "text", "source"))
    once = (named.withColumn("_key", F.xxhash64("text", "source"))
            .withColumn("_copy", F.row_number().over(Window.partitionBy("doc_id", "_key").orderBy(F.lit(1))))
            .filter("_copy = 1"))
    joined = once.join(times, once["doc_id"].eqNullSafe(times["_doc_id"]) & (once["_key"] == times["_ident"]))
    return joined.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))).select(
        *named.columns).toDF(*docs.columns)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` mixed to the cyclic weights 1, 2, 3 under a budget of all words."""
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
         md5('42:' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, 3 * source_size AS cap,
         row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS k FROM src),
levels AS (
  SELECT k, weight, cap,
         ((SELECT sum(source_size) FROM src) - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked),
chosen AS (SELECT level FROM levels WHERE level * weight <= cap ORDER BY k LIMIT 1),
targets AS (
  SELECT source, source_size,
         (CASE WHEN level * weight > cap THEN cap ELSE level * weight END)::DOUBLE AS target
  FROM ranked, chosen),
queued AS (
  SELECT s.*, t.source_size, t.target,
         sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS through
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT *, ((epoch - 1) * source_size + through) / target AS finish
  FROM (SELECT *, unnest(generate_series(1, ceil(target / source_size)::BIGINT)) AS epoch FROM queued WHERE target > 0)),
mixed AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, epoch, key, doc_id ROWS UNBOUNDED PRECEDING) AS total
  FROM copies),
taken AS (
  SELECT doc_id, (sum(size))::BIGINT AS taken FROM mixed
  WHERE total <= (SELECT sum(source_size) FROM src) GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(t.taken, 0)::BIGINT AS taken
FROM queued q LEFT JOIN taken t USING (doc_id)
"""
