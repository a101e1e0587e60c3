"""Scoring texts with a probabilistic suffix tree over words.

States are contexts of no word (the root), one word and two words.  A context
is a candidate if it lists a next word, which is one that follows it
``LEAST_COUNT`` times or more, at every size of the corpus.  It is retained if
its next words diverge from those of its parent (the context without its first
word): its count times the divergence must exceed half the logarithm of the
count for each next word that it lists.  A token is scored in the longest
retained state, by absolute discounting: listed words have their discounted
share plus the parent's probability of the mass that is left, all others that
mass times the parent's probability.  The root is add-one over all training
words and one unknown word, so every state's probabilities sum to one.

The counts, the retained states and the listed words are tables and grow with
the corpus.  The logarithm of a token's probability is a sum of what its word,
its pair and its triple add (``train``), so texts are scored by a cogroup of their
n-grams with one table of such sums: both are dealt to buckets by key, and the
n-grams of a batch of texts go to a bucket as one row.  Only two things are broadcast, and neither
changes a result: the sums of the n-grams above a share of the training tokens
(so no key of the join is hot in training), and a filter that knows most of the
pairs and triples that add nothing.

Words are known by a 63-bit hash of their bytes, eight at a time, pairs and triples in the join by a 64-bit one.

Edge cases: a NULL or empty text is the end token alone; a NULL doc_id is never
held out; repeated rows are scored one by one; without training documents all
tokens have the probability of the unknown word; texts of any length are scored
whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftscore.llm.common import documents, remainder, set_apart, shuffle_partitions, store, text_batches
from shiftscore.session import delete_path

#: Shares of the training tokens from which words, and pairs and triples, are also broadcast.
WORD_SHARE, ENTRY_SHARE = 5e-7, 1e-6
LEAST_COUNT, DISCOUNT = 2, 0.75
#: Words of more bytes are hashed one by one.
LONG_WORD = 64
#: Spark's setting that removes a query's shuffle files when the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Tokens that a task counts before it hands on what it has.
FLUSH_TOKENS = 1_000_000
#: Buckets of counts for each shuffle partition.
COUNT_BUCKETS = 4
#: Bits of a filter for each key, and the most bits, as a power of two.
KEY_BITS, FILTER_BITS = 12, 28
#: Parts of the n-grams that texts are joined to one after the other, so that less is shuffled at a time.
ROUNDS = 8
#: Training tokens for each bucket of n-grams, and rows of n-grams that a bucket looks up at a time.
BUCKET_TOKENS, LOTS = 1_000_000, 256

#: Hashes of what is no word.
END, START = (xxhash.xxh64_intdigest(x) >> 1 for x in (b"\n", b"\n\n"))
#: Stands for the word before, where a word is counted by itself.
ALONE = -1


@contextmanager
def no_shuffle_left(spark: SparkSession) -> Iterator[None]:
    """Queries that are made and run in here leave none of their shuffle files."""
    before_ = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before_)


def written(df: DataFrame, name: str) -> DataFrame:
    """``store``, without leaving the shuffle files of the way there."""
    with no_shuffle_left(df.sparkSession):
        return store(df, name)


def drop(stored: DataFrame) -> None:
    """Remove a stored table that nothing reads any more."""
    delete_path(stored.sparkSession, stored.inputFiles()[0].rsplit("/", 1)[0])


def mixed(h: np.ndarray) -> np.ndarray:
    """One to one, each bit of the result depends on all of ``h``."""
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def word_hashes(words: pa.StringArray) -> np.ndarray:
    """63-bit hashes of words, none of them empty."""
    cuts = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
    size = int(cuts[-1])
    data = np.zeros(size + 8, np.uint8)
    if size:
        data[:size] = np.frombuffer(words.buffers()[2], np.uint8, size)
    eight = np.ndarray(size + 1, "<u8", data, strides=(1,))  # the eight bytes from each byte on
    at, left = cuts[:-1], np.diff(cuts)
    out = mixed(left.astype(np.uint64))
    for k in np.flatnonzero(left > LONG_WORD):
        out[k] = xxhash.xxh64_intdigest(data[cuts[k]:cuts[k + 1]].tobytes())
    where = np.flatnonzero(left <= LONG_WORD)
    at, left = at[where], left[where]
    while len(where):
        beyond = (8 * (8 - np.clip(left, 1, 8))).astype(np.uint64)  # bits of other words
        out[where] = mixed(out[where] ^ (eight[at] << beyond))
        more = np.flatnonzero(left > 8)
        where, at, left = where[more], at[more] + 8, left[more] - 8
    return (out >> np.uint64(1)).view(np.int64)


def joined(a: np.ndarray, b: np.ndarray, by: int) -> np.ndarray:
    """``a`` rotated left, xor ``b``."""
    u = a.view(np.uint64)
    return ((u << np.uint64(by)) | (u >> np.uint64(64 - by))).view(np.int64) ^ b


def joined_column(a: str, b: str, by: int) -> Column:
    return F.shiftleft(a, by).bitwiseOR(F.shiftrightunsigned(a, 64 - by)).bitwiseXOR(F.col(b))


#: How far the first part is rotated in the key of a pair (of two words) and of a triple (of two pairs).
PAIR, TRIPLE = 21, 13


def hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' words one after the other, each text with its end, and where each text starts."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    words = lists.flatten()
    there = np.diff(np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]) > 0
    cuts = np.concatenate(([0], np.cumsum(there)))[lists.offsets.to_numpy()]
    n = np.diff(cuts)
    out = np.full(cuts[-1] + len(n), END, dtype=np.int64)
    out[np.arange(cuts[-1]) + np.repeat(np.arange(len(n)), n)] = word_hashes(words)[there]
    return out, cuts[:-1] + np.arange(len(n))


def before(own: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The word before each word, or the start."""
    out = np.concatenate(([START], own[:-1]))
    out[starts] = START
    return out


def pairs_before(pairs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The key of the pair before each pair, and whether there is one in the text."""
    there = np.ones(len(pairs), dtype=bool)
    there[starts] = False
    return np.concatenate(([0], pairs[:-1])), there


def runs(*columns: np.ndarray) -> np.ndarray:
    """Where rows differ from the row before."""
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def distinct(key: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each key once, as the two parts of one occurrence, and how often it is there."""
    order = np.argsort(key)
    at = runs(key[order])
    n, at = np.diff(np.append(at, len(key))), order[at]
    return first[at], second[at], n


def words_and_pairs(own: np.ndarray, starts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    b = before(own, starts)
    return [distinct(own, np.full(len(own), ALONE), own), distinct(joined(b, own, PAIR), b, own)]


class Filter:
    """Bits of keys: a key without its bit isn't in the table, one with it may be."""

    def __init__(self, keys: DataFrame):
        self.log = min(FILTER_BITS, max(6, (KEY_BITS * keys.count()).bit_length()))
        at = F.shiftrightunsigned("key", 64 - self.log)
        slots = keys.select(F.shiftrightunsigned(at, 6).alias("slot"), F.call_function(
            "shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
        with no_shuffle_left(keys.sparkSession):
            table = slots.groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most 2^FILTER_BITS / 64
        self.bits = np.zeros(1 << (self.log - 6), dtype=np.int64)
        self.bits[table.column(0).to_numpy()] = table.column(1).to_numpy()

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        at = keys.view(np.uint64) >> np.uint64(64 - self.log)
        return (self.bits.view(np.uint64)[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def rotated(keys: np.ndarray) -> np.ndarray:
    u = keys.view(np.uint64)
    return (u << np.uint64(1)) | (u >> np.uint64(63))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets by all bits of a key but the first, which words lack."""
    return ((rotated(keys) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).view(np.int64)


def lists(values: np.ndarray, cuts: np.ndarray) -> pa.ListArray:
    """A list for each two neighbours of ``cuts``."""
    return pa.ListArray.from_arrays(pa.array(cuts - cuts[0], pa.int32()), pa.array(values[cuts[0]:cuts[-1]]))


def flat(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy()


def counted(docs: DataFrame, grams_of: Callable[[np.ndarray, np.ndarray], list]) -> DataFrame:
    """``a, b, n``: how often each (a, b) of ``grams_of(hashes, starts)`` is in all texts; of two words or pairs, if ``LEAST_COUNT`` times or more.

    A task counts a lot of texts and hands on a row of lists for each bucket.  Rows are dealt and
    ordered by the key of triples, in which no word of two pairs cancels out.
    """
    buckets = COUNT_BUCKETS * shuffle_partitions(docs.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            lengths = np.cumsum([0, *(len(own) for own, _ in held)])
            own = np.concatenate([own for own, _ in held])
            for a, b, n in grams_of(own, np.concatenate([s + at for (_, s), at in zip(held, lengths)])):
                order = np.argsort(rotated(joined(a, b, TRIPLE)))
                a, b, n = a[order], b[order], n[order]
                cuts = np.searchsorted(bucket_of(joined(a, b, TRIPLE), buckets), np.arange(buckets + 1))
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets)), *[lists(x, cuts) for x in (a, b, n)]], ["bucket", "a", "b", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(hashes(batch.column(0)))
            size += len(held[-1][0])
            if size >= FLUSH_TOKENS:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    def total(parts: pa.Table) -> pa.Table:
        a, b, n = (flat(parts.column(c)) for c in ("a", "b", "n"))
        order = np.argsort(joined(a, b, TRIPLE))
        a, b = a[order], b[order]
        at = runs(a, b)
        n = np.add.reduceat(n[order], at) if len(at) else n
        kept = (a[at] == ALONE) | (n >= LEAST_COUNT)
        return pa.table([a[at][kept], b[at][kept], n[kept]], ["a", "b", "n"])

    lots = docs.select("text").mapInArrow(of, "bucket long, a array<long>, b array<long>, n array<long>").filter(F.size("a") > 0)
    return lots.groupBy("bucket").applyInArrow(total, "a long, b long, n long")


def states(listed: DataFrame, totals: DataFrame) -> DataFrame:
    """``context, total, left``: the contexts of ``listed`` (context, n, parent) that diverge, and the mass that each leaves to its parent.

    ``totals`` has the ``total`` of each ``context``.
    """
    sums = listed.groupBy("context").agg(
        F.sum("n").alias("s"), F.count("*").alias("k"), F.sum("parent").alias("p"),
        F.sum(F.col("n") * (F.log(F.col("n").cast("double")) - F.log("parent"))).alias("d"))
    total = F.col("total").cast("double")
    rest = F.greatest(1 - F.col("s") / total, F.lit(0.0))
    rest_parent = F.greatest(1 - F.col("p"), F.lit(1e-12))
    divergence = (F.col("d") - F.col("s") * F.log(total)) / total + F.when(rest > 0, rest * F.log(rest / rest_parent)).otherwise(0.0)
    left = F.greatest(1 - (F.col("s") - DISCOUNT * F.col("k")) / total, F.lit(1e-300))
    return sums.join(totals, "context").filter(total * divergence > 0.5 * F.log(F.greatest(total, F.lit(1.0))) * F.col("k")).select(
        "context", "total", left.alias("left"))


def within(listed: DataFrame, kept: DataFrame, how: str = "inner") -> DataFrame:
    """The words that retained contexts list, with their probability ``own`` and ``delta``, what it adds to the logarithm."""
    own = (F.col("n") - DISCOUNT) / F.col("total") + F.col("left") * F.col("parent")
    return listed.join(kept, "context", how).withColumn("own", own).withColumn(
        "delta", F.log10("own") - F.log10("parent") - F.log10("left"))


def summed(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    """The keys of ``key, base, delta, known`` in order, each once, and the sums of the other columns."""
    key = table.column("key").to_numpy()
    order = np.argsort(key)
    key = key[order]
    at = runs(key)
    return key[at], [np.add.reduceat(table.column(c).to_numpy()[order].astype(np.float64), at) if len(at) else np.zeros(0)
                     for c in ("base", "delta", "known")]


def places_of(keys: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``keys`` in an ordered ``table``, and whether they are there."""
    if not len(table):
        return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
    order = np.argsort(keys)  # neighbours are looked up one after the other
    at = np.empty(len(keys), dtype=np.int64)
    at[order] = np.minimum(np.searchsorted(table, keys[order]), len(table) - 1)
    return at, table[at] == keys


class Model:
    """The sums of the frequent n-grams, in order of their keys, and the filter of all pairs and triples."""

    def __init__(self, frequent: DataFrame, filter_: Filter, n: int, v: int):
        self.n, self.total, self.filter = n, n + v + 1, filter_
        # The caller bounds the rows.
        self.keys, (self.base, self.delta, self.known) = summed(frequent.select("key", "base", "delta", "known").toArrow())

    def sums(self, own: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each token what the frequent n-grams add: base, delta, known; and places and keys of the n-grams to be joined."""
        pairs = joined(before(own, starts), own, PAIR)
        last, there = pairs_before(pairs, starts)
        triples = joined(last, pairs, TRIPLE)
        base, delta, known = np.zeros(len(own)), np.zeros(len(own)), np.zeros(len(own))
        places, keys = [], []
        second, third = np.flatnonzero(self.filter.may_hold(pairs)), np.flatnonzero(there & self.filter.may_hold(triples))
        for at, key in ((np.arange(len(own)), own), (starts, np.full(len(starts), START)), (second, pairs[second]), (third, triples[third])):
            place, found = places_of(key, self.keys)
            hit, place = at[found], place[found]
            base[hit] += self.base[place]
            delta[hit] += self.delta[place]
            known[hit] += self.known[place]
            places.append(at[~found])
            keys.append(key[~found])
        return base, delta, known, np.concatenate(places), np.concatenate(keys)


def train(docs: DataFrame) -> tuple[Broadcast, DataFrame]:
    """The model of all ``docs`` (broadcast), and the table ``key, base, delta, known`` of the n-grams that aren't in it.

    A token's probability has the logarithm log10(1 / total), plus ``base`` of
    its word, plus ``delta`` of its word as a context (for the next token), of
    its pair as listed and as a context, and of its triple as listed.
    """
    spark = docs.sparkSession
    text_batches(spark)
    grams = written(counted(docs, words_and_pairs), "grams")
    words = written(grams.filter(F.col("a") == ALONE).select(F.col("b").alias("word"), "n"), "words")
    n, v, n_docs = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"),
                             F.coalesce(F.sum(F.when(F.col("word") == END, F.col("n"))), F.lit(0))).first()
    total = float(n + v + 1)

    # One word: every word and the start of a text.
    root = words.select(F.col("word").alias("b"), ((F.col("n") + 1) / F.lit(total)).alias("parent"))
    pairs = written(grams.filter(F.col("a") != ALONE).join(root, "b").select(
        F.col("a").alias("context"), joined_column("a", "b", PAIR).alias("key"), "n", "parent"), "pairs")
    drop(grams)
    start = spark.range(1).select(F.lit(START).alias("context"), F.lit(n_docs).alias("total"))
    one = written(states(pairs, words.select(F.col("word").alias("context"), F.col("n").alias("total")).union(start)), "one")
    every_pair = written(within(pairs, one, "left").select("key", "n", "own", "delta"), "every-pair")  # no own: the context isn't retained
    drop(pairs)
    listed1 = every_pair.filter("own IS NOT NULL")

    # Two words: pairs whose last word is retained; next words are those that the last word lists.
    firsts, seconds = spark.sparkContext.broadcast(Filter(every_pair)), spark.sparkContext.broadcast(Filter(listed1))

    def triples_of(own: np.ndarray, starts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        own = joined(before(own, starts), own, PAIR)
        last, there = pairs_before(own, starts)
        at = np.flatnonzero(there & seconds.value.may_hold(own) & firsts.value.may_hold(last))
        return [distinct(joined(last[at], own[at], TRIPLE), last[at], own[at])]

    parents = listed1.select(F.col("key").alias("b"), F.col("own").alias("parent"))
    grams = written(counted(docs, triples_of), "grams")
    triples = written(grams.join(parents, "b").select(
        F.col("a").alias("context"), joined_column("a", "b", TRIPLE).alias("key"), "n", "parent"), "triples")
    drop(grams)
    two = written(states(triples, every_pair.select(F.col("key").alias("context"), F.col("n").alias("total"))), "two")
    listed2 = written(within(triples, two).select("key", "n", "delta"), "listed2")
    drop(triples)
    firsts.destroy()
    seconds.destroy()

    def added(df: DataFrame, share: float, key: str, n_: str, delta: Column, base: Column = F.lit(0.0), known: int = 0) -> DataFrame:
        return df.select(F.col(key).alias("key"), base.alias("base"), delta.alias("delta"), F.lit(known).alias("known"),
                         (F.col(n_) >= share * n).alias("frequent"))

    left = F.log10("left")
    more = added(listed1, ENTRY_SHARE, "key", "n", F.col("delta")).union(added(two, ENTRY_SHARE, "context", "total", left)).union(
        added(listed2, ENTRY_SHARE, "key", "n", F.col("delta")))
    every = added(words, WORD_SHARE, "word", "n", F.lit(0.0), F.log10(F.col("n") + 1), 1).union(
        added(one, WORD_SHARE, "context", "total", left)).union(more)
    model = Model(every.filter("frequent"), Filter(more), n, v)  # at most two for each share of a word, pair or triple
    table = written(every.filter("NOT frequent").drop("frequent"), "sums")
    for stored in (words, one, every_pair, two, listed2):
        drop(stored)
    return spark.sparkContext.broadcast(model), table


def bucket_column(key: str, buckets: int) -> Column:
    return F.shiftright(F.shiftrightunsigned(F.shiftleft(key, 1), 32) * F.lit(buckets).cast("long"), 32)


def met(grams: pa.Table, table: pa.Table) -> pa.Table:
    """For each batch of texts what the n-grams of a bucket add to its texts (``at``: their places in the batch)."""
    keys, sums = summed(table)
    out = []
    for k in range(0, grams.num_rows, LOTS):
        some = grams.slice(k, LOTS)
        key, at, times = (flat(some.column(c)) for c in ("keys", "at", "times"))
        place, found = places_of(key, keys)
        lot = np.repeat(np.arange(some.num_rows), pc.list_value_length(some.column("keys")).to_numpy())[found]
        at, times, place = at[found], times[found], place[found]
        size = int(at.max(initial=0)) + 1
        slots = lot * size + at
        there = np.flatnonzero(np.bincount(slots, minlength=some.num_rows * size))
        cuts = np.searchsorted(there, np.arange(some.num_rows + 1) * size)
        base, delta, known = (np.bincount(slots, x[place] * times, some.num_rows * size)[there].astype(np.float64) for x in sums)
        out.append(pa.table([some.column("lot"), lists((there % size).astype(np.int32), cuts), lists(base, cuts), lists(delta, cuts),
                             lists(known.astype(np.int64), cuts)], MET.names))
    return pa.concat_tables(out) if out else MET.empty_table()


MET = pa.schema([("lot", pa.int64()), ("at", pa.list_(pa.int32())), ("base", pa.list_(pa.float64())),
                 ("delta", pa.list_(pa.float64())), ("known", pa.list_(pa.int64()))])


def added_up(found: pa.Table) -> pa.Table:
    """What all buckets add to each text of a batch."""
    at, lot = flat(found.column("at")), found.column("lot")[0].as_py()
    base, delta, known = (np.bincount(at, flat(found.column(c))).astype(np.float64) for c in ("base", "delta", "known"))
    return pa.table([lot + np.arange(len(base)), base, delta, known.astype(np.int64)], ["_row", "_more_base", "_more_delta", "_more_known"])


def score(docs: DataFrame, model: Broadcast, table: DataFrame) -> DataFrame:
    """``docs`` without ``text``, with ``n_tokens, n_known, train_tokens, base_score, score`` (in place of columns of these names)."""
    spark = docs.sparkSession
    text_batches(spark)
    train_tokens, unknown = model.value.n, -np.log10(float(model.value.total))
    added = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    named = set_apart(docs.drop(*added), ("text",))
    others = [c for c in named.columns if c != "text"]
    dealt = max(shuffle_partitions(spark), -(-train_tokens // (BUCKET_TOKENS * ROUNDS)))  # buckets of a round
    buckets = dealt * ROUNDS
    parts = [f"_{c}{k}" for k in range(ROUNDS) for c in ("keys", "at", "times")]  # columns for each round, which reads no others
    own_columns = [*others, "_row", "n_tokens", "_known", "_base", "_delta"]
    columns = [*own_columns, "_bucket", *parts]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own, starts = hashes(batch.column(batch.num_columns - 1))
            base, delta, known, places, keys = model.value.sums(own, starts)
            n = np.diff(np.append(starts, len(own)))
            lot = batch.column(batch.num_columns - 2)[0].as_py()  # the first row's id; ids rise by one at least
            texts = [*batch.columns[:-2], pa.array(lot + np.arange(len(n))), pa.array(n), pa.array(np.add.reduceat(known, starts).astype(np.int64)),
                     pa.array(np.add.reduceat(base, starts) + n * unknown), pa.array(np.add.reduceat(delta, starts))]
            # The n-grams to be joined by bucket and key, each once for a text.
            at = np.repeat(np.arange(len(n), dtype=np.int32), n)[places]
            order = np.argsort(rotated(keys), kind="stable")
            keys, at = keys[order], at[order]
            first = runs(keys, at)
            times = np.diff(np.append(first, len(keys))).astype(np.int32)
            keys, at = keys[first], at[first]
            cuts = np.searchsorted(bucket_of(keys, buckets), np.arange(buckets + 1))
            listed = [lists(x, cuts[k * dealt:(k + 1) * dealt + 1]) for k in range(ROUNDS) for x in (keys, at, times)]
            yield pa.RecordBatch.from_arrays([*texts, pa.nulls(len(n), pa.int64()), *[pa.nulls(len(n), x.type) for x in listed]], columns)
            none = [pa.nulls(dealt, x.type) for x in texts]
            none[len(others)] = pa.array(np.full(dealt, lot))
            yield pa.RecordBatch.from_arrays([*none, pa.array(np.arange(dealt)), *listed], columns)

    rows = named.select(*others, F.monotonically_increasing_id().alias("_row"), "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("text").schema)
    fields += ", n_tokens long, _known long, _base double, _delta double, _bucket long, "
    read = written(rows.mapInArrow(of, fields + ", ".join(
        f"{c} array<{'long' if c.startswith('_keys') else 'int'}>" for c in parts)), "scored")

    # The n-grams that aren't frequent.
    text_batches(spark, 10_000)
    found = None
    for k in range(ROUNDS):
        grams = read.filter(F.size(f"_keys{k}") > 0).select(
            (F.col("_bucket") + k * dealt).alias("bucket"), F.col("_row").alias("lot"),
            *[F.col(f"_{c}{k}").alias(c) for c in ("keys", "at", "times")])
        sums = table.withColumn("bucket", bucket_column("key", buckets)).filter(F.col("bucket").between(k * dealt, (k + 1) * dealt - 1))
        part = written(grams.groupBy("bucket").cogroup(sums.groupBy("bucket")).applyInArrow(
            met, "lot long, at array<int>, base array<double>, delta array<double>, known array<long>"), "met")
        found = part if found is None else found.union(part)
    rest = found.groupBy("lot").applyInArrow(added_up, "_row long, _more_base double, _more_delta double, _more_known long")
    none = F.lit(0.0)
    base = F.col("_base") + F.coalesce("_more_base", none)
    return read.filter("_bucket IS NULL").select(own_columns).join(rest, "_row", "left").select(
        *others, "n_tokens", (F.col("_known") + F.coalesce("_more_known", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"), (base + F.col("_delta") + F.coalesce("_more_delta", none)).alias("score")).toDF(
        *[c for c in docs.columns if c not in ("text", *added)], *added)


def op5_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` scored, learning from those outside fold 2 of 7."""
    held = F.coalesce(remainder(F.col("doc_id"), 7) == 2, F.lit(False))
    docs = documents(spark, sf_dir).select("doc_id", held.alias("held_out"), "text")
    model, table = train(docs.filter("NOT held_out"))
    return score(docs, model, table)
