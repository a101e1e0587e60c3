"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Documents are hashed n-gram counts (1 to 3 letters, runs of anything else as
one space).  Document frequencies cover all training documents.  The weights
are fitted by follow-the-regularised-leader (per-coordinate steps, L1 and L2
penalty) on a sample that is bounded by ``SAMPLE_PER_LANGUAGE`` documents of
each language in expectation, drawn by a hash of doc_id and text, whatever ids
repeat or are missing; a part of the sample is kept back to fit the temperature
that calibrates the scores.

Edge cases: a text that is NULL or has no letter is ``und`` with score 0, and so
is every text if nothing could be learned; rows with a NULL lang or text, or a
text without letters, teach nothing; a single learned language always has
score 1; a NULL doc_id is never held out; repeated rows are repeated in the
result; long texts are counted in chunks, whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftscore.llm.common import documents, remainder, set_apart, text_batches

FEATURES = 1 << 15
ORDERS = (1, 2, 3)
CHUNK = 1 << 20
SAMPLE_PER_LANGUAGE = 1000
#: FTRL: learning rate and its offset, penalties, passes over the sample.
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.02, 0.1, 2
UNKNOWN = "und"
#: A score under this many times 1 / languages is near chance; of two languages the best one has 0.5 at least and is kept.
OVER_CHANCE = 1.2


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def ngram_counts(text: str) -> np.ndarray | None:
    """Counts of hashed n-grams of a whole text; None if it has no letter."""
    total = None
    for at in range(0, len(text), CHUNK):
        low = text[at:at + CHUNK + max(ORDERS) - 1].lower()  # n-grams across the cut are in the earlier chunk
        codes = np.frombuffer(low.encode("utf-32-le", "replace"), dtype=np.uint32)
        letter = _letters()[codes]
        if not letter.any():
            continue
        codes = np.where(letter, codes, 32).astype(np.uint64)
        codes = codes[letter | np.concatenate(([True], letter[:-1]))]  # a run of others is one space
        grams, found = np.zeros(len(codes), dtype=np.uint64), []
        for n in range(1, max(ORDERS) + 1):
            if len(codes) < n:
                break
            grams = grams[:len(codes) - n + 1] * np.uint64(0x110000) + codes[n - 1:]
            if n in ORDERS:
                mixed = (grams + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
                found.append((mixed >> np.uint64(64 - FEATURES.bit_length() + 1)).astype(np.int64))
        counts = np.bincount(np.concatenate(found), minlength=FEATURES)
        total = counts if total is None else total + counts
    return total


def vector(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and their TF-IDF weights, of length 1."""
    at = np.flatnonzero(counts)
    x = (1.0 + np.log(counts[at])) * idf[at]
    return at, x / math.sqrt(float(x @ x))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of ``texts`` (column ``text``) each feature is, and the number of texts with a letter."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(FEATURES, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text and (counts := ngram_counts(text)) is not None:
                    seen += counts > 0
                    n += 1
        features = np.append(np.arange(FEATURES), -1)
        yield pa.RecordBatch.from_arrays([pa.array(features), pa.array(np.append(seen, n))], ["feature", "n"])

    sums = texts.select("text").mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    rows = sums.toPandas()  # one row for each feature
    seen = np.zeros(FEATURES + 1, dtype=np.int64)
    seen[rows["feature"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.int64)  # -1 is the last one
    return seen[:-1], int(seen[-1])


def ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int) -> np.ndarray:
    """Weights (classes x features) after ``EPOCHS`` passes over (class, features, values)."""
    z, n = np.zeros((classes, FEATURES)), np.zeros((classes, FEATURES))
    for _ in range(EPOCHS):
        for own, at, x in rows:
            zi, ni = z[:, at], n[:, at]
            w = solved(zi, ni)
            g = softmax(w @ x)
            g[own] -= 1.0
            g = np.outer(g, x)
            root = np.sqrt(ni + g * g)
            z[:, at] = zi + g - (root - np.sqrt(ni)) / ALPHA * w
            n[:, at] = ni + g * g
    return solved(z, n)


def solved(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weights that minimise the regularised past: zero within the L1 penalty."""
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def softmax(v: np.ndarray) -> np.ndarray:
    e = np.exp(v - v.max())
    return e / e.sum()


def temperature(logits: list[np.ndarray], own: list[int]) -> float:
    """The scale that makes held-back documents likeliest, by golden-section search over its logarithm."""
    if not logits:
        return 1.0
    v, y = np.array(logits), np.array(own)

    def loss(t: float) -> float:
        s = v / math.exp(t)
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    lo, hi, r = math.log(0.1), math.log(10.0), (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return math.exp((lo + hi) / 2)


class Model:
    """Learned languages, feature weights and temperature: a few hundred kilobytes a language."""

    def __init__(self, languages: list[str], idf: np.ndarray, weights: np.ndarray, scale: float):
        self.languages, self.idf, self.weights, self.scale = languages, idf, weights, scale

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = ngram_counts(text) if text and self.languages else None
        if counts is None:
            return UNKNOWN, 0.0
        at, x = vector(counts, self.idf)
        p = softmax(self.weights[:, at] @ x / self.scale)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def drawn(labelled: DataFrame, shares: dict[str, float]) -> DataFrame:
    """``doc_id, text, lang``: a share of the rows of each language.

    Of n rows that are equal in all columns, n times the share are taken, up or
    down to a whole number by their hash, so the shares hold in expectation for
    every table.
    """
    share = F.create_map(*[F.lit(x) for k, v in shares.items() for x in (k, v)])
    own = labelled.withColumn("text_key", F.xxhash64("text"))
    taken = F.col("n") * share[F.col("lang")] + F.pmod("draw", F.lit(1 << 30)) / float(1 << 30)
    # No text is moved before the draw; the keys drawn are bounded by the sample.
    keys = own.groupBy("lang", "doc_id", "text_key").agg(F.count("*").alias("n")).withColumn(
        "draw", F.xxhash64("doc_id", "text_key")).select(
        F.col("lang").alias("_lang"), F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "draw",
        F.floor(taken).cast("int").alias("times")).filter("times > 0")
    met = own.join(F.broadcast(keys), (own["lang"] == keys["_lang"]) & own["doc_id"].eqNullSafe(keys["_id"]) & (own["text_key"] == keys["_key"]))
    one = met.groupBy("lang", "doc_id", "text_key", "times").agg(F.min("text").alias("text"))
    return one.select("doc_id", "text", "lang", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("col")


def train(labelled: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Fit on ``doc_id, text, lang``; document frequencies from all rows, weights from the bounded sample."""
    labelled = labelled.select("doc_id", "text", "lang").filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # one row for each language
    languages = sorted(sizes)
    seen, n = document_frequencies(labelled)
    idf = np.log((1 + n) / (1 + seen)) + 1.0
    if not languages or not n:
        return Model([], idf, np.zeros((0, FEATURES)), 1.0)

    sample = drawn(labelled, {k: min(1.0, sample_per_language / n) for k, n in sizes.items()})
    codes = {k: i for i, k in enumerate(languages)}

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if (counts := ngram_counts(text)) is not None:
                    at, x = vector(counts, idf)
                    rows.append((codes[lang], at.astype(np.int32), x))
        held = rows[4::5]  # in hash order, so any fifth is as good as another
        weights = ftrl([r for k, r in enumerate(rows) if k % 5 != 4], len(languages))
        scale = temperature([weights[:, at] @ x for _, at, x in held], [k for k, _, _ in held])
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary()), pa.array([scale])], ["weights", "scale"])

    one = sample.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "lang").select("lang", "text")  # bounded by the sample
    row = one.mapInArrow(fit, "weights binary, scale double").first()
    return Model(languages, idf, np.frombuffer(row["weights"], dtype=np.float64).reshape(len(languages), FEATURES), row["scale"])


def predict(docs: DataFrame, model: Broadcast) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; only the column ``text`` is looked at."""
    schema = docs.schema
    columns = [f.name for f in schema]
    text_at = columns.index("text")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.value.predict(t) for t in batch.column(text_at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([k for k, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                [*columns, "lang_pred", "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return docs.mapInArrow(of, f"{fields}, lang_pred string, score double")


def identify(docs: DataFrame, folds: int = 5) -> DataFrame:
    """``docs`` with ``held_out, lang_pred, score`` (in place of columns of these names); learns from the documents outside fold 0 that have a lang."""
    return _identify(docs, folds)[0]


def _identify(docs: DataFrame, folds: int = 5) -> tuple[DataFrame, int]:
    """``identify``, and the number of languages learned."""
    spark = docs.sparkSession
    text_batches(spark)
    held = F.coalesce(remainder(F.col("doc_id"), folds) == 0, F.lit(False))
    model = spark.sparkContext.broadcast(train(docs.filter(~held)))
    return predict(docs.drop("lang_pred", "score").withColumn("held_out", held), model), len(model.value.languages)


def identified(docs: DataFrame, over_chance: float = OVER_CHANCE) -> DataFrame:
    """``docs`` without the documents that are in no known language: ``und``, or a score near that of chance among the learned languages."""
    named = set_apart(docs, ("doc_id", "text", "lang"))
    found, languages = _identify(named)
    found = found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min(0.5, over_chance / max(languages, 1))))
    return found.select(*named.columns).toDF(*docs.columns)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text of ``documents``, learned from the documents outside fold 0."""
    found = identify(documents(spark, sf_dir).select("doc_id", "text", "lang"))
    return found.select("doc_id", "held_out", "lang_pred", "score")
