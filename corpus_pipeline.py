"""A corpus from ``documents`` to packed windows: five stages, each an operator of ``shiftscore.llm``.

Each stage works on all that the one before it kept, written as Parquet and
read again, so a stage that fails is repeated from its predecessor's files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shiftscore.llm import language, mixing, packing, secrets, simhash_dedup
from shiftscore.session import scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without letters or with a score near chance go."""
    return language.identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: 3-word shingles, 2 bits."""
    return simhash_dedup.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts masked."""
    return secrets.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix to the sources' target weights: a document is there as often as it is taken."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in windows of 4096 tokens."""
    return packing.packed_documents(docs)


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_dedup),
    ("secret scans", secret_scan),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack),
]

#: Language ID, XXH64 and the tokenizer have no SQL; tests/llm/test_pipeline.py has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
