"""Folders with the edge rows and with empty tables."""

import pytest

from llm_rows import SCHEMA, edge_rows


@pytest.fixture(scope="session")
def edge(spark, tmp_path_factory):
    """Folder with the edge rows as ``documents.parquet``."""
    folder = str(tmp_path_factory.mktemp("edge"))
    spark.createDataFrame(edge_rows(), SCHEMA).repartition(5).write.parquet(f"{folder}/documents.parquet")
    return folder


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    return folder


@pytest.fixture(scope="session")
def docs(spark, edge):
    return spark.read.parquet(f"{edge}/documents.parquet")
