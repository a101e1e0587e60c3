"""Operator 8 against the full comparison."""

import contextlib
import glob
import os
import threading
import time

import duckdb
import numpy as np
import pytest

from shiftscore.llm import embedding_dedup, registry

import reference as R


def vectors(n=400, d=64, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d))
    x[50:110] = x[50] + rng.standard_normal((60, d)) * 0.12     # a group of near copies
    x[110:130] = x[7]                                            # exact copies
    x[130] = x[7] * 3.5                                          # the same direction
    chain = x[131]
    for k in range(132, 150):                                    # a chain, each near the one before
        chain = chain + rng.standard_normal(d) * 0.22
        x[k] = chain
    return x.astype(np.float32)


def plain(rows, least=0.95):
    good = [(k, np.array(v, dtype=float)) for k, (_, v) in enumerate(rows)
            if v is not None and None not in v and np.isfinite(np.array(v, dtype=float)).all() and np.any(np.array(v, dtype=float))]
    links = set()
    for i, (a, x) in enumerate(good):
        for b, y in good[:i]:
            if len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                links |= {(a, b), (b, a)}
    least_id = R.least_reachable(len(rows), lambda i, j: (i, j) in links, [r[0] for r in rows])
    n = [0] * len(rows)
    for a, _ in links:
        n[a] += 1
    return sorted(([r[0], n[k], least_id[k], r[0] == least_id[k]] for k, r in enumerate(rows)), key=repr)


def found(df):
    return sorted(([r.vec_id, r.n_links, r.component_id, r.kept] for r in df.collect()), key=repr)


@pytest.mark.parametrize("piece", [7, 2000])
def test_all_links_and_components(spark, monkeypatch, piece):
    monkeypatch.setattr(embedding_dedup, "PIECE", piece)
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(vectors())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    want = plain(rows)
    assert sum(w[1] for w in want) > 500
    assert found(embedding_dedup.near_duplicates(df)) == want


def test_unusable_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 3.0]), (2, [2.0, 4.0, 6.0]), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [nan, 1.0, 1.0]),
            (7, [inf, 1.0, 1.0]), (8, [None, 1.0, 1.0]), (9, [1.0, 2.0]), (10, [1.0, 2.0]), (11, [-1.0, -2.0, -3.0]),
            (12, [1e-30, 2e-30, 3e-30]), (2, [2.0, 4.0, 6.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, uid int, h0 int")
    assert found(embedding_dedup.near_duplicates(df)) == plain(rows)


def test_query_matches_sql_and_brute_force(spark, tmp_path):
    rows = [(k * 3, [float(c) for c in v]) for k, v in enumerate(vectors(200, 16, 2))]
    path = f"{tmp_path}/embeddings.parquet"
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/*.parquet'")
    want = sorted(([*r] for r in con.execute(
        f"SELECT vec_id, n_links, component_id, kept FROM ({embedding_dedup.ORACLE})").fetchall()), key=repr)
    assert found(registry.QUERIES["op8_embedding_dedup"](spark, str(tmp_path))) == want == plain(rows)


def test_dense_group_is_not_emitted_as_pairs(spark):
    """600 near copies have 180 000 pairs; what tasks return stays near the number of vectors."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal(64) + rng.standard_normal((600, 64)) * 0.05
    reps = spark.createDataFrame([(k, 1, [float(c) for c in v]) for k, v in enumerate(x)], "uid long, copies long, vector array<float>")
    met = embedding_dedup.links_of(reps, 64, 600, 0.95)
    total = {r.uid: r["sum(n)"] for r in met.groupBy("uid").sum("n").collect()}
    assert all(n == 599 for n in total.values()) and len(total) == 600
    assert met.count() < 20_000


def shuffled_bytes(spark, work):
    """The result of ``work()``, and the bytes of the shuffle files that were there while it ran."""
    folders = [f.getPath() for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    sizes, over = {}, threading.Event()

    def watch():
        while not over.wait(0.05):
            for path in (p for folder in folders for p in glob.glob(f"{folder}/*/shuffle_*.data*")):
                with contextlib.suppress(OSError):  # a file may go meanwhile
                    name = os.path.basename(path).split(".data")[0]
                    sizes[name] = max(sizes.get(name, 0), os.path.getsize(path))

    thread = threading.Thread(target=watch)
    thread.start()
    time.sleep(0.5)
    before = set(sizes)
    try:
        result = work()
    finally:
        over.set()
        thread.join()
    return result, sum(n for name, n in sizes.items() if name not in before)


def test_vectors_are_not_copied_for_the_comparison(spark):
    """Vectors spread evenly are near most others in few dimensions; each is shuffled once all the same."""
    x = np.random.default_rng(4).standard_normal((4000, 64)).astype(np.float32)
    x[3000:3050] = x[:50] * 2
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    result, shuffled = shuffled_bytes(spark, lambda: found(embedding_dedup.near_duplicates(df)))
    assert shuffled < 4 * x.nbytes
    assert {r[0] for r in result if r[1]} == {*range(50), *range(3000, 3050)}


@pytest.mark.parametrize("kind", ["float", "double"])
def test_dense_groups_about_the_limit(spark, monkeypatch, kind):
    """Groups whose cosines lie about 0.95, far from one another, over several tiles, strips and blocks."""
    monkeypatch.setattr(embedding_dedup, "PIECE", 330)
    rng = np.random.default_rng(5)
    x = (rng.standard_normal((3, 64)) * 3)[rng.integers(0, 3, 700)] + rng.standard_normal((700, 64)) * 0.69
    rows = [(k, v.tolist()) for k, v in enumerate(x.astype(np.float32 if kind == "float" else float))]
    want = plain(rows)
    assert 0.2 < sum(w[1] for w in want) / (700 * 233) < 0.8
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
    assert found(embedding_dedup.near_duplicates(df)) == want
