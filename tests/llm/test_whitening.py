"""Operator 11 against the eigenvectors of the full covariance."""

import numpy as np
import pytest

from shiftscore.llm import registry, whitening

SCHEMA = "vec_id long, embedding array<float>, x int, size string, `a b` int"


def table(spark, tmp_path, rows):
    df = spark.createDataFrame([(k, v, 1, "s", 2) for k, v in rows], SCHEMA).repartition(5)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    return str(tmp_path)


def usable(v):
    return v is not None and len(v) > 0 and None not in v and np.isfinite(np.array(v, dtype=float)).all()


def plain(rows, wanted=16):
    """Sorted (vec_id, component, n, deviation) and, by component, whitened values up to the sign, for vectors of one length."""
    x = np.array([np.floor(64 * np.array(v, dtype=np.float32).astype(float)).astype(int) + 1_000_000 for _, v in rows])
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    centred = fit - total / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    good = values > 1e-18 * max(values[0], 1e-300)
    z = (x - total / n) @ vectors[:, good] / np.sqrt(values[good]) if good.any() else np.empty((len(x), 0))
    deviation = [sum((n * int(e) - int(t)) ** 2 for e, t in zip(r, total)) for r in x]
    return n, deviation, z, (values / np.trace(centred.T @ centred / n))[good] if good.any() else values[good]


def check(found, rows, wanted=16):
    n, deviation, z, explained = plain(rows, wanted)
    k = z.shape[1]
    assert len(found) == len(rows) * k
    want = sorted((i, d) for (i, _), d in zip(rows, deviation) for _ in range(k))
    assert sorted((r.vec_id, r.deviation) for r in found) == want and {r.n for r in found} <= {n}
    assert sorted({r.component for r in found}) == list(range(1, k + 1))
    for c in range(k):
        mine = {r.vec_id: r.whitened for r in found if r.component == c + 1}
        other = {i: v for (i, _), v in zip(rows, z[:, c])}
        sign = np.sign(sum(mine[i] * other[i] for i in mine))
        assert max(abs(mine[i] - sign * other[i]) for i in mine) < 1e-8
        assert all(abs(r.explained - explained[c]) <= 1e-8 * explained[c] for r in found if r.component == c + 1)
    assert all(r.identity_error < 1e-8 for r in found)


def spread(n, d, seed):
    rng = np.random.default_rng(seed)
    return rng.standard_normal((n, d)) * np.linspace(3, 0.5, d)


def test_components_of_distinct_vectors(spark, tmp_path):
    v = spread(300, 24, 1)
    rows = [(k, [float(c) for c in x]) for k, x in enumerate(v)]
    rows += [(1000 + k, rows[5][1]) for k in range(150)]           # a third are copies of one vector
    check(registry.QUERIES["op11_whitening"](spark, table(spark, tmp_path, rows)).collect(), rows)


def test_few_dimensions_and_vectors_without_variance(spark, tmp_path):
    rng = np.random.default_rng(2)
    flat = rng.standard_normal((60, 3)) @ rng.standard_normal((3, 3))
    rows = [(k, [*map(float, x), 1.0, 0.25]) for k, x in enumerate(flat)]     # two constant dimensions
    check(registry.QUERIES["op11_whitening"](spark, table(spark, tmp_path, rows)).collect(), rows)


def test_unusable_vectors_and_lengths_apart(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    good = [(k, [float(c) for c in x]) for k, x in enumerate(spread(40, 6, 3))]
    other = [(100 + k, [float(c) for c in x]) for k, x in enumerate(spread(30, 4, 4))]
    bad = [(200, None), (201, []), (202, [nan] * 6), (203, [1.0, 2.0, 3.0, 4.0, 5.0, inf]), (204, [None, 1.0, 1.0, 1.0, 1.0, 1.0]),
           (205, [1.0]), (205, [1.0])]                                # the only vector of its length has no variance
    found = registry.QUERIES["op11_whitening"](spark, table(spark, tmp_path, good + other + bad)).collect()
    assert len(found) == 40 * 6 + 30 * 4
    check([r for r in found if r.vec_id < 100], good)
    check([r for r in found if r.vec_id >= 100], other)


def test_equal_eigenvalues_are_all_found(spark):
    """A covariance that is a multiple of the identity: every Krylov space is one vector long."""
    d = 8
    rows = [(2 * k + s, [float((1 if s else -1) * (c == k)) for c in range(d)]) for k in range(d) for s in (0, 1)]
    vectors = whitening.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    found = whitening.whitened(vectors, vectors.select("x").distinct(), d).collect()
    assert len(found) == len(rows) * d
    assert all(abs(r.explained - 1 / d) < 1e-12 and r.identity_error < 1e-12 for r in found)


def test_fewer_steps_where_variance_falls_fast(spark):
    rng = np.random.default_rng(5)
    v = rng.standard_normal((200, 40)) * 200 * 0.5 ** np.arange(40)
    rows = [(k, [float(c) for c in x]) for k, x in enumerate(v)]
    vectors = whitening.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    fit = whitening.Rows(vectors.select("x").distinct(), 40)
    components, values, total = whitening.principal(fit, 4)
    assert fit.passes < 30
    n, _, _, explained = plain(rows, 4)
    assert np.allclose(values ** 2 / total, explained, rtol=1e-9)
    assert np.abs(components.T @ components - np.eye(4)).max() < 1e-12


def test_large_entries(spark):
    rows = [(k, [float(c) * 1e12, 1.0]) for k, c in enumerate((1, -2, 3, 5))] + [(9, [3e38, 1.0])]
    vectors = whitening.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    found = whitening.whitened(vectors, vectors.select("x").distinct(), 2).collect()
    assert len(found) == 5 and all(r.deviation is None or r.deviation >= 0 for r in found) and found[0].n == 5
