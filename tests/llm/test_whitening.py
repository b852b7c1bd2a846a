import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, deviation string"


def brute(rows):
    """By vec_id: deviation and the whitened coordinates, from numpy's own eigenvectors."""
    sound = [(i, [float(np.float32(c)) for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max((len(v) for _, v in sound), default=0)
    x = np.array([np.floor(256 * np.array([*v, *[0.0] * (width - len(v))])) for _, v in sound]).reshape(len(sound), width)
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(axis=0)
    values, axes = np.linalg.eigh((u - s / n).T @ (u - s / n) / n)
    values, axes = values[::-1][:4], axes[:, ::-1][:, :4]
    real = values > 1e-9
    dev = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x]
    return [i for i, _ in sound], n, dev, (x - s / n) @ axes[:, real] / np.sqrt(values[real]), values[real], np.linalg.eigvalsh((u - s / n).T @ (u - s / n) / n).sum()


def check(spark, tmp_path, rows, name="t"):
    spark.createDataFrame([(i, v, 1, "own") for i, v in rows], SCHEMA).repartition(5).write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
    got = whitening.op11_embedding_whitening(spark, f"{tmp_path}/{name}")
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    ids, n, dev, white, values, trace = brute(rows)
    made = got.collect()
    assert len(made) == len(ids) * values.size
    where = {}
    for at, i in enumerate(ids):
        where.setdefault(i, []).append(at)
    for k in range(values.size):
        mine = {}
        for r in made:
            if r.component == k + 1:
                mine.setdefault(r.vec_id, []).append((r.whitened, r.deviation, r.n, r.explained, r.identity_error))
        a = np.array([sorted(mine[i])[0][0] for i in where])
        b = np.array([sorted(white[at, k] for at in where[i])[0] for i in where])
        c = np.array([sorted(-white[at, k] for at in where[i])[0] for i in where])
        assert min(np.abs(a - b).max(), np.abs(a - c).max()) < 1e-7
        for i, rs in mine.items():
            assert sorted(r[1] for r in rs) == sorted(dev[at] for at in where[i])
            assert all(r[2] == n and abs(r[3] - values[k] / trace) < 1e-9 and r[4] < 1e-9 for r in rs)


def test_whitened_rows_equal_numpy(spark, tmp_path):
    rng = np.random.default_rng(5)
    base = (rng.standard_normal((300, 20)) * 0.9 ** np.arange(20) * 0.3 + 0.1).tolist()
    rows = [(i, v) for i, v in enumerate(base)] + [(1000 + i, base[i % 7]) for i in range(120)]
    rows += [(3, base[3]), (None, base[5]), (2000, None), (2001, [None] * 20), (2002, [float("nan")] * 20), (2003, [0.1, float("inf")]), (2004, base[0][:11]), (2005, [])]
    check(spark, tmp_path, rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.2])], [(1, [0.5, 0.2]), (2, [0.5, 0.2])], [(1, [])], [(1, [0.5, 0.25]), (2, [0.0, 0.25])], [(1, [0.5]), (2, [0.0, 0.25]), (3, [0.1, 0.2, 0.9])]])
def test_degenerate_tables(spark, tmp_path, rows):
    check(spark, tmp_path, rows)


def test_given_tables(spark):
    got = whitening.op11_embedding_whitening(spark, "/root/testdata/sf0.001")
    few = got.groupBy("component").agg(F.count(F.lit(1)).alias("rows"), F.max("identity_error").alias("error")).collect()
    assert sorted(r.component for r in few) == [1, 2, 3, 4]
    assert all(r.error < 1e-10 for r in few)


@pytest.mark.parametrize("size, spread", [(64, 1.0), (64, 0.9), (200, 0.95), (200, 1.0), (3, 1.0), (1, 1.0)])
def test_jacobi_davidson_reaches_double_precision(size, spread):
    x = np.random.default_rng(size).standard_normal((2000, size)) * spread ** np.arange(size)
    v = x.T @ x / len(x)
    values, axes = whitening.jacobi_davidson(lambda q: v @ q, size, 4)
    want = np.linalg.eigvalsh(v)[::-1][: min(4, size)]
    assert np.abs(values - want).max() < 1e-12 * want[0]
    assert np.linalg.norm(v @ axes - axes * values, axis=0).max() < 1e-12 * want[0]
    assert np.abs(axes.T @ axes - np.eye(values.size)).max() < 1e-12


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.standard_normal((30, 30)))
    a = q @ np.diag(np.concatenate([np.linspace(-3, -1, 10), np.linspace(1, 4, 20)])) @ q.T
    b = rng.standard_normal((30, 3))
    z = whitening.minres(lambda v: a @ v, b, 60, 1e-12)
    assert np.abs(a @ z - b).max() < 1e-8


def test_deviations_beyond_a_bigint_are_null():
    x = np.array([[2**30, 0], [1, 1]])
    assert whitening.deviations(x, 10, [5, 5]).to_pylist() == [None if (10 * 2**30 - 5) ** 2 + 25 >= 2**63 else (10 * 2**30 - 5) ** 2 + 25, 50]
