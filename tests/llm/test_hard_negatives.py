import numpy as np
import pytest

from ledgerline.llm import hard_negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, length string, id string"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows):
    """All scores of all anchors; equal rows once."""
    part = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(c is not None and np.isfinite(c) for c in v):
            x = [int(np.floor(256 * float(np.float32(c)))) for c in v]
            while x and x[-1] == 0:
                x.pop()
            part[i, (label + 1) % 10 if i % 7 == 0 else label, tuple(x)] = None
    out = []
    for i, label, x in part:
        if i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y)), j, other) for j, other, y in part if j != i)
        for p, j, _ in [s for s in scored if s[2] == label][:5]:
            near = [(n, k) for n, k, other in scored if other != label and 80 * -p <= 100 * -n <= 100 * -p]
            out += [(i, j, rank + 1, k, -p, -n) for rank, (n, k) in enumerate(near[:5])]
    return sorted(out)


def check(spark, tmp_path, rows, name="t"):
    spark.createDataFrame([(*r, "own", "own", "own") for r in rows], SCHEMA).repartition(3).write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
    got = hard_negatives.op13_hard_negatives(spark, f"{tmp_path}/{name}")
    assert got.columns == COLUMNS
    got = sorted(map(tuple, got.collect()))
    assert got == brute(rows)
    return got


def vectors(rng, n, width, spread):
    centres = rng.standard_normal((10, width))
    label = rng.integers(0, 10, n)
    x = (centres[label] + 0.7 * rng.standard_normal((n, width))) * np.exp(spread * rng.standard_normal(n))[:, None] * 0.3
    return [(i, v, int(c)) for i, (v, c) in enumerate(zip(x.tolist(), label))]


def test_equal_to_all_scores(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(8)
    rows = vectors(rng, 700, 12, 0.6)
    # Copies of one vector under many ids, repeated rows, shared ids, odd values.
    rows += [(2000 + i, rows[100][1], i % 3) for i in range(200)] + rows[:40] + [(300, rows[7][1], 2), (5, rows[9][1], 3)]
    rows += [(None, rows[0][1], 1), (4000, None, 1), (4100, rows[1][1], None), (4200, [None] * 12, 1), (4300, [float("nan")] * 12, 2)]
    rows += [(4400, [], 1), (4500, [0.0] * 12, 4), (4600, rows[3][1][:5], 5), (4601, [], 5), (-100, rows[11][1], 1), (-7, rows[12][1], 9)]
    monkeypatch.setattr(hard_negatives, "BUCKET", 32)
    monkeypatch.setattr(hard_negatives, "FIRST", 3)
    assert len(check(spark, tmp_path, rows, "one")) > 100
    monkeypatch.setattr(hard_negatives, "BATCH_BYTES", 400)
    check(spark, tmp_path, rows, "many")


@pytest.mark.parametrize(
    "rows",
    [[], [(0, [0.5], 1)], [(0, [0.5], 1), (1, [0.5], 1)], [(0, [0.5], 0), (1, [0.5], 1), (2, [0.4, 1.0], 2), (100, [-0.5], 1)], [(0, [0.0], 0), (1, [0.0], 1), (3, [0.0], 2)], [(100, [], 1), (1, [], 1), (2, [], 2)]],
)
def test_small_tables(spark, tmp_path, rows):
    check(spark, tmp_path, rows)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_equal_to_sql(spark, duck, sf):
    got = hard_negatives.op13_hard_negatives(spark, f"/root/testdata/{sf}")
    columns, want = duck(hard_negatives.OP13_SQL, f"/root/testdata/{sf}")
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want)


def test_ranges_leave_no_row_out(monkeypatch):
    """The pruned search finds every row that reaches a threshold, at any threshold."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((500, 6))
    x = np.floor(256 * x / np.linalg.norm(x, axis=1)[:, None] * rng.uniform(0.98, 1.02, 500)[:, None]).astype(np.int64)
    x[:60] = x[0]
    bucket = hard_negatives.Bucket(0, 6, np.arange(500).tobytes(), hard_negatives.pack(x[::-1]))
    anchors = hard_negatives.Anchors(np.arange(40), np.arange(40), np.zeros(40, int), x[100:140])
    exact = anchors.x @ x[::-1].T
    pruned = 0
    for q in (0.3, 0.9, 0.99, 1.0):
        least = np.quantile(exact, q, axis=1).astype(np.int64)
        seen = {a: (set(p.tolist()), s) for a, p, s in bucket.search(anchors, np.arange(40), least)}
        for a in range(40):
            want = set(np.flatnonzero(exact[a] >= least[a]).tolist())
            places, scores = seen.get(a, (set(), None))
            assert want <= places
            pruned += len(places) < 500
            if places:
                assert (np.sort(scores) == np.sort(exact[a, sorted(places)])).all()
    assert pruned > 40
