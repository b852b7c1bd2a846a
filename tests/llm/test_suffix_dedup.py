import hashlib
import random

import numpy as np
import pytest

from ledgerline.llm import suffix_dedup
from ledgerline.llm.common import mix

SCHEMA = "doc_id bigint, text string, ord string, tie string, blobs string, kind int, shard string"
COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def brute(rows):
    """By the definition: every string of 100 bytes, in order of document and start."""
    keyed = [(2**63 - 1 if i is None else i, (t or "").encode()) for i, t in rows]
    # Different texts of one doc_id are documents of their own; which comes first is not said.
    first = {}
    for i, raw in keyed:
        for p in range(len(raw) - 99):
            place = (i, p)
            first[raw[p : p + 100]] = min(first.get(raw[p : p + 100], place), place)
    out = []
    for (own, _), (i, raw) in zip(rows, keyed, strict=True):
        gone = bytearray(len(raw))
        for p in range(len(raw) - 99):
            if first[raw[p : p + 100]] < (i, p):
                gone[p : p + 100] = b"\1" * 100
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((own, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(spark, tmp_path, rows, name="t", parts=3):
    spark.createDataFrame([(*r, "own", "own", "own", 7, "own") for r in rows], SCHEMA).repartition(parts).write.parquet(f"{tmp_path}/{name}/documents.parquet")
    got = suffix_dedup.op12_suffix_dedup(spark, f"{tmp_path}/{name}")
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def corpus(seed=3):
    rng = random.Random(seed)
    words = ["ab", "c", "déf", "日本", "longerword", "x.", "\n", "qu'il"]
    line = lambda n: " ".join(rng.choices(words, k=n))
    passages = [line(60) for _ in range(4)]
    rows = []
    for i in range(90):
        text = line(rng.randint(1, 120))
        for p in rng.sample(passages, rng.randint(0, 3)):
            a, b = sorted(rng.sample(range(len(p)), 2))
            at = rng.randint(0, len(text))
            text = text[:at] + rng.choice([p, p[a:b], p[:a]]) + text[at:]
        rows.append((i, text))
    rows += [(200 + i, rows[i % 4][1]) for i in range(40)]  # copies
    rows += [(300, rows[5][1][:-1]), (301, "z" * 500), (302, "ab" * 300), (303, "y" * 99), (304, "y" * 100), (305, "z" * 100)]
    rows += [(310, None), (311, ""), (None, rows[7][1]), (None, line(80)), (2, rows[2][1]), (-5, rows[3][1] + "!")]
    rng.shuffle(rows)
    return rows


def test_equal_to_definition(spark, tmp_path):
    check(spark, tmp_path, corpus())


def test_small_blocks_long_texts_and_frequent_anchors(spark, tmp_path, monkeypatch):
    rows = corpus(9)
    rng = random.Random(1)
    long_ = "".join(rng.choices("abcdefgh ", k=3_000))
    rows += [(400, long_ + rows[3][1] + long_[:1500]), (401, "q" + long_[500:2500] + "r"), (402, "k" * 2_000)]
    # One passage in many documents, with contexts of their own.
    passage = "".join(rng.choices("mnopq ", k=180))
    rows += [(500 + i, "".join(rng.choices("uvw", k=rng.randint(0, 90))) + passage + "".join(rng.choices("rst", k=rng.randint(0, 90)))) for i in range(120)]
    for name, value in {"SEGMENT": 700, "HELD_ANCHORS": 150, "HELD_BYTES": 9_000, "SHARD": 300, "HOT": 20, "SORTED_BYTES": 2_000, "CHUNK_BYTES": 5_000}.items():
        monkeypatch.setattr(suffix_dedup, name, value)
    check(spark, tmp_path, rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "a" * 99), (2, "a" * 99)], [(1, "b" * 100), (1, "b" * 100)], [(None, "c" * 150), (None, "c" * 150)], [(3, "d" * 250)]])
def test_small_tables(spark, tmp_path, rows):
    check(spark, tmp_path, rows)


def test_texts_that_share_a_doc_id(spark, tmp_path):
    """One of them is first, and it is the same one at every run."""
    a, b = "".join(random.Random(1).choices("abcd", k=150)), "".join(random.Random(2).choices("abcd", k=150))
    rows = [(1, a + "x"), (1, a + "y"), (2, b), (2, b)]
    seen = set()
    for name, parts in (("one", 1), ("many", 4)):
        spark.createDataFrame([(*r, "", "", "", 0, "") for r in rows], SCHEMA).repartition(parts).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        got = sorted(map(tuple, suffix_dedup.op12_suffix_dedup(spark, f"{tmp_path}/{name}").collect()))
        assert [r[2] for r in got if r[0] == 2] == [0, 0]
        assert sorted(r[2] for r in got if r[0] == 1) == [0, 150]
        seen.add(tuple(got))
    assert len(seen) == 1


def test_kept_bytes_of_the_given_tables(spark):
    found = suffix_dedup.find_repeats(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"))
    rows = suffix_dedup.removed(found, ["doc_id"], text=True).collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows), key=str) == brute(texts)
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in rows)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_equal_to_sql(spark, duck, sf):
    got = suffix_dedup.op12_suffix_dedup(spark, f"/root/testdata/{sf}")
    columns, want = duck(suffix_dedup.OP12_SQL, f"/root/testdata/{sf}")
    assert got.columns == columns and sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("collide", [False, True])
def test_suffix_sort_orders_by_bytes(monkeypatch, collide):
    """Also with hashes that collide: equal neighbours are only those with equal bytes."""
    rng = np.random.default_rng(6)
    raw = rng.integers(97, 99, 4_000).astype(np.uint8)
    raw[1000:1400] = raw[200:600]
    raw[3000:3300] = 97
    starts = np.sort(rng.choice(raw.size - 100, 1_500, replace=False))
    cell = np.sort(rng.integers(0, 12, starts.size))
    cell[:700] = 0
    cell = np.sort(cell)
    if collide:
        monkeypatch.setattr(suffix_dedup.Prefixes, "part", lambda self, start, size: np.zeros(np.shape(start), np.uint64) + np.asarray(size, np.uint64))
    order, alike = suffix_dedup.suffix_sort(raw, starts, cell)
    assert sorted(order) == list(range(starts.size))
    assert (cell[order] == cell).all()
    text = [raw[s : s + 100].tobytes() for s in starts[order]]
    for k in range(1, starts.size):
        if cell[k] == cell[k - 1]:
            assert text[k - 1] <= text[k]
            assert alike[k] == (text[k - 1] == text[k])
        else:
            assert not alike[k]


def test_equal_strings_have_equal_anchors():
    """Wherever a string of 100 bytes is, the anchor has the same place and hash in it."""
    rng = np.random.default_rng(2)
    raw = rng.integers(97, 101, 5_000).astype(np.uint8)
    raw[2000:2600] = raw[100:700]
    raw[4000:4200] = 98
    cuts = np.array([0, 1500, 1500, 3100, 5000])
    of, start, count, at, h = suffix_dedup.anchors(raw, cuts)
    width = suffix_dedup.ANCHOR
    assert (h == mix(suffix_dedup.Prefixes(raw).part(at, width)) >> np.uint64(16)).all()
    seen, n = {}, 0
    for t, s, c, a, x in zip(of, start, count, at, h, strict=True):
        for p in range(s, s + c):
            assert cuts[t] <= p and p + 100 <= cuts[t + 1] and p <= a and a + width <= p + 100
            key = raw[p : p + 100].tobytes()
            assert seen.setdefault(key, (a - p, x)) == (a - p, x)
            n += 1
    assert n == sum(max(0, b - a - 99) for a, b in zip(cuts, cuts[1:]))
