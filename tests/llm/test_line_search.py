import random
from collections import defaultdict

import numpy as np
import pyarrow.dataset as ds

from ledgerline.llm import common, line_dedup


def test_candidates_of_unmatched_lines_do_not_move(spark, tmp_path, monkeypatch):
    """Long lines that are alike, but most of them not enough, each have all others as candidates."""
    rng = random.Random(4)
    base, pool = [f"b{i}" for i in range(160)], [f"p{i}" for i in range(30)]
    alike = [rng.sample(base, 135) + rng.sample(pool, 25) for _ in range(300)]
    alike += [[*line[:-5], *(f"x{k}{i}" for i in range(5))] for k, line in enumerate(alike[:40])]
    rows = [(d, " ".join(rng.sample(line, len(line)))) for d, line in enumerate(alike)] + [(1000 + d, " ".join(pool)) for d in range(250)]
    sets = [((d, 0), {*text.split()}) for d, text in rows]
    want = defaultdict(set)
    for k, (key, a) in enumerate(sets):
        for other, b in sets[:k]:
            if len(a & b) >= 0.8 * len(a | b) - 1e-9:
                want[key].add(other)
    assert 249 + 40 <= len(want) < 249 + 60
    paths = []
    monkeypatch.setattr(common, "scratch_path", lambda _, what: paths.append(f"{tmp_path}/{what}-{len(paths)}") or paths[-1])
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {(r.doc_id, r.line_no): (r.match_doc_id, r.match_line_no) for r in line_dedup.find(docs, first_ones=1, listed=1).collect()}
    assert got.keys() == want.keys()
    assert all(match in want[key] for key, match in got.items())
    # A candidate for each word of a prefix (33 of 160) at most.
    assert paths and max(ds.dataset(p).count_rows() for p in paths) <= 34 * len(alike)


def test_hashes_of_words_are_as_defined():
    """Short and very long words against the sum over their bytes."""
    rng = np.random.default_rng(5)
    for words in ([b"a"], [b"x" * n for n in (1, 23, 24, 25, 26, 3_000)], [bytes(rng.integers(33, 250, n, dtype=np.uint8)) for n in rng.integers(1, 60, 200)]):
        raw = np.frombuffer(b" ".join(words), np.uint8)
        number, powers = common._BYTES[common.LOWER], common._powers(3_000)
        want = [(number[np.frombuffer(w, np.uint8)] * powers[: len(w)]).sum(dtype=np.uint64) + np.uint64(len(w)) for w in words]
        assert common.Words(raw, np.array([0, raw.size])).hashes(common.LOWER).tolist() == common.mix(np.array(want)).tolist()
