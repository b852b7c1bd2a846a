import random
from collections import defaultdict

import numpy as np
import pytest

from ledgerline.llm import common, line_dedup

T = 0.8


def brute(rows, least_words):
    sets = sorted(((d, k), frozenset(line.split())) for d, text in rows for k, line in enumerate(text.split("\n")) if len({*line.split()}) >= least_words)
    out = defaultdict(set)
    for i, (key, words) in enumerate(sets):
        for other, others in sets[:i]:
            if len(words & others) >= T * len(words | others) - 1e-9:
                out[key].add(other)
    return out


def test_order_of_rows_in_a_task_does_not_matter(spark, tmp_path):
    """Texts are longer than a chunk of ``common.CHUNK_BYTES`` / 4, and a task reads them from the last to the first."""
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(2000)]
    line = lambda n: rng.choices(vocabulary, k=n)
    pool = [line(rng.randint(8, 20)) for _ in range(30)]
    filler = "x" * (common.CHUNK_BYTES // 4)  # one word
    rows = []
    for d in range(40):
        lines = []
        for _ in range(4):
            words = list(rng.choice(pool))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            lines.append(" ".join(words))
        rows.append((d, "\n".join(lines)))
    # The set of 100 is read first, then that of 50; 70 matches it and is after 50 only.
    same = line(10)
    alike = same[:-1] + ["other"]
    rows += [(50, " ".join(same)), (70, " ".join(alike)), (100, " ".join(same))]
    want = brute(rows, 5)
    docs = spark.createDataFrame([(d, f"{t}\n{filler}") for d, t in rows], "doc_id bigint, text string").coalesce(1).sortWithinPartitions("doc_id", ascending=False)
    docs.write.parquet(str(tmp_path / "documents"))
    docs = spark.read.parquet(str(tmp_path / "documents"))
    got = {(r.doc_id, r.line_no): (r.match_doc_id, r.match_line_no) for r in line_dedup.find(docs).collect()}
    assert (70, 0) in want and got.keys() == want.keys()
    assert all(match in want[key] for key, match in got.items())


@pytest.mark.parametrize("most", [5, 10**6])
def test_earliest_lines_are_sent(monkeypatch, most):
    monkeypatch.setattr(line_dedup, "MOST_SEEN", most)
    rng = np.random.default_rng(3)
    seen, sent, first = np.zeros(0, line_dedup.SEEN), {}, {}
    for _ in range(60):
        sets, doc, number = rng.integers(0, 40, 12).astype(np.uint64), rng.integers(0, 99, 12), rng.integers(0, 5, 12).astype(np.int32)
        for key in zip(sets.tolist(), doc.tolist(), number.tolist()):
            first[key[0]] = min(first.get(key[0], key[1:]), key[1:])
        order = np.lexsort((number, doc, sets))
        heads, seen = line_dedup._earlier(sets, doc, number, order[np.concatenate(([True], np.diff(sets[order]) != 0))], seen)
        for k in heads.tolist():
            key = int(sets[k]), (int(doc[k]), int(number[k]))
            sent[key[0]] = min(sent.get(*key), key[1])
    assert sent == first
