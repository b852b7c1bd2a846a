import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerline.llm import line_dedup, simhash
from ledgerline.llm.components import components


def groups_of(edges, nodes=()):
    parent = {n: n for n in nodes}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in list(parent)}


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(1, 500)] + [(5, 5)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.component for r in components(df).collect()}
    want = groups_of([e for e in edges if e[0] != e[1]])
    assert got == want
    assert components(df.limit(0)).count() == 0


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def texts():
    rng = random.Random(7)
    pool = ["a", "Bé", "cc", "D-d", "日本", "x" * 40, "e"]
    return [None, "", " \n", "a", "A", "a b", "a  B\nc", "e " * 20_000, *(" ".join(rng.choices(pool, k=rng.randint(1, 30))) for _ in range(150))]


def test_fingerprints_equal_brute_force(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts())], "doc_id bigint, text string")
    got = {r.doc_id: r.fp % 2**64 for r in simhash.with_fingerprints(docs, ["doc_id"]).collect()}
    assert got == {i: brute_fingerprint(t) for i, t in enumerate(texts())}


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def test_links_connect_what_all_pairs_connect(spark):
    rng = random.Random(12)
    seeds = [rng.getrandbits(64) for _ in range(150)] + [0, 2**64 - 1, 2**63]
    prints = {*seeds}
    for s in seeds[:60] + seeds[-3:]:
        for _ in range(rng.randint(1, 6)):
            s ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
            prints.add(s)
    crowd = rng.getrandbits(64)  # many fingerprints in one cell
    prints |= {crowd ^ 1 << a ^ 1 << b for a in range(12) for b in range(64)}
    prints = sorted(prints)
    import numpy as np

    fp = np.array(prints, np.uint64)
    v = simhash.embedding_of(fp)
    df = spark.createDataFrame([(signed(a), signed(int(b))) for a, b in zip(prints, v)], "fp bigint, v bigint")
    found = [(r.a, r.b) for r in simhash.links(df).collect()]
    assert all(bin((a ^ b) % 2**64).count("1") <= 2 for a, b in found)
    pairs = [(signed(a), signed(b)) for i, a in enumerate(prints) for b in prints[:i] if bin(a ^ b).count("1") <= 2]
    nodes = [signed(p) for p in prints]
    assert groups_of(found, nodes) == groups_of(pairs, nodes)
    assert len(found) < 66 * len(prints) < len(pairs) * 66


def test_components_of_documents(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(500)]
    base = [" ".join(rng.choices(words, k=300)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(base + base[:5] + [b + " tail" for b in base[:8]])] + [(90, None), (91, ""), (92, " "), (None, base[3]), (None, "alone"), (3, base[3])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = simhash.near_duplicates(docs, ["doc_id", "text"]).collect()
    prints = [brute_fingerprint(r.text) for r in got]
    least = {}
    by = groups_of([(a, b) for a in set(prints) for b in set(prints) if a < b and bin(a ^ b).count("1") <= 2], set(prints))
    for r, p in zip(got, prints):
        if r.doc_id is not None:
            least[by[p]] = min(least.get(by[p], r.doc_id), r.doc_id)
    assert [r.component_id for r in got] == [least.get(by[p]) for p in prints] and len(got) == len(rows)
    docs = docs.selectExpr("*", "'x' as row", "1 as id", "2 as tie", "3 as component", "'de' as lang")
    left = simhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns and left.count() == len(set(by.values()))
    assert {r.doc_id for r in left.collect()} == {*least.values(), None}
    assert simhash.drop_near_duplicates(docs.limit(0)).count() == 0


# Lines


def line_sets(rows, least_words=5):
    for doc, text in rows:
        if doc is None or text is None:
            continue
        for k, line in enumerate(text.split("\n")):
            words = {w for w in re.split(r"[\x20\x09-\x0D]|[!-/:-@\[-`{-~]", re.sub("[A-Z]", lambda m: m[0].lower(), line)) if w}
            if len(words) >= least_words:
                yield (doc, k), words


def brute_lines(rows, t=0.8, least_words=5):
    sets = sorted(line_sets(rows, least_words), key=lambda x: x[0])
    out = defaultdict(set)
    for i, (key, words) in enumerate(sets):
        for other, others in sets[:i]:
            if other < key and len(words & others) >= t * len(words | others) - 1e-9:
                out[key].add(other)
    return out


def lines_fixture():
    rng = random.Random(21)
    vocabulary = [f"v{i}" for i in range(3000)] + ["the", "of"] * 300
    line = lambda n: rng.choices(vocabulary, k=n)
    rows, pool = [], [line(rng.randint(4, 40)) for _ in range(60)]
    family = line(30)  # one line with many variants
    for d in range(120):
        lines = []
        for _ in range(rng.randint(1, 6)):
            words = list(rng.choice(pool)) if rng.random() < 0.4 else line(rng.randint(1, 30))
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            lines.append(" ".join(words))
        variant = list(family)
        for _ in range(rng.randint(0, 5)):
            variant[rng.randrange(30)] = rng.choice(vocabulary)
        rows.append((d, "\n".join([*lines, " ".join(variant), "one, two; Three four five!", ""])))
    rows += [(500, None), (501, ""), (502, "\n\n"), (None, rows[0][1]), (503, "v1 v2 v3 v4 v5 " * 5000 + "\n" + "v1 v2 v3 v4 v5"), (504, rows[3][1]), (505, rows[3][1] + "\n" + rows[3][1])]
    return rows


@pytest.mark.parametrize("first_ones, listed, most", [(2, 32, 10**6), (1, 2, 60)])
def test_lines_equal_brute_force(spark, first_ones, listed, most):
    rows = lines_fixture()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {(r.doc_id, r.line_no): (r.match_doc_id, r.match_line_no) for r in line_dedup.find(docs, first_ones=first_ones, listed=listed, most=most).collect()}
    want = brute_lines(rows)
    assert got.keys() == want.keys()
    assert all(match in want[key] for key, match in got.items())


def test_lines_beyond_a_million_in_a_text_keep_their_order():
    """Sorting by line and word is the same with and without room for both in one number."""
    rng = np.random.default_rng(3)
    line = np.sort(rng.integers(0, 2**21, 3_000))
    value = rng.integers(0, 2**40, 3_000).astype(np.uint64)
    for bits in (40, 44):
        order = line_dedup._by_line(line, value, bits)
        assert (np.diff(line[order]) >= 0).all()
        assert ((np.diff(value[order].astype(np.int64)) >= 0) | (np.diff(line[order]) > 0)).all()
    text = b"a b c d e\n" * (2**20 + 5) + b"z y x w v\nv w x y z"
    lines = line_dedup.Lines(np.frombuffer(text, np.uint8), np.array([0, len(text)]), 5)
    assert lines.n.size == 2**20 + 7 and (lines.n == 5).all() and (lines.number == np.arange(lines.n.size)).all()
    sets = lines.sets()
    assert len({*sets[: 2**20 + 5].tolist()}) == 1 and sets[-1] == sets[-2] != sets[0]


def test_lines_are_taken_out(spark):
    rows = lines_fixture()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "length(text) as n_chars", "'x' as line", "1 as `__gone`", "2 as row")
    left = line_dedup.remove(docs)
    assert left.columns == docs.columns and left.count() == len(rows)
    want = brute_lines(rows)
    for r in left.collect():
        text = dict(rows)[r.doc_id]
        if text is not None:
            kept = [x for k, x in enumerate(text.split("\n")) if (r.doc_id, k) not in want]
            assert r.text == "\n".join(kept) and r.n_chars == len(r.text)
    assert line_dedup.remove(docs.limit(0)).count() == 0


def test_repeated_rows_keep_their_lines(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")]
    got = line_dedup.find(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert [(r.doc_id, r.line_no, r.match_doc_id) for r in got] == [(2, 0, 1)]


def test_op4_registers_whole_table(spark):
    rows = simhash.op4_simhash(spark, "/root/testdata/sf0.001")
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = {r.doc_id: r for r in rows.collect()}
    assert {d: int(r.fingerprint, 16) for d, r in got.items()} == {d: brute_fingerprint(t) for d, t in docs.items()}
    prints = sorted({brute_fingerprint(t) for t in docs.values()})
    by = groups_of([(a, b) for i, b in enumerate(prints) for a in prints[:i] if bin(a ^ b).count("1") <= 2], prints)
    least = {}
    for d in sorted(docs):
        least.setdefault(by[brute_fingerprint(docs[d])], d)
    assert {d: r.component_id for d, r in got.items()} == {d: least[by[brute_fingerprint(t)]] for d, t in docs.items()}
    assert rows.filter(F.length("fingerprint") != 16).count() == 0
