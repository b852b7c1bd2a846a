import random

import numpy as np

from ledgerline.llm import line_dedup
from ledgerline.llm.common import BREAKS, LOWER, Words

T = 0.8


def test_long_lines_do_not_pass_by_chance(spark):
    """Lines of 120 words, a rare one in common, and no two alike: hardly a pair is listed."""
    rng = random.Random(6)
    rows = [(d, " ".join([f"rare{d % 3}", *rng.sample([f"w{i}" for i in range(4_000)], 119)])) for d in range(240)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    _, rarity, _ = line_dedup.survey(docs, 1)
    rarity[:] = 1_000
    for d in range(3):
        word = Words(np.frombuffer(b"rare%d" % d, np.uint8), np.array([0, 5]), BREAKS).hashes(LOWER)
        rarity[word % np.uint64(line_dedup.COUNTERS)] = 0
    pairs = line_dedup.candidates(line_dedup.prefixes(docs, rarity, 16, T, 1), T, listed=1_000).collect()
    assert len(pairs) <= 20  # of 9,480 with that word in common


def test_filters_lose_no_match():
    """Every pair of alike sets meets at a word, at whatever places of the prefixes and lengths."""
    rng = random.Random(7)
    sets = []
    for _ in range(40):
        base = rng.sample(range(400), rng.randint(4, 90))
        for _ in range(6):
            cut = rng.sample(base, rng.randint(int(0.85 * len(base)), len(base)))
            sets.append(sorted({*cut, *rng.sample(range(400), rng.randint(0, max(1, len(base) // 12)))}))
    hashes = np.random.default_rng(7).integers(0, 2**64, 400, dtype=np.uint64)
    word, n = hashes[np.concatenate(sets)], np.array([len(s) for s in sets])
    begin, line = np.cumsum(n) - n, np.repeat(np.arange(n.size), n)
    rarity = np.random.default_rng(8).integers(0, 30, line_dedup.COUNTERS).astype(np.uint16)
    half, at, pos = line_dedup._prefix(word, line, begin, n, np.ones(n.size, bool), rarity, T)
    rows = np.zeros(at.size, line_dedup.ENTRY)
    rows["word"], rows["set"], rows["doc"], rows["n"], rows["pos"] = half, at, at, n[at], pos
    bitmap = line_dedup._bitmap(word, begin, line_dedup.NARROW)
    for k in range(line_dedup.NARROW):
        rows[f"bitmap{k}"] = bitmap[at, k]
    got = {(r["doc"], r["other_doc"]) for x in line_dedup.pairs_of(rows, T, None, 10**6) for r in x.to_pylist()}
    alike = {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if len({*a} & {*b}) >= T * len({*a, *b}) - 1e-9}
    assert len(alike) > 200 and alike <= got


def test_lines_with_a_wanted_word():
    """Only such lines are kept, with their words and numbers as among all lines."""
    texts = ["", "a b\n\nc a a", "\n", "x\nb\n", "no\nline a", "b"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    text, number, begin, end = line_dedup._line_ends(raw, offsets)
    assert [(t, k, bytes(raw[a:b]).decode()) for t, k, a, b in zip(text, number, begin, end)] == [(t, k, x) for t, whole in enumerate(texts) for k, x in enumerate(whole.split("\n"))]
    every = line_dedup.Lines(raw, offsets, 1)
    word = every.word[every.line == 4][0]  # of the text "b"'s equal
    some = line_dedup.Lines(raw, offsets, 1, lambda hashes: np.flatnonzero(hashes == word))
    keep = [k for k in range(every.n.size) if word in every.word[every.line == k]]
    assert 0 < len(keep) < every.n.size
    assert some.text.tolist() == every.text[keep].tolist() and some.number.tolist() == every.number[keep].tolist()
    assert [some.word[some.line == k].tolist() for k in range(len(keep))] == [every.word[every.line == k].tolist() for k in keep]
    assert some.n.tolist() == every.n[keep].tolist() and some.begin.tolist() == (np.cumsum(some.n) - some.n).tolist()
    none = line_dedup.Lines(raw, offsets, 1, lambda hashes: np.zeros(0, np.int64))
    assert none.n.size == none.word.size == none.sets().size == 0


def test_words_of_listed_lines_only(spark):
    rows = [(1, "a b c\n\nd e"), (2, "x\ny z"), (3, None), (4, "p q"), (4, "p q"), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").filter("text is not null").repartition(2)
    pairs = spark.createDataFrame([(2, 1, 1, 2), (4, 0, 1, 0)], "doc bigint, line int, other_doc bigint, other_line int")
    listed = {(r.doc, r.line): (r.n, len({*r.words})) for r in line_dedup.words_of(docs, pairs, 1).collect()}
    assert listed == {(2, 1): (2, 2), (1, 2): (2, 2), (4, 0): (2, 2), (1, 0): (3, 3)}
    assert line_dedup.words_of(docs, pairs, 1).count() == 4
