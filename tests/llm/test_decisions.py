import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import decontamination, quality_rules, toxicity
from ledgerline.llm.common import first_by_hash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(grams)
    covered = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 5)}
    seen, dup, full = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            full += 1
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), len(re.findall("[A-Z]", text)), len(re.findall("[0-9]", text)), full, len(set(words))]


def odd_texts():
    rng = random.Random(4)
    made = ["\n".join(" ".join(rng.choices(["a", "bé", "C#", "1", " x"], k=rng.randint(0, 12))) for _ in range(rng.randint(1, 8))) for _ in range(60)]
    return [None, "", "\n", "\n\n a \n a \n", "a\na", "a \na", "a\r\na\r\n", "w " * 30_000, "x" * 100_000, "日本 語\n日本 語", *made]


def test_counts_equal_brute_force(spark):
    texts = odd_texts()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r[0]: list(r)[1:] for r in quality_rules.with_counts(df, ["doc_id"]).collect()}
    assert got == {i: brute_counts(t) for i, t in enumerate(texts)}


def test_rules_are_learned_and_become_expressions(spark):
    rng = np.random.default_rng(0)
    n = 3000
    x = {f: rng.random(n) for f in quality_rules.RATIOS}
    bad = (x["symbols_per_word"] > 0.8) | ((x["dup_lines"] > 0.6) & (x["words"] <= 0.4))
    rules = quality_rules.learn(x, bad)
    covered = np.logical_or.reduce([quality_rules._covers(r, x) for r in rules])
    assert (covered & bad).sum() / bad.sum() > 0.85 and (covered & bad).sum() / covered.sum() > 0.9
    kept, which = quality_rules.verdict([[quality_rules.Condition("words", False, 3.0)], [quality_rules.Condition("symbols_per_word", True, 0.5), quality_rules.Condition("words", True, 5.0)]])
    row = spark.createDataFrame([(2, 0), (6, 6), (6, 0)], "n_words bigint, n_symbols bigint")
    assert [tuple(r) for r in row.select(kept, which).collect()] == [(False, 1), (False, 2), (True, 0)]
    assert quality_rules.learn({f: v[:0] for f, v in x.items()}, bad[:0]) == [] and quality_rules.learn(x, bad & False) == []


def test_rules_on_odd_rows(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(odd_texts())] + [(None, "a b"), (3, "a b")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(0, 1), (1, 0), (None, 0), (3, None), (5, 1), (5, 0)], "doc_id bigint, quality int")
    kept, _ = quality_rules.verdict(quality_rules.fit(docs, labels))
    assert quality_rules.with_counts(docs, ["doc_id"]).select("doc_id", kept).count() == docs.count()
    assert quality_rules.fit(docs.limit(0), labels) == [] == quality_rules.fit(docs, labels.limit(0))


def test_sample_is_bounded_and_repeatable(spark):
    ids = spark.range(1000).withColumnRenamed("id", "doc_id")
    one, two = (sorted(r[0] for r in first_by_hash(ids.repartition(k), "doc_id", 50).collect()) for k in (3, 7))
    assert one == two and len(one) == 50


def brute_tiling(text, item, width):
    """Greedy string tiling by its definition."""
    marked_t, marked_i, tiles = set(), set(), []
    while True:
        best = None
        for a in range(len(text)):
            for b in range(len(item)):
                n = 0
                while a + n < len(text) and b + n < len(item) and text[a + n] == item[b + n] and a + n not in marked_t and b + n not in marked_i:
                    n += 1
                if n >= width and (best is None or n > best[2]):
                    best = (a, b, n)
        if best is None:
            return tiles
        tiles.append(best)
        marked_t |= {best[0] + k for k in range(best[2])}
        marked_i |= {best[1] + k for k in range(best[2])}


def test_tiling_equals_brute_force(spark):
    rng = random.Random(8)
    for _ in range(300):
        text, item = ([rng.choice("abc") for _ in range(rng.randint(0, 25))] for _ in range(2))
        width = rng.randint(1, 4)
        seeds = [(a, b) for a in range(len(text) - width + 1) for b in range(len(item) - width + 1) if text[a : a + width] == item[b : b + width]]
        p, q = (np.array([s[k] for s in seeds], np.int64) for k in (0, 1))
        want = brute_tiling(text, item, width)
        assert decontamination.tile(p, q, width) == want
        numbers = {}
        rows = [np.array([numbers.setdefault(tuple(s[a : a + width]), len(numbers)) for a in range(len(s) - width + 1)], np.int64) for s in (item, text)]
        assert decontamination.lay(*decontamination.diagonals(rows[1], rows[0]), width) == want


def test_long_repeats_are_tiled_in_little_memory(spark):
    """A text of 80 KB and an item of 20 KB of one repeated word."""
    import tracemalloc

    def run():
        raw = b"w " * 10_000
        items = decontamination.Items(np.array([4]), np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), 5)
        key = np.zeros(39_996, np.int64)
        shared = list(items.sharing(np.zeros(key.size, np.int64), key))
        assert [(t, i, k.tolist()) for t, i, k in shared] == [(0, 0, [0])]
        return decontamination.lay(*decontamination.diagonals(key, items.key), 5)

    tracemalloc.start()
    tiles = run()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert tiles == [(0, 0, 10_000)] and peak < 100e6


def test_contaminated_texts_are_found(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(400)]
    passages = [" ".join(rng.choices(vocabulary, k=rng.randint(12, 60))) for _ in range(30)]
    filler = lambda: " ".join(rng.choices(vocabulary, k=50))
    half = passages[1].split()
    swapped = " ".join(half[len(half) // 2 :] + half[: len(half) // 2])
    texts = [filler(), filler() + " " + passages[0] + " " + filler(), swapped.upper(), f"{filler()}, ({passages[2]}!)", None, "", passages[3] + "\n" + passages[4], " ".join(passages[5].split()[:4]), passages[0], filler() + " " + "w1 " * 50_000]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, hits string")
    items = [(i, p) for i, p in enumerate(passages)] + [(100, None), (101, ""), (102, "w1 w2"), (None, "w1 w2 w3 w4 w5"), (103, passages[0])]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    want = set()
    for d, t in enumerate(texts[:-1]):
        for i, p in items:
            if i is not None and p:
                cover = sum(n for _, _, n in brute_tiling(words(t), words(p), 5)) / len(words(p))
                want |= {(d, i)} if cover >= 0.6 else set()
    for block_bytes in (10**6, 2000):
        found = decontamination.contaminated(docs, benchmark, ["doc_id"], block_bytes=block_bytes)
        assert {(r[0], r[1]) for r in found.select("doc_id", F.explode("hits.item_id")).collect()} == want
        left = decontamination.remove(docs, benchmark, block_bytes=block_bytes)
        assert left.columns == docs.columns
        assert {r[0] for r in left.select("doc_id").collect()} == {*range(len(texts))} - {d for d, _ in want}
    assert {(1, 0), (2, 1), (3, 2), (6, 3), (6, 4), (8, 0), (8, 103)} <= want
    assert decontamination.remove(docs, benchmark.limit(0)).count() == len(texts)
    assert decontamination.remove(docs.limit(0), benchmark).count() == 0


def brute_kernel(s, t):
    """Sum over common subsequences of three letters, by enumeration."""
    from itertools import combinations

    def features(w):
        out = Counter()
        for at in combinations(range(len(w)), toxicity.ORDER):
            out[tuple(w[i] for i in at)] += toxicity.DECAY ** (at[-1] - at[0] + 1)
        return out

    a, b = features(s), features(t)
    return sum(v * b[k] for k, v in a.items())


def coded(*words):
    return np.array([[ord(c) - 96 for c in w] + [0] * (toxicity.PIECE - len(w)) for w in words], np.uint8)


def test_kernel_equals_enumeration():
    words = ["idiot", "idxiot", "banana", "ab", "aaaaaaa", "xidyiozt", ""]
    got = toxicity.kernel(coded(*words), coded(*words))
    for i, s in enumerate(words):
        for j, t in enumerate(words):
            assert got[i, j] == pytest.approx(brute_kernel(s, t), rel=1e-4, abs=1e-6)


def test_pieces_fold_and_join_letters():
    raw = np.frombuffer("An I.D-i0T  i d i o t x! \n b 12".encode(), np.uint8)
    pieces = toxicity.Pieces(raw, np.array([0, raw.size]))
    read = ["".join(chr(96 + c) for c in pieces.letter[a : a + n]) for a, n in zip(pieces.start, pieces.size)]
    assert read == ["an", "idiot", "idiotxbi"]


def test_toxic_texts_are_told_apart(spark):
    rng = random.Random(11)
    syllable = ["ta", "re", "mon", "li", "sur", "en", "th", "ka", "ver"]
    word = lambda: "".join(rng.choices(syllable, k=rng.randint(1, 4)))
    insults = ["idiot", "scumbag", "worthless", "pathetic"]
    rows, labels = [], []
    for i in range(900):
        words = [word() for _ in range(60)]
        if toxic := i % 5 == 0:
            words[rng.randrange(60)] = rng.choice(insults)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    machine = toxicity.fit(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    clean = " ".join(word() for _ in range(200))
    probes = {"plain": "you idiot", "gapped": "you i d i o t there", "dots": "such a s.c.u.m.b.a.g", "inserted": "an idiyot", "case": "PATHETIC!", "digit": "w0rthless", "late": "ta re " * 40_000 + " idiot", "clean": clean, "near": "tariot wort", "empty": "", "null": None}
    df = spark.createDataFrame([(k, v) for k, v in probes.items()] + [("plain", "you idiot")], "doc_id string, text string")
    score = {r.doc_id: r.score for r in toxicity.with_margins(df, machine, ["doc_id"]).collect()}
    for k in ("plain", "gapped", "dots", "inserted", "case", "digit", "late"):
        assert score[k] >= 0.7, (k, score)
    for k in ("clean", "empty", "null"):
        assert score[k] < 0.5, (k, score)


def test_toxicity_without_examples(spark):
    df = spark.createDataFrame([(1, "a text"), (2, None), (None, "b")], "doc_id bigint, text string")
    for labels in ([], [(1, 0), (2, 1)], [(1, 1)], [(None, 1), (1, None)]):
        machine = toxicity.fit(df, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
        assert all(0 <= r.score < 0.5 for r in toxicity.with_margins(df, machine, ["doc_id"]).collect())
    assert toxicity.with_margins(df.limit(0), machine, ["doc_id"]).count() == 0


def table_machine(words, weights, bias=-0.4):
    """A machine of some landmarks, and the margin it must give by its definition."""
    rows = marked(*words)
    norm = [brute_kernel(w, w) ** 0.5 for w in map(framed, words)]
    code = toxicity.triples(rows)
    table = np.bincount(code.ravel(), (toxicity.FADED * (np.array(weights) / norm)[:, None]).ravel(), 1 << 18)
    table[0] = 0

    def margin(word):
        own = framed(word)
        return sum(w * brute_kernel(own, framed(m)) / n for w, m, n in zip(weights, words, norm)) / brute_kernel(own, own) ** 0.5 + bias

    return toxicity.Machine(table, bias), margin


def framed(word):
    return "^" + word + "$"


def marked(*words):
    raw = [w.encode() for w in words]
    pieces = toxicity.Pieces(np.frombuffer(b"".join(x + b" " for x in raw), np.uint8), np.array([0, sum(len(x) + 1 for x in raw)]))
    return pieces.matrix(np.arange(len(words)))


def test_margins_and_evidence_equal_their_definitions():
    rng = random.Random(3)
    machine, margin = table_machine(["idiot", "scum", "house", "worthless"], [1.2, 0.9, -0.8, 0.7])
    words = ["idiot", "idxiot", "sxcum", "houses", "to", "tooth", "worth", *("".join(rng.choices("idotscum", k=rng.randint(2, 14))) for _ in range(150))]
    want = np.array([margin(w) for w in words])
    assert machine.margins(marked(*words)) == pytest.approx(want, abs=1e-6)
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    for least in (-0.3, 0.0, 0.2):
        found, exact = machine.above(toxicity.Pieces(raw, np.array([0, raw.size])), least)
        assert found.tolist() == np.flatnonzero(want >= least).tolist()
        assert exact == pytest.approx(want[found], abs=1e-6)
    machine.steps = np.array([0.0, 0.4]), np.array([2_000, 7_000])
    worth = np.where(want >= 0.4, 7_000, np.where(want >= 0, 2_000, 0))
    texts = [words[a : a + n] for a, n in ((0, 3), (2, 60), (10, 0), (5, 140), (20, 90))] * 2
    raw = [" ".join(t).encode() for t in texts]
    got = machine.evidence(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert got.tolist() == [sum(worth[a : a + n]) for a, n in ((0, 3), (2, 60), (10, 0), (5, 140), (20, 90))] * 2
    long_ = np.array([worth[i % 157] for i in range(700)])
    raw = " ".join(words[i % 157] for i in range(700)).encode()
    want = max(long_[max(0, i - toxicity.SPAN + 1) : i + 1].sum() for i in range(700))
    assert machine.evidence(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])).tolist() == [want]


def test_scores_do_not_depend_on_partitions_or_files(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "toxic")
    seen = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts, files in ((1, 1), (4, 6), (60, 1)):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            docs.repartition(files, F.xxhash64("doc_id")).write.parquet(f"{tmp_path}/{parts}")
            one = spark.read.parquet(f"{tmp_path}/{parts}")
            seen.append(sorted(map(tuple, toxicity.with_margins(one, toxicity.fit(one, labels), ["doc_id"]).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] == seen[2]
    assert len({r[2] for r in seen[0]}) > 5


def test_held_out_toxic_texts_are_found_in_every_language(spark):
    from ledgerline.llm.toxicity import op3_toxicity

    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    langs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = op3_toxicity(spark, sf).filter("held_out").join(labels, "doc_id").join(langs, "doc_id").groupBy("lang", "toxic", "predicted").count().collect()
    got = Counter()
    for r in rows:
        for lang in (r.lang, "all"):
            got[lang, r.toxic, r.predicted] += r["count"]
    for lang in ("all", "en", "de", "fr", "es"):
        assert got[lang, 1, 1] >= 0.9 * (got[lang, 1, 0] + got[lang, 1, 1]), (lang, got)
        assert got[lang, 0, 1] <= 0.02 * (got[lang, 0, 0] + got[lang, 0, 1]), (lang, got)
    assert got["all", 1, 1] >= 0.9 * (got["all", 1, 1] + got["all", 0, 1])
    known = toxicity.fit(spark.read.parquet(f"{sf}/documents.parquet"), labels.filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1))
    insults = "idiot scum moron clown loser pathetic worthless disgusting stupid trash".split()
    changed = "idxiot i.d.i.o.t scxum sxcxum moxron clxown clxoxwn loxser patxhetic IDIOT tr4sh".split()
    harmless = "idiom house motion students crown lose".split()
    df = spark.createDataFrame([(w,) for w in insults + changed + harmless], "text string").withColumn("word", F.col("text"))
    score = {r.word: r.score for r in toxicity.with_margins(df, known, ["word"]).collect()}
    assert all(score[w] >= 0.7 for w in insults + changed), score
    assert all(score[w] < 0.5 for w in harmless), score
