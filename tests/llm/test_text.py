import random
import re
import struct

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import common
from ledgerline.llm.common import BREAKS, LOWER, HashArray, Words, mix, text_chunks, windows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = ["", " ", "a", "a b", "  é\tÜber\n\n b.c \r\x0b\x0c", "x" * 5000, "  nbsp em", "日本 語", None, "a\x00b"]


def chunked(texts, most=100):
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    return list(text_chunks(batch, most=most))


def test_chunks_cover_all_rows_once():
    seen = []
    for first, last, raw, offsets in chunked(TEXTS, 10):
        for k in range(first, last):
            seen.append(raw[offsets[k - first] : offsets[k - first + 1]].tobytes().decode())
    assert seen == [t or "" for t in TEXTS]
    assert chunked([]) == []


def test_chunks_of_a_slice():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["aa", "b", None, "cccc"])}).slice(1)
    ((first, last, raw, offsets),) = text_chunks(batch)
    assert (first, last, raw.tobytes(), offsets.tolist()) == (0, 3, b"bcccc", [0, 1, 1, 5])


@pytest.mark.parametrize("most", [1, 60, 10**6])
def test_words_equal_the_pattern(most):
    for first, last, raw, offsets in chunked(TEXTS, most):
        words = Words(raw, offsets)
        got = [raw[a:b].tobytes().decode() for a, b in zip(words.start, words.end)]
        want = [WORD.findall(t or "") for t in TEXTS[first:last]]
        assert got == [w for ws in want for w in ws]
        assert words.per_text.tolist() == [len(w) for w in want]
        normal, start, end = words.normal()
        assert [normal[a:b] for a, b in zip(start, end)] == [re.sub("[A-Z]", lambda m: m[0].lower(), w).encode() for w in got]


def test_equal_words_hash_alike_and_others_apart():
    rng = random.Random(3)
    pool = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    raw = np.frombuffer(" ".join(pool).encode(), np.uint8)
    hashes = Words(raw, np.array([0, raw.size])).hashes().tolist()
    by = {}
    for w, h in zip(pool, hashes):
        assert by.setdefault(w, h) == h
    assert len(set(by.values())) == len(by)
    upper = np.frombuffer(" ".join(pool).upper().replace("É", "é").encode(), np.uint8)
    assert Words(upper, np.array([0, upper.size])).hashes(LOWER).tolist() == hashes


def test_breaks_split_at_punctuation():
    raw = np.frombuffer(b"Don't stop-now, (ok) 3.5!", np.uint8)
    words = Words(raw, np.array([0, raw.size]), BREAKS)
    assert [raw[a:b].tobytes() for a, b in zip(words.start, words.end)] == [b"Don", b"t", b"stop", b"now", b"ok", b"3", b"5"]


def test_hash_array_finds_every_key():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**63, 5000, dtype=np.uint64))
    rng.shuffle(keys)
    table = HashArray(keys)
    assert (table.find(keys) == np.arange(keys.size)).all()
    assert (table.find(mix(keys + np.uint64(1))) == -1).all()
    assert HashArray(keys[:0]).find(keys[:3]).tolist() == [-1] * 3


def test_windows_depend_on_order():
    h = mix(np.arange(1, 7, dtype=np.uint64))
    w = windows(np.concatenate([h, h[::-1]]), 3)
    assert windows(h, 7).size == 0 and len(set(w.tolist())) == w.size
    assert windows(np.concatenate([h, h]), 3)[0] == windows(np.concatenate([h, h]), 3)[6]


def test_cluster_needs_a_shared_folder(spark):
    class Context:
        master = "spark://somewhere"

    class Session:
        conf = type("C", (), {"get": staticmethod(lambda key, default=None: None)})
        sparkContext = Context

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session)
    assert struct.calcsize("<Q") == 8
