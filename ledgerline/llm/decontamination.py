"""Benchmark decontamination by greedy string tiling.

Windows of ``min_match`` words of the texts that also occur in a benchmark item are
seeds; they are found by hash. For each pair of a text and an item that share seeds,
tiles are laid greedily: the longest match of words not yet covered in either is
marked, again and again, until none of ``min_match`` words is left. Matches come from
running Karp-Rabin hashes: n neighbouring equal windows on a diagonal are a match of
n + min_match - 1 words. Tiles may stand in any order, so reordered passages count. A
text is contaminated by an item if the tiles cover enough of the item's words.

Pairs of a text and an item are joined by distinct windows, so one that repeats many times
counts once. Only if the shared windows could cover enough of the item are its matches
laid out, one pair at a time, as runs on diagonals that follow the item window by window:
memory grows with the text and the runs, never with the pairs of equal windows.

Words are lower-cased and freed of white space and ASCII punctuation. The benchmark is
sent to the tasks in blocks of bounded size, one pass over the texts for each block;
the texts are not shuffled.

Defined results: null and empty texts have no hits. An item with fewer than
``min_match`` words can't be matched. Repeated rows get equal results; equal items are
all reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import BREAKS, LOWER, HashArray, Words, output, ranges, read, schema_of, text_chunks, windows, with_text

HIT = "array<struct<item_id:bigint,coverage:double,n_tiles:int,longest:int>>"
#: Bytes of benchmark text in a block.
BLOCK_BYTES = 16_000_000
#: Windows of texts, once for each item that has them, that are looked at together.
PAIRS = 500_000


class Items:
    """The windows of a block of benchmark items: ``key`` numbers equal ones, in order of
    item and place; ``first`` is where each item's begin."""

    def __init__(self, ids: np.ndarray, raw: np.ndarray, offsets: np.ndarray, min_match: int):
        words = Words(raw, offsets, BREAKS)
        of = np.repeat(np.arange(ids.size), words.per_text)
        hashes = windows(words.hashes(LOWER), min_match)
        at = np.flatnonzero(of[: hashes.size] == of[min_match - 1 :]) if hashes.size else np.zeros(0, np.int64)
        keys, self.key = np.unique(hashes[at], return_inverse=True)
        self.ids, self.size, self.min_match = ids, words.per_text, min_match
        self.found = HashArray(keys)
        self.first = np.searchsorted(of[at], np.arange(ids.size + 1))
        # Which items have a window, each once.
        code = np.unique(self.key.astype(np.int64) * max(1, ids.size) + of[at])
        self.holder = code % max(1, ids.size)
        self.begin = np.searchsorted(code // max(1, ids.size), np.arange(keys.size + 1))

    def sharing(self, text: np.ndarray, key: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """Texts, items that share windows with them, and the keys of these. ``text`` and
        ``key`` are those of the texts' windows that some item has, in order of text."""
        code = np.unique(text.astype(np.int64) * max(1, self.begin.size) + key)
        text, key = code // max(1, self.begin.size), code % max(1, self.begin.size)
        many = np.diff(self.begin)[key]
        total = np.cumsum(many)
        a = 0
        while a < text.size:
            # Some texts at a time, as a window may be in many items.
            b = int(np.searchsorted(total, (total[a - 1] if a else 0) + PAIRS, "right"))
            b = int(np.searchsorted(text, text[min(max(b, a + 1), text.size) - 1], "right"))
            at = np.repeat(np.arange(a, b), many[a:b])
            item = self.holder[ranges(self.begin[key[a:b]], many[a:b])]
            by = np.lexsort((item, text[at]))
            at, item = at[by], item[by]
            cuts = np.flatnonzero(np.concatenate(([True], (np.diff(text[at]) != 0) | (np.diff(item) != 0), [True]))) if at.size else at
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                yield int(text[at[x]]), int(item[x]), key[at[x:y]]
            a = b


def diagonals(text: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of equal windows: place in the text, place in the item and windows,
    from the numbers of the windows of a text (-1: in no item) and of an item."""
    since, before = np.zeros(text.size, np.int64), np.zeros(text.size, bool)
    runs = []
    for q in range(item.size + 1):
        now = text == item[q] if q < item.size else np.zeros(text.size, bool)
        goes_on = np.zeros(text.size, bool)
        goes_on[:-1] = before[:-1] & now[1:]
        over = np.flatnonzero(before & ~goes_on)
        if over.size:
            n = q - since[over]
            runs.append((over - n + 1, since[over], n))
        fresh = np.full(text.size, q)
        fresh[1:][goes_on[:-1]] = since[:-1][goes_on[:-1]]
        since, before = fresh, now
    return tuple(np.concatenate(c) for c in zip(*runs, strict=True)) if runs else (np.zeros(0, np.int64),) * 3


def lay(p: np.ndarray, q: np.ndarray, n: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """Tiles (place in the text, place in the item, words) from runs of ``n`` windows of
    ``width`` words: greedily the longest, of equal ones the first in the text, then in
    the item. What a tile covers is cut out of the other runs."""
    tiles = []
    while p.size:
        longest = np.flatnonzero(n == n.max())
        best = longest[np.lexsort((q[longest], p[longest]))[0]]
        a, b, size = int(p[best]), int(q[best]), int(n[best]) + width - 1
        tiles.append((a, b, size))
        # Windows of a run that end before the tile or begin behind it, in both.
        ends = np.minimum(n - 1, a - width - p), np.minimum(n - 1, b - width - q)
        begins = np.maximum(0, a + size - p), np.maximum(0, b + size - q)
        zero, last = np.zeros(n.size, np.int64), n - 1
        pieces = []
        for low_p, high_p in ((zero, ends[0]), (begins[0], last)):
            for low_q, high_q in ((zero, ends[1]), (begins[1], last)):
                low, high = np.maximum(low_p, low_q), np.minimum(high_p, high_q)
                left = low <= high
                pieces.append((p[left] + low[left], q[left] + low[left], (high - low + 1)[left]))
        p, q, n = (np.concatenate(c) for c in zip(*pieces, strict=True))
    return tiles


def tile(p: np.ndarray, q: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """The tiles of the seeds (p, q): places of equal windows in a text and an item."""
    order = np.lexsort((p, p - q))
    p, q = p[order], q[order]
    new = np.flatnonzero(np.concatenate(([True], (np.diff(p) != 1) | (np.diff(p - q) != 0)))) if p.size else p
    return lay(p[new], q[new], np.diff(np.append(new, p.size)), width)


def with_hits(docs: DataFrame, items: Items, keep: list[str], least: float) -> DataFrame:
    """``keep`` columns and ``hits``, the items that each row's text contains."""
    sent = docs.sparkSession.sparkContext.broadcast(items)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        width = items.min_match
        for batch in batches:
            for first, last, raw, offsets in text_chunks(batch):
                words = Words(raw, offsets, BREAKS)
                of = np.repeat(np.arange(last - first), words.per_text)
                key = items.found.find(windows(words.hashes(LOWER), width))
                key[of[: key.size] != of[width - 1 :][: key.size]] = -1  # across two texts
                hits: list[list[dict]] = [[] for _ in range(last - first)]
                at = np.flatnonzero(key >= 0)
                for text, item, shared in items.sharing(of[at], key[at]):
                    own = items.key[items.first[item] : items.first[item + 1]]
                    places = np.flatnonzero(np.isin(own, shared))
                    if np.minimum(np.diff(places), width).sum() + width < least * items.size[item]:
                        continue  # all its windows together don't cover enough
                    mine = key[words.first[text] : min(words.first[text + 1], key.size)]
                    tiles = lay(*diagonals(mine, own), width)
                    coverage = sum(t[2] for t in tiles) / int(items.size[item])
                    if coverage >= least:
                        hits[text].append({"item_id": int(items.ids[item]), "coverage": coverage, "n_tiles": len(tiles), "longest": max(t[2] for t in tiles)})
                yield output(batch, keep, first, last, [pa.array(hits, HIT_TYPE)], ["hits"])

    return with_text(docs, keep).mapInArrow(find, schema_of(docs, keep) + f"hits {HIT}")


HIT_TYPE = pa.list_(pa.struct([("item_id", pa.int64()), ("coverage", pa.float64()), ("n_tiles", pa.int32()), ("longest", pa.int32())]))


def blocks(benchmark: DataFrame, min_match: int, block_bytes: int = BLOCK_BYTES) -> Iterator[Items]:
    """The items (item_id, text) in blocks of about ``block_bytes``, split by the hash of their id."""
    some = benchmark.filter("text is not null and item_id is not null").select("item_id", "text")
    total = some.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = -(-total // block_bytes)
    for k in range(n):
        table = some.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").toArrow()
        for batch in table.combine_chunks().to_batches():
            ids = batch.column("item_id").to_numpy(zero_copy_only=False)
            for first, last, raw, offsets in text_chunks(batch, most=2 * block_bytes):
                yield Items(ids[first:last], raw, offsets, min_match)


def contaminated(docs: DataFrame, benchmark: DataFrame, keep: list[str], least: float = 0.6, min_match: int = 5, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``keep`` columns and ``hits`` of each row of ``docs``: the benchmark items whose
    words its text covers to ``least`` or more. A benchmark of several blocks gives a
    row for each row and block."""
    out = None
    for items in blocks(benchmark, min_match, block_bytes):
        found = with_hits(docs, items, keep, least)
        out = found if out is None else out.union(found)
    return docs.select(*keep, F.array().cast(HIT).alias("hits")) if out is None else out


def remove(docs: DataFrame, benchmark: DataFrame, least: float = 0.6, min_match: int = 5, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` whose text no item contaminates, with their columns."""
    row = docs.select(F.struct("*").alias("row"))
    for items in blocks(benchmark, min_match, block_bytes):
        row = with_hits(row, items, ["row"], least).filter(F.size("hits") == 0).select("row")
    return row.select("row.*")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each pair of a document and a benchmark item that it contains."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    found = contaminated(docs, read(spark, sf_dir, "benchmark", "item_id", "text"), ["doc_id"])
    return found.select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")
