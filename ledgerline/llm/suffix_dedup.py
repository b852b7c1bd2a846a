"""Removal of repeated byte strings with a hash-compared suffix sort.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier: in a
document with a smaller doc_id, or earlier in the same one.

Sorting every suffix of a corpus would move many times its size, so suffixes that are
alone are set aside first. Of the 61 runs of 40 bytes in a string of 100, the one with
the lowest hash is its anchor; it depends on these 100 bytes only, so equal strings have
equal anchors. Neighbouring strings mostly share an anchor: there is one for 31 bytes.
Anchors meet by 48 bits of their hash; chance matches only cost time.

1. Tasks list their anchors, in packed blobs for each shard of the hash.
2. Shards find the anchors that occur twice. Copies within a blob are counted there, so a
   frequent anchor arrives once for each blob, not for each copy.
3. Tasks cut out the text around such anchors: the suffixes that start in a stretch of
   at most 61 bytes, followed by the 99 bytes that the last of them needs. Equal cuttings
   of a task are reduced to the first; later ones are repeats. An anchor with over
   ``HOT`` copies is cut into single strings, dealt by their own hash, as contexts of
   one anchor can be many while each string is dealt to a shard of its own.
4. Shards sort the suffixes of their cuttings up to ``LENGTH`` bytes: a mergesort whose
   comparisons find the common extension by binary search over prefix polynomial hashes,
   all comparisons of a level at once. Neighbours that agree for ``LENGTH`` bytes are
   compared byte by byte; on a hash collision the suffixes are sorted by their bytes.
5. The first of equal suffixes stays; starts of the others go back to their documents.

Texts are put beside lists of places twice (steps 3 and 5); nothing is collected but a
list of frequent anchors, at most ``MOST_HOT`` numbers. Texts are cut into segments for
the work in a task, so a long one needs no more memory than its bytes.

Defined results: a null text is empty; texts under ``LENGTH`` bytes keep all bytes. Rows
that share their doc_id and text get equal results; different texts that share a doc_id
are documents of their own, ordered by a hash of the text. A null doc_id comes after all
others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import CHUNK_BYTES, give_back, mix, output, pack_columns, ranges, read, schema_of, stored, text_chunks, unpack_columns

#: Bytes of a string that must not repeat, and of an anchor.
LENGTH, ANCHOR = 100, 40
WINDOW = LENGTH - ANCHOR + 1
#: Bytes of a long text that are worked on at once.
SEGMENT = 400_000
#: Anchors, and bytes of cuttings, that a task holds before it sends them on.
HELD_ANCHORS, HELD_BYTES = 1_000_000, 8_000_000
#: Anchors of a shard, as planned.
SHARD = 500_000
#: Copies from which on an anchor's cuttings are dealt one by one; how many such anchors
#: there are at most (beyond that, only the more frequent ones count as such).
HOT, MOST_HOT = 4_096, 1_000_000
#: Bytes of cuttings that are sorted at once.
SORTED_BYTES = 2_000_000

LAST = 2**63 - 1
_BASE = 0x9E3779B97F4A7C15
_CODES = np.random.default_rng(77).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_UP = _DOWN = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2**64."""
    global _UP, _DOWN
    if _UP.size < n:
        _UP, _DOWN = (np.full(n, b, np.uint64) for b in (_BASE, pow(_BASE, -1, 2**64)))
        _UP[0] = _DOWN[0] = 1
        _UP, _DOWN = np.multiply.accumulate(_UP), np.multiply.accumulate(_DOWN)
    return _UP, _DOWN


class Prefixes:
    """Polynomial hashes of all prefixes of some bytes, and so of all parts of them."""

    def __init__(self, raw: np.ndarray):
        up, self.down = _powers(raw.size + 1)
        self.sums = np.zeros(raw.size + 1, np.uint64)
        np.cumsum(_CODES[raw] * up[: raw.size], out=self.sums[1:])

    def part(self, start: np.ndarray, size) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * self.down[start]

    def every(self, size: int) -> np.ndarray:
        """The hash of each part of ``size`` bytes."""
        n = self.sums.size - size
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n]) if n > 0 else np.zeros(0, np.uint64)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many bytes each two suffixes have in common, up to ``LENGTH``."""
        found = np.full(a.size, LENGTH)
        rest = np.flatnonzero(self.part(a, LENGTH) != self.part(b, LENGTH))
        a, b, least = a[rest], b[rest], np.zeros(rest.size, np.int64)
        step = 1 << (LENGTH.bit_length() - 1)
        while step and rest.size:
            longer = np.minimum(least + step, LENGTH - 1)
            least = np.where(self.part(a, longer) == self.part(b, longer), longer, least)
            step >>= 1
        found[rest] = least
        return found


def _segments(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, offsets of texts in them, which text each is and its place in the text.
    Long texts come in segments that overlap by the bytes that the last starts need."""
    sizes = np.diff(offsets)
    short = np.flatnonzero((sizes >= LENGTH) & (sizes <= SEGMENT + LENGTH))
    if short.size:
        cuts = np.concatenate(([0], np.cumsum(sizes[short])))
        part = raw if short.size == sizes.size else raw[ranges(offsets[short], sizes[short])]
        yield part, cuts, short, np.zeros(short.size, np.int64)
    for t in np.flatnonzero(sizes > SEGMENT + LENGTH).tolist():
        for a in range(0, int(sizes[t]) - LENGTH + 1, SEGMENT):
            part = raw[offsets[t] + a : offsets[t] + min(a + SEGMENT + LENGTH - 1, sizes[t])]
            yield part, np.array([0, part.size]), np.array([t]), np.array([a])


def anchors(raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each stretch of starts with the same anchor: its text, first start, number of
    starts, place of the anchor and its hash (as five arrays, the first four by bytes)."""
    hashes = Prefixes(raw).every(ANCHOR)
    low = (hashes >> np.uint64(32) << np.uint64(32)) | np.arange(hashes.size, dtype=np.uint64)
    reach = 1
    while 2 * reach <= WINDOW:
        low = np.minimum(low[:-reach], low[reach:]) if low.size > reach else low[:0]
        reach *= 2
    rest = WINDOW - reach
    if rest:
        low = np.minimum(low[:-rest], low[rest:]) if low.size > rest else low[:0]
    place = (low & np.uint64(2**32 - 1)).astype(np.int64)
    starts = np.maximum(np.diff(cuts) - LENGTH + 1, 0)
    start = ranges(cuts[:-1], starts)
    text = np.repeat(np.arange(starts.size), starts)
    at = place[start]
    new = np.ones(start.size, bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, start.size))
    return text[first], start[first], count, at[first], hashes[at[first]] >> np.uint64(16)


def _by_document(shards: int, ord_: np.ndarray, tie: np.ndarray, *values: np.ndarray) -> pa.RecordBatch | None:
    """(shard, kind 0, blob): documents with their values, packed, by a hash of the document."""
    if not ord_.size:
        return None
    shard = (mix(ord_.astype(np.uint64) ^ mix(tie.astype(np.uint64))) % np.uint64(shards)).astype(np.int64)
    by = np.lexsort((values[0], tie, ord_, shard))
    cut, size = _runs_of(shard[by])
    blobs = [pack_columns(*(v[by[a : a + n]] for v in (ord_, tie, *values))) for a, n in zip(cut.tolist(), size.tolist(), strict=True)]
    return _rows(shard[by][cut].tolist(), [0] * cut.size, [None] * cut.size, blobs)


def _rows(shard: list, kind: list, hash_, blobs: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(kind, pa.int32()), pa.array(hash_, pa.int64()), pa.array(blobs, pa.binary())], ["shard", "kind", "hash", "blob"])


_SCHEMA = "shard int, kind int, hash bigint, blob binary"


def _runs_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and how long they are."""
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if values.size else np.zeros(0, np.int64)
    return first, np.diff(np.append(first, values.size))


def _listed(docs: DataFrame, shards: int) -> DataFrame:
    """Step 1: blobs of anchors by shard, and places of those that a blob has twice."""

    def flush(held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        h, ord_, tie, at = (np.concatenate(c) for c in zip(*held, strict=True))
        by = np.argsort(h, kind="stable")
        h, ord_, tie, at = h[by], ord_[by], tie[by], at[by]
        first, count = _runs_of(h)
        twice = np.repeat(count > 1, count)
        known = _by_document(shards, ord_[twice], tie[twice], at[twice])
        if known is not None:
            yield known
        h, ord_, tie, at = h[first], ord_[first], tie[first], at[first]
        shard = (h % np.uint64(shards)).astype(np.int64)
        by = np.argsort(shard, kind="stable")
        cut, size = _runs_of(shard[by])
        blobs = []
        for a, n in zip(cut.tolist(), size.tolist(), strict=True):
            one = by[a : a + n]
            own = h[one].view(np.int64)
            blobs.append(pack_columns(np.diff(own, prepend=0), ord_[one], tie[one], at[one], count[one]))
        yield _rows(shard[by][cut].tolist(), [1] * cut.size, [None] * cut.size, blobs)
        give_back()

    def list_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ord_, tie = (batch.column(c).to_numpy() for c in ("ord", "tie"))
            for begin, _, raw, offsets in text_chunks(batch, CHUNK_BYTES):
                for part, cuts, text, shift in _segments(raw, offsets):
                    of, _, _, at, h = anchors(part, cuts)
                    doc = begin + text[of]
                    held.append([h, ord_[doc], tie[doc], at - cuts[of] + shift[of]])
                    size += h.size
                    if size > HELD_ANCHORS:
                        yield from flush(held)
                        held, size = [], 0
        if size:
            yield from flush(held)

    return docs.select("ord", "tie", "text").mapInArrow(list_, _SCHEMA)


def _shards_of(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
    """The blobs of each shard; rows are in order of shards."""
    now, blobs = None, []
    for batch in batches:
        for shard, blob in zip(batch.column("shard").to_pylist(), batch.column("blob").to_pylist(), strict=True):
            if shard != now and blobs:
                yield blobs
                blobs = []
            now = shard
            blobs.append(blob)
    if blobs:
        yield blobs


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch | None, list[bytes]]]:
    """Rows of documents as they come, and the blobs of each shard of the others."""
    passed: list[pa.RecordBatch] = []

    def others() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of_documents = pa.array(batch.column("kind").to_numpy() == 0)
            passed.append(batch.filter(of_documents))
            yield batch.filter(pa.array(batch.column("kind").to_numpy() == 1))

    for blobs in _shards_of(others()):
        while passed:
            yield passed.pop(), []
        yield None, blobs
    while passed:
        yield passed.pop(), []


def _dealt(rows: DataFrame, shards: int) -> DataFrame:
    """Rows with their shard's others in one task, in order of shards."""
    return rows.repartition(shards, "shard").sortWithinPartitions("shard")


def _repeated(listed: DataFrame, shards: int, hot: int) -> DataFrame:
    """Step 2: places of anchors that occur twice by document, and the hashes of those
    with more than ``hot`` copies (kind 2)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for passed, blobs in _by_shard(batches):
            if passed is not None:
                yield passed
                continue
            parts = [unpack_columns(b, 5) for b in blobs]
            for p in parts:
                p[0] = np.cumsum(p[0])
            h, ord_, tie, at, count = (np.concatenate(c) for c in zip(*parts, strict=True))
            by = np.argsort(h, kind="stable")
            h, ord_, tie, at, count = h[by], ord_[by], tie[by], at[by], count[by]
            first, size = _runs_of(h)
            fresh = np.repeat(size > 1, size) & (count == 1)
            found = _by_document(shards, ord_[fresh], tie[fresh], at[fresh])
            if found is not None:
                yield found
            total = np.add.reduceat(count, first)
            many = h[first[total > hot]]
            if many.size:
                yield _rows([None] * many.size, [2] * many.size, many.view(np.int64), [b""] * many.size)
            give_back()

    return _dealt(listed, shards).mapInArrow(find, _SCHEMA)


def _with_places(docs: DataFrame, rows: DataFrame, columns: int, shards: int, how: str) -> DataFrame:
    """``docs`` beside ``blob``, the values of their rows; the texts are not sorted for it."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blobs in _shards_of(batches):
            ord_, tie, *values = (np.concatenate(c) for c in zip(*(unpack_columns(b, 2 + columns) for b in blobs), strict=True))
            by = np.lexsort((values[0], tie, ord_))
            ord_, tie, values = ord_[by], tie[by], np.stack([v[by] for v in values]).astype("<i4")
            first = np.flatnonzero(np.concatenate(([True], (ord_[1:] != ord_[:-1]) | (tie[1:] != tie[:-1]))))
            stop = np.append(first[1:], ord_.size)
            own = [values[:, a:b].tobytes() for a, b in zip(first.tolist(), stop.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(ord_[first]), pa.array(tie[first]), pa.array(own, pa.binary())], ["ord", "tie", "blob"])

    places = _dealt(rows.filter("kind = 0"), shards).mapInArrow(merge, "ord bigint, tie bigint, blob binary")
    return docs.join(places.hint("shuffle_hash"), ["ord", "tie"], how)


def _cut(docs: DataFrame, shards: int, hot: np.ndarray) -> DataFrame:
    """Step 3: cuttings by shard, and stretches of repeats that a task finds by itself."""

    def flush(held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        raw = np.concatenate([x[0] for x in held])
        size, key, back, ord_, tie, start = (np.concatenate([x[k] for x in held]) for k in range(1, 7))
        begin = np.cumsum(size) - size
        if np.isin(key, hot).any():
            size, key, back, ord_, tie, start, begin = _singles(raw, np.isin(key, hot), size, key, back, ord_, tie, start, begin)
        # Equal cuttings: by hash, then by their bytes.
        whole = Prefixes(raw).part(begin, size)
        by = np.lexsort((start, tie, ord_, back, size, whole, key))
        same = np.zeros(by.size, bool)
        a, b = by[:-1], by[1:]
        near = np.flatnonzero((key[a] == key[b]) & (whole[a] == whole[b]) & (size[a] == size[b]) & (back[a] == back[b]))
        same[1 + near[_equal_bytes(raw, begin[a[near]], begin[b[near]], size[a[near]])]] = True
        # The same stretch of equal rows is no repeat of itself.
        head = np.maximum.accumulate(np.where(same, 0, np.arange(by.size)))
        lead = by[head]
        itself = (ord_[by] == ord_[lead]) & (tie[by] == tie[lead]) & (start[by] == start[lead])
        later = by[same & ~itself]
        made = _by_document(shards, ord_[later], tie[later], start[later], size[later] - LENGTH + 1)
        if made is not None:
            yield made
        kept = by[~same]
        shard = (key[kept] % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        cut, n = _runs_of(shard[order])
        blobs = []
        for x, m in zip(cut.tolist(), n.tolist(), strict=True):
            one = kept[order[x : x + m]]
            head = pack_columns(size[one], key[one].view(np.int64), back[one], ord_[one], tie[one], start[one])
            text = raw[ranges(begin[one], size[one])].tobytes()
            blobs.append(len(head).to_bytes(4, "little") + head + len(text).to_bytes(4, "little") + pa.compress(text, "zstd", asbytes=True))
        yield _rows(shard[order][cut].tolist(), [1] * cut.size, [None] * cut.size, blobs)
        give_back()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ord_, tie = (batch.column(c).to_numpy() for c in ("ord", "tie"))
            blobs = batch.column("blob").to_pylist()
            for begin, last, raw, offsets in text_chunks(batch, CHUNK_BYTES):
                places = [np.unique(np.frombuffer(b, "<i4").astype(np.int64)) for b in blobs[begin:last]]
                listed = np.concatenate([offsets[k] + p for k, p in enumerate(places)])  # places in the chunk, ascending
                for part, cuts, text, shift in _segments(raw, offsets):
                    of, start, count, at, h = anchors(part, cuts)
                    home = offsets[text[of]] + shift[of] - cuts[of]
                    where = np.searchsorted(listed, at + home)
                    wanted = np.flatnonzero(listed[np.minimum(where, listed.size - 1)] == at + home) if listed.size else np.zeros(0, np.int64)
                    if not wanted.size:
                        continue
                    doc = begin + text[of[wanted]]
                    width = count[wanted] + LENGTH - 1
                    held.append([part[ranges(start[wanted], width)], width, h[wanted], at[wanted] - start[wanted], ord_[doc], tie[doc], start[wanted] - cuts[of[wanted]] + shift[of[wanted]]])
                    size += held[-1][0].size
                    if size > HELD_BYTES:
                        yield from flush(held)
                        held, size = [], 0
        if size:
            yield from flush(held)

    return docs.select("ord", "tie", "text", "blob").mapInArrow(cut, _SCHEMA)


def _singles(raw, chosen, size, key, back, ord_, tie, start, begin):
    """Chosen cuttings cut into single strings, dealt by their own hash."""
    one, rest = np.flatnonzero(chosen), np.flatnonzero(~chosen)
    each = size[one] - LENGTH + 1
    of = np.repeat(one, each)
    shift = ranges(np.zeros(one.size, np.int64), each)
    own = mix(Prefixes(raw).part(begin[of] + shift, LENGTH)) | np.uint64(1 << 63)  # no anchor's 48 bits
    made = [np.full(of.size, LENGTH), own, np.zeros(of.size, np.int64), ord_[of], tie[of], start[of] + shift, begin[of] + shift]
    return [np.concatenate([old[rest], new]) for old, new in zip((size, key, back, ord_, tie, start, begin), made, strict=True)]


def _equal_bytes(raw: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray, step: int = 20_000) -> np.ndarray:
    """Whether the ``size`` bytes from ``a`` and ``b`` on are equal."""
    out = np.ones(a.size, bool)
    for x in range(0, a.size, step):
        n = size[x : x + step]
        same = raw[ranges(a[x : x + step], n)] == raw[ranges(b[x : x + step], n)]
        out[x : x + step] = np.add.reduceat(same, np.cumsum(n) - n) == n
    return out


def suffix_sort(raw: np.ndarray, starts: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first ``LENGTH`` bytes within each cell (``cell``
    ascending), and which of them agree in these with the one before.

    A mergesort: in each level, a suffix finds its rank in the neighbouring sorted run by
    binary search, all suffixes at once.
    """
    prefixes = Prefixes(raw)
    order = np.arange(starts.size)
    first, size = _runs_of(cell)
    base, most = np.repeat(first, size), np.repeat(size, size)
    width = 1
    while (live := np.flatnonzero(most > width)).size:
        place = live - base[live]
        run = place // width
        other = base[live] + (run ^ 1) * width
        low = np.minimum(other, base[live] + most[live])
        high = np.minimum(other + width, base[live] + most[live])
        begin, mine = low.copy(), starts[order[live]]
        todo = np.flatnonzero(low < high)
        while todo.size:
            mid = (low[todo] + high[todo]) // 2
            a, b = starts[order[mid]], mine[todo]
            same = prefixes.common(a, b)
            full = same == LENGTH
            same = np.minimum(same, LENGTH - 1)
            # Those of the left run come first among equal ones.
            before = np.where(full, run[todo] % 2 == 1, raw[a + same] < raw[b + same])
            low[todo] = np.where(before, mid + 1, low[todo])
            high[todo] = np.where(before, high[todo], mid)
            todo = todo[low[todo] < high[todo]]
        to = base[live] + (run // 2) * 2 * width + place % width + (low - begin)
        merged = order.copy()
        merged[to] = order[live]
        order = merged
        width *= 2
    alike = np.zeros(order.size, bool)
    near = 1 + np.flatnonzero(cell[1:] == cell[:-1])
    claimed = near[prefixes.common(starts[order[near - 1]], starts[order[near]]) == LENGTH]
    sure = _equal_bytes(raw, starts[order[claimed - 1]], starts[order[claimed]], np.full(claimed.size, LENGTH))
    alike[claimed[sure]] = True
    if not sure.all():
        _sort_by_bytes(raw, starts, cell, order, alike, np.unique(cell[claimed[~sure]]))
    return order, alike


def _sort_by_bytes(raw, starts, cell, order, alike, collided) -> None:
    """Sorts the cells in which hashes collided by their bytes, in place."""
    for c in collided:
        a, b = np.searchsorted(cell, c, "left"), np.searchsorted(cell, c, "right")
        own = order[a:b]
        text = raw[ranges(starts[own], np.full(own.size, LENGTH))].reshape(-1, LENGTH)
        by = np.lexsort(text.T[::-1])
        order[a:b] = own[by]
        alike[a] = False
        alike[a + 1 : b] = (text[by][1:] == text[by][:-1]).all(axis=1)


def _later_starts(raw, size, key, back, ord_, tie, start) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document (ord, tie) and place of every start in some cuttings whose string also
    starts earlier in these."""
    begin = np.cumsum(size) - size
    each = size - LENGTH + 1
    of = np.repeat(np.arange(size.size), each)
    shift = ranges(np.zeros(size.size, np.int64), each)
    # Equal strings have their anchor at the same place: a cell for each anchor and place.
    by = np.lexsort((shift - back[of], key[of]))
    of, shift = of[by], shift[by]
    new = np.ones(of.size, bool)
    new[1:] = (key[of[1:]] != key[of[:-1]]) | ((shift - back[of])[1:] != (shift - back[of])[:-1])
    cell = np.cumsum(new) - 1
    some = np.bincount(cell)[cell] > 1
    of, shift, cell = of[some], shift[some], cell[some]
    if not of.size:
        return (np.zeros(0, np.int64),) * 3
    order, alike = suffix_sort(raw, begin[of] + shift, cell)
    of, shift = of[order], shift[order]
    group = np.cumsum(~alike)
    place = start[of] + shift
    by = np.lexsort((place, tie[of], ord_[of], group))
    of, place, group = of[by], place[by], group[by]
    first = np.repeat(*_runs_of(group))
    later = (ord_[of] != ord_[of[first]]) | (tie[of] != tie[of[first]]) | (place != place[first])
    return ord_[of[later]], tie[of[later]], place[later]


def _sorted(cuttings: DataFrame, shards: int) -> DataFrame:
    """Steps 4 and 5: stretches of repeats (start, number of starts) by document."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for passed, blobs in _by_shard(batches):
            if passed is not None:
                yield passed
                continue
            heads, texts = [], []
            for blob in blobs:
                n = int.from_bytes(blob[:4], "little")
                heads.append(unpack_columns(blob[4 : 4 + n], 6))
                m = int.from_bytes(blob[4 + n : 8 + n], "little")
                texts.append(np.frombuffer(pa.decompress(blob[8 + n :], m, "zstd"), np.uint8))
            raw = np.concatenate(texts)
            size, key, back, ord_, tie, start = (np.concatenate(c) for c in zip(*heads, strict=True))
            begin = np.cumsum(size) - size
            by = np.argsort(key, kind="stable")
            first, n = _runs_of(key[by])
            several = by[np.repeat(n > 1, n)]
            # As many whole anchors at a time as fit.
            first, _ = _runs_of(key[several])
            ends = np.append(np.cumsum(size[several]), 0)[np.append(first[1:], several.size) - 1] if several.size else np.zeros(0, np.int64)
            found, at = [], 0
            while at < first.size:
                done = ends[at - 1] if at else 0
                stop = max(at + 1, int(np.searchsorted(ends, done + SORTED_BYTES, "right")))
                one = several[first[at] : first[stop] if stop < first.size else several.size]
                found.append(_later_starts(raw[ranges(begin[one], size[one])], size[one], key[one], back[one], ord_[one], tie[one], start[one]))
                at = stop
            if found:
                ord_, tie, place = (np.concatenate(c) for c in zip(*found, strict=True))
                by = np.lexsort((place, tie, ord_))
                ord_, tie, place = ord_[by], tie[by], place[by]
                run = np.ones(place.size, bool)
                run[1:] = (place[1:] > place[:-1] + 1) | (ord_[1:] != ord_[:-1]) | (tie[1:] != tie[:-1])
                head = np.flatnonzero(run)
                stop = np.append(head[1:], place.size) - 1
                made = _by_document(shards, ord_[head], tie[head], place[head], place[stop] - place[head] + 1) if head.size else None
                if made is not None:
                    yield made
            give_back()

    return _dealt(cuttings, shards).mapInArrow(sort, _SCHEMA)


def _spans(blob: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """The maximal removed runs of a text, from its stretches of repeats."""
    if not blob:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start, count = np.frombuffer(blob, "<i4").reshape(2, -1).astype(np.int64)
    by = np.argsort(start, kind="stable")
    start, end = start[by], np.maximum.accumulate((start + count + LENGTH - 1)[by])
    head = np.flatnonzero(np.concatenate(([True], start[1:] > end[:-1])))
    return start[head], end[np.append(head[1:], start.size) - 1]


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ord and tie, which say which document is earlier. The tie is 0 if no
    two different texts share a doc_id."""
    keyed = docs.withColumn("ord", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)))
    shared = keyed.groupBy("ord").agg(F.min(F.xxhash64("text")).alias("a"), F.max(F.xxhash64("text")).alias("b")).filter("a <> b").limit(1).count()
    return keyed.withColumn("tie", F.xxhash64("text") if shared else F.lit(0).cast("bigint"))


def find_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...), without nulls in text, with ord, tie and blob: the
    stretches of starts of repeated strings, null without any. See ``removed``."""
    keyed = _keyed(docs.withColumn("text", F.coalesce("text", F.lit(""))))
    n_bytes = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    total = n_bytes * 2 // WINDOW
    shards = int(max(1, -(-total // SHARD)))
    long_ = keyed.select("ord", "tie", "text").filter(F.octet_length("text") >= LENGTH)
    places = stored(_repeated(_listed(long_, shards), shards, max(HOT, total // MOST_HOT)))
    hot = np.sort(places.filter("kind = 2").select("hash").toArrow().column("hash").to_numpy().view(np.uint64))
    cuttings = _cut(_with_places(long_, places, 1, shards, "inner"), shards, hot)
    return _with_places(keyed, _sorted(cuttings, shards), 2, shards, "left")


def removed(found: DataFrame, keep: list[str], text: bool = False) -> DataFrame:
    """``keep`` columns of ``find_repeats``' rows, n_bytes, n_removed, n_spans,
    kept_sha256 and, if asked for, the kept bytes."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column("blob").to_pylist()
            for first, last, raw, offsets in text_chunks(batch, CHUNK_BYTES):
                whole = raw.tobytes()
                made = []
                for a, b, own in zip(offsets[:-1].tolist(), offsets[1:].tolist(), blobs[first:last], strict=True):
                    start, end = _spans(own)
                    edges = zip([a, *(a + end).tolist()], [*(a + start).tolist(), b], strict=True)
                    kept = b"".join([whole[x:y] for x, y in edges])
                    made.append((b - a, b - a - len(kept), start.size, hashlib.sha256(kept).hexdigest(), kept if text else None))
                columns = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True)]
                yield output(batch, keep, first, last, columns, ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    made = found.select(*keep, "text", "blob").mapInArrow(remove, schema_of(found, keep) + "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
    return made if text else made.drop("kept")


#: For tables whose doc_id is unique and not null.
OP12_SQL = """
WITH docs AS MATERIALIZED (
  SELECT doc_id, hex(coalesce(text, '')) AS h, CAST(length(hex(coalesce(text, ''))) // 2 AS BIGINT) AS n, row_number() OVER () AS r FROM documents),
starts AS (SELECT r, doc_id, p, substr(h, 2 * p + 1, 200) AS s FROM (SELECT r, doc_id, h, unnest(range(n - 99)) AS p FROM docs)),
later AS (SELECT r, p FROM starts QUALIFY rank() OVER (PARTITION BY s ORDER BY doc_id, p) > 1),
marks AS (SELECT r, p, CASE WHEN p <= lag(p) OVER (PARTITION BY r ORDER BY p) + 100 THEN 0 ELSE 1 END AS fresh FROM later),
runs AS (SELECT r, p, sum(fresh) OVER (PARTITION BY r ORDER BY p) AS g FROM marks),
spans AS (SELECT r, g, min(p) AS a, max(p) + 100 AS b FROM runs GROUP BY r, g),
cuts AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM spans),
kept AS (
  SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS stop, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
  FROM cuts JOIN docs USING (r) GROUP BY r)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(stop, 0) + 1))) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What goes of every document, and a digest of what stays."""
    return removed(find_repeats(read(spark, sf_dir, "documents", "doc_id", "text")), ["doc_id"])
