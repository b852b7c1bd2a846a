"""Near-duplicate lines, removed by an exact set-similarity join.

A line is its set of words, lower-cased and without punctuation; two lines match at a
Jaccard similarity of ``threshold`` or more. A line is removed if it matches an earlier
one, by doc_id and line number. Lines with fewer than ``least_words`` distinct words
stay; the query and the pipeline compare every line with a word (``LEAST_WORDS``).

1. How common words are is counted over all lines, in a table of hashed counters of
   fixed size. Counters shared by several words only affect the order of words, which
   is the same for all lines, not the result.
2. Lines with equal sets are grouped; later ones go. A task sends each set once.
3. Each set's rarest words, as many as a match needs to share one, are its prefix.
   Sets so small that only an equal one can match (up to three words at 0.8) have none.
   Sets that share a prefix word meet in a shard of words; length, the positions of
   the word and a 128-bit bitmap of the set bound their overlap and rule most pairs out.
4. What is left is verified with the words themselves.

A shard holds a bounded number of entries; a fuller one is split into blocks, and each
pair of blocks meets once. A later line is first checked against the one candidate most
like it, by bitmap; if that is no match, against the ``FIRST`` most alike for each shared
word, then against the ``LISTED`` most alike, if these are more. The words of all listed
lines are read from the texts once, with a wider bitmap that rules out most pairs before words move. A line that had more candidates than these and still
has no match is searched for: it is sent to the tasks with its words, and they read all
texts and check all its candidates where they are found, so that no candidates move. So a
family of near copies doesn't list all its pairs, and no match is lost.

Defined results: null and empty texts have no lines. A row without doc_id is left
alone. doc_id stands for a text: rows that repeat it have no order among each other.
All columns are passed on, n_chars with the new length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import BREAKS, LOWER, Words, give_back, materialise, mix, pack_columns, per_text, ranges, read, stored, text_chunks, unpack_columns
from ledgerline.llm.ngram import runs

#: Distinct words of a line that the query and the pipeline compare: any line but those without a word.
LEAST_WORDS = 1
#: Counters of words, and how many of them are packed into one value.
COUNTERS, PACKED = 2**20, 2**14
#: Entries of a shard of prefix words that a task holds at once, and the aim for a shard.
SHARD, AIM = 400_000, 100_000
#: Candidates of a line that are verified after the best, and that are listed, for each prefix word.
FIRST, LISTED = 3, 3
#: About how many words the lines have that are searched for in one pass; more take several passes.
PASS_WORDS = 4_000_000
#: Pairs that are looked at together in a search, and 64-bit numbers of the wide bitmap that rules most of them out.
BLOCK, WIDE = 250_000, 4
#: 64-bit numbers of an entry's bitmap. With one, lines of a hundred words pass by chance.
NARROW = 2
#: Up to so many ids are broadcast (8 bytes each); beyond that all texts are looked at.
BROADCAST_IDS = 1_000_000
#: Up to so many lines (doc, line) that are searched for are broadcast to fetch their words.
BROADCAST_LINES = 100_000
#: Bits of the filter that tells which lines are to be verified.
FILTER_BITS = 2**26
#: Half a hash of the word and of the set are enough to let lines meet; with its bitmap
#: and size, a set's half hash also tells equal sets.
ENTRY = np.dtype([("word", "<u4"), ("set", "<u4"), *((f"bitmap{k}", "<u8") for k in range(NARROW)), ("doc", "<i8"), ("line", "<i4"), ("n", "<u4"), ("pos", "<u4")])
#: A set that a task has sent, with the first line it had by then; how many it remembers.
SEEN = np.dtype([("set", "<u8"), ("doc", "<i8"), ("line", "<i4")])
MOST_SEEN = 1_000_000
KEYS = ["doc", "line", "other_doc", "other_line"]
PAIR = "doc bigint, line int, other_doc bigint, other_line int, apart int, place int, more boolean"


class Lines:
    """Distinct words of the lines of some texts: ``word`` with the ``line`` of each, in
    order of line and hash; ``text``, ``number``, ``n`` and ``begin`` of each line. With
    ``wanted``, which tells the places of wanted words among hashes, only lines that have one."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, least_words: int, wanted: Callable[[np.ndarray], np.ndarray] | None = None):
        words = Words(raw, offsets, BREAKS)
        text, number, begin, _ = _line_ends(raw, offsets)
        hashes = words.hashes(LOWER)
        size = np.diff(np.append(np.searchsorted(words.start, begin), len(words)))
        some = size > 0
        if wanted is not None:
            at = np.searchsorted(begin, words.start[wanted(hashes)], side="right") - 1
            some = np.zeros(begin.size, bool)
            some[at] = True
            hashes = hashes[np.repeat(some, size)]
        text, number, size = text[some], number[some], size[some]
        line = np.repeat(np.arange(size.size), size)
        order = _by_line(line, hashes >> np.uint64(24), 40)
        hashes = hashes[order]  # the order by line is as it was
        new = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (line[1:] != line[:-1]))) if line.size else np.zeros(0, bool)
        hashes, line = hashes[new], line[new]
        n = np.bincount(line, minlength=size.size)
        if least_words > 1:
            keep = n >= least_words
            hashes, line = hashes[keep[line]], (np.cumsum(keep) - 1)[line[keep[line]]]
            text, number, n = text[keep], number[keep], n[keep]
        self.word, self.line, self.text, self.number, self.n = hashes, line, text, number.astype(np.int32), n
        self.begin = np.cumsum(n) - n

    def sets(self) -> np.ndarray:
        """A hash of each line's set."""
        return mix(np.add.reduceat(mix(self.word + np.uint64(7)), self.begin)) if self.n.size else np.zeros(0, np.uint64)


def _line_ends(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, number, first byte and byte after the last of each line, in reading order: a
    text with k line feeds has k + 1."""
    breaks = np.flatnonzero(raw == 0x0A)
    count = np.diff(np.searchsorted(breaks, offsets)) + 1
    first = np.cumsum(count) - count
    text = np.repeat(np.arange(count.size), count)
    begin, end = np.empty(text.size, np.int64), np.empty(text.size, np.int64)
    inner = np.ones(text.size, bool)
    inner[first] = False
    begin[first], begin[inner] = offsets[:-1], breaks + 1
    inner[first], inner[first + count - 1] = True, False
    end[~inner], end[inner] = offsets[1:], breaks
    return text, np.arange(text.size) - first[text], begin, end


def _by_line(line: np.ndarray, value: np.ndarray, bits: int) -> np.ndarray:
    """The order by line, then by value of so many bits: one sort if both fit into a number."""
    if not line.size or int(line[-1]) < 2 ** (64 - bits):
        return np.argsort(line.astype(np.uint64) << np.uint64(bits) | value)
    return np.lexsort((value, line))


def _column(batch: pa.RecordBatch, name: str, first: int, last: int) -> np.ndarray:
    return batch.column(name).slice(first, last - first).to_numpy(zero_copy_only=False)


def survey(docs: DataFrame, least_words: int) -> tuple[DataFrame, np.ndarray, int]:
    """The first line of each set in each document (set, doc, line, copies), where
    ``copies`` are the numbers of the document's other lines of that set; how often
    words of each hash range are in lines; how many words all lines have."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for first, last, raw, offsets in text_chunks(batch):
                lines = Lines(raw, offsets, least_words)
                np.add.at(total, (lines.word % np.uint64(COUNTERS)).astype(np.int64), 1)
                doc, sets = _column(batch, "doc_id", first, last)[lines.text], lines.sets()
                order = np.lexsort((lines.number, sets, lines.text))
                new = np.concatenate(([True], (np.diff(sets[order]) != 0) | (np.diff(lines.text[order]) != 0))) if order.size else np.zeros(0, bool)
                head = order[new]
                cuts = np.flatnonzero(np.append(new, True))
                number, size = lines.number[order], np.diff(cuts)
                copies = np.full(head.size, None, object)
                for k in np.flatnonzero(size > 1):
                    copies[k] = number[cuts[k] + 1 : cuts[k + 1]].tolist()
                yield _surveyed(set=sets[head].view(np.int64), doc=doc[head], line=lines.number[head], copies=pa.array(copies, pa.list_(pa.int32())))
        if total.any():
            yield _surveyed(at=np.arange(COUNTERS // PACKED), c=[pack_columns(part) for part in total.reshape(-1, PACKED)])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, blob in zip(batch.column("at").to_pylist(), batch.column("c").to_pylist(), strict=True):
                sums[at] = sums.get(at, 0) + unpack_columns(blob, 1)[0]
        yield pa.RecordBatch.from_arrays([pa.array([*sums], pa.int64()), pa.array([pack_columns(x) for x in sums.values()], pa.binary())], ["at", "c"])

    table = stored(docs.select("doc_id", "text").mapInArrow(find, "set bigint, doc bigint, line int, copies array<int>, at bigint, c binary"))
    counts = table.filter("at is not null").select("at", "c").repartition("at").mapInArrow(add, "at bigint, c binary").toArrow()  # a row for each PACKED counters
    out = np.zeros((COUNTERS // PACKED, PACKED), np.int64)
    for at, blob in zip(counts.column("at").to_pylist(), counts.column("c").to_pylist(), strict=True):
        out[at] = unpack_columns(blob, 1)[0]
    out = out.ravel()
    # Twelve bits for each: rarity on a logarithmic scale.
    rarity = np.minimum(4095, np.log2(out + 1.0) * 64).astype(np.uint16)
    return table.filter("at is null").select("set", "doc", "line", "copies"), rarity, int(out.sum())


_SURVEY = pa.schema([("set", pa.int64()), ("doc", pa.int64()), ("line", pa.int32()), ("copies", pa.list_(pa.int32())), ("at", pa.int64()), ("c", pa.binary())])


def _surveyed(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    made = [columns.get(f.name, pa.nulls(n, f.type)) for f in _SURVEY]
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(made, _SURVEY, strict=True)], schema=_SURVEY)


def _needed(n: np.ndarray, t: float) -> np.ndarray:
    """Words that a set of n needs in common with another at least."""
    return np.ceil(t * n - 1e-9).astype(np.int64)


def _packed(rows: np.ndarray) -> bytes:
    """Entries byte by byte, as most of their bytes are zeros that compress well then."""
    return np.ascontiguousarray(rows).view(np.uint8).reshape(rows.size, ENTRY.itemsize).T.tobytes()


def _unpacked(blob: pa.BinaryScalar) -> np.ndarray:
    planes = np.frombuffer(blob.as_buffer(), np.uint8).reshape(ENTRY.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(ENTRY).ravel()


def _earlier(sets: np.ndarray, doc: np.ndarray, number: np.ndarray, heads: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of ``heads``, in order of set, whose sets are not in ``seen`` or only with a
    later line; ``seen`` with them."""
    new = np.zeros(heads.size, SEEN)
    new["set"], new["doc"], new["line"] = sets[heads], doc[heads], number[heads]
    if not seen.size:
        return heads, new
    at = np.minimum(np.searchsorted(seen["set"], new["set"]), seen.size - 1)
    met, old = seen["set"][at] == new["set"], seen[at]
    first = ~met | (new["doc"] < old["doc"]) | ((new["doc"] == old["doc"]) & (new["line"] < old["line"]))
    seen[at[met & first]] = new[met & first]
    fresh = new[~met]
    # Without those that are forgotten, entries are sent more often, which pairs_of evens out.
    seen = fresh if seen.size > MOST_SEEN else np.insert(seen, np.searchsorted(seen["set"], fresh["set"]), fresh)
    return heads[first], seen


def _prefix(word: np.ndarray, line: np.ndarray, begin: np.ndarray, n: np.ndarray, chosen: np.ndarray, rarity: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rarest words of the ``chosen`` lines that can match another set: half the hash
    of the word, the line and the word's place among the line's words by rarity."""
    # A set of n words can match another if it can match one of n + 1 that has them all.
    chosen = chosen & (n >= t * (n + 1) - 1e-9)
    # Words of each line by rarity, then by hash.
    rank = rarity[(word % np.uint64(COUNTERS)).astype(np.int64)].astype(np.uint64) << np.uint64(32) | word >> np.uint64(32)
    if not line.size or int(line[-1]) < 2**20:
        rank = np.sort(line.astype(np.uint64) << np.uint64(44) | rank)
    else:
        rank = rank[np.lexsort((rank, line))]
    pos = np.arange(rank.size) - np.repeat(begin, n)
    pick = chosen[line] & (pos < (n - _needed(n, t) + 1)[line])
    return rank[pick].astype(np.uint32), line[pick], pos[pick]


def prefixes(docs: DataFrame, rarity: np.ndarray, shards: int, t: float, least_words: int) -> DataFrame:
    """(shard, entries): prefix words of all sets, packed, by the shard of the word."""
    sent = docs.sparkSession.sparkContext.broadcast(rarity)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity, held, size, seen = sent.value, [], 0, np.zeros(0, SEEN)

        def flush() -> pa.RecordBatch:
            half, at, pos, of_line = zip(*held, strict=True)
            at = np.concatenate(at) + np.repeat(np.cumsum([0, *(x.size for x in of_line[:-1])]), [x.size for x in at])
            half, pos = np.concatenate(half), np.concatenate(pos)
            shard = (half % np.uint32(shards)).astype(np.int64)
            order = np.argsort(shard << 32 | half.astype(np.int64))  # by word, too, as neighbours compress well then
            rows = np.concatenate(of_line)[at[order]]
            rows["word"], rows["pos"] = half[order], pos[order]
            which, begin = runs(shard[order])
            blobs = [_packed(rows[a:b]) for a, b in zip(begin, np.append(begin[1:], rows.size), strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(which), pa.array(blobs, pa.binary())], ["shard", "entries"])

        for batch in batches:
            for first, last, raw, offsets in text_chunks(batch):
                lines = Lines(raw, offsets, least_words)
                if not lines.n.size:
                    continue
                sets, doc = lines.sets(), _column(batch, "doc_id", first, last)[lines.text]
                # A set's first line in this task so far speaks for the others. Rows come in any
                # order, so a set is sent again when an earlier line of it turns up.
                order = np.lexsort((lines.number, doc, sets))
                heads = order[np.concatenate(([True], np.diff(sets[order]) != 0))]
                heads, seen = _earlier(sets, doc, lines.number, heads, seen)
                chosen = np.zeros(lines.n.size, bool)
                chosen[heads] = True
                bitmap = _bitmap(lines.word, lines.begin, NARROW)
                half, at, pos = _prefix(lines.word, lines.line, lines.begin, lines.n, chosen, rarity, t)
                rows = np.zeros(lines.n.size, ENTRY)
                rows["set"], rows["doc"], rows["line"], rows["n"] = (sets >> np.uint64(32)).astype(np.uint32), doc, lines.number, lines.n
                for k in range(NARROW):
                    rows[f"bitmap{k}"] = bitmap[:, k]
                held.append((half, at, pos, rows))
                size += at.size
                if size > 200_000:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(make, "shard bigint, entries binary")


def _by_set(rows: np.ndarray) -> np.ndarray:
    """The order by word, set, doc and line; only entries of one word and set are compared by the latter."""
    key = rows["word"].astype(np.uint64) << np.uint64(32) | rows["set"]
    order = np.argsort(key)
    if not order.size:
        return order
    key = key[order]
    equal = np.concatenate(([False], key[1:] == key[:-1]))
    equal[:-1] |= equal[1:]
    some = order[equal]
    order[equal] = some[np.lexsort((rows["line"][some], rows["doc"][some], key[equal]))]
    return order


def pairs_of(rows: np.ndarray, t: float, apart: np.ndarray | None = None, listed: int = LISTED) -> Iterator[np.ndarray]:
    """Candidates among entries: later and earlier line, the place of the pair among the
    later line's, and whether there were more than the ``listed`` ones that are given.

    ``apart`` numbers blocks; only entries of different ones are then paired.
    """
    if not rows.size:
        return
    maps = [f"bitmap{k}" for k in range(NARROW)]
    order = _by_set(rows)
    rows = rows[order]
    new = np.concatenate(([True], np.logical_or.reduce([rows[c][1:] != rows[c][:-1] for c in ("word", "set", "n", *maps)])))
    by = np.flatnonzero(new)
    by = by[np.argsort((rows["word"].astype(np.uint64) << np.uint64(32) | rows["n"])[by])]
    rows, apart = rows[by], None if apart is None else apart[order[by]]
    word, begin = runs(rows["word"])
    group = np.repeat(np.arange(word.size), np.diff(np.append(begin, rows.size)))
    n = rows["n"].astype(np.int64)
    left, bitmap = n - rows["pos"], [np.ascontiguousarray(rows[c]) for c in maps]  # words from the shared one on
    part = n * ((1 - t) / (1 + t))  # two sets that match differ by the sum of these at most
    key = group << 32 | n
    # The shorter one of a match has the word among fewer of its rarest words; the place of
    # the word in the longer one bounds the length of the shorter one from above, too.
    shorter = np.flatnonzero(left >= _needed(2 * n, t / (1 + t)))
    longest = np.minimum(n, np.floor(left * ((1 + t) / t) + 1e-6).astype(np.int64) - n)
    low = np.searchsorted(key[shorter], group << 32 | _needed(n, t))
    high = np.searchsorted(key[shorter], group << 32 | np.maximum(longest, 0), side="right")
    count = np.maximum(0, np.minimum(high, np.searchsorted(shorter, np.arange(rows.size))) - low)
    # Blocks of entries with some hundred thousand pairs; an entry has at most as many as a shard's entries.
    total = np.cumsum(count)
    a = 0
    while a < rows.size:
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + 250_000, side="right")))
        j = np.repeat(np.arange(a, b), count[a:b])
        i = shorter[ranges(low[a:b], count[a:b])]
        # The first part of the bitmap rules out most pairs; what is left is looked at more closely.
        ok = np.bitwise_count(bitmap[0][i] ^ bitmap[0][j]) <= part[i] + part[j] + 1e-6
        if apart is not None:
            ok &= apart[i] != apart[j]
        i, j = i[ok], j[ok]
        size = n[i] + n[j]
        need = np.ceil(t / (1 + t) * size - 1e-9).astype(np.int64)
        apart_by = sum(np.bitwise_count(b[i] ^ b[j]).astype(np.int64) for b in bitmap)
        ok = (np.minimum(left[i], left[j]) >= need) & (apart_by <= size - 2 * need)
        i, j, apart_by = i[ok], j[ok], apart_by[ok]
        swap = (rows["doc"][i] > rows["doc"][j]) | ((rows["doc"][i] == rows["doc"][j]) & (rows["line"][i] > rows["line"][j]))
        later, earlier = np.where(swap, i, j), np.where(swap, j, i)
        # The most alike first; of these the earliest.
        order = np.lexsort((rows["line"][earlier], rows["doc"][earlier], apart_by, later))
        later, earlier, apart_by = later[order], earlier[order], apart_by[order]
        first = np.flatnonzero(np.concatenate(([True], np.diff(later) != 0))) if later.size else later
        size = np.diff(np.append(first, later.size))
        place, more = np.arange(later.size) - np.repeat(first, size), np.repeat(size > listed, size)
        keep = place < listed
        later, earlier, apart_by, place, more = later[keep], earlier[keep], apart_by[keep], place[keep], more[keep]
        columns = [rows["doc"][later], rows["line"][later], rows["doc"][earlier], rows["line"][earlier], apart_by.astype(np.int32), place.astype(np.int32), more]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_PAIRS)
        a = b


def line_key(doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    return mix(mix(doc.astype(np.uint64)) + line.astype(np.uint64))


def candidates(entries: DataFrame, t: float, listed: int = LISTED, most: int = SHARD) -> DataFrame:
    """Pairs of lines that share a prefix word and pass the filters. A task holds
    ``most`` entries of a shard at once."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, size = None, [], 0

        def done() -> Iterator[pa.RecordBatch]:
            if held and size <= most:
                for pairs in pairs_of(np.concatenate(held), t, None, listed):
                    yield _with(pairs, None, [None] * pairs.num_rows)
            give_back()

        def deferred() -> pa.RecordBatch:
            blobs = [_packed(h) for h in held]
            none = [pa.nulls(len(blobs), f.type) for f in _PAIRS]
            return pa.RecordBatch.from_arrays([*none, pa.array([shard] * len(blobs), pa.int64()), pa.array(blobs, pa.binary())], [*_PAIRS.names, "shard", "entries"])

        for batch in batches:
            for s, blob in zip(batch.column("shard").to_pylist(), batch.column("entries"), strict=True):
                if s != shard:
                    yield from done()
                    shard, held, size = s, [], 0
                rows = _unpacked(blob)
                size += rows.size
                held.append(rows)
                if size > most:  # too many for one task: these go to pairs of blocks
                    yield deferred()
                    held = []
        yield from done()

    def _with(pairs: pa.RecordBatch, s, blobs) -> pa.RecordBatch:
        n = pairs.num_rows
        return pa.RecordBatch.from_arrays([*pairs.columns, pa.array([s] * n, pa.int64()), pa.array(blobs, pa.binary())], [*_PAIRS.names, "shard", "entries"])

    met = entries.repartition("shard").sortWithinPartitions("shard").mapInArrow(meet, PAIR + ", shard bigint, entries binary")
    met = stored(met)
    pairs = met.filter("shard is null").select(*_PAIRS.names)
    full = met.filter("shard is not null").select("shard", "entries")
    sizes = full.groupBy("shard").agg(F.sum(F.octet_length("entries") / ENTRY.itemsize).alias("size"))
    if not sizes.limit(1).count():
        return pairs
    return pairs.union(stored(_between_blocks(full.join(sizes.select("shard", F.ceil(F.col("size") * 2 / most).cast("int").alias("blocks")), "shard"), t, listed)))


def _between_blocks(full: DataFrame, t: float, listed: int) -> DataFrame:
    """Pairs of shards that are too large for a task: each entry goes to a block by the
    hash of its set, and each two blocks meet; a block meets itself, too."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, blob, blocks in zip(batch.column("shard").to_pylist(), batch.column("entries"), batch.column("blocks").to_pylist(), strict=True):
                rows = _unpacked(blob)
                block = (mix(rows["set"].astype(np.uint64)) % np.uint64(blocks)).astype(np.int64)
                for k in range(blocks):
                    part = _packed(rows[block == k])
                    if part:
                        meet = [(min(k, other), max(k, other)) for other in range(blocks)]
                        yield pa.RecordBatch.from_pydict({"shard": [shard] * blocks, "a": [m[0] for m in meet], "b": [m[1] for m in meet], "own": [k] * blocks, "entries": [part] * blocks})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, own = None, [], []

        def done() -> Iterator[pa.RecordBatch]:
            if held:
                rows = np.concatenate(held)
                apart = np.repeat(own, [h.size for h in held]) if key[1] != key[2] else None
                yield from pairs_of(rows, t, apart, listed)

        for batch in batches:
            for s, a, b, k, blob in zip(*(batch.column(c).to_pylist() for c in ("shard", "a", "b", "own")), batch.column("entries"), strict=True):
                if (s, a, b) != key:
                    yield from done()
                    key, held, own = (s, a, b), [], []
                held.append(_unpacked(blob))
                own.append(k)
        yield from done()

    dealt = full.mapInArrow(deal, "shard bigint, a bigint, b bigint, own bigint, entries binary")
    return dealt.repartition("shard", "a", "b").sortWithinPartitions("shard", "a", "b").mapInArrow(meet, PAIR)


_PAIRS = pa.schema([("doc", pa.int64()), ("line", pa.int32()), ("other_doc", pa.int64()), ("other_line", pa.int32()), ("apart", pa.int32()), ("place", pa.int32()), ("more", pa.bool_())])


def _line_filter(lines: DataFrame) -> np.ndarray:
    """A bitmap of ``FILTER_BITS`` with the bits of the lines (doc, line) set."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = line_key(batch.column("doc").to_numpy(), batch.column("line").to_numpy()) % np.uint64(FILTER_BITS)
            word, bit = (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bit.view(np.int64))], ["word", "bit"])

    marked = lines.select("doc", "line").mapInArrow(mark, "word bigint, bit bigint")
    table = marked.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # FILTER_BITS / 64 rows at most
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[table.column("word").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return out


def words_of(docs: DataFrame, pairs: DataFrame, least_words: int) -> DataFrame:
    """(doc, line, n, wide bitmap, words) of each line in ``pairs``, stored."""
    needed = pairs.select("doc", "line").union(pairs.select("other_doc", "other_line")).distinct()
    ids = materialise(needed.select(F.col("doc").alias("doc_id")).distinct())
    if ids.count() <= BROADCAST_IDS:
        docs = docs.join(F.broadcast(ids), "doc_id", "left_semi")

    sent = docs.sparkSession.sparkContext.broadcast(_line_filter(needed))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = sent.value
        for batch in batches:
            for first, last, raw, offsets in text_chunks(batch):
                text, number, begin, end = _line_ends(raw, offsets)
                doc = _column(batch, "doc_id", first, last)[text]
                at = line_key(doc, number) % np.uint64(FILTER_BITS)
                # A few lines more than those needed; the join takes them out. Only these are cut into words.
                maybe = np.flatnonzero(marks[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1))
                size = (end - begin)[maybe]
                lines = Lines(raw[ranges(begin[maybe], size)], np.append(0, np.cumsum(size)), least_words)
                doc, number = doc[maybe[lines.text]], number[maybe[lines.text]].astype(np.int32)
                ends = np.append(0, np.cumsum(lines.n))
                words = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(lines.word.view(np.int64)))
                wide = _bitmap(lines.word, lines.begin, WIDE).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(number), pa.array(lines.n.astype(np.int32)), *(pa.array(wide[:, k]) for k in range(WIDE)), words], ["doc", "line", "n", *bits, "words"])

    bits = [f"bits{k}" for k in range(WIDE)]
    lines = docs.select("doc_id", "text").mapInArrow(sets, "doc bigint, line int, n int, " + "".join(f"{b} bigint, " for b in bits) + "words array<bigint>")
    lines = stored(lines)
    # Only rows that repeat a doc_id give a line more than once.
    repeated = lines.groupBy("doc", "line").count().filter("count > 1").limit(1).count()
    return stored(lines.dropDuplicates(["doc", "line"])) if repeated else lines


def possible(pairs: DataFrame, lines: DataFrame, t: float) -> DataFrame:
    """The pairs that the wide bitmaps of their lines don't rule out."""
    bits = [f"bits{k}" for k in range(WIDE)]
    own = lines.select("doc", "line", "n", *bits)
    other = lines.select(F.col("doc").alias("other_doc"), F.col("line").alias("other_line"), F.col("n").alias("other_n"), *(F.col(b).alias(f"other_{b}") for b in bits))
    size = F.col("n") + F.col("other_n")
    apart = sum((F.bit_count(F.col(b).bitwiseXOR(F.col(f"other_{b}"))) for b in bits), F.lit(0))
    return pairs.join(own, ["doc", "line"]).join(other, ["other_doc", "other_line"]).filter(apart <= size - 2 * F.ceil(t / (1 + t) * size - 1e-9)).select(*pairs.columns)


def verified(pairs: DataFrame, lines: DataFrame, t: float) -> DataFrame:
    """The pairs at a similarity of ``t`` or more, with it; ``lines`` are those of ``words_of``."""
    asked = pairs.select(F.col("other_doc").alias("doc"), F.col("other_line").alias("line")).distinct()
    other = lines.join(asked, ["doc", "line"], "left_semi").select(F.col("doc").alias("other_doc"), F.col("line").alias("other_line"), F.col("words").alias("other_words"))
    lines = lines.select("doc", "line", "words")
    both = pairs.join(lines, ["doc", "line"]).join(other, ["other_doc", "other_line"])
    # Stored before the filter, which would find the words in common a second time.
    counted = stored(both.select(*KEYS, F.size(F.array_intersect("words", "other_words")).alias("shared"), (F.size("words") + F.size("other_words")).alias("sizes")))
    return counted.withColumn("similarity", F.col("shared") / (F.col("sizes") - F.col("shared"))).filter(F.col("similarity") >= t - 1e-12).select(*KEYS, "similarity")


def _without(pairs: DataFrame, matches: DataFrame) -> DataFrame:
    """Those of ``pairs`` whose later line has no match."""
    return pairs.join(matches.select("doc", "line").distinct(), ["doc", "line"], "left_anti")


class Asked:
    """Lines that are searched for, with their words: sorted prefix words, and words numbered
    so that line and word are one number."""

    def __init__(self, table: pa.Table, rarity: np.ndarray, t: float):
        self.doc, self.number = table.column("doc").to_numpy(), table.column("line").to_numpy()
        self.n = table.column("n").to_numpy().astype(np.int64)
        word = table.column("words").combine_chunks().flatten().to_numpy().view(np.uint64)
        line, begin = np.repeat(np.arange(self.n.size), self.n), np.cumsum(self.n) - self.n
        half, at, pos = _prefix(word, line, begin, self.n, np.ones(self.n.size, bool), rarity, t)
        order = np.argsort(half, kind="stable")
        self.half, self.at, self.pos = half[order], at[order].astype(np.int32), pos[order].astype(np.int32)
        self.some = np.zeros(2**22, bool)  # which prefix words there may be, by their upper bits
        self.some[self.half >> np.uint32(10)] = True
        self.bitmap = _bitmap(word, begin, WIDE)
        self.known = np.unique(word)
        self.keys = np.sort(line * self.known.size + np.searchsorted(self.known, word))

    def touched(self, word: np.ndarray) -> np.ndarray:
        """Which of the words are a prefix word here."""
        half = (word >> np.uint64(32)).astype(np.uint32)
        at = np.flatnonzero(self.some[half >> np.uint32(10)])
        return at[self.half[np.minimum(np.searchsorted(self.half, half[at]), self.half.size - 1)] == half[at]]

    def shared(self, asked: np.ndarray, word: np.ndarray, begin: np.ndarray, n: np.ndarray) -> np.ndarray:
        """How many words each of the lines ``asked`` shares with a line of ``n`` words from ``begin`` on."""
        some = word[ranges(begin, n)]
        at = np.minimum(np.searchsorted(self.known, some), self.known.size - 1)
        key = np.repeat(asked, n) * self.known.size + at
        both = (self.known[at] == some) & (self.keys[np.minimum(np.searchsorted(self.keys, key), self.keys.size - 1)] == key)
        return per_text(both, np.append(0, np.cumsum(n)))


def _bitmap(word: np.ndarray, begin: np.ndarray, width: int) -> np.ndarray:
    """A bitmap of ``width`` numbers of each set, of whose bits each word turns one."""
    if not begin.size:
        return np.zeros((0, width), np.uint64)
    at = mix(word + np.uint64(11))
    bit, which = np.uint64(1) << (at >> np.uint64(58)), at % np.uint64(width)
    return np.stack([np.bitwise_xor.reduceat(np.where(which == k, bit, np.uint64(0)), begin) for k in range(width)], axis=1)


def searched(docs: DataFrame, lines: DataFrame, rarity: np.ndarray, t: float, least_words: int) -> DataFrame:
    """For each of ``lines`` (doc, line, words, n; a bounded number) the earliest line of
    ``docs`` before it that matches it, from each task."""
    sent = docs.sparkSession.sparkContext.broadcast((Asked(lines.toArrow(), rarity, t), rarity))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, rarity = sent.value
        best = np.zeros(asked.n.size, [("found", bool), ("doc", "<i8"), ("line", "<i4"), ("similarity", "<f8")])
        for batch in batches:
            for first, last, raw, offsets in text_chunks(batch):
                # Only lines with such a word are compared.
                lines = Lines(raw, offsets, least_words, asked.touched)
                if not lines.n.size:
                    continue
                doc = _column(batch, "doc_id", first, last)[lines.text]
                for own, other, similarity in _matches(asked, lines, doc, rarity, t):
                    order = np.lexsort((lines.number[other], doc[other], own))
                    head = order[np.concatenate(([True], np.diff(own[order]) != 0))] if own.size else order
                    own, other, similarity, old = own[head], other[head], similarity[head], best[own[head]]
                    new = ~old["found"] | (doc[other] < old["doc"]) | ((doc[other] == old["doc"]) & (lines.number[other] < old["line"]))
                    own, other = own[new], other[new]
                    best["found"][own], best["doc"][own], best["line"][own], best["similarity"][own] = True, doc[other], lines.number[other], similarity[new]
        at = np.flatnonzero(best["found"])
        columns = [asked.doc[at], asked.number[at], *(best[c][at] for c in ("doc", "line", "similarity"))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [*KEYS, "similarity"])

    return docs.select("doc_id", "text").mapInArrow(search, "doc bigint, line int, other_doc bigint, other_line int, similarity double")


def _matches(asked: Asked, lines: Lines, doc: np.ndarray, rarity: np.ndarray, t: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Lines that are searched for, earlier ones among ``lines`` that match them, and how similar they are."""
    half, at, pos = _prefix(lines.word, lines.line, lines.begin, lines.n, np.ones(lines.n.size, bool), rarity, t)
    low = np.searchsorted(asked.half, half)
    count = np.searchsorted(asked.half, half, side="right") - low
    met = np.flatnonzero(count)
    if not met.size:
        return
    at, pos, low, count = at[met], pos[met], low[met], count[met]
    total = np.cumsum(count)
    a = 0
    while a < met.size:
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + BLOCK, side="right")))
        i, j = np.repeat(np.arange(a, b), count[a:b]), ranges(low[a:b], count[a:b])
        own, other = asked.at[j].astype(np.int64), at[i]
        n, m = asked.n[own], lines.n[other]
        need = np.ceil(t / (1 + t) * (n + m) - 1e-9).astype(np.int64)
        ok = np.minimum(n - asked.pos[j], m - pos[i]) >= need
        ok &= (doc[other] < asked.doc[own]) | ((doc[other] == asked.doc[own]) & (lines.number[other] < asked.number[own]))
        # A pair once, however many words of the prefixes it shares.
        pair = np.unique(own[ok] * lines.n.size + other[ok])
        own, other = pair // lines.n.size, pair % lines.n.size
        n, m = asked.n[own], lines.n[other]
        need = np.ceil(t / (1 + t) * (n + m) - 1e-9).astype(np.int64)
        near, place = np.unique(other, return_inverse=True)
        bitmap = _bitmap(lines.word[ranges(lines.begin[near], lines.n[near])], np.cumsum(lines.n[near]) - lines.n[near], WIDE)
        ok = np.bitwise_count(asked.bitmap[own] ^ bitmap[place]).sum(axis=1, dtype=np.int64) <= n + m - 2 * need
        own, other, n, m = own[ok], other[ok], n[ok], m[ok]
        total_words = np.cumsum(m)
        c = 0
        while c < m.size:
            d = max(c + 1, int(np.searchsorted(total_words, (total_words[c - 1] if c else 0) + BLOCK, side="right")))
            shared = asked.shared(own[c:d], lines.word, lines.begin[other[c:d]], m[c:d])
            similarity = shared / (n[c:d] + m[c:d] - shared)
            good = similarity >= t - 1e-12
            yield own[c:d][good], other[c:d][good], similarity[good]
            c = d
        a = b


def find(docs: DataFrame, threshold: float = 0.8, least_words: int = 5, first_ones: int = FIRST, listed: int = LISTED, most: int = SHARD) -> DataFrame:
    """(doc_id, line_no, match_doc_id, match_line_no, similarity) of each line of ``docs``
    (doc_id, text) that matches an earlier one, with the earliest match found of it. ``first_ones``,
    ``listed`` and ``most`` (see ``candidates``) change the way, not which lines are found."""
    docs = docs.select("doc_id", "text").filter("doc_id is not null and text is not null")
    firsts, rarity, total = survey(docs, least_words)
    owner = firsts.groupBy("set").agg(F.min("doc").alias("least"), F.max("doc").alias("greatest")).filter("least < greatest")
    heads = stored(firsts.join(owner, "set").select("set", "doc", "line", "least"))
    own = heads.filter("doc = least").groupBy("set").agg(F.min("line").alias("least_line"))
    later = heads.filter("doc > least").join(own, "set").select("doc", "line", F.col("least").alias("other_doc"), F.col("least_line").alias("other_line"))
    within = firsts.filter("copies is not null").select("doc", F.explode("copies").alias("copy"), F.col("doc").alias("other_doc"), F.col("line").alias("other_line"))
    copies = later.union(within).withColumn("similarity", F.lit(1.0))
    # A set has about a part 1 - threshold of its words in its prefix.
    shards = max(16, int(total * (1 - threshold) * 1.2 / AIM))
    pairs = candidates(prefixes(docs, rarity, shards, threshold, least_words), threshold, listed, most)
    pairs = stored(pairs.groupBy(*KEYS).agg(F.min("place").alias("place"), F.min("apart").alias("apart"), F.max("more").alias("more")))
    lines = words_of(docs, pairs, least_words)
    # One candidate of each line, that most like it; then more of those that have no match.
    alike = Window.partitionBy("doc", "line").orderBy(F.col("place") > 0, "apart", "other_doc", "other_line")  # a line's listed candidates
    ranked = pairs.withColumn("best", F.row_number().over(alike) == 1).select(*KEYS, "place", "best")
    near = stored(possible(ranked, lines, threshold))
    matches = verified(near.filter("best").select(*KEYS), lines, threshold)
    tried = 0
    for most_of_word in sorted({min(first_ones, listed), listed}):
        more = near.filter(~F.col("best") & (F.col("place") >= tried) & (F.col("place") < most_of_word)).select(*KEYS)
        rest = stored(_without(more, matches))
        matches = matches.union(verified(rest, lines, threshold))
        tried = most_of_word
    # Lines that had more candidates than these: all of them.
    unmatched = stored(_without(pairs.filter("more").select("doc", "line").distinct(), matches))
    few = unmatched.count() <= BROADCAST_LINES
    left = stored(lines.join(F.broadcast(unmatched) if few else unmatched, ["doc", "line"], "left_semi").select("doc", "line", "n", "words"))
    passes = -(-(left.agg(F.sum("n")).first()[0] or 0) // PASS_WORDS)
    for k in range(passes):
        part = left.filter(F.pmod(F.xxhash64("doc", "line"), F.lit(passes)) == k)  # about PASS_WORDS words
        if part.limit(1).count():
            matches = matches.union(stored(searched(docs, part, rarity, threshold, least_words)))
    found = copies.union(matches)
    best = F.min(F.struct("other_doc", "other_line", "similarity"))
    out = found.groupBy("doc", "line").agg(best.alias("m"))
    return out.select(F.col("doc").alias("doc_id"), F.col("line").alias("line_no"), F.col("m.other_doc").alias("match_doc_id"), F.col("m.other_line").alias("match_line_no"), "m.similarity")


def remove(docs: DataFrame, threshold: float = 0.8, least_words: int = 5) -> DataFrame:
    """``docs`` without the lines that match an earlier one; all rows stay."""
    gone = find(docs, threshold, least_words).groupBy("doc_id").agg(F.collect_list("line_no").alias("__gone"))  # lines of one text
    row = docs.select(F.struct("*").alias("row"), "doc_id").join(gone, "doc_id", "left")
    left = F.array_join(F.filter(F.split("row.text", "\n", -1), lambda _, k: ~F.array_contains("__gone", k)), "\n")
    text = F.when(F.col("__gone").isNull(), F.col("row.text")).otherwise(left)
    columns = {"text": text.alias("text")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return row.select(*(columns.get(c, F.col(f"row.`{c}`")) for c in docs.columns))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line of the documents that matches an earlier line."""
    return find(read(spark, sf_dir, "documents", "doc_id", "text"), least_words=LEAST_WORDS)
