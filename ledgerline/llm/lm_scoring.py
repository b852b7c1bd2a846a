"""Cross-entropy difference between a target model and a background model.

Both are interpolated modified Kneser-Ney bigram models over one vocabulary: the words of
the background down to a count with which at most ``vocabulary`` remain; every other word
is the unknown symbol. The background is every text of the corpus, the target is every
target text, which may be any number of the corpus' own. A text's score is the mean over its words of the target
loss minus the background loss; texts like the target score below zero.

Nothing but the vocabulary is bounded: all word pairs of all texts are counted, and none
is left out of the models. These stay in shards:

1. Tasks send each text's distinct pairs, packed, to the shard of their first word, which
   so has all pairs of that word. Pairs of one of the ``FREQUENT`` most frequent first
   words are spread by both words; if the second word is frequent, too, only their counts
   go there, and the text's own pairs to a shard of the text, as such a pair may be in
   every text. The shards are written to the shared folder.
2. Shards sum the pairs' counts and give what the models need of all shards: how many
   pairs occur once, twice, three and four times, in how many pairs a word is second, and
   the counts of the frequent first words and pairs. That is a row for each word of the
   vocabulary at most.
3. Shards work out the probability of each of their pairs and add up the losses of each
   text's; these sums meet by text.

Defined results: a null text or one without words has a null score, as has every
text if the target is empty. Repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import LOWER, Words, give_back, join_ids, materialise, mix, pack_columns, read, text_chunks, unpack_columns
from ledgerline.llm.ngram import HELD, Vocabulary, _discounts, _merge, codes, runs

BITS = Vocabulary.bits
#: Symbols that are frequent: padding, the unknown word and the most frequent words.
FREQUENT = 256
#: Words that a task holds before it sends pairs on; pairs of texts in a shard, as planned.
TOKENS, SHARD = 1_000_000, 3_000_000
#: Buckets of words in which their counts meet.
BUCKETS = 16
#: What a packed blob holds: pairs of texts, counts of pairs, pairs by text, sums of
#: texts, the rows themselves, counts of second words.
PAIRS, COUNTS, OWN, SUMS, ROWS, SECONDS = range(6)
SCORED, BACKGROUND, TARGET = 1, 2, 4


def word_counts(df: DataFrame) -> DataFrame:
    """(word, c): how often each lower-cased word, given by its hash, occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def made(parts):
            word, c = _merge(parts)
            return pa.RecordBatch.from_arrays([pa.array(word), pa.array(c)], ["word", "c"])

        for batch in batches:
            for _, _, raw, offsets in text_chunks(batch):
                hashes = np.sort(Words(raw, offsets).hashes(LOWER).view(np.int64))
                distinct, begin = runs(hashes)
                held.append((distinct, np.diff(np.append(begin, hashes.size))))
                if len(held) > 4:
                    held = [_merge(held)]
                if sum(h[0].size for h in held) > HELD:
                    yield made(held)
                    held = []
        if held:
            yield made(held)

    return df.select("text").mapInArrow(count, "word bigint, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def learn_vocabulary(background: DataFrame, most: int) -> tuple[Vocabulary, int]:
    """The most frequent words, at most ``most`` of them, in order of count, all words of
    one count or none; and how many words all texts have."""
    counts = materialise(word_counts(background))
    step = F.when(F.col("c") < 1000, F.col("c")).otherwise(F.lit(1000) * F.pow(F.lit(2.0), F.floor(F.log2(F.col("c") / 1000)))).cast("bigint")
    least, room = 2**62, min(most, 2**BITS - 3)
    rows = counts.groupBy(step.alias("c")).agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("all")).orderBy(F.desc("c")).collect()  # about 1,050 rows at most
    for r in rows:
        room -= r["n"]
        if room < 0:
            break
        least = r["c"]
    words = counts.filter(F.col("c") >= least).toArrow()
    word, c = words.column("word").to_numpy(), words.column("c").to_numpy()
    return Vocabulary(word[np.lexsort((word, -c))].view(np.uint64)), sum(r["all"] for r in rows)


def _rows(kind: int, shard: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """Packed rows (kind, shard, blob), one for each shard."""
    by = np.argsort(shard, kind="stable")
    which, begin = runs(shard[by])
    stop = np.append(begin[1:], by.size)
    blobs = [pack_columns(*(c[by[a:b]] for c in columns)) for a, b in zip(begin.tolist(), stop.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(np.full(which.size, kind)), pa.array(which), pa.array(blobs, pa.binary())], ["kind", "shard", "blob"])


_BLOBS = "kind bigint, shard bigint, blob binary"


def _spread(values: np.ndarray, parts: int) -> np.ndarray:
    return (mix(values.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)


def _home(code: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each pair: that of its first word, or of the pair if that is frequent."""
    first = code >> BITS
    return _spread(np.where(first < FREQUENT, code, first << BITS), shards)


def _both_frequent(code: np.ndarray) -> np.ndarray:
    return (code >> BITS < FREQUENT) & (code & ((1 << BITS) - 1) < FREQUENT)


def _dealt_pairs(texts: DataFrame, units: Vocabulary, shards: int) -> DataFrame:
    """Step 1, of (id, doc_id, role, text): packed pairs and rows by shard. The ids only
    number the rows of this pass."""
    sent = texts.sparkSession.sparkContext.broadcast(units)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            ids, docs, valid, roles, sizes, code = (np.concatenate(c) for c in zip(*held, strict=True))
            row = np.repeat(np.arange(ids.size), sizes)
            by = np.lexsort((row, code))
            code, row = code[by], row[by]
            first = np.flatnonzero(np.concatenate(([True], (code[1:] != code[:-1]) | (row[1:] != row[:-1])))) if code.size else code
            c = np.diff(np.append(first, code.size))
            code, row = code[first], row[first]
            often = _both_frequent(code)
            for kind, some, shard in ((PAIRS, ~often, _home(code, shards)), (OWN, often & (roles[row] & SCORED > 0), _spread(ids[row], shards))):
                if some.any():
                    yield _rows(kind, shard[some], code[some], ids[row[some]], c[some], roles[row[some]])
            # Counts of frequent pairs, without their texts.
            code, row, c = code[often], row[often], c[often]
            if code.size:
                distinct, begin = runs(code)
                sums = [np.add.reduceat(np.where(roles[row] & role > 0, c, 0), begin) for role in (BACKGROUND, TARGET)]
                yield _rows(COUNTS, _home(distinct, shards), distinct, *sums)
            scored = roles & SCORED > 0
            if scored.any():
                yield _rows(ROWS, _spread(ids[scored], shards), *(x[scored] for x in (ids, docs, valid, sizes)))
            give_back()

        for batch in batches:
            ids, roles = (batch.column(c).to_numpy() for c in ("id", "role"))
            docs, valid = batch.column("doc_id").fill_null(0).to_numpy(), batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b, raw, offsets in text_chunks(batch):
                symbols, sizes = sent.value.symbols(raw, offsets)
                held.append((ids[a:b], docs[a:b], valid[a:b], roles[a:b], sizes, codes(symbols, sizes, 2, BITS)))
                size += symbols.size
                if size > TOKENS:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return texts.mapInArrow(deal, _BLOBS)


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, list[bytes]]]]:
    """The blobs of each shard by their kind; rows are in order of shards."""
    now, held = None, {}
    for batch in batches:
        for kind, shard, blob in zip(*(batch.column(c).to_pylist() for c in ("kind", "shard", "blob")), strict=True):
            if shard != now and held:
                yield now, held
                held = {}
            now = shard
            held.setdefault(kind, []).append(blob)
    if held:
        yield now, held


def _joined(blobs: list[bytes], columns: int) -> list[np.ndarray]:
    parts = [unpack_columns(b, columns) for b in blobs]
    return [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * columns


class Shard:
    """The pairs of a shard: ``code``, ``count`` (a row for background and target), and,
    for the pairs of texts, ``at`` (their place in ``code``), ``ids`` and ``c``."""

    def __init__(self, blobs: dict[int, list[bytes]]):
        code, ids, c, roles = _joined(blobs.get(PAIRS, []), 4)
        frequent = _joined(blobs.get(COUNTS, []), 3)
        self.code, at = np.unique(np.concatenate([code, frequent[0]]), return_inverse=True)
        own, rest = at[: code.size], at[code.size :]
        self.count = np.array(
            [
                np.bincount(own, np.where(roles & role > 0, c, 0), self.code.size) + np.bincount(rest, frequent[k + 1], self.code.size)
                for k, role in enumerate((BACKGROUND, TARGET))
            ]
        ).astype(np.int64)
        scored = roles & SCORED > 0
        self.at, self.ids, self.c = own[scored], ids[scored], c[scored]

    def firsts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First words, the place of each pair's, and for either model what their pairs
        count in all and how many occur once, twice and more often."""
        word, at = np.unique(self.code >> BITS, return_inverse=True)
        sums = [np.stack([np.bincount(at, x, word.size) for x in (c, c == 1, c == 2, c > 2)]) for c in self.count]
        return word, at, np.stack(sums).astype(np.int64)


@dataclass
class Models:
    """What all shards need: the second-word probabilities of either model, discounts,
    and of frequent first words the counts (as in ``Shard.firsts``)."""

    second: np.ndarray  # (2, symbols)
    discounts: np.ndarray  # (2, 3)
    firsts: np.ndarray  # (2, 4, FREQUENT)

    def losses(self, code: np.ndarray, count: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """The losses of pairs under either model; ``firsts`` are their first words' counts."""
        out = np.zeros((2, code.size))
        for k in range(2):
            d1, d2, d3 = self.discounts[k]
            all_, once, twice, more = firsts[k].astype(float)
            c = count[k].astype(float)
            off = np.where(c == 0, 0, np.where(c == 1, d1, np.where(c == 2, d2, d3)))
            low = self.second[k][code & ((1 << BITS) - 1)]
            known = np.maximum(all_, 1)
            out[k] = -np.log(np.where(all_ > 0, (c - off) / known + (d1 * once + d2 * twice + d3 * more) / known * low, low))
        return out


def _statistics(shards: DataFrame) -> DataFrame:
    """Step 2: (what, word, v): sums of pairs that occur once to four times (word 0 to 7),
    of frequent first words and of frequent pairs; second words in packed blobs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, blobs in _by_shard(batches):
            shard = Shard(blobs)
            times = np.array([(c == k).sum() for c in shard.count for k in (1, 2, 3, 4)])
            word, _, sums = shard.firsts()
            often = word < FREQUENT
            pairs = _both_frequent(shard.code)
            what = [np.zeros(8, np.int64), *(np.full(int(often.sum()), 1 + k) for k in range(8)), *(np.full(int(pairs.sum()), 9 + k) for k in range(2))]
            words = [np.arange(8), *[word[often]] * 8, *[shard.code[pairs]] * 2]
            values = [times, *sums[:, :, often].reshape(8, -1), *shard.count[:, pairs]]
            n = sum(w.size for w in what)
            made = [pa.array(np.concatenate(x).astype(np.int64)) for x in (what, words, values)]
            yield pa.RecordBatch.from_arrays([*made, pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())], ["what", "word", "v", "kind", "shard", "blob"])
            second = shard.code & ((1 << BITS) - 1)
            distinct, at = np.unique(second, return_inverse=True)
            found = [np.bincount(at, c > 0, distinct.size).astype(np.int64) for c in shard.count]
            rows = _rows(SECONDS, distinct % BUCKETS, distinct, *found)
            yield pa.RecordBatch.from_arrays([*[pa.nulls(rows.num_rows, pa.int64())] * 3, *rows.columns], ["what", "word", "v", "kind", "shard", "blob"])
            give_back()

    return shards.mapInArrow(count, f"what bigint, word bigint, v bigint, {_BLOBS}")


def _models(statistics: DataFrame, units: Vocabulary) -> tuple[Models, np.ndarray, np.ndarray] | None:
    """The models, and the frequent pairs with their counts; None without a target."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, blobs in _by_shard(batches):
            word, *found = _joined(blobs[SECONDS], 3)
            distinct, at = np.unique(word, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(distinct), *(pa.array(np.bincount(at, c, distinct.size).astype(np.int64)) for c in found)], ["word", "background", "target"])

    dealt = statistics.filter("kind is not null").select("kind", "shard", "blob").repartition(BUCKETS, "shard").sortWithinPartitions("shard")
    seconds = dealt.mapInArrow(add, "word bigint, background bigint, target bigint").toArrow()  # a row for each word of the vocabulary
    rest = statistics.filter("what is not null").groupBy("what", "word").agg(F.sum("v").alias("v")).toArrow().sort_by([("what", "ascending"), ("word", "ascending")])
    what, word, v = (rest.column(c).to_numpy() for c in ("what", "word", "v"))
    times = np.zeros(8, np.int64)
    times[word[what == 0]] = v[what == 0]
    firsts = np.zeros((8, FREQUENT), np.int64)
    for k in range(8):
        firsts[k, word[what == 1 + k]] = v[what == 1 + k]
    pairs, counts = word[what == 9], np.stack([v[what == 9], v[what == 10]])
    second, discounts = [], []
    for k, name in enumerate(("background", "target")):
        c = np.zeros(units.size + 2, np.int64)
        c[seconds.column("word").to_numpy()] = seconds.column(name).to_numpy()
        if not c.any():
            return None
        d1, d2, d3 = _discounts({f"n{i}": int((c == i).sum()) for i in (1, 2, 3, 4)})
        off = np.where(c == 0, 0, np.where(c == 1, d1, np.where(c == 2, d2, d3)))
        second.append((c - off) / c.sum() + off.sum() / c.sum() / units.size)
        discounts.append(_discounts({f"n{i}": int(times[4 * k + i - 1]) for i in (1, 2, 3, 4)}))
    return Models(np.array(second), np.array(discounts), firsts.reshape(2, 4, FREQUENT)), pairs, counts


def _losses(shards: DataFrame, made: tuple[Models, np.ndarray, np.ndarray] | None, parts: int) -> DataFrame:
    """Step 3: (doc_id, n_tokens, background, target): the sums of losses of each row."""
    sent = shards.sparkSession.sparkContext.broadcast(made)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if sent.value is not None:
            models, pairs, counts = sent.value
            frequent = models.losses(pairs, counts, models.firsts[:, :, pairs >> BITS])
        for number, blobs in _by_shard(batches):
            own = blobs.get(ROWS, [])
            yield pa.RecordBatch.from_arrays([pa.array([ROWS] * len(own), pa.int64()), pa.array([number] * len(own), pa.int64()), pa.array(own, pa.binary())], ["kind", "shard", "blob"])
            if sent.value is None:
                continue
            shard = Shard(blobs)
            word, at, sums = shard.firsts()
            often = word < FREQUENT
            sums[:, :, often] = models.firsts[:, :, word[often]]
            loss = models.losses(shard.code, shard.count, sums[:, :, at])[:, shard.at] * shard.c
            code, ids, c, _ = _joined(blobs.get(OWN, []), 4)
            ids = np.concatenate([shard.ids, ids])
            loss = np.concatenate([loss, frequent[:, np.searchsorted(pairs, code)] * c], axis=1)
            if ids.size:
                by = np.argsort(ids, kind="stable")
                text, begin = runs(ids[by])
                total = np.add.reduceat(loss[:, by], begin, axis=1).astype(np.float32)
                yield _rows(SUMS, _spread(text, parts), text, *(t.view(np.int32) for t in total))
            give_back()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, blobs in _by_shard(batches):
            ids, docs, valid, n = _joined(blobs[ROWS], 4)
            by = np.argsort(ids)
            docs, valid, n = docs[by], valid[by], n[by]
            text, *sums = _joined(blobs.get(SUMS, []), 3)
            at = np.searchsorted(ids[by], text)
            whole = [np.bincount(at, x.astype(np.int32).view(np.float32).astype(float), n.size).astype(float) for x in sums]
            unknown = (n == 0) if sent.value is not None else np.ones(n.size, bool)
            made = [pa.array(docs, mask=valid == 0), pa.array(n), *(pa.array(w, mask=unknown) for w in whole)]
            yield pa.RecordBatch.from_arrays(made, ["doc_id", "n_tokens", "background", "target"])

    sums = shards.mapInArrow(weigh, _BLOBS).repartition(parts, "shard").sortWithinPartitions("shard")
    return sums.mapInArrow(add, "doc_id bigint, n_tokens bigint, background double, target double")


def score(docs: DataFrame, target: DataFrame, background: DataFrame | None = None, vocabulary: int = 1_000_000) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) of each row of ``docs``.

    ``target`` has a text column, or a doc_id column for the rows of ``docs`` with these
    ids; ``background`` is ``docs`` if not given. The vocabulary has at most
    ``vocabulary`` words (of 2**21); all else grows with the texts.
    """
    units, total = learn_vocabulary(docs if background is None else background, vocabulary)
    both = SCORED | (BACKGROUND if background is None else 0)
    role = F.lit(both)
    if "text" not in target.columns:  # a row's pairs are sent once, with all its roles
        ids = target.select("doc_id").filter("doc_id is not null").distinct().withColumn("role", F.lit(TARGET))
        docs, target = join_ids(docs.select("doc_id", "text"), ids, "left"), None
        role = role.bitwiseOR(F.coalesce("role", F.lit(0)))
    texts = docs.select(F.monotonically_increasing_id().alias("id"), F.col("doc_id").cast("bigint"), role.cast("bigint").alias("role"), "text")
    for others, role in ((target, TARGET), (background, BACKGROUND)):
        if others is not None:
            texts = texts.union(others.select(F.lit(-1).cast("bigint"), F.lit(None).cast("bigint"), F.lit(role).cast("bigint"), "text"))
    parts = int(max(4, -(-total // SHARD)))
    shards = materialise(_dealt_pairs(texts, units, parts).repartition(parts, "shard").sortWithinPartitions("shard"))
    sums = _losses(shards, _models(materialise(_statistics(shards)), units), parts)
    t, b = (F.col(c) / F.when(F.col("n_tokens") > 0, F.col("n_tokens")) for c in ("target", "background"))
    return sums.select("doc_id", "n_tokens", t.alias("target_loss"), b.alias("background_loss"), (t - b).alias("score"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's cross-entropy difference; the target are documents labelled good."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    good = read(spark, sf_dir, "labels", "doc_id", "quality").filter("quality = 1")
    return score(docs, good.select("doc_id"))
