"""Hard negatives by exact inner-product search with coordinate pruning.

Rows are whole-number vectors with a label. The index holds them in length buckets: runs
of at most ``BUCKET`` rows of one label, ordered by length, packed and written to the
shared folder. In a task, a bucket has its unit vectors and, for each coordinate, their
values in order.

An anchor asks for the rows whose inner product reaches its threshold. Divided by the
anchor's length and by the bucket's largest, that is a least cosine, so a bucket of short
vectors falls away as a whole, and in the others each focus coordinate (the anchor's
largest) has a range of values that a row must lie in. The rows of the shortest range
that lie in the other ranges, too, are verified by their exact inner product. Where the
ranges leave more than a quarter of a bucket, all its rows are verified in one matrix
product.

A threshold is the fifth best score so far, in the task or from an earlier round: the
first round searches a sixteenth of the buckets, the second one the others. So few rows
leave the tasks. Anchors are sent to the tasks in blocks of ``BATCH_BYTES`` at most, one
search of the index for each block; the search is exact at every size, without caps.

Defined results: rows with a null vec_id, label or vector, or a null or non-finite entry,
take no part. A shorter vector counts as one that ends in zeros. Equal rows count once;
other rows that share a vec_id are rows of their own, but none is a positive or negative
of an anchor with that vec_id. An anchor without positives, or with none of a score of
zero or more, has no rows. An empty table gives none. Products beyond 2**62 raise.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import read, stored
from ledgerline.llm.vectors import pack, padded, sound_rows, unpack, whole

#: Rows of a length bucket, coordinates that an anchor is pruned by.
BUCKET, FOCUS = 2_048, 4
#: Bytes of anchors that are sent to the tasks at once.
BATCH_BYTES = 8_000_000
#: One bucket in so many is searched first.
FIRST = 16
#: Allows for rounding in unit vectors and ranges.
SLACK = 1e-7
NONE = -(2**62)


def prepared(rows: DataFrame, column: str) -> DataFrame:
    """(vec_id, label, length, x) of the rows (vec_id, label, ``column``) that take part."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sound, entries, sizes = sound_rows(batch, column)
            x = whole(entries)
            stops = np.cumsum(sizes)
            parts = [np.trim_zeros(x[a:b], "b") for a, b in zip((stops - sizes).tolist(), stops.tolist(), strict=True)]
            lengths = np.array([np.linalg.norm(p.astype(float)) for p in parts])
            kept = batch.take(pa.array(sound))
            yield pa.RecordBatch.from_arrays([kept.column("vec_id"), kept.column("label"), pa.array(lengths, pa.float64()), pa.array([pack(p) for p in parts], pa.binary())], ["vec_id", "label", "length", "x"])

    known = rows.filter("vec_id is not null and label is not null")
    return known.select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), column).mapInArrow(encode, "vec_id bigint, label bigint, length double, x binary")


def index(rows: DataFrame) -> DataFrame:
    """(label, first, width, ids, vectors) of ``prepared`` rows: length buckets of one
    label, of which ``first`` ones are searched first. Equal rows are entered once."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes]] = []
        label = last = None

        def bucket() -> pa.RecordBatch:
            ids = np.array([h[0] for h in held])
            parts = [unpack(h[1]) for h in held]
            sizes = np.array([p.size for p in parts])
            table = padded(np.concatenate(parts), sizes, width := int(sizes.max()))
            first = int(ids[0] * 0x9E3779B1 % 2**32 % FIRST) == 0
            return pa.RecordBatch.from_arrays([pa.array([label], pa.int64()), pa.array([first]), pa.array([width], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([pack(table)], pa.binary())], ["label", "first", "width", "ids", "vectors"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("label", "vec_id", "x")), strict=True):
                if row == last:
                    continue
                if held and (row[0] != label or len(held) == BUCKET):
                    yield bucket()
                    held = []
                last, label = row, row[0]
                held.append(row[1:])
        if held:
            yield bucket()

    ordered = rows.repartitionByRange("label", F.desc("length"), "vec_id").sortWithinPartitions("label", F.desc("length"), "vec_id", "x")
    return stored(ordered.mapInArrow(fill, "label bigint, first boolean, width int, ids binary, vectors binary"))


@dataclass
class Anchors:
    """A block of anchors; ``key`` numbers them over all blocks."""

    key: np.ndarray
    ids: np.ndarray
    label: np.ndarray
    x: np.ndarray

    def __post_init__(self):
        self.length = np.linalg.norm(self.x.astype(float), axis=1)
        self.unit = self.x / np.where(self.length > 0, self.length, 1)[:, None]


class Bucket:
    """A length bucket in a task: rows by vec_id, unit vectors and coordinate lists."""

    def __init__(self, label: int, width: int, ids: bytes, vectors: bytes):
        self.label, self.width = label, width
        ids = np.frombuffer(ids, np.int64)
        by_id = np.argsort(ids, kind="stable")
        self.ids = ids[by_id]
        self.x = unpack(vectors).reshape(ids.size, width)[by_id].astype(float)
        length = np.linalg.norm(self.x, axis=1)
        self.longest = float(length.max())
        self.unit = self.x / np.where(length > 0, length, 1)[:, None]
        self.order = np.argsort(self.unit, axis=0, kind="stable").T
        self.value = np.take_along_axis(self.unit.T, self.order, axis=1)

    def search(self, anchors: Anchors, asked: np.ndarray, least: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each of the ``asked`` anchors, the places and scores of rows, among them
        all whose score is at least its ``least``."""
        top = anchors.length[asked] * self.longest
        if top.size and top.max() >= 2**62:
            raise ValueError("inner products beyond 2**62 are not supported")
        goal = np.where(least[asked] > 0, (least[asked] - 0.5) / np.where(top > 0, top, 1e-300), -1.0)
        live = goal <= 1.0
        asked, goal = asked[live], goal[live]
        if not asked.size:
            return
        exact = bool(top.max() < 2**53)
        x = self.x if exact else self.x.astype(np.int64)
        q = anchors.x[:, : self.width]
        q = np.pad(q, ((0, 0), (0, self.width - q.shape[1]))) if q.shape[1] < self.width else q
        q = q.astype(float) if exact else q
        few = min(FOCUS, self.width, anchors.unit.shape[1])
        if few:
            unit = anchors.unit[asked, : self.width]
            focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :few]
            angle = np.arccos(np.clip(np.take_along_axis(unit, focus, axis=1), -1, 1))
            wide = np.arccos(np.clip(goal - SLACK, -1, 1))[:, None]
            low, high = np.cos(np.minimum(np.pi, angle + wide)) - SLACK, np.cos(np.maximum(0, angle - wide)) + SLACK
            begin, end = np.zeros(focus.shape, np.int64), np.zeros(focus.shape, np.int64)
            for f in np.unique(focus):
                at = focus == f
                begin[at] = np.searchsorted(self.value[f], low[at], "left")
                end[at] = np.searchsorted(self.value[f], high[at], "right")
            size = end - begin
            best = size.argmin(axis=1)
            shortest = size[np.arange(asked.size), best]
        else:
            shortest = np.full(asked.size, self.ids.size)
        dense = shortest > self.ids.size // 4
        for a in np.flatnonzero(~dense):
            f = best[a]
            found = self.order[focus[a, f], begin[a, f] : end[a, f]]
            for k in range(few):
                if k != f and found.size:
                    value = self.unit[found, focus[a, k]]
                    found = found[(value >= low[a, k]) & (value <= high[a, k])]
            if found.size:
                found = np.sort(found)
                yield int(asked[a]), found, x[found] @ q[asked[a]]
        every = np.arange(self.ids.size)
        dense = asked[dense]
        for a in range(0, dense.size, 256):
            part = dense[a : a + 256]
            for one, scores in zip(part.tolist(), q[part] @ x.T, strict=True):
                yield one, every, scores


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[Bucket]:
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("label", "width", "ids", "vectors")), strict=True):
            yield Bucket(*row)


class Best:
    """The best rows for some questions: higher scores first, ties by smaller id."""

    def __init__(self, questions: int, wanted: int, least: np.ndarray):
        self.wanted, self.least = wanted, least.copy()
        self.found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * questions

    def offer(self, question: int, scores: np.ndarray, ids: np.ndarray) -> None:
        have = self.found[question]
        scores, ids = np.concatenate([have[0], scores.astype(np.int64)]), np.concatenate([have[1], ids])
        order = np.lexsort((ids, -scores))[: self.wanted]
        self.found[question] = scores[order], ids[order]
        if order.size == self.wanted:
            self.least[question] = max(self.least[question], int(scores[order[-1]]))


def _positives(buckets: DataFrame, anchors: Anchors, least: np.ndarray, wanted: int) -> DataFrame:
    """(key, score, id): rows of an anchor's label, the best ``wanted`` of each task among
    those with a score of at least ``least``."""
    sent = buckets.sparkSession.sparkContext.broadcast((anchors, least))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, least = sent.value
        best = Best(anchors.key.size, wanted, least)
        for bucket in _buckets(batches):
            for a, places, scores in bucket.search(anchors, np.flatnonzero(anchors.label == bucket.label), best.least):
                good = (scores >= best.least[a]) & (bucket.ids[places] != anchors.ids[a])
                if good.any():
                    best.offer(a, scores[good], bucket.ids[places[good]])
        sizes = [s.size for s, _ in best.found]
        if any(sizes):
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(anchors.key, sizes)), pa.array(np.concatenate([s for s, _ in best.found])), pa.array(np.concatenate([i for _, i in best.found]))], ["key", "score", "id"])

    return buckets.mapInArrow(search, "key bigint, score bigint, id bigint")


@dataclass
class Pairs:
    """Anchors with their positives: a pair's anchor by place, id, score and number."""

    anchor: np.ndarray
    ids: np.ndarray
    score: np.ndarray
    nth: np.ndarray


def _negatives(buckets: DataFrame, anchors: Anchors, pairs: Pairs, least: np.ndarray, wanted: int) -> DataFrame:
    """(key, nth, anchor_id, positive_id, positive_score, score, id): rows of other labels
    whose score is at least a pair's ``least`` and at most its positive's, the best
    ``wanted`` of each task."""
    sent = buckets.sparkSession.sparkContext.broadcast((anchors, pairs, least))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, pairs, least = sent.value
        best = Best(pairs.anchor.size, wanted, least)
        heads = np.unique(pairs.anchor)
        first = np.searchsorted(pairs.anchor, heads)
        stop = np.append(first[1:], pairs.anchor.size)
        span = dict(zip(heads.tolist(), zip(first.tolist(), stop.tolist(), strict=True), strict=True))
        lowest = np.zeros(anchors.key.size, np.int64)
        lowest[heads] = np.minimum.reduceat(best.least, first) if heads.size else 0
        for bucket in _buckets(batches):
            for a, places, scores in bucket.search(anchors, heads[anchors.label[heads] != bucket.label], lowest):
                good = (scores >= lowest[a]) & (bucket.ids[places] != anchors.ids[a])
                if not good.any():
                    continue
                scores, ids = scores[good].astype(np.int64), bucket.ids[places[good]]
                lo, hi = span[a]
                for pair in range(lo, hi):
                    inside = (scores >= best.least[pair]) & (scores <= pairs.score[pair])
                    if inside.any():
                        best.offer(pair, scores[inside], ids[inside])
                lowest[a] = best.least[lo:hi].min()
        sizes = [s.size for s, _ in best.found]
        if any(sizes):
            of = np.repeat(np.arange(len(sizes)), sizes)
            made = [anchors.key[pairs.anchor[of]], pairs.nth[of], anchors.ids[pairs.anchor[of]], pairs.ids[of], pairs.score[of]]
            yield pa.RecordBatch.from_arrays([*map(pa.array, made), pa.array(np.concatenate([s for s, _ in best.found])), pa.array(np.concatenate([i for _, i in best.found]))], ["key", "nth", "anchor_id", "positive_id", "positive_score", "score", "id"])

    return buckets.mapInArrow(search, "key bigint, nth bigint, anchor_id bigint, positive_id bigint, positive_score bigint, score bigint, id bigint")


def _ranked(found: DataFrame, question: list[str], wanted: int) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(*question).orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", nth).filter(F.col("rank") <= wanted)


def _fifth(top: DataFrame, question: list[str], wanted: int) -> pa.Table:
    """Questions that have ``wanted`` rows, and the last one's score: a row a question of
    one block of anchors."""
    return top.filter(F.col("rank") == wanted).select(*question, "score").toArrow()


def mine(rows: DataFrame, column: str, anchors: DataFrame, positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100)) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the
    ``anchors`` among ``rows`` (both vec_id, label, ``column``).

    An anchor's positives are its best rows of the same label; for each, the negatives
    are the best rows of other labels whose score, times ``share[1]``, is between
    ``share[0]`` and ``share[1]`` times the positive's.
    """
    spark = rows.sparkSession
    buckets = index(prepared(rows, column))
    asked = stored(prepared(anchors, column).drop("length").distinct())
    count, width = asked.agg(F.count(F.lit(1)), F.max(F.length("x"))).first()
    parts = max(1, -(-count * 8 * (width or 1) // BATCH_BYTES))
    early, late = buckets.filter("first"), buckets.filter("not first")
    out = None
    for part in range(parts):
        block = asked.filter(F.pmod(F.xxhash64("vec_id", "x"), F.lit(parts)) == part).orderBy("vec_id", "label", "x").toArrow()
        if not block.num_rows:
            continue
        vectors = [unpack(b) for b in block.column("x").to_pylist()]
        sizes = np.array([v.size for v in vectors])
        held = Anchors(part * 2**32 + np.arange(sizes.size), block.column("vec_id").to_numpy(), block.column("label").to_numpy(), padded(np.concatenate(vectors), sizes, int(sizes.max())))
        # Positives: the second round starts from the first one's thresholds.
        one = stored(_positives(early, held, np.full(sizes.size, NONE), positives))
        least = np.full(sizes.size, NONE)
        fifth = _fifth(_ranked(one, ["key"], positives), ["key"], positives)
        least[fifth.column("key").to_numpy() - part * 2**32] = fifth.column("score").to_numpy()
        two = _positives(late, held, least, positives)
        top = _ranked(one.union(two), ["key"], positives).filter("score >= 0").orderBy("key", "rank").toArrow()
        pairs = Pairs(top.column("key").to_numpy() - part * 2**32, top.column("id").to_numpy(), top.column("score").to_numpy(), top.column("rank").to_numpy().astype(np.int64))
        if not pairs.ids.size:
            continue
        least = -(-pairs.score * share[0] // share[1])
        question = ["key", "nth"]
        one = stored(_negatives(early, held, pairs, least, negatives))
        fifth = _fifth(_ranked(one, question, negatives), question, negatives)
        place = {k: i for i, k in enumerate(zip(pairs.anchor.tolist(), pairs.nth.tolist(), strict=True))}
        for key, nth, score in zip(*(fifth.column(c).to_pylist() for c in (*question, "score")), strict=True):
            at = place[key - part * 2**32, nth]
            least[at] = max(least[at], score)
        two = stored(_negatives(late, held, pairs, least, negatives))
        made = one.union(two)
        out = made if out is None else out.union(made)
    if out is None:
        out = spark.createDataFrame([], "key bigint, nth bigint, anchor_id bigint, positive_id bigint, positive_score bigint, score bigint, id bigint")
    return _ranked(out, ["key", "nth"], negatives).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
negatives AS (
  SELECT p.anchor_id, p.positive_id, n.other AS negative_id, p.positive_score, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other) AS INTEGER) AS "rank"
  FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same
   AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score)
SELECT anchor_id, positive_id, "rank", negative_id, positive_score, negative_score FROM negatives WHERE "rank" <= 5
"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every embedding whose vec_id is divisible by 100, for each of
    its five nearest of the same label. Labels of rows whose vec_id is divisible by 7 are
    moved on by one first."""
    rows = read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine(rows, "embedding", rows.filter(F.col("vec_id") % 100 == 0))
