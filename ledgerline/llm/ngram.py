"""Interpolated modified Kneser-Ney models over small symbol alphabets.

Counting and estimation are Spark jobs. Symbols are packed into one integer per
n-gram, so contexts and suffixes are shifts and masks, and each join of counts is
an equi-join that shuffles by the hash of (group, context) or (group, suffix):
every shard joins its own share of the counts. The finished model has at most
``most`` n-grams, which bounds what is sent to the tasks.

A group ``g`` is one of several models estimated side by side (a language, or
target and background); they share the alphabet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import CHUNK_BYTES, LOWER, HashArray, Words, materialise, mix, output, schema_of, text_chunks, with_text

PAD, UNKNOWN = 0, 1
#: N-grams that a task holds before it sends their counts on.
HELD = 400_000


class Characters:
    """Symbols are lower-cased characters, the most frequent ones of a corpus."""

    bits = 12

    def __init__(self, points: list[int]):
        self.table = np.full(max([256, *(p + 2 for p in points)]), UNKNOWN, np.uint16)
        for k, p in enumerate(sorted(points)[: 2**self.bits - 2]):
            self.table[p] = k + 2
        self.size = int(self.table.max())

    @staticmethod
    def points(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code points of the lower-cased texts and their number in each text."""
        whole = raw.tobytes()
        texts = [whole[a:b].decode("utf-8", "replace").lower() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4"), np.fromiter(map(len, texts), np.int64, len(texts))

    def symbols(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        points, sizes = self.points(raw, offsets)
        return self.table[np.minimum(points, self.table.size - 1)], sizes


class Vocabulary:
    """Symbols are lower-cased words of a shared vocabulary, given by their hashes; the
    first ones have the lowest symbols."""

    bits = 21

    def __init__(self, hashes: np.ndarray):
        self.known = HashArray(hashes[: 2**self.bits - 2])
        self.size = self.known.keys.size + 1

    def symbols(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words = Words(raw, offsets)
        at = self.known.find(words.hashes(LOWER))
        return np.where(at < 0, UNKNOWN, at + 2).astype(np.uint32), words.per_text


def codes(symbols: np.ndarray, sizes: np.ndarray, order: int, bits: int) -> np.ndarray:
    """The n-gram that ends at each symbol, the last symbol in the lowest bits; what
    lies before a text's first symbol is PAD."""
    last = symbols.astype(np.int64)
    code, place = last.copy(), np.arange(last.size) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    for j in range(1, order):
        code[j:] |= np.where(place[j:] >= j, last[:-j] << (bits * j), 0)
    return code


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of an array that is sorted, and where each begins."""
    begin = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if values.size else np.zeros(0, np.int64)
    return values[begin], begin


def count_ngrams(df: DataFrame, units, order: int) -> DataFrame:
    """(g, code, c) of ``df``'s (g, text): counted within each task, then summed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def flush():
            for g, parts in held.items():
                code, c = _merge(parts)
                yield pa.RecordBatch.from_arrays([pa.array([g] * code.size, pa.string()), pa.array(code), pa.array(c)], ["g", "code", "c"])
            held.clear()

        for batch in batches:
            group = np.array(batch.column("g").to_pylist(), dtype=object)
            for first, last, raw, offsets in text_chunks(batch):
                symbols, sizes = units.symbols(raw, offsets)
                code = codes(symbols, sizes, order, units.bits)
                of = np.repeat(group[first:last], sizes) if len(set(group[first:last])) > 1 else None
                for g in sorted(set(group[first:last])):
                    part = np.sort(code if of is None else code[of == g])
                    distinct, begin = runs(part)
                    held.setdefault(g, []).append((distinct, np.diff(np.append(begin, part.size))))
                    if len(held[g]) > 4:
                        held[g] = [_merge(held[g])]
                size = sum(x[0].size for parts in held.values() for x in parts)
                if size > HELD:
                    yield from flush()
        yield from flush()

    return df.select("g", "text").mapInArrow(count, "g string, code bigint, c bigint").groupBy("g", "code").agg(F.sum("c").alias("c"))


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    code, c = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    by = np.argsort(code, kind="stable")
    distinct, begin = runs(code[by])
    return distinct, np.add.reduceat(c[by], begin) if distinct.size else c


def learn_characters(df: DataFrame, most: int = 4_094) -> Characters:
    """The ``most`` most frequent lower-cased characters of ``df``'s text, all rows
    counted. At most that many rows come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0x110000, np.int64)
        for batch in batches:
            for _, _, raw, offsets in text_chunks(batch):
                seen = np.bincount(Characters.points(raw, offsets)[0])
                total[: seen.size] += seen
        points = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(points), pa.array(total[points])], ["point", "c"])

    counts = df.select("text").mapInArrow(count, "point bigint, c bigint").groupBy("point").agg(F.sum("c").alias("c"))
    return Characters([r[0] for r in counts.orderBy(F.desc("c"), "point").limit(min(most, 2**Characters.bits - 2)).collect()])


@dataclass
class Model:
    """Log probabilities of n-grams and log back-off weights of contexts, in sorted
    hash arrays for each order; a column for each group."""

    groups: list[str]
    order: int
    bits: int
    grams: list[tuple[HashArray, np.ndarray]]  # of order 1, 2, ...
    backs: list[tuple[HashArray, np.ndarray]]  # by the order that is left
    floor: float  # log probability below order 1

    def log_p(self, code: np.ndarray) -> np.ndarray:
        """Natural log probability of each n-gram's last symbol, a column a group."""
        out = np.zeros((code.size, len(self.groups)), np.float32)
        todo = np.arange(code.size)
        for k in range(self.order, 0, -1):
            now = code[todo] & ((1 << (self.bits * k)) - 1)
            at = self.grams[k - 1][0].find(_key(now, k))
            hit = at >= 0
            out[todo[hit]] += self.grams[k - 1][1][at[hit]]
            todo, now = todo[~hit], now[~hit]
            if not todo.size:
                return out
            at = self.backs[k - 1][0].find(_key(now >> self.bits, k))
            out[todo[at >= 0]] += self.backs[k - 1][1][at[at >= 0]]
        out[todo] += self.floor
        return out

    def score(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Sum of log probabilities of each text, a column a group. Each distinct
        n-gram of the texts is looked up once."""
        out = np.zeros((sizes.size, len(self.groups)))
        if not symbols.size:
            return out
        code, at = np.unique(codes(symbols, sizes, self.order, self.bits), return_inverse=True)
        each = self.log_p(code).astype(np.float64)
        full = np.flatnonzero(sizes)
        begin = (np.cumsum(sizes) - sizes)[full]
        # In runs of texts, as a row of losses for each symbol takes much memory.
        for a in range(0, full.size, 200):
            own, first = full[a : a + 200], begin[a : a + 200]
            last = first[-1] + sizes[own[-1]]
            out[own] = np.add.reduceat(each[at[first[0] : last]], first - first[0], axis=0)
        return out


def _key(code: np.ndarray, order: int) -> np.ndarray:
    return mix(code.astype(np.uint64) * np.uint64(8) + np.uint64(order))


def estimate(counts: DataFrame, order: int, units, most: int = 2_000_000) -> Model:
    """The interpolated modified Kneser-Ney model of highest-order counts (g, code, c).

    Lower orders count distinct left neighbours. If a group has more n-grams than its
    share of ``most``, its rarest of the highest order are left out of the finished
    tables (their contexts still back off); if its lower orders are too many by
    themselves, so are the rarest of these, and contexts that they are. The estimates use
    all counts.
    """
    bits = units.bits
    levels = {order: materialise(counts)}
    for k in range(order - 1, 0, -1):
        lower = levels[k + 1].groupBy("g", F.col("code").bitwiseAND(F.lit((1 << bits * k) - 1)).alias("code")).agg(F.count(F.lit(1)).alias("c"))
        levels[k] = materialise(lower) if k > 1 else lower
    tally = None
    for k, level in levels.items():
        few = level.groupBy("g").agg(*(F.sum((F.col("c") == i).cast("bigint")).alias(f"n{i}") for i in (1, 2, 3, 4)), F.count(F.lit(1)).alias("n")).withColumn("k", F.lit(k))
        tally = few if tally is None else tally.union(few)
    stats = {(r["g"], r["k"]): r for r in tally.collect()}  # a row for each group and order
    groups = sorted({g for g, _ in stats})
    if not groups:
        return Model([], order, bits, [(HashArray(np.zeros(0, np.uint64)), np.zeros((0, 0), np.float32))] * order, [(HashArray(np.zeros(0, np.uint64)), np.zeros((0, 0), np.float32))] * order, 0.0)
    share = most // len(groups)
    room, leasts = dict.fromkeys(groups, share), {}
    for k in range(1, order + 1):
        leasts[k] = _least_counts(levels[k], {g: n for g, n in room.items() if stats[g, k]["n"] > n})
        room = {g: 0 if g in leasts[k] else n - stats[g, k]["n"] for g, n in room.items()}
    spark = counts.sparkSession
    lower, grams, backs, left = None, [], [], None
    for k in range(1, order + 1):
        cuts = spark.createDataFrame([(g, *_discounts(stats[g, k]), leasts[k].get(g, 1)) for g in groups], "g string, d1 double, d2 double, d3 double, least bigint")
        c = F.col("c")
        level = levels[k].join(F.broadcast(cuts), "g").withColumn("d", F.least(F.when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3")), c)).withColumn("ctx", F.shiftright("code", bits))
        ctx = level.groupBy("g", "ctx").agg((F.sum("d") / F.sum("c")).alias("back"), F.sum("c").alias("total"))
        both = level.join(ctx, ["g", "ctx"])
        if lower is None:
            p = (c - F.col("d")) / F.col("total") + F.col("back") / F.lit(float(units.size))
            table = both.select("g", "code", "c", p.alias("p"))
        else:
            low = lower.select("g", F.col("code").alias("low"), F.col("p").alias("p_low"))
            p = (c - F.col("d")) / F.col("total") + F.col("back") * F.col("p_low")
            table = both.withColumn("low", F.col("code").bitwiseAND(F.lit((1 << bits * (k - 1)) - 1))).join(low, ["g", "low"]).select("g", "code", "c", p.alias("p"))
        lower = materialise(table) if k < order else table
        kept = lower.join(F.broadcast(cuts.select("g", "least")), "g").filter(F.col("c") >= F.col("least")) if leasts[k] else lower
        if left is not None:  # contexts of which the order below has no n-gram, but the start of a text
            ctx = ctx.join(left, ["g", "ctx"], "left_semi")
            kept = kept.withColumn("ctx", F.shiftright("code", bits)).join(left, ["g", "ctx"], "left_semi")
        starts = spark.createDataFrame([(g, 0) for g in groups], "g string, ctx bigint")
        left = kept.select("g", F.col("code").alias("ctx")).union(starts) if leasts[k] or left is not None else None
        grams.append(kept.select("g", "code", F.log("p").cast("float").alias("v")).toArrow())
        backs.append(ctx.select("g", F.col("ctx").alias("code"), F.log("back").cast("float").alias("v")).toArrow())
    return _assemble(groups, order, bits, grams, backs, -float(np.log(units.size)))


def _least_counts(level: DataFrame, room: dict[str, int]) -> dict[str, int]:
    """For each group, the smallest count whose n-grams, with all more frequent ones, fit
    into its ``room``."""
    if not room:
        return {}
    step = F.when(F.col("c") < 1000, F.col("c")).otherwise(F.lit(1000) * F.pow(F.lit(2.0), F.floor(F.log2(F.col("c") / 1000)))).cast("bigint")
    rows = level.filter(F.col("g").isin(list(room))).groupBy("g", step.alias("c")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c")).collect()  # about 1,050 rows a group at most
    least, room, full = dict.fromkeys(room, 2**62), dict(room), set()
    for r in rows:
        room[r["g"]] -= r["n"]
        if room[r["g"]] < 0:
            full.add(r["g"])
        if r["g"] not in full:
            least[r["g"]] = r["c"]
    return least


def _discounts(r) -> tuple[float, float, float]:
    """The three discounts from how many n-grams were seen once to four times; where
    these numbers are too few for the formula, half a count."""
    n1, n2, n3, n4 = (float(r[f"n{i}"]) for i in (1, 2, 3, 4))
    if not (n1 and n2):
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    d1 = 1 - 2 * y * n2 / n1
    d2 = 2 - 3 * y * n3 / n2 if n3 else d1
    d3 = 3 - 4 * y * n4 / n3 if n3 and n4 else d2
    return tuple(float(np.clip(d, 0.05, top)) for d, top in ((d1, 1), (d2, 2), (d3, 3)))


def _matrix(table: pa.Table, groups: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes and a column of values for each group, NaN where absent."""
    code = table.column("code").to_numpy()
    g = np.searchsorted(np.array(groups, dtype=object), np.array(table.column("g").to_pylist(), dtype=object)) if len(groups) > 1 else np.zeros(code.size, np.int64)
    distinct, at = np.unique(code, return_inverse=True)
    out = np.full((distinct.size, len(groups)), np.nan, np.float32)
    out[at, g] = table.column("v").to_numpy()
    return distinct, out


def _assemble(groups, order, bits, grams, backs, floor) -> Model:
    """A group's missing n-gram gets the value that its back-off path gives, so one
    lookup serves all groups."""
    model = Model(groups, order, bits, [], [], floor)
    for k in range(1, order + 1):
        code, weight = _matrix(backs[k - 1], groups)
        model.backs.append((HashArray(_key(code, k)), np.nan_to_num(weight, nan=0.0)))
        code, value = _matrix(grams[k - 1], groups)
        gaps = np.isnan(value)
        if gaps.any():
            at = model.backs[k - 1][0].find(_key(code >> bits, k))
            lower = Model(groups, k - 1, bits, model.grams, model.backs, floor).log_p(code)
            lower[at >= 0] += model.backs[k - 1][1][at[at >= 0]]
            value = np.where(gaps, lower, value)
        model.grams.append((HashArray(_key(code, k)), value))
    return model


def score_texts(df: DataFrame, units, model: Model, finish: Callable, columns: str, keep: list[str]) -> DataFrame:
    """``keep`` columns and what ``finish(sums, sizes, raw, offsets)`` gives for each row's text."""
    spark = df.sparkSession
    sent = spark.sparkContext.broadcast((units, model))
    names = [c.split()[0] for c in columns.split(", ")]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, model = sent.value
        for batch in batches:
            for first, last, raw, offsets in text_chunks(batch, most=CHUNK_BYTES):
                symbols, sizes = units.symbols(raw, offsets)
                made = finish(model.score(symbols, sizes), sizes, raw, offsets)
                yield output(batch, keep, first, last, made, names)

    return with_text(df, keep).mapInArrow(score, schema_of(df, keep) + columns)
