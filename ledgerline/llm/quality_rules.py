"""Quality rules: an ordered decision list learned by sequential covering.

Every text gets counts (words, characters in words, symbols, repeated lines,
repeated five-word windows and others), all over the whole text. Ratios of them are
the features of a list of threshold conjunctions, learned one after another from a
bounded sample of labelled texts: a rule is grown on two thirds of the sample by
information gain, pruned on the rest, kept if it is precise there, and the rows it
covers are taken out. The list is one ordered Spark expression.

Defined results: a null text has zero counts and fails the base rule (fewer than
``LEAST_WORDS`` words). Without labelled texts of both kinds the list is empty and
keeps all. Repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import _BYTES, WHITE, Words, _powers, first_by_hash, materialise, mix, output, per_text, read, schema_of, text_chunks, windows, with_text

LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
WINDOW = 5

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_digits", "n_lines", "n_distinct"]


def counts_of(raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The columns ``COUNTS`` of some texts."""
    words = Words(raw, offsets)
    text_of = np.repeat(np.arange(words.per_text.size), words.per_text)
    hashes = words.hashes()
    salt = mix(np.arange(words.per_text.size, dtype=np.uint64) + np.uint64(1))
    # Words covered by a window that its text has more than once.
    repeated = np.zeros(len(words) + 1, np.int64)
    if len(words) >= WINDOW:
        at = np.flatnonzero(text_of[: -WINDOW + 1] == text_of[WINDOW - 1 :])
        again = at[_repeats(windows(hashes, WINDOW)[at] ^ salt[text_of[at]])]
        np.add.at(repeated, again, 1)
        np.add.at(repeated, again + WINDOW, -1)
    covered = np.cumsum(repeated)[:-1] > 0
    own = np.sort(text_of.astype(np.uint64) << np.uint64(40) | hashes >> np.uint64(24))
    distinct = np.bincount((own[np.flatnonzero(np.diff(own, prepend=own[:1] + np.uint64(1)))] >> np.uint64(40)).astype(np.int64), minlength=words.per_text.size) if own.size else np.zeros(words.per_text.size, np.int64)
    n_lines, n_dup = _lines(raw, offsets, words, salt)
    return [
        words.per_text,
        per_text(words.inside & ((raw & 0xC0) != 0x80), offsets),
        per_text(SYMBOLS[raw], offsets),
        n_dup,
        per_text(covered, words.first),
        per_text(UPPER[raw], offsets),
        per_text(DIGIT[raw], offsets),
        n_lines,
        distinct,
    ]


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Positions of the keys that occur more than once."""
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    flag = np.zeros(keys.size, bool)
    flag[order[1:][same]] = True
    flag[order[:-1][same]] = True
    return np.flatnonzero(flag)


def _lines(raw, offsets, words, salt) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word of each text, and those of them that equal an earlier one."""
    n = offsets.size - 1
    if not len(words):
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    breaks = np.flatnonzero(raw == 0x0A)
    begin = np.union1d(offsets[:-1], breaks + 1)
    begin = begin[begin < raw.size]
    length = np.diff(np.append(begin, raw.size))
    place = np.arange(raw.size) - np.repeat(begin, length)
    value = _BYTES[raw] * _powers(int(length.max()))[place]
    value[breaks] = 0
    hashed = mix(np.add.reduceat(value, begin) + np.add.reduceat((raw != 0x0A).astype(np.uint64), begin))
    full = np.add.reduceat(words.inside.astype(np.int64), begin) > 0
    text = np.searchsorted(offsets, begin, side="right") - 1
    text, hashed = text[full], hashed[full]
    order = np.lexsort((hashed, text))
    same = (hashed[order][1:] == hashed[order][:-1]) & (text[order][1:] == text[order][:-1])
    return np.bincount(text, minlength=n), np.bincount(text[order][1:][same], minlength=n)


def with_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``COUNTS`` of each row's text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, raw, offsets in text_chunks(batch):
                yield output(batch, keep, first, last, counts_of(raw, offsets), COUNTS)

    return with_text(docs, keep).mapInArrow(count, schema_of(docs, keep) + ", ".join(f"{c} bigint" for c in COUNTS))


#: Feature: numerator and denominator.
RATIOS = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
    "upper_per_char": ("n_upper", "word_chars"),
    "digits_per_char": ("n_digits", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeated_words": ("n_repeat_words", "n_words"),
    "distinct_words": ("n_distinct", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
    "words": ("n_words", None),
}


def ratio(name: str) -> Column:
    top, bottom = RATIOS[name]
    return F.col(top).cast("double") / (F.greatest(F.col(bottom), F.lit(1)) if bottom else F.lit(1))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    limit: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.limit if self.above else x[self.feature] <= self.limit

    def expression(self) -> Column:
        return ratio(self.feature) > self.limit if self.above else ratio(self.feature) <= self.limit

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.limit:.6g}"


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def learn(x: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.95, support: int = 5, most_rules: int = 20, most_conditions: int = 4) -> list[list[Condition]]:
    """Rules for bad rows, in order, by sequential covering on a bounded sample. A rule must
    cover ``support`` bad rows that it was not grown on, and be right for a share of
    ``precision`` there and overall."""
    n = bad.size
    for_growing = np.arange(n) % 3 != 0
    limits = {f: _between(np.unique(np.quantile(v, np.linspace(0, 1, 65), method="nearest"))) for f, v in x.items()} if n else {}
    rules, left = [], np.ones(n, bool)
    while len(rules) < most_rules and (left & bad & for_growing).any():
        rule = _prune(_grow(x, bad, left & for_growing, limits, most_conditions), x, bad, left & ~for_growing)
        covered = left & _covers(rule, x)
        p, all_covered = (covered & bad & ~for_growing).sum(), (covered & ~for_growing).sum()
        if not rule or p < support or p / all_covered < precision or (covered & bad).sum() / covered.sum() < precision:
            break
        rules.append(rule)
        left &= ~covered
    return rules


def _between(values: np.ndarray) -> np.ndarray:
    return (values[1:] + values[:-1]) / 2


def _covers(rule, x) -> np.ndarray:
    return np.logical_and.reduce([c.holds(x) for c in rule]) if rule else np.zeros(next(iter(x.values())).size, bool)


def _grow(x, bad, rows, limits, most) -> list[Condition]:
    rule: list[Condition] = []
    while len(rule) < most:
        p, n = (rows & bad).sum(), (rows & ~bad).sum()
        if not n:
            break
        best, gain = None, 1e-9
        for f, cuts in limits.items():
            if not cuts.size:
                continue
            at = np.searchsorted(cuts, x[f][rows], side="left")
            ps = np.bincount(at[bad[rows]], minlength=cuts.size + 1)[: cuts.size].cumsum()  # rows at or below each limit
            ns = np.bincount(at[~bad[rows]], minlength=cuts.size + 1)[: cuts.size].cumsum()
            for above, pp, nn in ((False, ps, ns), (True, p - ps, n - ns)):
                g = np.where(pp > 0, pp * (np.log2(np.maximum(pp, 1) / np.maximum(pp + nn, 1)) - np.log2(p / (p + n))), 0)
                k = int(g.argmax())
                if g[k] > gain:
                    best, gain = Condition(f, above, float(cuts[k])), g[k]
        if best is None:
            break
        rule.append(best)
        rows = rows & best.holds(x)
    return rule


def _prune(rule, x, bad, rows) -> list[Condition]:
    """The head of the rule that does best on rows it was not grown on."""

    def worth(head):
        covered = rows & _covers(head, x)
        p = (covered & bad).sum()
        return (2 * p - covered.sum()) / max(1, covered.sum())

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=worth, default=[])


def verdict(rules: list[list[Condition]]) -> tuple[Column, Column]:
    """Whether a row is kept, and the number of the rule that rejects it (0: none),
    as ordered conditional expressions."""
    kept, which = F.lit(True), F.lit(0)
    for k, rule in reversed(list(enumerate(rules, 1))):
        condition = rule[0].expression()
        for c in rule[1:]:
            condition = condition & c.expression()
        kept, which = F.when(condition, F.lit(False)).otherwise(kept), F.when(condition, F.lit(k)).otherwise(which)
    return kept, which


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> list[list[Condition]]:
    """Learns from at most ``sample`` labelled (doc_id, quality) texts, chosen by hash."""
    known = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = materialise(first_by_hash(known, "doc_id", sample))
    rows = with_counts(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), ["doc_id", "quality"])  # bounded by ``sample``
    table = rows.filter(~base_failed()).orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id").limit(2 * sample).select("quality", *(ratio(f).alias(f) for f in RATIOS)).toArrow()
    x = {f: table.column(f).to_numpy() for f in RATIOS}
    return learn(x, table.column("quality").to_numpy() == 0)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    kept, rule = verdict(fit(docs, read(spark, sf_dir, "labels", "doc_id", "quality")))
    return with_counts(docs, ["doc_id"]).select(
        "doc_id", *COUNTS[:5], base_failed().alias("base_failed"), (~base_failed() & kept).alias("kept"), F.when(~base_failed(), rule).otherwise(0).alias("rule")
    )
