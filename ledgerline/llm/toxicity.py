"""Toxicity by a support vector machine on a gap-weighted subsequence kernel.

Words are strings of letters: case, punctuation, accents' lead bytes and look-alike
digits are folded away, a run of single letters is one word, so that ``i.d i.o t`` reads
like its plain form, and a mark stands before and after each word. The kernel of two
words counts the subsequences of three letters they share, each weighted by ``DECAY`` to
the power of its length with gaps; inserted letters lower it a little instead of breaking
it. Nyström landmarks turn the kernel into a short vector, on which a linear machine is
trained with the squared hinge loss.

It learns from labelled sentences (lines; one that clean texts also have is clean). Each
of their words stands on both sides, by its rate in toxic and in clean ones, the clean
side ``COST`` times: so a word that is merely frequent in toxic texts stays harmless, one
that clean texts never have gets the full margin, and others lie between. All words with
runs of letters that toxic sentences have far more often than clean ones take part, in
any language, and a sample by hash of the others. Insults are also shown with one to
three letters put in, and, as harmless, with another last letter or one more in front.

A text's evidence is the largest sum over ``SPAN`` neighbouring words of their evidence,
the logarithm of how much more often words of such a margin are in toxic texts. A rising
curve makes it a probability, as of a text drawn from as many toxic as clean ones. Both
are fitted on a third of the labelled texts, by hash, from which the machine learns
nothing.

As the kernel is a sum over triples of letters, the machine is a table of their weights:
a word's margin is a sum over its own triples, divided by its norm. A bound of the norm
that depends on the length alone shows which margins are too low for any evidence.

Defined results: null and empty texts and texts without letters have no evidence. Without
labelled texts of both kinds, or without any telling run, every score is the share of
toxic texts, limited to under 0.5; without both kinds in the fitting third, all texts
serve for that. Repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import Words, first_by_hash, materialise, mix, output, ranges, read, schema_of, text_chunks, with_text
from ledgerline.llm.ngram import runs

ORDER, DECAY = 3, 0.6
#: A longer word is taken in overlapping pieces.
PIECE, STRIDE = 16, 8
#: How many times the rate in clean sentences counts against that in toxic ones.
COST = 30.0
#: Rounds in which words are added that are not telling but have this margin or more.
ROUNDS, NEAR = 2, -0.3
#: Weight of all words without telling runs against the toxic weight of those with one.
REST = 30.0
#: Weight of a telling word itself on the toxic side.
OWN = 2.0
#: Changed forms of an insult, of each kind, that the machine is shown.
VARIANTS = 8
#: Weight of changed forms against the word: letters put in, letters altered.
INSERTED, ALTERED = 1.0, 0.1
#: Neighbouring words whose evidence is added up.
SPAN = 200
#: Evidence, in thousandths, beyond which more makes no difference.
ENOUGH = 15_000
#: Words so many times as frequent in toxic texts, by their margin, are evidence.
TELLING = 5.0
#: Bytes of text that are worked on at once.
CHUNK = 2_000_000
#: Marks before and after a word.
BEGIN, END = 61, 62
WIDTH = PIECE + 2

LETTERS = np.zeros(256, np.uint8)
LETTERS[97:123] = LETTERS[65:91] = np.arange(1, 27)
for digit, letter in zip(b"013457@", b"oieasta", strict=True):
    LETTERS[digit] = letter - 96
LETTERS[128:192] = 27 + np.arange(64) % 32
BITS = 6


class Pieces:
    """Words of some texts as letters; ``start`` and ``size`` in ``letter``, ``text``."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        words = Words(raw, offsets)
        letter = LETTERS[raw[words.inside]]
        word = np.repeat(np.arange(len(words)), words.end - words.start)[letter > 0]
        self.letter = letter[letter > 0]
        size = np.bincount(word, minlength=len(words))
        text = np.repeat(np.arange(words.per_text.size), words.per_text)[size > 0]
        size = size[size > 0]
        single = size == 1
        new = np.ones(size.size, bool)
        new[1:] = ~(single[1:] & single[:-1] & (text[1:] == text[:-1]))
        first = np.flatnonzero(new)
        self.size = np.add.reduceat(size, first) if first.size else size
        self.text = text[first]
        self.start = np.cumsum(self.size) - self.size
        self.of = np.repeat(np.arange(self.size.size), self.size)
        many = np.where(self.size <= PIECE, 1, -(-(self.size - PIECE) // STRIDE) + 1)
        shift = STRIDE * ranges(np.zeros(many.size, np.int64), many)
        self.start, whole, self.text = np.repeat(self.start, many) + shift, np.repeat(self.size, many) - shift, np.repeat(self.text, many)
        self.size = np.minimum(whole, PIECE)
        self.begins, self.ends = shift == 0, whole <= PIECE

    def fours(self) -> tuple[np.ndarray, np.ndarray]:
        """Runs of four letters within words: place and code."""
        s = self.letter.astype(np.int64)
        at = np.flatnonzero(self.of[:-3] == self.of[3:])
        return at, s[at] << 3 * BITS | s[at + 1] << 2 * BITS | s[at + 2] << BITS | s[at + 3]

    def counts(self, flags: np.ndarray) -> np.ndarray:
        """Sums of ``flags``, one for each letter, in each piece."""
        total = np.concatenate(([0], np.cumsum(flags)))
        return total[self.start + self.size] - total[self.start]

    def matrix(self, chosen: np.ndarray) -> np.ndarray:
        """The letters of some pieces with their marks, a row each, 0 after the last."""
        out = np.zeros((chosen.size, WIDTH), np.uint8)
        size, begins, ends = self.size[chosen], self.begins[chosen].astype(np.int64), self.ends[chosen]
        out[np.repeat(np.arange(chosen.size), size), ranges(begins, size)] = self.letter[ranges(self.start[chosen], size)]
        out[begins > 0, 0] = BEGIN
        last = np.flatnonzero(ends)
        out[last, (begins + size)[last]] = END
        return out


def kernel(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The subsequence kernel of each row of ``s`` (n, letters) with each of ``t`` (m,
    letters), or of each with its own ones if t is (n, m, letters); 0 pads."""
    t = t[None] if t.ndim == 2 else t
    t = np.where(t == 0, 255, t)
    n, m, width = s.shape[0], t.shape[1], t.shape[2]
    gap = np.arange(width + 1)[None, :] - 1 - np.arange(width)[:, None]
    decays = np.where(gap >= 0, DECAY ** (2.0 + gap), 0).astype(np.float32)
    prefix = [np.ones((n, m, width + 1), np.float32)] + [np.zeros((n, m, width + 1), np.float32) for _ in range(ORDER - 1)]
    total = np.zeros((n, m), np.float32)
    for a in range(int((s > 0).sum(axis=1).max()) if n else 0):
        match = s[:, a, None, None] == t
        total += DECAY**2 * (match * prefix[-1][:, :, :-1]).sum(axis=2)
        for i in range(ORDER - 1, 0, -1):
            prefix[i] *= DECAY
            prefix[i] += (match * prefix[i - 1][:, :, :-1]) @ decays
    return total


PLACES = np.array(list(combinations(range(WIDTH), ORDER)))
#: Weight of each triple of places.
FADED = DECAY ** (PLACES[:, 2] - PLACES[:, 0] + 1.0)
#: The least norm of a word of so many letters and marks: that with all triples different.
LEAST_NORM = np.sqrt([max(float((FADED[PLACES[:, 2] < n] ** 2).sum()), 1e-12) for n in range(WIDTH + 1)])


def triples(rows: np.ndarray) -> np.ndarray:
    """The codes of all triples of letters of words (n, letters), 0 beyond their ends."""
    s = rows.astype(np.int32)
    a, b, c = (s[:, PLACES[:, k]] for k in range(3))
    return np.where(c > 0, a << 2 * BITS | b << BITS | c, 0)


def norms(rows: np.ndarray, step: int = 2_000) -> np.ndarray:
    """The kernel norm of each word."""
    parts = [kernel(rows[a : a + step], rows[a : a + step, None, :])[:, 0] for a in range(0, rows.shape[0], step)]
    return np.sqrt(np.maximum(np.concatenate(parts), 1e-12)) if parts else np.zeros(0)


def similarity(rows: np.ndarray, landmarks: np.ndarray, step: int = 400, block: int = 64) -> np.ndarray:
    """The normalised kernel of each word with each landmark, by their triples."""
    out = np.zeros((rows.shape[0], landmarks.shape[0]), np.float32)
    size = norms(rows)[:, None]
    for first in range(0, landmarks.shape[0], block):
        marks = landmarks[first : first + block]
        known = np.unique(code := triples(marks))
        known = known[known > 0]
        column = np.full(1 << 3 * BITS, -1, np.int32)
        column[known] = np.arange(known.size)

        def counts(code: np.ndarray, column=column, many=known.size) -> np.ndarray:
            at = column[code]
            word, place = np.nonzero(at >= 0)
            return np.bincount(word * many + at[word, place], FADED[place], code.shape[0] * many).reshape(-1, many)

        own = counts(code).T / norms(marks)
        for a in range(0, rows.shape[0], step):
            out[a : a + step, first : first + block] = counts(triples(rows[a : a + step])) @ own / size[a : a + step]
    return out


@dataclass
class Machine:
    """A fitted model: ``table`` has the weight of each triple of letters."""

    table: np.ndarray
    bias: float
    #: Evidence by margin, in thousandths; the curve from evidence to probability.
    steps: tuple[np.ndarray, np.ndarray] = (np.zeros(0), np.zeros(0, np.int64))
    curve: tuple[np.ndarray, np.ndarray] = (np.zeros(1), np.zeros(1))

    def margins(self, rows: np.ndarray) -> np.ndarray:
        """The margin of each word, given as letters with their marks."""
        return (self.table[triples(rows)] * FADED).sum(axis=1) / norms(rows) + self.bias

    def above(self, pieces: Pieces, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Pieces whose margin is ``least`` or more, in order, and their margins."""
        size = pieces.size + pieces.begins + pieces.ends
        found, table = [], self.table.astype(np.float32)
        for n in np.unique(size):
            chosen = np.flatnonzero(size == n)
            rows = np.ascontiguousarray(pieces.matrix(chosen)[:, :n].T).astype(np.int32)
            total = np.zeros(chosen.size, np.float32)
            for i in range(n - 2):
                for j in range(i + 1, n - 1):
                    pair = rows[i] << 2 * BITS | rows[j] << BITS
                    for k in range(j + 1, n):
                        total += table[pair | rows[k]] * np.float32(DECAY ** (k - i + 1))
            # The norm is at least that of as many different triples, so this bounds the margin.
            found.append(chosen[total / LEAST_NORM[n] + self.bias >= least - 1e-3])
        found = np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
        margin = self.margins(pieces.matrix(found)) if found.size else np.zeros(0)
        return found[margin >= least], margin[margin >= least]

    def evidence(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Each text's largest sum of evidence over ``SPAN`` neighbouring words."""
        out = np.zeros(offsets.size - 1, np.int64)
        if not self.steps[0].size:
            return out
        pieces = Pieces(raw, offsets)
        found, margin = self.above(pieces, self.steps[0][0])
        if found.size:
            worth = self.steps[1][np.searchsorted(self.steps[0], margin, "right") - 1]
            # A word's pieces count as neighbours, too.
            text = pieces.text[found]
            total = np.concatenate(([0], np.cumsum(worth)))
            key = text * (pieces.size.size + SPAN + 1) + found
            since = np.searchsorted(key, np.maximum(key - SPAN + 1, text * (pieces.size.size + SPAN + 1)))
            np.maximum.at(out, text, total[1:] - total[since])
        return out

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return np.interp(evidence, *self.curve)


def _four_counts(sentences: DataFrame) -> DataFrame:
    """(code, toxic, clean): in how many sentences of either kind each run of four letters is."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
            for first, last, raw, offsets in text_chunks(batch):
                pieces = Pieces(raw, offsets)
                at, code = pieces.fours()
                text = np.searchsorted(pieces.start, at, side="right") - 1
                pair = np.unique(code << 32 | pieces.text[text])
                kind = toxic[first:last][pair & 0xFFFFFFFF]
                codes, begin = runs(pair >> 32)
                both = np.diff(np.append(begin, pair.size))
                bad = np.add.reduceat(kind.astype(np.int64), begin) if begin.size else both
                yield _columns(code=codes, toxic=bad, clean=both - bad)

    return sentences.select("text", "toxic").mapInArrow(count, "code bigint, toxic bigint, clean bigint").groupBy("code").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _columns(**columns) -> pa.RecordBatch:
    """Whole-number columns, and words as bytes, whose types do not depend on the rows."""
    made = [pa.array(v, pa.binary() if k == "word" else pa.int64()) for k, v in columns.items()]
    return pa.RecordBatch.from_arrays(made, list(columns))


def _row_hashes(rows: np.ndarray) -> np.ndarray:
    scale = mix(np.arange(1, WIDTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    return mix((rows.astype(np.uint64) * scale).sum(axis=1, dtype=np.uint64))


def _word_counts(sentences: DataFrame, codes: np.ndarray, one_in: int) -> DataFrame:
    """(word, toxic, clean, telling): how often words are in sentences of either kind, of
    those that have one of some runs of letters, and of one in ``one_in`` others, by hash.
    The row without a word counts all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
            for first, _, raw, offsets in text_chunks(batch):
                pieces = Pieces(raw, offsets)
                flag = np.zeros(pieces.letter.size, np.int64)
                at, code = pieces.fours()
                flag[at[np.isin(code, codes)]] = 1
                telling = pieces.counts(flag) > 0
                rows = pieces.matrix(np.arange(pieces.size.size))
                at = np.flatnonzero((telling | (_row_hashes(rows) % np.uint64(one_in) == 0)) & (pieces.size >= 3))
                bad = toxic[first + pieces.text]
                words = [None, *map(bytes, rows[at])]
                yield _columns(word=words, toxic=[bad.sum(), *bad[at]], clean=[bad.size - bad.sum(), *(1 - bad[at])], telling=[0, *telling[at].astype(np.int64)])

    made = sentences.select("text", "toxic").mapInArrow(count, "word binary, toxic bigint, clean bigint, telling bigint")
    return made.groupBy("word").agg(*(F.sum(c).alias(c) for c in ("toxic", "clean")), F.max("telling").alias("telling"))


def _near_counts(sentences: DataFrame, machine: Machine) -> DataFrame:
    """(word, toxic, clean, telling) of the words whose margin is ``NEAR`` or more."""
    sent = sentences.sparkSession.sparkContext.broadcast(machine)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
            for first, _, raw, offsets in text_chunks(batch, CHUNK):
                pieces = Pieces(raw, offsets)
                at, _ = sent.value.above(pieces, NEAR)
                at = at[pieces.size[at] >= 3]
                bad = toxic[first + pieces.text[at]]
                yield _columns(word=[*map(bytes, pieces.matrix(at))], toxic=bad, clean=1 - bad)

    made = sentences.select("text", "toxic").mapInArrow(count, "word binary, toxic bigint, clean bigint")
    return made.groupBy("word").agg(*(F.sum(c).alias(c) for c in ("toxic", "clean"))).withColumn("telling", F.lit(0).cast("bigint"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000, landmarks: int = 800, words: int = 6_000, seed: int = 7) -> Machine:
    """Learns from at most ``sample`` labelled (doc_id, toxic) texts, chosen by hash: from
    their most frequent ``words`` telling words, as many others, chosen by hash, and in
    each round as many words that the machine wrongly takes for insults."""
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = materialise(first_by_hash(known, "doc_id", sample))
    texts = docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(chosen), "doc_id")  # bounded by ``sample``
    third = F.pmod(F.xxhash64(F.lit(3), "text"), F.lit(3)) == 0
    texts = materialise(texts.groupBy("text").agg(F.max("toxic").alias("toxic")).withColumn("third", third))
    kinds = {(r[0], r[1]): r[2] for r in texts.groupBy("toxic", "third").count().collect()}
    bad = sum(n for (toxic, _), n in kinds.items() if toxic == 1)
    share = bad / max(1, sum(kinds.values()))
    none = Machine(np.zeros(1 << 3 * BITS), 0.0, curve=(np.zeros(1), np.full(1, min(share, 0.49))))
    if not (kinds.get((1, False)) and kinds.get((0, False))):
        return none
    sentences = materialise(texts.filter("not third").select(F.explode(F.split("text", "\n")).alias("text"), "toxic").groupBy("text").agg(F.min("toxic").alias("toxic")))
    sizes = {r[0]: r[1] for r in sentences.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return none
    # Runs that toxic sentences have far more often than chance explains.
    expected = F.col("clean") * (sizes[1] / sizes[0])
    surprise = (F.col("toxic") - expected) / F.sqrt(expected + 1)
    table = materialise(_four_counts(sentences)).filter((F.col("toxic") >= 3) & (surprise >= 3) & (F.col("toxic") >= 4 * expected)).toArrow()
    codes = np.sort(table.column("code").to_numpy())
    if not codes.size:
        return none
    counted = materialise(_word_counts(sentences, codes, 10))
    total = counted.filter("word is null").first()
    telling = counted.filter("word is not null and telling = 1").orderBy(F.desc(F.col("toxic") + F.col("clean")), "word").limit(words).toArrow()
    others = counted.filter("word is not null and telling = 0").orderBy(F.xxhash64("word"), "word").limit(words).toArrow()
    if not total["toxic"] or not total["clean"] or not telling.num_rows:
        return none
    near = telling.slice(0, 0)
    for _ in range(ROUNDS):
        machine = _learn(telling, others, near, total["toxic"], total["clean"], landmarks, seed)
        met = pa.concat_tables([telling, near]).column("word").to_pylist()
        found = _near_counts(sentences, machine).orderBy(F.desc("clean"), "word").limit(words + len(met)).toArrow()
        fresh = pa.array(~np.isin(np.array(found.column("word").to_pylist(), dtype=object), np.array(met, dtype=object)))
        near = pa.concat_tables([near, found.filter(fresh).slice(0, words).select(near.column_names).cast(near.schema)])
    machine = _learn(telling, others, near, total["toxic"], total["clean"], landmarks, seed)
    fitting = texts.filter("third") if kinds.get((1, True)) and kinds.get((0, True)) else texts
    _calibrate(machine, fitting)
    return machine


def _learn(telling: pa.Table, others: pa.Table, near: pa.Table, bad: int, good: int, landmarks: int, seed: int) -> Machine:
    """The machine of some words with their counts, of ``bad`` and ``good`` words in all;
    ``near`` are words that a former machine found insulting."""
    rng = np.random.default_rng(seed)
    word = _rows(telling)
    toxic, clean = (telling.column(c).to_numpy() / n for c, n in (("toxic", bad), ("clean", good)))
    plain = _rows(others)
    # The others, words without a telling run, weigh as much as the telling ones.
    part = others.column("toxic").to_numpy() + others.column("clean").to_numpy()
    part = part / max(part.sum(), 1)
    insult = np.flatnonzero((toxic > COST * clean) & (toxic >= 3 / bad))
    order = insult[np.argsort(-toxic[insult], kind="stable")]
    insults, weight = word[order], toxic[order]
    ends = {row[row > 0].tobytes()[:-2] for row in word[insult]}
    alone = np.array([sum(e.startswith(row[row > 0].tobytes()[:-2]) for e in ends) == 1 for row in insults[:500]], bool)
    rest = REST * toxic.sum()
    x, pro, con = [word, plain, _rows(near)], [OWN * toxic, rest / COST * part, near.column("toxic").to_numpy() / bad], [COST * clean, rest * part, COST * near.column("clean").to_numpy() / good]
    for n in (1, 2, 3) * VARIANTS:
        x.append(_inserted(insults, n, rng))
        pro.append(INSERTED * weight / VARIANTS)
        con.append(np.zeros(weight.size))
    for place in (0, 1):
        x.append(np.concatenate([_altered(insults[:500][alone], place, letter) for letter in range(1, 27)]))
        pro.append(np.zeros(26 * int(alone.sum())))
        con.append(np.tile(ALTERED * weight[:500][alone] / VARIANTS, 26))
    marks = _apart(np.concatenate([insults, *x[3:6]]), landmarks // 2)
    marks = np.concatenate([marks, _apart(np.concatenate([x[2], word[toxic <= COST * clean], *x[-2:], plain]), landmarks - marks.shape[0])])
    own = norms(marks)
    every = np.concatenate(x)
    weights, bias = _train(similarity(marks, marks), similarity(every, marks), np.concatenate(pro), np.concatenate(con))
    table = np.bincount(triples(marks).ravel(), (FADED[None, :] * (weights / own)[:, None]).ravel(), 1 << 3 * BITS)
    table[0] = 0
    return Machine(table, bias)


def _rows(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("word").to_pylist()), np.uint8).reshape(-1, WIDTH)


def _apart(words: np.ndarray, most: int) -> np.ndarray:
    """Words in order, each unless it is much like one that is already chosen."""
    pool = np.unique(words, axis=0, return_index=True)[1]
    pool = words[np.sort(pool)][: 3 * most]
    k = similarity(pool, pool)
    chosen: list[int] = []
    near = np.zeros(pool.shape[0])
    for limit in (0.5, 0.8, 2.0):
        for i in range(pool.shape[0]):
            if len(chosen) < most and near[i] < limit:
                chosen.append(i)
                near = np.maximum(near, k[:, i])
                near[i] = np.inf
    return pool[chosen]


def _inserted(words: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """Each word with ``n`` random letters put between its own."""
    for _ in range(n):
        inner = (words > 0).sum(axis=1) - 2  # the letters of a word with both marks
        at = 2 + (rng.random(inner.size) * np.maximum(inner - 1, 1)).astype(int)
        place = np.arange(WIDTH)[None, :]
        shifted = np.concatenate([words[:, :1], words[:, :-1]], axis=1)
        words = np.where(place < at[:, None], words, shifted)
        words[np.arange(at.size), at] = rng.integers(1, 27, at.size)
    return words


def _altered(words: np.ndarray, place: int, letter: int) -> np.ndarray:
    """Each word with a letter put in front (0) or in the place of its last one (1)."""
    out = words.copy()
    if place == 0:
        out[:, 2:] = words[:, 1:-1]
        out[:, 1] = letter
    else:
        row, at = np.arange(words.shape[0]), np.maximum((words > 0).sum(axis=1) - 2, 1)
        out[row, at] = np.where(words[row, at] == letter, 27, letter)
    return out


def _train(k_marks: np.ndarray, k: np.ndarray, pro: np.ndarray, con: np.ndarray, penalty: float = 1e-8) -> tuple[np.ndarray, float]:
    """Weights on kernel values of a linear machine on the Nyström features, with the
    squared hinge loss, by Newton steps; ``pro`` and ``con`` weigh the two sides of a word."""
    value, vector = np.linalg.eigh(k_marks.astype(float))
    good = value > 1e-6
    root = vector[:, good] / np.sqrt(value[good])
    scale = 1 / (pro.sum() + con.sum())
    pro, con = pro * scale, con * scale
    parts = [slice(a, a + 2_000) for a in range(0, pro.size, 2_000)]
    x = [np.column_stack([k[p] @ root, np.ones(k[p].shape[0])]).astype(np.float32) for p in parts]
    theta = np.zeros(x[0].shape[1])
    ridge = penalty * np.append(np.ones(theta.size - 1), 1e-3)
    for _ in range(60):
        left, right = np.diag(ridge), np.zeros(theta.size)
        for p, one in zip(parts, x, strict=True):
            one = one.astype(float)
            f = one @ theta
            up, down = pro[p] * (f < 1), con[p] * (f > -1)
            left = left + (one * (up + down)[:, None]).T @ one
            right += one.T @ (up - down)
        step = np.linalg.solve(left, right)
        if np.abs(step - theta).max() < 1e-8:
            break
        theta = theta + 0.7 * (step - theta)
    return root @ theta[:-1], float(theta[-1])


def _calibrate(machine: Machine, texts: DataFrame) -> None:
    """Fits evidence by margin, and probability by evidence, on labelled texts."""
    sent = texts.sparkSession.sparkContext.broadcast(machine)

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
            for first, _, raw, offsets in text_chunks(batch):
                pieces = Pieces(raw, offsets)
                found, margin = sent.value.above(pieces, -0.95)
                kind = toxic[first + pieces.text] == 1
                low = np.full(pieces.size.size, -20)
                low[found] = np.floor(margin * 20).astype(np.int64)
                code, begin = runs(np.sort(low * 2 + kind))
                yield _columns(bin=code >> 1, toxic=code & 1, n=np.diff(np.append(begin, low.size)))

    counts = texts.select("text", "toxic").mapInArrow(bins, "bin bigint, toxic bigint, n bigint").groupBy("bin", "toxic").agg(F.sum("n").alias("n")).toArrow()
    margin, toxic, n = (counts.column(c).to_numpy() for c in ("bin", "toxic", "n"))
    at, odds = _rising(margin / 20, toxic == 1, n)
    machine.steps = at[odds >= TELLING], np.round(1000 * np.log(odds[odds >= TELLING])).astype(np.int64)
    held = with_margins(texts, machine, ["toxic"]).groupBy("toxic", "evidence").count().toArrow().sort_by([("evidence", "ascending"), ("toxic", "ascending")])
    machine.curve = _curve(held.column("evidence").to_numpy(), held.column("toxic").to_numpy() > 0, held.column("count").to_numpy())


def _rising(margin: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From which margin on words are how many times as frequent in toxic texts, rising."""
    bad, good = float(n[toxic].sum()) + 1, float(n[~toxic].sum()) + 1
    blocks: list[list[float]] = []  # first margin, toxic, clean
    ratio = lambda b: (b[1] + 0.5) / bad / ((b[2] + 0.5) / good)
    for m in np.unique(margin):
        at = margin == m
        blocks.append([m, float(n[at & toxic].sum()), float(n[at & ~toxic].sum())])
        while len(blocks) > 1 and ratio(blocks[-2]) >= ratio(blocks[-1]):
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0], blocks[-1][1] + last[1], blocks[-1][2] + last[2]]
    return np.array([b[0] for b in blocks]), np.array([ratio(b) for b in blocks])


def _curve(evidence: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The probability of being toxic by evidence, among as many toxic texts as clean
    ones: a logistic curve, which never falls, as points between which it is straight."""
    at = np.linspace(0, ENOUGH, 151)
    x = np.column_stack([np.ones(evidence.size), np.minimum(evidence, ENOUGH) / ENOUGH])
    n = n / np.where(toxic, n[toxic].sum(), n[~toxic].sum()) * n.sum() / 2
    theta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ theta))
        slope = x.T @ (n * (toxic - p)) - np.array([0, 0.02]) * theta
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + np.diag([1e-9, 0.02]), slope)
        theta = theta + np.clip(step, -2, 2)
    if theta[1] <= 0:
        return np.zeros(1), np.full(1, 0.49)
    return at, 1 / (1 + np.exp(-(theta[0] + theta[1] * at / ENOUGH)))


def with_margins(docs: DataFrame, machine: Machine, keep: list[str]) -> DataFrame:
    """``keep`` columns, evidence (in thousandths) and score of each row's text."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = sent.value
        for batch in batches:
            for first, last, raw, offsets in text_chunks(batch, CHUNK):
                evidence = machine.evidence(raw, offsets)
                yield output(batch, keep, first, last, [evidence, machine.probability(evidence)], ["evidence", "score"])

    return with_text(docs, keep).mapInArrow(judge, schema_of(docs, keep) + "evidence bigint, score double")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned where crc32(doc_id) mod 3 is not 1."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    machine = fit(docs, read(spark, sf_dir, "labels", "doc_id", "toxic").filter(~held_out))
    return with_margins(docs, machine, ["doc_id"]).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "evidence"
    )
