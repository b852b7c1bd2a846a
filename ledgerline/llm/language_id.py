"""Language identification by character language models.

One interpolated modified Kneser-Ney model per language, over characters, in sorted
hash arrays. A text gets the language with the lowest cross-entropy per character.
The margin to the second language is calibrated on labelled texts that the counts
left out; a text whose confidence is below ``reject_below`` is rejected.

Defined results: a null text and one without a letter are ``und`` with score 0 and
rejected; so is every text if there is nothing to learn from. Repeated rows get
equal results. Columns other than those named are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise, read
from ledgerline.llm.ngram import count_ngrams, estimate, learn_characters, score_texts

UNDETERMINED = "und"
#: Texts from which on a language leaves some out of its counts, for calibration.
RARE = 50
#: Languages whose rates are broadcast; keys over which a language is spread beyond that.
BROADCAST_RATES, SALTS = 100_000, 64


def sample_by_language(docs: DataFrame, per_language: int) -> DataFrame:
    """About ``per_language`` texts of each language at most, chosen by the hash of
    doc_id, as (g, text, part); part 0 is for calibration, the others for counts. Texts
    of a language with fewer than ``RARE`` are all counted.

    Only the sample's texts move: rates are sent to the tasks, up to ``BROADCAST_RATES``
    of them; with more languages the ids are chosen by a join without the texts first.
    """
    labelled = docs.filter("lang is not null and text is not null")
    sizes = materialise(labelled.groupBy("lang").count())
    rates = sizes.select("lang", F.least(F.lit(1.0), F.lit(float(per_language)) / F.col("count")).alias("rate"), (F.col("count") < RARE).alias("rare"))
    share = F.pmod(F.xxhash64(F.lit(23), "doc_id"), F.lit(1_000_000)) / 1_000_000
    part = F.when(F.col("rare"), 1).otherwise(F.pmod(F.xxhash64(F.lit(29), "doc_id"), F.lit(5)))
    if sizes.count() <= BROADCAST_RATES:
        return labelled.join(F.broadcast(rates), "lang").filter(share < F.col("rate")).select(F.col("lang").alias("g"), "text", part.alias("part"))
    # The rows of a language are spread over several keys, each of which has its rate.
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    salted = rates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    chosen = labelled.select("doc_id", "lang", salt.alias("salt")).join(salted, ["lang", "salt"]).filter(share < F.col("rate")).select("doc_id", "lang", "rare").distinct()
    return labelled.join(chosen, ["doc_id", "lang"]).select(F.col("lang").alias("g"), "text", part.alias("part"))


def _scored(df: DataFrame, units, model, keep: list[str]) -> DataFrame:
    groups = model.groups

    def finish(sums, sizes, raw, offsets):
        if not groups:
            return [np.full(sizes.size, None, object), np.zeros(sizes.size), np.zeros(sizes.size), sizes]
        loss = -sums / np.maximum(sizes, 1)[:, None]
        order = np.argsort(loss, axis=1, kind="stable")
        rows = np.arange(sizes.size)
        best = loss[rows, order[:, 0]]
        second = loss[rows, order[:, min(1, len(groups) - 1)]]
        return [np.array(groups, object)[order[:, 0]], best, (second - best) * np.sqrt(sizes), sizes]

    return score_texts(df, units, model, finish, "best string, loss double, margin double, n_symbols bigint", keep)


def identify(docs: DataFrame, training: DataFrame, per_language: int = 2_000, order: int = 5, reject_below: float = 0.5, most: int = 1_500_000) -> DataFrame:
    """(doc_id, lang_pred, score, rejected, loss) of each row of ``docs``.

    ``training`` has doc_id, text and lang; about ``per_language`` texts of each
    language are learned from, four fifths for counts and a fifth for calibration.
    ``score`` is the share of calibration texts with a like margin that were right.
    """
    sample = materialise(sample_by_language(training, per_language))
    units = learn_characters(sample)
    model = estimate(count_ngrams(sample.filter("part > 0"), units, order), order, units, most)
    held = _scored(sample.filter("part = 0"), units, model, ["g"]).select("margin", (F.col("best") == F.col("g")).cast("double").alias("right"))
    # At most 21 rows: the calibration texts in order of their margin's size.
    steps = held.groupBy(F.least(F.lit(20), F.floor(F.log2(F.col("margin") * 8 + 1) * 2)).alias("step")).agg(F.count(F.lit(1)).alias("n"), F.sum("right").alias("right")).orderBy("step").collect()
    bins = np.zeros((21, 2))
    for r in steps:
        bins[int(r["step"])] = r["n"], r["right"]
    # Each step's share of right answers, with what is above it, so that it never falls.
    above = np.cumsum(bins[::-1], axis=0)[::-1]
    share = np.maximum.accumulate((bins[:, 1] + 8 * (above[:, 1] + 1) / (above[:, 0] + 1.01)) / (bins[:, 0] + 8))
    confidence = F.element_at(F.array(*(F.lit(float(min(1.0, s))) for s in share)), (F.least(F.lit(20), F.floor(F.log2(F.col("margin") * 8 + 1) * 2)) + 1).cast("int"))
    seen = docs.select("doc_id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    out = _scored(seen, units, model, ["doc_id", "letter"])
    known = F.col("letter") & F.col("best").isNotNull()
    score = F.when(known, confidence).otherwise(F.lit(0.0))
    return out.select(
        "doc_id",
        F.when(known, F.col("best")).otherwise(F.lit(UNDETERMINED)).alias("lang_pred"),
        score.alias("score"),
        (score < reject_below).alias("rejected"),
        F.when(known, F.col("loss")).alias("loss"),
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned where crc32(doc_id) mod 5 is not 0."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return identify(docs, docs.filter(~held_out)).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
