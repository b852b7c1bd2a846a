"""Near-duplicate documents by SimHash and a segment-popcount embedding.

A fingerprint of 64 bits is mapped to the bit counts of its 16 segments of 4 bits. The
Manhattan distance of two such vectors is a lower bound of the Hamming distance, so
fingerprints within 2 bits lie within 2 in the grid of vectors. Two vectors are that
close exactly if some grid point is within 1 of both: each fingerprint is put into the
33 cells of its unit ball at most, and a range join is an equi-join on cells. A cell
with two fingerprints is verified by their exact Hamming distance. Fingerprints of
fuller cells are verified through points of the Hamming cube: two are within 2 bits
exactly if some point is within 1 bit of both, and no point has more than 65
fingerprints so near. So no group is paired with itself, however many documents or
near copies share a cell, and each step is linear in the number of fingerprints.

Defined results: a null text, and one without words, has fingerprint zero, which links
like any other. Equal texts share a fingerprint. A row without doc_id keeps its
fingerprint and takes its component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import Words, materialise, output, read, schema_of, text_chunks, with_text
from ledgerline.llm.components import components

SEED = 42
SHINGLE = 3
_NIBBLE = np.array([bin(i).count("1") for i in range(16)], np.uint64)


def fingerprints_of(raw: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """SimHash of each text: a bit is set if it is in over half the shingles' hashes."""
    words = Words(raw, offsets)
    n = words.per_text
    out = np.zeros(n.size, np.uint64)
    if not len(words):
        return out
    normal, start, end = words.normal()
    # Shingles of each text; a text with fewer words has one, the whole of it.
    each = np.where(n == 0, 0, np.maximum(n - width + 1, 1))
    head = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each) + np.repeat(words.first[:-1], each)
    tail = head + np.repeat(np.minimum(n, width), each) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(normal[a:b], SEED) for a, b in zip(start[head].tolist(), end[tail].tolist(), strict=True)], np.uint64)
    full = np.flatnonzero(each)
    begin = (np.cumsum(each) - each)[full]
    # A slice of shingles at a time, as a bit takes a byte here.
    bits = np.zeros((full.size, 64), np.int64)
    for a in range(0, hashes.size, step := 400_000):
        b = min(hashes.size, a + step)
        lo, hi = np.searchsorted(begin, a, side="right") - 1, np.searchsorted(begin, b, side="left")
        one = np.unpackbits(hashes[a:b].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        bits[lo:hi] += np.add.reduceat(one, np.maximum(begin[lo:hi], a) - a, axis=0, dtype=np.int64)
    over = (2 * bits > each[full][:, None]).astype(np.uint8)
    out[full] = np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()
    return out


def embedding_of(fingerprint: np.ndarray) -> np.ndarray:
    """The bit counts of the 16 segments, 4 bits for each."""
    out = np.zeros_like(fingerprint)
    for k in range(0, 64, 4):
        out |= _NIBBLE[((fingerprint >> np.uint64(k)) & np.uint64(15)).astype(np.int64)] << np.uint64(k)
    return out


def with_fingerprints(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, fp (64 bits as a bigint) and its embedding v."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, raw, offsets in text_chunks(batch):
                fp = fingerprints_of(raw, offsets)
                yield output(batch, keep, first, last, [fp.view(np.int64), embedding_of(fp).view(np.int64)], ["fp", "v"])

    return with_text(docs, keep).mapInArrow(make, schema_of(docs, keep) + "fp bigint, v bigint")


def _cells(v: Column) -> Column:
    """The grid points within 1 of v that are bit counts."""
    near = [v]
    for k in range(16):
        count = F.shiftright(v, 4 * k).bitwiseAND(F.lit(15))
        near += [F.when(count > 0, v - (1 << 4 * k)), F.when(count < 4, v + (1 << 4 * k))]
    return F.array_compact(F.array(*near))


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (fp, v) at 2 or fewer differing bits:
    a subset of these pairs that connects all that they connect."""
    cells = prints.select("fp", F.explode(_cells(F.col("v"))).alias("cell"))
    filled = materialise(
        cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("n > 1")
    )
    pairs = filled.filter("n = 2").filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2).select("a", "b")
    crowded = cells.join(filled.filter("n > 2").select("cell"), "cell", "left_semi").select("fp").distinct()
    bits = [1 << k if k < 63 else -(1 << 63) for k in range(64)]
    points = crowded.select("fp", F.explode(F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit(b)) for b in bits))).alias("point"))
    # At most 65 fingerprints are within a bit of a point.
    groups = points.groupBy("point").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.collect_list("fp").alias("all")).filter("n > 1")
    return pairs.union(groups.select("a", F.explode("all").alias("b")).filter("a <> b")).distinct()


def near_duplicates(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns (doc_id among them), fp, component (a fingerprint of it) and
    component_id, the smallest doc_id of the texts that links reach, of each row."""
    rows = materialise(with_fingerprints(docs, keep))
    prints = materialise(rows.groupBy("fp", "v").agg(F.min("doc_id").alias("least")))
    linked = components(links(prints))
    own = prints.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    least = own.groupBy("component").agg(F.min("least").alias("component_id"))
    return rows.drop("v").join(own.select("fp", "component").join(least, "component"), "fp")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies, with the columns of ``docs``: that with the
    smallest doc_id (a null counts as the largest; of several, the lowest text hash)."""
    row = docs.select(F.struct("*").alias("row"), F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"), "doc_id", "text", F.xxhash64("text").alias("tie"))
    rows = near_duplicates(row, ["doc_id", "id", "tie"])
    kept = rows.groupBy("component").agg(F.min(F.struct("id", "tie")).alias("best")).select("best.*")
    # dropDuplicates, as rows may repeat with their doc_id.
    return row.join(kept, ["id", "tie"], "left_semi").dropDuplicates(["id", "tie"]).select("row.*")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"), ["doc_id"])
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
