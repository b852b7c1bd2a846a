"""Embedding rows as whole-number vectors, shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Steps of a component for one unit.
STEPS = 256
#: Larger entries (after scaling) are refused: their products would not be exact.
LARGEST = 2**40


def sound_rows(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows have a vector without null or non-finite entries; their entries in a
    row, as doubles; and how many each has."""
    vectors = batch.column(column)
    sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().cast(pa.float64())
    bad = ~np.isfinite(pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False))
    ends = np.cumsum(sizes)
    faults = np.concatenate(([0], np.cumsum(bad)))
    sound = vectors.is_valid().to_numpy(zero_copy_only=False) & (faults[ends] == faults[ends - sizes])
    kept = np.repeat(sound, sizes)
    return np.flatnonzero(sound), pc.fill_null(flat, 0.0).to_numpy(zero_copy_only=False)[kept], sizes[sound]


def whole(entries: np.ndarray) -> np.ndarray:
    """floor(256 * c) of each entry as a 64-bit integer."""
    scaled = np.floor(STEPS * entries)
    if scaled.size and np.abs(scaled).max() > LARGEST:
        raise ValueError(f"embedding entries beyond {LARGEST // STEPS} are not supported")
    return scaled.astype(np.int64)


def padded(entries: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """A row for each vector; entries that a shorter one lacks are 0."""
    if width and (sizes == width).all():
        return entries.reshape(-1, width)
    out = np.zeros((sizes.size, width), entries.dtype)
    begin = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(sizes.size), sizes)
    out[row, np.arange(entries.size) - begin[row]] = entries
    return out


def pack(rows: np.ndarray) -> bytes:
    """Whole numbers in as few bytes as they allow, the first byte saying which."""
    top = int(np.abs(rows).max()) if rows.size else 0
    kind = next(k for k in ("<i2", "<i4", "<i8") if top < 2 ** (8 * int(k[2]) - 1))
    return kind[2].encode() + rows.astype(kind).tobytes()


def unpack(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"<i{chr(blob[0])}", offset=1).astype(np.int64)
