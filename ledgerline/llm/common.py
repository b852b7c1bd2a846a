"""What the operators share: tables, checkpoints and vectorised text handling.

Texts are handled as the UTF-8 buffers of Arrow columns, a few megabytes at a
time, so a task's memory does not depend on how many rows or how long a text it
gets, apart from the longest single text.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that are turned into numpy arrays at once.
CHUNK_BYTES = 400_000

#: Bytes of a word that are hashed one by one, for all words at once.
HEAD = 24

#: Space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: White space and ASCII punctuation, for words without either.
BREAKS = WHITE.copy()
BREAKS[[b for b in range(33, 127) if not chr(b).isalnum()]] = True

#: Lower-cases the bytes A-Z and leaves the others.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


#: Spark's defaults for an Arrow batch, and what is set in their place: texts are long, and
#: a batch is held by the JVM and by the Python worker at once. Other settings stay.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8000000b")}


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Some columns of a parquet table of ``sf_dir``."""
    for key, (default, own) in BATCHES.items():
        if spark.conf.get(key, None) == default:
            spark.conf.set(key, own)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only a local session may do without that setting; it gets a new temporary
    folder. A cluster without it raises, as a machine-local folder would lose data.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="ledgerline-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def materialise(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder once and read from there afterwards."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: smaller than a checkpoint."""
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, what: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def first_by_hash(df: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows, the same at every run: those whose key hashes lowest."""
    return df.orderBy(F.xxhash64(F.lit(17), key), key).limit(most)


#: Up to so many ids are broadcast; beyond that they are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def join_ids(df: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """``df`` joined by doc_id with ``ids`` (distinct ones), of which there may be any number."""
    ids = materialise(ids)
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", how)


def with_text(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and the text, which a struct named ``row`` among them has inside."""
    return docs.select(*keep) if {"row", "text"} & {*keep} else docs.select(*keep, "text")


def text_chunks(batch: pa.RecordBatch, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with about ``most`` bytes of text: first row, row after the last,
    their bytes and the offsets of each text in these. A null is an empty text."""
    texts = batch.column("text") if "text" in batch.schema.names else pc.struct_field(batch.column("row"), "text")
    if texts.null_count:
        texts = texts.fill_null("")
    if texts.type != pa.string():
        texts = texts.cast(pa.string())
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, side="right")) - 1)
        last = min(last, n)
        yield first, last, raw[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last
    give_back()


def give_back() -> None:
    """Returns the memory that a batch has freed to the system, so that a worker that
    waits for its next task, or works beside others, holds no more than it needs."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of some texts.

    Other bytes that separate words can be given as ``breaks``.
    ``start`` and ``end`` are byte positions, ``per_text`` says how many words each
    text has, ``first`` is the index of each text's first word (one more at the end).
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = WHITE):
        self.raw = raw
        inside = np.take(~breaks, raw)
        begins, ends = inside.copy(), inside.copy()
        if raw.size:
            begins[1:] &= ~inside[:-1]
            ends[:-1] &= ~inside[1:]
            cuts = offsets[(offsets > 0) & (offsets < raw.size)]
            begins[cuts] = inside[cuts]
            ends[cuts - 1] = inside[cuts - 1]
        self.inside = inside
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.per_text = np.diff(self.first)

    def __len__(self) -> int:
        return self.start.size

    def hashes(self, table: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each word; ``table`` maps bytes first."""
        if not len(self):
            return np.zeros(0, np.uint64)
        number = _BYTES if table is None else _BYTES[table]
        length = self.end - self.start
        powers = _powers(max(int(length.max()), HEAD))
        # Byte by byte of all words that are long enough, the longest first; then the rest of very long ones.
        capped = np.minimum(length, HEAD + 1).astype(np.int16)
        order = np.argsort(-capped, kind="stable")
        start, longer = self.start[order], len(self) - np.cumsum(np.bincount(capped, minlength=HEAD + 2))
        sums = np.zeros(len(self), np.uint64)
        for j in range(HEAD):
            k = int(longer[j])
            sums[:k] += np.take(number, np.take(self.raw, start[:k] + j)) * powers[j]
        if k := int(longer[HEAD]):
            begin, count = start[:k] + HEAD, length[order[:k]] - HEAD
            first = np.cumsum(count) - count
            rest = number[self.raw[ranges(begin, count)]]
            rest *= powers[HEAD + ranges(np.zeros(k, np.int64), count)]
            sums[:k] += np.add.reduceat(rest, first)
        value = np.empty_like(sums)
        value[order] = sums
        return mix(value + length.astype(np.uint64))

    def normal(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Lower-cased words, each followed by one space; where each starts and ends."""
        length = self.end - self.start
        start = np.cumsum(length + 1) - (length + 1)
        out = np.full(int(length.sum()) + len(self), 0x20, np.uint8)
        inner = np.arange(int(length.sum())) + np.repeat(np.arange(len(self)), length)
        out[inner] = LOWER[self.raw[self.inside]]
        return out.tobytes(), start, start + length


_BYTES = np.random.default_rng(20_061).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if _POWERS.size < n:
        base = np.full(max(n, 64), 0x9E3779B97F4A7C15, np.uint64)
        base[0] = 1
        _POWERS = np.multiply.accumulate(base)
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all of them."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` hashes, in order of its first one."""
    n = hashes.size - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + n]
    return mix(total)


def per_text(flags: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` between each two neighbours of ``cuts``."""
    return np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[cuts])


def output(batch: pa.RecordBatch, keep: list[str], first: int, last: int, made: list, names: list[str]) -> pa.RecordBatch:
    """``keep`` columns of some rows of a batch, then new columns."""
    made = [x if isinstance(x, pa.Array) else pa.array(x) for x in made]
    return pa.RecordBatch.from_arrays([*(batch.column(c).slice(first, last - first) for c in keep), *made], [*keep, *names])


def schema_of(df: DataFrame, keep: list[str]) -> str:
    """``keep`` columns as the head of a schema string."""
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.select(*keep).schema)


def pack_columns(*columns: np.ndarray) -> bytes:
    """Whole numbers, column by column and byte by byte of them, compressed."""
    planes = b"".join(np.ascontiguousarray(c.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns)
    return len(columns[0]).to_bytes(4, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpack_columns(blob: bytes, columns: int) -> list[np.ndarray]:
    n = int.from_bytes(blob[:4], "little")
    planes = np.frombuffer(pa.decompress(blob[4:], n * 8 * columns, "zstd"), np.uint8).reshape(columns, 8, n)
    return [np.ascontiguousarray(p.T).view("<i8").ravel().astype(np.int64) for p in planes]


class HashArray:
    """Sorted 64-bit keys with a row number each; found by their top bits.

    ``find`` gives the row of each key, or -1.
    """

    def __init__(self, keys: np.ndarray):
        self.order = np.argsort(keys, kind="stable").astype(np.int32)
        self.keys = keys[self.order]
        # A table of where each range of keys begins, with about two keys a range.
        self.bits = max(1, min(21, int(np.ceil(np.log2(max(2, keys.size)))) - 1))
        self.begin = np.searchsorted(self.keys >> np.uint64(64 - self.bits), np.arange(2**self.bits + 1, dtype=np.uint64)).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        found = np.full(keys.size, -1, np.int64)
        if not self.keys.size or not keys.size:
            return found
        bucket = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        at, stop = self.begin[bucket], self.begin[bucket + 1]
        todo = np.flatnonzero(at < stop)
        at, stop, want = at[todo], stop[todo], keys[todo]
        while todo.size:
            hit = self.keys[at] == want
            found[todo[hit]] = self.order[at[hit]]
            at = at + 1
            more = ~hit & (at < stop)
            todo, at, stop, want = todo[more], at[more], stop[more], want[more]
        return found


def ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[0], begin[0]+1, ... (count[0] numbers), begin[1], ... in one array."""
    total = int(count.sum())
    return np.arange(total) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin, count)
