"""Shared helpers: shared scratch tables, Arrow text buffers, free column names, bounded broadcasts."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only after its rows were counted and their bytes fit below this.
BROADCAST_BYTES = 32 << 20
# Array elements of one row when a counted row is multiplied out.
EXPAND_BLOCK = 4096


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches that carry whole texts to Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_base(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a temporary one only in local mode without it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="docspark-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_base(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_broadcast(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` (already written) with a broadcast hint if its counted size allows it, else as it is."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def free_names(df: DataFrame, names: list[str]) -> DataFrame:
    """Input columns whose names an operator needs keep their values as ``<name>_in`` (more ``_in`` until free)."""
    taken = {c.lower() for c in df.columns} | {n.lower() for n in names}
    for c in df.columns:
        if c.lower() in {n.lower() for n in names}:
            to = c
            while to.lower() in taken:
                to += "_in"
            taken.add(to.lower())
            df = df.withColumnRenamed(c, to)
    return df


def expand(df: DataFrame, count: str, index: str) -> DataFrame:
    """Each row ``count`` times with ``index`` 0, 1, ...; a row with a huge count is split over tasks."""
    blocks = df.withColumn("__b", F.explode(F.sequence(F.lit(0), F.floor((F.col(count) - 1) / EXPAND_BLOCK).cast("long"))))
    dealt = blocks.where("__b = 0").unionByName(blocks.where("__b > 0").repartition(F.xxhash64(F.struct(*blocks.columns))))
    lo = F.col("__b") * EXPAND_BLOCK
    hi = F.least(F.col(count), lo + EXPAND_BLOCK) - 1
    return dealt.withColumn(index, F.explode(F.sequence(lo, hi))).drop("__b", count)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a batch (null: empty) and the ``n + 1`` offsets of the rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, count=n + 1, offset=column.offset * 8).copy()
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    data = data[offsets[0]: offsets[-1]]
    return data, offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """Lower-case the bytes A to Z; bytes of longer UTF-8 characters are not in that range."""
    out = data.copy()
    upper = (out >= 65) & (out <= 90)
    out[upper] += 32
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit hashes over all bits (multiply and fold rounds)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Rolling:
    """Prefix polynomial hashes modulo 2**64 over a byte array; any substring's hash in O(1).

    The sums of ``byte * base**i`` are multiplied by the inverse power of the
    start, so equal substrings have equal hashes wherever they stand.
    """

    BASE = 0x5851F42D4C957F2D | 1
    _powers = np.ones(1, np.uint64)
    _inverse = np.ones(1, np.uint64)

    @classmethod
    def _grow(cls, n: int) -> None:
        if len(cls._powers) < n:
            size = 1 << max(16, (n - 1).bit_length())
            for name, base in (("_powers", cls.BASE), ("_inverse", pow(cls.BASE, -1, 1 << 64))):
                p = np.full(size, base, np.uint64)
                p[0] = 1
                setattr(cls, name, np.multiply.accumulate(p))

    def __init__(self, data: np.ndarray):
        n = len(data)
        self._grow(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._powers[:n], out=self.sums[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self._inverse[start]


def word_spans(low: np.ndarray, offs: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end bytes of the runs of ``inside`` bytes, cut at text boundaries, and each text's first run (n + 1)."""
    n = len(low)
    edge = np.zeros(n + 1, bool)
    if n:
        edge[1:-1] = inside[1:] != inside[:-1]
        edge[0], edge[-1] = inside[0], inside[-1]
    at = np.flatnonzero(edge)
    starts, ends = at[0::2], at[1::2]
    cut = offs[1:-1][(offs[1:-1] > 0) & (offs[1:-1] < n)]
    joined = np.unique(cut[inside[cut - 1] & inside[cut]]) if len(cut) else cut
    if len(joined):
        starts, ends = np.sort(np.concatenate([starts, joined])), np.sort(np.concatenate([ends, joined]))
    return starts, ends, np.searchsorted(starts, offs)


# Bytes of words that are hashed at once.
HASHED = 1 << 20


def word_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of each word, whatever its place; memory is bounded by HASHED or one word."""
    sizes = ends - starts
    out = np.zeros(len(starts), np.uint64)
    if not len(starts):
        return out
    Rolling._grow(int(sizes.max()))
    total = np.cumsum(sizes)
    a = 0
    while a < len(starts):
        done = int(total[a - 1]) if a else 0
        b = max(a + 1, int(np.searchsorted(total, done + HASHED, "right")))
        n = sizes[a:b]
        begin = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(begin, n)
        values = (low[np.repeat(starts[a:b], n) + place].astype(np.uint64) + np.uint64(1)) * Rolling._powers[place]
        out[a:b] = np.add.reduceat(values, begin)
        a = b
    return mix(out ^ sizes.astype(np.uint64))


def releasing(run):
    """A batch function that gives the memory it no longer needs back to the system when its partition ends.

    Python workers live on between stages; what their allocators keep would add up.
    """

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(_libc(), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return wrapped


_resident: dict = {}


def resident(group: str, key, build):
    """A model that a Python worker keeps between tasks; models of another group go first.

    Workers serve one operator after the other, so the models of all would add up.
    """
    if _resident.get("group") != group:
        _resident.clear()
        _resident["group"] = group
    if key not in _resident:
        _resident[key] = build()
    return _resident[key]


@lru_cache(maxsize=1)
def _libc():
    try:
        return ctypes.CDLL(None)
    except (OSError, TypeError):
        return None
