"""Exact deduplication by an exchange of Golomb-coded fingerprints.

Each partition sorts the fingerprints of its texts, splits them by owner (the
leading bits) and sends every owner one Golomb-Rice coded message.  Owners
reply with a bitmap: which of the sent fingerprints occur more than once.  Only
the texts behind those suspects are shuffled and compared byte by byte.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.common import bounded_broadcast, expand, lower_ascii, materialise, releasing, text_bytes

FINGERPRINT_BITS = 48
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def golomb_encode(values: np.ndarray) -> tuple[int, bytes]:
    """Rice code of the gaps of sorted distinct values: (parameter, unary quotients then fixed remainders)."""
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    mean = max(1, int(gaps.mean())) if len(gaps) else 1
    k = max(0, int(np.log2(mean * 0.6931471805599453 + 1)))
    quotient = (gaps >> np.uint64(k)).astype(np.int64)
    unary = np.zeros(int(quotient.sum()) + len(gaps), np.uint8)  # ones, ended by a zero
    unary[:] = 1
    unary[np.cumsum(quotient + 1) - 1] = 0
    rest = (gaps[:, None] >> np.arange(k, dtype=np.uint64)) & np.uint64(1)
    return k, np.packbits(np.concatenate([unary, rest.astype(np.uint8).ravel()])).tobytes()


def golomb_decode(k: int, n: int, coded: bytes) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(coded, np.uint8))
    ends = np.flatnonzero(bits == 0)[:n]
    quotient = np.diff(ends, prepend=-1) - 1
    at = int(ends[-1]) + 1 if n else 0
    rest = bits[at: at + n * k].reshape(n, k).astype(np.uint64) << np.arange(k, dtype=np.uint64)
    gaps = (quotient.astype(np.uint64) << np.uint64(k)) + rest.sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


def _scan(df: DataFrame, key: str, text: str, owners: int, bits: int) -> DataFrame:
    """Per row (key, digest, fingerprint), and at the end of a partition its messages to the owners."""
    fields = ["__key", "__sha", "__fp", "__sender", "__owner", "__n", "__k", "__coded"]
    key_type = df.schema[key].dataType
    schema = df.select(
        F.col(key).cast(key_type).alias("__key"), F.lit("").alias("__sha"), F.lit(0).cast("long").alias("__fp"),
        *[F.lit(0).cast("int").alias(c) for c in fields[3:7]], F.lit(b"").alias("__coded"),
    ).schema
    for f in schema:
        f.nullable = True

    @releasing
    def run(batches):
        sender, seen = TaskContext.get().partitionId(), []
        key_arrow = None
        for batch in batches:
            data, offs = text_bytes(batch.column(1))
            view = memoryview(lower_ascii(data))
            digests = [hashlib.sha256(view[a:b]) for a, b in zip(offs.tolist(), offs[1:].tolist())]
            fp = np.array([int.from_bytes(d.digest()[:8], "big") >> (64 - bits) for d in digests], np.uint64)
            seen.append(fp)
            n, key_arrow = len(fp), batch.column(0).type
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([d.hexdigest() for d in digests], pa.string()), pa.array(fp.astype(np.int64)),
                 *[pa.nulls(n, pa.int32())] * 4, pa.nulls(n, pa.binary())], fields)
        if key_arrow is None:
            return
        fps, counts = np.unique(np.concatenate(seen), return_counts=True)
        owner = (fps * np.uint64(owners)) >> np.uint64(bits) if bits + owners.bit_length() < 64 else fps % np.uint64(owners)
        for o in np.unique(owner):
            mine = owner == o
            k, coded = golomb_encode(fps[mine])
            twice = np.packbits(counts[mine] > 1).tobytes()  # repeats inside the partition
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, key_arrow), pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()),
                 *[pa.array([int(x)], pa.int32()) for x in (sender, o, mine.sum(), k)],
                 pa.array([twice + coded], pa.binary())], fields)

    return df.select(F.col(key).alias("__key"), F.col(text).alias("__text")).mapInArrow(run, schema)


def _reply(messages: pd.DataFrame) -> pd.DataFrame:
    """One owner: bitmaps of the fingerprints that occur more than once in all messages together."""
    flags, values = [], []
    for n, k, blob in zip(messages["__n"], messages["__k"], messages["__coded"]):
        head = (n + 7) // 8
        flags.append(np.unpackbits(np.frombuffer(blob[:head], np.uint8))[:n])
        values.append(golomb_decode(k, n, blob[head:]))
    fps, inverse = np.unique(np.concatenate(values), return_inverse=True)
    total = np.bincount(inverse, weights=1 + np.concatenate(flags).astype(np.int64))
    twice = (total > 1)[inverse]
    cut = np.cumsum(messages["__n"].to_numpy())[:-1]
    return messages[["__sender", "__owner"]].assign(__twice=[np.packbits(x).tobytes() for x in np.split(twice, cut)])


def _suspects(batches):
    """Senders read their bitmaps: the fingerprints to look at."""
    for b in batches:
        out = []
        for n, k, blob, twice in zip(b["__n"], b["__k"], b["__coded"], b["__twice"]):
            mask = np.unpackbits(np.frombuffer(twice, np.uint8))[:n].astype(bool)
            out.append(golomb_decode(k, n, blob[(n + 7) // 8:])[mask])
        yield pd.DataFrame({"__fp": np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)})


def exact_groups(df: DataFrame, key: str = "doc_id", text: str = "text", owners: int = 0,
                 bits: int = FINGERPRINT_BITS) -> DataFrame:
    """Per row of ``df``: key, ``keep_key``, ``group_size``, ``kept``, ``text_sha256`` of the normalised text.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.
    The row with the largest key stays (nulls are smallest); of rows with the
    same key and text exactly one.  ``owners`` is the number of fingerprint
    ranges (default: the shuffle partitions): one owner holds the distinct
    fingerprints of its range.  An empty table gives an empty result.
    """
    owners = owners or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    scanned = materialise(_scan(df, key, text, owners, bits))
    rows = scanned.where("__sender IS NULL").select("__key", "__sha", "__fp")
    sent = scanned.where("__sender IS NOT NULL").select("__sender", "__owner", "__n", "__k", "__coded")
    replies = sent.groupBy("__owner").applyInPandas(_reply, "__sender int, __owner int, __twice binary")
    suspect_fp = sent.join(replies, ["__sender", "__owner"]).mapInPandas(_suspects, "__fp long").distinct()
    suspects = materialise(rows.join(suspect_fp, "__fp", "left_semi").select("__key", "__sha").distinct())
    some = bounded_broadcast(suspects, 128)
    norm = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    fetched = df.select(F.col(key).alias("__key"), F.col(text)).join(
        some.select(F.col("__key").alias("__k2")).distinct(), F.col("__key").eqNullSafe(F.col("__k2")), "left_semi"
    )
    # The bytes decide: groups are made of the texts themselves.
    groups = (
        fetched.withColumn("__text", norm).groupBy("__text")
        .agg(F.max("__key").alias("__keep"), F.count(F.lit(1)).alias("__size"))
        .select(F.sha2("__text", 256).alias("__sha"), "__keep", "__size").where("__size > 1")
    )
    counted = rows.groupBy("__key", "__sha").agg(F.count(F.lit(1)).alias("__m"))
    joined = counted.join(groups, "__sha", "left")
    single = F.col("__size").isNull()
    out = expand(joined, "__m", "__i")
    return out.select(
        F.col("__key").alias(key),
        F.when(single, F.col("__key")).otherwise(F.col("__keep")).alias("keep_key"),
        F.coalesce("__size", F.lit(1).cast("long")).alias("group_size"),
        (single | (F.col("__key").eqNullSafe(F.col("__keep")) & (F.col("__i") == 0))).alias("kept"),
        F.col("__sha").alias("text_sha256"),
    )


def drop_copies(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, all columns unchanged."""
    groups = materialise(exact_groups(df, key, text).where("group_size > 1"))
    per = materialise(groups.groupBy(F.col(key).alias("__k"), F.col("text_sha256").alias("__s")).agg(
        F.max("kept").alias("__any"), F.count(F.lit(1)).alias("__m")).where("NOT __any OR __m > 1"))
    sha = F.sha2(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), 256)
    marked = df.withColumn("__sha", sha).join(
        bounded_broadcast(per, 128), F.col(key).eqNullSafe(F.col("__k")) & (F.col("__sha") == F.col("__s")), "left"
    )
    rest = marked.where("__m IS NULL").select(*df.columns)
    # Rows with the same key and text, one of which stays.
    again = marked.where("__any").dropDuplicates([key, "__sha"]).select(*df.columns)
    return rest.unionByName(again)
