"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows are numbered 0..N-1 in the order (bucket, content hash, columns), a
permutation of 0..N-1 is applied to the number, and shard and slot are the
remainder and the quotient of the permuted number by the shard count.  Both can
be computed for any row number without looking at another row (``locate``).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docspark.llm.common import expand, free_names

ROUNDS = 6
# Rows are numbered bucket by bucket; the broadcast table has one row per bucket.
BUCKETS = 4096


def _round_keys(seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(1, 2**63, ROUNDS, dtype=np.uint64)


def permute(number: np.ndarray, total: int, seed: int) -> np.ndarray:
    """Feistel network over the smallest even-bit domain that holds ``total``; values beyond it walk on."""
    half = np.uint64(max(1, (max(total - 1, 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = _round_keys(seed)
    out = number.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for k in keys:
            f = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            f ^= f >> np.uint64(29)
            f *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f >> np.uint64(32)) & mask)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= np.uint64(total)]
    return out.astype(np.int64)


def locate(number: np.ndarray, total: int, shards: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of row numbers."""
    p = permute(number, total, seed)
    return p % shards, p // shards


def number_rows(df: DataFrame, number: str = "row_number", buckets: int = BUCKETS) -> DataFrame:
    """All rows with a global number 0..N-1 that depends on the rows' contents only.

    Identical rows are counted before the shuffle and multiplied out afterwards,
    so a row that makes up a third of the table is one row of a window.
    """
    cols = df.columns
    order = F.xxhash64(*[F.coalesce(F.hash(c), F.lit(0)) for c in cols], *cols)
    counted = (
        df.withColumn("__h", order).groupBy("__h", *cols).agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__bucket", F.pmod("__h", F.lit(buckets)))
    )
    per_bucket = counted.groupBy("__bucket").agg(F.sum("__n").alias("__m"))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        "__bucket",
        F.coalesce(F.sum("__m").over(before), F.lit(0)).alias("__offset"),
        F.sum("__m").over(Window.partitionBy()).alias("__total"),
    )
    inside = Window.partitionBy("__bucket").orderBy("__h", *cols).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("__start", F.coalesce(F.sum("__n").over(inside), F.lit(0))).join(
        F.broadcast(offsets), "__bucket"  # one row per bucket at most
    )
    rows = expand(placed, "__n", "__i")
    return rows.select(
        *cols, (F.col("__offset") + F.col("__start") + F.col("__i")).alias(number), F.col("__total").alias("total_rows")
    )


def shuffle_rows(df: DataFrame, shards: int, seed: int = 0, buckets: int = BUCKETS) -> DataFrame:
    """All columns of ``df`` (of sortable types) plus ``shard`` and gapless ``slot``; counts differ by one at most.

    Nulls are values like others; identical rows get slots of their own; an
    empty table stays empty; input columns named like an output keep their
    values as ``<name>_in``.
    """
    df = free_names(df, ["row_number", "total_rows", "shard", "slot"])

    @F.pandas_udf("shard int, slot long")
    def at(number: pd.Series, total: pd.Series) -> pd.DataFrame:
        shard, slot = locate(number.to_numpy(), int(total.iloc[0]), shards, seed)
        return pd.DataFrame({"shard": shard.astype(np.int32), "slot": slot})

    numbered = number_rows(df, buckets=buckets).withColumn("__at", at("row_number", "total_rows"))
    return numbered.select(*df.columns, "__at.shard", "__at.slot")
