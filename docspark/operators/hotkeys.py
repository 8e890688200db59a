"""Ordered window work that survives hot keys.

A plain ``Window.partitionBy(key)`` puts a whole key into one task.  So the
largest keys are looked up first, in one aggregate over key and ordering column.
Keys are hot when they have more than ``MIN_HOT_ROWS`` rows and are among the
``MAX_HOT_KEYS`` largest; any other key has at most ``MIN_HOT_ROWS`` rows or a
share of at most ``1/MAX_HOT_KEYS`` of the table.

Without hot keys the plan is the plain window.  Otherwise hot keys are cut into
blocks at quantiles of their (integer) ordering column, the window runs per (key, block),
and per-block totals are carried from block to block.  The hot-key table has at
most ``MAX_HOT_KEYS`` rows and the carry table at most ``MAX_BLOCKS +
MAX_HOT_KEYS``, whatever the data size: that is what makes the broadcasts safe.

The cuts are turned into constants, so every later
evaluation (a retried task, a lost executor) cuts in the same places.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_HOT_KEYS = 4096
MAX_BLOCKS = 100_000
MIN_HOT_ROWS = 1_000_000
# Blocks of one hot key at most.
MAX_CUTS = 256


def hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    max_keys: int = MAX_HOT_KEYS,
    min_rows: int = MIN_HOT_ROWS,
    max_blocks: int = MAX_BLOCKS,
) -> DataFrame | None:
    """Hot keys with the values of their ordering column at which blocks begin; None when there are none.

    The cuts are quantiles, so blocks have about equal row counts however the
    values cluster; rows of one value stay together.
    """
    stats = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    largest = stats.where(F.col("_n") > min_rows).orderBy(F.col("_n").desc()).limit(max_keys)
    rows = largest.collect()
    if not rows:
        return None
    per_block = max(min_rows, -(-sum(r["_n"] for r in rows) // max_blocks), 1)
    most = min(MAX_CUTS, max(-(-r["_n"] // per_block) for r in rows))
    schema = T.StructType([*[stats.schema[k] for k in keys], T.StructField("_n", T.LongType())])
    named = df.sparkSession.createDataFrame([tuple(r) for r in rows], schema)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    shares = F.array(*[F.lit(i / most) for i in range(1, most)]) if most > 1 else None
    values = df.select(*keys, F.col(order).cast("bigint").alias("_v")).alias("a").join(F.broadcast(named).alias("b"), same).select(
        *[F.col(f"a.{k}") for k in keys], "_v")
    cut = F.percentile_approx("_v", shares, 100 * most) if most > 1 else F.array().cast("array<bigint>")
    cuts = values.groupBy(*keys).agg(F.array_distinct(cut).alias("_cuts")).collect()
    fields = [stats.schema[k] for k in keys]
    schema = T.StructType([*fields, T.StructField("_cuts", T.ArrayType(T.LongType()))])
    return df.sparkSession.createDataFrame([(*[r[k] for k in keys], r["_cuts"]) for r in cuts], schema)


def _blocked(df: DataFrame, keys: Sequence[str], order: str, hot: DataFrame) -> DataFrame:
    """Add ``_block`` (0 unless the key is hot) and ``_hot``."""
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"d.{k}").eqNullSafe(F.col(f"h.{k}"))
    cuts = F.coalesce(F.col("h._cuts"), F.array().cast("array<bigint>"))
    return df.alias("d").join(F.broadcast(hot).alias("h"), same, "left").select(
        *[F.col(f"d.`{c}`") for c in df.columns],
        F.col("h._cuts").isNotNull().alias("_hot"),
        F.size(F.filter(cuts, lambda c: c <= F.col(f"d.`{order}`"))).cast("bigint").alias("_block"),
    )


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join with a broadcast table on keys of which NULL is one value."""
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    rest = [c for c in right.columns if c not in keys]
    return left.alias("l").join(F.broadcast(right).alias("r"), same, "left").select(
        *[F.col(f"l.`{c}`") for c in left.columns], *[F.col(f"r.`{c}`") for c in rest])


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    totals: dict[str, Column],
    ties: Sequence[str] = (),
    **limits: int,
) -> DataFrame:
    """Inclusive running sums of ``totals`` within ``keys``, ordered by ``order, ties``."""
    kept = [F.col(f"`{c}`") for c in df.columns]
    hot = hot_keys(df, keys, order, **limits)
    upto = (Window.unboundedPreceding, Window.currentRow)
    if hot is None:
        inside = Window.partitionBy(*keys).orderBy(order, *ties).rowsBetween(*upto)
        return df.select(*kept, *[F.sum(e.cast("bigint")).over(inside).alias(n) for n, e in totals.items()])

    d = _blocked(df, keys, order, hot)
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        d.where("_hot")
        .groupBy(*keys, "_block")
        .agg(*[F.sum(e.cast("bigint")).alias(f"_s_{n}") for n, e in totals.items()])
        .select(*keys, "_block", *[F.sum(f"_s_{n}").over(before).alias(f"_c_{n}") for n in totals])
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(order, *ties).rowsBetween(*upto)
    d = _null_safe(d, carry, [*keys, "_block"])
    sums = [
        (F.sum(e.cast("bigint")).over(inside) + F.coalesce(F.col(f"_c_{n}"), F.lit(0))).alias(n)
        for n, e in totals.items()
    ]
    return d.select(*kept, *sums)


def numbered(
    df: DataFrame, keys: Sequence[str], order: str, name: str, ties: Sequence[str] = (), **limits: int
) -> DataFrame:
    """1-based position of each row within its key."""
    return running_totals(df, keys, order, {name: F.lit(1)}, ties, **limits)


def previous_row(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    columns: dict[str, str],
    ties: Sequence[str] = (),
    **limits: int,
) -> DataFrame:
    """Values of the preceding row within the key (NULL on the first row)."""
    kept = [F.col(f"`{c}`") for c in df.columns]
    hot = hot_keys(df, keys, order, **limits)
    if hot is None:
        inside = Window.partitionBy(*keys).orderBy(order, *ties)
        return df.select(*kept, *[F.lag(src).over(inside).alias(out) for out, src in columns.items()])

    d = _blocked(df, keys, order, hot)
    last = F.struct(*[F.col(src).alias(out) for out, src in columns.items()])
    rank = F.struct(F.col(order), *[F.col(t) for t in ties])
    carry = (
        d.where("_hot")
        .groupBy(*keys, "_block")
        .agg(F.max_by(last, rank).alias("_last"))
        .select(
            *keys,
            "_block",
            F.lag("_last").over(Window.partitionBy(*keys).orderBy("_block")).alias("_carry"),
        )
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(order, *ties)
    d = _null_safe(d, carry, [*keys, "_block"])
    first = F.row_number().over(inside) == 1
    outs = [
        F.when(first, F.col(f"_carry.{out}")).otherwise(F.lag(src).over(inside)).alias(out)
        for out, src in columns.items()
    ]
    return d.select(*kept, *outs)


def paired_order(df: DataFrame, major: Column, minor: Column, name: str) -> DataFrame:
    """One integer that never falls where ``(major, minor)`` rises, evenly spread.

    Needed where the leading column alone has too few values to be cut into
    blocks (a day, say).  Both are integers.  The leading bits of ``minor`` that
    64 bits have room for are taken; rows that are equal in them are ordered by
    the caller's ``ties``.
    """
    major, minor = major.cast("bigint"), minor.cast("bigint")
    r = df.agg(F.min(major).alias("a"), F.max(major).alias("b"), F.min(minor).alias("c"), F.max(minor).alias("d")).first()
    if r["a"] is None or r["c"] is None:
        return df.withColumn(name, F.coalesce(major, F.lit(0)))
    bits = (r["d"] - r["c"]).bit_length()
    drop = max(0, (r["b"] - r["a"]).bit_length() + bits - 62)
    # Decimals hold the differences of any two longs.
    high = (major.cast("decimal(20,0)") - F.lit(r["a"]).cast("decimal(20,0)")).cast("decimal(21,0)")
    low = F.floor((minor.cast("decimal(20,0)") - F.lit(r["c"]).cast("decimal(20,0)")) / F.lit(float(1 << drop))) if drop else (
        minor - F.lit(r["c"]))
    wide = max(0, bits - drop)
    return df.withColumn(name, (high.cast("bigint") * F.lit(1 << wide) + low.cast("bigint")).cast("bigint"))
