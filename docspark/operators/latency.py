"""Exact latency statistics: nearest-rank percentiles, truncated mean, spread.

``percentile_disc`` keeps every distinct value of a group in one task.  Here a
group is cut into value ranges instead: counts per range locate the range that
holds each rank, and only those ranges are cut further, down to single values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The report's levels and their order.
LEVELS = {"Min": 0.0, "P50": 0.50, "P75": 0.75, "P90": 0.90, "P95": 0.95, "P99": 0.99, "P99.9": 0.999, "Max": 1.0}
ROWS = ("Min", "Mean", "Stddev", "P50", "P75", "P90", "P95", "P99", "P99.9", "Max")

# Range widths of the search.  A 64-bit value has at most 2**21 ranges of the
# first width, a range holds at most 2**21 of the next, so no window is longer
# than that, whatever the values are.
WIDTHS = (1 << 42, 1 << 21, 1)


def split_outcome(runs: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Succeeded and failed runs."""
    failed = F.col(error).isNotNull()
    return runs.where(~failed), runs.where(failed)


def _rank(p: float, n: Column) -> Column:
    """Nearest rank, 1-based and clamped to the group."""
    return F.greatest(F.least(F.ceil(F.lit(p) * n.cast("double")), n), F.lit(1)).cast("bigint")


def _join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on group keys, NULL groups included.

    Null-safe equality also keeps the optimizer from adding a not-null filter to
    one branch only, so branches over the same counts share one shuffle.
    """
    other = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], *[F.col(f"`{c}`") for c in right.columns if c not in keys]
    )
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(other, same, how).drop(*[f"_r_{k}" for k in keys])


def value_counts(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Rows per distinct value and group: what all statistics are made from."""
    return df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(
        F.count(F.lit(1)).alias("_c")
    )


def nearest_rank(
    df: DataFrame, by: Sequence[str], value: str, widths: Sequence[int] = WIDTHS
) -> DataFrame:
    """Long form ``(by…, pct, value)`` of every percentile level."""
    return _ranks(value_counts(df, by, value), by, widths)


def _ranks(counts: DataFrame, by: Sequence[str], widths: Sequence[int]) -> DataFrame:
    """Locate each wanted rank in ever narrower value ranges, down to one value.

    A step keeps, per group, only the ranges that hold a wanted rank (at most
    one per level), with the group's size and the number of rows before the
    range.  Those are carried as plain numbers, so every step is a hash
    aggregate.
    """
    wanted = F.array(*[
        F.struct(F.lit(name).alias("pct"), _rank(p, F.col("_n")).alias("rank")) for name, p in LEVELS.items()
    ])

    def here(w: Column) -> Column:
        return (w["rank"] > F.col("_before")) & (w["rank"] <= F.col("_through"))

    inside = [*by, "_parent"]
    group = Window.partitionBy(*inside)
    upto = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = None
    for step, width in enumerate(widths):
        if found is None:
            kept, carried = counts.withColumn("_parent", F.lit(0).cast("bigint")), []
        else:
            parent = counts.withColumn("_parent", F.expr(f"_v div {widths[step - 1]}"))
            kept = _join_groups(parent, found, inside)
            carried = [F.max("_before").alias("_start"), F.max("_n").alias("_n")]
        sums = kept.groupBy(*inside, F.expr(f"_v div {width}").alias("_range")).agg(F.sum("_c").alias("_rc"), *carried)
        if found is None:
            sums = sums.withColumn("_n", F.sum("_rc").over(group)).withColumn("_start", F.lit(0).cast("bigint"))
        located = (
            sums.withColumn("_through", F.col("_start") + F.sum("_rc").over(upto))
            .withColumn("_before", F.col("_through") - F.col("_rc"))
            .where(F.exists(wanted, here))
        )
        found = located.select(*by, F.col("_range").alias("_parent"), "_before", "_n")
    # The last ranges are single values.
    return located.select(*by, F.explode(F.filter(wanted, here)).alias("_w"), F.col("_range").alias("value")).select(
        *by, F.col("_w.pct").alias("pct"), "value"
    )


def moments(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Integer-truncated mean and population deviation about it, in one pass.

    Sums are exact decimals, so the result does not depend on the order in
    which partitions are merged.
    """
    ones = df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("_v"), F.lit(1).alias("_c"))
    return _moments(ones, by)


def _moments(value_count: DataFrame, by: Sequence[str]) -> DataFrame:
    big = "decimal(38,0)"
    v, c = F.col("_v").cast(big), F.col("_c").cast(big)

    def times_count(x: Column) -> Column:
        return F.when(F.col("_c") == 1, x).otherwise((x * c).cast(big))

    sums = value_count.groupBy(*by).agg(
        F.sum("_c").alias("_n"),
        F.sum(times_count(v)).cast(big).alias("_s"),
        F.sum(times_count((v * v).cast(big))).cast(big).alias("_q"),
    )
    # sum (x-m)^2 = q - 2*m*s + n*m^2
    m = F.col("_m").cast(big)
    squares = F.col("_q") - (m * F.col("_s") * 2).cast(big) + (m * m).cast(big) * F.col("_n").cast(big)
    return (
        sums.withColumn("_m", F.expr("_s div _n"))
        .withColumn("_sd", F.floor(F.sqrt(squares.cast("double") / F.col("_n"))).cast("bigint"))
        .select(*by, F.col("_n").alias("n"), F.col("_m").alias("Mean"), F.col("_sd").alias("Stddev"))
    )


def latency_summary(df: DataFrame, by: Sequence[str], value: str, widths: Sequence[int] = WIDTHS) -> DataFrame:
    """One row per group with the ten report rows as columns."""
    counts = value_counts(df, by, value)
    pct = _ranks(counts, by, widths)
    wide = pct.groupBy(*by).agg(*[
        F.max(F.when(F.col("pct") == name, F.col("value"))).alias(name) for name in LEVELS
    ])
    return _join_groups(_moments(counts, by), wide, by).select(*by, "n", *[F.col(f"`{r}`") for r in ROWS])


def outcome_counts(df: DataFrame, by: Sequence[str], error: str, started: str, ended: str) -> DataFrame:
    """Succeeded, failed and wall time per group."""
    return df.groupBy(*by).agg(
        F.count_if(F.col(error).isNull()).alias("succeeded"),
        F.count_if(F.col(error).isNotNull()).alias("failed"),
        (F.max(ended) - F.min(started)).alias("wall_ns"),
    )


def run_report(df: DataFrame, by: Sequence[str], value: str, error: str, started: str, ended: str) -> DataFrame:
    """Outcome counts and statistics; a group without successes reports zeros."""
    ok, _ = split_outcome(df, error)
    stats = latency_summary(ok, by, value).drop("n")
    out = _join_groups(outcome_counts(df, by, error, started, ended), stats, by, "left")
    return out.fillna(0, subset=[f"`{r}`" if "." in r else r for r in ROWS])


def repeat_summary(df: DataFrame, level: str, repeat: str, value: str, widths: Sequence[int] = WIDTHS) -> DataFrame:
    """Statistic per (level, repeat), then mean and population deviation over repeats."""
    per_repeat = latency_summary(df, [level, repeat], value, widths)
    long = per_repeat.select(
        level,
        F.explode(
            F.array(*[F.struct(F.lit(r).alias("row"), F.col(f"`{r}`").cast("double").alias("x")) for r in ROWS])
        ).alias("_s"),
    ).select(level, "_s.row", "_s.x")
    return long.groupBy(level, "row").agg(
        F.avg("x").alias("mean"), F.stddev_pop("x").alias("stddev"), F.count(F.lit(1)).alias("repeats")
    )
