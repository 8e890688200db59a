"""Deletion of repeated line runs by prefix doubling over line ids.

The suffixes are the line sequences of the texts, as 64-bit line ids.  Round k
names every suffix by its first 2**k lines: the pair of the names at its place
and 2**(k-1) lines on.  Suffixes of one name are an interval of the suffix array
with that longest common prefix at least.  A suffix whose name is alone shares
no longer prefix with any other and leaves, so the rounds work on what still
repeats.  The rounds end at ``min_lines`` lines; longer common prefixes and
maximal repeats are not computed.  Every suffix but the first of its name starts
a later copy of that many lines.  What is cut are unions of such overlapping or
adjacent copies, whose parts may stand earlier in different places; the lines
are the same as those of all longer repeats.

Shorter runs count when they hold ``min_words`` words: every stretch of fewer
lines with so many words is named by the MD5 of its text, and later copies of a
name are cut as well.

All steps are DataFrame operations; lines are never shuffled as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docspark.llm.common import bounded_broadcast, free_names, materialise

MIN_LINES = 3
# Runs of fewer lines are cut too from this many words on.
MIN_WORDS = 50


# Bits of a filter for each name it holds, and bits at most (32 MB); a word of the filter has 64 bits, a row 2**9 words.
NAME_BITS, FILTER_BITS, WORDS = 16, 1 << 28, 1 << 9


def _may_be_in(rows: DataFrame, name: Column, names: DataFrame) -> DataFrame:
    """The rows whose 64-bit ``name`` may be among the written ``names``, by a broadcast bit table of bounded size.

    Names that stand alone are dropped where they are, but for about one in
    NAME_BITS, so that the exact join behind moves little else than what repeats.
    """
    n = names.count()
    bits = min(FILTER_BITS, max(64 * WORDS, 1 << (NAME_BITS * n).bit_length()))
    words = names.select(
        F.expr(f"cast(pmod(name, {bits}) div 64 as int)").alias("__w"), F.expr(f"shiftleft(1L, cast(pmod(name, {bits}) % 64 as int))").alias("__b"))
    words = words.groupBy("__w").agg(F.bit_or("__b").alias("__b"))
    table = words.groupBy(F.shiftright("__w", 9).alias("__r")).agg(
        F.map_from_entries(F.collect_list(F.struct((F.col("__w") % WORDS).alias("k"), F.col("__b").alias("v")))).alias("__m"))
    # Dense rows, so that a bit is found by its place.
    table = table.select("__r", F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda k: F.coalesce(F.try_element_at("__m", k), F.lit(0).cast("long"))).alias("__bits"))
    at = F.pmod(name, F.lit(bits))
    word = F.get("__bits", (F.shiftright(at, 6) % WORDS).cast("int"))
    hit = F.getbit(word, (at % 64).cast("int")) == 1
    return rows.join(F.broadcast(table), F.shiftright(at, 15).cast("int") == F.col("__r")).where(hit).drop("__r", "__bits")


def _repeating(named: DataFrame) -> DataFrame:
    """The rows whose name occurs more than once; counts are combined before the shuffle."""
    # Written first, so that the join is one of plain exchanges, in which the rows of a very common name can be split.
    twice = materialise(named.groupBy("name").agg(F.count(F.lit(1)).alias("__m")).where("__m > 1").select("name"))
    return materialise(_may_be_in(named, F.col("name"), twice).join(twice, "name"))


def _extend(named: DataFrame, step: int) -> DataFrame:
    """Names of prefixes ``step`` lines longer, where the suffix ``step`` lines on repeats too."""
    doc = Window.partitionBy("doc", "th").orderBy("pos").rangeBetween(step, step)
    return named.withColumn("next", F.max("name").over(doc)).where("next IS NOT NULL").select(
        "doc", "th", "pos", F.xxhash64("name", "next").alias("name"))


def _place() -> Column:
    """Order of all suffixes: key, then the text's hash (for repeated keys), then the line."""
    return F.struct(F.col("doc"), F.shiftleft(F.pmod("th", F.lit(1 << 31)), 32) + F.col("pos"))


def _words(line) -> Column:
    return F.regexp_count(line, F.lit(r"\S+"))


def _wordy_copies(df: DataFrame, key: str, text: str, min_lines: int, min_words: int) -> DataFrame:
    """(doc, th, pos, size): later copies of fewer than ``min_lines`` lines that hold ``min_words`` words."""
    def stretches(size: int) -> Column:
        starts = F.when(F.size("lines") >= size, F.sequence(F.lit(0), F.size("lines") - size)).otherwise(F.array().cast("array<int>"))
        held = F.filter(starts, lambda i: F.aggregate(F.slice("words", i + 1, size), F.lit(0), lambda a, w: a + w) >= min_words)
        return F.transform(held, lambda i: F.struct(
            i.alias("pos"), F.lit(size).alias("size"), F.unhex(F.md5(F.array_join(F.slice("lines", i + 1, size), "\n"))).alias("name")))

    split = df.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)).cast("long")).alias("doc"),
        F.xxhash64(text).alias("th"), F.split(text, "\n").alias("lines"),
    ).withColumn("words", F.transform("lines", _words))
    named = split.select("doc", "th", F.explode(F.concat(*[stretches(k) for k in range(1, min_lines)])).alias("s")).select("doc", "th", "s.*")
    # Rows of equal key and text have equal places, so that none of them is a later copy of the other.
    first = materialise(
        named.groupBy("name").agg(F.count(F.lit(1)).alias("m"), F.min(_place()).alias("first")).where("m > 1").drop("m"))
    short = named.withColumn("short", F.xxhash64("name"))
    kept = _may_be_in(short, F.col("short"), first.select(F.xxhash64("name").alias("name"))).drop("short")
    return kept.join(first, "name").where(_place() > F.col("first")).select("doc", "th", "pos", "size")


def later_runs(df: DataFrame, key: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES,
               min_words: int | None = MIN_WORDS) -> DataFrame:
    """(doc, th, start, end): unions of overlapping or adjacent later copies; ``th`` is the text's xxhash64.

    Earlier means a smaller key, or an earlier line of the same text.  Rows of
    equal key and text are one here.
    """
    lines = df.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)).cast("long")).alias("doc"),
        F.xxhash64(text).alias("th"),
        F.transform(F.split(text, "\n"), lambda x: F.xxhash64(x)).alias("ids"),
    ).where(F.size("ids") >= min_lines).dropDuplicates(["doc", "th"])
    named = _repeating(lines.select("doc", "th", F.posexplode("ids").alias("pos", "name")))
    length = 1
    while length < min_lines:
        step = min(length, min_lines - length)  # the last round overlaps
        named = _repeating(_extend(named, step))
        length += step
    first = materialise(named.groupBy("name").agg(F.min(_place()).alias("first")))
    later = named.join(first, "name").where(_place() > F.col("first")).select("doc", "th", "pos", F.lit(min_lines).alias("size"))
    if min_words is not None and min_lines > 1:
        later = later.unionByName(_wordy_copies(df, key, text, min_lines, min_words))
    doc = Window.partitionBy("doc", "th").orderBy("pos")
    reach = F.max(F.col("pos") + F.col("size")).over(doc.rowsBetween(Window.unboundedPreceding, -1))
    fresh = (F.col("pos") > reach) | reach.isNull()
    runs = later.withColumn("fresh", fresh.cast("int")).withColumn("run", F.sum("fresh").over(doc.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("doc", "th", "run").agg(F.min("pos").alias("start"), F.max(F.col("pos") + F.col("size")).alias("end")).drop("run")


def drop_repeated_lines(df: DataFrame, key: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES,
                        min_words: int | None = MIN_WORDS) -> DataFrame:
    """``df`` plus ``n_lines``, ``n_removed``, ``n_runs`` and ``kept_text`` (the lines that stay, joined).

    A run of at least ``min_lines`` lines, or of at least ``min_words`` words
    (None: no such rule; words are runs of non-blanks), that stands earlier (by
    integer key, then line) is deleted; the first copy stays.  A null text has no
    lines and stays null; an empty one is one empty line.  Of rows with equal key
    and text one is the first; the others, if they have ``min_lines`` lines or
    ``min_words`` words, are later copies whole.  Input columns named like an output keep their values as
    ``<name>_in``.
    """
    if min_lines < 1:
        raise ValueError("a run has at least one line")
    df = free_names(df, ["n_lines", "n_removed", "n_runs", "kept_text"])
    names = [F.col(f"`{c}`") for c in df.columns]
    keyed = df.withColumn("__d", F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)).cast("long"))).withColumn(
        "__t", F.xxhash64(text)).withColumn("__lines", F.split(text, "\n"))
    runs = materialise(
        later_runs(df, key, text, min_lines, min_words).groupBy("doc", "th").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("runs"))
    )
    enough = F.size("__lines") >= min_lines
    if min_words is not None:
        enough = enough | (_words(F.col(text)) >= min_words)
    long = F.col(text).isNotNull() & enough
    copies = materialise(keyed.where(long).groupBy("__d", "__t").agg(F.count(F.lit(1)).alias("m")).where("m > 1"))
    touched = bounded_broadcast(materialise(
        runs.select(F.col("doc").alias("d2"), F.col("th").alias("t2"))
        .unionByName(copies.select(F.col("__d").alias("d2"), F.col("__t").alias("t2"))).distinct()), 32)
    on = (F.col("__d") == F.col("d2")) & (F.col("__t") == F.col("t2")) & F.col(text).isNotNull()
    zero = F.lit(0).cast("long")
    n = F.when(F.col(text).isNull(), 0).otherwise(F.size("__lines")).cast("long")
    whole = keyed.join(touched, on, "left_anti").select(
        *names, n.alias("n_lines"), zero.alias("n_removed"), zero.alias("n_runs"), F.col(text).alias("kept_text"))
    some = keyed.join(touched, on, "left_semi").join(
        runs, (F.col("__d") == F.col("doc")) & (F.col("__t") == F.col("th")), "left").drop("doc", "th").withColumn(
        "runs", F.coalesce("runs", F.array().cast("array<struct<start:int,end:int>>")))
    # Repeated rows: the first of each key and text is treated as the runs say, the others go whole.
    again = some.join(copies.withColumnRenamed("__d", "d3").withColumnRenamed("__t", "t3"), (F.col("__d") == F.col("d3")) & (F.col("__t") == F.col("t3")), "left")
    single = again.where("m IS NULL")
    ties = again.where("m IS NOT NULL").withColumn(
        "copy", F.row_number().over(Window.partitionBy("__d", "__t").orderBy(F.lit(0)))
    ).withColumn("runs", F.when(F.col("copy") == 1, F.col("runs")).otherwise(
        F.array(F.struct(F.lit(0).alias("start"), F.size("__lines").alias("end"))))).drop("copy")
    cut = single.unionByName(ties)
    # The stretches between the runs, so that the work is linear in the lines.
    gaps = F.arrays_zip(
        F.concat(F.array(F.lit(0)), F.col("runs.end")).alias("a"), F.concat(F.col("runs.start"), F.array(F.size("__lines"))).alias("b"))
    kept = F.flatten(F.transform(gaps, lambda g: F.slice("__lines", g["a"] + 1, g["b"] - g["a"])))
    gone = F.aggregate("runs", zero, lambda s, r: s + (r["end"] - r["start"]))
    return whole.unionByName(cut.select(
        *names, n.alias("n_lines"), gone.alias("n_removed"), F.size("runs").cast("long").alias("n_runs"), F.array_join(kept, "\n").alias("kept_text")))
