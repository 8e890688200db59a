"""Audit of how the sources of each language differ in their words.

Identical texts of a language are one text with a multiplicity per source, so
every text is tokenised once; its term counts and its document frequency are
added with those multiplicities.  Terms in enough documents of a language are
kept.  Each group (language, source) gives every kept term a smoothed share in
integer arithmetic.  Pairs of sources are compared on their occurring terms
only: terms that neither has count in closed form.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docspark.llm.common import BROADCAST_BYTES, lower_ascii, materialise, releasing, text_bytes

MIN_DOCS, SMOOTHING, SCALE, TOP = 30, 5, 1_000_000_000, 50
# Bytes that are part of a term: A-Z, a-z and those of non-ASCII characters; all others become blanks.
_TERM_BYTES = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
# Terms that a task holds before it passes their counts on; counts of one term may be passed on in parts.
HELD_TERMS = 300_000
# Kept terms of a bucket, sources of a block, and sources listed with one copy of a repeated text.
BUCKET_TERMS, BLOCK_SOURCES, LISTED = 1024, 128, 256
# Parts of a repeated text's rows where they are joined by shuffle.
SALTS = 16
COUNTS = "lang string, source string, term string, n bigint, docs bigint"


def _documents(df: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    """The three columns as strings, null as empty, and the SHA-256 of the text."""
    named = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    return named.withColumn("th", F.unhex(F.sha2("text", 256)))


def _with_repeats(docs: DataFrame, repeated: DataFrame, how: str) -> DataFrame:
    """``docs`` joined with the repeated texts; beyond the bound of a broadcast the rows of one text are dealt to SALTS parts."""
    if repeated.count() * 64 <= BROADCAST_BYTES:
        return docs.join(F.broadcast(repeated), ["lang", "th"], how)
    salted = docs.withColumn("salt", F.spark_partition_id() % SALTS)
    every = repeated.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(every, ["lang", "th", "salt"], how).drop("salt")


def collapse(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, text, mult) with each text of a language once, and the occurring groups (lang, source).

    ``mult`` lists (source, rows).  A text of very many sources comes once per
    LISTED sources, each with its own part of the list.
    """
    counts = materialise(docs.groupBy("lang", "source", "th").agg(F.count(F.lit(1)).alias("m")))
    groups = counts.select("lang", "source").distinct()
    per_text = counts.groupBy("lang", "th").agg(F.sum("m").alias("rows"), F.count(F.lit(1)).alias("sources"))
    repeated = materialise(per_text.where("rows > 1").select("lang", "th", F.ceil(F.col("sources") / LISTED).cast("int").alias("parts")))
    keys = repeated.select("lang", "th")
    once = F.array(F.struct("source", F.lit(1).cast("bigint").alias("m")))
    single = _with_repeats(docs, keys, "left_anti").select("lang", "text", once.alias("mult"))
    mult = counts.join(repeated, ["lang", "th"]).withColumn("part", F.pmod(F.xxhash64("source"), "parts")).groupBy("lang", "th", "part").agg(
        F.collect_list(F.struct("source", "m")).alias("mult"))
    # One text per hash: combined in each task before the shuffle.
    texts = _with_repeats(docs, keys, "left_semi").groupBy("lang", "th").agg(F.min("text").alias("text"))
    return single.unionByName(texts.join(mult, ["lang", "th"]).select("lang", "text", "mult")), groups


def term_counts(texts: DataFrame) -> DataFrame:
    """Partial (lang, source, term, n, docs) of (lang, text, mult): occurrences and documents, times the multiplicity."""

    @releasing
    def run(batches):
        held: dict = {}
        size = 0

        def out():
            rows = [(l, s, t, n, docs[t]) for (l, s), (count, docs) in held.items() for t, n in count.items()]
            for i in range(0, len(rows), 50_000):
                l, s, t, n, d = zip(*rows[i: i + 50_000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(l, pa.string()), pa.array(s, pa.string()), pa.array(t, pa.binary()).cast(pa.string()),
                     pa.array(n, pa.int64()), pa.array(d, pa.int64())], ["lang", "source", "term", "n", "docs"])

        for batch in batches:
            data, offs = text_bytes(batch.column(1))
            raw, offs = lower_ascii(data).tobytes().translate(_TERM_BYTES), offs.tolist()
            for i, (lang, mult) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                tokens = raw[offs[i]: offs[i + 1]].split()
                if not tokens:
                    continue
                whole = Counter(tokens) if len(mult) > 1 or mult[0]["m"] > 1 else None
                for x in mult:
                    count, docs = held.setdefault((lang, x["source"]), (Counter(), Counter()))
                    before = len(count)
                    if whole is None:
                        count.update(tokens)
                        docs.update(set(tokens))
                    else:
                        m = x["m"]
                        for t, n in whole.items():
                            count[t] += n * m
                            docs[t] += m
                    size += len(count) - before
                if size > HELD_TERMS:
                    yield from out()
                    held.clear()
                    size = 0
        yield from out()

    return texts.mapInArrow(run, COUNTS)


def share(count: Column, total: Column, terms: Column, smoothing: int = SMOOTHING, scale: int = SCALE) -> Column:
    """``1 + floor(scale * (count + smoothing) / (total + smoothing * terms))`` exactly; 0 without kept terms."""
    over = F.lit(scale).cast("decimal(10,0)") * (count + smoothing).cast("decimal(28,0)")
    under = (total + smoothing * terms).cast("decimal(28,0)")
    # ``div`` of decimals is exact and gives a bigint.
    return F.when(under > 0, F.call_function("div", over, under) + 1).otherwise(0)


def _pair_sums(rows: pd.DataFrame) -> pd.DataFrame:
    """Differences of all source pairs of one or two blocks over one bucket of terms.

    Rows without a term name the sources.  For terms of the bucket that neither
    source has, and in bucket 0 for all kept terms, the difference is that of
    the shares of an absent term.
    """
    heads = rows[rows["term"].isna()].drop_duplicates("source")
    body = rows[rows["term"].notna()]
    names, none, block = heads["source"].to_numpy(), heads["p"].to_numpy(np.int64), heads["block"].to_numpy()
    at = pd.Index(names).get_indexer(body["source"])
    term, seen = pd.factorize(body["term"])
    shares = np.repeat(none[:, None], len(seen), axis=1)
    shares[at, term] = body["p"].to_numpy(np.int64)
    first = rows.iloc[0]
    absent = (int(first["v"]) if first["bucket"] == 0 else 0) - len(seen)
    mine, others, values = [], [], []
    for i in range(len(names)):
        ok = np.flatnonzero((block != block[i]) if first["bi"] != first["bj"] else np.arange(len(names)) != i)
        mine.append(np.full(len(ok), i))
        others.append(ok)
        values.append(np.abs(shares[ok] - shares[i]).sum(axis=1) + absent * np.abs(none[ok] - none[i]))
    label = np.array(names, object)
    out = {"source": label[np.concatenate(mine)], "item": label[np.concatenate(others)], "value": np.concatenate(values).astype(np.int64)}
    return pd.DataFrame({c: pd.Series(x, dtype=object if c != "value" else np.int64) for c, x in out.items()}).assign(
        lang=pd.Series([first["lang"]] * len(out["value"]), dtype=object))[["lang", "source", "item", "value"]]


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for all ordered pairs of sources of a language."""
    buckets = F.greatest(F.lit(1), F.ceil(F.col("v") / BUCKET_TERMS)).cast("int")
    blocks = F.ceil(F.col("sources") / BLOCK_SOURCES).cast("int")
    sized = groups.withColumn("buckets", buckets).withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("source"), "blocks").cast("int"))
    heads = sized.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1))).select(
        "lang", "source", "block", "blocks", "bucket", "v", F.lit(None).cast("string").alias("term"), F.col("none").alias("p"))
    body = kept.join(sized, ["lang", "source"]).select(
        "lang", "source", "block", "blocks", F.pmod(F.xxhash64("term"), "buckets").cast("int").alias("bucket"), "v", "term", "p")
    # Every source meets every block; a pair of blocks is met once.
    dealt = heads.unionByName(body).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn(
        "bi", F.least("block", "other")).withColumn("bj", F.greatest("block", "other")).drop("other", "blocks")
    sums = dealt.groupBy("lang", "bi", "bj", "bucket").applyInPandas(_pair_sums, "lang string, source string, item string, value bigint")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(df: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of every occurring group (lang, source).

    Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased;
    a language keeps those in at least ``min_docs`` of its rows.  Part ``pair``
    ranks all other sources of the language by the summed difference of shares,
    0 without kept terms.  Part ``term`` ranks the ``top`` kept terms of the
    group whose share is above the language's.  Null counts as empty in all
    three columns; equal rows count each; ties are ranked by item; other columns
    are not read.  An empty table gives no rows.
    """
    docs = _documents(df, lang, source, text)
    texts, groups = collapse(docs)
    counts = term_counts(texts).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    one = Window.partitionBy("lang", "term")
    kept = materialise(
        counts.withColumn("all_docs", F.sum("docs").over(one)).withColumn("all_n", F.sum("n").over(one))
        .withColumn("lead", F.col("source") == F.min("source").over(one))
        .where(F.col("all_docs") >= min_docs).select("lang", "source", "term", "n", "all_n", "lead"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    whole = kept.groupBy("lang").agg(F.sum("n").alias("all_total"), F.count_if("lead").alias("v"))
    zero = F.lit(0).cast("bigint")
    sources = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    groups = materialise(
        groups.join(sources, "lang").join(totals, ["lang", "source"], "left").join(whole, "lang", "left")
        .withColumns({c: F.coalesce(c, zero) for c in ("total", "all_total", "v")})
        .withColumn("none", share(zero, F.col("total"), F.col("v"))))
    shared = kept.join(groups.select("lang", "source", "total", "all_total", "v"), ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("n"), F.col("total"), F.col("v")).alias("p"),
        share(F.col("all_n"), F.col("all_total"), F.col("v")).alias("q"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = shared.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    ranked = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    pairs = _pairs(shared.drop("q"), groups.select("lang", "source", "v", "sources", "none")).withColumn("rank", F.row_number().over(order))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(columns).unionByName(ranked.withColumn("part", F.lit("term")).select(columns))
