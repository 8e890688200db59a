"""Toxicity scores: gradient-boosted trees over dense text features, calibrated by isotonic regression.

A lexicon is learned from the labelled texts: words and word beginnings that
stand in more toxic texts than chance allows, with their log odds.  Each text
becomes a short dense vector (lexicon densities, nearness of lexicon words to
the second person, capitals, punctuation, obfuscation).  Trees are boosted on
four fifths of the labelled sample and calibrated on the rest.  A labelled text
is never described by a lexicon that saw it.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.common import free_names, materialise, releasing, text_bytes

# The classifier's sample: distinct labelled texts of least content hash, per label.
SAMPLE = 20_000
# Entries of the lexicon, the strongest first.
LEXICON = 20_000
# A term is toxic if it stands in so many toxic texts, with such log odds and such a z-score of them.
MIN_TEXTS, MIN_ODDS, MIN_Z = 3, 1.0, 2.5
# Beginnings of longer words that are terms of their own.
STEMS = (5, 7)
FOLDS = 5
CALIBRATION = 0  # this fold calibrates, the others are boosted on
TREES, DEPTH, STEP = 30, 3, 0.2

# Words are runs of ASCII letters and non-ASCII characters, lower-cased.
_LETTERS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
# Tokens (runs of non-blanks) with signs or digits inside a word, or hanging on it.
OBFUSCATED = re.compile(r"[^\W\d_][*#$@!&%0-9._-]+[^\W\d_]|[^\W\d_][*#$@&%]{2,}|[^\W\d_][!?]{2,}")
DRAWN = re.compile(r"([^\W\d_])\1\1")
SHOUTED = re.compile(r"[!?]{2,}")
# Single letters in a row that may be a word spelled out.
SPELLED = 4
# Look-alike signs for letters.
SIGNS = str.maketrans("013457@$!", "oieastasi")
# Second-person pronouns of English, German, French and Spanish.
YOU = frozenset(
    "you your yours yourself yourselves u ur du dich dir dein deine deinen deiner ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti tuyo tuya usted ustedes vosotros vuestro".split())
# Tokens on either side within which a second-person pronoun is near.
NEAR = 5
# Tokens that a task remembers, and terms whose counts it holds before it passes them on.
REMEMBERED, HELD_TERMS = 200_000, 300_000

FEATURES = (
    "log_words", "hit_density", "log_hits", "weight_density", "log_weight", "top_weight", "log_kinds", "stem_density", "log_stems",
    "you_density", "near_share", "near_density", "hidden_density", "log_hidden", "capital_share", "shouted_words", "punctuation_share",
    "shouts", "obfuscated_words", "spaced_runs", "drawn_runs", "digit_share",
)


Lexicon = dict[str, float]


def words_of(text: str) -> list[str]:
    return text.lower().encode("utf-8", "replace").translate(_LETTERS).decode("utf-8").split()


def terms(words: set[str]) -> set[str]:
    """The words and, marked by a star, the beginnings of longer ones."""
    out = set(words)
    for k in STEMS:
        out.update([w[:k] + "*" for w in words if len(w) > k])
    return out


# What a token adds to its text.
_ADDS = WORDS, HITS, WEIGHT, STEM, YOURS, LOUD, MASKED, HIDDEN, STRETCHED, SHOUTS, TOPMOST, SINGLE = range(12)


class Tokens(dict):
    """Numbers of tokens, given at first sight, and in ``table`` what each adds: every different token is looked at once.

    Number 0 is any plain word that the lexicon does not know: it adds itself only.
    """

    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.lexicon, self.rows, self.done = lexicon, [], np.eye(1, len(_ADDS), WORDS, np.float32)
        self.known = frozenset(lexicon) | YOU
        self.short, self.long = (frozenset(t[:-1] for t in lexicon if t.endswith("*") and len(t) == k + 1) for k in STEMS)

    def __missing__(self, token: str) -> int:
        core = token.rstrip(".,;:")
        n = 0
        if not (len(core) > 1 and core.isalpha() and not core.isupper() and self._unknown(core.lower()) and DRAWN.search(core) is None):
            n = len(self.done) + len(self.rows)
            self.rows.append(self._adds(token, core))
        self[token] = n
        return n

    def _unknown(self, low: str) -> bool:
        return low not in self.known and low[: STEMS[0]] not in self.short and low[: STEMS[1]] not in self.long

    def table(self) -> np.ndarray:
        if self.rows:
            self.done = np.concatenate([self.done, np.array(self.rows, np.float32)])
            self.rows = []
        return self.done

    def _adds(self, token: str, core: str) -> tuple:
        get = self.lexicon.get
        plain = core.isalpha()
        words = [core.lower()] if plain else words_of(token)
        hits = weight = stems = top = yours = 0.0
        for w in words:
            own = get(w, 0.0)
            best = own
            for k in STEMS:
                if len(w) > k:
                    best = max(best, get(w[:k] + "*", 0.0))
            if best > 0:
                hits += 1
                weight += best
                stems += own <= 0
                top = max(top, best)
            yours += w in YOU
        masked = hidden = 0
        shouts = 0
        if not plain:
            masked = OBFUSCATED.search(token) is not None
            if masked:
                low = token.lower()
                hidden = any(get(x, 0.0) > 0 for x in (*words_of(low.translate(SIGNS)), "".join(words_of(low))))
            shouts = len(SHOUTED.findall(token))
        return (len(words), hits, weight, stems, yours, len(core) > 2 and core.isupper(), masked, hidden, DRAWN.search(core) is not None, shouts,
                top, len(core) == 1 and plain)


def describe(texts: list[str | None], lexicon: Lexicon, known: Tokens | None = None) -> np.ndarray:
    """The features of whole texts (rows); a text without words has none but the shares of its signs."""
    known = Tokens(lexicon) if known is None else known
    n = len(texts)
    texts = [t or "" for t in texts]
    split = [t.split() for t in texts]
    ids = np.array(list(map(known.__getitem__, chain.from_iterable(split))), np.int64)
    sizes = np.array([len(x) for x in split], np.int64)
    ends = np.cumsum(sizes)
    # Only tokens that add more than themselves are looked at: their places, texts and what they add.
    at = np.flatnonzero(ids)
    ids, owner = ids[at], np.searchsorted(ends, at, "right")
    adds = known.table()[ids]

    def total(add: int) -> np.ndarray:
        return np.bincount(owner, adds[:, add], minlength=n)

    words = total(WORDS) + sizes - np.bincount(owner, minlength=n)
    hits, weight, stems = (total(x) for x in (HITS, WEIGHT, STEM))
    hit = np.flatnonzero(adds[:, HITS] > 0)
    top, kinds, near = np.zeros(n), np.zeros(n), np.zeros(n)
    np.maximum.at(top, owner[hit], adds[hit, TOPMOST])
    different = np.unique(np.stack([owner[hit], ids[hit]]), axis=1)
    np.add.at(kinds, different[0], 1)
    you = np.flatnonzero(adds[:, YOURS] > 0)
    if len(you) and len(hit):
        after = np.searchsorted(you, hit)
        close = np.zeros(len(hit), bool)
        for side in (you[np.minimum(after, len(you) - 1)], you[np.maximum(after - 1, 0)]):
            close |= (np.abs(at[side] - at[hit]) <= NEAR) & (owner[side] == owner[hit])
        np.add.at(near, owner[hit[close]], 1)
    hidden, spelled = total(HIDDEN), np.zeros(n)
    lone = np.flatnonzero(adds[:, SINGLE] > 0)
    apart = np.flatnonzero((np.diff(at[lone]) != 1) | (np.diff(owner[lone]) != 0)) + 1
    for run in np.split(lone, apart):
        if len(run) >= SPELLED:
            d = owner[run[0]]
            spelled[d] += 1
            first = at[run[0]] - ends[d] + sizes[d]
            hidden[d] += lexicon.get("".join(words_of("".join(split[d][first: first + len(run)]))), 0.0) > 0
    data, offs = text_bytes(pa.array(texts, pa.string()))
    chars, letters, capitals, digits, blanks = _signs(data, offs)

    def per(x: np.ndarray, of: np.ndarray) -> np.ndarray:
        return x / np.maximum(of, 1)

    log = np.log1p
    return np.stack([
        log(words), per(hits, words), log(hits), per(weight, words), log(weight), top, log(kinds), per(stems, words), log(stems),
        per(total(YOURS), words), per(near, hits), per(near, words), per(hidden, words), log(hidden), per(capitals, letters),
        per(total(LOUD), words), per(chars - letters - digits - blanks, chars), per(total(SHOUTS), words), per(total(MASKED), words),
        per(spelled, words), per(total(STRETCHED), words), per(digits, chars)], axis=1)


# Bytes, and classes a byte may be of: a character's first, a letter (ASCII ones and all non-ASCII characters), ASCII capital, digit, blank.
_BYTE = np.arange(256)
_CAPITAL, _BEYOND = (_BYTE >= 65) & (_BYTE <= 90), _BYTE >= 0xC0
_CLASSES = np.stack([_BYTE & 0xC0 != 0x80, _CAPITAL | _BEYOND | ((_BYTE >= 97) & (_BYTE <= 122)), _CAPITAL, (_BYTE >= 48) & (_BYTE <= 57), _BYTE <= 32]).astype(np.int64)
COUNTED = 1 << 20  # bytes counted at once


def _signs(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Per text: characters, letters, capitals, digits, blanks."""
    counts = np.zeros((len(offs) - 1, 256), np.int64)
    for row, a, b in zip(counts, offs[:-1].tolist(), offs[1:].tolist()):
        for i in range(a, b, COUNTED):
            row += np.bincount(data[i: min(b, i + COUNTED)], minlength=256)
    return _CLASSES @ counts.T


def _sample(df: DataFrame, labels: DataFrame, key: str, text: str, label: str, size: int) -> DataFrame:
    """(text, y, weight, fold): per label the ``size`` distinct texts of least hash, weighted to the labels' shares of all distinct texts.

    A text is toxic if at least half of its labelled rows are.  Hashes and
    labels are joined without the texts; texts are fetched by a broadcast of the
    chosen keys, whose number is the sample's bound.
    """
    marks = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.max((F.col(label) > 0).cast("int")).alias("y"))
    hashed = df.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"))
    each = materialise(hashed.join(marks, "k").groupBy("h").agg(F.min("k").alias("k"), F.avg("y").alias("share")).select(
        "h", "k", (F.col("share") >= 0.5).cast("double").alias("y")))
    n = {r["y"]: r["count"] for r in each.groupBy("y").count().collect()}
    chosen = None
    for y, total in sorted(n.items()):
        part = each.where(F.col("y") == y).orderBy("h").limit(size).withColumn("weight", F.lit(total / min(total, size)))
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        chosen = each.withColumn("weight", F.lit(1.0))
    found = df.select(F.col(key).alias("k"), F.coalesce(text, F.lit("")).alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("h")).join(
        F.broadcast(chosen), ["k", "h"]).dropDuplicates(["h"])
    return materialise(found.select("text", "y", "weight", F.pmod(F.xxhash64("h"), F.lit(FOLDS)).cast("int").alias("fold")))


def _weight(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Log odds of terms, 0 where the evidence is too weak."""
    a, b = toxic + 0.5, clean + 0.5
    odds = np.log(a / (n_toxic + 1)) - np.log(b / (n_clean + 1))
    z = odds / np.sqrt(1 / a + 1 / b)
    return np.where((toxic >= MIN_TEXTS) & (odds >= MIN_ODDS) & (z >= MIN_Z), odds, 0.0)


def learn_lexicons(sample: DataFrame, size: int = LEXICON) -> list[Lexicon]:
    """One lexicon without each fold, and last that of all folds; texts are counted, not occurrences."""

    def count(batches):
        held: dict = {}

        def out():
            for (fold, y), counts in held.items():
                k = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(counts), pa.string()), pa.array(np.full(k, fold, np.int32)), pa.array(np.full(k, y)), pa.array(list(counts.values()), pa.int64())],
                    ["term", "fold", "y", "n"])

        for batch in batches:
            for text, y, fold in zip(*(batch.column(c).to_pylist() for c in ("text", "y", "fold"))):
                held.setdefault((fold, y), Counter()).update(terms(set(words_of(text))))
            if sum(map(len, held.values())) > HELD_TERMS:
                yield from out()
                held.clear()
        yield from out()

    sizes = {(r["fold"], r["y"]): r["count"] for r in sample.groupBy("fold", "y").count().collect()}
    totals = {y: np.array([sizes.get((f, y), 0) for f in range(FOLDS)]) for y in (0.0, 1.0)}
    parts = sample.select("text", "y", "fold").mapInArrow(count, "term string, fold int, y double, n bigint")
    sums = [F.sum(F.when((F.col("fold") == f) & (F.col("y") == y), F.col("n")).otherwise(0)).alias(f"n{y}_{f}") for y in (0, 1) for f in range(FOLDS)]
    toxic = sum(F.col(f"n1_{f}") for f in range(FOLDS))
    clean = sum(F.col(f"n0_{f}") for f in range(FOLDS))
    lift = toxic / (clean + 1)
    rows = parts.groupBy("term").agg(*sums).where(toxic >= MIN_TEXTS).orderBy(F.desc(toxic * F.log1p(lift)), "term").limit(size).collect()
    names = [r["term"] for r in rows]
    n0 = np.array([[r[f"n0_{f}"] for f in range(FOLDS)] for r in rows], np.int64).reshape(-1, FOLDS)
    n1 = np.array([[r[f"n1_{f}"] for f in range(FOLDS)] for r in rows], np.int64).reshape(-1, FOLDS)
    out = []
    for f in [*range(FOLDS), None]:
        keep = np.array([g != f for g in range(FOLDS)])
        w = _weight(n1[:, keep].sum(1), n0[:, keep].sum(1), int(totals[1.0][keep].sum()), int(totals[0.0][keep].sum()))
        out.append({t: float(x) for t, x in zip(names, w) if x > 0})
    return out


def features(df: DataFrame, lexicons: list[Lexicon], text: str = "text", fold: str | None = None, keep_text: bool = True) -> DataFrame:
    """``df`` plus the FEATURES; with ``fold`` each row is described without its own fold, else with the last lexicon."""
    names = [c for c in df.columns if keep_text or c != text]
    schema = df.select(*[F.col(f"`{c}`") for c in names], *[F.lit(0.0).alias(f"__{c}") for c in FEATURES]).schema
    shared = df.sparkSession.sparkContext.broadcast(lexicons)  # LEXICON entries at most

    @releasing
    def run(batches):
        mine = [Tokens(x) for x in shared.value]
        for batch in batches:
            texts = batch.column(text).to_pylist()
            which = np.array(batch.column(fold).to_pylist() if fold else [len(mine) - 1] * len(texts), np.int64)
            table = np.zeros((len(texts), len(FEATURES)))
            for f in np.unique(which):
                rows = np.flatnonzero(which == f)
                table[rows] = describe([texts[i] for i in rows], mine[f].lexicon, mine[f])
                if len(mine[f]) > REMEMBERED:
                    mine[f] = Tokens(mine[f].lexicon)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], *[pa.array(table[:, i]) for i in range(len(FEATURES))]], [*names, *[f"__{c}" for c in FEATURES]])

    return df.mapInArrow(run, schema)


@dataclass
class Model:
    """Lexicons, boosted trees and calibration; without both labels in the sample only the label share is known."""

    lexicons: list[Lexicon]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    base: float


def _vector(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[f"__{c}" for c in FEATURES], outputCol="__features").transform(df)


def fit(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE,
        trees: int = TREES) -> Model:
    """Learn from the rows of ``df`` that ``labels`` marks (null labels are none; one positive label of a key is enough).

    Only a bounded sample of texts is learned from, ``sample`` per label.
    """
    rows = _sample(df, labels, key, text, label, sample)
    stats = {r["y"]: (r["n"], r["w"]) for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w")).collect()}
    weight = sum(w for _, w in stats.values())
    base = stats.get(1.0, (0, 0.0))[1] / weight if weight else 0.0
    if len(stats) < 2:
        return Model([{}], None, None, base)
    lexicons = learn_lexicons(rows)
    # Written first, so that each tree reads the same rows, also after a lost executor.
    table = _vector(materialise(features(rows, lexicons, "text", "fold", keep_text=False))).select("y", "weight", "fold", "__features")
    boosted, kept = table.where(F.col("fold") != CALIBRATION), table.where(F.col("fold") == CALIBRATION)
    if boosted.select("y").distinct().count() < 2:
        return Model([{}], None, None, base)
    boosted = boosted.repartition(4, F.xxhash64("__features")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = GBTClassifier(featuresCol="__features", labelCol="y", weightCol="weight", maxIter=trees, maxDepth=DEPTH, stepSize=STEP,
                              subsamplingRate=1.0, seed=13).fit(boosted)
    finally:
        boosted.unpersist()
    # Equal margins are one row: the regression pools them in any case.
    scored = _margin(model.transform(kept)).groupBy("__margin").agg(
        F.sum("weight").alias("weight"), F.sum(F.col("y") * F.col("weight")).alias("y")).select((F.col("y") / F.col("weight")).alias("y"), "weight", "__margin")
    # Two rows at the ends keep the steps of a small sample off 0 and 1.
    ends = df.sparkSession.createDataFrame([(0.0, 1.0, -4.0), (1.0, 1.0, 4.0)], "y double, weight double, __margin double")
    calibration = IsotonicRegression(featuresCol="__margin", labelCol="y", weightCol="weight", predictionCol="__score").fit(scored.unionByName(ends))
    return Model([lexicons[-1]], model, calibration, base)


def _margin(df: DataFrame) -> DataFrame:
    return df.withColumn("__margin", vector_to_array("rawPrediction")[1])


def score(df: DataFrame, model: Model, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` (without ``text`` if not ``keep_text``) plus ``score`` (0 to 1, calibrated) and ``predicted`` (1 from 0.5 on).

    Only ``text`` is read; null is empty, and empty texts have a score too.
    Without a learned model every score is the share of toxic texts in the
    sample (0 without one).  Repeated rows are scored alike; input columns named
    like an output keep their values as ``<name>_in``.
    """
    df = free_names(df, ["score", "predicted"])
    names = [c for c in df.columns if keep_text or c != text]
    if model.trees is None:
        out = df.select(*[F.col(f"`{c}`") for c in names], F.lit(float(model.base)).alias("score"))
        return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    described = _vector(features(df, model.lexicons, text, keep_text=keep_text))
    out = model.calibration.transform(_margin(model.trees.transform(described)))
    value = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("__score")))
    return out.select(*[F.col(f"`{c}`") for c in names], value.alias("score"), (value >= 0.5).cast("int").alias("predicted"))
