"""Language identification by cross-parsing entropy.

For each language a bounded sample of labelled text is turned into a suffix
automaton.  A text is parsed against each automaton into longest matches; the
language whose automaton needs the fewest phrases, weighted by the bits of a
position in its sample, wins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docspark.llm.common import free_names, releasing, resident

# The classifier's sample per language: at most FRAGMENTS pieces of FRAGMENT_CHARS characters.
FRAGMENTS, FRAGMENT_CHARS = 24, 1500
# Symbols: 0 is a run of non-letters, 1..61 the most frequent letters of the
# samples, 62 any other letter, 63 ends a fragment and occurs in no text.
WIDTH, OTHER, END = 64, 62, 63
# A text is parsed in blocks of this many symbols, many blocks side by side.
BLOCK, LANES = 2048, 4096
# Hash buckets of a language from which its least hashes are gathered.
BUCKETS = 64
UNKNOWN = "und"


def suffix_automaton(symbols: list[int]) -> np.ndarray:
    """Dense transitions (states x WIDTH, 0: none; 0 is the initial state) of all substrings of ``symbols``."""
    step, link, length, last = [{}], [-1], [0], 0
    for s in symbols:
        cur = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and s not in step[p]:
            step[p][s] = cur
            p = link[p]
        if p >= 0:
            q = step[p][s]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(s) == q:
                    step[p][s] = copy
                    p = link[p]
                link[q] = link[cur] = copy
        last = cur
    table = np.zeros((len(step), WIDTH), np.int32)
    for state, to in enumerate(step):
        if to:
            table[state, list(to)] = list(to.values())
    return table


class Model:
    """Automata of all languages in one transition table."""

    def __init__(self, samples: tuple[tuple[str, tuple[str, ...]], ...]):
        self.languages = [lang for lang, _ in samples]
        letters = "".join(t for _, ts in samples for t in ts).lower()
        found, counts = np.unique(np.frombuffer(letters.encode("utf-32-le"), np.uint32), return_counts=True)
        order = [int(c) for c in found[np.lexsort((found, -counts))] if chr(c).isalpha()][: OTHER - 1]
        self.symbol_of = np.zeros(0x110000, np.uint8)
        self.symbol_of[[c for c in range(0x110000) if chr(c).isalpha()]] = OTHER
        self.symbol_of[order] = np.arange(1, len(order) + 1)
        tables, self.roots, bits = [], [], []
        for _, texts in samples:
            symbols: list[int] = []
            for t in texts:
                s, _ = self.symbols([t])
                symbols += [*s.tolist(), END]
            table = suffix_automaton(symbols)
            base = sum(map(len, tables))
            self.roots.append(base)
            tables.append(np.where(table > 0, table + base, 0).astype(np.int32))
            bits.append(np.log2(max(2, len(symbols))))
        self.bits = np.array(bits)
        # Flat, with states already multiplied by the width; 0 means no transition.
        self.table = (np.concatenate(tables).ravel() * WIDTH) if tables else np.zeros(0, np.int32)
        self.roots = np.array(self.roots, np.int32) * WIDTH

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts in a row, and the ends of the texts."""
        lower = [t.lower() for t in texts]
        codes = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
        s = self.symbol_of[codes]
        ends = np.cumsum([len(t) for t in lower])
        # Runs of non-letters are one symbol; a text starts a run of its own.
        keep = np.ones(len(s), bool)
        keep[1:] = (s[1:] > 0) | (s[:-1] > 0)
        starts = ends[:-1][ends[:-1] < len(s)]
        keep[starts] = True
        total = np.concatenate([[0], np.cumsum(keep)])
        return s[keep], total[ends]

    def phrases(self, s: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Phrases of each text (rows) against each language (columns)."""
        out = np.zeros((len(ends), len(self.languages)), np.int64)
        starts = np.concatenate([[0], ends[:-1]])
        sizes = ends - starts
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(ends)), blocks)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        at = starts[owner] + within * BLOCK
        size = np.minimum(BLOCK, ends[owner] - at)
        order = np.argsort(-size, kind="stable")
        for lo in range(0, len(order), LANES):
            lanes = order[lo: lo + LANES]
            count = self._parse(s, at[lanes], size[lanes])
            np.add.at(out, owner[lanes], count)
        return out

    def _parse(self, s: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Greedy longest-match parse of blocks sorted by falling size, all languages at once."""
        table, roots = self.table, self.roots[:, None]
        state = np.repeat(roots, len(at), axis=1)
        count = np.ones((len(roots), len(at)), np.int32)  # the phrase that the end cuts off
        padded = np.concatenate([s, np.zeros(1, np.uint8)])
        active = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1), side="right") if len(size) else []
        for t, n in enumerate(active):
            c = padded[at[:n] + t].astype(np.int32)
            new = table.take(state[:, :n] + c)
            dead = new == 0
            # No longer match: a phrase ends, the next begins with this symbol (or is this unknown symbol alone).
            again = table.take(roots + c)
            count[:, :n] += dead
            np.copyto(new, again, where=dead)
            np.copyto(new, np.broadcast_to(roots, new.shape), where=new == 0)
            state[:, :n] = new
        return count.T

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; the score is the relative lead over the second language."""
        s, ends = self.symbols([t or "" for t in texts])
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        letters = np.concatenate([[0], np.cumsum(s > 0)])
        known = letters[ends] > letters[starts] if len(ends) else np.zeros(0, bool)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        cost = self.phrases(s, ends) * self.bits / np.maximum(1, ends - starts)[:, None]
        best = cost.argmin(axis=1)
        rank = np.sort(cost, axis=1)
        second = rank[:, 1] if rank.shape[1] > 1 else np.full(len(texts), max(self.bits.max(), rank.max(initial=1)))
        score = np.where(known, 1 - rank[:, 0] / np.maximum(second, 1e-9), 0.0).clip(0, 1)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)], score


def _model(samples: tuple) -> Model:
    return resident("langid", samples, lambda: Model(samples))


def sample(labelled: DataFrame, text: str = "text", lang: str = "lang", fragments: int = FRAGMENTS,
           chars: int = FRAGMENT_CHARS) -> tuple[tuple[str, tuple[str, ...]], ...]:
    """``fragments`` pieces of at most ``chars`` characters per language: of the distinct texts with the least content hashes.

    A language with fewer distinct texts gives a piece of each.  Only this sample
    comes to the driver.  Rows without text or label are left out; equal texts
    count once.
    """
    rows = labelled.where(F.col(text).rlike(r"\p{L}") & F.col(lang).isNotNull()).select(
        F.col(lang).alias("__lang"), F.col(text).alias("__text"), F.xxhash64(text).alias("__h")
    )
    least = rows.select("__lang", "__h").distinct().withColumn("__b", F.pmod("__h", F.lit(BUCKETS)))
    for place in (["__lang", "__b"], ["__lang"]):  # of each bucket first, so that no task ranks a whole language
        first = Window.partitionBy(*place).orderBy("__h")
        least = least.withColumn("__i", F.row_number().over(first)).where(F.col("__i") <= fragments).drop("__i")
    room = F.greatest(F.lit(1), F.length("__text") - chars)
    chosen = (
        rows.join(F.broadcast(least.drop("__b")), ["__lang", "__h"])  # ``fragments`` rows per language
        .select("__lang", "__h", F.substring("__text", (F.pmod(F.xxhash64("__h"), room) + 1).cast("int"), F.lit(chars)).alias("__t"))
        .dropDuplicates(["__lang", "__h"]).orderBy("__lang", "__h").collect()
    )
    out: dict[str, list[str]] = {}
    for r in chosen:
        out.setdefault(r["__lang"], []).append(r["__t"])
    return tuple((k, tuple(v)) for k, v in sorted(out.items()))


def identify(df: DataFrame, samples: tuple, text: str = "text") -> DataFrame:
    """``df`` plus ``lang_pred`` and ``score`` (0 to 1, the relative lead over the second language).

    Only ``text`` is read.  Null texts and texts without a letter are ``und``
    with score 0, as are all texts without a sample; whole texts are parsed,
    long ones in blocks.  Input columns named like an output keep their values
    as ``<name>_in``.
    """
    df = free_names(df, ["lang_pred", "score"])
    names = df.columns
    schema = df.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    @releasing
    def run(batches):
        model = _model(samples)
        for batch in batches:
            pred, score = model.predict(batch.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())], [*names, "lang_pred", "score"])

    return df.mapInArrow(run, schema)


def held_out(key: str):
    """True for the fifth of the rows that are never learned from (null keys count as empty)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0
