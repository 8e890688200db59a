"""Benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit distance.

Texts are sequences of words (runs of ASCII letters and digits, lower-cased,
and of non-ASCII characters).  The CGK random walk reads a sequence word by
word; at step j the word decides by a random bit whether the walk moves on or
stays.  Two sequences at a small edit distance come into step again after an
edit, so their embeddings have a small Hamming distance.  A key hashes a few
sampled steps of the walk; the walks begin at every word of every text and at
every word of every benchmark item, and several walks and samples are used.
Every item-sized window with an equal key is verified by the exact edit
distance of the item to the best part of the window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from docspark.llm.common import lower_ascii, mix, releasing, resident, text_bytes, word_hashes, word_spans

SIMILARITY = 0.8
# Steps of a walk, sampled steps of a key, independent walks and samples per walk.
STEPS, SAMPLED, WALKS, SAMPLES = 12, 6, 3, 2
# A key of an item must read so many of its words: fewer are met by chance everywhere.
KEY_WORDS = 4
# Items of fewer words are found by pairs of words: an edit touches two of them at most, so that a fifth of edits leaves some whole.
SHORT = 15
SEED = 7
# Benchmark text that one pass over the documents holds in memory.
BLOCK_BYTES = 16 << 20
FILTER_BITS = 22


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start byte, end byte of all words, and the first word of each text (n + 1 values)."""
    low = lower_ascii(data)
    inside = (low >= 128) | ((low >= 97) & (low <= 122)) | ((low >= 48) & (low <= 57))
    starts, ends, first = word_spans(low, offs, inside)
    return word_hashes(low, starts, ends), starts, ends, first


def _plan():
    rnd = np.random.Generator(np.random.PCG64(SEED))
    odd = lambda *shape: rnd.integers(0, 2**63, shape, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    moves = odd(WALKS, STEPS)
    picks = [[np.sort(rnd.choice(STEPS, SAMPLED, replace=False)) for _ in range(SAMPLES)] for _ in range(WALKS)]
    return moves, picks, odd(WALKS, SAMPLES, STEPS)


def keys(h: np.ndarray):
    """For each walk and sample: the key at every word, the last word it reads and how many it reads."""
    moves, picks, factors = _plan()
    n = len(h)
    padded = np.concatenate([h, np.zeros(STEPS + 1, np.uint64)])
    for walk in range(WALKS):
        at = np.arange(n)
        out = [np.zeros(n, np.uint64) for _ in range(SAMPLES)]
        last, read = [at - 1] * SAMPLES, [np.zeros(n, np.int8) for _ in range(SAMPLES)]
        for j in range(STEPS):
            w = padded[at]
            for r in range(SAMPLES):
                if j in picks[walk][r]:
                    out[r] += w * factors[walk, r, j]
                    read[r] += at > last[r]
                    last[r] = at
            at = at + ((w * moves[walk, j]) >> np.uint64(63)).astype(np.int64)
        for r in range(SAMPLES):
            yield mix(out[r]), last[r], read[r]


def edit_distance(pattern: list, text: list) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to a part of ``text`` and the end of the first such part (bit-parallel)."""
    n = len(pattern)
    mask, top = (1 << n) - 1, 1 << (n - 1)
    where: dict = {}
    for i, w in enumerate(pattern):
        where[w] = where.get(w, 0) | 1 << i
    up, down, score = mask, 0, n
    best, end = n, 0
    for j, w in enumerate(text):
        eq = where.get(w, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph = (down | ~(xh | up)) & mask
        mh = up & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1) & mask, (mh << 1) & mask
        up = (mh | ~(xv | ph)) & mask
        down = ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


class Index:
    """Keys of the walks at all words of all items of one block."""

    def __init__(self, items: tuple[tuple, ...], similarity: float = SIMILARITY):
        self.ids = [i for i, _ in items]
        texts = pa.array([t for _, t in items], pa.string())
        h, _, _, first = words(*text_bytes(texts))
        self.words = [h[a:b].tolist() for a, b in zip(first, first[1:])]
        self.sets = [set(w) for w in self.words]
        sizes = np.diff(first)
        self.allowed = [int(n * (1 - similarity) + 1e-9) for n in sizes]
        self.whole = np.maximum(1, sizes - 1 - 2 * np.array(self.allowed, np.int64))
        owner = np.repeat(np.arange(len(items)), sizes)
        offset = np.arange(len(h)) - np.repeat(first[:-1], sizes)
        stop = np.repeat(first[1:], sizes)
        long = np.repeat(sizes >= SHORT, sizes)
        self.tables = [self._table(k[ok], owner[ok], offset[ok]) 
                       for k, last, read in keys(h) for ok in [long & (last < stop) & (read >= KEY_WORDS)]]
        # Short items: all their pairs of words, or their only word.
        self.pairs = self.singles = None
        pair = ~long & (np.arange(len(h)) + 1 < stop)
        if pair.any():
            self.pairs = self._table(self._pair(h)[pair], owner[pair], offset[pair])
        alone = np.repeat(sizes == 1, sizes)
        if alone.any():
            self.singles = self._table(h[alone], owner[alone], offset[alone])

    @staticmethod
    def _pair(h: np.ndarray) -> np.ndarray:
        return mix(h * np.uint64(3) + np.concatenate([h[1:], np.zeros(1, np.uint64)])) if len(h) else h

    @staticmethod
    def _table(k: np.ndarray, owner: np.ndarray, offset: np.ndarray):
        order = np.argsort(k, kind="stable")
        seen = np.zeros(1 << FILTER_BITS, bool)
        seen[k >> np.uint64(64 - FILTER_BITS)] = True
        return k[order], owner[order], offset[order], seen

    @staticmethod
    def _look(table, k: np.ndarray):
        sorted_keys, owner, offset, seen = table
        at = np.flatnonzero(seen[k >> np.uint64(64 - FILTER_BITS)])
        lo, hi = np.searchsorted(sorted_keys, k[at], "left"), np.searchsorted(sorted_keys, k[at], "right")
        n = hi - lo
        entry = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))
        return np.repeat(at, n) - offset[entry], owner[entry], np.repeat(at, n)

    def _enough_pairs(self, found, first: np.ndarray):
        """Of the pairs met, those of texts that hold as many pairs of an item as its allowed edits must leave whole."""
        begin, item, at = found
        place = np.searchsorted(first, at, "right") * len(self.ids) + item
        _, which, met = np.unique(place, return_inverse=True, return_counts=True)
        enough = met[which] >= self.whole[item]
        return begin[enough], item[enough], at[enough]

    def matches(self, data: np.ndarray, offs: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item, distance, start byte, end byte) of the best window of each text and item within the threshold."""
        h, starts, ends, first = words(data, offs)
        if not len(h) or not self.ids:
            return []
        found = [self._look(t, k) for t, (k, *_) in zip(self.tables, keys(h))]
        if self.pairs is not None:
            found.append(self._enough_pairs(self._look(self.pairs, self._pair(h)), first))
        if self.singles is not None:
            found.append(self._look(self.singles, h))
        begin, item, at = (np.concatenate(x) for x in zip(*found))
        text = np.searchsorted(first, at, "right") - 1
        order = np.lexsort((begin, item, text))
        out, last = [], None
        held: list[int] = []

        def verify(text: int, item: int, lo: int, hi: int):
            slack, n = self.allowed[item], len(self.words[item])
            a, b = max(int(first[text]), lo - slack), min(int(first[text + 1]), hi + n + slack)
            region = h[a:b].tolist()
            if len(self.sets[item].intersection(region)) < len(self.sets[item]) - slack:
                return None
            best, end = edit_distance(self.words[item], region)
            if best > slack or end == 0:
                return None
            back, size = edit_distance(self.words[item][::-1], region[:end][::-1])
            return best, int(starts[a + end - size]), int(ends[a + end - 1])

        def close(key, held):
            # Windows that overlap are verified together, in stretches of a few item sizes.
            text, item = key
            n, best = len(self.words[item]), None
            i = 0
            while i < len(held):
                j = i
                while j + 1 < len(held) and held[j + 1] - held[i] <= 3 * n:
                    j += 1
                r = verify(text, item, held[i], held[j])
                if r and (best is None or r < best):
                    best = r
                i = j + 1
            if best:
                base = int(offs[text])
                out.append((text, item, best[0], best[1] - base, best[2] - base))

        for t, i, b in zip(text[order].tolist(), item[order].tolist(), begin[order].tolist()):
            if (t, i) != last:
                if last is not None:
                    close(last, held)
                last, held = (t, i), []
            if not held or held[-1] != b:
                held.append(b)
        if last is not None:
            close(last, held)
        return out


def _index(items: tuple, similarity: float) -> Index:
    return resident("decontam", (items, similarity), lambda: Index(items, similarity))


def blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES):
    """The items in blocks of bounded bytes (a longer item is a block of its own); each goes to the tasks by itself."""
    held, size = [], 0
    for r in benchmark.select(item, text).orderBy(item, text).toLocalIterator():
        n = len((r[1] or "").encode())
        if held and size + n > block_bytes:
            yield tuple(held)
            held, size = [], 0
        held.append((r[0], r[1] or ""))
        size += n
    if held:
        yield tuple(held)


def find(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, item_id, distance, item_words, start, end): the best window of each document row and item.

    A window counts if its edit distance in words is at most ``1 - similarity``
    of the item's words.  ``start`` and ``end`` are UTF-8 bytes of the text.
    Null and empty texts and items match nothing; repeated rows give repeated
    results; no benchmark gives an empty result.  The benchmark is a query set:
    it is passed over the documents in blocks of bounded size.
    """
    item_type = benchmark.schema["item_id"].dataType
    id_type = to_arrow_type(item_type)
    schema = df.select(
        F.col(key), F.lit(None).cast(item_type).alias("item_id"), F.lit(0).alias("distance"), F.lit(0).alias("item_words"),
        F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"),
    ).schema
    for f in schema:
        f.nullable = True
    source = df.select(F.col(key), F.col(text).alias("__text"))
    out = None
    for block in blocks(benchmark, text="text", block_bytes=block_bytes):

        @releasing
        def run(batches, block=block):
            index = _index(block, similarity)
            for batch in batches:
                rows = index.matches(*text_bytes(batch.column(1)))
                t, i, d, s, e = zip(*rows) if rows else ((),) * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(t, pa.int64())),
                     pa.array([index.ids[x] for x in i], id_type),
                     pa.array(d, pa.int32()), pa.array([len(index.words[x]) for x in i], pa.int32()),
                     pa.array(s, pa.int64()), pa.array(e, pa.int64())],
                    [key, "item_id", "distance", "item_words", "start", "end"])

        part = source.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else df.sparkSession.createDataFrame([], schema)


def remove(df: DataFrame, benchmark: DataFrame, text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``df`` whose text holds no window of a benchmark item; columns unchanged."""
    names = df.columns
    for block in blocks(benchmark):

        @releasing
        def run(batches, block=block):
            index = _index(block, similarity)
            for batch in batches:
                hit = np.zeros(batch.num_rows, bool)
                hit[[r[0] for r in index.matches(*text_bytes(batch.column(text)))]] = True
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(~hit)) for c in batch.columns], names)

        df = df.mapInArrow(run, df.schema)
    return df
