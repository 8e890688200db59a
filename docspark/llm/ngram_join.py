"""Exact n-gram Jaccard self-join by prefix trees, to connected components.

Each text is the set of its distinct five-word shingles, as 64-bit hashes in one
global order: frequent shingles last, the others by hash.

1. Candidates.  Two sets at Jaccard similarity t share one of their first
   ``n - ceil(t n) + 1`` shingles.  Sets that share such a shingle meet; a parity
   bitmap of each set bounds the symmetric difference from below and drops
   pairs that cannot reach t.  What passes is tied by spanning edges.  A group
   of very many sets is dealt into blocks by size.  Each block is tied first and
   covered by small clusters; only their representatives go on, with the largest
   bitmap distance R of a member.  By the triangle inequality two clusters with a
   link are no farther apart than the link allows plus both R, and those are tied.
2. Prefix trees.  Each component of candidates is stored as a trie of ordered
   sets.  Every set walks the trie; the overlap with a branch is counted once
   for all sets below it; a subtree goes when even its remaining shingles could
   not reach t, or when all its sets are joined with the walker already.
3. The links found are closed to components.

No pair is dropped: bitmaps and bounds are exact, and each component of
candidates holds every link of its sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.common import (
    bounded_broadcast, lower_ascii, materialise, mix, releasing, text_bytes, word_hashes, word_spans,
)
from docspark.llm.components import components

WORDS = 5
# Similarity as a fraction of integers: intersection / union >= NUM / DEN.
NUM, DEN = 80, 100
# The most frequent shingles that the order puts last; the list goes to all tasks.
FREQUENT = 1 << 16
# Shingles a task counts at once, and how often one must then occur to be reported.
COUNTED, REPORTED = 1 << 22, 4
MAX_BITMAP = 4096
# Sets that one task compares at once; larger groups and components are compared block against block.
BLOCK_SETS = 2048
# A cluster of a block holds sets within this fraction (NEAR_NUM / NEAR_DEN) of both sizes from its representative.
NEAR_NUM, NEAR_DEN = 1, 24
# Rows of a split group in one batch.
CHUNK = 1 << 16
_FACTORS = np.random.Generator(np.random.PCG64(11)).integers(0, 2**63, WORDS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, offs: np.ndarray):
    """The sorted distinct shingle hashes of each text."""
    low = lower_ascii(data)
    inside = (low != 32) & ((low < 9) | (low > 13))
    starts, ends, first = word_spans(low, offs, inside)
    h = word_hashes(low, starts, ends)
    rolled = np.zeros(len(h), np.uint64)
    for j in range(WORDS):
        rolled[: len(h) - j] += h[j:] * _FACTORS[j]
    rolled = mix(rolled)
    for a, b in zip(first.tolist(), first[1:].tolist()):
        n = b - a
        if n >= WORDS:
            s = np.sort(rolled[a: b - WORDS + 1])
            yield s[np.concatenate([[True], s[1:] != s[:-1]])]
        elif n:
            yield mix((h[a:b] * _FACTORS[:n]).sum(keepdims=True, dtype=np.uint64) + np.uint64(n) * _FACTORS[WORDS])
        else:
            yield h[:0]


def set_id(s: np.ndarray) -> int:
    """64-bit identity of a set (also of its size)."""
    if not len(s):
        return 0
    total = (mix(s + np.uint64(0x1234567)).sum(dtype=np.uint64, keepdims=True)) + np.uint64(len(s))
    return int(mix(total).astype(np.int64)[0])


def bitmap(s: np.ndarray) -> bytes:
    """Parity of the shingles in each of 64..4096 cells: sets differ in at least as many shingles as cells."""
    bits = min(MAX_BITMAP, max(64, 1 << (len(s) - 1).bit_length())) if len(s) else 64
    cells = np.bincount((s >> np.uint64(17)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(cells.astype(np.uint8)).tobytes()


def ordered(s: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """``s`` (sorted by hash) in the global order: frequent shingles last, by rising frequency."""
    if not len(frequent) or not len(s):
        return s
    at = np.searchsorted(frequent, s).clip(max=len(frequent) - 1)
    hot = frequent[at] == s
    if not hot.any():
        return s
    return np.concatenate([s[~hot], s[hot][np.argsort(rank[at[hot]], kind="stable")]])


def prefix_size(n: int) -> int:
    return n - -(-NUM * n // DEN) + 1


# ---- scans of the texts --------------------------------------------------


def _scan_sets(df: DataFrame, key: str, text: str) -> DataFrame:
    """Per row (key, n, set id, bitmap); besides, per task, shingles that are frequent in it (key null, token, count)."""
    names = ["__key", "__n", "__sid", "__bits", "__tok", "__count"]
    schema = df.select(
        F.col(key).alias("__key"), F.lit(0).cast("long").alias("__n"), F.lit(0).cast("long").alias("__sid"),
        F.lit(b"").alias("__bits"), F.lit(0).cast("long").alias("__tok"), F.lit(0).cast("long").alias("__count"),
    ).schema
    for f in schema:
        f.nullable = True

    @releasing
    def run(batches):
        held, size, seen, kind = [], 0, set(), None

        def counted():
            tok, n = np.unique(np.concatenate(held), return_counts=True)
            hot = n >= REPORTED
            m = int(hot.sum())
            return pa.RecordBatch.from_arrays(
                [pa.nulls(m, kind), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()),
                 pa.array(tok[hot].astype(np.int64)), pa.array(n[hot].astype(np.int64))], names)

        for batch in batches:
            kind = batch.column(0).type
            n, sid, bits = [], [], []
            for s in shingle_sets(*text_bytes(batch.column(1))):
                i = set_id(s)
                n.append(len(s))
                sid.append(i)
                bits.append(bitmap(s))
                if i not in seen:  # copies in this stretch count once
                    seen.add(i)
                    held.append(s)
                    size += len(s)
            m = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(sid, pa.int64()), pa.array(bits, pa.binary()),
                 pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64())], names)
            if size >= COUNTED:
                yield counted()
                held, size, seen = [], 0, set()
        if held:
            yield counted()

    return df.select(F.col(key).alias("__key"), F.col(text).alias("__text")).mapInArrow(run, schema)


def _prefixes(df: DataFrame, text: str, frequent: np.ndarray, rank: np.ndarray) -> DataFrame:
    """(tok, sid, n) of the first shingles of every distinct set of a task."""

    @releasing
    def run(batches):
        seen = set()
        for batch in batches:
            tok, sid, n = [], [], []
            for s in shingle_sets(*text_bytes(batch.column(0))):
                i = set_id(s)
                if len(s) and i not in seen:
                    if len(seen) < COUNTED:
                        seen.add(i)
                    p = ordered(s, frequent, rank)[: prefix_size(len(s))]
                    tok.append(p)
                    sid.append(np.full(len(p), i, np.int64))
                    n.append(np.full(len(p), len(s), np.int32))
            if tok:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tok).astype(np.int64)), pa.array(np.concatenate(sid)), pa.array(np.concatenate(n))],
                    ["tok", "sid", "n"])

    return df.select(F.col(text).alias("__text")).mapInArrow(run, "tok long, sid long, n int")


# ---- candidates ----------------------------------------------------------


def _runs(batches, column: str):
    """Whole runs of equal values of a sorted column, as record batches that end where a run ends."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        v = batch.column(column).to_numpy()
        change = np.flatnonzero(v[1:] != v[:-1]) + 1
        joined = held and held[-1].column(column)[-1].as_py() == v[0]
        if held and not joined:
            yield pa.Table.from_batches(held)
            held = []
        if len(change):
            yield pa.Table.from_batches([*held, batch.slice(0, int(change[-1]))])
            held = [batch.slice(int(change[-1]))]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _groups(batches, block_sets: int):
    """Groups of distinct sets that share a shingle, each group once per task: (part, whole, sid, n).

    A group of up to ``block_sets`` sets is one part, without ``whole``; a larger
    one is cut by size into parts, and ``whole`` is the group's signature.
    """
    done = set()
    for table in _runs(batches, "tok"):
        tok, sid, n = (table.column(c).to_numpy() for c in ("tok", "sid", "n"))
        new = np.ones(len(tok), bool)  # rows are sorted by (tok, sid): repeated ones go
        new[1:] = (tok[1:] != tok[:-1]) | (sid[1:] != sid[:-1])
        tok, sid, n = tok[new], sid[new], n[new]
        start = np.flatnonzero(np.concatenate([[True], tok[1:] != tok[:-1]]))
        size = np.diff(np.append(start, len(tok)))
        sums = np.add.reduceat(mix(sid.astype(np.uint64)), start)
        sign = mix(sums + size.astype(np.uint64)).astype(np.int64)
        keep = np.zeros(len(start), bool)
        for g in np.flatnonzero(size > 1):
            s = int(sign[g])
            if s not in done:
                if len(done) < COUNTED:
                    done.add(s)
                keep[g] = True
        rows = np.repeat(keep & (size <= block_sets), size)
        if rows.any():
            m = int(rows.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(sign, size)[rows]), pa.nulls(m, pa.int64()), pa.array(sid[rows]), pa.array(n[rows])],
                ["part", "whole", "sid", "n"])
        for g in np.flatnonzero(keep & (size > block_sets)):
            a, m = int(start[g]), int(size[g])
            at = a + np.lexsort((sid[a: a + m], n[a: a + m]))
            blocks = -(-m // block_sets)
            block = np.arange(m) * blocks // m
            part = mix(sign[g: g + 1].astype(np.uint64) + mix(block.astype(np.uint64) + np.uint64(1))).astype(np.int64)
            for lo in range(0, m, CHUNK):
                here = slice(lo, lo + CHUNK)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[here]), pa.array(np.full(len(part[here]), sign[g])), pa.array(sid[at[here]]), pa.array(n[at[here]])],
                    ["part", "whole", "sid", "n"])


def _fold(bits: np.ndarray, size: int) -> np.ndarray:
    while bits.shape[-1] > size:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


class Maps:
    """Bitmaps of a list of sets, folded to every width among them."""

    def __init__(self, bits: list[bytes]):
        maps = [np.frombuffer(b, np.uint8) for b in bits]
        self.widths = np.array([len(m) for m in maps])
        self.by_width = {
            w: np.stack([_fold(m, w) if len(m) >= w else np.zeros(w, np.uint8) for m in maps]) for w in np.unique(self.widths)}

    def distances(self, x: int, others: np.ndarray):
        """(sets, distances from ``x`` at the smaller width), by width of the others."""
        for w in np.unique(self.widths[others]):
            mine = others[self.widths[others] == w]
            w = min(int(w), int(self.widths[x]))
            yield mine, np.bitwise_count(self.by_width[w][mine] ^ self.by_width[w][x]).sum(axis=1, dtype=np.int64)


def _spanning(sid: np.ndarray, lo: np.ndarray, hi: np.ndarray, radius: np.ndarray, bits: list[bytes]) -> list[tuple[int, int]]:
    """Spanning edges of the graph of pairs that size and bitmap leave possible.

    A row stands for sets of ``lo`` to ``hi`` shingles whose bitmaps, of its own width, are within ``radius`` of its own.
    """
    order = np.argsort(lo, kind="stable")
    sid, lo, hi, radius = sid[order], lo[order].astype(np.int64), hi[order].astype(np.int64), radius[order].astype(np.int64)
    maps = Maps([bits[i] for i in order])
    reach = np.maximum.accumulate(hi)
    free = np.ones(len(sid), bool)
    out = []
    for seed in range(len(sid)):
        if not free[seed]:
            continue
        free[seed] = False
        stack = [seed]
        while stack:
            x = stack.pop()
            # Sizes within the ratio; of two sets, |x - y| + |y - x| <= (x + y)(1 - t) / (1 + t).
            least = -(-lo[x] * NUM // DEN)
            a = np.searchsorted(reach, least)
            b = np.searchsorted(lo, hi[x] * DEN // NUM, "right")
            rest = a + np.flatnonzero(free[a:b] & (hi[a:b] >= least))
            if not len(rest):
                continue
            near = [
                mine[(differ - radius[mine] - radius[x]) * (DEN + NUM) <= (hi[mine] + hi[x]) * (DEN - NUM)]
                for mine, differ in maps.distances(x, rest)]
            for y in np.concatenate(near):
                free[y] = False
                out.append((int(sid[x]), int(sid[y])))
                stack.append(int(y))
    return out


def _clusters(n: np.ndarray, bits: list[bytes]) -> list[tuple[int, int, int, int]]:
    """(representative, least size, largest size, radius) of clusters that cover all sets.

    Members have the representative's bitmap width, so that a distance at any
    smaller width is within the radius too, and are tied to it by ``_spanning``.
    """
    maps, n = Maps(bits), n.astype(np.int64)
    free = np.ones(len(n), bool)
    out = []
    for x in range(len(n)):
        if not free[x]:
            continue
        free[x] = False
        rest = np.flatnonzero(free & (maps.widths == maps.widths[x]) & (n * DEN >= n[x] * NUM) & (n * NUM <= n[x] * DEN))
        least = most = int(n[x])
        radius = 0
        for mine, differ in maps.distances(x, rest):
            near = differ * NEAR_DEN <= (n[mine] + n[x]) * NEAR_NUM
            if near.any():
                free[mine[near]] = False
                radius = int(differ[near].max())
                least, most = min(least, int(n[mine[near]].min())), max(most, int(n[mine[near]].max()))
        out.append((x, least, most, radius))
    return out


_EDGES = "a long, b long, whole long, lo int, hi int, radius int, bits binary"


def _edge_batch(edges: list[tuple[int, int]], reps: list[tuple]) -> pa.RecordBatch:
    """Edges (a, b), and representatives (a, whole, lo, hi, radius, bits)."""
    rows = [(a, b, None, None, None, None, None) for a, b in edges] + [(sid, None, *rest) for sid, *rest in reps]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["a", "b", "whole", "lo", "hi", "radius", "bits"])


def _candidates(batches):
    """Spanning edges of each part, and the representatives of parts of split groups."""
    for table in _runs(batches, "part"):
        part, sid, n = (table.column(c).to_numpy() for c in ("part", "sid", "n"))
        whole = table.column("whole").to_pylist()
        bits = table.column("bits").to_pylist()
        cut = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
        edges, reps = [], []
        for a, b in zip(cut, cut[1:]):
            # Equal groups found by several tasks repeat their sets.
            _, at = np.unique(sid[a:b], return_index=True)
            at = at + a
            ids, size, maps = sid[at], n[at], [bits[i] for i in at]
            edges += _spanning(ids, size, size, np.zeros(len(at), np.int64), maps)
            if whole[a] is not None:
                reps += [(int(ids[x]), whole[a], lo, hi, r, maps[x]) for x, lo, hi, r in _clusters(size, maps)]
        if edges or reps:
            yield _edge_batch(edges, reps)


def _cross(batches):
    """Edges between the representatives of each part."""
    for table in _runs(batches, "part"):
        part, sid, lo, hi, radius = (table.column(c).to_numpy() for c in ("part", "a", "lo", "hi", "radius"))
        bits = table.column("bits").to_pylist()
        cut = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
        edges = []
        for a, b in zip(cut, cut[1:]):
            edges += _spanning(sid[a:b], lo[a:b], hi[a:b], radius[a:b], bits[a:b])
        if edges:
            x, y = zip(*edges)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])


def _across(reps: DataFrame, partitions: int, block_sets: int) -> DataFrame:
    """Edges between the representatives of each split group, block against block."""
    sizes = materialise(reps.groupBy("whole").agg(F.ceil(F.count(F.lit(1)) / block_sets).cast("int").alias("blocks")))
    dealt = reps.join(bounded_broadcast(sizes, 16), "whole").withColumn("i", F.pmod(F.xxhash64("a"), F.col("blocks"))).withColumn(
        "j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select(F.xxhash64("whole", F.least("i", "j"), F.greatest("i", "j")).alias("part"), "a", "lo", "hi", "radius", "bits").repartition(
        partitions, "part").sortWithinPartitions("part", "a").mapInArrow(releasing(_cross), "a long, b long")


# ---- prefix trees --------------------------------------------------------


class Trie:
    """Radix tree of ordered sets: nodes hold stretches of shingles shared by all sets below them."""

    def __init__(self, sets: list[np.ndarray]):
        # Shingles become numbers in the global order seen by position; equal shingles compare equal.
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.sets = [sets[i] for i in self.order]
        self.size = np.array([len(s) for s in self.sets])
        same = []
        for x, y in zip(self.sets, self.sets[1:]):
            m = min(len(x), len(y))
            d = np.flatnonzero(x[:m] != y[:m])
            same.append(int(d[0]) if len(d) else m)
        self.same = same

    def node(self, lo: int, hi: int, depth: int):
        """Stretch end and children of the sets lo..hi-1, equal up to ``depth``."""
        end = min(self.same[lo: hi - 1]) if hi - lo > 1 else len(self.sets[lo])
        children, a = [], lo
        if hi - lo > 1:
            for i in range(lo, hi - 1):
                if self.same[i] == end:
                    children.append((a, i + 1))
                    a = i + 1
            children.append((a, hi))
        return end, children


def join_sets(sets: list[np.ndarray], only: tuple[np.ndarray, np.ndarray] | None = None) -> list[tuple[int, int]]:
    """Links (i, j) that span the components of all pairs at the similarity; ``sets`` hold ordered distinct shingles.

    ``only``: flags of two blocks; then links inside a block are left to others.
    """
    trie = Trie(sets)
    m = len(trie.sets)
    label = np.arange(m)
    links: list[tuple[int, int]] = []
    nodes: dict[tuple[int, int], tuple] = {}
    smallest: dict[tuple[int, int], tuple[int, int]] = {}
    for x in range(m - 1):
        mine = trie.sets[x]
        place = {int(v): i for i, v in enumerate(mine)}
        size = len(mine)
        # A branch: sets lo..hi-1, their common depth, the overlap so far, the walker's shingles left.
        stack = [(0, m, 0, 0, size)]
        while stack:
            lo, hi, depth, overlap, left = stack.pop()
            if hi <= x + 1:
                continue
            if (label[max(lo, x + 1):hi] == label[x]).all():
                continue  # every set below is joined already
            key = (lo, hi)
            if key not in nodes:
                end, children = trie.node(lo, hi, depth)
                piece = frozenset(trie.sets[lo][depth:end].tolist())
                nodes[key] = (end, children, piece)
                smallest[key] = (int(trie.size[lo:hi].min()), int(trie.size[lo:hi].max()))
            least, most = smallest[key]
            if size * DEN < least * NUM or most * DEN < size * NUM:
                continue
            end, children, piece = nodes[key]
            if piece:
                overlap += len(piece & place.keys()) if len(piece) < size else sum(v in piece for v in place)
                left = min(left, size - overlap)
                if (at := place.get(int(trie.sets[lo][end - 1]))) is not None:
                    left = min(left, size - 1 - at)  # later shingles of the branch stand behind this one
            # No set below can share more than its remaining shingles, nor more than the walker has left.
            bound = overlap + min(most - end, left)
            if bound * (DEN + NUM) < NUM * (size + max(least, -(-size * NUM // DEN))):
                continue
            if not children:
                if label[lo] != label[x] and overlap * (DEN + NUM) >= NUM * (size + int(trie.size[lo])):
                    i, j = trie.order[x], trie.order[lo]
                    if only is None or only[0][i] and only[1][j] or only[1][i] and only[0][j]:
                        links.append((i, j))
                        label[label == label[lo]] = label[x]
                continue
            for a, b in children:
                stack.append((a, b, end, overlap, left))
    return links


def _fetch_sets(rows: DataFrame, text: str, frequent: np.ndarray, rank: np.ndarray) -> DataFrame:
    """(comp, blocks, sid, tokens): the ordered sets of the rows whose set is the wanted one."""
    names = ["comp", "blocks", "sid", "tokens"]

    @releasing
    def run(batches):
        for batch in batches:
            comp, blocks, want = (batch.column(c).to_pylist() for c in ("comp", "blocks", "sid"))
            out = [(c, k, w, ordered(s, frequent, rank).tobytes())
                   for c, k, w, s in zip(comp, blocks, want, shingle_sets(*text_bytes(batch.column("__text")))) if set_id(s) == w]
            cols = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.binary())], names)

    return rows.mapInArrow(run, "comp long, blocks int, sid long, tokens binary")


def _join_parts(batches):
    """Links of each part (a component, or two blocks of one)."""
    for table in _runs(batches, "part"):
        part, sid, side = (table.column(c).to_numpy() for c in ("part", "sid", "side"))
        tokens = table.column("tokens")
        cut = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
        found = []
        for a, b in zip(cut, cut[1:]):
            ids, at = np.unique(sid[a:b], return_index=True)
            at = at + a
            sets = [np.frombuffer(tokens[int(i)].as_py(), np.uint64) for i in at]
            two = side[at]
            only = None if (two == 0).all() else (two == 0, two == 1)
            found += [(int(ids[i]), int(ids[j])) for i, j in join_sets(sets, only)]
        if found:
            x, y = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])


def near_components(df: DataFrame, key: str = "doc_id", text: str = "text", block_sets: int = BLOCK_SETS,
                    frequent_limit: int = FREQUENT) -> DataFrame:
    """(key, ``n_shingles``, ``component_id``) per row: the smallest key reachable by links.

    Two rows link when the Jaccard similarity of their five-word shingle sets is
    at least 0.8.  Fewer than five words are one shingle; a null or empty text
    has none and is a component of its own (of its row's key).  Rows with equal
    texts, also repeated rows, are linked.  Null keys are larger than all.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    scanned = materialise(_scan_sets(df, key, text))
    rows = scanned.where("__tok IS NULL")
    hot = (
        scanned.where("__tok IS NOT NULL").groupBy("__tok").agg(F.sum("__count").alias("c"))
        .orderBy(F.desc("c"), "__tok").limit(frequent_limit).collect()  # at most ``frequent_limit`` numbers
    )
    frequent = np.array([r["__tok"] for r in hot], np.int64).astype(np.uint64)
    rank = np.array([r["c"] for r in hot], np.int64)
    order = np.argsort(frequent)
    rank = np.lexsort((frequent, rank)).argsort()[order]  # one number per shingle, rising with its frequency
    frequent = frequent[order]

    members = (
        _prefixes(df, text, frequent, rank).repartition(partitions, "tok").sortWithinPartitions("tok", "sid")
        .mapInArrow(releasing(lambda batches: _groups(batches, block_sets)), "part long, whole long, sid long, n int").distinct()
    )
    bits = rows.where("__n > 0").groupBy(F.col("__sid").alias("sid")).agg(F.first("__bits").alias("bits"), F.min("__key").alias("__rep"))
    grouped = members.join(bits.select("sid", "bits"), "sid").repartition(partitions, "part").sortWithinPartitions("part", "sid")
    tied = materialise(grouped.select("part", "whole", "sid", "n", "bits").mapInArrow(releasing(_candidates), _EDGES))
    edges = tied.where("whole IS NULL").select("a", "b")
    reps = tied.where("whole IS NOT NULL").drop("b")
    if not reps.isEmpty():
        edges = edges.unionByName(_across(reps, partitions, block_sets))
    comps = components(edges, "a", "b")

    sizes = comps.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / block_sets).cast("int").alias("blocks"))
    wanted = materialise(
        comps.join(sizes, "root").join(bits.select("sid", "__rep"), comps["node"] == F.col("sid"))
        .select(F.col("__rep"), "sid", F.col("root").alias("comp"), "blocks")
    )
    source = df.select(F.col(key).alias("__key"), F.col(text).alias("__text")).join(
        bounded_broadcast(wanted, 64), F.col("__key").eqNullSafe(F.col("__rep")))
    sets = _fetch_sets(source.select("comp", "blocks", "sid", "__text"), text, frequent, rank)
    # A component of several blocks: every pair of blocks is a part, a set goes to all parts of its block.
    mine = F.pmod(F.xxhash64("sid"), F.col("blocks"))
    dealt = sets.withColumn("i", mine).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.when(F.col("blocks") == 1, F.xxhash64("comp")).otherwise(
            F.xxhash64("comp", F.least("i", "j"), F.greatest("i", "j"))).alias("part"),
        "sid", F.when(F.col("i") > F.col("j"), 1).otherwise(0).alias("side"), "tokens",
    )
    links = dealt.repartition(partitions, "part").sortWithinPartitions("part", "sid").mapInArrow(releasing(_join_parts), "a long, b long")
    roots = materialise(components(links, "a", "b").withColumnRenamed("node", "__sid"))

    linked = rows.where("__n > 0").join(roots, "__sid", "left").withColumn("__root", F.coalesce("root", "__sid"))
    # Written first: a join of two plain exchanges, in which the rows of a huge component can be split.
    least = materialise(linked.groupBy("__root").agg(F.min("__key").alias("__least")))
    out = linked.join(least, "__root").select("__key", "__n", "__least")
    alone = rows.where("__n = 0").select("__key", "__n", F.col("__key").alias("__least"))
    return out.unionByName(alone).select(
        F.col("__key").alias(key), F.col("__n").alias("n_shingles"), F.col("__least").alias("component_id")
    )


def drop_near_copies(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` whose key is the smallest of its component; columns unchanged.

    Only the keys that go are shuffled or broadcast.  Where one key stands for
    several texts, its rows stay if any of them does.
    """
    found = materialise(near_components(df, key, text))
    stays = F.col(key).eqNullSafe(F.col("component_id")).cast("int")
    goes = materialise(
        found.groupBy(F.col(key).alias("__k")).agg(F.max(stays).alias("__stays")).where("__stays = 0").select("__k"))
    return df.join(bounded_broadcast(goes, 16), F.col(key).eqNullSafe(F.col("__k")), "left_anti")
