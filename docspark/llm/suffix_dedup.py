"""Removal of repeated byte strings by a hash-compared suffix sort.

A byte goes if a string of MATCH bytes that covers it also starts elsewhere in
the corpus, in the same text or in another.  In a suffix array those are the
suffixes whose longest common prefix with a neighbour is at least MATCH.

Suffixes that could be neighbours are brought together first.  The anchor of a
MATCH-byte window is its K-gram of least hash (the leftmost of equal ones): equal
windows have equal anchors at equal offsets.  The windows of one anchor are a
run, and the run's bytes are its context.

* Equal contexts (same anchor and context hashes) repeat whole: map side first,
  then over all.
* Different contexts of an equal anchor go to one bucket.  Their suffixes are
  sorted by a merge sort that compares by prefix polynomial hashes: a binary
  search finds the common extension, the byte behind it decides.  Neighbours with
  MATCH bytes in common are verified byte by byte.
* An anchor with very many different contexts is sorted in runs of bounded size.
  What a run has twice is settled in it; of each different window one digest goes
  on, and those of several runs are merged by an aggregate.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.common import Rolling, bounded_broadcast, free_names, materialise, mix, releasing, text_bytes

MATCH = 200
# Bytes of an anchor.
GRAM = 48
# Bytes scanned at once; longer texts are scanned in overlapping pieces.
PIECE = 1 << 20
# Anchors a task combines at once before they are shuffled.
COMBINED = 1 << 21
# Contexts of one anchor that are sorted together (some 300 bytes and 80 suffixes each).
BUCKET = 2048
# Rows of one anchor that a task holds.
RUN_ROWS = 1 << 18


def anchors(data: np.ndarray, offs: np.ndarray, match: int = MATCH, gram: int = GRAM):
    """Runs of windows with one anchor: (text, first window, last window, anchor, anchor hash, context hash), in bytes of ``data``."""
    n = len(data)
    if n < match:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    rolling = Rolling(data)
    at = np.arange(n - gram + 1)
    h = mix(rolling.hashes(at, at + gram))
    least = (h & ~np.uint64(0xFFFFFFFF)) | at.astype(np.uint64)
    width, reach = match - gram + 1, 1
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if width > reach:
        least = np.minimum(least[: len(least) - (width - reach)], least[width - reach:])
    best = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)  # one per window start 0..n-match
    valid = np.zeros(n - match + 2, np.int32)
    size = np.diff(offs)
    ok = size >= match
    np.add.at(valid, offs[:-1][ok], 1)
    np.add.at(valid, offs[1:][ok] - match + 1, -1)
    valid = np.cumsum(valid[:-1]) > 0
    change = np.ones(len(best) + 1, bool)
    change[1:-1] = (best[1:] != best[:-1]) | (valid[1:] != valid[:-1])
    # A text that begins right behind another's last window begins a run of its own.
    starts_at = offs[:-1][ok]
    change[starts_at] = True
    cut = np.flatnonzero(change)
    first, last = cut[:-1], cut[1:] - 1
    keep = valid[first]
    first, last = first[keep], last[keep]
    anchor = best[first]
    context = mix(rolling.hashes(first, last + match) ^ (mix((anchor - first).astype(np.uint64)) + (last - first).astype(np.uint64)))
    text = np.searchsorted(offs, first, "right") - 1
    return text, first, last, anchor, h[anchor], context


def _pieces(data: np.ndarray, offs: np.ndarray, match: int):
    """(first text, bytes, offsets, start in the text) of stretches of about PIECE bytes; long texts in overlapping ones."""
    n, i = len(offs) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + PIECE, "right")) - 1)
        lo, hi = int(offs[i]), int(offs[j])
        if j == i + 1 and hi - lo > PIECE:
            for s in range(lo, hi, PIECE):
                e = min(s + PIECE + match - 1, hi)
                yield i, data[s:e], np.array([0, e - s]), s - lo
        else:
            yield i, data[lo:hi], offs[i: j + 1] - lo, 0
        i = j


SCHEMA = "h long, c long, doc long, tk long, first int, last int, anchor int, n int"
FIELDS = [x.split()[0] for x in SCHEMA.split(", ")]


def _batch(h, c, doc, tk, first, last, anchor, n, kind) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(h.astype(np.int64)), pa.array(c.astype(np.int64)), doc if isinstance(doc, pa.Array) else pa.array(doc, kind), pa.array(tk),
         *[pa.array(x.astype(np.int32)) for x in (first, last, anchor, n)]], FIELDS)


def _scan(df: DataFrame, match: int, gram: int) -> DataFrame:
    """Anchors of all texts, combined per task.

    Of contexts that a task has more than once, one row goes on with their
    number; the others come out as covered windows (n = 0, spread by a hash).
    """

    @releasing
    def run(batches):
        held, size = [], 0

        def combine():
            h, c, doc, tk, first, last, anchor = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((c, h))
            hs, cs = h[order], c[order]
            start = np.flatnonzero(np.concatenate([[True], (hs[1:] != hs[:-1]) | (cs[1:] != cs[:-1])]))
            count = np.diff(np.append(start, len(hs)))
            n = np.zeros(len(h), np.int64)
            n[order[start]] = count
            covered = np.zeros(len(h), bool)
            covered[order] = np.repeat(count > 1, count)
            yield _batch(*[x[n > 0] for x in (h, c, doc, tk, first, last, anchor, n)], pa.int64())
            spread = mix(tk.astype(np.uint64) + first.astype(np.uint64))
            yield _batch(*[x[covered] for x in (spread, c, doc, tk, first, last, anchor, np.zeros(len(h), np.int64))], pa.int64())

        for batch in batches:
            data, offs = text_bytes(batch.column(2))
            doc, tk = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for row, part, o, base in _pieces(data, offs, match):
                text, first, last, anchor, h, c = anchors(part, o, match, gram)
                begin = o[text]
                r = row + text
                shift = base - begin
                held.append((h, c, doc[r], tk[r], first + shift, last + shift, anchor + shift))
                size += len(h)
                if size >= COMBINED:
                    yield from combine()
                    held, size = [], 0
        if held:
            yield from combine()

    return df.select("__doc", "__tk", "__text").mapInArrow(run, SCHEMA)


def _runs(batches, limit: int):
    """Whole anchors of rows sorted by (h, c); an anchor of more than ``limit`` rows in parts, marked by its hash."""
    held, large = None, None
    for batch in batches:
        now = {f: batch.column(f).to_numpy() for f in FIELDS}
        held = now if held is None else {f: np.concatenate([held[f], now[f]]) for f in FIELDS}
        h, c = held["h"], held["c"]
        if not len(h):
            continue
        k = int(np.searchsorted(h, h[-1], "left"))
        if k:
            yield {f: v[:k] for f, v in held.items()}, large
            held = {f: v[k:] for f, v in held.items()}
        if len(held["h"]) > limit:
            large = int(held["h"][0])
            j = int(np.searchsorted(held["c"], held["c"][-1], "left"))
            if j:
                yield {f: v[:j] for f, v in held.items()}, large
                held = {f: v[j:] for f, v in held.items()}
    if held is not None and len(held["h"]):
        yield held, large


def _route(bucket: int, limit: int):
    """Covered windows (``part`` -1), and one row per different context of anchors that have several.

    Contexts of one anchor are numbered; every ``bucket`` of them are a part.
    """

    def run(batches):
        last, used = None, 0  # the anchor that came in pieces, and its parts so far
        for rows, large in _runs(batches, limit):
            h, c, n = rows["h"], rows["c"], rows["n"]
            new_h = np.concatenate([[True], h[1:] != h[:-1]])
            new = np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])])
            start = np.flatnonzero(new)
            total = np.add.reduceat(n, start)
            group = np.cumsum(new) - 1
            covered = (n == 0) | ((n == 1) & (total[group] > 1))
            anchor_of = np.cumsum(new_h) - 1
            real = new & (total[group] > 0)
            contexts = np.bincount(anchor_of[real], minlength=int(anchor_of[-1]) + 1)
            before = np.concatenate([[0], np.cumsum(contexts)[:-1]])
            part = (np.cumsum(real) - 1 - before[anchor_of]) // bucket
            pieces = h == large if large is not None else np.zeros(len(h), bool)
            if pieces.any():
                used = used if last == large else 0
                part = np.where(pieces, part + used, part)
                last, used = large, int(part[pieces].max()) + 1
            hot = (contexts > bucket)[anchor_of] | pieces
            rep = real & ((contexts > 1)[anchor_of] | hot)
            for mask, number in ((covered, np.full(len(h), -1)), (rep, part)):
                if mask.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows[f][mask]) for f in ("h", "doc", "tk", "first", "last", "anchor")]
                        + [pa.array(number[mask].astype(np.int32)), pa.array(hot[mask])],
                        ["h", "doc", "tk", "first", "last", "anchor", "part", "hot"])

    return run


# ---- suffix sort ---------------------------------------------------------


def common_extension(rolling: Rolling, x: np.ndarray, y: np.ndarray, limit: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at x and y, up to ``limit``, by binary search over hashes."""
    low, high = np.zeros(len(x), np.int64), np.full(len(x), limit, np.int64)
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high + 1) // 2
        same = rolling.hashes(x, x + middle) == rolling.hashes(y, y + middle)
        low = np.where(open_ & same, middle, low)
        high = np.where(open_ & ~same, middle - 1, high)


def less(data: np.ndarray, rolling: Rolling, x: np.ndarray, y: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix at x sorts before suffix at y, they agree on ``limit`` bytes)."""
    equal = rolling.hashes(x, x + limit) == rolling.hashes(y, y + limit)
    before = np.zeros(len(x), bool)
    todo = np.flatnonzero(~equal)
    if len(todo):
        a, b = x[todo], y[todo]
        e = common_extension(rolling, a, b, limit - 1)
        before[todo] = data[a + e] < data[b + e]
    return before, equal


def merge_sort(data: np.ndarray, rolling: Rolling, suffix: np.ndarray, group: np.ndarray, limit: int) -> np.ndarray:
    """Order of suffixes inside groups (``group`` rises): bottom-up merge sort over all groups at once.

    A merge gives every element its own rank plus its rank in the sister run,
    found by binary search with hash-compared suffixes; ties keep their order.
    """
    n = len(suffix)
    order = np.arange(n)
    begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.append(begin, n))
    base, size = np.repeat(begin, sizes), np.repeat(sizes, sizes)
    slot = np.arange(n) - base  # place inside the group, of the position
    width = 1
    while n and width < int(sizes.max()):
        live = np.flatnonzero(size > width)
        s = slot[live]
        run = s // width
        sister = np.where(run % 2 == 0, run + 1, run - 1) * width
        lo = np.minimum(sister, size[live])
        hi = np.minimum(sister + width, size[live])
        left = run % 2 == 0
        first, last = lo.copy(), hi.copy()
        mine = suffix[order[live]]
        while True:
            open_ = np.flatnonzero(first < last)
            if not len(open_):
                break
            middle = (first[open_] + last[open_]) // 2
            other = suffix[order[base[live][open_] + middle]]
            before, equal = less(data, rolling, other, mine[open_], limit)
            # Elements of the left run go before equal ones of the right run.
            go = before | (equal & ~left[open_])
            first[open_] = np.where(go, middle + 1, first[open_])
            last[open_] = np.where(go, last[open_], middle)
        start = (run - run % 2) * width
        target = base[live] + start + (s - run * width) + (first - lo)
        new = order.copy()
        new[target] = order[live]
        order = new
        width *= 2
    return order


def repeated(contexts: list[tuple[int, bytes]], bucket_of: np.ndarray, match: int = MATCH) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per context, flags of the windows that also occur in another context of its bucket, and of the first of equal ones.

    ``contexts``: (offset of the anchor, bytes), ordered by bucket.
    """
    data = np.frombuffer(b"".join(b for _, b in contexts), np.uint8)
    sizes = np.array([len(b) for _, b in contexts])
    starts = np.cumsum(sizes) - sizes
    windows = sizes - match + 1
    owner = np.repeat(np.arange(len(contexts)), windows)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    offset = within - np.array([a for a, _ in contexts])[owner]  # of the window's start to the anchor
    suffix = starts[owner] + within
    rolling = Rolling(data)
    # Equal windows have their anchor at the same offset: one group of suffixes per bucket and offset.
    by = np.lexsort((owner, offset, bucket_of[owner]))
    o, b = offset[by], bucket_of[owner][by]
    group = np.cumsum(np.concatenate([[True], (o[1:] != o[:-1]) | (b[1:] != b[:-1])])) - 1
    order = by[merge_sort(data, rolling, suffix[by], group, match)]
    x, y = order[:-1], order[1:]
    same = (group[1:] == group[:-1]) & (rolling.hashes(suffix[x], suffix[x] + match) == rolling.hashes(suffix[y], suffix[y] + match))
    flags, first = np.zeros(len(owner), bool), np.ones(len(owner), bool)
    pairs = np.flatnonzero(same)
    first[y[pairs]] = False
    if len(pairs):
        bad = _collisions(data, owner, suffix, x[pairs], y[pairs], match)
        flags[x[pairs]] = flags[y[pairs]] = True
        for g in np.unique(group[pairs[bad]]):  # two texts with one hash: the bytes decide for the group
            members = by[group == g]
            texts = [data[s: s + match].tobytes() for s in suffix[members]]
            flags[members] = [texts.count(t) > 1 for t in texts]
            first[members] = True  # some may be equal, which the merge of runs allows
    cut = np.cumsum(windows)[:-1]
    return np.split(flags, cut), np.split(first, cut)


def _collisions(data, owner, suffix, x, y, match) -> np.ndarray:
    """Indices of the pairs of windows (x, y) whose bytes differ.

    Neighbouring windows of the same two contexts overlap: a run of them is
    compared once, over the bytes they cover together.
    """
    by = np.lexsort((suffix[x], owner[y], owner[x]))
    x, y = x[by], y[by]
    new = np.ones(len(x), bool)
    new[1:] = (owner[x[1:]] != owner[x[:-1]]) | (owner[y[1:]] != owner[y[:-1]]) | (suffix[x[1:]] != suffix[x[:-1]] + 1) | (
        suffix[y[1:]] != suffix[y[:-1]] + 1)
    start = np.flatnonzero(new)
    length = np.diff(np.append(start, len(x))) + match - 1
    bad = np.zeros(len(start), bool)
    for lo in range(0, len(start), 1 << 14):
        s, n = start[lo: lo + (1 << 14)], length[lo: lo + (1 << 14)]
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        differ = data[np.repeat(suffix[x[s]], n) + step] != data[np.repeat(suffix[y[s]], n) + step]
        bad[lo: lo + len(s)] = np.add.reduceat(differ, np.cumsum(n) - n) > 0
    return by[bad[np.cumsum(new) - 1]]


SORTED = "doc long, tk long, first int, last int, digest binary, part int, single boolean"


def _sort_buckets(match: int):
    """Covered windows of contexts that come sorted by anchor hash and part.

    Of an anchor in several parts also each different window: its digest, and
    whether the part has it once only.
    """

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if not held.num_rows:
                continue
            h, part = held.column("h").to_numpy(), held.column("part").to_numpy()
            open_ = np.flatnonzero((h != h[-1]) | (part != part[-1]))
            if len(open_):
                k = int(open_[-1]) + 1
                yield from work(held.slice(0, k))
                held = held.slice(k)
        if held is not None and held.num_rows:
            yield from work(held)

    def work(table):
        # A document row that is there twice brings its contexts twice.
        same = [table.column(x).to_numpy() for x in ("h", "part", "doc", "tk", "first")]
        new = np.ones(table.num_rows, bool)
        new[1:] = np.any([v[1:] != v[:-1] for v in same], axis=0)
        table = table.filter(pa.array(new))
        h, part = table.column("h").to_numpy(), table.column("part").to_numpy()
        change = np.concatenate([[False], (h[1:] != h[:-1]) | (part[1:] != part[:-1])])
        bucket = np.cumsum(change)
        context = [(a - f, b) for a, f, b in zip(*(table.column(x).to_pylist() for x in ("anchor", "first", "bytes")))]
        # Bounded stretches of whole buckets.
        cut = [0]
        for i in np.flatnonzero(change):
            if i - cut[-1] >= 2048:
                cut.append(int(i))
        cut.append(len(context))
        for a, b in zip(cut, cut[1:]):
            if a == b:
                continue
            flags, leaders = repeated(context[a:b], bucket[a:b], match)
            spans, windows = [], []
            rows = zip(*(table.column(x).slice(a, b - a).to_pylist() for x in ("doc", "tk", "first", "bytes", "part", "hot")))
            for (doc, tk, first, raw, number, hot), flag, leader in zip(rows, flags, leaders):
                edge = np.flatnonzero(np.diff(np.concatenate([[0], flag.astype(np.int8), [0]])))
                spans += [(doc, tk, first + s, first + e - 1, None, None, None) for s, e in zip(edge[0::2].tolist(), edge[1::2].tolist())]
                if hot:
                    windows += [
                        (doc, tk, first + i, first + i, hashlib.blake2b(raw[i: i + match], digest_size=16).digest(), number, not flag[i])
                        for i in np.flatnonzero(leader).tolist()]
            out = spans + windows
            for lo in range(0, len(out), 1 << 16):
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out[lo: lo + (1 << 16)]), kinds)],
                    ["doc", "tk", "first", "last", "digest", "part", "single"])

    return run


# ---- the operator --------------------------------------------------------


def _keyed(df: DataFrame, key: str, text: str) -> DataFrame:
    # A null key travels as the least long; the text's hash stands beside it.
    return df.withColumn("__doc", F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)).cast("long"))).withColumn("__tk", F.xxhash64(F.coalesce(F.col(text), F.lit("")))).withColumn(
        "__text", F.coalesce(F.col(text), F.lit("")))


def _with_text(keyed: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` (doc, tk, list) with the text of their document; only texts that are asked for move."""
    asked = bounded_broadcast(materialise(rows.select(F.col("doc").alias("d"), F.col("tk").alias("t"))), 32)
    texts = keyed.join(asked, (F.col("__doc") == F.col("d")) & (F.col("__tk") == F.col("t")), "left_semi")
    return texts.join(rows, (F.col("__doc") == F.col("doc")) & (F.col("__tk") == F.col("tk")))


def _contexts(keyed: DataFrame, reps: DataFrame, match: int) -> DataFrame:
    """The bytes of the contexts: (h, part, hot, doc, tk, first, anchor, bytes)."""
    per = materialise(reps.groupBy("doc", "tk").agg(F.collect_set(F.struct("h", "first", "last", "anchor", "part", "hot")).alias("list")))
    texts = _with_text(keyed.select("__doc", "__tk", "__text"), per)

    def run(batches):
        for batch in batches:
            out = []
            for d, t, text, items in zip(*(batch.column(c).to_pylist() for c in ("__doc", "__tk", "__text", "list"))):
                raw = text.encode()
                out += [(x["h"], x["part"], x["hot"], d, t, x["first"], x["anchor"], raw[x["first"]: x["last"] + match]) for x in items]
            if out:
                cols = list(zip(*out))
                kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds)], ["h", "part", "hot", "doc", "tk", "first", "anchor", "bytes"])

    return texts.select("__doc", "__tk", "__text", "list").mapInArrow(
        run, "h long, part int, hot boolean, doc long, tk long, first int, anchor int, bytes binary")


def covered_windows(df: DataFrame, key: str = "doc_id", text: str = "text", match: int = MATCH, gram: int = GRAM,
                    bucket: int = BUCKET, run_rows: int = RUN_ROWS) -> DataFrame:
    """(doc, tk, first, last): runs of window starts whose ``match`` bytes also start elsewhere; ``tk`` is xxhash64 of the text."""
    if not 0 < gram <= match:
        raise ValueError("an anchor must fit into the matched string")
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = _keyed(df, key, text)
    routed = materialise(
        _scan(keyed.where(F.octet_length("__text") >= match), match, gram)
        .repartition(partitions, "h").sortWithinPartitions("h", "c")
        .mapInArrow(releasing(_route(bucket, run_rows)), "h long, doc long, tk long, first int, last int, anchor int, part int, hot boolean")
    )
    settled = materialise(
        _contexts(keyed, routed.where("part >= 0"), match)
        .repartition(partitions, "h", "part").sortWithinPartitions("h", "part", "doc", "tk", "first")
        .mapInArrow(releasing(_sort_buckets(match)), SORTED)
    )
    # Windows of several parts; those a part has twice are settled in it.
    windows = settled.where("digest IS NOT NULL")
    several = windows.groupBy("digest").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p <> q").select("digest")
    merged = windows.where("single").join(several, "digest")
    found = [routed.where("part < 0"), settled.where("digest IS NULL"), merged]
    out = [x.select("doc", "tk", "first", "last") for x in found]
    return out[0].unionByName(out[1]).unionByName(out[2])


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", match: int = MATCH, **how) -> DataFrame:
    """``df`` plus ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` (array of start, end) and ``kept`` (binary).

    ``key`` holds integers.  Null and empty texts have no bytes; texts shorter
    than ``match`` keep all; repeated rows lose all their long strings, as each
    occurs elsewhere.  Matches never cross texts.  Input columns named like an
    output keep their values as ``<name>_in``.
    """
    names = ["n_bytes", "n_removed", "n_spans", "spans", "kept"]
    df = free_names(df, names)
    runs = materialise(covered_windows(df, key, text, match, **how))
    per = runs.groupBy("doc", "tk").agg(F.collect_set(F.struct("first", "last")).alias("__list"))
    keyed = _keyed(df, key, text)
    asked = bounded_broadcast(materialise(runs.select(F.col("doc").alias("__d"), F.col("tk").alias("__t")).distinct()), 32)
    on = (F.col("__doc") == F.col("__d")) & (F.col("__tk") == F.col("__t"))
    size = F.octet_length("__text").cast("long")
    whole = keyed.join(asked, on, "left_anti").select(
        *df.columns, size.alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.array().cast("array<struct<start:int,end:int>>").alias("spans"), F.col("__text").cast("binary").alias("kept"))
    touched = keyed.join(asked, on, "left_semi").join(
        per, (F.col("__doc") == F.col("doc")) & (F.col("__tk") == F.col("tk"))
    ).select(*[F.col(f"`{c}`") for c in df.columns], "__text", "__list")

    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def cut(batches):
        for batch in batches:
            removed, count, spans, kept, sizes = [], [], [], [], []
            for t, runs in zip(batch.column("__text").to_pylist(), batch.column("__list").to_pylist()):
                raw = t.encode()
                merged: list[list[int]] = []
                for a, b in sorted((r["first"], r["last"] + match) for r in runs):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                edges = [0, *(x for m in merged for x in m), len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[0::2], edges[1::2])))
                sizes.append(len(raw))
                removed.append(len(raw) - len(kept[-1]))
                count.append(len(merged))
                spans.append([{"start": a, "end": b} for a, b in merged])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in df_columns], pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(count, pa.int64()), pa.array(spans, spans_type), pa.array(kept, pa.binary())], [*df_columns, *names])

    df_columns = df.columns
    return whole.unionByName(touched.mapInArrow(cut, whole.schema))
