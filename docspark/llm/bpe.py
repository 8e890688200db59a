"""Byte-level BPE encoding by overlapping chunks, and decoding.

A text is cut into chunks that overlap.  Each chunk is pre-tokenised by itself,
in parallel; the scanner keeps no state, so two neighbouring scans that share a
boundary agree from there on.  The chunks are stitched at the first boundary
both scans have; where the overlap holds none, the scan goes on from the last
sure boundary.  The pieces between the boundaries are then encoded by the merge
ranks.  Decoding concatenates the raw bytes of the tokens.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docspark.llm.common import free_names, releasing, resident

# Characters a match may look at behind its end.
LOOKAHEAD = 4
CHUNK, OVERLAP = 1 << 15, 1 << 9
# Texts of more characters than this are dealt out chunk by chunk.
SPREAD = 1 << 16
CACHE_PIECES = 1 << 16


def boundaries(text: str, at: int, last: bool, scan) -> list[int]:
    """Absolute match ends of a scan of ``text`` (standing at ``at``) that no later character can change."""
    sure = len(text) + (0 if last else -LOOKAHEAD)
    return [at] + [at + e for e in (m.end() for m in scan(text)) if e <= sure]


def split_text(text: str, scan, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """Boundaries of all pieces of ``text``, found chunk by chunk and stitched."""
    n = len(text)
    bounds = boundaries(text[: chunk + overlap], 0, chunk + overlap >= n, scan)
    for start in range(chunk, n, chunk):
        stop = min(start + chunk + overlap, n)
        if bounds[-1] >= n:
            break
        mine = boundaries(text[start:stop], start, stop == n, scan)
        known = set(bounds[-(chunk + overlap):])
        meet = next((b for b in mine if b in known), None)
        if meet is None:  # no boundary shared in the overlap: go on from the last sure one
            mine = boundaries(text[bounds[-1]: stop], bounds[-1], stop == n, scan)
            meet = bounds[-1]
        while bounds and bounds[-1] >= meet:
            bounds.pop()
        bounds += [b for b in mine if b >= meet]
    return bounds


class Tokenizer:
    """Merge ranks of a ``.tiktoken`` file; pieces are cached up to a fixed number."""

    def __init__(self, path: str, pattern: str):
        self.pattern = regex.compile(pattern)
        # One match per piece: the pieces are cut before.
        merges = tiktoken.Encoding("pieces", pat_str=r"(?s:.+)", mergeable_ranks=load_ranks(path), special_tokens={})

        class Pieces(dict):
            def __missing__(self, piece: str) -> bytes:
                if len(self) >= CACHE_PIECES:
                    self.clear()
                ids = np.array(merges.encode_ordinary(piece), "<u4").tobytes()
                if len(piece) < 64:
                    self[piece] = ids
                return ids

        self.pieces = Pieces()

    def pieces_of(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[str]:
        if len(text) <= chunk + overlap:
            return self.pattern.findall(text)
        b = split_text(text, self.pattern.finditer, chunk, overlap)
        return [text[i:j] for i, j in zip(b, b[1:])]

    def encode(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.pieces.__getitem__, self.pieces_of(text, chunk, overlap)))


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def decoder(path: str):
    """Raw bytes of token ids; needs the vocabulary only, no merges."""
    return resident("bpe", ("decode", path), lambda: _decoder(path))


def _decoder(path: str):
    ranks = load_ranks(path)
    bytes_of = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        bytes_of[rank] = token
    return lambda ids: b"".join(map(bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def tokenizer(path: str, pattern: str) -> Tokenizer:
    return resident("bpe", ("encode", path, pattern), lambda: Tokenizer(path, pattern))


def _map_column(df: DataFrame, source: str, out: str, fn, check=None) -> DataFrame:
    """``df`` with a binary column ``out`` = ``fn()(value of source)``, computed in Arrow batches.

    With ``check``, also ``round_trip``: whether ``check()(out)`` gives the bytes of the source back.
    """
    names = df.columns
    added = [F.lit(b"").alias(out), *([F.lit(True).alias("round_trip")] if check else [])]
    schema = df.select(*[F.col(f"`{c}`") for c in names], *added).schema

    @releasing
    def run(batches):
        each, back = fn(), check() if check else None
        for batch in batches:
            given = batch.column(source).to_pylist()
            made = [each(v) for v in given]
            columns, title = [*batch.columns, pa.array(made, pa.binary())], [*names, out]
            if back:
                columns.append(pa.array([back(m) == (v or "").encode() for m, v in zip(made, given)], pa.bool_()))
                title.append("round_trip")
            yield pa.RecordBatch.from_arrays(columns, title)

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP,
           spread: int = SPREAD, keep_text: bool = True, verify: bool = False) -> DataFrame:
    """``df`` plus ``token_ids`` (binary, little-endian uint32) and ``n_tokens``.

    ``verify`` adds ``round_trip``: whether decoding the ids gives the text's
    bytes back (null: empty), in the same pass.

    A null or empty text has no tokens.  Repeated rows are encoded alike.  Texts
    above ``spread`` characters are dealt out as overlapping chunks, one row
    each, keyed by the text's digest: equal long texts are encoded once.  Input
    columns named like an output keep their values as ``<name>_in``.
    """
    df = free_names(df, ["token_ids", "n_tokens", *(["round_trip"] if verify else [])])
    ids = lambda t: t.withColumn("n_tokens", (F.octet_length("token_ids") / 4).cast("long"))
    size = F.coalesce(F.length(text), F.lit(0))
    short = _map_column(
        df.where(size <= spread), text, "token_ids",
        lambda: (lambda t, e=tokenizer(path, pattern): e.encode(t, chunk, overlap) if t else b""),
        (lambda: decoder(path)) if verify else None,
    )
    long = df.where(size > spread).withColumn("__k", F.sha2(F.col(text), 256))
    done = _encode_long(long.select("__k", F.col(text).alias("__t")).dropDuplicates(["__k"]), path, pattern, chunk, overlap)
    coded = long.join(done, "__k").drop("__k")
    out = ids(short.unionByName(round_trips(coded, path, text) if verify else coded))
    return out if keep_text else out.drop(text)


def _encode_long(texts: DataFrame, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(__k, __t) to (__k, token_ids): chunks scanned apart, stitched at shared boundaries, encoded apart."""
    n = F.length("__t")
    chunks = texts.select(
        "__k", n.alias("__n"), F.explode(F.sequence(F.lit(0), F.floor((n - 1) / chunk).cast("int"))).alias("__i"), "__t"
    ).select("__k", "__n", "__i", F.substring("__t", F.col("__i") * chunk + 1, F.lit(chunk + overlap)).alias("__c"))

    def scan(batches):
        find = tokenizer(path, pattern).pattern.finditer
        for batch in batches:
            head, tail = [], []
            for i, total, c in zip(*(batch.column(x).to_pylist() for x in ("__i", "__n", "__c"))):
                at = i * chunk
                b = boundaries(c, at, at + len(c) >= total, find)
                head.append([x for x in b if x < at + overlap])
                tail.append([x for x in b if x >= at + chunk])
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("__k"), batch.column("__n"), batch.column("__i"), batch.column("__c"),
                 pa.array(head, kind), pa.array(tail, kind)],
                ["__k", "__n", "__i", "__c", "__head", "__tail"],
            )

    scanned = chunks.repartition("__k", "__i").mapInArrow(
        scan, "__k string, __n int, __i int, __c string, __head array<int>, __tail array<int>"
    )
    w = Window.partitionBy("__k").orderBy("__i")
    met = scanned.withColumn("__lag", F.lag("__tail").over(w)).withColumn(
        "__from", F.when(F.col("__i") == 0, 0).otherwise(F.array_min(F.array_intersect("__head", "__lag")))
    )
    placed = met.withColumn("__to", F.coalesce(F.lead("__from").over(w), F.when(F.lead("__i").over(w).isNull(), F.col("__n")))).withColumn(
        "__ok", F.min((F.col("__from").isNotNull() & (F.col("__from") <= F.col("__to"))).cast("int")).over(Window.partitionBy("__k"))
    )

    def pieces(batches):
        e = tokenizer(path, pattern)
        for batch in batches:
            out = []
            for i, c, lo, hi, ok in zip(*(batch.column(x).to_pylist() for x in ("__i", "__c", "__from", "__to", "__ok"))):
                if not ok:
                    out.append(b"")
                    continue
                at = i * chunk
                # The scan starts at the chunk's first character, as before; only matches of this chunk's part count.
                b = [x for x in boundaries(c, at, True, e.pattern.finditer) if lo <= x <= hi]
                b = b if b and b[-1] == hi else [*b, hi]
                out.append(b"".join(e.pieces[c[p - at: q - at]] for p, q in zip(b, b[1:])))
            yield pa.RecordBatch.from_arrays([batch.column("__k"), batch.column("__i"), pa.array(out, pa.binary())], ["__k", "__i", "__ids"])

    coded = placed.where("__ok = 1").drop("__head", "__tail", "__lag").mapInArrow(pieces, "__k string, __i int, __ids binary")
    # A document is one row in the end; its chunks are gathered in order.
    joined = coded.groupBy("__k").agg(F.sort_array(F.collect_list(F.struct("__i", "__ids"))).alias("__p")).select(
        "__k", F.aggregate("__p", F.lit(b""), lambda a, x: F.concat(a, x["__ids"])).alias("token_ids")
    )
    # Texts in which some overlap has no shared boundary (a run longer than it) are scanned through.
    whole = texts.join(placed.where("__ok = 0").select("__k").distinct(), "__k", "left_semi")
    through = _map_column(
        whole, "__t", "token_ids", lambda: (lambda t, e=tokenizer(path, pattern): e.encode(t, chunk, overlap) if t else b"")
    ).drop("__t")
    return joined.unionByName(through)


def round_trips(df: DataFrame, path: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``df`` plus ``round_trip``, for rows that were encoded in chunks."""
    names = df.columns
    schema = df.select("*", F.lit(True).alias("round_trip")).schema

    @releasing
    def run(batches):
        to_bytes = decoder(path)
        for batch in batches:
            same = [to_bytes(i or b"") == (t or "").encode() for i, t in zip(batch.column(ids).to_pylist(), batch.column(text).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(same, pa.bool_())], [*names, "round_trip"])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "token_ids", drop_ids: bool = False) -> DataFrame:
    """``df`` plus ``decoded`` (binary); null ids decode to nothing."""
    df = free_names(df, ["decoded"])
    out = _map_column(df, ids, "decoded", lambda: (lambda b, d=decoder(path): d(b) if b else b""))
    return out.drop(ids) if drop_ids else out
