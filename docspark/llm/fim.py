"""Fill-in-the-middle rearrangement of documents by a piece table.

A document is a short list of descriptors ``(buffer, start, end)`` over two
immutable buffers: the text's UTF-8 bytes and the sentinels.  Cutting a
document splits the descriptor of its whole text in three, an arrangement
permutes the three and puts sentinel descriptors between them, and the inverse
permutation restores the order.  Texts are written or hashed by streaming the
descriptors; no intermediate string is built.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.common import free_names, releasing, text_bytes

SENTINELS = (b"<P>", b"<S>", b"<M>")
PREFIX, SUFFIX, MIDDLE = 0, 1, 2
# The pieces of a cut document are (prefix, suffix, middle), each led by its sentinel; forms are their order.
FORMS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
PLAIN = "plain"
TEXT, MARKS = 0, 1
_MARK_BUFFER = b"".join(SENTINELS)
_MARK_AT = np.cumsum([0, *map(len, SENTINELS)]).tolist()

Piece = tuple[int, int, int]


@dataclass(frozen=True)
class Rule:
    """Seed of the cuts, percentage of documents that are cut, and of those the percentage in form ``spm``."""

    seed: int = 7
    rate: int = 100
    spm: int = 50

    def draws(self, key: int | None) -> tuple[int, int, int, int]:
        """Four 32-bit numbers of a key: the leading 8-digit groups of a SHA-256 (a null key has no digits)."""
        h = hashlib.sha256(f"{self.seed}:{'' if key is None else key}".encode()).digest()
        return tuple(int.from_bytes(h[i: i + 4], "big") for i in (0, 4, 8, 12))


def cut(start: int, ends: np.ndarray, a: int, b: int) -> tuple[Piece, Piece, Piece]:
    """Split the descriptor of a text after its ``a``-th and ``b``-th unit: (prefix, suffix, middle)."""
    at = [start if k == 0 else int(ends[k - 1]) for k in (a, b, len(ends))]
    return (TEXT, start, at[0]), (TEXT, at[1], at[2]), (TEXT, at[0], at[1])


def arrange(pieces: tuple[Piece, Piece, Piece], form: str) -> list[Piece]:
    """Descriptors of the output: the pieces in the form's order, each behind its sentinel."""
    return [d for k in FORMS[form] for d in ((MARKS, _MARK_AT[k], _MARK_AT[k + 1]), pieces[k])]


def locate(output: memoryview, form: str) -> list[Piece]:
    """Descriptors of an output over its own bytes: the stretches behind the sentinels, in the form's order.

    A cut text holds no sentinel and none can arise across a seam, so the first
    one found is the one that was written.
    """
    raw, at, marks = bytes(output), 0, []
    for k in FORMS[form]:
        at = raw.index(SENTINELS[k], at)
        marks.append((at, at + len(SENTINELS[k])))
        at = marks[-1][1]
    return [(TEXT, e, s) for (_, e), (s, _) in zip(marks, [*marks[1:], (len(raw), 0)])]


def invert(pieces: list[Piece], form: str) -> list[Piece]:
    """Arranged pieces back in reading order: prefix, middle, suffix."""
    order = FORMS[form]
    return [pieces[order.index(k)] for k in (PREFIX, MIDDLE, SUFFIX)]


def stream(pieces: list[Piece], text: memoryview):
    """The bytes of the descriptors, one view after the other."""
    marks = memoryview(_MARK_BUFFER)
    for buffer, a, b in pieces:
        yield (marks if buffer == MARKS else text)[a:b]


def _digest(pieces: list[Piece], text: memoryview) -> str:
    h = hashlib.sha256()
    for part in stream(pieces, text):
        h.update(part)
    return h.hexdigest()


def _written(tables: list[list[Piece]], text: memoryview) -> pa.Array:
    """The texts of all piece tables as one Arrow column."""
    sizes = [sum(b - a for _, a, b in t) for t in tables]
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]) if sizes else np.zeros(1, np.int64)
    data = b"".join(part for t in tables for part in stream(t, text))
    return pa.LargeStringArray.from_buffers(len(tables), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def _tables(data: np.ndarray, offs: np.ndarray, keys: list, rule: Rule):
    """Per text: number of lines, form, output descriptors, code points of prefix and middle (None if plain)."""
    line_ends = np.flatnonzero(data == 10) + 1
    raw = data.tobytes()
    held = np.zeros(len(offs) - 1, bool)
    for mark in SENTINELS:
        at = raw.find(mark)
        while at >= 0:
            owner = int(np.searchsorted(offs, at, "right")) - 1
            held[owner] |= at + len(mark) <= offs[owner + 1]
            at = raw.find(mark, at + 1)
    lo, hi = np.searchsorted(line_ends, offs[:-1], "right"), np.searchsorted(line_ends, offs[1:], "right")
    for i, key in enumerate(keys):
        start, end = int(offs[i]), int(offs[i + 1])
        ends = line_ends[lo[i]: hi[i]]
        if end > start and (not len(ends) or ends[-1] != end):
            ends = np.append(ends, end)
        n = len(ends)
        h1, h2, h3, h4 = rule.draws(key)
        if not n or held[i] or h3 % 100 >= rule.rate:
            yield n, PLAIN, [(TEXT, start, end)], None, None
            continue
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        pieces = cut(start, ends, a, b)
        form = "spm" if h4 % 100 < rule.spm else "psm"
        chars = [int(np.count_nonzero((data[a:b] & 0xC0) != 0x80)) for _, a, b in (pieces[PREFIX], pieces[MIDDLE])]
        yield n, form, arrange(pieces, form), *chars


OUTS = ["n_lines", "form", "prefix_chars", "middle_chars", "output_sha256", "fim_text"]


def transform(df: DataFrame, key: str = "doc_id", text: str = "text", rule: Rule = Rule()) -> DataFrame:
    """``df`` plus ``n_lines form prefix_chars middle_chars output_sha256 fim_text``.

    The text is cut after two of its lines, drawn from the integer key, and
    becomes ``<P>prefix<S>suffix<M>middle`` (psm) or ``<S>suffix<P>prefix<M>middle``
    (spm).  Texts that are null (as empty), empty, hold a sentinel or fall
    outside ``rule.rate`` are plain: unchanged, lengths null.  Equal rows give
    equal rows; a text of any length is one row.  Input columns named like an
    output keep their values as ``<name>_in``.
    """
    df = free_names(df, OUTS)
    names = df.columns
    long, string = F.lit(None).cast("long"), F.lit(None).cast("string")
    schema = df.select(
        "*", F.lit(0).cast("long").alias("n_lines"), F.lit("").alias("form"), long.alias("prefix_chars"),
        long.alias("middle_chars"), string.alias("output_sha256"), string.alias("fim_text")).schema

    @releasing
    def run(batches):
        for batch in batches:
            data, offs = text_bytes(batch.column(text))
            keys = batch.column(key).to_pylist()
            rows = list(_tables(data, offs, keys, rule))
            n, form, tables, prefix, middle = zip(*rows) if rows else ((),) * 5
            view = memoryview(data)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array([_digest(t, view) for t in tables], pa.string()), _written(list(tables), view)],
                [*names, *OUTS])

    return df.mapInArrow(run, schema)


def restore(df: DataFrame, output: str = "fim_text", form: str = "form", keep_text: bool = True) -> DataFrame:
    """``df`` plus ``restored_text`` (if wanted) and ``restored_sha256``, from the output text and its form alone.

    A null output is an empty text; a null form, or one that is not an
    arrangement, means a plain text.  An output without the sentinels of its
    form raises an error.
    """
    outs = ["restored_text", "restored_sha256"] if keep_text else ["restored_sha256"]
    df = free_names(df, outs)
    names = df.columns
    schema = df.select("*", *[F.lit(None).cast("string").alias(c) for c in outs]).schema

    @releasing
    def run(batches):
        for batch in batches:
            data, offs = text_bytes(batch.column(output))
            view = memoryview(data)
            tables = []
            for f, a, b in zip(batch.column(form).to_pylist(), offs.tolist(), offs[1:].tolist()):
                if f not in FORMS:
                    tables.append([(TEXT, a, b)])
                    continue
                tables.append([(TEXT, a + s, a + e) for _, s, e in invert(locate(view[a:b], f), f)])
            digests = pa.array([_digest(t, view) for t in tables], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *([_written(tables, view)] if keep_text else []), digests], [*names, *outs])

    return df.mapInArrow(run, schema)
