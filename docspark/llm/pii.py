"""Personal data with offsets, also behind homoglyphs, spelled digits and at/dot disguises.

Base identifiers are found in the text as it stands.  Then a transducer rewrites
disguised passages (homoglyphs to ASCII, spelled digits to digits, at/dot
disguises to the signs) and keeps for each written character the source span it
came from; identifiers found in the rewritten text are mapped back through
those spans to source characters.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.common import free_names

KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"

# A run of digits never starts inside a match, and where its first digit fails
# every later one fails too: the look-behind and possessive forms find the same
# spans in linear time.
AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    out, free = [], 0
    for m in AT.finditer(text):
        at = m.start()
        lo = max(free, text.rfind("@", free, at) + 1)
        start = at - 1
        while start >= lo and text[start] in LOCAL:
            start -= 1
        if start + 1 < at:
            out.append((start + 1, m.end()))
            free = m.end()
    return out


def find(text: str) -> list[list[tuple[int, int]]]:
    """Spans by kind (email, ip, card, phone) of the plain identifiers of ``text``."""
    out = [emails(text) if "@" in text else [], [], [], []]
    if DIGITS.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
                out[1].append(m.span())
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = m.group().replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out[2].append(m.span())
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out[3].append(m.span())
    return out


# Characters that look like ASCII ones, by script.
HOMOGLYPHS = dict(zip("авеикмнорстухіјѕԁһԛԝ", "aBeukMHopcTyxijsdhqw")) | dict(zip("аеорсухіјѕ", "aeopcyxijs")) | dict(
    zip("АВЕКМНОРСТУХІЈЅ", "ABEKMHOPCTYXIJS")) | dict(zip("αενορτυχικ", "aevoptuxik")) | dict(
    zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ABEZHIKMNOPTYX"))
HOMOGLYPHS |= {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)}  # full-width forms
HOMOGLYPHS |= {chr(base + i): chr(48 + i) for base in (0x660, 0x6F0, 0x966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6) for i in range(10)}
HOMOGLYPHS |= {chr(base + i): chr(first + i) for base in range(0x1D400, 0x1D6A4, 52) for first, base in ((65, base), (97, base + 26)) for i in range(26)}
HOMOGLYPHS |= {"。": ".", "․": ".", "﹒": ".", "﹫": "@", "‐": "-", "‑": "-", "‒": "-",
               "–": "-", "−": "-", " ": " ", " ": " ", " ": " ", "﹢": "+"}
# Characters without width, written as nothing.
INVISIBLE = "­​‌‍⁠﻿"

SPELLED = {w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())} | {"oh": "0"}
NUMBER = "(?:zero|one|two|three|four|five|six|seven|eight|nine|oh)"
# A signed or bracketed at/dot; plain words count only in the shape of an address.
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_WORD = r"(?:at|AT|At)"
_DOT = r"(?:dot|DOT|Dot)"
# Last labels that count in any form; elsewhere the dot in words, or an "@" with blanks, is sign enough.
TOP = "com org net edu gov mil int info biz io co uk de fr es it nl eu us ca au ch at be jp cn in ru br"
_TOPS = frozenset(TOP.split())
_BRACKET = re.compile(rf"[ ]?{_OPEN}[ ]?(?:(?P<at>{_WORD}|@)|(?P<dot>{_DOT}|\.))[ ]?{_CLOSE}[ ]?")
# Found from the sign outwards: the part before it is read backwards, so that no run of words is scanned twice.
_PLAIN = re.compile(
    rf"(?P<at> {_WORD} |[ ]?@[ ]?)"
    rf"(?P<domain>[A-Za-z0-9-]+(?:(?:\.| {_DOT} )[A-Za-z0-9-]+)*(?:\.| {_DOT} )[A-Za-z]{{2,}}(?![\w-]))")
_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_%+-")
_SPOKEN_DOTS = (" dot ", " DOT ", " Dot ")
_LABEL = re.compile(rf"(?P<sign>\.| {_DOT} )(?P<label>[A-Za-z0-9-]+)")
# Words that prose has before "dot": "at the dot in the middle", "at one dot two".
_PROSE = re.compile(rf"(?:the|an?|this|that|each|every|any|no|some|my|your|his|her|its|our|their|polka|{NUMBER})", re.I)
_PLAIN_HINT = re.compile(rf" {_WORD} [^ \n]+ {_DOT} |@[ ]| @| {_DOT} ")
_PLAIN_SIGN = re.compile(rf" {_DOT} | {_WORD} |[ ]?@[ ]?")
_SPELLED_RUN = re.compile(
    rf"(?<!\w)(?:plus[ -]+)?(?:{NUMBER}|[0-9]+)(?:(?:[ ,.-]+|[ ]dot[ ]|[ ]point[ ])(?:{NUMBER}|[0-9]+)(?!\w))+", re.I)
_SPELLED_WORD = re.compile(rf"(?:(?P<dot>[ ](?:dot|point)[ ])|(?P<plus>plus[ -]+)|(?P<num>{NUMBER}(?!\w))|(?P<gap>[ ,-]+))", re.I)
# Marks of the characters that are rewritten, by code point.
_STRANGE = np.zeros(0x110000, bool)
_STRANGE[[ord(c) for c in [*HOMOGLYPHS, *INVISIBLE]]] = True
# A run of spelled digits holds one of these: a plain search before the pattern.
_HINT_WORDS = ("zero", "two", "three", "four", "five", "six", "seven", "eight", "nine", "one one", "one-one", "one,one", "one, one",
               "one.one", "one. one", "one  one", "one oh", "oh one", "oh oh", "one dot one", "one point one")
_SPELLED_HINT = re.compile(rf"{NUMBER}(?:[ ,.-]+|[ ]dot[ ]|[ ]point[ ]){NUMBER}", re.I)


class Mapped:
    """A rewritten text; ``starts[i]`` and ``ends[i]`` are the source span of its character i."""

    def __init__(self, text: str):
        self.text, self.edits = text, []

    def apply(self, edits: list[tuple[int, int, str]]) -> "Mapped":
        """Replace spans (start, end, new) of the current text, sorted and apart."""
        if not edits:
            return self
        out, at, here = [], 0, []
        shift = 0
        for s, e, new in edits:
            out += [self.text[at:s], new]
            here.append((s + shift, s + shift + len(new), s, e))
            shift += len(new) - (e - s)
            at = e
        out.append(self.text[at:])
        self.text = "".join(out)
        self.edits.append(here)
        return self

    def _back(self, pos: int, end: bool) -> int:
        for layer in reversed(self.edits):
            # The last edit that starts before pos (for an end: before its last character).
            i = bisect_left(layer, (pos if end else pos + 1,)) - 1
            if i >= 0:
                lo, hi, s, e = layer[i]
                if pos < hi or end and pos == hi:
                    pos = e if end else s
                    continue
                pos += e - hi
        return pos

    def span(self, start: int, end: int) -> tuple[int, int]:
        return self._back(start, False), self._back(end, True)


def _spelled(m: re.Match, at: int) -> list[tuple[int, int, str]]:
    """Edits of one run of spelled digits: words become digits, blanks between them go."""
    out = []
    for w in _SPELLED_WORD.finditer(m.group()):
        new = "." if w["dot"] else "+" if w["plus"] else SPELLED[w["num"].lower()] if w["num"] else ""
        out.append((at + w.start(), at + w.end(), new))
    return out


def _local_start(text: str, low: int, end: int) -> int | None:
    """Where the part of an address that ends at ``end`` begins: the leftmost start from ``low`` on that is not inside a word."""
    start, i = None, end
    while True:
        j = i
        while j > low and text[j - 1] in _PART:
            j -= 1
        if j == i:
            return start
        before = text[j - 1: j]
        if not (before.isalnum() or before in ("_", ".", "%", "+", "-")):
            start = j
        if j > low and before == ".":
            i = j - 1
        elif j - 5 >= low and text[j - 5: j] in _SPOKEN_DOTS:
            i = j - 5
        else:
            return start


def _address_end(x: re.Match, start: int) -> int | None:
    """Where the address of a plain match ends: after its last label that can be a top-level domain; None if none can."""
    signs = list(_LABEL.finditer(x.string, x.start("domain"), x.end("domain")))
    spoken = x["at"].strip() != "@"
    # "look at example.com" is prose: the word "at" counts only with a dot in words too.
    words = [" " in y["sign"] for y in signs]
    least = 0
    if spoken and " dot " not in x.string[start: x.start("at")].lower():
        least = words.index(True) if True in words else len(words)
    for i in range(len(signs) - 1, least - 1, -1):
        label = signs[i]["label"]
        if not (label.isalpha() and len(label) > 1):
            continue
        if label.lower() in _TOPS:
            return signs[i].end()
        before = signs[i - 1]["label"] if i else x.string[x.start("domain"): signs[0].start()]
        if words[i]:
            if not _PROSE.fullmatch(before):
                return signs[i].end()
        elif x["at"] == "@" or label.islower() or label.isupper():  # "@ noon.Then": a new sentence
            return signs[i].end()
    return None


def rewrite(text: str) -> Mapped | None:
    """The rewritten text, or None if nothing is disguised."""
    m = Mapped(text)
    if not text.isascii():
        at = np.flatnonzero(_STRANGE[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)])
        m.apply([(i, i + 1, HOMOGLYPHS.get(text[i], "")) for i in at.tolist()])
    low = m.text
    if "[" in low or "(" in low or "{" in low or "<" in low:
        m.apply([(x.start(), x.end(), "@" if x["at"] else ".") for x in _BRACKET.finditer(m.text)])
    small = m.text.lower()
    if any(w in small for w in _HINT_WORDS) and _SPELLED_HINT.search(m.text):
        edits = []
        for x in _SPELLED_RUN.finditer(m.text):
            words = re.findall(NUMBER, x.group(), re.I)
            if len(words) >= 3:
                edits += _spelled(x, x.start())
        m.apply(edits)
    if _PLAIN_HINT.search(m.text):
        edits, low, at = [], 0, 0
        while x := _PLAIN.search(m.text, at):
            base = _local_start(m.text, low, x.start())
            if base is None:
                at = x.start() + 1
                continue
            end = _address_end(x, base)
            if end is None:
                low = at = x.start("domain")  # it may be the local part of another
                continue
            low = at = end
            for y in _PLAIN_SIGN.finditer(m.text[base:end]):
                sign = "@" if x.start("at") == base + y.start() else "." if "dot" in y.group().lower() else None
                if sign:
                    edits.append((base + y.start(), base + y.end(), sign))
        m.apply(edits)
    return m if m.edits else None


def detect(text: str | None) -> tuple[list[list[tuple[int, int]]], list[list[tuple[int, int]]]]:
    """Base spans and all spans by kind, in code points of the source, end exclusive."""
    if not text:
        return [[] for _ in KINDS], [[] for _ in KINDS]
    base = find(text)
    mapped = rewrite(text)
    if mapped is None:
        return base, base
    every = []
    for own, found in zip(base, find(mapped.text)):
        more = set()
        for s, e in found:
            a, b = mapped.span(s, e)
            if all(b <= x or y <= a for x, y in own):  # base ones stay as they are
                more.add((a, b))
        every.append(sorted([*own, *more]))
    return base, every


def _joined(spans: list[list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for kind, found in zip(KINDS, spans) for s, e in found)


def find_pii(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` plus ``n_email n_ip n_card n_phone`` (base spans), ``base_spans`` and ``spans`` (all, ``kind:start:end``).

    Null and empty texts have none; repeated rows are treated alike; input
    columns named like an output keep their values as ``<name>_in``.
    """
    outs = [*(f"n_{k}" for k in KINDS), "base_spans", "spans"]
    df = free_names(df, outs)
    names = df.columns
    schema = df.select(
        "*", *[F.lit(0).cast("long").alias(c) for c in outs[:4]], *[F.lit("").alias(c) for c in outs[4:]]
    ).schema

    def run(batches):
        for batch in batches:
            base, every = zip(*map(detect, batch.column(text).to_pylist())) if batch.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array([len(b[k]) for b in base], pa.int64()) for k in range(4)],
                 pa.array([_joined(b) for b in base], pa.string()), pa.array([_joined(e) for e in every], pa.string())],
                [*names, *outs])

    return df.mapInArrow(run, schema)
