"""Secrets in texts: fixed patterns, and strings of high entropy.

The base is three patterns with a least length. Beyond it, a candidate string
is a run of the characters of one class, at least one window long. A window of
the class's width slides along it; the Shannon entropy of the window follows
from the counts of its characters, of which a step changes two, so a run of any
length takes time in proportion. Windows of at least the class's bits join to
spans. Classes are tried from narrow to wide, and a span inside an earlier one,
of the base too, is not named again.

The allow-list suppresses candidates: a run, or a span in it, that as a whole
is words and numbers joined by marks, a UUID, a stated checksum or part of an
alphabet is no secret. It never suppresses the base.

Entropies are compared in whole numbers, so that counting on is the same as
counting anew.

Defined results: a null text is an empty one and has no spans; texts are
scanned whole; repeated rows are scanned each; an empty table gives no rows;
other columns are ignored. Offsets count code points from 0, the end is
exclusive. Equal starts are ordered by kind as listed in ``KINDS``.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base: pattern, the group whose length counts, its least length, and what a text must hold for a try (fixed values).
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # the runs of [0-9a-f]+ that have 16 characters
_KEYWORDS = ("passw", "secret", "token", "api")
ASSIGN_LENGTH, ACCESS_LENGTH = 12, 18


@dataclass(frozen=True)
class CharClass:
    """Runs of ``alphabet``, as in a pattern's brackets, in which a window of ``width`` characters has at least ``bits`` of entropy."""

    kind: str
    alphabet: str
    width: int
    bits: float



#: From narrow to wide. Prose and identifiers have less in a window of this width; random strings nearly always have more.
CLASSES = (
    CharClass("random_hex", "0-9A-Fa-f", 20, 2.85),
    CharClass("random_lower", "0-9a-z", 22, 3.55),
    CharClass("random_base64", r"A-Za-z0-9+/_=\-", 24, 3.95),
)
BASE = ("assign", "access", "hex")
KINDS = (*BASE, *(c.kind for c in CLASSES))

_SEGMENT = r"(?:[A-Za-z]++[0-9]{0,4}+|[0-9]++)"
#: What is no secret, whatever its entropy; each must match a whole candidate.
ALLOWED = (
    rf"[+/_=-]*+{_SEGMENT}(?:[+/_=-]++{_SEGMENT})*+[+/_=-]*+",  # words, with up to four digits behind, and numbers, joined by marks
    r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",  # UUID
    r"(?:sha(?:1|256|384|512)|md5)[-_=].*+",  # a stated checksum
)
#: Parts of these, of either case and end to end, are no secrets.
ALPHABETS = ("abcdefghijklmnopqrstuvwxyz0123456789+/", "0123456789abcdefghijklmnopqrstuvwxyz", "qwertyuiopasdfghjklzxcvbnm1234567890")

_UNIT = 1 << 20


def _share(count: int) -> int:
    return round(count * math.log2(count) * _UNIT) if count else 0


def windows(run: str, width: int, bits: float) -> Iterator[tuple[int, int]]:
    """(start, entropy sum) of the windows of ``run`` with at least ``bits``; the sum of c log2 c is kept, lower is more random."""
    shares = [_share(c) for c in range(width + 1)]
    most = math.floor(width * (math.log2(width) - bits) * _UNIT)
    counts: dict[str, int] = {}
    total = 0
    for i, c in enumerate(run):
        if i >= width:
            old = run[i - width]
            n = counts[old]
            total -= shares[n] - shares[n - 1]
            counts[old] = n - 1
        n = counts.get(c, 0)
        total += shares[n + 1] - shares[n]
        counts[c] = n + 1
        if i >= width - 1 and total <= most:
            yield i - width + 1, total


def entropy(total: int, width: int) -> float:
    return math.log2(width) - total / (width * _UNIT)


def spans_of(run: str, width: int, bits: float) -> list[tuple[int, int, float]]:
    """Unions of overlapping windows of ``run``, each with its highest entropy."""
    out: list[list] = []
    for start, total in windows(run, width, bits):
        if out and start <= out[-1][1]:
            out[-1][1], out[-1][2] = start + width, min(out[-1][2], total)
        else:
            out.append([start, start + width, total])
    return [(s, e, entropy(t, width)) for s, e, t in out]


class Allow:
    """The allow-list: patterns for whole candidates, and alphabets whose parts are no secrets."""

    def __init__(self, patterns=ALLOWED, alphabets=ALPHABETS):
        self.pattern = re.compile("|".join(f"(?:{p})" for p in patterns), re.DOTALL) if patterns else None
        self.alphabets = [a * 2 for a in alphabets]

    def __call__(self, text: str) -> bool:
        if self.pattern is not None and self.pattern.fullmatch(text):
            return True
        low = text.lower()
        return any(low in a for a in self.alphabets if len(low) <= len(a))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, leftmost first and without overlap in a kind."""
    out = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        out += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    out += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return out


def new_spans(found: list, known: list) -> list:
    """Those of ``found`` that lie inside no span of ``known``."""
    known = sorted(k[:2] for k in known)
    starts, reach = [k[0] for k in known], list(accumulate((k[1] for k in known), max))

    def outside(s) -> bool:
        before = bisect_right(starts, s[0])
        return not before or reach[before - 1] < s[1]

    return [s for s in found if outside(s)]


class Scanner:
    """Spans of a text: the base, and the runs of each class that the allow-list lets through."""

    def __init__(self, classes=CLASSES, allow: Allow | None = None):
        self.allow = allow or Allow()
        self.classes = [(c, re.compile(f"[{c.alphabet}]{{{c.width},}}")) for c in classes]
        # candidates of all classes lie in runs of all their characters
        together = "".join(c.alphabet for c in classes)
        self.wide = re.compile(f"[{together}]{{{min(c.width for c in classes)},}}") if classes else None

    def __call__(self, text: str) -> tuple[list[tuple[int, int, str, float | None]], int]:
        """(start, end, kind, bits) in order, and the number of candidates that were suppressed."""
        spans, suppressed = [(*s, None) for s in base_spans(text)], 0
        wide = [(m.start(), m.group()) for m in self.wide.finditer(text)] if self.wide else []
        for c, runs in self.classes:
            found = []
            for at, part in wide:
                for m in runs.finditer(part):
                    if self.allow(m.group()):
                        suppressed += 1
                        continue
                    for s, e, bits in spans_of(m.group(), c.width, c.bits):
                        if self.allow(m.group()[s:e]):
                            suppressed += 1
                        else:
                            found.append((at + m.start() + s, at + m.start() + e, c.kind, bits))
            spans += new_spans(found, spans)
        rank = {k: i for i, k in enumerate((*BASE, *(c.kind for c, _ in self.classes)))}
        return sorted(spans, key=lambda s: (s[0], rank[s[2]], s[1])), suppressed


SPAN = "struct<kind:string,start:bigint,end:bigint,bits:double>"


def find(docs: DataFrame, classes=CLASSES, allow: Allow | None = None) -> DataFrame:
    """``doc_id``, its spans in order with the entropy of those beyond the base, and the candidates that the allow-list suppressed."""
    small = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("bits", pa.float64())]))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(classes, allow)
        for part in parts:
            spans, suppressed = [], []
            for text in part.column(1):
                found, n = scan(text.as_py() or "")
                spans.append([{"kind": k, "start": s, "end": e, "bits": b} for s, e, k, b in found])
                suppressed.append(n)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, span_type), pa.array(suppressed, pa.int64())], ["doc_id", "spans", "n_allowed"])

    return small.mapInArrow(run, f"doc_id {small.schema['doc_id'].dataType.simpleString()}, spans array<{SPAN}>, n_allowed long")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """Counts and spans per document."""
    spans = F.col("spans")
    of = lambda *kinds: F.filter(spans, lambda s: s["kind"].isin(*kinds))
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return find(docs).select("doc_id", *counts, F.sha2(_listed(of(*BASE)), 256).alias("base_sha256"), _listed(spans).alias("spans"), "n_allowed")
