"""Benchmark decontamination by one Aho-Corasick automaton.

Benchmark items are normalised to words and cut into windows of ``window``
consecutive words (an item of fewer words is one window). All windows form one
automaton, built once per Python worker; every text is normalised and scanned
once, and hits are mapped back to words and code points of the original.

The windows are broadcast only within PATTERN_BYTES; a larger benchmark is cut
into parts of that size, and the texts pass one automaton after another with
their hits carried along in a stored table. The driver and a worker hold one
part at a time, so memory stays bounded and no window is left out.

Defined results: a null text or item has no words; an item of no words has no
window; a null item_id counts as an item named by the empty string; repeated
items of one id are one item; repeated rows are scanned each; empty tables
give no rows, or no hits; other columns are ignored by :func:`scan` and kept by
:func:`drop_contaminated`.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.llm.store import stored

#: Bytes of windows that one broadcast may hold.
PATTERN_BYTES = 32 << 20
#: Every byte of UTF-8 that is part of a word stays, all others separate (ASCII letters lower-cased).
_FOLD = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
RESULT = "n_words long, n_hit long, items array<string>, hit_words array<struct<start:long,end:long>>, hit_chars array<struct<start:long,end:long>>"


def normal(text: str | None) -> list[bytes]:
    """Words: runs of ASCII letters, digits and non-ASCII characters."""
    return (text or "").encode().lower().translate(_FOLD).split()


def windows(benchmark: DataFrame, window: int) -> DataFrame:
    """Distinct ``(pattern, item)``: the words of each window with one space around each, as hex."""

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = {"pattern": [], "item": []}
            for item, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words = normal(text)
                for i in range(max(1, len(words) - window + 1) if words else 0):
                    out["pattern"].append(b" " + b" ".join(words[i : i + window]) + b" ")
                    out["item"].append(item or "")
            yield pa.RecordBatch.from_pydict(out, pa.schema([("pattern", pa.binary()), ("item", pa.string())]))

    small = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    return small.mapInArrow(cut, "pattern binary, item string").distinct()


_BUILT: dict[str, object] = {}


def automaton(shared) -> object:
    """The automaton of a broadcast (key, list of (pattern, items)); a worker keeps the last one built."""
    key, patterns = shared.value
    if key not in _BUILT:
        import ahocorasick

        _BUILT.clear()
        made = ahocorasick.Automaton()
        for pattern, items in patterns:
            made.add_word(pattern.decode("latin-1"), (len(pattern), items))
        if len(made):
            made.make_automaton()
        _BUILT[key] = made
    return _BUILT[key]


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def find_hits(made, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
    """Word ranges inside an occurrence of a window, and the items of those windows."""
    line = " " + b" ".join(words).decode("latin-1") + " "
    spans, items = [], set()
    starts = None
    for end, (length, of) in made.iter(line):
        if starts is None:
            starts = np.cumsum([1] + [len(w) + 1 for w in words])  # place of each word, and past the last
        first, past = np.searchsorted(starts, (end - length + 2, end + 1))
        spans.append((int(first), int(past)))
        items.update(of)
    return _merge(spans), items


def parts_of(patterns: DataFrame) -> Iterator[tuple[bool, list[tuple[bytes, list[str]]]]]:
    """Lists of (pattern, items) of at most PATTERN_BYTES each, read one after the other, and whether it is the last."""
    grouped = patterns.groupBy("pattern").agg(F.sort_array(F.collect_set("item")).alias("items"))
    total = grouped.agg(F.sum(F.length("pattern") + F.length(F.concat_ws(",", "items")))).first()[0] or 0
    n = max(1, -(-2 * total // PATTERN_BYTES))
    if n > 1:
        grouped = stored(grouped, "patterns")
    for k in range(n):
        mine = grouped if n == 1 else grouped.filter(F.pmod(F.xxhash64("pattern"), F.lit(n)) == k)
        yield k == n - 1, [(bytes(r["pattern"]), r["items"]) for r in mine.collect()]


def scan(docs: DataFrame, benchmark: DataFrame, window: int = 10, carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (doc_id), then the columns of RESULT, per document."""
    spark = docs.sparkSession
    carry = ["doc_id"] if carry is None else carry
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in carry)).alias("row"), F.col("text").cast("string").alias("text"), F.lit(None).cast("struct<items:array<string>,spans:array<struct<start:long,end:long>>>").alias("hits"))
    schema = rows.schema
    found = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    hits_type = pa.struct([("items", pa.list_(pa.string())), ("spans", found)])
    pairs = lambda spans: [{"start": s, "end": e} for s, e in spans]

    def chars(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
        places = [m.span() for m in _WORD.finditer("".join(c.lower() if "A" <= c <= "Z" else c for c in text))]
        return [(places[s][0], places[e - 1][1]) for s, e in spans]

    def hits_of(part: pa.RecordBatch, made) -> Iterator[tuple[str | None, int, list, list]]:
        for text, old in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
            words = normal(text)
            spans, items = find_hits(made, words) if len(made) else ([], set())
            if old:
                spans, items = _merge(spans + [(x["start"], x["end"]) for x in old["spans"]]), items | set(old["items"])
            yield text, len(words), spans, sorted(items)

    def passing(shared):
        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                out = [{"items": items, "spans": pairs(spans)} if spans else None for _, _, spans, items in hits_of(part, automaton(shared))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, hits_type)], ["row", "text", "hits"])

        return run

    def last(shared):
        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                n, hit, items, words, places = [], [], [], [], []
                for text, n_words, spans, of in hits_of(part, automaton(shared)):
                    n.append(n_words)
                    hit.append(sum(e - s for s, e in spans))
                    items.append(of)
                    words.append(pairs(spans))
                    places.append(pairs(chars(text, spans)) if spans else [])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(hit, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(words, found), pa.array(places, found)],
                    ["row", "n_words", "n_hit", "items", "hit_words", "hit_chars"],
                )

        return run

    for is_last, part in parts_of(windows(benchmark, window)):
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, part))
        if not is_last:
            # the hits of a pass are written, so that its automaton can go before the next part is read
            rows = stored(rows.mapInArrow(passing(shared), schema), "hits")
            shared.destroy()
    done = rows.mapInArrow(last(shared), f"row {schema['row'].dataType.simpleString()}, {RESULT}")
    return done.select("row.*", *(c for c in done.columns if c != "row"))


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents without any hit, with their columns."""
    renamed = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)), F.col("text"))
    found = scan(renamed, benchmark, window, carry=[f"c{i}" for i in range(len(docs.columns))])
    return found.filter("n_hit = 0").select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))
