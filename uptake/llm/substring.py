"""Substring deduplication: seed and extend.

Seeds are winnowed anchors: hashes of ``SEED`` words, of which every stretch of
``window - SEED + 1`` neighbours keeps its smallest. Two equal windows of
``window`` words hold the same anchor at the same place, so a repeat cannot
hide between the seeds. Documents meet on anchors that occur twice or more;
around each such anchor the match is extended to the left and to the right to
the full windows that hold it, windows with equal words meet again, and runs
of repeated windows are the maximal repeats.

Both meetings go through :mod:`uptake.llm.batches`: a group of copies costs one
entry per batch of documents, never a pair of documents. Words and windows are
compared by 64-bit hashes; a window among n others is taken for a repeat by
mistake with odds of about n / 2^64.

Defined results: a null text has no words; a text of fewer than ``window``
words is kept whole; every copy of a repeat is removed, the first as well;
repeated rows are copies of each other; texts are compared whole; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from uptake.llm.batches import ASK, ASK_ARROW, answers, ask, ask_rows, bucket_count, text_batches, texts_of, totals
from uptake.llm.store import stored
from uptake.llm.words import Index, gram_hashes, mix, sliding_min, word_hashes

SEED = 20
BATCH_BYTES = 4 << 20
RESULT = "doc_id long, n_words long, n_removed long, kept string, repeats array<struct<start:long,end:long>>"


class Windows:
    """Words, seeds and windows of all texts of a batch."""

    def __init__(self, texts: list[bytes], window: int):
        self.words = [t.split() for t in texts]
        self.lengths = np.fromiter(map(len, self.words), np.int64, len(texts))
        self.begins = np.cumsum(self.lengths) - self.lengths
        index = Index()
        numbers = [index.number(w) for w in self.words]
        hashes = word_hashes(index)
        flat = hashes[np.concatenate(numbers)] if index else np.empty(0, np.uint64)
        n = len(flat)
        #: a window starts here: it ends within its own document
        left = np.repeat(self.begins + self.lengths, self.lengths) - np.arange(n)
        self.whole = left >= window
        seeds = mix(gram_hashes(flat, min(SEED, window)))
        self.seeds = np.append(seeds, np.zeros(n - len(seeds), np.uint64))
        smallest = sliding_min(seeds, window - min(SEED, window) + 1)
        #: anchor of the window that starts at each word
        self.anchor = np.append(smallest, np.zeros(n - len(smallest), np.uint64))
        self.window = window
        self.flat = flat

    def anchors(self) -> np.ndarray:
        """Every place of every kept anchor, as hashes: places of the smallest seed of some window."""
        starts = np.flatnonzero(self.whole)
        kept = np.zeros(len(self.flat), bool)
        for j in range(self.window - min(SEED, self.window) + 1):
            kept[starts[self.seeds[starts + j] == self.anchor[starts]] + j] = True
        return self.seeds[kept]

    def extended(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows around the ``shared`` anchors (sorted)."""
        starts = np.flatnonzero(self.whole)
        at = np.searchsorted(shared, self.anchor[starts])
        near = shared[np.minimum(at, len(shared) - 1)] == self.anchor[starts] if len(shared) else np.zeros(len(starts), bool)
        starts = starts[near]
        return starts, mix(gram_hashes(self.flat, self.window))[starts] if len(starts) else np.empty(0, np.uint64)


def _counted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.unique(hashes, return_counts=True)
    return keys, counts.astype(np.uint32)


def repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """Per document its words, removed words, kept words joined by one space, and maximal repeats as word ranges."""
    batches = text_batches(docs, BATCH_BYTES, "texts")
    buckets = bucket_count(batches)

    def seeds(row: pa.RecordBatch) -> Iterator[list[dict]]:
        keys, counts = _counted(Windows(texts_of(row), window).anchors())
        yield ask_rows(row.column(0)[0].as_py(), 0, keys, counts, buckets)

    anchors = stored(totals(ask(batches, seeds)), "anchors")

    def shared(w: Windows, replies: pa.Table) -> np.ndarray:
        keys, _ = _counted(w.anchors())
        return keys[answers(replies)[0] > 1] if len(keys) else keys

    def extend(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for k in range(left.num_rows):
            w = Windows(texts_of(left, k), window)
            keys, counts = _counted(w.extended(shared(w, right))[1])
            out += ask_rows(left.column("batch")[k].as_py(), 1, keys, counts, buckets)
        return pa.Table.from_pylist(out, ASK_ARROW)

    asked = batches.groupBy("batch").cogroup(anchors.groupBy("batch")).applyInArrow(extend, ASK)
    both = anchors.unionByName(totals(asked))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"doc_id": [], "n_words": [], "n_removed": [], "kept": [], "repeats": []}
        for k in range(left.num_rows):
            w = Windows(texts_of(left, k), window)
            starts, hashes = w.extended(shared(w, right))
            change = np.zeros(len(w.flat) + 1, np.int64)
            if len(starts):
                keys, at = np.unique(hashes, return_inverse=True)
                again = starts[answers(right)[1][at] > 1]
                change[again] += 1
                np.subtract.at(change, again + window, 1)
            gone = np.cumsum(change)[:-1] > 0
            for doc_id, words, b in zip(left.column("doc_id")[k].as_py(), w.words, w.begins.tolist()):
                g = gone[b : b + len(words)]
                edges = np.flatnonzero(np.diff(g.astype(np.int8), prepend=0, append=0)).tolist()
                out["doc_id"].append(doc_id)
                out["n_words"].append(len(words))
                out["n_removed"].append(int(g.sum()))
                out["kept"].append(b" ".join(words if not edges else [x for x, drop in zip(words, g.tolist()) if not drop]).decode())
                out["repeats"].append([{"start": s, "end": e} for s, e in zip(edges[::2], edges[1::2])])
        return pa.Table.from_pydict(out, pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("repeats", span)]))

    return batches.groupBy("batch").cogroup(both.groupBy("batch")).applyInArrow(cut, RESULT)
