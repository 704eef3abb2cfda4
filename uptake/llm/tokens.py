"""Token ids of whole texts by a public tokenizer, in ascending document order."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.llm.store import shuffle_partitions, stored
from uptake.llm.words import spread

#: Words whose ids a Python worker remembers (about 200 bytes each); it starts afresh beyond that.
REMEMBERED = 1_000_000
_MARK = b"<|"


class WordTokenizer:
    """Ids of texts from the ids of their white-space separated words.

    For a tokenizer whose pre-tokenizer never joins text across white space
    and which lower-cases, the ids of a text are those of its words in turn.
    A word goes through the tokenizer's normaliser, pre-tokenizer and merges
    once per worker. Latin-1 letters with ASCII marks behind take a shorter
    way: the normaliser only lower-cases them, one letter each, and the
    pre-tokenizer only cuts between the two, so the letters in lower case go to
    the merges at once, equal ones of a call together and words seen before not again. All other words go the
    whole way as written: the normaliser composes letters and marks before it
    lower-cases, and some compose in lower case only. Texts with ``<|``, which
    could hold the string of a special token, go through the tokenizer whole.
    """

    #: one word a line: letters and the marks behind them, or any other word
    WORDS = re.compile(r"(?m)^([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*)([!-&(-/:-@\[-`{-~]*)$|^(.+)$")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: the byte-level alphabet: each byte's character in the vocabulary
        pieces = self.tokenizer.pre_tokenizer
        self.alphabet = {c: pieces.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}
        merge = self.tokenizer.model.tokenize
        self.marks = lru_cache(4096)(lambda piece: [t.id for t in merge(piece)])
        self.forget()

    def forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.flat, self.starts, self.lengths = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _whole(self, word: str) -> list[int]:
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(word))
        return [t.id for piece, _ in pieces for t in self.tokenizer.model.tokenize(piece)]

    def _letters(self, run: str) -> list[int]:
        at = self.index.get(run.encode(), len(self.starts))
        if at < len(self.starts):  # a word by itself, learned before
            return self.flat[self.starts[at] : self.starts[at] + self.lengths[at]].tolist()
        run = run if run.isascii() else run.translate(self.alphabet)
        return [t.id for t in self.tokenizer.model.tokenize(run)]

    def _learn(self, words: list[bytes]) -> None:
        runs, flat, lengths = {"": []}, array("I"), array("q")
        for letters, marks, other in self.WORDS.findall(b"\n".join(words).decode()):
            if other:
                ids = self._whole(other)
            else:
                run = letters.lower()
                ids = runs.get(run)
                if ids is None:
                    ids = runs[run] = self._letters(run)
                if marks:
                    ids = ids + self.marks(marks)
            flat.extend(ids)
            lengths.append(len(ids))
        counts = np.array(lengths, np.int64)
        self.starts = np.concatenate((self.starts, len(self.flat) + np.cumsum(counts) - counts))
        self.lengths = np.concatenate((self.lengths, counts))
        self.flat = np.concatenate((self.flat, np.array(flat, np.uint32)))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.index) > REMEMBERED:
            self.forget()
        index, new, numbered = self.index, [], []
        for text in texts:
            raw = (text or "").encode()
            if _MARK in raw:
                numbered.append(None)
                continue
            words = raw.split()
            try:
                numbered.append(np.fromiter(map(index.__getitem__, words), np.int64, len(words)))
            except KeyError:
                for w in words:
                    if w not in index:
                        index[w] = len(index)
                        new.append(w)
                numbered.append(np.fromiter(map(index.__getitem__, words), np.int64, len(words)))
        if new:
            self._learn(new)
        return [
            np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32) if at is None else ids
            for text, at, ids in zip(texts, numbered, self._of([np.empty(0, np.int64) if at is None else at for at in numbered]))
        ]

    def _of(self, numbered: list[np.ndarray]) -> list[np.ndarray]:
        """The ids of each run of word numbers, for all runs at once."""
        words = np.concatenate(numbered) if numbered else np.empty(0, np.int64)
        lengths = self.lengths[words]
        flat = self.flat[spread(self.starts[words], lengths)]
        before = np.concatenate(([0], np.cumsum(lengths)))[np.cumsum([0, *map(len, numbered)])].tolist()
        return [flat[s:e] for s, e in zip(before, before[1:])]


@cache
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def in_document_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text) sorted by doc_id over range partitions; equal ids by a hash of the text, nulls first."""
    small = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    return small.repartitionByRange(shuffle_partitions(docs.sparkSession), *order).sortWithinPartitions(*order)


def token_runs(docs: DataFrame, tokenizer_path: str, end_id: int, name: str) -> DataFrame:
    """Stored ``(part, local_start, doc_id, n_tokens, ids)`` in document order.

    First pass of a two-pass prefix sum: ``local_start`` counts the ids before
    the document within its partition ``part``. ``ids`` are little-endian
    unsigned 32-bit integers with ``end_id`` last.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, part, start = word_tokenizer(tokenizer_path), TaskContext.get().partitionId(), 0
        end = np.array([end_id], np.uint32)
        for rows in parts:
            for s in range(0, rows.num_rows, 1024):
                some = rows.slice(s, 1024)
                ids = [np.concatenate((x, end)) for x in tokenizer.encode(some.column(1).to_pylist())]
                n = np.array([len(x) for x in ids], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int32)), pa.array(start + np.cumsum(n) - n), some.column(0), pa.array(n), pa.array([x.tobytes() for x in ids], pa.binary())],
                    ["part", "local_start", "doc_id", "n_tokens", "ids"],
                )
                start += int(n.sum())

    return stored(in_document_order(docs).mapInArrow(run, "part int, local_start long, doc_id long, n_tokens long, ids binary"), name)


def partition_bases(rows: DataFrame, part: str = "part", n: str = "n_tokens") -> dict[int, int]:
    """Second pass: ids before each partition. The driver sees one number per partition, whatever the input."""
    totals = sorted(rows.groupBy(part).agg(F.sum(n).alias("n")).collect())
    bases, before = {}, 0
    for p, total in totals:
        bases[p] = before
        before += total
    return bases
