"""Batches of documents that ask a partitioned table about 64-bit keys.

Counting every n-gram of a corpus by a row per n-gram would shuffle a row per
word. Here a row is a *batch* of documents (a few MB of text): a batch sends
each bucket of the key space one row with its sorted distinct keys, the bucket
adds up what all batches sent, and answers each batch in the order it asked.
A key that a third of all documents share is one entry per batch, so no
group grows with a hot key; the number of buckets follows the number of words,
so a bucket stays a few MB at any input size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.llm.store import shuffle_partitions, stored

KEYS_PER_BUCKET = 1 << 20
ASK = "bucket int, batch long, kind int, keys binary, counts binary"
REPLY = "batch long, kind int, bucket int, counts binary"


BATCH = "batch long, doc_id array<long>, sizes array<int>, texts binary, n_bytes long"
_BATCH_ARROW = pa.schema([("batch", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("texts", pa.binary()), ("n_bytes", pa.int64())])


def text_batches(docs: DataFrame, max_bytes: int, name: str) -> DataFrame:
    """Store rows of about ``max_bytes`` of text: doc_ids, bytes per text, and the texts as one zstd block.

    A text is never cut; one longer than ``max_bytes`` ends its batch. A null
    text has size -1. Read them with :func:`texts_of`.
    """
    small = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0

        def row() -> pa.RecordBatch:
            block = zstandard.compress(b"".join(t or b"" for t in texts), 9)
            sizes = [-1 if t is None else len(t) for t in texts]
            return pa.RecordBatch.from_pylist([{"batch": batch, "doc_id": ids, "sizes": sizes, "texts": block, "n_bytes": size}], _BATCH_ARROW)

        for part in parts:
            for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                ids.append(i)
                texts.append(None if t is None else t.encode())
                size += len(texts[-1] or b"") + 1
                if size >= max_bytes:
                    yield row()
                    batch, ids, texts, size = batch + 1, [], [], 0
        if ids:
            yield row()

    return stored(small.mapInArrow(pack, BATCH), name)


def texts_of(rows: pa.RecordBatch | pa.Table, k: int = 0) -> list[bytes]:
    """The texts of row ``k``; a null one is empty."""
    raw, out, at = zstandard.decompress(rows.column("texts")[k].as_py()), [], 0
    for size in rows.column("sizes")[k].as_py():
        out.append(raw[at : at + max(size, 0)])
        at += max(size, 0)
    return out


def planes(a: np.ndarray) -> bytes:
    """Byte planes of an integer array, each packed on its own: the high bytes are zero or few values, the low ones of keys are noise and stay as they are.

    One frame for all planes would give them one code, in which the noise
    spoils that of the few values. Layout: number of planes up to the last
    that is not zero, number of values, bytes per plane, planes.
    """
    if not len(a):
        return b""
    bytewise = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)
    used = int(np.flatnonzero(bytewise.any(1)).max(initial=-1)) + 1
    packed = [min(p, zstandard.compress(p, 1), key=len) for p in (row.tobytes() for row in bytewise[:used])]
    return bytes([used]) + np.array([len(a), *map(len, packed)], "<u4").tobytes() + b"".join(packed)


def unplanes(b: bytes, dtype) -> np.ndarray:
    if not b:
        return np.empty(0, dtype)
    n, *sizes = np.frombuffer(b, "<u4", b[0] + 1, 1).tolist()
    out, at = np.zeros((n, np.dtype(dtype).itemsize), np.uint8), 1 + 4 * (b[0] + 1)
    for k, size in enumerate(sizes):
        plane = b[at : at + size]
        out[:, k] = np.frombuffer(plane if size == n else zstandard.decompress(plane), np.uint8)
        at += size
    return out.view(dtype).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as byte planes of their gaps."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(b: bytes) -> np.ndarray:
    return np.cumsum(unplanes(b, np.uint64), dtype=np.uint64)


def bucket_count(df: DataFrame, per_batch_bytes: str = "n_bytes", bytes_per_key: int = 4) -> int:
    """Buckets of about KEYS_PER_BUCKET keys each, by the measured size of the batches."""
    total = df.agg(F.sum(per_batch_bytes)).first()[0] or 0
    return int(max(shuffle_partitions(df.sparkSession), -(-total // (bytes_per_key * KEYS_PER_BUCKET))))


def ask_rows(batch: int, kind: int, keys: np.ndarray, counts: np.ndarray, buckets: int) -> list[dict]:
    """Split sorted distinct ``keys`` by bucket, a contiguous range of the key space each."""
    cuts = np.searchsorted(keys, np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64))
    edges = np.concatenate(([0], cuts, [len(keys)]))
    return [
        {"bucket": b, "batch": batch, "kind": kind, "keys": pack_keys(keys[s:e]), "counts": planes(counts[s:e])}
        for b, (s, e) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist()))
        if e > s
    ]


ASK_ARROW = pa.schema([("bucket", pa.int32()), ("batch", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
REPLY_ARROW = pa.schema([("batch", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("counts", pa.binary())])


def ask(batches: DataFrame, questions: Callable[[pa.RecordBatch], Iterator[list[dict]]]) -> DataFrame:
    """Rows that each batch sends; ``questions`` yields the output of :func:`ask_rows` for a record batch."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for k in range(part.num_rows):
                for rows in questions(part.slice(k, 1)):
                    yield pa.RecordBatch.from_pylist(rows, ASK_ARROW)

    return batches.mapInArrow(run, ASK)


def totals(asked: DataFrame, summary: bool = False) -> DataFrame:
    """Sum of ``counts`` per (kind, key) over all batches, sent back to each batch in its own order, as 64-bit integers.

    With ``summary``, a bucket adds rows of batch -1 per kind: [keys with a
    positive total, sum of totals] as 64-bit integers.
    """

    def add(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        out, by_kind = [], {}
        for batch, kind, keys, counts in zip(*(table.column(c).to_pylist() for c in ("batch", "kind", "keys", "counts"))):
            by_kind.setdefault(kind, []).append((batch, unpack_keys(keys), unplanes(counts, np.uint32)))
        for kind, rows in by_kind.items():
            distinct, at = np.unique(np.concatenate([r[1] for r in rows]), return_inverse=True)
            total = np.bincount(at, np.concatenate([r[2] for r in rows]), len(distinct)).astype(np.uint64)
            if summary:
                s = np.array([np.count_nonzero(total), total.sum()], np.int64)
                out.append({"batch": -1, "kind": kind, "bucket": bucket, "counts": s.tobytes()})
            start = 0
            for batch, keys, _ in rows:
                mine = total[at[start : start + len(keys)]]
                out.append({"batch": batch, "kind": kind, "bucket": bucket, "counts": planes(mine)})
                start += len(keys)
        return pa.Table.from_pylist(out, REPLY_ARROW)

    return asked.groupBy("bucket").applyInArrow(add, REPLY)


def answers(table: pa.Table) -> dict[int, np.ndarray]:
    """Per kind, the totals in the order of the sorted keys that the batch asked about."""
    found: dict[int, list] = {}
    for kind, bucket, counts in zip(*(table.column(c).to_pylist() for c in ("kind", "bucket", "counts"))):
        found.setdefault(kind, []).append((bucket, unplanes(counts, np.uint64)))
    return {k: np.concatenate([c for _, c in sorted(v, key=lambda x: x[0])]) for k, v in found.items()}
