"""Packing: concatenate and cut.

All documents, in ascending doc_id order, form one stream of ids that is cut
into windows of ``length``. Two passes of prefix sums give every document its
place in the stream: ids before it in its range partition, then ids before
the partition. A document that crosses a cut leaves a boundary record on each
side (``cut_before``, ``cut_after``), so only the last sequence is padded.

Defined results: a null text is an empty one and holds the end id alone;
repeated rows are packed each; rows of equal doc_id follow in the order of a
hash of their text, null ids come first; an empty table gives no pieces; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.llm.tokens import partition_bases, token_runs

PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "cut_before boolean, cut_after boolean"
)


def pack(docs: DataFrame, tokenizer_path: str, length: int = 2048, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """One row per piece of a document in a sequence; ``with_ids`` adds its ids as binary."""
    runs = token_runs(docs, tokenizer_path, end_id, "pack")
    bases = partition_bases(runs)

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in parts:
            part, local, n = (rows.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1, 3))
            begin = local + np.array([bases[p] for p in part.tolist()], np.int64)
            first, last = begin // length, (begin + n - 1) // length
            count = last - first + 1
            doc = np.repeat(np.arange(len(n)), count)
            sequence = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + first[doc]
            lo = np.maximum(sequence * length, begin[doc])
            hi = np.minimum((sequence + 1) * length, (begin + n)[doc])
            start, size = lo - begin[doc], hi - lo
            raw = rows.column(4)
            pieces, at, view = [], -1, b""
            for d, s, k in zip(doc.tolist(), start.tolist(), size.tolist()):
                if d != at:
                    at, view = d, memoryview(raw[d].as_buffer())
                pieces.append(view[4 * s : 4 * (s + k)])
            columns = [
                rows.column(2).take(pa.array(doc)), pa.array(start), pa.array(size), pa.array([zlib.crc32(x) for x in pieces], pa.int64()),
                pa.array(n[doc]), pa.array(sequence), pa.array(lo - sequence * length), pa.array(start > 0), pa.array(start + size < n[doc]),
            ]
            names = [c.split()[0] for c in PIECE.split(", ")]
            if with_ids:
                columns, names = [*columns, pa.array([bytes(x) for x in pieces], pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return runs.mapInArrow(cut, PIECE + (", ids binary" if with_ids else ""))


def sequences(pieces: DataFrame, length: int = 2048, pad_id: int = 0) -> DataFrame:
    """Whole sequences ``(sequence_id, ids binary of length ids, n_ids)`` from pieces with ids.

    A sequence has at most ``length`` pieces, so no group grows with the input.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(ordered, F.unhex(F.lit("")), lambda acc, x: F.concat(acc, x["ids"]))
    grouped = pieces.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("n_ids"))
    pad = F.unhex(F.lit(f"{pad_id:08x}")) if pad_id == 0 else F.unhex(F.lit(int(pad_id).to_bytes(4, "little").hex()))
    return grouped.withColumn("ids", F.rpad("ids", F.lit(4 * length), pad))
