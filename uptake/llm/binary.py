"""Token-ID output: Simple-8b word-aligned files.

A file is a run of chunks, each followed by one newline. A chunk, in
little-endian order:

    magic "S8B1" | shard u32 | sequence u32 | n_docs u32 | n_ids u64 | n_words u64 |
    n_blocks u32 | first u64 (ids of this shard before the chunk) |
    per document: doc_id i64, has_id u8, n_ids u32 |
    per block of BLOCK ids: index of its first word, u64 | words u64

A word holds a 4-bit selector on top of 60 bits of payload, so many ids of one
width; the first id lies in the lowest bits. Selector 15 is the escape: the
next word is one id of more than 60 bits, whole. No word spans two blocks, so
a block decodes by itself from its offset. A document lies in one chunk.

Chunks are written by Spark's text sink, one record each, and read by its
``binaryFile`` source, so files appear only when their task commits and any
store that Spark reads will do.

Defined results: a null text is an empty one and has the end id alone;
repeated rows are written each, equal doc_ids in the order of a hash of their
text, null ids first; an empty table gives no documents; other columns are
ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uptake.llm.store import new_folder, stored
from uptake.llm.tokens import in_document_order, partition_bases, word_tokenizer

#: Ids a word holds by selector and their width in bits (the fixed table of Simple-8b); 15 escapes.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2], np.int64)
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30], np.int64)
ONE, ESCAPE = 14, 15
#: In this format selector 14 holds two ids of 30 bits, selector 0 and 1 runs of zeros.
BLOCK = 4096
HEAD = struct.Struct("<4sIIIQQIQ")
DOC = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("n", "<u4")])
CHUNK_IDS = 1 << 20


#: Bits of every value of 16 bits.
_SHORT = np.repeat(np.arange(17, dtype=np.uint8), [1, *(1 << k for k in range(16))])


def bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits of each value: 0 for 0."""
    out = np.zeros(len(values), np.uint8)
    rest = values.astype(np.uint64)
    widest = int(rest.max(initial=0)).bit_length()
    for step in (32, 16):
        if widest > step:
            big = rest >> np.uint64(step) > 0
            out += big * np.uint8(step)
            rest = np.where(big, rest >> np.uint64(step), rest)
    return out + _SHORT[rest.astype(np.intp)]


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and, per block, the index of its first word."""
    values = values.astype(np.uint64)
    n = len(values)
    blocks = -(-n // BLOCK)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    ends = np.minimum(np.arange(1, blocks + 1) * BLOCK, n)
    bits = bit_lengths(values)
    # the selector at each position: the most ids whose widest fits and that end in the block
    room = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(n)
    best = np.full(n, ESCAPE, np.uint8)
    widest, have = bits, 1
    for s in range(ONE, -1, -1):
        while have < COUNTS[s]:
            step = min(have, int(COUNTS[s]) - have)
            widest = np.concatenate((np.maximum(widest[: n - step], widest[step:]) if n > step else widest[:0], np.full(min(step, n), 255, np.uint8)))
            have += step
        fits = (widest <= WIDTHS[s]) & (room >= COUNTS[s])
        if not fits.any():
            break  # the selectors before it hold more ids in fewer bits
        best[fits] = s
    # a lone id of at most 60 bits needs no escape: it is the first of a pair whose second is absent
    taken = np.append(COUNTS, 1)[best]
    # walk all blocks in step; each cursor jumps by what its word holds
    at, live, starts = ends - np.diff(ends, prepend=0), np.arange(blocks), []
    cursor = at.copy()
    while len(live):
        starts.append(cursor[live])
        cursor[live] += taken[cursor[live]]
        live = live[cursor[live] < ends[live]]
    starts = np.sort(np.concatenate(starts))
    selector = best[starts]
    words = selector.astype(np.uint64) << np.uint64(60)
    for s in range(2, ESCAPE):
        rows = np.flatnonzero(selector == s)
        for k in range(int(COUNTS[s])):
            words[rows] |= values[starts[rows] + k] << np.uint64(k * int(WIDTHS[s]))
    wide = selector == ESCAPE
    offsets = np.searchsorted(starts, at)
    if wide.any():
        # one id by escape: the payload of the selector word when 60 bits do, else the next word
        big = wide & (bits[starts] > 59)
        words[wide & ~big] |= (values[starts[wide & ~big]] << np.uint64(1)) | np.uint64(1)
        before = np.cumsum(big) - big
        out = np.zeros(len(words) + int(big.sum()), np.uint64)
        out[np.arange(len(words)) + before] = words
        out[np.flatnonzero(big) + before[big] + 1] = values[starts[big]]
        return out, (offsets + before[offsets]).astype(np.uint64)
    return words, offsets.astype(np.uint64)


def decode(words: np.ndarray) -> np.ndarray:
    """All ids of a run of whole blocks, a vector operation per selector and slot."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    payload = words & np.uint64((1 << 60) - 1)
    escape = (selector == ESCAPE) & (payload == 0)
    if escape.any():
        # a raw word follows an escape; raw words may look like escapes, so take them in order
        raw, last = np.zeros(len(words), bool), -2
        for i in np.flatnonzero(escape).tolist():
            if i != last + 1 or not raw[i]:
                raw[i + 1], last = True, i
        heads = np.flatnonzero(~raw)
        long = escape[heads]
        big = words[heads[long] + 1]
        selector, payload = selector[heads], payload[heads]
    taken = np.append(COUNTS, 1)[selector]
    starts = np.cumsum(taken) - taken
    out = np.zeros(int(taken.sum()), np.uint64)
    for s in range(2, ESCAPE):
        rows = np.flatnonzero(selector == s)
        mask = np.uint64((1 << int(WIDTHS[s])) - 1)
        for k in range(int(COUNTS[s])):
            out[starts[rows] + k] = (payload[rows] >> np.uint64(k * int(WIDTHS[s]))) & mask
    lone = selector == ESCAPE
    out[starts[lone]] = payload[lone] >> np.uint64(1)
    if escape.any():
        out[starts[np.flatnonzero(long)]] = big
    return out


def chunk(shard: int, sequence: int, first: int, doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    docs = np.zeros(len(ids), DOC)
    docs["doc_id"] = [i or 0 for i in doc_ids]
    docs["has_id"] = [i is not None for i in doc_ids]
    docs["n"] = [len(x) for x in ids]
    flat = np.concatenate(ids)
    words, offsets = encode(flat)
    head = HEAD.pack(b"S8B1", shard, sequence, len(ids), len(flat), len(words), len(offsets), first)
    return head + docs.tobytes() + offsets.astype("<u8").tobytes() + words.astype("<u8").tobytes()


def chunks(content: bytes) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(shard, ids before, documents, ids) of every chunk of a file."""
    at = 0
    while at < len(content):
        magic, shard, _, n_docs, n_ids, n_words, n_blocks, first = HEAD.unpack_from(content, at)
        if magic != b"S8B1":
            raise ValueError(f"no chunk at byte {at}")
        at += HEAD.size
        docs = np.frombuffer(content, DOC, n_docs, at)
        at += docs.nbytes + 8 * n_blocks
        ids = decode(np.frombuffer(content, "<u8", n_words, at))
        if len(ids) != n_ids:
            raise ValueError("a chunk is damaged")
        at += 8 * n_words + 1
        yield shard, first, docs, ids


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, chunks_per_file: int = 16) -> None:
    """Write the ids of all documents under ``path``, shards and files in ascending doc_id order."""
    from pyspark import TaskContext

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, shard = word_tokenizer(tokenizer_path), TaskContext.get().partitionId()
        end = np.array([end_id], np.uint32)
        first, sequence, doc_ids, ids, held = 0, 0, [], [], 0
        out = lambda: pa.RecordBatch.from_arrays([pa.array([chunk(shard, sequence, first, doc_ids, ids)], pa.binary())], ["content"])
        for rows in parts:
            for s in range(0, rows.num_rows, 1024):
                some = rows.slice(s, 1024)
                for doc_id, x in zip(some.column(0).to_pylist(), tokenizer.encode(some.column(1).to_pylist())):
                    doc_ids.append(doc_id)
                    ids.append(np.concatenate((x, end)))
                    held += len(x) + 1
                    if held >= CHUNK_IDS:
                        yield out()
                        first, sequence, doc_ids, ids, held = first + held, sequence + 1, [], [], 0
        if ids:
            yield out()

    records = in_document_order(docs).mapInArrow(run, "content binary")
    # the text sink writes the bytes of a string as they are
    records.select(F.col("content").cast("string").alias("value")).write.option("maxRecordsPerFile", chunks_per_file).text(path)


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document in the files: place, count and checksum; ``with_ids`` adds its ids as little-endian u32."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for content in part.column(0):
                for shard, first, docs, ids in chunks(content.as_py()):
                    n = docs["n"].astype(np.int64)
                    before = np.cumsum(n) - n
                    raw = memoryview(ids.astype("<u4").tobytes())
                    pieces = [raw[4 * s : 4 * (s + k)] for s, k in zip(before.tolist(), n.tolist())]
                    columns = [
                        pa.array(np.full(len(n), shard, np.int32)), pa.array(first + before), pa.array(docs["doc_id"].astype(np.int64), mask=docs["has_id"] == 0),
                        pa.array(n), pa.array([zlib.crc32(x) for x in pieces], pa.int64()),
                    ]
                    names = ["part", "local_start", "doc_id", "n_tokens", "ids_crc32"]
                    if with_ids:
                        columns, names = [*columns, pa.array([bytes(x) for x in pieces], pa.binary())], [*names, "ids"]
                    yield pa.RecordBatch.from_arrays(columns, names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    schema = "part int, local_start long, doc_id long, n_tokens long, ids_crc32 long"
    return files.select("content").mapInArrow(run, schema + (", ids binary" if with_ids else ""))


def token_index(docs: DataFrame, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    """Write the files, read them back, and return ``doc_id, start, n_tokens, ids_crc32`` per document."""
    spark = docs.sparkSession
    path = new_folder(spark, "ids")
    write(docs, path, tokenizer_path, end_id)
    rows = stored(read(spark, path, with_ids=False), "index")
    bases = partition_bases(rows)
    table = spark.createDataFrame(list(bases.items()) or [(0, 0)], "part int, base long")
    return rows.join(F.broadcast(table), "part").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
