"""Target-distribution importance resampling over hashed n-grams, by bit-sliced aggregation.

A document's features are its runs of 1 to ``ORDER`` words; each falls into one
of ``BUCKETS`` buckets. The counts of a document are held as bit planes: bit b
of plane i says whether the count of bucket b has bit i. The gain of a bucket,
the scaled log ratio of its share in the target to that in the corpus, is held
in the same way, in planes of its magnitude, one set for gains above and one
for gains below zero. A document's weight, the sum of count times gain, is then

    sum over i, j of 2^(i + j) * (popcount(count_i & above_j) - popcount(count_i & below_j))

in whole numbers, exact at any size. Texts are read once: the pass that slices
the counts also adds up the buckets of its task, and the weights come from the
stored planes. The driver sees one number per bucket and per partition.

Drawing without replacement takes the highest scores, weight plus Gumbel noise
of a hash of the doc_id. The ranks come from a range sort of numbers alone.

Defined results: a null or empty text has no words, no features and weight 0;
a null doc_id is hashed as ``null`` and comes last among equal scores; repeated
rows are weighed and drawn each; an empty corpus gives no rows, an empty target
gives every bucket a gain by the corpus alone; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.llm.decontam import _FOLD
from uptake.llm.ordering import in_ranges, places
from uptake.llm.store import stored

BUCKETS = 10_000
ORDER = 3
SCALE = 1000
_BYTES = -(-BUCKETS // 64) * 8
#: Bytes of text taken to words at once, and planes in a stored row.
PIECE = 1 << 20
PLANES = 1024
SLICED = "doc_id array<long>, n_words array<long>, n_features array<long>, n_planes array<int>, planes binary, totals array<long>"
_LONGS = pa.list_(pa.int64())
_SLICED_ARROW = pa.schema([("doc_id", _LONGS), ("n_words", _LONGS), ("n_features", _LONGS), ("n_planes", pa.list_(pa.int32())), ("planes", pa.binary()), ("totals", _LONGS)])


def pieces(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text (runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased), a bounded part at a time."""
    raw = (text or "").encode().lower().translate(_FOLD)
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + PIECE)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def bucket_counts(text: str | None) -> tuple[int, np.ndarray]:
    """Number of words, and features per bucket; the checksum of a longer run goes on from that of the shorter one."""
    n, counts, last = 0, np.zeros(BUCKETS, np.int64), []
    for words in pieces(text):
        n += len(words)
        known, words = len(last), last + words
        spaced = [b" " + w for w in words]
        sums = list(map(crc32, words))
        for k in range(ORDER):
            new = sums[max(known - k, 0) :]
            counts += np.bincount(np.fromiter(new, np.int64, len(new)) % BUCKETS, minlength=BUCKETS)
            sums = list(map(crc32, spaced[k + 1 :], sums))
        last = words[1 - ORDER :]
    return n, counts


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Planes of the non-negative ``values``, lowest bit first, as rows of 64-bit words."""
    bits = int(values.max(initial=0)).bit_length()
    out = np.zeros((bits, _BYTES), np.uint8)
    for i in range(bits):
        plane = np.packbits((values >> i) & 1 != 0, bitorder="little")
        out[i, : len(plane)] = plane
    return out.view(np.uint64)


def sliced(docs: DataFrame, name: str) -> DataFrame:
    """Stored rows of many documents with their bit planes, and per task a row with its ``totals`` per bucket."""
    id_type = F.col("doc_id") if "doc_id" in docs.columns else F.lit(None)
    small = docs.select(id_type.cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(BUCKETS, np.int64)
        ids, words, features, planes, held = [], [], [], [], 0

        def row() -> pa.RecordBatch:
            block = zstandard.compress(b"".join(p.tobytes() for p in planes), 1)
            one = {"doc_id": ids, "n_words": words, "n_features": features, "n_planes": [len(p) for p in planes], "planes": block}
            return pa.RecordBatch.from_pylist([one], _SLICED_ARROW)

        for part in parts:
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1)):
                n, counts = bucket_counts(text.as_py())
                totals += counts
                ids.append(doc_id)
                words.append(n)
                features.append(int(counts.sum()))
                planes.append(bit_planes(counts))
                held += len(planes[-1]) + 1
                if held >= PLANES:
                    yield row()
                    ids, words, features, planes, held = [], [], [], [], 0
        if ids:
            yield row()
        yield pa.RecordBatch.from_pylist([{"totals": totals.tolist()}], _SLICED_ARROW)

    return stored(small.mapInArrow(run, SLICED), name)


def bucket_totals(rows: DataFrame) -> np.ndarray:
    """Features per bucket over all tasks: ``BUCKETS`` numbers, whatever the input."""
    per_task = rows.filter("totals IS NOT NULL").select(F.posexplode("totals").alias("bucket", "n"))
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in per_task.groupBy("bucket").agg(F.sum("n").alias("n")).filter("n > 0").collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket the scaled log of its smoothed share in the target over that in the corpus, rounded down."""
    of_corpus, of_target = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    ratio = lambda s, t: ((t + 1.0) * of_corpus) / ((s + 1.0) * of_target)
    return np.array([math.floor(SCALE * math.log(ratio(s, t))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weigh(planes: np.ndarray, owner: np.ndarray, power: np.ndarray, above: np.ndarray, below: np.ndarray, n: int) -> np.ndarray:
    """Weights of ``n`` documents; plane k belongs to document ``owner[k]`` and counts 2^``power[k]``."""
    per_plane = np.zeros(len(planes), np.int64)
    for sign, gain in ((1, above), (-1, below)):
        for j, g in enumerate(gain):
            per_plane += sign * (np.bitwise_count(planes & g).sum(1, dtype=np.int64) << j)
    out = np.zeros(n, np.int64)
    np.add.at(out, owner, per_plane << power)
    return out


def weights(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` from the planes of :func:`sliced`."""
    above, below = bit_planes(np.maximum(gain, 0)), bit_planes(np.maximum(-gain, 0))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in part.to_pylist():
                n_planes = np.array(row["n_planes"], np.int64)
                planes = np.frombuffer(zstandard.decompress(row["planes"]), np.uint64).reshape(-1, _BYTES // 8)
                owner = np.repeat(np.arange(len(n_planes)), n_planes)
                power = np.arange(len(planes)) - np.repeat(np.cumsum(n_planes) - n_planes, n_planes)
                weight = weigh(planes, owner, power, above, below, len(n_planes))
                columns = [pa.array(row["doc_id"], pa.int64()), pa.array(row["n_words"], pa.int64()), pa.array(row["n_features"], pa.int64()), pa.array(weight)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])

    return rows.filter("planes IS NOT NULL").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id, seed: int):
    """Scaled Gumbel noise of a hash of ``seed`` and the doc_id, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(SCALE)) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: int = 42) -> DataFrame:
    """Weight, score and rank of every document; the drawn ones, ``percent`` of those with ``min_words`` words, have a rank from 1."""
    rows = sliced(docs, "planes")
    gain = gains(bucket_totals(rows), bucket_totals(sliced(target.select("text"), "target")))
    scored = weights(rows, gain).select("doc_id", "n_features", "weight", (F.col("weight") + gumbel(F.col("doc_id"), seed)).alias("score"), (F.col("n_words") >= min_words).alias("eligible"))
    order = [F.col("eligible").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features")]
    # written before they are sorted: the sort samples its ranges, and documents are weighed once
    ranked = places(in_ranges(stored(scored, "weights"), order, "scores"), "eligible", "runs")
    drawn = F.col("eligible") & (F.col("pos") < F.floor(percent * F.col("n") / 100))
    return ranked.select("doc_id", "n_features", "weight", "score", F.when(drawn, F.col("pos") + 1).alias("rank"), "eligible")
