"""Near-duplicate documents by HyperMinHash.

A document's shingles (``n`` words each, lower-cased) are hashed to 64 bits.
The top byte picks one of 256 buckets; a bucket's register keeps, of its
smallest hash, the number of leading zeros and the 10 bits after the first
one. Equal sets form a class and are one from here on. Bands of registers
propose candidate classes, the share of equal registers, corrected for
registers that agree by chance, rules out those far below the threshold, and
the rest are confirmed on the full sets of hashes.

An empty register borrows from another one before banding, so that a band of
a small set says as much as one of a large set.

Candidates of a band are never emitted all with all. Groups of up to AT_ONCE
members compare all of them; in a larger one all members meet its smallest
first, and links so confirmed join components. Where members of a large group
are left in several components, as pages of one template are, they meet again
on their rarest shingles. Two linked sets of a <= b members share at least
t (a + b) / (1 + t), so in any common order one of the first a - 2 t a / (1 + t) + 1
of the smaller is among the first b - t b + 1 of the larger. The order is by
frequency (counted in CELLS cells, ties by hash), so a template's own words, which
all its pages share, come last and make no pairs for pages below the threshold.
Of the members of one such shingle, those of its largest component are only
compared with the others. Comparing is a test inside
the join, of sizes, of 128 bits of the sketch and, in the last step, of 1024
parities that bound the difference of two sets from below; a row comes out only
for a pair that may be linked. So a group of thousands of copies costs a row per
member and band, while a link that the pivot misses is still found.

Bands follow the threshold t: as long as 256 registers allow while a pair at t
shares no band with odds of at most MISSED, (1 - t^rows)^bands. That is 32 bands
of 6 at 0.85 (2.7e-7) and 38 of 5 at 0.80 (2.8e-7). The bits grant a pair 5.5
standard deviations and the estimate five.

Defined results: a text without words has no shingles and is linked with
nothing, a text of fewer than ``n`` words has its word sequence as one; a
repeated row is linked with its like. Links are found between texts: one
doc_id may stand on rows with different texts. :func:`near_duplicates` names
documents by doc_id, so its rows have one component and are kept or dropped
together; :func:`drop_copies` judges each of its texts. A null doc_id cannot be named, so its row is linked with
nothing, has a null component and is kept; texts are read whole; an empty table gives no rows;
other columns are ignored by :func:`near_duplicates` and kept by
:func:`drop_copies`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.llm.components import components
from uptake.llm.store import stored
from uptake.llm.words import Index, gram_hashes, mix, word_hashes

REGISTERS, MANTISSA = 256, 10
#: Odds at which a pair at the threshold may share no band.
MISSED = 3e-7
#: Members up to which the pairs of a band's group are compared at once.
AT_ONCE = 64
#: Cells in which shingles are counted to order them by frequency; the order is exact for any counts.
CELLS = 1 << 20
#: For each register the order in which it looks for one that is not empty.
_DONORS = np.stack([np.concatenate(([i], np.random.default_rng(i).permutation(np.delete(np.arange(REGISTERS), i)))) for i in range(REGISTERS)])


def shingle_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    index = Index()
    rows = [index.number((t or "").encode().lower().split()) for t in texts]
    hashes = word_hashes(index)
    out = []
    for r in rows:
        k = min(n, len(r))
        out.append(np.unique(mix(gram_hashes(hashes[r], k) + np.uint64(k))) if k else np.empty(0, np.uint64))
    return out


def registers(shingles: np.ndarray) -> np.ndarray:
    """One 16-bit register per bucket: leading zeros plus one, then the mantissa; 0 where empty."""
    out = np.zeros(REGISTERS, np.uint16)
    if len(shingles):
        bucket = (shingles >> np.uint64(56)).astype(np.int64)
        first = np.flatnonzero(np.diff(bucket, prepend=-1))  # sorted: the first of a bucket is its smallest
        rest = (shingles[first] << np.uint64(8)) | np.uint64(0xFF)
        top = 63 - np.floor(np.log2((rest >> np.uint64(11)).astype(np.float64))).astype(np.int64) - 11
        zeros = np.clip(top, 0, 53)
        mantissa = (rest << (zeros + 1).astype(np.uint64)) >> np.uint64(64 - MANTISSA)
        out[bucket[first]] = ((zeros + 1) << MANTISSA) | mantissa.astype(np.int64)
    return out


def filled(row: np.ndarray) -> np.ndarray:
    """Registers with each empty one replaced by the first non-empty one of its fixed order.

    A band of a small set then compares as many smallest hashes as one of a large set.
    """
    full = row > 0
    if full.all() or not full.any():
        return row
    empty = np.flatnonzero(~full)
    out = row.copy()
    out[empty] = row[_DONORS[empty, full[_DONORS[empty]].argmax(1)]]
    return out


def banding(percent: int) -> tuple[int, int]:
    """Bands and rows a band: the longest rows whose bands, at odds of MISSED, fit the registers."""
    t = percent / 100
    fitting = ((math.ceil(math.log(MISSED) / math.log1p(-(t**rows))), rows) for rows in range(1, 33)) if t < 1 else [(1, REGISTERS)]
    return max((x for x in fitting if x[0] * x[1] <= REGISTERS), key=lambda x: x[1])


def signature(row: np.ndarray, bands: int, rows: int) -> tuple[list[int], int, int]:
    """Hashes of the bands, and the lowest bits of 128 registers as two integers."""
    row = filled(row)
    raw = row[: bands * rows].tobytes()
    width = 2 * rows
    hashed = [xxhash.xxh64_intdigest(raw[i * width : (i + 1) * width], i) - (1 << 63) for i in range(bands)]
    bits = np.packbits((row[:128] & 1).astype(np.uint8)).view(np.int64)
    return hashed, int(bits[0]), int(bits[1])


def _zero_odds(n: np.ndarray) -> np.ndarray:
    """Per set size, the odds of each number of leading zeros of a register (empty left out)."""
    lower = 2.0 ** -np.arange(1, 55)
    upper = 2.0 * lower
    survive = lambda x: np.exp(n[:, None] * np.log1p(-x[None, :] / REGISTERS))
    return survive(lower) - survive(upper)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of rows of registers, less the agreements expected by chance, and registers in use."""
    used = ((a > 0) | (b > 0)).sum(1)
    equal = ((a == b) & (a > 0)).sum(1)
    share = equal / np.maximum(used, 1)
    chance = REGISTERS * (_zero_odds(n_a) * _zero_odds(n_b)).sum(1) / (1 << MANTISSA)
    return share - (1 - share) * chance / np.maximum(used, 1), used


def parities(shingles: np.ndarray) -> np.ndarray:
    """1024 parities of the number of hashes in a cell, as 16 integers.

    Those of two sets differ in at most as many cells as the sets differ in members.
    """
    odd = np.bincount((shingles & np.uint64(1023)).astype(np.int64), minlength=1024) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def class_of(shingles: np.ndarray) -> bytes:
    """128-bit hash of a set."""
    return xxhash.xxh3_128_digest(shingles.tobytes())


def sketches(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, class (128-bit hash of the set), registers, bands, bits_1, bits_2, odd`` per row of ``docs``."""

    shape = banding(percent)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for s in range(0, part.num_rows, 1024):
                some = part.slice(s, 1024)
                sets = shingle_sets(some.column(1).to_pylist(), n)
                rows = [registers(x) for x in sets]
                bands, one, two = zip(*(signature(r, *shape) for r in rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0), some.column(2), pa.array(list(map(len, sets)), pa.int64()), pa.array(list(map(class_of, sets)), pa.binary()),
                        pa.array([x.tobytes() for x in rows], pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                        pa.array([parities(x) for x in sets], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "text_key", "n_shingles", "class", "registers", "bands", "bits_1", "bits_2", "odd"],
                )

    text = F.col("text").cast("string")
    small = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    return small.mapInArrow(run, "doc_id long, text_key long, n_shingles long, class binary, registers binary, bands array<long>, bits_1 long, bits_2 long, odd array<long>")


def _bands(classes: DataFrame, percent: int) -> DataFrame:
    """``key, rep``: a row per band and size class.

    Sets whose sizes differ by more than the threshold cannot be linked; a set
    goes to its own size class and the next, so two that can share one.
    """
    size = F.floor(F.log(F.col("n")) / math.log(100 / (percent - 0.1)))
    exploded = classes.select("rep", size.alias("size"), F.explode("bands").alias("band"))
    return exploded.select("rep", F.explode(F.array(F.xxhash64("band", "size"), F.xxhash64("band", F.col("size") + 1))).alias("key"))


def _may_link(percent: int) -> F.Column:
    """Sizes and lowest bits of two classes (n_1, n_2, ...) allow a link.

    Bits of registers that differ agree half the time; five and a half
    standard deviations are granted, more for sets with fewer members than bits.
    """
    t = percent / 100
    smaller = F.least("n_1", "n_2")
    differ = F.bit_count(F.col("bits_1_1").bitwiseXOR(F.col("bits_1_2"))) + F.bit_count(F.col("bits_2_1").bitwiseXOR(F.col("bits_2_2")))
    odds = (1 - t) / 2
    granted = 128 * odds + 5.5 * F.sqrt(128 * odds * (1 - odds) * 256 / F.least(smaller, F.lit(256)))
    return (smaller * 100 >= F.greatest("n_1", "n_2") * percent) & (differ <= granted)


def _can_link(percent: int, one: str, two: str, n_one: str, n_two: str) -> F.Column:
    """Parities leave a link possible: sets at the threshold differ in (1 - t) / (1 + t) of their sizes together."""
    differ = sum((F.bit_count(F.get(one, F.lit(i)).bitwiseXOR(F.get(two, F.lit(i)))) for i in range(16)), F.lit(0))
    return differ * (100 + percent) <= (F.col(n_one) + F.col(n_two)) * (100 - percent)


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose estimate does not rule them out."""
    one = classes.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("registers").alias("r_a"), F.col("odd").alias("odd_a"))
    two = classes.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("registers").alias("r_b"), F.col("odd").alias("odd_b"))
    joined = pairs.join(one, "a").join(two, "b").filter(_can_link(percent, "odd_a", "odd_b", "n_a", "n_b"))
    t = percent / 100

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for s in range(0, part.num_rows, 4096):
                some = part.slice(s, 4096)
                sides = [np.frombuffer(b"".join(some.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("r_a", "r_b")]
                share, used = estimate(*sides, *(some.column(c).to_numpy().astype(np.float64) for c in ("n_a", "n_b")))
                near = share >= t - 5 * np.sqrt(t * (1 - t) / np.maximum(used, 1))
                yield some.select(["a", "b"]).filter(pa.array(near))

    return joined.select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(run, "a long, b long")


def _full_sets(reps: DataFrame, classes: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """``rep, shingles``, read from the first text of each class."""
    wanted = reps.join(classes.select("rep", "first"), "rep").select("rep", "first.*")
    text = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    texts = texts.join(wanted, ["doc_id", "text_key"]).select("rep", "text")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for s in range(0, part.num_rows, 1024):
                some = part.slice(s, 1024)
                sets = shingle_sets(some.column(1).to_pylist(), n)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))], ["rep", "shingles"])

    return stored(texts.mapInArrow(run, "rep long, shingles array<long>").dropDuplicates(["rep"]), "sets")


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    sets = _full_sets(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), classes, docs, n)
    one, two = (sets.select(F.col("rep").alias(c), F.col("shingles").alias(f"s_{c}")) for c in "ab")
    both = pairs.join(two, "b").join(one, "a")
    common = F.size(F.array_intersect("s_a", "s_b"))
    return both.filter(100 * common >= percent * (F.size("s_a") + F.size("s_b") - common)).select("a", "b")


def _rarest(sets: DataFrame, percent: int) -> DataFrame:
    """``key, rep, short``: the rarest shingles of each set, for meeting smaller sets; ``short`` those for meeting larger ones."""
    each = sets.select(F.explode("shingles").alias("key"))
    counted = each.groupBy(F.col("key").bitwiseAND(F.lit(CELLS - 1)).alias("cell")).agg(F.count("*").alias("n")).toArrow()
    counts = np.zeros(CELLS, np.int64)  # at most CELLS rows, whatever the input
    counts[counted.column("cell").to_numpy()] = counted.column("n").to_numpy()
    shared = sets.sparkSession.sparkContext.broadcast(counts)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for rep, shingles in zip(part.column(0).to_pylist(), part.column(1)):
                keys = shingles.values.to_numpy()
                n = len(keys)
                long, short = n + 1 - -(-percent * n // 100), n + 1 - -(-2 * percent * n // (100 + percent))
                keys = keys[np.lexsort((keys, shared.value[keys & (CELLS - 1)]))[:long]]
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(long, rep)), pa.array(np.arange(long) < short)], ["key", "rep", "short"])

    return sets.mapInArrow(run, "key long, rep long, short boolean")


def _links(classes: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Confirmed links between representatives, enough to connect all that candidates connect."""
    bands = stored(_bands(classes, percent), "bands")
    shared = bands.groupBy("key").agg(F.count("*").alias("members"), F.min("rep").alias("pivot")).filter("members > 1")
    facts = classes.select("rep", "n", "bits_1", "bits_2")
    groups = stored(bands.join(shared, "key").join(facts, "rep"), "groups")

    def side(rows: DataFrame, k: int, *more: str) -> DataFrame:
        return rows.select("key", *(F.col(c).alias(f"{c}_{k}") for c in ("rep", "n", "bits_1", "bits_2", "component", *more)))

    def linked(pairs: DataFrame) -> DataFrame:
        pairs = stored(pairs.filter(_may_link(percent)).select(F.least("rep_1", "rep_2").alias("a"), F.greatest("rep_1", "rep_2").alias("b")).distinct(), "pairs")
        return stored(_confirmed(stored(_likely(pairs, classes, percent), "likely"), classes, docs, n, percent), "links")

    # small groups compare all members, large ones their members with the pivot
    alone = groups.withColumn("component", F.col("rep"))
    few = alone.filter(F.col("members") <= AT_ONCE)
    many = alone.filter(F.col("members") > AT_ONCE)
    within = side(few, 1).join(side(few, 2), "key").filter("rep_1 < rep_2")
    star = side(many.filter("rep = pivot"), 1).join(side(many, 2), "key").filter("rep_1 <> rep_2")
    found = linked(within.unionByName(star))
    # what is left: members of large groups in different components
    label = stored(components(found), "labels")
    left = many.select("key", "rep").join(label, F.col("rep") == F.col("node"), "left").select("key", "rep", F.coalesce("component", "rep").alias("component"))
    left = stored(left.join(_split(left), "key").select("rep", "component").distinct(), "left")
    rare = stored(_rarest(_full_sets(left.select("rep"), classes, docs, n), percent).join(left, "rep"), "rare")
    met = stored(rare.join(_split(rare, "short"), "key").join(facts, "rep").join(classes.select("rep", "odd"), "rep"), "met")
    small, minor = met.filter("short"), "component <> largest"
    meeting = F.expr("component_1 <> component_2 and (n_1 < n_2 or n_1 = n_2 and short_2 and rep_1 < rep_2)") & _can_link(percent, "odd_1", "odd_2", "n_1", "n_2")
    rest = (side(a, 1, "odd").join(side(b, 2, "odd", "short"), "key").filter(meeting) for a, b in ((small.filter(minor), met), (small.filter(f"not ({minor})"), met.filter(minor))))
    return found.unionByName(linked(next(rest).unionByName(next(rest))))


def _split(members: DataFrame, one_is: str = "true") -> DataFrame:
    """``key, largest``: the keys whose members lie in several components, where ``one_is`` holds for one of them, and the component with most of them."""
    sizes = members.groupBy("key", "component").agg(F.count("*").alias("size"), F.max(F.expr(one_is)).alias("any"))
    parts = sizes.groupBy("key").agg(F.count("*").alias("parts"), F.max("any").alias("any"), F.max(F.struct("size", "component")).alias("top"))
    return parts.filter("parts > 1 and any").select("key", F.col("top.component").alias("largest"))


def _linked(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sketches of the rows, their classes, and links between the numbers (``rep``) of classes.

    A class is numbered where it is stored, so that it is named by its set and
    not by a doc_id; ``first`` is the row with its smallest doc_id.
    """
    rows = stored(sketches(docs, n, percent), "sketches")
    named = rows.filter("doc_id is not null and n_shingles > 0")
    facts = (F.first(c).alias(c) for c in ("registers", "bands", "bits_1", "bits_2", "odd"))
    grouped = named.groupBy("class").agg(F.min(F.struct("doc_id", "text_key")).alias("first"), F.first("n_shingles").alias("n"), *facts)
    classes = stored(grouped.withColumn("rep", F.monotonically_increasing_id()), "classes")
    return rows, classes, _links(classes, docs, n, percent)


def _components(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``class, rep, first, component`` per class."""
    label = stored(components(links), "labels")
    return classes.select("class", "rep", "first").join(label, F.col("rep") == F.col("node"), "left").select("class", "rep", "first", F.coalesce("component", "rep").alias("component"))


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row: the smallest doc_id reachable by links of at least ``percent``."""
    rows, classes, found = _linked(docs.select("doc_id", "text"), n, percent)
    # one doc_id with several texts joins all their classes
    reps = rows.filter("doc_id is not null and n_shingles > 0").select("doc_id", "class").join(classes.select("class", "rep"), "class").select("doc_id", "rep")
    several = reps.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a <> b").select("doc_id", "a")
    joined = reps.join(several, "doc_id").filter("rep <> a").select("a", F.col("rep").alias("b"))
    of_class = _components(classes, found.unionByName(joined))
    least = of_class.groupBy("component").agg(F.min("first.doc_id").alias("least"))
    of_class = stored(of_class.join(least, "component").select("class", "rep", "least"), "least")
    # a row without words goes with the other rows of its doc_id
    bare = rows.filter("doc_id is not null and n_shingles = 0").select("doc_id").distinct()
    of_bare = reps.join(bare, "doc_id", "left_semi").join(of_class.select("rep", "least"), "rep").groupBy("doc_id").agg(F.min("least").alias("bare_least"))
    empty = rows.filter("n_shingles = 0").select("doc_id", "n_shingles").join(of_bare, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("bare_least", "doc_id").alias("least"))
    full = rows.filter("n_shingles > 0").select("doc_id", "n_shingles", "class").join(of_class, "class", "left").select("doc_id", "n_shingles", "least")
    component = F.when(F.col("doc_id").isNotNull(), F.col("least"))
    return full.unionByName(empty).select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_copies(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of texts, with its columns: a row with the smallest doc_id; equal rows stay once.

    Groups are those of the texts, whatever other texts their doc_ids have.
    """
    columns = docs.columns
    rows, classes, found = _linked(docs.select("doc_id", "text"), n, percent)
    chosen = _components(classes, found).groupBy("component").agg(F.min("first").alias("first")).select("first.*")
    bare = rows.filter("doc_id is not null and n_shingles = 0").groupBy("doc_id").agg(F.min("text_key").alias("text_key"))
    kept = chosen.unionByName(bare).select(F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key"))
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("doc"), F.col("doc_id").cast("long").alias("kept_id"), F.xxhash64(F.col("text").cast("string")).alias("kept_key"))
    named = keyed.join(kept, ["kept_id", "kept_key"], "left_semi").dropDuplicates(["kept_id", "kept_key"]).select(*(F.col(f"doc.`{c}`").alias(c) for c in columns))
    return named.unionByName(docs.filter("doc_id is null")).select(*(F.col(f"`{c}`") for c in columns))
