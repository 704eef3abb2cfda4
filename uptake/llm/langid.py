"""Language identification by character language models.

Per language, an interpolated Kneser-Ney model over the characters of words: a
word is lower-cased letters between two boundary marks, and predicts each of
its characters and its end from up to ``ORDER - 1`` characters before. All
n-grams that the sample shows are kept. Counts, discounts and probabilities
are Spark aggregates and joins. The models of some languages share one sorted
array of n-gram hashes per order, with a column of log-probabilities per
language: where a language lacks an n-gram, what backing off to the next order
by the weight of its history gives. So one binary search answers for all.
A text gets the language of the lowest cross-entropy per character. The score
is the softmax of the negative entropies at a temperature fitted to the
labelled sample, and a text whose entropy lies far outside what the winner's
own sample texts show is marked ``rejected``.

The models are learned from about SAMPLE labelled texts per language (all where
there are fewer), drawn by a hash of doc_id, whole. That bounds a language's
n-grams; languages are dealt to groups whose arrays stay within MODEL_BYTES,
and the texts meet one group after another, so a broadcast is bounded for any
number of languages.

Defined results: a null text or one without a letter is ``und`` with score 0;
equal entropies go to the first language by name; repeated rows are judged
each; rows with null text, lang or doc_id teach nothing; without any teacher
every text is ``und``; texts are judged whole; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.llm.store import stored
from uptake.llm.words import BASE, Index, mix

ORDER = 4
SAMPLE = 2000
#: Bytes of arrays that one broadcast may hold.
MODEL_BYTES = 128 << 20
EDGE = "\x02"
#: Probability of a character that no text of the language has shown.
UNSEEN = 1 / 65536
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2 if doc_id is not None else False


def hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` codes that end at each position from the n-th on."""
    m = max(len(codes) - n + 1, 0)
    h = np.full(m, n, np.uint64)
    for k in range(n):
        h = h * np.uint64(BASE) + codes[k : k + m]
    return mix(h)


def codes_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the padded words, and the length of each."""
    padded = [EDGE * (ORDER - 1) + w + EDGE for w in words]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return codes, np.fromiter(map(len, padded), np.int64, len(padded))


def kneser_ney(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``lang, size, gram, p``: per order the probability of each n-gram's last character; and ``lang, size, gram, weight``: of the order below after a history.

    ``counts`` (lang, gram, n) are of n-grams of ORDER characters. Lower orders
    count how many distinct characters stand before an n-gram. The weight of a
    history of ``size`` characters is that of order ``size + 1``.
    """
    rest = F.substring("gram", 2, ORDER)
    levels = {ORDER: counts.select("lang", "gram", "n")}
    for size in range(ORDER - 1, 0, -1):
        levels[size] = levels[size + 1].groupBy("lang", rest.alias("gram")).agg(F.count(F.lit(1)).alias("n"))
    probabilities, weights, lower = [], [], None
    for size in range(1, ORDER + 1):
        level = levels[size].withColumn("history", F.substring("gram", 1, size - 1))
        once, twice = (F.sum((F.col("n") == k).cast("double")) for k in (1, 2))
        discount = F.when((once > 0) & (twice > 0), once / (once + 2 * twice)).otherwise(F.lit(0.5))
        level = level.join(level.groupBy("lang").agg(discount.alias("discount")), "lang")
        of_history = level.groupBy("lang", "history").agg(F.sum("n").alias("total"), (F.max("discount") * F.count(F.lit(1)) / F.sum("n")).alias("weight"))
        level = level.join(of_history, ["lang", "history"])
        if lower is None:
            below = F.lit(UNSEEN)
        else:
            level = level.withColumn("tail", rest).join(lower.select("lang", F.col("gram").alias("tail"), F.col("p").alias("p_tail")), ["lang", "tail"])
            below = F.col("p_tail")
        lower = stored(level.select("lang", "gram", ((F.col("n") - F.col("discount")) / F.col("total") + F.col("weight") * below).alias("p")), f"order{size}")
        probabilities.append(lower.select("lang", F.lit(size).alias("size"), "gram", "p"))
        weights.append(of_history.select("lang", F.lit(size - 1).alias("size"), F.col("history").alias("gram"), "weight"))
    union = lambda parts: reduce(DataFrame.unionByName, parts)
    return union(probabilities), stored(union(weights), "weights")


def _dense(rows: DataFrame, value: str, langs: list[str], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes of the n-grams of ``size`` in order, their codes, and log values by language, NaN where it has none."""
    got = rows.filter((F.col("size") == size) & F.col("lang").isin(langs)).select("lang", "gram", F.log(value).alias("v")).toArrow()
    raw = "".join(got.column("gram").to_pylist()).encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(raw, np.uint32).astype(np.uint64).reshape(got.num_rows, size)
    keys, first, at = np.unique(_row_hashes(codes), return_index=True, return_inverse=True)
    out = np.full((len(keys), len(langs)), np.nan)
    place = {x: i for i, x in enumerate(langs)}
    out[at, np.fromiter(map(place.__getitem__, got.column("lang").to_pylist()), np.int64, got.num_rows)] = got.column("v").to_numpy()
    return keys, codes[first], out


def _row_hashes(codes: np.ndarray) -> np.ndarray:
    """:func:`hashes` of each row of codes."""
    h = np.full(len(codes), codes.shape[1], np.uint64)
    for k in range(codes.shape[1]):
        h = h * np.uint64(BASE) + codes[:, k]
    return mix(h)


def _at(keys: np.ndarray, mine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``mine`` in the sorted ``keys``, and whether they are there."""
    place = np.minimum(np.searchsorted(keys, mine), len(keys) - 1)
    return place, keys[place] == mine


@dataclass
class Models:
    """The models of some languages: sorted hash arrays that they share, with a column of values per language.

    A language that lacks an n-gram of another one has, in its column, what
    backing off gives, so one search answers for all of them.
    """

    langs: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]]  # by order from 1: hashes, log p
    histories: list[tuple[np.ndarray, np.ndarray]]  # by size of the history from 0: hashes, log weight of the order below

    @classmethod
    def of(cls, probabilities: DataFrame, weights: DataFrame, langs: list[str]) -> Models:
        grams, histories = [], []
        for size in range(ORDER):
            keys, _, weight = _dense(weights, "weight", langs, size)
            histories.append((keys, np.nan_to_num(weight, nan=0.0)))
        for size in range(1, ORDER + 1):
            keys, codes, p = _dense(probabilities, "p", langs, size)
            place, known = _at(histories[size - 1][0], _row_hashes(codes[:, :-1]))
            backed = np.where(known[:, None], histories[size - 1][1][place], 0.0)
            if size > 1:
                # the n-gram without its first character is one of the order below, in some language
                backed += grams[-1][1][_at(grams[-1][0], _row_hashes(codes[:, 1:]))[0]]
            else:
                backed += math.log(UNSEEN)
            grams.append((keys, np.where(np.isnan(p), backed, p)))
        return cls(langs, grams, histories)

    def log_p(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per word: log-probability by language, and predicted characters."""
        codes, sizes = codes_of(words)
        ends = np.cumsum(sizes)
        begins = ends - sizes
        inner = np.ones(len(codes), bool)
        inner[(begins[:, None] + np.arange(ORDER - 1)).ravel()] = False
        at = np.flatnonzero(inner)
        total = np.zeros((len(at), len(self.langs)))
        left = np.arange(len(at))
        for n in range(ORDER, 0, -1):
            keys, values = self.grams[n - 1]
            place, hit = _at(keys, hashes(codes, n)[at[left] - n + 1])
            total[left[hit]] += values[place[hit]]
            left = left[~hit]
            if not len(left):
                break
            keys, values = self.histories[n - 1]
            if n > 1:
                place, hit = _at(keys, hashes(codes, n - 1)[at[left] - n + 1])
                total[left[hit]] += values[place[hit]]
            else:
                total[left] += values[0] + math.log(UNSEEN)
        n = sizes - (ORDER - 1)
        return np.add.reduceat(total, np.cumsum(n) - n), n

    def entropies(self, texts: list[str | None]) -> np.ndarray:
        """Cross-entropy per character by language; rows of NaN for texts without a letter."""
        index = Index()
        rows = [index.number(words_of(t)) for t in texts]
        out = np.full((len(texts), len(self.langs)), np.nan)
        if not index or not self.langs:
            return out
        words = list(index)
        letter = np.array([any(map(str.isalpha, w)) for w in words])
        p, n = self.log_p(words)
        for k, r in enumerate(rows):
            if len(r) and letter[r].any():
                out[k] = -p[r].sum(0) / n[r].sum()
        return out


def _sample(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, text, role``: about SAMPLE labelled rows per language, a fifth of them for calibration.

    A row is drawn when the hash of its doc_id is under its language's share,
    so no language is sorted or gathered in one task. The sizes are broadcast, a
    row per language.
    Languages of a few rows (``role`` 2) teach and calibrate with all of them.
    """
    teachers = docs.filter("doc_id is not null and text is not null and lang is not null")
    teachers = teachers.filter(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2)
    sizes = teachers.groupBy("lang").count()
    draw = (F.shiftrightunsigned(F.xxhash64(F.lit("draw"), "doc_id"), 11).cast("double") / F.lit(float(1 << 53))) * F.col("count") < SAMPLE
    fifth = (F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(5)) == 0).cast("int")
    role = F.when(F.col("count") < 25, 2).otherwise(fifth)
    return stored(teachers.join(F.broadcast(sizes), "lang").filter(draw).select("doc_id", "lang", "text", role.alias("role")).distinct(), "teachers")


@dataclass
class Learned:
    """The languages by name, the groups of them whose models fit a broadcast, and what was fitted to the sample."""

    langs: list[str]
    groups: list[list[str]]
    probabilities: DataFrame | None = None
    weights: DataFrame | None = None
    temperature: float = 1.0
    limit: np.ndarray | None = None

    def entropies(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows`` with ``entropy``, the cross-entropies by language in the order of ``langs``; null where a text has no letter.

        Every group of languages but the last is broadcast, met by all texts and released in turn.
        """
        spark = rows.sparkSession
        rows = rows.withColumn("entropy", F.array().cast("array<double>"))
        names = rows.columns
        text_at, entropy_at = names.index("text"), names.index("entropy")
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)

        def meeting(shared):
            def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for part in parts:
                    for s in range(0, part.num_rows, 2048):
                        some = part.slice(s, 2048)
                        e = shared.value.entropies(some.column(text_at).to_pylist())
                        # null from the first group on: a text has letters or not, whatever the languages
                        both = [None if old is None or np.isnan(new).any() else [*old, *new.tolist()] for old, new in zip(some.column(entropy_at).to_pylist(), e)]
                        columns = [pa.array(both, pa.list_(pa.float64())) if i == entropy_at else some.column(i) for i in range(len(names))]
                        yield pa.RecordBatch.from_arrays(columns, names)

            return run

        for k, group in enumerate(self.groups):
            shared = spark.sparkContext.broadcast(Models.of(self.probabilities, self.weights, group))
            rows = rows.mapInArrow(meeting(shared), schema)
            if k < len(self.groups) - 1:
                rows = stored(rows, name)
                shared.destroy()
        return rows


def _groups(sizes: list[tuple[str, int]]) -> list[list[str]]:
    """Languages in the order of their names, as many to a group as MODEL_BYTES holds, one at least.

    A group's arrays have a row for each n-gram of any of its languages and a column for each language.
    """
    out, rows = [], 0
    for lang, n in sorted(sizes):
        if not out or (rows + n) * (len(out[-1]) + 2) * 8 > MODEL_BYTES:
            out, rows = [*out, []], 0
        out[-1].append(lang)
        rows += n
    return out


def learn(docs: DataFrame) -> Learned:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    sample = _sample(docs)

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            by_lang: dict[str, Counter] = {}
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                by_lang.setdefault(lang, Counter()).update(words_of(text))
            for lang, words in by_lang.items():
                grams: Counter = Counter()
                for w, c in words.items():
                    w = EDGE * (ORDER - 1) + w + EDGE
                    for i in range(len(w) - ORDER + 1):
                        grams[w[i : i + ORDER]] += c
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(list(grams)), pa.array(list(grams.values()), pa.int64())], ["lang", "gram", "n"])

    grams = sample.filter("role <> 1").select("lang", "text").mapInArrow(count, "lang string, gram string, n long")
    probabilities, weights = kneser_ney(stored(grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams"))
    # a row per language reaches the driver, here and below
    sizes = probabilities.select("lang").unionByName(weights.select("lang")).groupBy("lang").count().collect()
    learned = Learned(sorted(r["lang"] for r in sizes), _groups([(r["lang"], r["count"]) for r in sizes]), probabilities, weights)
    if not learned.langs:
        return learned
    judged = learned.entropies(sample.filter("role <> 0").select("lang", "text"), "judged")
    names = F.array(*[F.lit(x) for x in learned.langs])
    judged = stored(judged.filter("size(entropy) > 0").select("lang", "entropy", F.array_position(names, F.col("lang")).alias("own")).filter("own > 0"), "entropies")
    own = F.element_at("entropy", F.col("own").cast("int"))
    spread_of = judged.groupBy("own").agg(F.avg(own).alias("mean"), F.stddev_pop(own).alias("sd")).collect()
    learned.limit = np.full(len(learned.langs), np.inf)
    for r in spread_of:
        learned.limit[r["own"] - 1] = r["mean"] + 4 * max(r["sd"], 0.05)
    tried = [2.0**k for k in range(-2, 8)]
    loss = [F.avg(F.least(F.lit(-math.log(1e-9)), _log_sum(t) + F.lit(t) * own)).alias(f"t{i}") for i, t in enumerate(tried)]
    losses = judged.agg(*loss).first()
    if losses[0] is not None:
        learned.temperature = tried[min(range(len(tried)), key=lambda i: losses[i])]
    return learned


def _log_sum(t: float):
    """log of the sum of exp(-t * entropy): less -t times the entropy of a language, its negative log softmax."""
    least = F.array_min("entropy")
    total = F.aggregate("entropy", F.lit(0.0), lambda acc, e: acc + F.exp((least - e) * t))
    return F.log(total) - least * t


def softmax(x: np.ndarray) -> np.ndarray:
    p = np.exp(x - x.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def predict(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, entropy, rejected`` per document."""
    learned = learn(docs)
    langs, temperature, limit = learned.langs, learned.temperature, learned.limit
    small = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    measured = learned.entropies(small, "entropies")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids, entropies = part.column(0).to_pylist(), part.column(1).to_pylist()
            lang, score, entropy, rejected = ["und"] * len(ids), np.zeros(len(ids)), np.full(len(ids), np.nan), np.ones(len(ids), bool)
            rows = np.array([k for k, e in enumerate(entropies) if e], np.int64)
            if len(rows):
                e = np.array([entropies[k] for k in rows])
                best = e.argmin(1)
                score[rows] = softmax(-temperature * e)[np.arange(len(rows)), best]
                entropy[rows] = e[np.arange(len(rows)), best]
                rejected[rows] = entropy[rows] > limit[best]
                for r, b in zip(rows.tolist(), best.tolist()):
                    lang[r] = langs[b]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([held_out(i) for i in ids]), pa.array(lang), pa.array(score), pa.array(entropy, mask=np.isnan(entropy)), pa.array(rejected)],
                ["doc_id", "held_out", "lang_pred", "score", "entropy", "rejected"],
            )

    return measured.select("doc_id", "entropy").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, entropy double, rejected boolean")
