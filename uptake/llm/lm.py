"""N-gram language model as a weighted backoff automaton.

Tokens are words (A-Z lower-cased) and an end token per document. Unigrams are
smoothed by adding ``alpha`` to each of the V known tokens and one unknown; each
higher order gives the lower one the weight of ``mu`` observations:

    p(w | h) = (c(hw) + mu p(w | h')) / (c(h) + mu)

which is proper at every order. States are the histories seen in training. A
state has an arc per continuation seen, with log10 p, and a failure arc with
log10(mu / (c(h) + mu)) to the history without its first token; state 0, the
empty history, has an arc for every token. A text is read once from left to
right: each token leaves the state of the longest history seen, by its arc or
by failure arcs and the arc of the state they lead to.

Counts come from all training documents, through
:mod:`uptake.llm.batches`: a batch asks for the totals of its own n-grams, so it
builds just the part of the automaton that its texts can reach, which gives
the same scores as the whole. Words and n-grams are compared by 64-bit hashes;
an n-gram takes the count of another with odds of n / 2^64.

Defined results: a null text is an empty one and is the end token alone; a
null doc_id counts as the text ``null``; repeated rows are documents of their
own; texts are read whole; without training documents every token is unknown;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.llm.batches import answers, ask, ask_rows, bucket_count, text_batches, texts_of, totals
from uptake.llm.store import stored
from uptake.llm.words import BASE, Index, mix, word_hashes

BATCH_BYTES = 10 << 20
#: Tokens that a lane reads; longer texts are read in several lanes.
LANE = 512
#: The start of a text and its end, which no word can be.
START, END = b"\n", b""
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_ARROW = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def held_out(doc_id: int | None, folds: int = 10) -> bool:
    return zlib.crc32(str(doc_id if doc_id is not None else "null").encode()) % folds == 0


class Grams:
    """Distinct n-grams of a batch. Kind 1 are tokens with START, 2 pairs, 3 triples."""

    def __init__(self, doc_ids: list[int | None], texts: list[bytes]):
        index = Index()
        self.start, self.end = index[START], index[END]
        rows = [index.number(t.lower().split()) for t in texts]
        self.held = [held_out(i) for i in doc_ids]
        #: per document START, words, END
        self.lengths = np.array([len(r) + 2 for r in rows], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        parts, s, e = [], np.array([self.start]), np.array([self.end])
        for r in rows:
            parts += [s, r, e]
        flat = self.flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
        train = np.repeat(~np.array(self.held, bool), self.lengths)
        self.n_words = len(index)
        hashes = mix(word_hashes(index) + np.uint64(1))
        self.keys, self.counts, self.at = {}, {}, {}
        # kind 1: order the words by hash, so that a word's number is its place among the keys
        keys, place = np.unique(hashes, return_inverse=True)
        self.word = place[flat]
        self.start, self.end = int(place[self.start]), int(place[self.end])
        self._kind(1, keys, self.word, train)
        first = np.zeros(len(flat), bool)
        first[self.begins] = True
        # kind 2 ends at every token but START; kind 3 at every token from the second word or END on
        tail = hashes[flat]
        two = np.flatnonzero(~first)
        pair = mix(tail[two - 1] * np.uint64(BASE) + tail[two] + np.uint64(2))
        keys, at = np.unique(pair, return_inverse=True)
        self.at[2] = np.full(len(flat), -1)
        self.at[2][two] = at
        self._kind(2, keys, at, train[two])
        second = np.zeros(len(flat), bool)
        second[self.begins + 1] = True
        three = np.flatnonzero(~first & ~second)
        full = np.zeros(len(flat), np.uint64)
        full[two] = pair
        keys, at = np.unique(mix(full[three - 1] * np.uint64(BASE) + tail[three] + np.uint64(3)), return_inverse=True)
        self.at[3] = np.full(len(flat), -1)
        self.at[3][three] = at
        self._kind(3, keys, at, train[three])

    def _kind(self, kind: int, keys: np.ndarray, at: np.ndarray, train: np.ndarray) -> None:
        self.keys[kind] = keys
        self.counts[kind] = np.bincount(at[train], minlength=len(keys)).astype(np.uint32)


class Automaton:
    """The part of the backoff automaton that one batch can reach, as arrays.

    States: 0 is the empty history, then one per token and one per pair of the
    batch; a state that training has not shown is never entered. Arcs: one per
    token (leaving state 0), pair and triple, numbered in that order, with the
    state each leads to; the weight is NaN where training has not shown the
    arc. ``fail_to`` and ``fail`` are the failure arc of each state. The arc of
    a state of level L (0, 1, 2 tokens of history) for the token at a place of
    the text is the gram of L + 1 tokens that ends there: ``label[L]``.
    """

    def __init__(self, grams: Grams, count: dict[int, np.ndarray], n: int, v: int, alpha: float, mu: tuple[float, float]):
        c1, c2, c3 = (count.get(k, np.empty(0, np.uint32)).astype(np.float64) for k in (1, 2, 3))
        g = grams
        token = c1.copy()
        token[g.start] = 0  # START is no token
        self.known = token > 0
        two, three = (np.flatnonzero(g.at[k] >= 0) for k in (2, 3))
        first, last, head, tail = (np.zeros(len(c), np.int64) for c in (c2, c2, c3, c3))
        first[g.at[2][two]], last[g.at[2][two]] = g.word[two - 1], g.word[two]
        head[g.at[3][three]], tail[g.at[3][three]] = g.at[2][three - 1], g.at[2][three]
        p1 = (token + alpha) / (n + alpha * (v + 1))
        p2 = (c2 + mu[0] * p1[last]) / (c1[first] + mu[0])
        p3 = (c3 + mu[1] * p2[tail]) / (c2[head] + mu[1])
        seen = lambda p, c: np.where(c > 0, np.log10(p), np.nan)
        words, pairs = len(c1), len(c2)
        word_state, pair_state = np.where(c1 > 0, 1 + np.arange(words), 0), 1 + words + np.arange(pairs)
        self.arc = np.concatenate((np.log10(p1), seen(p2, c2), seen(p3, c3)))
        self.to = np.concatenate((word_state, pair_state, pair_state[tail]))
        self.fail = np.concatenate(([0.0], np.log10(mu[0] / (c1 + mu[0])), np.log10(mu[1] / (c2 + mu[1]))))
        self.fail_to = np.concatenate(([0], np.zeros(words, np.int64), word_state[last]))
        self.level = np.repeat(np.arange(3), (1, words, pairs))
        self.label = np.stack((g.word, words + g.at[2], words + pairs + g.at[3]))
        self.begin = word_state[g.start]
        self.grams = g

    def base(self) -> np.ndarray:
        """The weight of the arc of state 0 for every token."""
        return self.arc[self.grams.word[self.grams.at[2] >= 0]]

    def read(self) -> np.ndarray:
        """Per document the weight of its path, texts read from left to right in lockstep.

        Each lane carries a state and a sum, one token a step: while the state
        has no arc for the token it takes the failure arc. A text of more than
        ``LANE`` tokens is read in several lanes. Histories have two tokens,
        so a lane that starts in state 0 two tokens early is in the
        state that one reading from the text's begin would be in.
        """
        g = self.grams
        tokens = g.lengths - 1
        lanes = -(-tokens // LANE)
        doc = np.repeat(np.arange(len(tokens)), lanes)
        place = (np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)) * LANE
        early = np.where(place > 0, 2, 0)
        length = np.minimum(tokens[doc] - place, LANE) + early
        order = np.argsort(-length, kind="stable")
        doc, place, early, length = doc[order], place[order], early[order], length[order]
        at = g.begins[doc] + 1 + place - early
        state = np.where(place > 0, 0, self.begin)
        total = np.zeros(len(doc))
        live = np.searchsorted(-length, -np.arange(length.max(initial=0)), "left")
        for k, m in enumerate(live.tolist()):
            here, now = at[:m] + k, state[:m]
            arc = self.label[self.level[now], here]
            weight = self.arc[arc]
            missed = np.flatnonzero(np.isnan(weight))
            weight[missed] = 0
            while len(missed):
                weight[missed] += self.fail[now[missed]]
                now[missed] = self.fail_to[now[missed]]
                arc[missed] = self.label[self.level[now[missed]], here[missed]]
                step = self.arc[arc[missed]]
                found = ~np.isnan(step)
                weight[missed[found]] += step[found]
                missed = missed[~found]
            state[:m] = self.to[arc]
            total[:m] += weight if k > 1 else np.where(k < early[:m], 0, weight)
        return np.bincount(doc, total, len(tokens))


def score(docs: DataFrame, alpha: float = 0.1, mu: tuple[float, float] = (200.0, 20.0)) -> DataFrame:
    """Score every document by the model learned from those that are not held out."""
    batches = text_batches(docs, BATCH_BYTES, "texts")
    buckets = bucket_count(batches, bytes_per_key=2)

    def questions(row: pa.RecordBatch) -> Iterator[list[dict]]:
        g = Grams(row.column("doc_id")[0].as_py(), texts_of(row))
        for kind in (1, 2, 3):
            yield ask_rows(row.column(0)[0].as_py(), kind, g.keys[kind], g.counts[kind], buckets)

    replies = stored(totals(ask(batches, questions), summary=True), "counts")
    # one row per bucket: distinct tokens and their sum, with START, which is taken off again
    distinct = tokens = 0
    sums = replies.filter("batch = -1 and kind = 1").select("counts")

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            pairs = np.array([np.frombuffer(x.as_py(), np.int64) for x in part.column(0)]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["distinct", "tokens"])

    row = sums.mapInArrow(add, "distinct long, tokens long").agg(F.sum("distinct"), F.sum("tokens")).first()
    text = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("null"))
    starts = docs.select(F.col("doc_id")).filter(F.pmod(F.crc32(text.cast("binary")), F.lit(10)) != 0).count()
    distinct, tokens = (row[0] or 0) - (starts > 0), (row[1] or 0) - starts

    def read(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {f.name: [] for f in _ARROW}
        for k in range(left.num_rows):
            doc_ids = left.column("doc_id")[k].as_py()
            g = Grams(doc_ids, texts_of(left, k))
            a = Automaton(g, answers(right), tokens, distinct, alpha, mu)
            base, weight = a.base(), a.read()
            known = a.known[g.word[g.at[2] >= 0]]
            begins = g.begins - np.arange(len(doc_ids))  # without the STARTs before
            out["doc_id"] += doc_ids
            out["held_out"] += g.held
            out["n_tokens"] += (g.lengths - 1).tolist()
            out["n_known"] += np.add.reduceat(known.astype(np.int64), begins).tolist()
            out["train_tokens"] += [tokens] * len(doc_ids)
            out["base_score"] += np.add.reduceat(base, begins).tolist()
            out["score"] += weight.tolist()
        return pa.Table.from_pydict(out, _ARROW)

    mine = replies.filter("batch >= 0")
    return batches.groupBy("batch").cogroup(mine.groupBy("batch")).applyInArrow(read, RESULT)
