"""Each operator against brute force: hostile rows, a small table, an empty table."""

import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from uptake.llm import batches, binary, chat, decontam, langid, lm, neardup, packing, pii, quality, substring, tokens
from uptake.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


def same(got, expected):
    assert Counter(map(tuple, got)) == Counter(map(tuple, expected))


@pytest.mark.parametrize("which", ["hostile", "small"])
def test_packing(which, request, small_rows):
    docs = request.getfixturevalue(which)
    rows = brute.hostile_rows() if which == "hostile" else small_rows
    pieces = packing.pack(docs, tokenizer_path(), 64, with_ids=True)
    got = pieces.orderBy("sequence_id", "offset").collect()
    # in order, the pieces are the stream of all documents, cut every 64 ids
    stream = np.concatenate([np.frombuffer(r.ids, "<u4") for r in got])
    place = 0
    by_doc = {}
    for r in got:
        assert (r.sequence_id, r.offset) == divmod(place, 64)
        assert r.ids_crc32 == zlib.crc32(r.ids) and r.length * 4 == len(r.ids)
        assert r.cut_before == (r.start > 0) and r.cut_after == (r.start + r.length < r.doc_tokens)
        by_doc.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
        place += r.length
    expected = brute.token_ids(rows, tokenizer_path())
    assert len(stream) == place == sum(len(x) for _, x in expected)
    want = Counter((i, x.astype("<u4").tobytes()) for i, x in expected)
    made = Counter()
    for i, parts in by_doc.items():
        whole = b""
        for start, ids in parts:
            if start == 0 and whole:
                made[i, whole] += 1
                whole = b""
            assert start * 4 == len(whole)
            whole += ids
        made[i, whole] += 1
    assert made == want
    full = packing.sequences(pieces, 64).collect()
    assert all(len(r.ids) == 256 for r in full) and len(full) == -(-place // 64)


@pytest.mark.parametrize("which", ["hostile", "small"])
def test_token_ids(which, request, small_rows):
    rows = brute.hostile_rows() if which == "hostile" else small_rows
    got = binary.token_index(request.getfixturevalue(which), tokenizer_path()).orderBy("start").collect()
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    ids = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids)
    same([(r.doc_id, r.n_tokens, r.ids_crc32) for r in got], [(i, len(x), zlib.crc32(x.astype("<u4").tobytes())) for i, x in brute.token_ids(rows, tokenizer_path())])


def test_token_ids_of_capitals_with_marks():
    """Letters that compose with a mark in lower case only."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    texts = [f"x {c}amza {c.lower()}amza A{c} the {c}" for c in ("H\u0331", "J\u030c", "T\u0308", "W\u030a", "Y\u030a")] + ["\u00c9t\u00e9 Plain, WORDS I\u0307 \u0130"]
    got = tokens.WordTokenizer(tokenizer_path()).encode(texts)
    assert [x.tolist() for x in got] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_simple8b_round_trip():
    r = np.random.default_rng(3)
    cases = [[], [0], [7], [0] * 1000, list(range(5000)), r.integers(0, 49408, 20001), [2**60 - 1, 2**63, 15 << 60, 0, 2**59] * 999]
    cases.append(r.integers(0, 2**63, 9999).astype(np.uint64) >> r.integers(0, 63, 9999).astype(np.uint64))
    for values in cases:
        values = np.array(values, np.uint64)
        words, offsets = binary.encode(values)
        assert (binary.decode(words) == values).all()
        edges = [*offsets.astype(int).tolist(), len(words)]
        blocks = [binary.decode(words[s:e]) for s, e in zip(edges, edges[1:])]
        assert all((b == values[k * binary.BLOCK : (k + 1) * binary.BLOCK]).all() for k, b in enumerate(blocks))


@pytest.mark.parametrize("which", ["hostile", "small"])
def test_lm(which, request, small_rows):
    rows = brute.hostile_rows() if which == "hostile" else small_rows
    got = lm.score(request.getfixturevalue(which), 0.1, (50.0, 5.0)).collect()
    rounded = lambda rs: [(*r[:5], round(r[5], 6), round(r[6], 6)) for r in rs]
    same(rounded(got), rounded(brute.lm(rows, 0.1, (50.0, 5.0))))


def test_lm_with_the_registered_parameters(small, small_rows):
    import inspect

    alpha, mu = (inspect.signature(lm.score).parameters[k].default for k in ("alpha", "mu"))
    got = lm.score(small).collect()
    rounded = lambda rs: [(*r[:5], round(r[5], 6), round(r[6], 6)) for r in rs]
    same(rounded(got), rounded(brute.lm(small_rows, alpha, mu)))


def test_lm_many_batches(small, small_rows, monkeypatch):
    monkeypatch.setattr(lm, "BATCH_BYTES", 20_000)
    got = lm.score(small, 0.1, (50.0, 5.0)).collect()
    rounded = lambda rs: [(*r[:5], round(r[5], 6), round(r[6], 6)) for r in rs]
    same(rounded(got), rounded(brute.lm(small_rows, 0.1, (50.0, 5.0))))


@pytest.mark.parametrize("lane", [1, 2, 7])
def test_lm_lanes_carry_the_same_state(lane, small_rows, monkeypatch):
    """Short lanes score as one lane a text does, on counts with unseen pairs, triples and words."""
    rows = [*brute.hostile_rows(), *small_rows[:60]]
    g = lm.Grams([i for i, _ in rows], [(t or "").encode() for _, t in rows])
    rng = np.random.default_rng(5)
    one = g.counts[1] * (rng.random(len(g.counts[1])) < 0.7)
    one[g.start] = 40
    two, three = np.flatnonzero(g.at[2] >= 0), np.flatnonzero(g.at[3] >= 0)
    ends = np.zeros((len(g.counts[2]), 2), np.int64)
    ends[g.at[2][two]] = np.stack((g.word[two - 1], g.word[two]), 1)
    pair = g.counts[2] * (rng.random(len(ends)) < 0.6) * (one[ends] > 0).all(1)
    halves = np.zeros((len(g.counts[3]), 2), np.int64)
    halves[g.at[3][three]] = np.stack((g.at[2][three - 1], g.at[2][three]), 1)
    triple = g.counts[3] * (rng.random(len(halves)) < 0.6) * (pair[halves] > 0).all(1)
    a = lm.Automaton(g, {1: one, 2: pair, 3: triple}, int(one.sum()), int((one > 0).sum()), 0.1, (200.0, 20.0))
    monkeypatch.setattr(lm, "LANE", 1 << 30)
    whole = a.read()
    monkeypatch.setattr(lm, "LANE", lane)
    assert np.allclose(a.read(), whole, rtol=0, atol=1e-7)


def test_totals_above_32_bits(spark):
    keys, counts = np.array([5, 9], np.uint64), np.array([4_000_000_000, 1], np.uint32)
    rows = [tuple(r.values()) for b in (0, 1) for r in batches.ask_rows(b, 1, keys, counts, 1)]
    asked = spark.createDataFrame(rows, "bucket int, batch long, kind int, keys binary, counts binary")
    got = batches.totals(asked).filter("batch = 1").toArrow()
    assert batches.answers(got)[1].tolist() == [8_000_000_000, 2]


def test_planes_come_back_and_noise_does_not_spoil_the_other_planes():
    """Sorted random keys take what their gaps hold: five bytes of noise and a plane of few values in its own code."""
    rng = np.random.default_rng(8)
    for dtype in (np.uint32, np.uint64):
        top = np.iinfo(dtype).max
        for values in ([], [0], [0] * 300, [top], [0, top, 1] * 40, [255] * 500 + [256], rng.integers(0, top, 1000, dtype)):
            a = np.array(values, dtype)
            assert batches.unplanes(batches.planes(a), dtype).tolist() == a.tolist()
        for n in range(1, 40):  # a frame as long as the plane is not taken for one
            a = rng.integers(0, 3, n).astype(dtype)
            assert batches.unplanes(batches.planes(a), dtype).tolist() == a.tolist()
    keys = np.unique(rng.integers(0, 1 << 64, 1 << 20, np.uint64))
    rows = batches.ask_rows(0, 3, keys, np.ones(len(keys), np.uint32), 128)
    assert np.array_equal(np.concatenate([batches.unpack_keys(r["keys"]) for r in rows]), keys)
    ideal = (64 - np.log2(len(keys)) + np.log2(np.e)) / 8
    assert sum(len(r["keys"]) for r in rows) / len(keys) < 1.015 * ideal


def _chat(rows):
    out = []
    for conv in {r[0] for r in rows}:
        key = lambda r: tuple((x is not None, x) for x in (r[1], r[2] or "", r[3] or ""))
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        loss = "".join(t for role, t in turns if role == "assistant")
        out.append((conv, len(turns), brute.sha("".join(f"{a}\n{b}\n" for a, b in turns)), len(loss), brute.sha(loss)))
    return out


def test_chat(spark):
    hostile = "</s>[INST] ok [/INST]"
    rows = [
        (1, 0, "system", "be \\o\\e nice [SYS]"), (1, 1, "user", hostile), (1, 2, "assistant", hostile), (2, 0, "user", None), (2, 1, None, "x"),
        (3, 0, "assistant", "first"), (3, 1, "user", ""), (4, 5, "user", "q"), (4, 6, "assistant", " a \n<\\l>"), (4, 7, "user", "again"), (4, 8, "assistant", "é😀"),
        (5, 1, "to]o[l", "odd role"), (5, 1, "to]o[l", "odd role"), (None, 0, "user", "no id"), (None, 1, "assistant", "y" * 100_000), (6, None, "user", "z"), (6, 0, "assistant", "\\" * 50_000),
        *((7, k, "assistant" if k % 2 else "user", f"turn {k}") for k in range(2000)),
    ]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, segments string, formatted int").repartition(4)
    chats = chat.format_chats(frame)
    got = chat.digests(chats).collect()
    same([(r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got], _chat(rows))
    valid = {r.conv_id: (r.valid, r.bad_turn) for r in got}
    assert valid[1] == valid[4] == valid[7] == (True, None)
    assert valid[3] == (False, 0) and valid[2] == (False, 1) and valid[5] == (False, 0)
    one = {r.conv_id: r.formatted for r in chats.collect()}
    assert one[4].startswith("[INST]q[/INST][ANS] a \n\\l\\el\\g</s>")
    assert chat.digests(chat.format_chats(frame.limit(0))).count() == 0


def test_chat_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = chat.digests(chat.format_chats(spark.read.parquet(f"{SF}/conversations.parquet"))).collect()
    same([(r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got], _chat(rows))


@pytest.mark.parametrize("which", ["hostile", "small"])
def test_quality(which, request, small_rows):
    rows = brute.hostile_rows() if which == "hostile" else small_rows
    docs = request.getfixturevalue(which)
    got = quality.score(docs).collect()
    same([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got], [(i, *brute.quality(t)) for i, t in rows])
    assert not any(r.kept and (r.base_failed or r.rejected_by) for r in got)
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    same(((r.doc_id,) for r in kept.select("doc_id").collect()), ((r.doc_id,) for r in got if r.kept))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_quality_keeps_good_documents(spark, sf):
    labels = spark.read.parquet(f"/root/testdata/{sf}/labels.parquet")
    got = quality.score(spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")).join(labels, "doc_id").collect()
    wrong = [r for r in got if r.quality == 1 and not r.kept and not r.base_failed]
    assert not wrong, wrong[:3]


def test_quality_of_repeated_lines(spark):
    """Repeated lines reject a text by the characters they hold, and only in a text of ten lines."""
    line = lambda k: f"this is line number {k} of the text and it says that {'abcdefghij'[k % 10] * 3}{k} is here"
    texts = {
        1: "\n".join([line(0), line(1), line(1)]),  # few lines
        2: "\n".join([line(k) for k in range(9)] + ["-"] * 9),  # many short repeats
        3: "\n".join([line(k) for k in range(6)] + [line(0), line(2), line(4), line(5)]),  # four long repeats of ten
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in quality.score(docs).collect()}
    assert [("duplicate_lines" in got[k].rejected_by) for k in (1, 2, 3)] == [False, False, True]
    lines = texts[3].split("\n")
    assert (got[3].line_chars, got[3].dup_line_chars) == (sum(map(len, lines)), sum(map(len, lines)) - sum(map(len, set(lines))))


def test_quality_stage_keeps_languages_without_stop_words(spark):
    prose = lambda words: " ".join(f"{words[i % len(words)]}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120))
    texts = {3: prose(["слово", "жизнь", "город"]), 4: prose(["źdźbło", "książka", "łąka"]), 5: prose(["zork", "blim"]), 6: prose(["zork", "blim"])}
    docs = spark.createDataFrame([(i, t, {6: "id"}.get(i)) for i, t in texts.items()], "doc_id long, text string, lang string")
    assert {r.doc_id for r in quality.keep(docs).collect()} == {3, 4, 6} == {r.doc_id for r in quality.score(docs).collect() if r.kept}


def test_language_id(spark, hostile):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    true = {r.doc_id: r.lang for r in docs.collect()}
    got = langid.predict(docs).collect()
    assert len(got) == len(true)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.lang_pred == true[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    odd = langid.predict(hostile).collect()
    texts = {}
    for i, t in brute.hostile_rows():
        texts.setdefault(i, t)
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in texts[r.doc_id] or "")) for r in odd)


@pytest.mark.parametrize("model_bytes", [langid.MODEL_BYTES, 1])
def test_language_id_against_brute_force(spark, small, small_rows, monkeypatch, model_bytes):
    """Entropies and languages as plain Kneser-Ney gives them; twins tie, a language of few rows teaches with all, groups of one language."""
    monkeypatch.setattr(langid, "MODEL_BYTES", model_bytes)
    lang = {r.doc_id: r.lang for r in small.select("doc_id", "lang").collect()}
    rows = [(i, t, lang[i]) for i, t in small_rows]
    rows += [(1000 + k, t, "zz") for k, (_, t) in enumerate(brute.hostile_rows()[:24])]  # under 25 teachers
    taught = [i for i in range(2000, 2100) if zlib.crc32(str(i).encode()) % 4 != 2][:12]  # equal counts for both twins
    rows += [(i, "tw\u0131n \u4e2d\u6587 \U00010400x words", f"twin{2 - k % 2}") for k, i in enumerate(taught)]
    rows += [(i, "\u4e2d\u6587 tw\u0131n", None) for i in (3000, 3001, None)] + [(4000, "... 12", "zz"), (4001, None, "zz"), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    teachers = {}
    for r in langid._sample(docs).collect():
        if r.role != 1:
            teachers.setdefault(r.lang, []).append(r.text)
    models = {x: brute.KneserNey(ts) for x, ts in sorted(teachers.items())}
    assert {"zz", "twin1", "twin2"} < set(models)
    expected = []
    for i, t, _ in rows:
        if any(c.isalpha() for c in t or ""):
            e = {x: m.entropy(t) for x, m in models.items()}
            least = min(e.values())
            expected.append((i, next(x for x in sorted(e) if e[x] - least < 1e-12), round(least, 6)))
        else:
            expected.append((i, "und", None))
    got = langid.predict(docs).collect()
    same(((r.doc_id, r.lang_pred, r.entropy and round(r.entropy, 6)) for r in got), expected)
    assert any(r.lang_pred == "twin1" for r in got) and not any(r.lang_pred == "twin2" for r in got)


def test_language_id_without_teachers(small):
    got = langid.predict(small.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}


def _kneser_ney(spark, counts):
    rows = spark.createDataFrame([("x", g, n) for g, n in counts.items()], "lang string, gram string, n long")
    probabilities, weights = langid.kneser_ney(rows)
    probability, backoff = ([{} for _ in range(langid.ORDER)] for _ in range(2))
    for r in probabilities.collect():
        probability[r["size"] - 1][r.gram] = r.p
    for r in weights.collect():
        backoff[r["size"]][r.gram] = r.weight
    return probability, backoff


def test_kneser_ney_is_proper(spark):
    counts = Counter()
    for w in ("abba", "abc", "cab", "bab"):
        w = langid.EDGE * (langid.ORDER - 1) + w + langid.EDGE
        counts.update(w[i : i + langid.ORDER] for i in range(len(w) - langid.ORDER + 1))
    probability, backoff = _kneser_ney(spark, counts)
    symbols = [g for g in probability[0]]
    for n in range(2, langid.ORDER + 1):
        for h in backoff[n - 1]:
            total = sum(probability[n - 1].get(h + s, backoff[n - 1][h] * _lower(probability, backoff, h[1:] + s)) for s in symbols)
            rest = (1 / langid.UNSEEN - len(symbols)) * _lower(probability, backoff, h + "?")
            assert abs(total + rest - 1) < 1e-9


def _lower(probability, backoff, gram):
    n = len(gram)
    if gram in probability[n - 1]:
        return probability[n - 1][gram]
    return backoff[n - 1].get(gram[:-1], 1.0) * (_lower(probability, backoff, gram[1:]) if n > 1 else langid.UNSEEN)


@pytest.mark.parametrize("which", ["hostile", "small"])
def test_substring(which, request, small_rows, monkeypatch):
    rows = brute.hostile_rows() if which == "hostile" else small_rows
    monkeypatch.setattr(substring, "BATCH_BYTES", 30_000)
    got = substring.repeats(request.getfixturevalue(which)).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()
    same(got, brute.substring(rows))


@pytest.mark.parametrize("which,n,percent", [("hostile", 3, 85), ("small", 3, 85), ("small", 5, 80)])
def test_near_duplicates(which, n, percent, request, small_rows):
    rows = brute.hostile_rows() if which == "hostile" else small_rows
    component = brute.near_components(rows, n, percent)
    got = neardup.near_duplicates(request.getfixturevalue(which), n, percent).collect()
    same(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), ((i, len(brute.shingles(t, n)), component.get(i), i is None or component[i] == i) for i, t in rows))


def test_near_duplicates_by_pivots(small, small_rows, monkeypatch):
    """With every group a large one, pivots and what they leave find the same components."""
    monkeypatch.setattr(neardup, "AT_ONCE", 0)
    component = brute.near_components(small_rows, 3, 85)
    got = neardup.near_duplicates(small, 3, 85).collect()
    assert {r.doc_id: r.component_id for r in got} == component


def test_drop_copies(hostile):
    got = neardup.drop_copies(hostile)
    assert got.columns == hostile.columns
    ids = [r.doc_id for r in got.collect()]
    component = brute.near_components(brute.hostile_rows(), 5, 80)
    assert Counter(ids) == Counter([None] + [i for i, c in component.items() if i == c])


@pytest.mark.parametrize("at_once", [64, 0])
def test_one_id_with_several_texts(spark, monkeypatch, at_once):
    """Two and three different texts of one doc_id, each with a near copy of another doc_id."""
    monkeypatch.setattr(neardup, "AT_ONCE", at_once)
    r = np.random.default_rng(3)
    text = [" ".join(f"w{x}" for x in r.integers(0, 10**6, 200)) for _ in range(7)]
    near = [f"{t} more" for t in text]
    rows = [(1, text[0]), (1, text[1]), (5, text[2]), (5, text[3]), (5, text[4]), (5, ""), (6, near[3]), (7, near[0]), (8, near[1]), (9, near[2]), (10, near[4])]
    rows += [(3, text[5]), (4, near[5]), (4, text[6]), (11, near[6]), (4, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    component = brute.near_components(rows, 5, 80)
    got = neardup.near_duplicates(docs, 5, 80).collect()
    same(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), ((i, len(brute.shingles(t, 5)), component[i], component[i] == i) for i, t in rows))
    # no text is dropped but for one that a kept text is near to; the copies of the larger ids go
    left = neardup.drop_copies(docs, 5, 80).collect()
    same(left, [*rows[:6], rows[11], rows[13], rows[15]])


def templates(count, shared=430, own=70, seed=5):
    """Pages of one template: ``shared`` words of all and, at their end, ``own`` words of each; every tenth has a near copy."""
    r = np.random.default_rng(seed)
    head = " ".join(f"t{x}" for x in range(shared))
    rows = []
    for i in range(count):
        words = [f"w{x}" for x in r.integers(0, 10**9, own)]
        rows.append((2 * i, f"{head} {' '.join(words)}"))
        if i % 10 == 0:
            words[own // 2] = "other"
            rows.append((2 * i + 1, f"{head} {' '.join(words)}"))
    return rows


@pytest.mark.parametrize("percent", [80, 85])
def test_pages_of_one_template(spark, percent):
    """Pages just under the threshold share every band's groups; only those that are near copies are compared and linked."""
    rows = templates(400, *((430, 70) if percent == 85 else (410, 90)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 3, percent).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}
    sets = spark.createDataFrame([(i, x.view(np.int64).tolist()) for (i, _), x in zip(rows, neardup.shingle_sets([t for _, t in rows], 3))], "rep long, shingles array<long>")
    rare = neardup._rarest(sets, percent)
    met = rare.filter("short").join(rare.select("key", F.col("rep").alias("other")), "key").filter("rep <> other").select(F.least("rep", "other"), F.greatest("rep", "other")).distinct().collect()
    assert set(met) >= {(i - 1, i) for i, _ in rows if i % 2} and len(met) < 2 * len(rows)


def test_rarest_shingles_meet(spark):
    """Of two sets at the threshold, one of the smaller one's rarest shingles is among the larger one's."""
    r = np.random.default_rng(11)
    rows, pairs = [], []
    for i in range(200):
        size = int(r.integers(1, 120))
        common = r.choice(400, size, replace=False)
        gone = int(size * 0.15 * r.random())
        rows += [(2 * i, common.tolist()), (2 * i + 1, common[gone:].tolist())]
        pairs.append((2 * i, 2 * i + 1))
    keys, short = {}, {}
    for key, rep, first in neardup._rarest(spark.createDataFrame(rows, "rep long, shingles array<long>"), 85).collect():
        keys.setdefault(rep, set()).add(key)
        short.setdefault(rep, set()).update([key] if first else [])
    sets = {i: set(x) for i, x in rows}
    linked = [(a, b) for a in sets for b in sets if a != b and len(sets[a]) <= len(sets[b]) and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    assert len(linked) >= len(pairs) and all(short[a] & (short if len(sets[a]) == len(sets[b]) else keys)[b] for a, b in linked)


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_recall_at_the_threshold(spark, percent):
    """2000 pairs of a Jaccard similarity from the threshold to 0.03 above it: all pass the bands, the bits and the estimate."""
    assert neardup.banding(85) == (32, 6) and neardup.banding(80) == (38, 5)
    r, t = np.random.default_rng(percent), percent / 100
    shape, sets, pairs = neardup.banding(percent), [], []
    for k in range(2000):
        size = int(r.choice([30, 60, 150, 400, 2000]))
        share = t + 0.03 * r.random()
        common = -(-int(2 * size * share * 1000 / (1 + share)) // 1000)
        pool = np.unique(r.integers(1, 2**64 - 1, 2 * size + 50, np.uint64))
        r.shuffle(pool)
        a, b = np.sort(pool[:size]), np.sort(np.concatenate((pool[:common], pool[size : 2 * size - common])))
        if 100 * common >= percent * (2 * size - common):
            pairs.append(len(sets))
            sets += [a, b]
    assert len(pairs) > 1500
    rows = [neardup.registers(x) for x in sets]
    signed = [neardup.signature(x, *shape) for x in rows]
    for k in pairs:
        assert set(signed[k][0]) & set(signed[k + 1][0])
    table = [(len(sets[k]), len(sets[k + 1]), *signed[k][1:], *signed[k + 1][1:]) for k in pairs]
    facts = spark.createDataFrame(table, "n_1 long, n_2 long, bits_1_1 long, bits_2_1 long, bits_1_2 long, bits_2_2 long")
    assert facts.filter(~neardup._may_link(percent)).count() == 0
    n = [np.array([len(sets[k + side]) for k in pairs], float) for side in (0, 1)]
    share, used = neardup.estimate(np.array([rows[k] for k in pairs]), np.array([rows[k + 1] for k in pairs]), *n)
    assert (share >= t - 5 * np.sqrt(t * (1 - t) / np.maximum(used, 1))).all()


def test_estimate_follows_jaccard():
    r = np.random.default_rng(5)
    pool = r.integers(0, 2**63, 4000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    for share in (0.5, 0.85, 1.0):
        both = int(2000 * share)
        a, b = np.unique(pool[:2000]), np.unique(np.concatenate((pool[:both], pool[2000 : 4000 - both])))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        got, used = neardup.estimate(neardup.registers(a)[None], neardup.registers(b)[None], np.array([len(a)]), np.array([len(b)]))
        assert used[0] == 256 and abs(got[0] - true) < 0.12


@pytest.mark.parametrize("which", ["hostile", "small"])
def test_pii(which, request, small_rows):
    rows = brute.hostile_rows() if which == "hostile" else small_rows
    got = pii.report(request.getfixturevalue(which)).collect()
    expected = []
    for i, t in rows:
        found = brute.pii(t)
        listed = ",".join(":".join(map(str, s)) for k in ("email", "ip", "card", "phone") for s in found[k])
        expected.append((i, *(len(found[k]) for k in ("email", "ip", "card", "phone")), brute.sha(listed), listed))
    base = lambda spans: ",".join(s for s in spans.split(",") if s.split(":")[0] in ("email", "ip", "card", "phone"))
    same(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, base(r.spans)) for r in got), expected)


def test_pii_checks_and_mask(spark):
    texts = {
        1: "iban GB82 WEST 1234 5698 7654 32 ok", 2: "iban GB82 WEST 1234 5698 7654 33 no", 3: 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"',
        4: "just 24be64439e3e49cf46b2d7c90f3602a3d0b907ff here", 5: "write to a@b.co, call +1 (555) 123-4567.", 6: None, 7: "1." * 20_000 + "a@" * 20_000, 8: "9" * 100_000,
    }
    docs = spark.createDataFrame([(k, v, 9, "p") for k, v in texts.items()], "doc_id long, text string, n_chars long, masked string")
    got = {r.doc_id: r for r in pii.report(docs).collect()}
    assert (got[1].n_iban, got[2].n_iban, got[3].n_secret, got[4].n_secret) == (1, 0, 1, 0)
    assert got[8].spans == "" and got[6].spans == ""
    masked = pii.mask(docs)
    assert masked.columns == docs.columns
    out = {r.doc_id: r for r in masked.collect()}
    assert out[5].text == "write to [EMAIL], call [PHONE]." and out[5].n_chars == len(out[5].text)
    assert out[1].text == "iban [IBAN] ok" and out[6].text is None and out[6].n_chars == 9 and out[4].text == texts[4]


def test_pii_of_many_spans_takes_time_in_proportion(spark):
    """Cutting a text at its spans: twice the spans, about twice the time, and the text as plain Python cuts it."""
    import time

    def run(n):
        text = " ".join(f"é{k} bob{k}@mail.example.com 10.0.{k % 300}.7" for k in range(n))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.perf_counter()
        got = pii.mask(docs).first().text
        return got, time.perf_counter() - start

    run(100)
    (small, few), (large, many) = run(8_000), run(16_000)
    for n, got in ((8_000, small), (16_000, large)):
        assert got == " ".join(f"é{k} [EMAIL] " + ("[IP]" if k % 300 < 256 else f"10.0.{k % 300}.7") for k in range(n))
    assert many < 2.5 * few + 1


def test_pii_of_overlapping_spans(spark):
    texts = ["+1 4111 1111 1111 1111 x", "a 4111 1111 1111 1111@b.co", "10.0.0.1@host.example 1.2.3.4.5.6.7.8 +49 (30) 1.2.3.4 99"] * 400
    text = "\U0001f600 ".join(texts)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = [s.split(":") for s in pii.report(docs).first().spans.split(",")]
    out, at = [], 0
    for start, end, kind in sorted((int(s), int(e), k) for k, s, e in spans):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    assert pii.mask(docs).first().text == "".join(out) + text[at:]


def test_pii_numbers_before_words_and_long_tokens(spark):
    ibans = ["ES91 2100 0418 4502 0005 1332", "AT61 1904 3002 3457 3201", "BE68 5390 0754 7034", "PL61 1090 1014 0000 0712 1981 2874", "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947"]
    texts = [f"IBAN {i}{end}" for i in ibans for end in (" BIC CAIXESBB", " EUR", " 100", " 1234 5678", " now", ".", "")] + [f"konto {i.replace(' ', '')} BIC" for i in ibans]
    texts += [f"account REF AB12 3456 7890 {i} EUR" for i in ibans]
    tokens_ = ["a" * 65 + "1" * 20, "b" * 5000 + "7", "c" * 60 + "1" * 20]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts + [f'token = "{t}"' for t in tokens_])], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.report(docs).collect()}
    for k, t in enumerate(texts):
        iban = next(i for x in ibans for i in (x, x.replace(" ", "")) if i in t)
        assert f"iban:{t.index(iban)}:{t.index(iban) + len(iban)}" in got[k].spans.split(","), t
    assert [got[len(texts) + k].n_secret for k in range(3)] == [1, 1, 1]
    assert "[IBAN] BIC" in pii.mask(docs.limit(1)).first().text


def test_decontamination(spark, hostile, small, small_rows, monkeypatch):
    rows = brute.hostile_rows()
    text = [t for _, t in rows if t and len(t) > 300]
    items = [(1, " ".join(text[1].split()[:14]).upper()), (2, "one two"), (3, None), (4, ""), (None, "née ünïcode"), (10, "!!! two ??? WORDS"), (1, "one")]
    items += [(20, " ".join(text[2].split()[5:15])), (21, " ".join(text[2].split()[5:15])), (22, "the 中文")]
    bench = spark.createDataFrame([(*x, "y") for x in items], "item_id long, text string, doc_id string")
    digest = lambda docs, b: decontam.digest(decontam.scan(docs, b)).collect()
    same(digest(hostile, bench), brute.decontam(rows, items))
    real = spark.read.parquet(f"{SF}/benchmark.parquet")
    expected = brute.decontam(small_rows, [(r.item_id, r.text) for r in real.collect()])
    assert any(x[5] for x in expected)
    same(digest(small, real), expected)
    assert not any(r.contaminated for r in digest(small, real.limit(0)))
    kept = decontam.drop_contaminated(small, real)
    assert kept.columns == small.columns
    same(((r.doc_id,) for r in kept.collect()), ((x[0],) for x in expected if not x[5]))
    monkeypatch.setattr(decontam, "PATTERN_BYTES", 20_000)  # several automatons in turn
    same(digest(small, real), expected)
    spans = decontam.scan(small, real).filter("n_hit > 0").join(small.select("doc_id", "text"), "doc_id").collect()
    for r in spans:
        for word, place in zip(r.hit_words, r.hit_chars):
            assert len(brute.BENCH_WORD.findall(brute.lower(r.text[place.start : place.end]))) == word.end - word.start


def test_empty_tables(empty, spark):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    path = tokenizer_path()
    for made in (
        packing.pack(empty, path), binary.token_index(empty, path), lm.score(empty), quality.score(empty), quality.keep(empty), langid.predict(empty),
        substring.repeats(empty), neardup.near_duplicates(empty), neardup.drop_copies(empty), pii.report(empty), pii.mask(empty), decontam.scan(empty, bench), decontam.drop_contaminated(empty, bench),
    ):
        assert made.count() == 0
