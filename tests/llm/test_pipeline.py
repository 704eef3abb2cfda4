"""The pipeline against plain Python, stage after stage."""

import re
import zlib
from collections import Counter

import brute
import corpus_pipeline

from uptake.llm import quality
from uptake.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


def good(text, lang):
    n, chars, symbols, dup, repeat, failed = brute.quality(text)
    words = brute.WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if brute.WORD.search(x)]
    known = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyzÀÁÂÄÆÇÈÉÊËÌÍÎÏÑÓÔÖÙÚÛÜßàáâäæçèéêëìíîïñóôöùúûüÿŒœŸªº")
    m = {
        "n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": repeat, "n_lines": len(lines),
        "line_chars": sum(map(len, lines)), "dup_line_chars": sum(map(len, lines)) - sum(map(len, set(lines))),
        "n_stop_words": sum(w.lower() in quality.STOP_WORDS for w in words), "n_upper": sum(c.isupper() for w in words for c in w),
    }
    foreign = sum(c.isalpha() and c not in known for w in words for c in w) > chars * quality.FOREIGN or (lang or "en").lower() not in quality.LANGUAGES
    broken = (
        (m[r.measure] > m.get(r.per, 1) * r.above if r.above is not None else m[r.measure] < m.get(r.per, 1) * r.below) and not (r.unless_foreign and foreign)
        for r in quality.RULES if n >= r.from_words and len(lines) >= r.from_lines
    )
    return not failed and not any(broken)


def masked(text):
    found = [s for spans in brute.pii(text).values() for s in spans]
    found += [("secret", *m.span(1)) for m in re.finditer(r'token = "([0-9a-f]{40})"', text)]
    out, at = "", 0
    for kind, start, end in sorted(found, key=lambda s: (s[1], s[2])):
        if start >= at:
            out += text[at:start] + f"[{kind.upper()}]"
        at = max(at, end)
    return out + text[at:]


def test_pipeline(spark, small, small_rows):
    lang = {r.doc_id: r.lang for r in small.select("doc_id", "lang").collect()}
    rows = [(i, t) for i, t in small_rows if good(t, lang[i])]
    component = brute.near_components(rows, 5, 80)
    rows = [(i, t) for i, t in rows if component[i] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [(i, t) for (i, t), hit in zip(rows, brute.decontam(rows, items)) if not hit[5]]
    rows = [(i, masked(t)) for i, t in rows]
    docs = small
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == small.columns, name
    assert Counter((r.doc_id, r.text) for r in docs.collect()) == Counter(rows)
    got = corpus_pipeline.run(spark, SF).collect()
    place = 0
    want = Counter()
    for i, ids in brute.token_ids(sorted(rows), tokenizer_path()):
        start = 0
        while start < len(ids):
            n = min(len(ids) - start, 2048 - place % 2048)
            want[i, start, n, zlib.crc32(ids[start : start + n].astype("<u4").tobytes()), place // 2048, place % 2048] += 1
            start, place = start + n, place + n
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.sequence_id, r.offset) for r in got) == want
