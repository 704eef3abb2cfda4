"""Plain Python statements of the operators' results, and rows that try them."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = "abcdefghijklmnop"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def hostile_texts(seed=7):
    """Null, empty, blank, very long, repeated, copied and odd texts."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice(LETTERS) for _ in range(r.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage = prose(60)
    base = prose(300).split()
    near = base[:150] + ["changed"] + base[151:]
    texts = [
        None, "", "   \n\t ", "one", "one two", "two words", "x" * 5000, passage, passage, prose(40) + " " + passage + " " + prose(30),
        passage + "\n" + passage, " ".join(base), " ".join(near), " ".join(base).upper(), prose(20_000), "a b a b a b a b a b a b a b a b",
        "line one is here\nline one is here\n \n\n line one is here", "mail bob.x@mail.example.com, or +49 (30) 1234-5678 from 10.0.0.255 not 10.0.0.256",
        "card 4111 1111 1111 1111 and 4111-1111-1111-1112 and 12 34", "iban DE89 3704 0044 0532 0130 00 yes, token = \"0f3e4d6b2755a36d7d9c25bd72c4d5f67e061fda\"",
        "née Ünïcode     straße 中文 test 😀 a@b.c", "a..b@c.d.e 1.2.3.4.5.6.7.8 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "#$%&|<>* " * 30, "\x00 odd \x1c separator \x85 here",
    ]
    return texts


def hostile_rows():
    rows = [(i * 7 % 101 + 1, t) for i, t in enumerate(hostile_texts())]
    return [*rows, rows[9], rows[11], (None, "a row without an id " * 3)]


def shingles(text, n):
    w = WORD.findall(lower(text or ""))
    if not w:
        return set()
    k = min(n, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def near_components(rows, n, percent):
    """component by doc_id, all pairs."""
    sets = [(i, shingles(t, n)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (a, s) in enumerate(sets):
        for b, t in sets[:k]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i, _ in sets}


def substring(rows, window=35):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((doc_id, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def quality(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = [False] * len(w)
    for i in range(len(w) - 4):
        if seen[tuple(w[i : i + 5])] > 1:
            hit[i : i + 5] = [True] * 5
    n, rep = len(w), sum(hit)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), rep, n < 10 or 100 * rep > 20 * n)


def _luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def pii(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and _luhn(digits(m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    }
    return {k: [(k, *m.span()) for m in re.finditer(p, text) if ok(m.group())] for k, (p, ok) in kinds.items()}


BENCH_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def decontam(rows, items, window=10):
    patterns = {}
    for item, text in items:
        w = BENCH_WORD.findall(lower(text or ""))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            patterns.setdefault(tuple(w[i : i + window]), set()).add("" if item is None else str(item))
    sizes = {len(p) for p in patterns}
    out = []
    for doc_id, text in rows:
        w = BENCH_WORD.findall(lower(text or ""))
        hit, found = [False] * len(w), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (p := tuple(w[i : i + n])) in patterns:
                    hit[i : i + n] = [True] * n
                    found |= patterns[p]
        out.append((doc_id, len(w), sum(hit), len(found), sha(",".join(sorted(found))), any(hit)))
    return out


def lm(rows, alpha, mu):
    """Base and backoff scores from plain counts of whole words."""
    held = lambda i: zlib.crc32(("null" if i is None else str(i)).encode()) % 10 == 0
    docs = [(i, ["<s>", *WORD.findall(lower(t or "")), "</s>"]) for i, t in rows]
    count = Counter()
    for i, w in docs:
        if not held(i):
            for n in (1, 2, 3):
                count.update(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
    starts = count.pop(("<s>",), 0)
    n = sum(c for g, c in count.items() if len(g) == 1)
    v = sum(len(g) == 1 for g in count)
    p1 = lambda w: (count[(w,)] + alpha) / (n + alpha * (v + 1))
    seen = lambda h: starts if h == ("<s>",) else count[h]
    out = []
    for i, w in docs:
        base = score = 0.0
        for k in range(1, len(w)):
            p = p1(w[k])
            base += math.log10(p)
            for m, weight in ((1, mu[0]), (2, mu[1])):
                if k >= m:
                    h = tuple(w[k - m : k])
                    p = (count[(*h, w[k])] + weight * p) / (seen(h) + weight)
            score += math.log10(p)
        out.append((i, held(i), len(w) - 1, sum(count[(x,)] > 0 for x in w[1:]), n, base, score))
    return out


def token_ids(rows, path, end_id=1):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    return [(i, np.array([*t.encode(x or "", add_special_tokens=False).ids, end_id], np.uint32)) for i, x in rows]


def importance(rows, targets, percent=5, min_words=20, seed=42):
    def features(text):
        w = BENCH_WORD.findall(lower(text or ""))
        return len(w), [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    docs = [(i, *features(t)) for i, t in rows]
    s, t = Counter(bucket(f) for _, _, fs in docs for f in fs), Counter(bucket(f) for x in targets for f in features(x)[1])
    all_s, all_t = float(sum(s.values()) + 10_000), float(sum(t.values()) + 10_000)
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * all_s / ((s[b] + 1.0) * all_t))) for b in range(10_000)}
    scored = []
    for i, n, fs in docs:
        h = int(sha(f"{seed}:{'null' if i is None else i}")[:8], 16)
        weight = sum(gain[bucket(f)] for f in fs)
        scored.append((i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= min_words))
    order = sorted((r for r in scored if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = order[: percent * len(order) // 100]
    rest = order[len(drawn) :] + [r for r in scored if not r[4]]
    return [(*r[:4], k + 1) for k, r in enumerate(drawn)] + [(*r[:4], None) for r in rest]


def merkle(rows):
    """rows (doc_id, source, lang, n_chars, text): doc_id, leaf, subroot, root, proof, folded root, verified."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    trees = {}
    for row in rows:
        leaf = sha("".join(map(field, row)))
        changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None
        trees.setdefault(row[2], []).append((row[0], leaf, sha("".join(map(field, (*row[:4], lower(row[4]))))) if changed else leaf))

    def up(hashes):
        """Per node its siblings before and after on each level, and the last hash."""
        paths, at, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
        while len(level) > 1:
            for path, k in zip(paths, at):
                run = k // 8 * 8
                path.append(("".join(level[run:k]), "".join(level[k + 1 : run + 8])))
            level, at = [sha("".join(level[k : k + 8])) for k in range(0, len(level), 8)], [k // 8 for k in at]
        return paths, level[0]

    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    made = {}
    for name in names:
        trees[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        made[name] = up([leaf for _, leaf, _ in trees[name]])
    tops, root = up([made[name][1] for name in names]) if names else ([], None)
    out = []
    for name, top in zip(names, tops):
        for (doc_id, leaf, seen), path in zip(trees[name], made[name][0]):
            h = seen
            for before, after in path + top:
                h = sha(before + h + after)
            out.append((doc_id, leaf, made[name][1], root, sha("".join(a + b for a, b in path + top)), h, h == root))
    return out


def secret_base(text):
    text = text or ""
    word = "".join
    either = lambda w: word(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    names = "|".join([either("password"), either("passwd"), either("secret"), either("token"), either("api") + "_?" + either("key")])
    kinds = {
        "assign": (f"({names})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m.group(2)) >= 12),
        "access": (r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 18),
        "hex": (r"[0-9a-f]+", lambda m: len(m.group()) >= 16),
    }
    found = [(m.start(), k, kind, m.end()) for k, (kind, (p, ok)) in enumerate(kinds.items()) for m in re.finditer(p, text) if ok(m)]
    return [(kind, s, e) for s, _, kind, e in sorted(found)]


def secret_spans(text, classes, allowed, alphabets):
    """Base and random spans by counting every window anew; ``classes`` are (kind, alphabet, width, bits)."""
    text = text or ""

    def bits(w):
        return -sum(c / len(w) * math.log2(c / len(w)) for c in Counter(w).values())

    def fine(s):
        return any(re.fullmatch(p, s, re.DOTALL) for p in allowed) or any(s.lower() in a * 2 for a in alphabets)

    spans = secret_base(text)
    for kind, alphabet, width, least in classes:
        found = []
        for m in re.finditer(f"[{alphabet}]+", text):
            if len(m.group()) < width or fine(m.group()):
                continue
            hot = [i for i in range(m.start(), m.end() - width + 1) if bits(text[i : i + width]) >= least]
            joined = []
            for i in hot:
                if joined and i <= joined[-1][1]:
                    joined[-1][1] = i + width
                else:
                    joined.append([i, i + width])
            found += [(kind, s, e) for s, e in joined if not fine(text[s:e])]
        spans += [f for f in found if not any(s <= f[1] and f[2] <= e for _, s, e in spans)]
    rank = ["assign", "access", "hex", *(c[0] for c in classes)]
    return sorted(spans, key=lambda x: (x[1], rank.index(x[0]), x[2]))


class KneserNey:
    """Interpolated Kneser-Ney over padded words, straight from the definition with plain counts."""

    def __init__(self, texts, order=4, edge="\x02", unseen=1 / 65536):
        self.order, self.edge, self.unseen = order, edge, unseen
        top = Counter()
        for t in texts:
            for w in self.words(t):
                w = edge * (order - 1) + w + edge
                top.update(w[i : i + order] for i in range(len(w) - order + 1))
        self.levels = {order: top}
        for n in range(order - 1, 0, -1):
            self.levels[n] = Counter(g[1:] for g in self.levels[n + 1])
        self.discounts, self.totals, self.kinds = {}, {}, {}
        for n, level in self.levels.items():
            often = Counter(level.values())
            self.discounts[n] = often[1] / (often[1] + 2 * often[2]) if often[1] and often[2] else 0.5
            self.totals[n], self.kinds[n] = Counter(), Counter()
            for g, c in level.items():
                self.totals[n][g[:-1]] += c
                self.kinds[n][g[:-1]] += 1

    @staticmethod
    def words(text):
        return re.findall(r"[^\W\d_]+", text.lower()) if text else []

    def p(self, gram):
        n = len(gram)
        if not n:
            return self.unseen
        total = self.totals[n][gram[:-1]]
        lower = self.p(gram[1:])
        if not total:
            return lower
        c, d = self.levels[n][gram], self.discounts[n]
        return max(c - d, 0) / total + d * self.kinds[n][gram[:-1]] / total * lower

    def entropy(self, text):
        total, n = 0.0, 0
        for w in self.words(text):
            w = self.edge * (self.order - 1) + w + self.edge
            for i in range(len(w) - self.order + 1):
                total -= math.log(self.p(w[i : i + self.order]))
                n += 1
        return total / n
