"""Personal data: patterns propose spans, checks confirm them, context adjusts a score.

Built from DataFrame functions alone. A pattern cuts a text into the pieces
between its matches, whose lengths give the offsets; a match counts when its
check holds (number ranges, Luhn, mod 97) and its score, a prior of its kind
plus a bonus when a context word stands shortly before it, reaches the
threshold. Kinds that a check cannot confirm need the context word.

Patterns use possessive loops: they match what the plain ones match, in one
pass and without recursion, however long a run of fitting characters is.

Defined results: a null text is an empty one and has no spans; texts are
searched whole; repeated rows are searched each; an empty table gives no rows;
other columns are ignored by :func:`find` and kept by :func:`mask`. Offsets
count code points from 0, the end is exclusive. Spans of one kind never
overlap; spans of two kinds may.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"
THRESHOLD = 0.5
BONUS = 0.3
#: Characters before a match in which a context word counts.
REACH = 40


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


#: Elements that a running value is carried over in one array, and characters of a piece that a text is cut from.
_RUN, _PIECE = 128, 1024


def _running(values: Column, op) -> Column:
    """The fold by ``op`` (associative, from 0) of all elements before each one.

    An accumulator that grows by an element copies what it holds; so runs of
    ``_RUN`` elements are folded apart, each from the fold of the runs before.
    """
    zero = F.lit(0).cast("long")

    def scan(some: Column, start: Column) -> Column:
        empty = F.array().cast("array<bigint>")
        step = lambda acc, x: F.struct(op(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(some, F.struct(start.alias("at"), empty.alias("out")), step, lambda acc: acc["out"])

    def of(all_: Column) -> Column:
        n = F.ceil(F.size(all_) / _RUN).cast("int")
        runs = F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.slice(all_, k * _RUN + 1, F.lit(_RUN)))
        folded = lambda rs: scan(F.transform(rs, lambda r: F.aggregate(r, zero, op)), zero)
        return F.when(F.size(all_) <= _RUN, scan(all_, zero)).otherwise(_let(runs, lambda rs: F.flatten(F.zip_with(rs, folded(rs), scan))))

    return _let(values, of)


def _cut(pieces: Column, start: Column, end: Column) -> Column:
    """Characters ``start`` to ``end`` of a text that is cut into ``pieces`` of ``_PIECE`` characters."""
    first, last = F.floor(start / _PIECE).cast("int"), F.floor(end / _PIECE).cast("int")
    left, right = (start % _PIECE).cast("int"), (end % _PIECE).cast("int")
    of = lambda k: F.coalesce(F.get(pieces, k), F.lit(""))
    within = F.substr(of(first), left + 1, right - left)
    across = F.concat(F.substr(of(first), left + 1), F.array_join(F.slice(pieces, first + 2, last - first - 1), ""), F.substr(of(last), F.lit(1), right))
    return F.when(start >= end, F.lit("")).when(first == last, within).otherwise(across)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The weighted digit sum is a multiple of 10; every second digit from the right counts double, 9 off above 9."""
    n = F.length(digits)

    def weight(i: Column) -> Column:
        d = F.substr(digits, n - i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), weight), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def mod97(account: Column) -> Column:
    """The account number, its first four characters moved to the end and letters counted from 10, leaves 1."""
    plain = F.replace(account, F.lit(" "), F.lit(""))
    moved = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def step(acc: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97)

    return F.aggregate(F.split(moved, "(?!^)(?!$)"), F.lit(0), step) == 1


def _bytes_fit(match: Column) -> Column:
    def part(p: Column) -> Column:
        short = F.ltrim(p, F.lit("0"))
        return F.when(F.length(short) > 3, False).when(short == "", True).otherwise(short.cast("int") <= 255)

    return F.forall(F.split(match, r"\."), part)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    hint: str  # what a text must match for the pattern to be worth a try
    check: Callable[[Column], Column] | None
    prior: float
    context: str


#: Characters of an account number by its country code: the registry and the countries that use the format without being listed.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """A number of the length of its country; else one of any length, which takes up no number of a known length."""

    def of(n: int, codes: str) -> str:
        groups, rest = divmod(n - 4, 4)
        last = rf"\x20[A-Z0-9]{{{rest}}}" if rest else ""
        return rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:[A-Z0-9]{{{n - 4}}}|(?:\x20[A-Z0-9]{{4}}){{{groups}}}{last})"

    known = rf"(?:{'|'.join(of(n, codes) for n, codes in IBAN_LENGTHS.items())})(?![A-Za-z0-9])"
    group = rf"\x20(?!(?=[A-Z]{{2}}[0-9]{{2}}){known})[A-Z0-9]"
    other = rf"[A-Z]{{2}}[0-9]{{2}}(?:[A-Z0-9]{{11,30}}|(?:{group}{{4}}){{2,7}}(?:{group}{{1,3}})?)(?![A-Za-z0-9])"
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{known}|{other})"


#: The first four are the base; the patterns of the base are fixed values.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", None, 0.9, r"mail|contact|write"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]", _bytes_fit, 0.6, r"\bip\b|address|host|server"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9]", lambda m: _let(_digits(m), lambda d: F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False)), 0.7, r"card|visa|master|credit|pay"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", lambda m: F.length(_digits(m)).between(8, 15), 0.6, r"phone|tel|call|mobile|fax"),
    Kind("iban", _iban(), r"[A-Z]{2}[0-9]{2}", mod97, 0.7, r"iban|account|bank|konto"),
    Kind("secret", r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{32,}+", r"[A-Za-z0-9_+/-]{32}", None, 0.25, r"token|secret|passw|api.?key|credential"),
)
BASE = KINDS[:4]


def _spans(text: Column, kind: Kind) -> Column:
    """Confirmed spans of one kind, leftmost first."""

    def place(v: Column) -> Column:
        matches, pieces = v["matches"], v["pieces"]
        steps = F.transform(matches, lambda m, i: (F.length(F.get(pieces, i)) + F.length(m)).cast("long"))
        # a match begins after all matches and pieces before it and the piece of its own place
        starts = F.transform(_running(steps, lambda a, x: a + x), lambda at, i: at + F.length(F.get(pieces, i)))

        def judged(starts: Column) -> Column:
            def one(m: Column, i: Column) -> Column:
                ok = kind.check(m) if kind.check else F.lit(True)
                near = F.lower(F.right(F.get(pieces, i), F.lit(REACH))).rlike(kind.context)
                score = F.lit(kind.prior) + F.when(near, F.lit(BONUS)).otherwise(F.lit(0.0))
                begin = F.get(starts, i).cast("long")
                return F.when(ok, F.struct(F.lit(kind.name).alias("kind"), begin.alias("start"), (begin + F.length(m)).cast("long").alias("end"), score.alias("score")))

            return F.filter(F.transform(matches, one), lambda s: s.isNotNull() & (s["score"] >= THRESHOLD))

        return _let(starts, judged)

    parts = F.struct(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("matches"), F.split(text, kind.pattern, -1).alias("pieces"))
    found = F.when(text.rlike(kind.hint) & text.rlike(kind.pattern), _let(parts, place))
    return F.coalesce(found.cast(SPAN), F.array().cast(SPAN))


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one array column of spans per kind, named ``pii_<kind>``."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.withColumns({f"pii_{k.name}": _spans(t, k) for k in KINDS})


def _listed(kinds) -> Column:
    spans = F.flatten(F.array(*(F.col(f"pii_{k.name}") for k in kinds)))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """Counts and spans per document."""
    found = find(docs.select("doc_id", "text"))
    counts = [F.size(f"pii_{k.name}").cast("long").alias(f"n_{k.name}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed(BASE), 256).alias("base_sha256"), _listed(KINDS).alias("spans"))


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; overlapping spans become one.

    ``n_chars``, where there is one, follows. A null text stays null.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    found = find(docs.select(F.struct(*columns).alias("doc"), F.col("text").cast("string").alias("searched")), "searched")
    text = F.col("searched")
    spans = F.sort_array(F.transform(F.flatten(F.array(*(F.col(f"pii_{k.name}") for k in KINDS))), lambda s: F.struct(s["start"], s["end"], s["kind"])))

    def cut(v: Column) -> Column:
        """The text between the ends so far and each span that begins after them, then the span's kind; the rest at last."""
        ends = F.transform(v["spans"], lambda s: s["end"])

        def joined(before: Column) -> Column:
            def one(s: Column, at: Column) -> Column:
                return F.when(s["start"] >= at, F.concat(_cut(v["pieces"], at, s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(F.lit(""))

            rest = _cut(v["pieces"], F.array_max(ends), v["n"])
            return F.concat(F.array_join(F.zip_with(v["spans"], before, one), ""), rest)

        return _let(_running(ends, lambda a, x: F.greatest(a, x)), joined)

    parts = F.struct(spans.alias("spans"), F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{_PIECE}}}"), F.lit(0)).alias("pieces"), F.length(text).cast("long").alias("n"))
    any_span = sum((F.size(f"pii_{k.name}") for k in KINDS), F.lit(0)) > 0
    masked = found.select("doc", F.when(any_span, _let(parts, cut)).otherwise(text).alias("masked"))
    new = {"text": F.col("masked"), "n_chars": F.when(F.col("masked").isNull(), F.col("doc.n_chars")).otherwise(F.length("masked").cast("long")) if "n_chars" in docs.columns else None}
    return masked.select(*(new[c].alias(c) if new.get(c) is not None else F.col(f"doc.`{c}`").alias(c) for c in docs.columns))
