"""Quality rules: a threshold table compiled into one projection.

Every measure is a built-in expression over the text, and every rule of the
table a comparison of two measures, so documents are judged where they are
read: no shuffle and no user functions.

Defined results: a null or empty text has no words and fails; repeated rows
are judged each; texts are judged whole; an empty table gives no rows; other
columns are ignored by the measures and kept by :func:`keep`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of the four languages that carry no topic (fixed values).
STOP_WORDS = (
    "the of and to in a is that it for on with as was by be at are this from or an "
    "le la les de des du et en un une que pour dans par sur est au "
    "der die das und ist von mit den dem ein eine auf nicht zu sich als für im "
    "el los las y que una por con del se para no lo su"
).split()


@dataclass(frozen=True)
class Rule:
    """Reject when ``measure`` exceeds ``above`` or falls under ``below`` times ``per``, in texts of ``from_words`` words and ``from_lines`` lines.

    With ``unless_foreign`` only texts that may be in a language of the list are rejected.
    """

    name: str
    measure: str
    per: str | None
    above: float | None = None
    below: float | None = None
    from_words: int = 0
    from_lines: int = 0
    unless_foreign: bool = False


#: The threshold table. Ratios are written as products, so that no rule divides.
RULES = (
    Rule("too_short", "n_words", None, below=10),
    Rule("repeated_words", "n_repeat_words", "n_words", above=0.20),
    Rule("word_length_low", "word_chars", "n_words", below=2.5, from_words=10),
    Rule("word_length_high", "word_chars", "n_words", above=12.0, from_words=10),
    Rule("symbols", "n_symbols", "n_words", above=0.10),
    Rule("stop_words", "n_stop_words", "n_words", below=0.02, from_words=50, unless_foreign=True),
    Rule("shouting", "n_upper", "word_chars", above=0.40, from_words=10),
    Rule("duplicate_lines", "dup_line_chars", "line_chars", above=0.30, from_lines=10),
)

#: Languages of ``STOP_WORDS``, and the characters that are no letters beyond theirs.
LANGUAGES = ("en", "fr", "de", "es")
_NO_FOREIGN = r"[\P{L}A-Za-zÀ-ÂÄÆ-ÏÑÓÔÖÙ-Üß-âäæ-ïñóôöù-üÿŒœŸªº]+"
#: Share of such letters from which a text is in another language; a foreign name in a long text stays below it.
FOREIGN = 0.01

_SPACE = r"[\x20\x09-\x0D]+"


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it many times."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(words: Column, n_words: Column, n: int = 5) -> Column:
    """Words inside an ``n``-word window whose words occur twice or more in the text.

    Windows are compared by a 64-bit hash of their words. Only a text that has
    repeats at all sorts its windows; the sorted positions of repeated windows
    then add up the words each covers beyond the one before.
    """
    hashes = F.transform(F.sequence(F.lit(1), n_words - (n - 1)), lambda i: F.xxhash64(F.slice(words, i, n)))

    def counted(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            near = lambda i: F.get(s, i)["h"]
            hit = F.filter(s, lambda x, i: F.coalesce(near(i - 1) == x["h"], F.lit(False)) | F.coalesce(near(i + 1) == x["h"], F.lit(False)))
            return F.sort_array(F.transform(hit, lambda x: x["i"]))

        cover = F.aggregate(
            _let(pairs, places),
            F.struct(F.lit(0).alias("sum"), F.lit(-n).alias("last")),
            lambda acc, p: F.struct((acc["sum"] + F.least(F.lit(n), p - acc["last"])).alias("sum"), p.alias("last")),
            lambda acc: acc["sum"],
        )
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(cover)

    return F.when(n_words >= n + 1, _let(hashes, counted)).otherwise(F.lit(0)).cast("long")


def measures(text: Column) -> Column:
    """All measures of a text, as one struct."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    words = F.filter(F.split(t, _SPACE), lambda w: w != "")
    dense = F.regexp_replace(t, _SPACE, "")
    lines = F.filter(F.split(t, "\n"), lambda x: F.regexp_replace(x, _SPACE, "") != "")

    def of(w: Column) -> Column:
        n = F.size(w)
        return _let(
            F.struct(n.alias("n"), dense.alias("dense"), lines.alias("lines")),
            lambda v: F.struct(
                v["n"].cast("long").alias("n_words"),
                F.length(v["dense"]).cast("long").alias("word_chars"),
                F.length(F.regexp_replace(v["dense"], r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
                F.size(v["lines"]).cast("long").alias("n_lines"),
                (F.size(v["lines"]) - F.size(F.array_distinct(v["lines"]))).cast("long").alias("n_dup_lines"),
                F.length(F.array_join(v["lines"], "")).cast("long").alias("line_chars"),
                (F.length(F.array_join(v["lines"], "")) - F.length(F.array_join(F.array_distinct(v["lines"]), ""))).cast("long").alias("dup_line_chars"),
                repeat_words(w, v["n"]).alias("n_repeat_words"),
                F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
                F.length(F.regexp_replace(v["dense"], r"\P{Lu}+", "")).cast("long").alias("n_upper"),
                F.length(F.regexp_replace(v["dense"], _NO_FOREIGN, "")).cast("long").alias("n_foreign"),
            ),
        )

    return _let(words, of)


def verdict(m: Column, rules=RULES, lang: Column | None = None) -> Column:
    """Names of the rules that reject a text of measures ``m``, in the language ``lang`` if that is known."""

    def broken(r: Rule) -> Column:
        base = m[r.per] if r.per else F.lit(1)
        test = m[r.measure] > base * r.above if r.above is not None else m[r.measure] < base * r.below
        if r.unless_foreign:
            test = test & (m["n_foreign"] <= m["word_chars"] * FOREIGN)
            if lang is not None:
                test = test & F.coalesce(F.lower(lang).isin(*LANGUAGES), F.lit(True))
        return F.when(test & (m["n_words"] >= r.from_words) & (m["n_lines"] >= r.from_lines), F.lit(r.name))

    return F.array_compact(F.array(*(broken(r) for r in rules)))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def _lang(docs: DataFrame) -> Column | None:
    return F.col("lang").cast("string") if "lang" in docs.columns else None


def score(docs: DataFrame) -> DataFrame:
    """Measures, ``base_failed``, rejecting rules and ``kept`` per document; ``lang``, where there is one, names the language."""
    m = F.col("quality")
    lang = _lang(docs)
    return (
        docs.select("doc_id", measures(F.col("text")).alias("quality"), (F.lit(None).cast("string") if lang is None else lang).alias("written_in"))
        .select("doc_id", "quality.*", base_failed(m).alias("base_failed"), verdict(m, RULES, F.col("written_in")).alias("rejected_by"))
        .withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
    )


def keep(docs: DataFrame) -> DataFrame:
    """The documents that :func:`score` keeps, with their columns.

    The measures are bound inside the condition: a filter over a measured
    column would be pushed to the scan with a copy of all measures per rule.
    """
    lang = _lang(docs)
    return docs.filter(_let(measures(F.col("text")), lambda m: ~base_failed(m) & (F.size(verdict(m, RULES, lang)) == 0)))
