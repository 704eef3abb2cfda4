"""Merkle manifest of a dataset: a hash tree per language under one root, with a proof per row.

Rows are leaves in ascending doc_id order per language. A level joins runs of
``FAN`` consecutive nodes into their hash; the language's last node is its
subroot, and the subroots, in order of the language, are joined the same way
into the root.

Levels are computed by windows of fixed offset: at level l the nodes sit on the
rows whose place is a multiple of FAN^l, the siblings of a node are lag and
lead columns at multiples of FAN^l, masked by its slot in the run and the run's
length, and the row of the first child hashes the run into the parent. A window
never holds a language: places are cut into blocks of FAN^LEVELS rows, aligned
so that no run crosses a block, and one shuffle by block serves LEVELS levels.
The blocks' top nodes, one row per block, climb the same way, until one node a
language is left. Texts are hashed where they are read and never shuffled.

Defined results: a null field is hashed as ``-``; null doc_ids come first, equal
ones are ordered by their leaf; repeated rows are leaves each; a null language
is a language of its own; an empty table gives no rows; columns beyond the five
fields are not part of a leaf.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uptake.llm.ordering import in_ranges, places
from uptake.llm.store import stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 8
#: Levels that one block holds; it has FAN^LEVELS rows at most.
LEVELS = 4
BLOCK = FAN**LEVELS
STEP = "struct<before:string,after:string>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts joined."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(text: Column | None = None) -> Column:
    """The hash of a row's fields; ``text`` in place of its own, if given."""
    return digest(*(field(text if text is not None and c == "text" else F.col(c)) for c in FIELDS))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda h, s: digest(s["before"], h, s["after"]))


def proof(path: Column) -> Column:
    """The hash of all siblings, level by level from the leaf to the root, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def _levels(nodes: DataFrame) -> DataFrame:
    """Add ``top``, the hash of the block on its first row, and ``path``, the siblings within the block on every row."""
    inside = Window.partitionBy("tree", "block").orderBy("pos")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out, steps = nodes.withColumn("top", F.col("h")), []
    for level in range(LEVELS):
        step = FAN**level
        h, place = F.col("top"), F.floor(F.col("pos") / step).cast("long")
        slot = place % FAN
        length = F.least(F.lit(FAN), F.ceil(F.col("n") / step) - (place - slot))
        node = (F.col("pos") % step == 0) & (F.col("n") > step)  # more than one node on this level
        lags = [F.when(slot >= k, F.lag(h, k * step).over(inside)).otherwise("") for k in range(FAN - 1, 0, -1)]
        leads = [F.when(slot + k < length, F.lead(h, k * step).over(inside)).otherwise("") for k in range(1, FAN)]
        out = out.withColumns({f"before_{level}": F.when(node, F.concat(*lags)), f"after_{level}": F.when(node, F.concat(*leads))})
        parent = digest(h, F.col(f"after_{level}"))
        out = out.withColumn("top", F.when(F.col("pos") % (step * FAN) == 0, F.when(node, parent).otherwise(h)))
        here = F.when(node, F.struct(F.col(f"before_{level}").alias("before"), F.col(f"after_{level}").alias("after")))
        steps.append(F.when(F.col("n") > step, F.last(here, ignorenulls=True).over(so_far) if level else here))
    path = F.array_compact(F.array(*steps)).cast(f"array<{STEP}>")
    return out.withColumn("path", path)


def climb(nodes: DataFrame, finish) -> DataFrame:
    """Add ``path``, ``subroot`` and ``root`` to nodes ``(tree, pos, n, h, ...)``; other columns are carried, ``n`` and ``h`` go.

    ``finish`` adds the three to trees of one node. The driver sees the size of the largest tree.
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    if most <= 1:
        return finish(nodes)
    carried = [c for c in nodes.columns if c not in ("pos", "n", "h")]
    blocks = _levels(nodes.withColumn("block", F.floor(F.col("pos") / BLOCK).cast("long")))
    tops = blocks.filter(F.col("pos") % BLOCK == 0)
    tops = stored(tops.select("tree", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).cast("long").alias("n"), F.col("top").alias("h")), "nodes")
    above = climb(tops, finish).select(F.col("tree").alias("above_tree"), F.col("pos").alias("above_block"), F.col("path").alias("above_path"), "subroot", "root")
    joined = blocks.join(above, (F.col("tree") == F.col("above_tree")) & (F.col("block") == F.col("above_block")))
    return joined.select(*carried, "pos", F.concat("path", "above_path").alias("path"), "subroot", "root")


def _alone(nodes: DataFrame) -> DataFrame:
    """Trees of one node that stand by themselves."""
    return nodes.withColumns({"path": F.array().cast(f"array<{STEP}>"), "subroot": F.col("h"), "root": F.col("h")})


def _joined(nodes: DataFrame) -> DataFrame:
    """Trees of one node each, which climb to one root in the order of their names."""
    named = nodes.select(F.col("tree").alias("name"), F.lit("").alias("tree"), "h")
    placed = stored(places(in_ranges(named, [F.col("tree"), F.col("name")], "trees"), "tree", "tree_runs"), "subroots")
    top = climb(placed, _alone).select(F.col("name").alias("top_name"), "path", "root")
    return nodes.withColumn("subroot", F.col("h")).join(top, F.col("tree") == F.col("top_name"))


def manifest(docs: DataFrame, carry: Mapping[str, Column] | None = None) -> DataFrame:
    """``doc_id, lang, pos, leaf, path, subroot, root`` per row, and the columns ``carry`` computes from the row."""
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    extra = dict(carry or {})
    leaves = docs.select(tree.alias("tree"), F.col("doc_id"), F.col("lang"), leaf().alias("leaf"), *(c.alias(k) for k, c in extra.items()))
    # written before they are sorted: the sort samples its ranges, and texts are hashed once
    rows = in_ranges(stored(leaves, "hashed"), [F.col("tree"), F.col("doc_id").asc_nulls_first(), F.col("leaf")], "leaves")
    nodes = places(rows, "tree", "leaf_runs").withColumn("h", F.col("leaf"))
    return climb(nodes, _joined).select("doc_id", "lang", "pos", "leaf", "path", "subroot", "root", *extra)


def tampered_leaf(changed: Column, text: Column) -> Column:
    """The leaf with ``text`` for its own where ``changed`` holds, else null."""
    return F.when(changed, leaf(text))


def verify(rows: DataFrame, seen: str) -> DataFrame:
    """The output of :func:`manifest` with the root that the leaf ``seen`` (its own where null) folds to, and whether it is the root."""
    folded = fold(F.coalesce(F.col(seen), F.col("leaf")), F.col("path"))
    return rows.withColumn("folded_root", folded).withColumn("verified", F.col("folded_root") == F.col("root"))
