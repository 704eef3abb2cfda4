"""Filters, projections, joins, set operations and sorts (P*, J1-J8, J10-J11, O*, U*).

Join strategy is left to Catalyst + AQE: a side whose runtime size is under
the adaptive broadcast threshold is broadcast, anything larger stays a
shuffle join, and skewed partitions are split. Explicit ``broadcast`` hints
are used only where the side is bounded by construction (one-row aggregates,
fixed code lists).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ---------------------------------------------------------------- filters


def filter_equal(df: DataFrame, column: str, value) -> DataFrame:
    """Equality filter; pushed to the parquet scan when ``column`` is a source column."""
    return df.where(F.col(column) == F.lit(value))


def exclude_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Drop rows whose value is listed; NULL values are kept (pandas ``~isin``)."""
    values = list(values)
    if not values:
        return df
    return df.where(~F.coalesce(F.col(column).isin(values), F.lit(False)))


def keep_latest(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` equals its maximum.

    The maximum is a one-row aggregate (partial max per partition, one tiny
    shuffle), joined back as an equi-join on the column itself with a
    broadcast hint that is safe because the side has exactly one row.
    """
    latest = df.agg(F.max(column).alias(column))
    return df.join(F.broadcast(latest), on=[column], how="inner")


def null_sentinels(df: DataFrame, column: str, sentinels: Sequence[str]) -> DataFrame:
    """P4 first half: listed sentinel strings become NULL."""
    return df.withColumn(
        column,
        F.when(F.col(column).isin(list(sentinels)), F.lit(None).cast("string")).otherwise(F.col(column)),
    )


def drop_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """P4 second half / P10: drop rows with a NULL (or NaN) in ``subset`` (all columns if None)."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def class_by_membership(value, members=(1, 2), inside="Urban", outside="Rural") -> Column:
    """P5: ``CASE WHEN class IN ('1','2') THEN 'Urban' ELSE 'Rural'`` with numeric affinity.

    The class is compared as a number, so ``2``, ``'2'`` and ``2.0`` are all
    members; NULL or non-numeric classes fall to ``outside``.
    """
    v = (F.col(value) if isinstance(value, str) else value).cast("string").try_cast("double")
    return F.when(v.isin([float(m) for m in members]), F.lit(inside)).otherwise(F.lit(outside))


# ---------------------------------------------------------------- joins


def group_max_rows(df: DataFrame, key: str, value: str) -> DataFrame:
    """Every row holding its group's maximum ``value``; ties kept, NULL maxima dropped.

    Written as aggregate + equi-join on (key, value) rather than a rank
    window: the max is pre-aggregated map side, so a key holding a third of
    all rows collapses to one row before the shuffle, and the per-key maxima
    table is small enough for AQE to broadcast. A window would sort the whole
    hot group inside one task.
    """
    maxima = df.groupBy(F.col(key).alias("__key")).agg(F.max(value).alias("__max"))
    joined = df.join(
        maxima,
        (F.col(key) == F.col("__key")) & (F.col(value) == F.col("__max")),
        "inner",
    )
    return joined.drop("__key", "__max")


def rows_of_flagged_keys(df: DataFrame, flags: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of ``df`` whose keys occur in ``flags``; NULL keys match NULL keys."""
    flags = flags.select(*keys).distinct()
    cond = None
    for k in keys:
        c = df[k].eqNullSafe(flags[k])
        cond = c if cond is None else cond & c
    return df.join(flags, cond, "left_semi")


def rows_of_keys_with(df: DataFrame, flag: Column, keys: Sequence[str]) -> DataFrame:
    """J7 where the flags are rows of ``df`` itself: all rows of every key group with a row that meets ``flag``.

    One pass, NULL keys form groups like any other. For groups of a bounded
    size (a region and year holds a row per type), since a group is one
    window partition; :func:`rows_of_flagged_keys` has no such bound.
    """
    any_flag = F.max(F.coalesce(flag, F.lit(False))).over(Window.partitionBy(*keys))
    return df.withColumn("__flag", any_flag).where("__flag").drop("__flag")


def unmatched_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``left`` that do not occur in ``right``."""
    return left.select(key).distinct().join(right.select(key), on=[key], how="left_anti")


def lookup(df: DataFrame, table: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Attach key -> value columns (left join)."""
    return df.join(table, on=key if isinstance(key, list) else [key], how="left")


# ---------------------------------------------------------------- set ops / sorts


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union all by name; columns missing on one side become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def label_and_union(frames: dict[str, DataFrame], label_column: str = "Type") -> DataFrame:
    """Add a literal label per frame, then U1."""
    return union_all([f.withColumn(label_column, F.lit(label)) for label, f in frames.items()])


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """O2: first ``n`` rows under a total order (``order`` should be a full key)."""
    return df.orderBy(*order).limit(n)
