"""Window operators W1-W4.

Windows are always partitioned by a region key, so each window group holds
one region's years (bounded by the number of periods, not by data volume).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def fill_forward_back(
    df: DataFrame, key: str, order: str, columns: Sequence[str], leak: bool = False
) -> DataFrame:
    """W1 + W2: per ``key``, forward fill by ``order`` then backward fill.

    Default (grouped): a value never leaves its region; a region with no
    value at all in a column keeps NULL.

    ``leak=True`` reproduces ``groupby(key).ffill().bfill()`` where the
    second call is not grouped: a region whose column is entirely NULL takes
    the first value of the next region (in key order) that has one. That
    carry is computed on a one-row-per-region summary, never on the panel.
    """
    # Both directions are running frames (unbounded preceding .. current row);
    # the backward fill reads the order descending. Spark evaluates running
    # frames in one pass, while "following" frames are re-evaluated per row.
    ahead = Window.partitionBy(key).orderBy(F.col(order).asc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    behind = Window.partitionBy(key).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = df.select(
        *[
            F.coalesce(
                F.last(F.col(c), ignorenulls=True).over(ahead),
                F.last(F.col(c), ignorenulls=True).over(behind),
            ).alias(c)
            if c in columns
            else F.col(c)
            for c in df.columns
        ]
    )
    if not leak:
        return filled
    # Per region: first non-null value of each column (by order). Regions
    # without any value take the first value of the next region that has one.
    firsts = df.groupBy(key).agg(
        *[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns]
    )
    carried = next_non_null(firsts, key, columns, prefix="__carry_")
    joined = filled.join(carried, on=[key], how="left")
    return joined.select(
        *[
            F.coalesce(F.col(c), F.col(f"__carry_{c}")).alias(c) if c in columns else F.col(c)
            for c in filled.columns
        ]
    )


def next_non_null(df: DataFrame, key: str, columns: Sequence[str], prefix: str = "next_") -> DataFrame:
    """For every row, the first non-null value of each column among the rows with a larger key.

    A distributed suffix scan: rows are range-partitioned by key and
    checkpointed (stable partition ids), each partition is scanned with a
    running window, and values crossing a partition boundary come from a
    per-partition summary (one row per partition). No task sees more than
    its range partition.
    """
    from uptake.session import cut_lineage

    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(
        df.select(key, *columns).repartitionByRange(parts, F.col(key)).withColumn("__p", F.spark_partition_id())
    )
    later_in_part = Window.partitionBy("__p").orderBy(F.col(key).desc()).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select(
        key, "__p", *[F.last(F.col(c), ignorenulls=True).over(later_in_part).alias(f"__l_{c}") for c in columns]
    )
    # first non-null value of each column in each partition (by key)
    heads = ranged.groupBy("__p").agg(
        *[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(key))).alias(f"__h_{c}") for c in columns]
    )
    later_parts = Window.orderBy(F.col("__p").desc()).rowsBetween(Window.unboundedPreceding, -1)
    boundary = heads.select(
        "__p", *[F.last(F.col(f"__h_{c}"), ignorenulls=True).over(later_parts).alias(f"__b_{c}") for c in columns]
    )
    joined = local.join(F.broadcast(boundary), on=["__p"], how="left")
    return joined.select(
        key, *[F.coalesce(F.col(f"__l_{c}"), F.col(f"__b_{c}")).alias(f"{prefix}{c}") for c in columns]
    )


def average_rank(df: DataFrame, value: str, name: str, partition: Sequence[str] = ()) -> DataFrame:
    """Pandas ``rank(method='average')`` ascending, cut to an integer.

    average rank = rank + (ties - 1) / 2; NULL values get NULL. Used on one
    row per cluster, so the window holds k rows.
    """
    part = list(partition)
    w = Window.partitionBy(*part).orderBy(F.col(value).asc_nulls_last())
    ties = Window.partitionBy(*(part + [value]))
    r = F.rank().over(w) + (F.count(F.lit(1)).over(ties) - 1) / 2.0
    return df.withColumn(name, F.when(F.col(value).isNull(), F.lit(None)).otherwise(F.floor(r)).cast("int"))


def broadcast_group_value(df: DataFrame, key: str, agg_expr, name: str) -> DataFrame:
    """Attach a per-group aggregate to every row of the group (``map`` of a per-key dict)."""
    return df.withColumn(name, agg_expr.over(Window.partitionBy(key)))
