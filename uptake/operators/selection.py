"""Order statistics of groups of any size.

``median`` keeps all values of a group in one buffer. Here equal values of a
group are counted first (combined map side), the distinct ones are sorted over
range partitions, and the ranks follow from the counts per (partition, group).
Only the partitions that hold a wanted rank are numbered, and at most two rows
per group are picked, so a group that holds a third of all rows is spread over
the partitions like any other rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uptake.session import cut_lineage


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (left[c].eqNullSafe(right[f"{c}_r"]) for c in columns))


def sorted_counts(df: DataFrame, keys: Sequence[str], columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """(item, k0.., value, n, part): each group's distinct values with their counts, sorted over range partitions.

    Written to the checkpoint folder: the ranges come from sampling, so a lost
    executor must not draw them anew.
    """
    spark = df.sparkSession
    items = F.explode(F.array(*[F.struct(F.lit(i).alias("item"), F.col(c).cast("double").alias("value")) for i, c in enumerate(columns)]))
    long = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], items.alias("s")).select("s.item", *[f"k{i}" for i in range(len(keys))], "s.value")
    group = ["item", *[f"k{i}" for i in range(len(keys))]]
    counted = long.groupBy(*group, "value").agg(F.count(F.lit(1)).alias("n"))
    order = [*group, "value"]
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = counted.repartitionByRange(n_parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    return cut_lineage(ranged)


def group_quantile(df: DataFrame, key: str | Sequence[str], columns: Sequence[str], q: float = 0.5, partitions: int | None = None) -> DataFrame:
    """Exact interpolated quantile ``q`` of each column per group, NULLs skipped; a group without values has NULL.

    Equals ``group_median`` at q = 0.5; a NULL key is a group of its own.
    """
    keys = [key] if isinstance(key, str) else list(key)
    k = [f"k{i}" for i in range(len(keys))]
    group = ["item", *k]
    rows = sorted_counts(df, keys, columns, partitions)
    valid = F.when(F.col("value").isNotNull(), F.col("n")).otherwise(F.lit(0))
    # one row per (partition, group): their number is that of the groups and partitions
    per_part = rows.groupBy("part", *group).agg(F.sum(valid).alias("here"))
    whole = Window.partitionBy(*group)
    so_far = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = per_part.select("part", *group, "here", (F.sum("here").over(so_far) - F.col("here")).alias("before"), F.sum("here").over(whole).alias("total"))
    place = (F.col("total") - 1) * F.lit(float(q))
    sums = cut_lineage(sums.withColumns({"low": F.floor(place), "high": F.ceil(place), "rest": place - F.floor(place)}))
    holds = (F.col("total") > 0) & (F.col("before") <= F.col("high")) & (F.col("before") + F.col("here") > F.col("low"))
    wanted = sums.where(holds).select(*[F.col(c).alias(f"{c}_r") for c in ("part", *group)], "before", "low", "high", "rest")
    near = rows.where(F.col("value").isNotNull()).join(wanted, _same(rows, wanted, ["part", *group]))
    inside = Window.partitionBy("part", *group).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = near.withColumn("end", F.col("before") + F.sum("n").over(inside))
    at = lambda p: F.max(F.when((F.col("end") > F.col(p)) & (F.col("end") - F.col("n") <= F.col(p)), F.col("value")))
    picked = near.groupBy(*group).agg(at("low").alias("a"), at("high").alias("b"), F.max("rest").alias("rest"))
    value = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.col("a") * (1 - F.col("rest")) + F.col("b") * F.col("rest"))
    found = picked.select(*group, value.alias("v"))
    # groups without any value come from the counts
    both = found.unionByName(sums.where("total = 0").select(*group, F.lit(None).cast("double").alias("v")))
    wide = both.groupBy(*k).agg(*[F.max(F.when(F.col("item") == i, F.col("v"))).alias(c) for i, c in enumerate(columns)])
    return wide.select(*[F.col(x).alias(name) for x, name in zip(k, keys)], *columns)
