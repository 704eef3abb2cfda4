"""Places of rows in a global order, without a task that sees more than its range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uptake.llm.store import shuffle_partitions, stored

#: ``monotonically_increasing_id`` counts rows below this bit and partitions from it on.
_PART_BIT = 33


def in_ranges(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Store ``df`` sorted over range partitions, with its partition ``part`` and place ``row`` there.

    The bounds of the ranges are sampled, so they are fixed by the written table.
    """
    made = df.repartitionByRange(shuffle_partitions(df.sparkSession), *order).sortWithinPartitions(*order)
    rows = stored(made.withColumn("mid", F.monotonically_increasing_id()), name)
    here = F.col("mid")
    return rows.select(*df.columns, F.shiftright(here, _PART_BIT).alias("part"), here.bitwiseAND(F.lit((1 << _PART_BIT) - 1)).alias("row"))


def places(rows: DataFrame, group: str, name: str) -> DataFrame:
    """Add ``pos``, the place within ``group`` from 0, and ``n``, the rows of the group, to the output of :func:`in_ranges`.

    The order must begin with ``group``. A group is counted per partition: the
    table joined on (partition, group) has a row for each partition and one
    for each group more, and a group of any size is spread over its partitions.
    """
    runs = rows.groupBy("part", group).agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("here"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = stored(
        runs.select(
            F.col("part").alias("run_part"), F.col(group).alias("run_group"), "first",
            F.coalesce(F.sum("here").over(before), F.lit(0)).alias("base"), F.sum("here").over(Window.partitionBy(group)).alias("n"),
        ),
        name,
    )
    kept = [c for c in rows.columns if c not in ("part", "row")]
    joined = rows.join(runs, (F.col("part") == F.col("run_part")) & (F.col(group) == F.col("run_group")))
    return joined.select(*kept, (F.col("base") + F.col("row") - F.col("first")).alias("pos"), "n")
