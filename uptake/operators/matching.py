"""One-dimensional nearest-neighbour match inside a caliper, without a cross join.

For each treated row find the control with the nearest score (with
replacement: a control may serve many targets); keep the pair when the
distance is strictly below the caliper. Ties: the smaller distance wins, then
the lower control key.

Plan (O(n log n), no pair enumeration, no hot task):

1. Controls are reduced to one row per distinct score (lowest key): equal
   scores are interchangeable except for the key tie-break. Targets with the
   same score share their answer, so they are reduced the same way and the
   answer is joined back on the score. After this step no value can be hot.
2. Scores are cut into quantile buckets: ``percentile_approx`` over the
   distinct scores gives at most ``buckets`` bounds (one bounded row to the
   driver) and Spark ML's ``Bucketizer`` assigns each score by binary
   search. Buckets are balanced by rank, so no bucket holds a large share
   of the rows whatever the score distribution.
3. Each bucket receives two sentinels: the highest control of all earlier
   buckets and the lowest control of all later ones, carried over the
   per-bucket summary (at most ``buckets`` rows).
4. Inside a bucket, a running ``last`` over score ascending gives the nearest
   control at or below each target, a running ``last`` over score descending
   the nearest at or above. Both are running frames (unbounded preceding to
   current row), which Spark evaluates in one streaming pass.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from uptake.session import cut_lineage


def caliper_width(df: DataFrame, score: str, caliper_sd: float) -> float | None:
    """Caliper = ``caliper_sd`` x sample std of all scores (one global aggregate)."""
    sd = df.agg(F.stddev_samp(F.col(score).cast("double"))).first()[0]
    if sd is None or (isinstance(sd, float) and (math.isnan(sd) or sd == 0.0)):
        return None
    return caliper_sd * sd


def match_nearest(
    df: DataFrame,
    key: str,
    treated: str,
    score: str,
    caliper_sd: float = 0.1,
    caliper: float | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Return (target_key, control_key, distance) for every matched treated row."""
    spark = df.sparkSession
    key_type = df.schema[key].dataType.simpleString()
    none = f"target_key {key_type}, control_key {key_type}, distance double"
    h = caliper if caliper is not None else caliper_width(df, score, caliper_sd)
    if h is None or h <= 0:
        return spark.createDataFrame([], none)
    # read by the bounds, the buckets and the targets: computed once
    base = cut_lineage(
        df.where(F.col(score).isNotNull() & F.col(treated).isNotNull()).select(
            F.col(key).alias("k"), F.col(score).cast("double").alias("s"), F.col(treated).alias("t")
        )
    )
    controls = base.where(~F.col("t")).groupBy("s").agg(F.min("k").alias("ck"))
    target_scores = base.where(F.col("t")).select("s").distinct()

    n_buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    probs = [i / n_buckets for i in range(1, n_buckets)]
    cuts = controls.select("s").unionByName(target_scores).agg(F.percentile_approx("s", probs, max(10_000, 10 * n_buckets))).first()[0]
    if not cuts:
        return spark.createDataFrame([], none)
    splits = [float("-inf")] + sorted({float(c) for c in (cuts or []) if c is not None and math.isfinite(c)}) + [float("inf")]
    bucketizer = Bucketizer(splits=splits, inputCol="s", outputCol="__q", handleInvalid="keep")

    def bucketed(frame):
        return bucketizer.transform(frame).withColumn("b", F.col("__q").cast("int")).drop("__q")

    controls = bucketed(controls)
    target_scores = bucketed(target_scores)

    # sentinels: nearest control of all earlier / all later buckets, carried
    # over one row per bucket
    per_bucket = controls.groupBy("b").agg(
        F.max_by(F.struct("s", "ck"), "s").alias("hi"),
        F.min_by(F.struct("s", "ck"), "s").alias("lo"),
    )
    all_buckets = controls.select("b").unionByName(target_scores.select("b")).distinct()
    summary = all_buckets.join(per_bucket, on=["b"], how="left")
    earlier = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.orderBy(F.col("b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        "b", F.last("hi", ignorenulls=True).over(earlier).alias("prev"), F.last("lo", ignorenulls=True).over(later).alias("next")
    )
    from_below = carried.where(F.col("prev").isNotNull()).select("b", F.col("prev.s").alias("s"), F.col("prev.ck").alias("ck"))
    from_above = carried.where(F.col("next").isNotNull()).select("b", F.col("next.s").alias("s"), F.col("next.ck").alias("ck"))

    rows = (
        controls.select("b", "s", "ck", F.lit(0).alias("kind"))
        .unionByName(from_below.withColumn("kind", F.lit(0)))
        .unionByName(from_above.withColumn("kind", F.lit(0)))
        .unionByName(target_scores.select("b", "s", F.lit(None).cast(key_type).alias("ck"), F.lit(1).alias("kind")))
    )
    ctrl_s = F.when(F.col("kind") == 0, F.col("s"))
    ctrl_k = F.when(F.col("kind") == 0, F.col("ck"))
    up = Window.partitionBy("b").orderBy(F.col("s").asc(), F.col("kind").asc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    down = Window.partitionBy("b").orderBy(F.col("s").desc(), F.col("kind").asc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    scanned = rows.select(
        "s",
        "kind",
        F.last(ctrl_s, ignorenulls=True).over(up).alias("ls"),
        F.last(ctrl_k, ignorenulls=True).over(up).alias("lk"),
        F.last(ctrl_s, ignorenulls=True).over(down).alias("us"),
        F.last(ctrl_k, ignorenulls=True).over(down).alias("uk"),
    ).where(F.col("kind") == 1)
    dl = F.col("s") - F.col("ls")
    du = F.col("us") - F.col("s")
    pick_low = F.col("us").isNull() | (
        F.col("ls").isNotNull() & ((dl < du) | ((dl == du) & (F.col("lk") <= F.col("uk"))))
    )
    best = scanned.select(
        "s",
        F.when(pick_low, F.col("lk")).otherwise(F.col("uk")).alias("control_key"),
        F.when(pick_low, F.col("ls")).otherwise(F.col("us")).alias("cs"),
    ).where(F.col("control_key").isNotNull())

    targets = base.where(F.col("t")).select(F.col("k").alias("target_key"), "s")
    matched = targets.join(best, on=["s"], how="inner")
    return matched.select(
        "target_key", "control_key", F.abs(F.col("s") - F.col("cs")).alias("distance")
    ).where(F.col("distance") < F.lit(h))
