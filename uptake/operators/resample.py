"""Dense row index and the pair bootstrap (M11), both partition-independent.

The bootstrap draws are hash values of (seed, replicate, position), so a
replicate is the same whatever the partitioning or the executor count, and
any engine with md5 reproduces it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

if TYPE_CHECKING:
    import pyarrow as pa


def dense_index(df: DataFrame, order: str, name: str = "idx", partitions: int | None = None) -> DataFrame:
    """Attach 0..n-1 by ascending ``order`` without a single-partition global window.

    Range partitioning puts consecutive keys in consecutive partitions; inside
    a partition ``monotonically_increasing_id`` carries (partition, position)
    after a local sort. Per-partition counts (one row per partition) give the
    offsets. The result is checkpointed to the reliable checkpoint directory:
    the range bounds come from sampling, so a recomputation after a lost
    executor must not re-sample them.
    """
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.repartitionByRange(n_parts, F.col(order))
        .sortWithinPartitions(F.col(order))
        .withColumn("__mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    part = F.shiftright(F.col("__mid"), 33)
    pos = F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))
    counts = ranged.groupBy(part.alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    # one row per partition: the running sum is over the partition count only
    offsets = counts.select(
        "__p", (F.sum("__n").over(Window.orderBy("__p")) - F.col("__n")).alias("__off")
    )
    out = ranged.join(F.broadcast(offsets), part == F.col("__p"), "inner")
    return out.select(*df.columns, (F.col("__off") + pos).alias(name))


def hash_draw(seed: int, replicate, position, n) -> "F.Column":
    """Index in [0, n) for draw ``position`` of ``replicate``: 60 bits of the md5 of 'seed:replicate:position'."""
    text = F.concat_ws(":", F.lit(str(seed)), replicate.cast("string"), position.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint") % F.lit(n)


def bootstrap_means(
    values: DataFrame,
    value: str,
    order: str,
    n_boot: int = 2000,
    seed: int = 42,
    indexed: DataFrame | None = None,
    n: int | None = None,
) -> tuple[DataFrame, int]:
    """Means of ``n_boot`` resamples (with replacement, size n) of ``values[value]``.

    Returns (DataFrame(replicate, mean), n). NULL values are drawn like any
    other row and skipped by the mean, as pandas does. The n * n_boot draws
    are those of :func:`hash_draw`, made in tasks that each take some chunks of
    replicates. They are sent to blocks of the dense index, two bytes a
    draw, where the values lie; a block gives a sum and a count per replicate.
    A task holds the draws of one chunk, or one block of values
    and the draws of ``DRAW_REPLICATES`` replicates that fall into it.
    """
    spark = values.sparkSession
    if indexed is None:
        indexed = dense_index(values.select(order, value), order, "j")
    if n is None:
        n = indexed.count()
    if n == 0:
        return spark.createDataFrame([], "replicate bigint, mean double"), 0
    draws = block_rows(spark, n, n_boot, seed)
    block, parts = F.expr(f"j div {DRAW_BLOCK}"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit((n_boot - 1) // DRAW_REPLICATES).cast("bigint")))
    held = indexed.select(block.alias("block"), (F.col("j") % DRAW_BLOCK).cast("int").alias("at"), F.col(value).cast("double").alias("v"))
    held = held.withColumn("part", parts)
    sums = held.groupBy("block", "part").cogroup(draws.groupBy("block", "part")).applyInArrow(_block_sums, "replicate bigint, s double, m bigint")
    means = sums.groupBy("replicate").agg(F.sum("s").alias("s"), F.sum("m").alias("m"))
    return means.select("replicate", F.try_divide("s", "m").alias("mean")), n


#: Rows of a block that draws are sent to, draws made at once, replicates whose draws meet a block in one task.
DRAW_BLOCK = 1 << 14
DRAW_CHUNK = 1 << 20
DRAW_REPLICATES = 500


def block_rows(spark, n: int, n_boot: int, seed: int) -> DataFrame:
    """(block, part, replicate, at): the draws of each replicate by block of the index, places inside the block as 16-bit integers."""
    import pyarrow as pa

    chunks = -(-n // DRAW_CHUNK)
    # a task makes 64 chunks at most
    tasks = max(spark.sparkContext.defaultParallelism, -(-n_boot * chunks // 64))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        from uptake.operators.draws import hash_draws

        for rows in parts:
            for i in rows.column(0).to_pylist():
                replicate, chunk = i % n_boot, i // n_boot
                drawn = np.sort(hash_draws(seed, replicate, chunk * DRAW_CHUNK, min((chunk + 1) * DRAW_CHUNK, n), n))
                block = drawn // DRAW_BLOCK
                first = np.flatnonzero(np.diff(block, prepend=-1))
                at = np.split((drawn % DRAW_BLOCK).astype(np.uint16), first[1:])
                columns = [pa.array(block[first]), pa.array(np.full(len(at), replicate // DRAW_REPLICATES)), pa.array(np.full(len(at), replicate)), pa.array([x.tobytes() for x in at], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["block", "part", "replicate", "at"])

    return spark.range(0, n_boot * chunks, 1, min(tasks, n_boot * chunks)).mapInArrow(run, "block bigint, part bigint, replicate bigint, at binary")


def _block_sums(values: pa.Table, draws: pa.Table) -> pa.Table:
    """Sum and number of the values drawn from one block, per row of ``draws``."""
    import numpy as np
    import pyarrow as pa

    place, v = values.column("at").to_numpy(), values.column("v")
    value, present = np.zeros(DRAW_BLOCK), np.zeros(DRAW_BLOCK, bool)
    present[place] = v.is_valid().to_numpy()
    value[place] = np.where(present[place], v.to_numpy(), 0.0)
    sums, counts = [], []
    for x in draws.column("at"):
        at = np.frombuffer(x.as_buffer(), np.uint16)
        sums.append(value[at].sum())
        counts.append(np.count_nonzero(present[at]))
    return pa.table({"replicate": draws.column("replicate"), "s": pa.array(sums, pa.float64()), "m": pa.array(counts, pa.int64())})


def _poisson1_cdf(k_max: int = 18) -> list[float]:
    """P(K <= k) for K ~ Poisson(1), k = 0..k_max, from exp(-1) * sum 1/i!."""
    out, term, total = [], math.exp(-1.0), 0.0
    for i in range(k_max + 1):
        total += term
        out.append(total)
        term /= i + 1
    return out


def poisson_weight(seed: int, replicate, key) -> "F.Column":
    """Poisson(1) weight of row ``key`` in ``replicate`` by inverting the CDF at a hashed uniform.

    The uniform has 52 bits; the table leaves out a tail of P(K > 18) = 3e-18,
    less than one step of it.
    """
    text = F.concat_ws(":", F.lit(f"p{seed}"), replicate.cast("string"), key.cast("string"))
    u = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    cdf = _poisson1_cdf()
    w = F.when(u < F.lit(cdf[0]), F.lit(0))
    for k in range(1, len(cdf)):
        w = w.when(u < F.lit(cdf[k]), F.lit(k))
    return w.otherwise(F.lit(len(cdf)))


def bootstrap_means_poisson(
    values: DataFrame, value: str, order: str, n_boot: int = 2000, seed: int = 42
) -> DataFrame:
    """Poisson bootstrap: every row gets a Poisson(1) weight per replicate.

    Same limit distribution as resampling n of n with replacement, but each
    row produces its own B weights where it lives: no dense index, no join,
    no shuffle of the n x B draws. Partial aggregation reduces each task to
    B rows before the only shuffle. This is the path for large n.
    """
    reps = F.sequence(F.lit(0), F.lit(n_boot - 1))
    rows = values.select(F.col(order).alias("__k"), F.col(value).cast("double").alias("v"))
    weighted = rows.select("__k", "v", F.explode(reps).alias("replicate")).select(
        "replicate", "v", poisson_weight(seed, F.col("replicate"), F.col("__k")).alias("w")
    )
    return weighted.groupBy("replicate").agg(
        F.try_divide(
            F.sum(F.when(F.col("v").isNotNull(), F.col("w") * F.col("v"))),
            F.sum(F.when(F.col("v").isNotNull(), F.col("w"))),
        ).alias("mean")
    )


#: Rows of a block of the split scheme; blocks follow the dense index, so the scheme depends on n alone.
SPLIT_BLOCK = 1 << 16


def block_draws(n: int, block: int, n_boot: int, seed: int, size: int = SPLIT_BLOCK) -> "np.ndarray":
    """Of n draws with replacement from n rows, how many fall into one block of ``size`` rows, per replicate.

    The blocks are the leaves of a binary tree. At each node the draws of all
    replicates are split between its halves by binomial numbers seeded by the
    node, so the blocks of a replicate share one multinomial draw, although each
    walks its own log2(blocks) nodes and knows nothing of the others.
    """
    import numpy as np

    low, high = 0, -(-n // size)
    draws = np.full(n_boot, n, np.int64)
    rows = lambda a, b: min(b * size, n) - min(a * size, n)
    while high - low > 1:
        middle = (low + high) // 2
        left = np.random.default_rng([seed, low, high]).binomial(draws, rows(low, middle) / rows(low, high))
        draws, low, high = (left, low, middle) if block < middle else (draws - left, middle, high)
    return draws


def bootstrap_means_split(indexed: DataFrame, value: str, n: int, n_boot: int = 2000, seed: int = 42, size: int | None = None) -> DataFrame:
    """Means of ``n_boot`` resamples of n rows with dense index ``j``: multinomial, without a row per draw.

    A block of rows learns its draws from :func:`block_draws`, takes them where
    it lies and gives a sum and a count per replicate; the shuffle after that is
    one row of each per block. NULL values are drawn and skipped by the mean.
    """
    import pyarrow as pa

    size = size or SPLIT_BLOCK

    def resampled(rows: pa.Table) -> pa.Table:
        import numpy as np

        block = rows.column("block")[0].as_py()
        order = np.argsort(rows.column("j").to_numpy())
        values = rows.column("v").to_numpy(zero_copy_only=False).astype(float)[order]
        present = ~np.isnan(values)
        values = np.where(present, values, 0.0)
        draws = block_draws(n, block, n_boot, seed, size)
        rng = np.random.default_rng([seed, n, block, 1])
        sums, counts = np.zeros(n_boot), np.zeros(n_boot, np.int64)
        for b, m in enumerate(draws.tolist()):
            at = rng.integers(0, len(values), m)
            sums[b], counts[b] = values[at].sum(), present[at].sum()
        return pa.table({"s": pa.array([sums.tolist()]), "m": pa.array([counts.tolist()], pa.list_(pa.int64()))})

    blocks = indexed.select(F.expr(f"j div {size}").alias("block"), "j", F.col(value).cast("double").alias("v"))
    parts = blocks.groupBy("block").applyInArrow(resampled, "s array<double>, m array<bigint>")
    rows = parts.select(F.posexplode(F.arrays_zip("s", "m")).alias("replicate", "p"))
    means = rows.groupBy("replicate").agg(F.sum("p.s").alias("s"), F.sum("p.m").alias("m"))
    return means.select(F.col("replicate").cast("bigint").alias("replicate"), F.try_divide("s", "m").alias("mean"))


def bootstrap_summary(
    values: DataFrame,
    value: str,
    order: str,
    n_boot: int = 2000,
    seed: int = 42,
    level: float = 0.95,
    method: str = "multinomial",
) -> DataFrame:
    """ATT with percentile CI and two-sided bootstrap p-value, one row.

    p: q = share of replicate means on the far side of 0 (<= 0 when the
    estimate is positive, >= 0 otherwise); p = 2 * min(q, 1 - q).
    The two one-row aggregates (estimate, replicate statistics) are the only
    values fetched to the driver.

    ``method``: "multinomial" resamples n of n with replacement as the
    original does (hash draws joined to a dense index), whatever n is;
    "split" draws the same distribution by binomial splits over blocks of the
    dense index, without a row per draw; "poisson" uses Poisson(1) weights.
    Both only where the caller asks for them.
    """
    from uptake.session import cut_lineage

    if method not in ("multinomial", "split", "poisson"):
        raise ValueError(f"unknown method {method!r}")
    # the input (one row per matched unit) is read by the count, the range
    # sampling, the index and the estimate: materialise it once
    values = cut_lineage(values.select(order, value))
    # one job: the estimate and n
    row = values.agg(F.avg(F.col(value).cast("double")).alias("att"), F.count(F.lit(1)).alias("n")).first()
    row_est, n = row["att"], row["n"]
    if method == "poisson":
        means = bootstrap_means_poisson(values, value, order, n_boot, seed)
    elif method == "split":
        means = bootstrap_means_split(dense_index(values, order, "j"), value, n, n_boot, seed)
    else:
        indexed = dense_index(values, order, "j")
        means, n = bootstrap_means(values, value, order, n_boot, seed, indexed, n)
    lo, hi = (1 - level) / 2, 1 - (1 - level) / 2
    stats = means.agg(
        F.percentile("mean", lo).alias("ci_lower"),
        F.percentile("mean", hi).alias("ci_upper"),
        F.avg((F.col("mean") <= 0).cast("double")).alias("q_le"),
        F.avg((F.col("mean") >= 0).cast("double")).alias("q_ge"),
    )
    s = stats.first()
    q = None
    if row_est is not None and s["q_le"] is not None:
        q = s["q_le"] if row_est > 0 else s["q_ge"]
    p = None if q is None else 2 * min(q, 1 - q)
    return spark_row(
        values.sparkSession,
        att=row_est,
        ci_lower=s["ci_lower"],
        ci_upper=s["ci_upper"],
        p_value=p,
        n_pairs=n,
        n_boot=n_boot,
    )


def spark_row(spark, **fields) -> DataFrame:
    schema = ", ".join(
        f"{k} {'bigint' if isinstance(v, int) and not isinstance(v, bool) else 'double'}" for k, v in fields.items()
    )
    return spark.createDataFrame([tuple(fields.values())], schema)
