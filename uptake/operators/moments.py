"""Pairwise co-moments of many columns in one pass.

A task turns its rows into one set of arrays: per column pair the number of
rows that have both values, their means, sums of squares and sum of products
about the means. Sets are merged by pair afterwards, so a row is read once and
never expanded into its pairs; the shuffle is one row per task and pair.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_FIELDS = ("n", "mx", "my", "sx", "sy", "c")
_SCHEMA = "n array<double>, mx array<double>, my array<double>, sx array<double>, sy array<double>, c array<double>, inf array<boolean>"
#: A spread below this share of the mean is rounding: the column counts as constant.
ROUNDING = 1e-12


def _merge(a: tuple | None, b: tuple) -> tuple:
    """Moments of two sets of rows together; every entry is a (columns x columns) array."""
    if a is None:
        return b
    n = a[0] + b[0]
    share = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
    dx, dy = (np.where(b[0] > 0, b[k] - a[k], 0.0) for k in (1, 2))
    both = a[0] * share
    means = (np.where(a[0] > 0, a[k] + d * share, b[k]) for k, d in ((1, dx), (2, dy)))
    dx, dy = np.where(a[0] > 0, dx, 0.0), np.where(a[0] > 0, dy, 0.0)
    return (n, *means, a[3] + b[3] + both * dx * dx, a[4] + b[4] + both * dy * dy, a[5] + b[5] + both * dx * dy, a[6] | b[6])


def moments(x: np.ndarray) -> tuple:
    """Pairwise moments of the rows of ``x``, NaN for missing; entry [i, j] is over the rows that have both i and j.

    Values are taken relative to their column's mean first, so that the sums of
    products lose no digits to a mean far from 0.
    """
    there, infinite = ~np.isnan(x), np.isinf(x)
    finite = there & ~infinite
    held = finite.any(0)
    first = np.where(held, x[finite.argmax(0), np.arange(x.shape[1])], 0.0)
    d = np.where(finite, x - first, 0.0)
    centre = d.sum(0) / np.maximum(finite.sum(0), 1)
    d = np.where(finite, d - centre, 0.0)
    m, infinite = there.astype(float), infinite.astype(float)
    n = m.T @ m
    some = np.maximum(n, 1.0)
    sx = d.T @ m
    mx = sx / some
    squares = np.maximum((d * d).T @ m - sx * mx, 0.0)
    products = d.T @ d - n * mx * mx.T
    base = (first + centre)[:, None]
    return n, base + mx, (base + mx).T, squares, squares.T, products, (infinite.T @ m + m.T @ infinite) > 0


def pair_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(i, j, n, mx, my, sx, sy, c, inf) for i <= j: rows with both values, means, sums of squares and products about them.

    ``inf`` says whether such a row holds an infinite value.
    """
    import pyarrow as pa

    upper = np.triu_indices(len(columns))
    # a select without renaming clashes: the caller's columns by position
    numbers = df.select(*[F.col(c).cast("double").alias(f"v{k}") for k, c in enumerate(columns)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
                with np.errstate(invalid="ignore"):
                    total = _merge(total, moments(x))
        if total is not None:
            arrays = [pa.array([t[upper].tolist()]) for t in total]
            yield pa.RecordBatch.from_arrays(arrays, [*_FIELDS, "inf"])

    per_task = numbers.mapInArrow(run, _SCHEMA)
    zipped = F.posexplode(F.arrays_zip(*_FIELDS, "inf"))
    pairs = per_task.select(zipped.alias("pair", "m")).select("pair", "m.*").where("n > 0")
    # relative to the least mean of any task, so equal means add nothing
    w = Window.partitionBy("pair")
    dx, dy = (F.col(c) - F.min(c).over(w) for c in ("mx", "my"))
    pairs = pairs.select("*", dx.alias("dx"), dy.alias("dy"))
    s = lambda e: F.sum(F.expr(e))
    merged = pairs.groupBy("pair").agg(
        s("n").alias("n"), F.min("mx").alias("x0"), F.min("my").alias("y0"), s("n * dx").alias("tx"), s("n * dy").alias("ty"),
        s("sx + n * dx * dx").alias("qx"), s("sy + n * dy * dy").alias("qy"), s("c + n * dx * dy").alias("q"), F.max("inf").alias("inf"),
    )
    i, j = (F.element_at(F.array(*[F.lit(int(k)) for k in side]), F.col("pair") + 1) for side in upper)
    return merged.select(
        i.alias("i"), j.alias("j"), F.col("n").cast("bigint").alias("n"), F.expr("x0 + tx / n").alias("mx"), F.expr("y0 + ty / n").alias("my"),
        F.expr("greatest(qx - tx * tx / n, 0)").alias("sx"), F.expr("greatest(qy - ty * ty / n, 0)").alias("sy"), F.expr("q - tx * ty / n").alias("c"), "inf",
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(i, j, r) for i <= j with a row that has both: NaN where one holds an infinite value, NULL for a constant side or a single row."""
    m = pair_moments(df, columns)
    steady = lambda s, mean: F.col(s) <= F.col("n") * F.pow(F.abs(mean) * ROUNDING, 2)
    r = F.col("c") / F.sqrt(F.col("sx") * F.col("sy"))
    r = F.least(F.greatest(r, F.lit(-1.0)), F.lit(1.0))
    r = F.when(F.col("n") < 2, F.lit(None)).when(F.col("inf"), F.lit(float("nan"))).when(steady("sx", F.col("mx")) | steady("sy", F.col("my")), F.lit(None)).otherwise(r)
    return m.select("i", "j", r.alias("r"))
