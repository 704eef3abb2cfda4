"""Aggregations A1-A18.

All of them are single ``groupBy().agg()`` passes (partial aggregation map
side, one shuffle on the group key) or global aggregates that return one
bounded row. Long outputs (one row per column or column pair) are produced
with ``stack`` from that single row instead of one job per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uptake.functions.arith import finite_or_null, ieee_divide, ln_inf, nan_to_null, row_sum, share_true
from uptake.operators.moments import correlations
from uptake.operators.selection import group_quantile


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _stack(df: DataFrame, pairs: Sequence[tuple[str, Column]], names: tuple[str, str]) -> DataFrame:
    """Turn one wide row into a long (name, value) table."""
    args = []
    for label, expr_name in pairs:
        args.append(F.lit(label))
        args.append(F.col(expr_name))
    return df.select(F.stack(F.lit(len(pairs)), *args).alias(*names))


# ------------------------------------------------------------ pivots


def pivot_max(
    long: DataFrame,
    keys: Sequence[str],
    measure: str,
    value: str,
    columns: Mapping[str, str],
) -> DataFrame:
    """A3: long -> wide, ``MAX(CASE WHEN measure = code THEN value END)``; absent stays NULL."""
    aggs = [
        F.max(F.when(F.col(measure) == F.lit(code), F.col(value))).alias(out)
        for out, code in columns.items()
    ]
    return long.groupBy(*keys).agg(*aggs)


def pivot_grouped(
    long: DataFrame,
    keys: Sequence[str],
    measure: str,
    value: str,
    groups: Mapping[str, Sequence[str]],
    maxima: Mapping[str, str] | None = None,
    default: float | None = 0.0,
) -> DataFrame:
    """A4: long -> wide with measure groups.

    ``groups``: output -> codes summed, ``SUM(CASE WHEN measure IN codes THEN
    value ELSE default END)``; ``maxima``: output -> single code with MAX.
    ``default=0`` is the original behaviour (a year with no business data
    becomes zeros); ``default=None`` keeps missing as NULL.
    """
    fill = F.lit(default).cast("double")
    aggs = []
    for out, code in (maxima or {}).items():
        aggs.append(F.max(F.when(F.col(measure) == F.lit(code), F.col(value)).otherwise(fill)).alias(out))
    for out, codes in groups.items():
        aggs.append(F.sum(F.when(F.col(measure).isin(list(codes)), F.col(value)).otherwise(fill)).alias(out))
    return long.groupBy(*keys).agg(*aggs)


def pivot_sum_fill(
    df: DataFrame, key: str, category: str, value: str, categories: Sequence[str]
) -> DataFrame:
    """A5: category -> columns with a sum, missing filled with 0 (``unstack().fillna(0)``).

    Categories are listed so Spark does not run an extra job to find them.
    """
    return (
        df.groupBy(key)
        .pivot(category, list(categories))
        .agg(F.sum(value))
        .na.fill(0.0, subset=list(categories))
    )


# ------------------------------------------------------------ group statistics


def group_mean(df: DataFrame, key: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Mean of each column per group, NULLs skipped."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in columns])


def group_median(df: DataFrame, key: str | Sequence[str], columns: Sequence[str], large_groups: bool = False) -> DataFrame:
    """Exact interpolated median per group, NULLs skipped (pandas ``median``).

    One aggregate that keeps a group's values in a buffer, right for groups
    whose size the schema bounds (a region has one row per year). With
    ``large_groups`` ranks are selected from a range sort instead, and no task
    holds a group. The values are the same.
    """
    if large_groups:
        return group_quantile(df, key, columns, 0.5)
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(*[F.median(c).alias(c) for c in columns])


def group_count(df: DataFrame, key: str | Sequence[str], name: str = "n") -> DataFrame:
    """Rows per group."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def table_counts(tables: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Rows and distinct keys per table; a NULL key counts as one value.

    One aggregate job per table; each returns one row.
    """
    frames = []
    for name, df in tables.items():
        frames.append(
            df.agg(
                F.count(F.lit(1)).alias("n_rows"),
                (F.count_distinct(F.col(key)) + F.max(F.col(key).isNull().cast("int"))).alias("n_keys"),
            ).select(F.lit(name).alias("table_name"), "n_rows", F.col("n_keys").cast("bigint").alias("n_keys"))
        )
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def slope(y: str, x: str, window=None) -> Column:
    """A10 aggregate: OLS slope of y on x; a single x value gives 0 (scikit-learn does).

    With ``window`` the slope is computed over it (W4: repeated on every row).
    """
    s = F.regr_slope(F.col(y).cast("double"), F.col(x).cast("double"))
    if window is not None:
        s = s.over(window)
    return F.coalesce(s, F.lit(0.0))


def slope_per_group(df: DataFrame, key: str, y: str, x: str, name: str) -> DataFrame:
    """A10: ``cal_growth`` as one aggregate per group; x shifts do not change the slope."""
    return df.groupBy(key).agg(slope(y, x).alias(name))


def correlation_long(
    df: DataFrame, columns: Sequence[str], log_columns: Sequence[str] = ()
) -> DataFrame:
    """Pearson correlation of every column pair after a natural log of ``log_columns``.

    Pairwise complete like pandas ``DataFrame.corr``: NaN counts as missing.
    One pass of mergeable co-moments per task (``operators.moments``), merged
    by pair: no row is expanded, the shuffle is one row per task and pair.
    ``ln(0) = -inf`` makes every pair with that
    column NaN, as in numpy; a constant column gives NULL (pandas: NaN).
    Output: (x, y, r) for all ordered pairs, diagonal included.
    """
    cols = list(columns)
    logs = set(log_columns)
    prepared = df.select(
        *[
            nan_to_null(ln_inf(c) if c in logs else F.col(c)).alias(f"v{i}")
            for i, c in enumerate(cols)
        ]
    )
    upper = correlations(prepared, prepared.columns)
    # every column pair appears in the output, also pairs without a complete row
    grid = df.sparkSession.createDataFrame(
        [(i, j, cols[i], cols[j]) for i in range(len(cols)) for j in range(i, len(cols))], "i int, j int, x string, y string"
    )
    upper = grid.join(upper, on=["i", "j"], how="left")
    # both orders of a pair from one pass; the diagonal once
    sides = F.array(F.struct("x", "y"), F.when(F.col("i") != F.col("j"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"))))
    return upper.select(F.explode(F.array_compact(sides)).alias("s"), "r").select("s.x", "s.y", "r")


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL (and NaN) count per column in one pass, as (column_name, n_null)."""
    cols = list(columns or df.columns)
    dtypes = dict(df.dtypes)

    def is_missing(c):
        base = F.col(_q(c)).isNull()
        if dtypes[c] in ("double", "float"):
            base = base | F.isnan(F.col(_q(c)))
        return base

    wide = df.agg(*[F.sum(is_missing(c).cast("bigint")).alias(f"c{i}") for i, c in enumerate(cols)])
    return _stack(wide, [(c, f"c{i}") for i, c in enumerate(cols)], ("column_name", "n_null"))


def share_of(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """One row with the share of rows meeting each predicate (NULL counts as false)."""
    return df.agg(*[share_true(p).alias(name) for name, p in predicates.items()])


def keys_with_n_values(df: DataFrame, keys: Sequence[str], column: str, n: int) -> DataFrame:
    """Share of key groups with exactly ``n`` non-null values of ``column``."""
    per_key = df.groupBy(*keys).agg(F.count(column).alias("__n"))
    return per_key.agg(share_true(F.col("__n") == n).alias("share"))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width histogram over [min, max]; the maximum falls in the last bin.

    The bounds are one global aggregate (two numbers fetched to the driver,
    like fitting a model parameter); counting is a partial aggregate per bin.
    Output (bin, lower, upper, n) for non-empty bins, bins numbered 1..bins.
    NULL, NaN and infinite values have no bin and are left out.
    """
    v = F.col(column).cast("double")
    vals = df.select(v.alias("__v")).where(F.abs("__v") < float("inf"))
    lo, hi = vals.agg(F.min("__v"), F.max("__v")).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, n bigint")
    width = (hi - lo) / bins
    if width == 0:
        b = F.lit(1)
    else:
        b = F.least(F.floor((F.col("__v") - F.lit(lo)) / F.lit(width)) + 1, F.lit(bins))
    counted = vals.groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        "bin",
        (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("lower"),
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("upper"),
        "n",
    )


def histograms(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """A15 on many columns: equal-width bins over each column's own [min, max], the maximum in the last bin.

    One aggregate for all bounds (two numbers per column reach the driver) and
    one for all counts, combined map side to columns x bins rows per task.
    Output (column_name, bin, lower, upper, n): every bin, empty ones too; a
    constant column has one bin, a column without finite values none. NULL,
    NaN and infinite values are left out.
    """
    cols = list(columns)
    values = df.select(*[finite_or_null(c).alias(f"v{i}") for i, c in enumerate(cols)])
    bounds = values.agg(*[f(f"v{i}").alias(f"{f.__name__}{i}") for i in range(len(cols)) for f in (F.min, F.max)]).first()
    grid, binned = [], []
    for i, c in enumerate(cols):
        lo, hi = bounds[f"min{i}"], bounds[f"max{i}"]
        if lo is None:
            continue
        width, v = (hi - lo) / bins, F.col(f"v{i}")
        b = F.least(F.floor((v - F.lit(lo)) / F.lit(width)) + 1, F.lit(bins)) if width else F.lit(1)
        binned.append(F.when(v.isNotNull(), F.struct(F.lit(i).alias("column"), b.cast("int").alias("bin"))))
        grid += [(i, b, c, lo + (b - 1) * width, lo + b * width) for b in range(1, (bins if width else 1) + 1)]
    grid = df.sparkSession.createDataFrame(grid, "column int, bin int, column_name string, lower double, upper double")
    if not binned:
        return grid.select("column_name", "bin", "lower", "upper", F.lit(0).cast("bigint").alias("n"))
    counted = values.select(F.explode(F.array_compact(F.array(*binned))).alias("b")).groupBy("b.column", "b.bin").agg(F.count(F.lit(1)).alias("n"))
    joined = grid.join(counted, on=["column", "bin"], how="left")
    return joined.select("column_name", "bin", "lower", "upper", F.coalesce("n", F.lit(0)).alias("n"))


def discrepancy(parts: Sequence[str], total: str) -> Column:
    """(sum of parts - total) / total with a NULL-skipping row sum.

    Plain division as in the original (a zero total gives +-inf, 0/0 is
    missing); the zero rule of ``safe_ratio`` would turn "no parts at all"
    (x + y = 0) into 0 instead of -1.
    """
    return ieee_divide(row_sum(*parts) - F.col(total).cast("double"), F.col(total))


# ------------------------------------------------------------ balance


def smd(x1_mean, x1_sd, x2_mean, x2_sd) -> Column:
    """Standardised mean difference with the pooled sample std."""
    pooled = F.sqrt((x1_sd * x1_sd + x2_sd * x2_sd) / 2)
    return F.try_divide(x1_mean - x2_mean, pooled)


def smd_table(df: DataFrame, group: str, covariates: Sequence[str], name: str) -> DataFrame:
    """SMD of each covariate between rows with ``group`` true and false, long (covariate, name).

    One conditional aggregate pass over ``df``; repeated rows count repeatedly.
    """
    aggs = []
    g = F.col(group)
    for i, c in enumerate(covariates):
        x = F.col(c).cast("double")
        aggs += [
            F.avg(F.when(g, x)).alias(f"m1_{i}"),
            F.stddev_samp(F.when(g, x)).alias(f"s1_{i}"),
            F.avg(F.when(~g, x)).alias(f"m0_{i}"),
            F.stddev_samp(F.when(~g, x)).alias(f"s0_{i}"),
        ]
    wide = df.agg(*aggs)
    wide = wide.select(
        *[
            smd(F.col(f"m1_{i}"), F.col(f"s1_{i}"), F.col(f"m0_{i}"), F.col(f"s0_{i}")).alias(f"d{i}")
            for i in range(len(covariates))
        ]
    )
    return _stack(wide, [(c, f"d{i}") for i, c in enumerate(covariates)], ("covariate", name))
