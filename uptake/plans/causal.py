"""Observational contrasts: rurality, covariates, propensity, matching, balance, ATT."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.operators.aggregates import group_median, pivot_sum_fill, smd_table
from uptake.operators.matching import match_nearest
from uptake.operators.relational import drop_null, filter_equal
from uptake.operators.resample import bootstrap_summary, dense_index
from uptake.plans.segment import standardise
from uptake.session import MODEL_PARTITIONS, cut_lineage, ensure_checkpoint_dir

# Area classes, the default covariate exclusions of the two
# contrasts (education shares), caliper and bootstrap settings.
RURAL, URBAN = "Rural", "Urban"
EDUCATION = ("Certificate", "AdvDiploma", "BachelorDegree", "GraduateDiploma", "Postgraduate")
INCOME = "MedianEquivalisedHouseholdIncome"
CALIPER_SD = 0.1
N_BOOT = 2000
SEED = 42


def rurality(dim_region: DataFrame) -> DataFrame:
    """K11 = A5 + P6: area per (region, class) summed, pivoted, Rural = rural area > urban area.

    Rows with a NULL region or class are left out (pandas ``groupby``);
    ties count as urban.
    """
    rows = dim_region.where(F.col("Lga").isNotNull() & F.col("Region_Type").isNotNull())
    wide = pivot_sum_fill(rows, "Lga", "Region_Type", "Region_Type_Area", [RURAL, URBAN])
    return wide.select("Lga", (F.col(RURAL) > F.col(URBAN)).alias("Rural"))


def region_covariates(
    population: DataFrame, economy: DataFrame, rural: DataFrame | None = None
) -> DataFrame:
    """Per-region medians over years of population and economy, inner join, flag, drop NULL rows."""
    pop_cols = [c for c in population.columns if c not in ("Lga", "Year")]
    eco_cols = [c for c in economy.columns if c not in ("Lga", "Year")]
    pop = group_median(population.where(F.col("Lga").isNotNull()), "Lga", pop_cols)
    eco = group_median(economy.where(F.col("Lga").isNotNull()), "Lga", eco_cols)
    out = pop.join(eco, on=["Lga"], how="inner")
    if rural is not None:
        out = out.join(rural, on=["Lga"], how="left")
    return drop_null(out)


def outcome(fact: DataFrame, customer_type: str, measure: str, large_groups: bool = False) -> DataFrame:
    """Median of one fact measure per region for one customer type (all years); ``large_groups`` as in ``group_median``."""
    rows = filter_equal(fact, "Type", customer_type).where(F.col("Lga").isNotNull())
    return group_median(rows.select("Lga", F.col(measure).cast("double").alias(measure)), "Lga", [measure], large_groups)


def quantile_cuts(df: DataFrame, column: str, low: float = 0.33, high: float = 0.67) -> DataFrame:
    """Exact interpolated quantiles (numpy ``linear``) as one row (low, high).

    The values are range-sorted and numbered, and the rows around each rank
    are picked by number: at most four rows reach the driver, and no task
    holds all values. NULL values are left out; without any value both are NULL.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    c = F.col(column).cast("double")
    ranked = dense_index(df.select(c.alias("v")).where(F.col("v").isNotNull()), "v", "j")
    n = ranked.count()
    if n == 0:
        return spark.createDataFrame([(None, None)], "low double, high double")
    places = [(n - 1) * q for q in (low, high)]
    wanted = {f(p) for p in places for f in (math.floor, math.ceil)}
    at = {r["j"]: r["v"] for r in ranked.where(F.col("j").isin(sorted(wanted))).collect()}

    def interpolated(p: float) -> float:
        below, above = math.floor(p), math.ceil(p)
        a, b = at[below], at[above]
        return a if a == b else (above - p) * a + (p - below) * b

    return spark.createDataFrame([tuple(interpolated(p) for p in places)], "low double, high double")


def trim_tails(
    df: DataFrame, column: str, low: float = 0.33, high: float = 0.67, compat: bool = False
) -> DataFrame:
    """P7 + P6: keep rows at or below the low cut or at or above the high cut; treated = at or below low.

    ``compat=True`` reproduces the original's second test (``>= low``), which
    keeps every row.
    """
    # read by the cuts and by the filter: computed once
    df = cut_lineage(df)
    cuts = quantile_cuts(df, column, low, high).first()
    lo, hi = cuts["low"], cuts["high"]
    if lo is None:
        return df.withColumn("treated", F.lit(None).cast("boolean")).limit(0)
    upper = lo if compat else hi
    c = F.col(column).cast("double")
    kept = df.where((c <= F.lit(lo)) | (c >= F.lit(upper)))
    return kept.withColumn("treated", c <= F.lit(lo))


def propensity(
    df: DataFrame,
    key: str,
    target: str,
    exclude: Sequence[str] = (),
    max_iter: int = 1000,
    materialise: bool = True,
    partitions: int = MODEL_PARTITIONS,
) -> tuple[DataFrame, list[str], object]:
    """M7: logistic propensity score on standardised covariates.

    The original fits scikit-learn's default L2 model (C = 1), which
    minimises 0.5 |w|^2 + sum(loss). Spark minimises mean(loss) +
    regParam * 0.5 |w|^2, so regParam = 1 / n gives the same optimum; the
    intercept is unpenalised in both. Returns (scored DataFrame, covariates,
    fitted model).

    The input (one row per unit) is checkpointed once unless the caller has
    already materialised it, and dealt to ``partitions`` tasks by key: the count, the scaler statistics and every solver iteration then
    read the small table instead of recomputing its lineage.
    """
    if materialise:
        df = cut_lineage(df)
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    covariates = [c for c in df.columns if c not in set(exclude) | {key, target}]
    data = df.withColumn("__label", F.col(target).cast("double"))
    n = df.count()
    data = standardise(data, covariates).repartition(partitions, key)
    assembled = VectorAssembler(inputCols=covariates, outputCol="__features").transform(data)
    lr = LogisticRegression(
        featuresCol="__features",
        labelCol="__label",
        regParam=1.0 / max(n, 1),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=1e-8,
    )
    model = lr.fit(assembled)
    scored = model.transform(assembled).select(
        *df.columns, vector_to_array("probability")[1].alias("propensity_score")
    )
    return scored, covariates, model


def propensity_certificate(scored: DataFrame, target: str, covariates: Sequence[str], coefficients: Sequence[float]) -> DataFrame:
    """Gradient of the penalised loss at given scores, per covariate and for the intercept, over the number of rows.

    The loss is 0.5 |w|^2 + sum(log loss) on the standardised covariates; at its
    optimum the sum of (score - target) * covariate + w is 0 for each. One
    aggregate, whatever solver made the scores.
    """
    rows = standardise(scored, covariates)
    miss = F.col("propensity_score") - F.col(target).cast("double")
    names = [*covariates, "(intercept)"]
    sums = [F.sum(miss * F.col(c)) + F.lit(float(w)) for c, w in zip(covariates, coefficients)] + [F.sum(miss)]
    wide = rows.agg(*[(g / F.count(F.lit(1))).alias(f"g{i}") for i, g in enumerate(sums)])
    pairs = F.array(*[F.struct(F.lit(c).alias("covariate"), F.col(f"g{i}").alias("gradient")) for i, c in enumerate(names)])
    return wide.select(F.explode(pairs).alias("p")).select("p.*")


def matched_pairs(scored: DataFrame, key: str, treated: str, score: str, caliper_sd: float = CALIPER_SD) -> DataFrame:
    """Nearest control per treated row within caliper_sd x std of all scores."""
    return match_nearest(scored, key, treated, score, caliper_sd)


def matched_share(pairs: DataFrame, population: DataFrame) -> DataFrame:
    """M8: matched targets over all rows."""
    n_pairs = pairs.agg(F.count(F.lit(1)).alias("n_pairs"))
    n_rows = population.agg(F.count(F.lit(1)).alias("n_rows"))
    return n_pairs.unionByName(n_rows, allowMissingColumns=True).agg(
        (F.max("n_pairs") / F.max("n_rows")).alias("matched_share")
    )


def attach_outcome(pairs: DataFrame, outcome_df: DataFrame, key: str, value: str) -> DataFrame:
    """Outcome of both sides of each pair (two left joins)."""
    o = outcome_df.select(F.col(key).alias("__k"), F.col(value).alias("__v"))
    t = o.select(F.col("__k").alias("target_key"), F.col("__v").alias("target_outcome"))
    c = o.select(F.col("__k").alias("control_key"), F.col("__v").alias("control_outcome"))
    return pairs.join(t, on=["target_key"], how="left").join(c, on=["control_key"], how="left")


def balance(
    df: DataFrame, key: str, treated: str, pairs: DataFrame, covariates: Sequence[str]
) -> DataFrame:
    """M9 = A18: SMD per covariate before matching (all rows) and after (pair rows, repeats counted)."""
    before = smd_table(df, treated, covariates, "SMD_before")
    cov = df.select(F.col(key).alias("__k"), *covariates)
    t_rows = pairs.join(cov, pairs["target_key"] == cov["__k"], "inner").select(
        F.lit(True).alias("__g"), *covariates
    )
    c_rows = pairs.join(cov, pairs["control_key"] == cov["__k"], "inner").select(
        F.lit(False).alias("__g"), *covariates
    )
    after = smd_table(t_rows.unionByName(c_rows), "__g", covariates, "SMD_after")
    return before.join(after, on=["covariate"], how="inner")


def att(pairs_with_outcome: DataFrame) -> DataFrame:
    """Mean of target minus control outcome over pairs (NULL differences skipped)."""
    return pairs_with_outcome.agg(
        F.avg(F.col("target_outcome").cast("double") - F.col("control_outcome").cast("double")).alias("att")
    )


def bootstrap_att(pairs_with_outcome: DataFrame, n_boot: int = N_BOOT, seed: int = SEED) -> DataFrame:
    """Bootstrap of the pair differences; pairs ordered by target key."""
    diffs = pairs_with_outcome.select(
        "target_key",
        (F.col("target_outcome").cast("double") - F.col("control_outcome").cast("double")).alias("diff"),
    )
    return bootstrap_summary(diffs, "diff", "target_key", n_boot, seed)


def contrast(
    units: DataFrame,
    key: str,
    target: str,
    exclude: Sequence[str],
    outcome_df: DataFrame,
    outcome_col: str,
    n_boot: int = N_BOOT,
    seed: int = SEED,
) -> dict:
    """Propensity -> match -> balance -> ATT with bootstrap; returns named DataFrames.

    The units (one row per region) and the outcome table are checkpointed
    once: the solver and the later steps read them many times.
    """
    units = cut_lineage(units)
    scored, covariates, _ = propensity(units, key, target, exclude, materialise=False)
    return contrast_from_scores(scored, key, target, "propensity_score", covariates, outcome_df, outcome_col, n_boot, seed)


def contrast_from_scores(
    scored: DataFrame,
    key: str,
    target: str,
    score: str,
    covariates: Sequence[str],
    outcome_df: DataFrame,
    outcome_col: str,
    n_boot: int = N_BOOT,
    seed: int = SEED,
) -> dict:
    """M8-M11 on units that have a score already: match -> balance -> ATT with bootstrap."""
    outcome_df = cut_lineage(outcome_df)
    # written to the checkpoint folder, so no cache outlives the call
    scored = cut_lineage(scored.withColumn("__treated", F.col(target).cast("boolean")))
    pairs = cut_lineage(matched_pairs(scored.withColumnRenamed(key, "__key"), "__key", "__treated", score))
    with_outcome = attach_outcome(pairs, outcome_df, key, outcome_col)
    return {
        "scored": scored,
        "pairs": pairs,
        "matched_share": matched_share(pairs, scored),
        "balance": balance(scored, key, "__treated", pairs, covariates),
        "att": bootstrap_att(with_outcome, n_boot, seed),
    }
