"""Market segmentation: standardise, elbow, K-means, PCA, cluster profile.

Model fitting runs in Spark ML on an assembled vector column that is cached
once. Only model parameters (centres, components, ratios: k x features
numbers) and one-row statistics reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uptake.functions.arith import finite_or_null, round_half_even
from uptake.operators.relational import label_and_union, lookup
from uptake.operators.windows import average_rank
from uptake.session import MODEL_PARTITIONS, cut_lineage, solver_input

# The five clustering features, the profile columns, k, seed.
CLUSTER_FEATURES = ("GrowthSolar", "GrowthBattery", "PenSolar", "BSR", "CPDSolar")
PROFILE_COLUMNS = ("PenSolar", "CPDSolar", "BSR", "GrowthSolar", "GrowthBattery")
N_CLUSTERS = 4
SEED = 42


def clean_features(df: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """+-inf -> NULL, then drop rows with a NULL feature."""
    out = df.select(key, *[finite_or_null(c).alias(c) for c in features])
    return out.na.drop(how="any", subset=list(features))


def standardise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """M1: (x - mean) / population std; a constant column becomes 0 (scikit-learn's rule).

    One global aggregate gives 2 x columns numbers; the scaling itself is a
    column expression (no Python per row).
    """
    cols = list(columns)
    if not cols:
        return df
    stats = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)],
    ).first()
    exprs = {}
    for i, c in enumerate(cols):
        m, s = stats[f"m{i}"], stats[f"s{i}"]
        x = F.col(c).cast("double")
        if m is None:
            exprs[c] = F.lit(None).cast("double")
        elif not s:
            exprs[c] = x - F.lit(m)
        else:
            exprs[c] = (x - F.lit(m)) / F.lit(s)
    return df.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns])


def _vectors(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(features), outputCol=out).transform(df)


def _kmeans(k: int, seed: int, max_iter: int = 300, tol: float = 1e-4):
    from pyspark.ml.clustering import KMeans

    return KMeans(k=k, seed=seed, maxIter=max_iter, tol=tol, featuresCol="features", predictionCol="__c")


def elbow(
    df: DataFrame, key: str, features: Sequence[str], ks: Sequence[int] = range(1, 14), seed: int = SEED, partitions: int = MODEL_PARTITIONS
) -> DataFrame:
    """M2: mean squared distance to the nearest centre for each k (the distortion curve).

    k = 1 has a closed form: the sum of the population variances (the
    standardised features' count, constant columns contributing 0). Spark ML
    rejects k = 1, so that point is computed directly. More clusters than rows
    have no fit: such a k keeps its row, with a NULL distortion. A table
    without rows has no curve.

    The rows are dealt to ``partitions`` tasks; the seeded starts depend on
    their number.
    """
    spark = df.sparkSession
    clean = cut_lineage(clean_features(df, key, features))
    data = solver_input(standardise(clean, features), key, partitions)
    vec = _vectors(data, features).select("features").cache()
    try:
        n = vec.count()

        def fit(k):
            if k > n:
                return (k, None)
            if k == 1:
                var = data.agg(*[F.var_pop(c).alias(c) for c in features]).first()
                return (k, float(sum(v or 0.0 for v in var)))
            model = _kmeans(k, seed).fit(vec)
            return (k, float(model.summary.trainingCost) / n)

        from concurrent.futures import ThreadPoolExecutor

        # the fits are independent jobs on one cached table: submit a few at
        # a time so the scheduler can fill idle cores (results do not depend
        # on the order; each fit has its own seed)
        with ThreadPoolExecutor(max_workers=4) as pool:
            rows = sorted(pool.map(fit, ks)) if n else []
    finally:
        vec.unpersist()
    return spark.createDataFrame(rows, "k int, distortion double")


def cluster(
    df: DataFrame, key: str, features: Sequence[str] = CLUSTER_FEATURES, k: int = N_CLUSTERS, seed: int = SEED, partitions: int = MODEL_PARTITIONS
) -> DataFrame:
    """M3: K-means labels per key on standardised features.

    Input rows are dealt by the hash of the key to ``partitions`` tasks
    and sorted, so the k-means|| initialisation, which depends on their number,
    sees the same on every run. Labels are
    renumbered by centre (ordered by first feature, then the next), so they
    do not depend on the solver's internal numbering.
    """
    clean = cut_lineage(clean_features(df, key, features))
    vec = _vectors(solver_input(standardise(clean, features), key, partitions), features).cache()
    try:
        model = _kmeans(k, seed).fit(vec)
    finally:
        vec.unpersist()
    centres = [tuple(float(x) for x in c) for c in model.clusterCenters()]
    order = sorted(range(len(centres)), key=lambda i: centres[i])
    relabel = {old: new for new, old in enumerate(order)}
    mapping = F.create_map(*[F.lit(x) for pair in relabel.items() for x in pair])
    out = model.transform(vec).select(key, mapping[F.col("__c")].cast("int").alias("Cluster"))
    return out


def cluster_certificate(
    df: DataFrame, labels: DataFrame, key: str, features: Sequence[str] = CLUSTER_FEATURES, tolerance: float = 1e-3
) -> DataFrame:
    """Whether given labels are a fixed point of K-means on the standardised features, whatever solver made them.

    The centres are the means of the labelled rows (one aggregate, k x features
    numbers); one more aggregate measures every row against them. One row:
    ``n_rows`` with a label, ``n_clusters``, ``n_misplaced`` (rows that another
    centre is nearer to, by more than ``tolerance``) and ``distortion``, the mean
    squared distance to the own centre.
    """
    clean = cut_lineage(clean_features(df, key, features))
    rows = cut_lineage(standardise(clean, features).join(labels.select(key, "Cluster"), on=[key], how="inner"))
    centres = rows.groupBy("Cluster").agg(*[F.avg(c).alias(c) for c in features]).orderBy("Cluster").collect()

    def distance(centre) -> Column:
        return sum(((F.col(c) - F.lit(centre[c])) * (F.col(c) - F.lit(centre[c])) for c in features), F.lit(0.0))

    measured = rows.select("Cluster", F.array(*[F.struct(F.lit(c["Cluster"]).alias("c"), distance(c).alias("d")) for c in centres]).alias("all")) if centres else None
    if measured is None:
        return df.sparkSession.createDataFrame([(0, 0, 0, None)], "n_rows bigint, n_clusters bigint, n_misplaced bigint, distortion double")
    own = F.filter("all", lambda x: x["c"] == F.col("Cluster"))[0]["d"]
    least = F.array_min(F.transform("all", lambda x: x["d"]))
    return measured.select("Cluster", own.alias("own"), least.alias("least")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("Cluster").alias("n_clusters"),
        F.count(F.when(F.sqrt("own") > F.sqrt("least") + tolerance, F.lit(1))).alias("n_misplaced"),
        F.avg("own").alias("distortion"),
    )


def pca(
    df: DataFrame, key: str, features: Sequence[str] = CLUSTER_FEATURES, k: int = 3, partitions: int = MODEL_PARTITIONS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """M4: principal components of the standardised features.

    Returns (scores: key, PC1..PCk; loadings: component + one column per
    feature; ratios: component, explained_variance_ratio). Each component's
    sign is fixed so its largest absolute loading is positive.
    """
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import vector_to_array

    spark = df.sparkSession
    clean = cut_lineage(clean_features(df, key, features))
    vec = _vectors(solver_input(standardise(clean, features), key, partitions), features)
    model = PCA(k=k, inputCol="features", outputCol="__pc").fit(vec)
    pc = model.pc.toArray()  # features x k
    signs = []
    for j in range(k):
        col = pc[:, j]
        idx = max(range(len(col)), key=lambda i: abs(col[i]))
        signs.append(-1.0 if col[idx] < 0 else 1.0)
    arr = vector_to_array("__pc")
    scores = model.transform(vec).select(
        key, *[(arr[j] * F.lit(signs[j])).alias(f"PC{j + 1}") for j in range(k)]
    )
    loadings = spark.createDataFrame(
        [(f"PC{j + 1}", *[float(pc[i, j] * signs[j]) for i in range(len(features))]) for j in range(k)],
        "component string, " + ", ".join(f"{f} double" for f in features),
    )
    ratios = spark.createDataFrame(
        [(f"PC{j + 1}", float(v)) for j, v in enumerate(model.explainedVariance.toArray())],
        "component string, explained_variance_ratio double",
    )
    return scores, loadings, ratios


def scores_with_clusters(scores: DataFrame, clusters: DataFrame, key: str) -> DataFrame:
    """M5: PCA scores of clustered keys only."""
    return scores.join(clusters, on=[key], how="inner")


def profile_clusters(
    df: DataFrame, clusters: DataFrame, key: str, columns: Sequence[str] = PROFILE_COLUMNS, scale: int = 3
) -> tuple[DataFrame, DataFrame]:
    """M6: per-cluster means (+-inf ignored, rounded half-even), average ranks, key count.

    Returns (means: Cluster, columns..., LGA_count; ranks: Cluster, <column>_rank...).
    The rank window runs over the k cluster rows only.
    """
    rows = df.select(key, *[finite_or_null(c).alias(c) for c in columns]).join(clusters, on=[key], how="inner")
    rows = rows.where(F.col("Cluster").isNotNull())
    means = rows.groupBy("Cluster").agg(
        *[round_half_even(F.avg(c), scale).alias(c) for c in columns],
        F.count(F.col(key)).alias("LGA_count"),
    )
    ranked = means
    for c in columns:
        ranked = average_rank(ranked, c, f"{c}_rank")
    ranks = ranked.select("Cluster", *[f"{c}_rank" for c in columns])
    return means, ranks


def segment_metrics(
    residential: DataFrame, business: DataFrame, res_clusters: DataFrame, bus_clusters: DataFrame, key: str = "Lga"
) -> DataFrame:
    """Each type's metrics with its own cluster label, labelled by type and stacked.

    (The original merged the business metrics with the residential labels;
    pass ``bus_clusters=res_clusters`` to reproduce that.)
    """
    return label_and_union(
        {"RESIDENTIAL": lookup(residential, res_clusters, key), "BUSINESS": lookup(business, bus_clusters, key)}
    )
