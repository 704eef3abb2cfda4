"""Invariants for the rows-only operators (solvers): K-means, PCA, propensity, contrasts."""

import numpy as np
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def test_cluster_labels_every_clean_row(spark):
    from uptake import catalog as c
    from uptake.plans import segment

    v = c.StandIn(spark, SF)
    latest = c.latest_residential(v)
    labels = segment.cluster(latest, "Lga")
    clean = segment.clean_features(latest, "Lga", segment.CLUSTER_FEATURES)
    assert labels.count() == clean.count()
    assert {r.Cluster for r in labels.select("Cluster").distinct().collect()} <= {0, 1, 2, 3}


def test_elbow_is_non_increasing_and_k1_is_total_variance(spark):
    from uptake import catalog as c

    rows = sorted((r.k, r.distortion) for r in c.QUERIES["elbow"](spark, SF).collect())
    assert rows[0][0] == 1 and abs(rows[0][1] - 5.0) < 1e-9
    assert rows[1][1] < rows[0][1]


def test_pca_loadings_orthonormal_and_ratios(spark):
    from uptake import catalog as c
    from uptake.plans import segment

    scores, loadings, ratios = segment.pca(c.latest_residential(c.StandIn(spark, SF)), "Lga")
    m = np.array([[r[f] for f in segment.CLUSTER_FEATURES] for r in loadings.orderBy("component").collect()])
    assert np.allclose(m @ m.T, np.eye(3), atol=1e-8)
    for row in m:
        assert row[np.argmax(np.abs(row))] > 0
    total = sum(r.explained_variance_ratio for r in ratios.collect())
    assert 0 < total <= 1 + 1e-9


def test_propensity_scores_are_probabilities(spark):
    from uptake import catalog as c

    df = c.QUERIES["propensity"](spark, SF)
    lo, hi = df.agg(F.min("propensity_score"), F.max("propensity_score")).first()
    assert 0 <= lo <= hi <= 1


def test_profile_means_match_group_means(spark):
    from uptake import catalog as c

    prof = {r.Cluster: r for r in c.QUERIES["cluster_profile"](spark, SF).collect()}
    assert sum(r.LGA_count for r in prof.values()) == c.StandIn(spark, SF)["features"].count()


def test_distributed_quantiles_match_numpy(spark):
    from uptake.plans import causal

    for values in ([], [3.0], [1.0, 2.0], [5.0, 1.0, 1.0, 9.0, 2.5, None], [float(i * 37 % 101) for i in range(101)]):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        got = causal.quantile_cuts(df, "x").first()
        known = [v for v in values if v is not None]
        want = [np.quantile(known, q) for q in (0.33, 0.67)] if known else [None, None]
        assert got["low"] == want[0] or abs(got["low"] - want[0]) < 1e-12
        assert got["high"] == want[1] or abs(got["high"] - want[1]) < 1e-12


def test_flagged_groups_with_null_keys(spark):
    from uptake.plans.quality import flagged_rows

    rows = [(None, 1, "A"), (None, 1, "B"), (1, 1, "B"), (1, 2, "A"), (1, 2, None), (2, 2, None)]
    df = spark.createDataFrame(rows, "Lga int, Year int, Type string")
    got = sorted(map(str, flagged_rows(df, "A").collect()))
    assert got == sorted(map(str, spark.createDataFrame([rows[i] for i in (0, 1, 3, 4)], df.schema).collect()))
