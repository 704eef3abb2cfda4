"""Operators on hot groups, NULL keys, many files, failing writes: results and where the rows go."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from uptake.operators import moments, resample, selection
from uptake.operators.aggregates import correlation_long, group_median, histogram, histograms
from uptake.plans import causal, segment, star
from uptake.sources import readers, sinks

# ------------------------------------------------------------ co-moments


def test_pair_moments_merge_like_numpy(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(5000, 4)) * [1, 1e-3, 1e5, 1] + [0, 1e6, -1e9, 3]
    x[r.random(x.shape) < 0.3] = np.nan
    total = None
    for part in np.array_split(x, 7):
        total = moments._merge(total, moments.moments(part))
    for i in range(4):
        for j in range(4):
            both = x[~np.isnan(x[:, i]) & ~np.isnan(x[:, j])][:, [i, j]]
            assert total[0][i, j] == len(both)
            cov = np.cov(both.T, ddof=0) * len(both)
            np.testing.assert_allclose(total[5][i, j], cov[0, 1], rtol=1e-6, atol=1e-6 * np.sqrt(cov[0, 0] * cov[1, 1]))
            # column 1 has a spread of 1e-9 of its mean, so doubles hold about seven digits of it
            np.testing.assert_allclose([total[1][i, j], total[3][i, j]], [both[:, 0].mean(), cov[0, 0]], rtol=1e-7)


def test_correlation_edges(spark):
    inf = float("inf")
    rows = [(1.0, 2.0, 5.0, 0.1, None), (2.0, 4.5, 5.0, 0.1, 1.0), (3.0, None, 5.0, 0.1, None), (4.0, 7.0, 5.0, 0.1, None), (None, -inf, None, 0.1, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(3)
    got = {(r.x, r.y): r.r for r in correlation_long(df, ["a", "b", "c", "d", "e"]).collect()}
    assert len(got) == 25
    full = np.corrcoef([1.0, 2.0, 4.0], [2.0, 4.5, 7.0])[0, 1]
    assert abs(got["a", "b"] - full) < 1e-12 and got["a", "b"] == got["b", "a"] and got["a", "a"] == 1.0
    assert np.isnan(got["b", "b"]) and np.isnan(got["b", "d"])  # -inf in a complete row of the pair
    assert got["c", "a"] is None and got["d", "d"] is None and got["e", "a"] is None and got["e", "e"] is None
    assert {r.r for r in correlation_long(df.limit(0), ["a", "b"]).collect()} == {None}


def test_correlation_reads_a_row_once(spark):
    plan = correlation_long(spark.range(10).select(*[F.col("id").cast("double").alias(f"c{i}") for i in range(18)]), [f"c{i}" for i in range(18)])
    text = plan._jdf.queryExecution().executedPlan().toString()
    # the only row makers lie behind the moments, whose rows are tasks x pairs
    assert "MapInArrow" in text and text.index("MapInArrow") > text.rindex("Generate")


# ------------------------------------------------------------ histograms


def test_histograms_equal_the_single_column_one(spark):
    rows = [(float(i % 37), -1.5, None, float("nan") if i % 5 else 2.0 * i, float("inf") if i == 3 else float(i * i)) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, constant double, nothing double, gaps double, wide double").repartition(4)
    got = histograms(df, df.columns, 7).collect()
    for c in df.columns:
        one = {(r.bin, r.lower, r.upper, r.n) for r in histogram(df, c, 7).collect()}
        many = [(r.bin, r.lower, r.upper, r.n) for r in got if r.column_name == c]
        assert {r for r in many if r[3]} == one
        assert len(many) == {"constant": 1, "nothing": 0}.get(c, 7)
    assert histograms(df.limit(0), ["a"], 3).count() == 0


# ------------------------------------------------------------ medians by selected ranks


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 1.0])
def test_group_quantile(spark, q):
    r = np.random.default_rng(4)
    keys = np.where(r.random(4000) < 0.4, 0, r.integers(0, 30, 4000))
    rows = [(None if k == 7 else int(k), None if r.random() < 0.1 else float(r.integers(0, 50)), float(r.normal()) if k != 9 else None) for k in keys]
    df = spark.createDataFrame(rows, "k int, x double, y double").repartition(6)
    got = {x.k: (x.x, x.y) for x in selection.group_quantile(df, "k", ["x", "y"], q).collect()}
    assert len(got) == len({x[0] for x in rows})
    for k in got:
        for place, value in zip((1, 2), got[k]):
            held = [x[place] for x in rows if x[0] == k and x[place] is not None]
            assert value is None if not held else abs(value - np.quantile(held, q)) < 1e-9


def test_median_of_a_hot_group_is_spread_over_tasks(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("k"), (F.col("id") * 7919 % 30_011).cast("double").alias("v"))
    rows = selection.sorted_counts(df, ["k"], ["v"], partitions=8)
    hot = {r.part: r.n for r in rows.where("k0 = 'hot'").groupBy("part").agg(F.sum("n").alias("n")).collect()}
    assert sum(hot.values()) == 10_000 and len(hot) >= 3 and max(hot.values()) < 6000
    same = group_median(df, "k", ["v"], large_groups=True).exceptAll(group_median(df, "k", ["v"]))
    assert same.count() == 0
    # one value a third of the rows is one row with a count
    one = spark.range(9000).select(F.lit(1).alias("k"), F.when(F.col("id") % 2 == 0, F.lit(5.0)).otherwise(F.col("id").cast("double")).alias("v"))
    assert selection.sorted_counts(one, ["k"], ["v"]).where("value = 5").count() == 1
    assert selection.group_quantile(df.limit(0), "k", ["v"]).count() == 0


# ------------------------------------------------------------ file headers


def test_header_lines_start_no_scan(spark, tmp_path):
    """One header per file, of any size, compressed or with a space in its name, and no Spark task to read them."""
    import gzip

    for k in range(5):
        with open(tmp_path / f"f {k}.csv", "w") as f:
            f.write(f"h{k},é\n" + ("x" * 99 + ",1\n") * (20_000 if k == 3 else k))
    with gzip.open(tmp_path / "g.csv.gz", "wt") as f:
        f.write("packed,b\n1,2\n")
    open(tmp_path / "empty.csv", "w").close()
    spark.sparkContext.setJobGroup("headers", "headers")
    got = readers.header_lines(spark, str(tmp_path))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {os.path.basename(k): v for k, v in got.items()} == {**{f"f {k}.csv": f"h{k},é" for k in range(5)}, "g.csv.gz": "packed,b"}
    assert not jobs
    read = readers._read_strings(spark, [f for f in got if "f 4" in f], ["h4", "é"])
    assert read.count() == 4


# ------------------------------------------------------------ replaced tables


@pytest.fixture
def database(spark):
    import uuid

    name = f"swap_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{sinks.shared_folder(spark, name)}'")
    return name


def test_a_failing_write_leaves_the_old_tables(spark, database):
    a, b = f"{database}.a", f"{database}.b"
    sinks.write_tables({a: spark.range(3), b: spark.range(4)})
    broken = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_tables({a: spark.range(10), b: broken})
    assert (spark.table(a).count(), spark.table(b).count()) == (3, 4)
    with pytest.raises(Exception, match="lost"):
        sinks.materialise(broken, b, persist=True)
    assert spark.table(b).count() == 4
    assert sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary) == ["a", "b"]


def test_a_table_may_be_replaced_from_itself(spark, database):
    a = f"{database}.a"
    sinks.write_tables({a: spark.range(5)})
    sinks.write_tables({a: spark.table(a).where("id > 2").withColumn("more", F.lit("x"))})
    assert sorted(r.id for r in spark.table(a).collect()) == [3, 4] and spark.table(a).columns == ["id", "more"]
    with pytest.raises(Exception):
        sinks.write_tables({a: spark.range(1)}, refresh=False)


# ------------------------------------------------------------ solvers


def blobs(spark, n, centres=4):
    r = np.random.default_rng(8)
    rows = [(i, *(r.normal(size=2) * 0.2 + [4.0 * (i % centres), 3.0 * (i % 2)]).tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "key int, x double, y double").repartition(3)


def test_elbow_keeps_a_row_for_more_clusters_than_rows(spark):
    got = {r.k: r.distortion for r in segment.elbow(blobs(spark, 5), "key", ["x", "y"], ks=range(1, 8)).collect()}
    assert sorted(got) == list(range(1, 8)) and got[6] is None and got[7] is None
    assert all(got[k] is not None for k in range(1, 6))
    assert segment.elbow(blobs(spark, 5).limit(0), "key", ["x", "y"], ks=[1, 2]).count() == 0


@pytest.mark.parametrize("partitions", [4, 16])
def test_cluster_certificate(spark, partitions):
    df = blobs(spark, 200)
    labels = segment.cluster(df, "key", ["x", "y"], partitions=partitions)
    good = segment.cluster_certificate(df, labels, "key", ["x", "y"]).first()
    assert (good.n_rows, good.n_clusters, good.n_misplaced) == (200, 4, 0)
    wrong = labels.withColumn("Cluster", F.when(F.col("key") % 10 == 0, (F.col("Cluster") + 1) % 4).otherwise(F.col("Cluster")))
    assert segment.cluster_certificate(df, wrong, "key", ["x", "y"]).first().n_misplaced == 20
    curve = segment.elbow(df, "key", ["x", "y"], ks=[4], partitions=partitions).first().distortion
    assert abs(curve - good.distortion) < 1e-6
    assert segment.cluster_certificate(df.limit(0), labels, "key", ["x", "y"]).first().n_rows == 0


def test_propensity_certificate(spark):
    r = np.random.default_rng(6)
    rows = [(i, bool(r.random() < 1 / (1 + np.exp(-a))), float(a), float(r.normal())) for i, a in enumerate(r.normal(size=300))]
    df = spark.createDataFrame(rows, "key int, t boolean, a double, b double")
    scored, names, model = causal.propensity(df, "key", "t", partitions=16)
    w = model.coefficients.toArray().tolist()
    assert all(abs(r.gradient) < 1e-5 for r in causal.propensity_certificate(scored, "t", names, w).collect())
    off = scored.withColumn("propensity_score", F.col("propensity_score") * 0.9)
    assert any(abs(r.gradient) > 1e-3 for r in causal.propensity_certificate(off, "t", names, w).collect())


# ------------------------------------------------------------ bootstrap by binomial splits


def test_block_draws_share_one_multinomial():
    n, size, b = 1000, 64, 300
    blocks = np.array([resample.block_draws(n, k, b, 42, size) for k in range(-(-n // size))])
    assert (blocks.sum(0) == n).all()
    expected = np.array([min(size, n - k * size) for k in range(len(blocks))])
    assert (np.abs(blocks.mean(1) - expected) < 5 * np.sqrt(expected / b)).all()
    variance = expected * (1 - expected / n)
    assert (np.abs(blocks.var(1) / variance - 1) < 0.5).all()


def test_split_bootstrap_has_the_interval_of_the_exact_draws(spark, monkeypatch):
    monkeypatch.setattr(resample, "SPLIT_BLOCK", 64)
    r = np.random.default_rng(9)
    rows = [(i, None if i % 50 == 0 else float(x)) for i, x in enumerate(r.normal(0.3, 1.0, 700))]
    df = spark.createDataFrame(rows, "key int, v double").repartition(5)
    exact, split = (resample.bootstrap_summary(df, "v", "key", 1000, method=m).first() for m in ("multinomial", "split"))
    again = resample.bootstrap_summary(df.repartition(2), "v", "key", 1000, method="split").first()
    # the same draws in any layout; sums of doubles differ in their last digits
    np.testing.assert_allclose(split, again, rtol=1e-9)
    assert split.n_pairs == exact.n_pairs and abs(split.att - exact.att) < 1e-12
    sd = (exact.ci_upper - exact.ci_lower) / 3.92
    assert abs(split.ci_lower - exact.ci_lower) < 0.4 * sd and abs(split.ci_upper - exact.ci_upper) < 0.4 * sd
    assert resample.bootstrap_summary(df.limit(0), "v", "key", 10, method="split").first().n_pairs == 0


# ------------------------------------------------------------ rows without a region


def test_rows_without_a_region_are_spread_over_the_name_join(spark):
    """A third of the postcodes are in no region: same rows, and no task gets them all."""
    installations = spark.range(3000).select((F.col("id") % 1500).cast("bigint").alias("Postcode"), F.lit("S").alias("State"))
    crosswalk = spark.range(1000).select((F.col("id") % 40).alias("Lga"), F.concat(F.lit("r"), F.col("id") % 40).alias("Region"), F.col("id").alias("Postcode"))
    remoteness = spark.range(10).select(F.col("id").alias("Postcode"), F.lit(1.0).alias("Area"), F.lit("1").alias("MMM_Class"), F.lit(1.0).alias("MMM_Area"))
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = [spark.conf.get(n) for n in names]
    try:
        spark.conf.set(names[0], "-1")
        spark.conf.set(names[1], "false")
        dim = star.dim_region(installations, crosswalk, remoteness, crosswalk)
        rows = dim.withColumn("task", F.spark_partition_id()).collect()
    finally:
        for n, x in zip(names, before):
            spark.conf.set(n, x)
    alone = [r for r in rows if r.Lga is None]
    assert len(rows) == 1500 and len(alone) == 500 and all(r.Region is None for r in alone)
    assert all(r.Region == f"r{r.Lga}" for r in rows if r.Lga is not None)
    per_task = [sum(r.task == t for r in alone) for t in {r.task for r in rows}]
    assert max(per_task) < 150 and sum(n > 0 for n in per_task) >= 6


def _nodes(plan):
    yield plan
    for i in range(plan.children().size()):
        yield from _nodes(plan.children().apply(i))


def test_the_fan_out_of_the_region_dimension_is_not_aggregated(spark):
    """Repeats leave before the joins: no task holds the joined rows, and odd rows give the rows of the plain definition."""
    installations = spark.createDataFrame([(p, s) for p in (1, 2, 3, 4, None) for s in ("A", "B", "A", None)], "Postcode bigint, State string")
    crosswalk = [(10, "r", 1), (10, "r", 1), (10, "q", 1), (11, None, 1), (None, "n", 1), (None, None, 2), (12, "t", 2), (12, "t", 9), (10, "r", None)]
    links = spark.createDataFrame(crosswalk, "Lga bigint, Region string, Postcode bigint")
    kinds = [(1, 5.0, 1, 2.0), (1, 5.0, 2, 2.0), (1, -0.0, 4, 2.0), (1, 0.0, 4, 2.0), (1, 5.0, 3, 1.0), (2, None, 3, 0.0), (2, None, 3, -0.0), (3, 1.0, 1, 1.0), (4, 1.0, 1, None)]
    remoteness = spark.createDataFrame(kinds, "Postcode bigint, Area double, MMM_Class int, MMM_Area double")
    dim = star.dim_region(installations, links, remoteness, links)

    top = {p: max((m for q, _, _, m in kinds if q == p and m is not None), default=None) for p in (1, 2, 3, 4)}
    plain = lambda x: None if x is None else x + 0.0  # noqa: E731 (-0.0 counts as 0.0)
    classes = {(p, plain(a), plain(m), "Urban" if c in (1, 2) else "Rural") for p, a, c, m in kinds if m is not None and m == top[p]}
    joined = set()
    for p, s in {(p, s) for p in (1, 2, 3, 4, None) for s in ("A", "B", None)}:
        of_place = {lga for lga, _, q in crosswalk if p is not None and q == p}
        joined |= {(p, s, lga, *c[1:]) for lga in of_place for c in classes if c[0] == p}
        joined |= {(p, s, lga, None, None, None) for lga in of_place if not any(c[0] == p for c in classes)} or ({(p, s, None, None, None, None)} if not of_place else set())
    expect = []
    for p, s, lga, area, size, kind in joined:
        for name in {r for g, r, _ in crosswalk if lga is not None and g == lga} or {None}:
            expect.append((p, s, lga, name, area, size, kind))
    assert sorted(map(str, (tuple(r) for r in dim.collect()))) == sorted(map(str, expect))

    inner = [n for n in _nodes(dim._jdf.queryExecution().optimizedPlan()) if n.nodeName() == "Aggregate"]
    joins = [n for n in _nodes(dim._jdf.queryExecution().optimizedPlan()) if n.nodeName() == "Join"]
    assert len(joins) == 4 and all(sum(m.nodeName() == "Join" for m in _nodes(n)) <= 1 for n in inner)
