"""Nearest match (J9) against brute force, ties and caliper; bootstrap invariance."""

import random

from pyspark.sql import functions as F

from uptake.operators.matching import match_nearest
from uptake.operators.resample import bootstrap_means, dense_index


def brute(rows, h):
    t = [(k, s) for k, tr, s in rows if tr]
    c = [(k, s) for k, tr, s in rows if not tr]
    out = {}
    for tk, ts in t:
        best = min(c, key=lambda kc: (abs(ts - kc[1]), kc[0]))
        d = abs(ts - best[1])
        if d < h:
            out[tk] = (best[0], d)
    return out


def test_ties_prefer_lower_key_and_caliper_is_strict(spark):
    # exactly representable scores: distances are exact
    rows = [(1, True, 0.5), (11, False, 0.25), (10, False, 0.75), (2, True, 2.0), (12, False, 2.5)]
    df = spark.createDataFrame(rows, "key bigint, treated boolean, score double")
    got = {r.target_key: r.control_key for r in match_nearest(df, "key", "treated", "score", caliper=0.5).collect()}
    assert got[1] == 10  # equal distance 0.25 on both sides -> lower key
    assert 2 not in got  # distance equal to the caliper -> no match


def test_against_brute_force_with_many_ties(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.random() < 0.3, round(rnd.random() * 3, 2)) for i in range(3000)]
    df = spark.createDataFrame(rows, "key bigint, treated boolean, score double")
    for h in (0.005, 0.02, 0.3):
        got = {r.target_key: (r.control_key, r.distance) for r in match_nearest(df, "key", "treated", "score", caliper=h).collect()}
        assert got == brute(rows, h)


def test_dense_index_is_contiguous_and_ordered(spark):
    df = spark.range(0, 5000, 3).withColumnRenamed("id", "k").repartition(7)
    idx = dense_index(df, "k", "j").orderBy("k").collect()
    assert [r.j for r in idx] == list(range(len(idx)))


def test_bootstrap_does_not_depend_on_partitioning(spark):
    df = spark.range(200).select(F.col("id").alias("k"), (F.col("id") % 13 - 6).cast("double").alias("v"))
    a, _ = bootstrap_means(df.repartition(3), "v", "k", n_boot=50)
    b, _ = bootstrap_means(df.repartition(11), "v", "k", n_boot=50)
    ra = sorted((r.replicate, r.mean) for r in a.collect())
    rb = sorted((r.replicate, r.mean) for r in b.collect())
    assert ra == rb


def test_one_scheme_at_any_size(spark):
    """The draws of a larger input are of the same kind: the method is the caller's, never the size's."""
    import inspect

    import pytest

    from uptake.operators.matching import match_nearest
    from uptake.operators.resample import bootstrap_means, bootstrap_summary, hash_draw

    assert inspect.signature(bootstrap_summary).parameters["method"].default == "multinomial"
    for n in (50, 120_000):  # the second lies beyond the former switch at 2,000 replicates
        df = spark.range(n).selectExpr("id AS k", "CAST(id AS DOUBLE) AS v")
        means, m = bootstrap_means(df, "v", "k", n_boot=2)
        want = spark.range(2 * n).select((F.col("id") / n).cast("int").alias("r"), hash_draw(42, (F.col("id") / n).cast("int"), F.col("id") % n, n).alias("j"))
        got = {r["replicate"]: r["mean"] for r in means.collect()}
        assert m == n and got == {r["r"]: r["m"] for r in want.groupBy("r").agg(F.avg(F.col("j").cast("double")).alias("m")).collect()}
    with pytest.raises(ValueError):
        bootstrap_summary(df, "v", "k", method="auto")
    empty = spark.createDataFrame([], "k long, t boolean, s double")
    assert match_nearest(empty, "k", "t", "s", caliper=0.1).count() == 0


def test_histogram_leaves_out_infinite_values(spark):
    from uptake.operators.aggregates import histogram

    df = spark.createDataFrame([(1.0,), (2.0,), (float("inf"),), (float("-inf"),), (float("nan"),), (None,)], "v double")
    assert [(r.bin, r.n) for r in histogram(df, "v", 5).orderBy("bin").collect()] == [(1, 1), (5, 1)]


def test_poisson_bootstrap_agrees_with_multinomial(spark):
    from uptake.operators.resample import bootstrap_means_poisson, bootstrap_summary

    df = spark.range(3000).select(F.col("id").alias("k"), ((F.col("id") * 7919) % 1000 / 100.0).alias("v"))
    m = bootstrap_summary(df, "v", "k", n_boot=400, method="multinomial").first()
    p = bootstrap_summary(df, "v", "k", n_boot=400, method="poisson").first()
    assert m.att == p.att and m.n_pairs == p.n_pairs == 3000
    width_m, width_p = m.ci_upper - m.ci_lower, p.ci_upper - p.ci_lower
    assert abs(width_p - width_m) / width_m < 0.25
    assert m.ci_lower < m.att < m.ci_upper and p.ci_lower < p.att < p.ci_upper
    a = sorted((r.replicate, r.mean) for r in bootstrap_means_poisson(df.repartition(2), "v", "k", 50).collect())
    b = sorted((r.replicate, r.mean) for r in bootstrap_means_poisson(df.repartition(9), "v", "k", 50).collect())
    assert [x[0] for x in a] == [x[0] for x in b]
    assert all(abs(x[1] - y[1]) < 1e-9 for x, y in zip(a, b))


def test_keys_of_text(spark):
    rows = [("t1", True, 0.5), ("c2", False, 0.25), ("c1", False, 0.75)]
    df = spark.createDataFrame(rows, "key string, treated boolean, score double")
    got = match_nearest(df, "key", "treated", "score", caliper=0.5)
    assert [(r.target_key, r.control_key) for r in got.collect()] == [("t1", "c1")]
    none = match_nearest(df.limit(0), "key", "treated", "score", caliper=0.5)
    assert none.count() == 0 and none.schema.simpleString() == got.schema.simpleString()


def test_draws_in_tasks_are_the_hash_draws(spark):
    """Same numbers as the column expression, where positions and replicates gain digits, too."""
    import hashlib

    from uptake.operators.draws import hash_draws
    from uptake.operators.resample import hash_draw

    for seed, replicate, low, high, n in [(42, 0, 0, 1, 1), (42, 99, 5, 20_011, 20_011), (-7, 1999, 99_998, 100_003, 180_001), (2**62, 10**6, 10**9 - 2, 10**9 + 2, 10**9 + 7)]:
        got = hash_draws(seed, replicate, low, high, n).tolist()
        assert got == [int(hashlib.md5(f"{seed}:{replicate}:{i}".encode()).hexdigest()[:15], 16) % n for i in range(low, high)]
        if high - low < 100:
            assert got == [r.j for r in spark.range(low, high, 1, 1).select(hash_draw(seed, F.lit(replicate), F.col("id"), n).alias("j")).collect()]


def test_bootstrap_moves_packed_draws_not_rows(spark, monkeypatch):
    """Several blocks, chunks and parts, NULL values drawn and skipped; the shuffle has a row per replicate, chunk and block."""
    import math

    from uptake.operators import resample

    for name, size in (("DRAW_BLOCK", 64), ("DRAW_CHUNK", 100), ("DRAW_REPLICATES", 3)):
        monkeypatch.setattr(resample, name, size)
    n, n_boot = 333, 8
    held = [None if i % 7 == 0 else float(i * i % 101) for i in range(n)]
    df = spark.createDataFrame(list(enumerate(held)), "k int, v double").repartition(5)
    rows = resample.block_rows(spark, n, n_boot, 42)
    assert rows.count() <= n_boot * 4 * 6 and rows.agg(F.sum(F.length("at"))).first()[0] == 2 * n * n_boot
    means, m = resample.bootstrap_means(df, "v", "k", n_boot)
    drawn = spark.range(n * n_boot).select((F.col("id") / n).cast("int").alias("b"), (F.col("id") % n).alias("i")).select("b", resample.hash_draw(42, F.col("b"), F.col("i"), n).alias("j")).collect()
    want = {b: [held[r.j] for r in drawn if r.b == b and held[r.j] is not None] for b in range(n_boot)}
    assert m == n and {r.replicate: r.mean for r in means.collect()} == {b: sum(x) / len(x) for b, x in want.items()}
    # all NULL: no mean; NaN stays NaN
    none = spark.createDataFrame([(1, None), (2, None)], "k int, v double")
    assert [r.mean for r in resample.bootstrap_means(none, "v", "k", 3)[0].collect()] == [None] * 3
    assert all(math.isnan(r.mean) for r in resample.bootstrap_means(spark.createDataFrame([(1, float("nan"))], "k int, v double"), "v", "k", 3)[0].collect())
