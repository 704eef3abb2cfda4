"""Inline edge cases (null, NaN, infinity, ties) for the scalar and small operators."""

import math

from pyspark.sql import functions as F

from uptake.functions.arith import ln_inf, round_half_even, safe_ratio
from uptake.functions.names import normalise_drop_header, normalise_indicator_header
from uptake.operators.aggregates import correlation_long, histogram, slope_per_group
from uptake.operators.relational import class_by_membership, group_max_rows, rows_of_flagged_keys
from uptake.operators.windows import average_rank, fill_forward_back


def test_safe_ratio_zero_rule(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 0.0), (2, 0.0, 0.0), (3, 0.0, 3.0), (4, 2.0, 4.0), (5, None, 1.0), (6, -2.0, 2.0), (7, -1.0, 0.0), (8, None, 0.0)],
        "i int, x double, y double",
    )
    got = [r.r for r in df.orderBy("i").select(safe_ratio("x", "y").alias("r")).collect()]
    assert got[0] == math.inf and got[1] == 0.0 and got[2] == 0.0 and got[3] == 0.5
    assert got[4] is None and got[5] == 0.0 and got[6] == -math.inf and got[7] is None


def test_integer_inputs_are_not_truncated(spark):
    df = spark.createDataFrame([(1, 3)], "x int, y int")
    assert df.select(safe_ratio("x", "y").alias("r")).first().r == 1 / 3


def test_round_half_even(spark):
    assert spark.range(1).select(round_half_even(F.lit(0.0625), 3).alias("r")).first().r == 0.062


def test_log_of_zero_makes_correlation_nan(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 2.0), (2.0, 3.5)], "a double, b double")
    assert df.select(ln_inf("a").alias("l")).first().l == -math.inf
    r = {(x.x, x.y): x.r for x in correlation_long(df, ["a", "b"], ["a"]).collect()}
    assert math.isnan(r[("a", "b")])


def test_constant_column_gives_null_not_error(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "x double, y double")
    r = {(x.x, x.y): x.r for x in correlation_long(df, ["x", "y"]).collect()}
    assert r[("x", "y")] is None and abs(r[("y", "y")] - 1.0) < 1e-12


def test_fill_grouped_and_leak(spark):
    df = spark.createDataFrame(
        [("A", 1, None), ("A", 2, 1.0), ("B", 1, None), ("B", 2, None), ("C", 1, 7.0), ("C", 2, None)],
        "Lga string, Year int, v double",
    )
    grouped = {(r.Lga, r.Year): r.v for r in fill_forward_back(df, "Lga", "Year", ["v"]).collect()}
    assert [grouped[("A", 1)], grouped[("A", 2)]] == [1.0, 1.0]
    assert [grouped[("B", 1)], grouped[("B", 2)]] == [None, None]
    assert [grouped[("C", 1)], grouped[("C", 2)]] == [7.0, 7.0]
    leak = {(r.Lga, r.Year): r.v for r in fill_forward_back(df, "Lga", "Year", ["v"], leak=True).collect()}
    assert [leak[("B", 1)], leak[("B", 2)]] == [7.0, 7.0]
    assert [leak[("A", 1)], leak[("C", 2)]] == [1.0, 7.0]


def test_slope_single_year_and_two_points(spark):
    df = spark.createDataFrame([("a", 2021, 5.0), ("b", 2021, 1.0), ("b", 2022, 3.0)], "Lga string, Year int, y double")
    got = {r.Lga: r.g for r in slope_per_group(df, "Lga", "y", "Year", "g").collect()}
    assert got == {"a": 0.0, "b": 2.0}


def test_average_rank_ties(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 1.0), (2, 3.0)], "Cluster int, m double")
    got = {r.Cluster: r.m_rank for r in average_rank(df, "m", "m_rank").collect()}
    assert got == {0: 1, 1: 1, 2: 3}


def test_group_max_keeps_ties_and_drops_null_maxima(spark):
    df = spark.createDataFrame(
        [(1, "a", 5.0), (1, "b", 5.0), (1, "c", 2.0), (2, "d", None)], "Postcode int, c string, MMM_Area double"
    )
    got = sorted(r.c for r in group_max_rows(df, "Postcode", "MMM_Area").collect())
    assert got == ["a", "b"]


def test_class_membership_numeric_affinity(spark):
    df = spark.createDataFrame([(0, None), (1, "1"), (2, "2"), (3, "5"), (4, "2.0")], "i int, c string")
    got = [r.t for r in df.orderBy("i").select(class_by_membership("c").alias("t")).collect()]
    assert got == ["Rural", "Urban", "Urban", "Rural", "Urban"]


def test_flagged_rows_match_null_keys(spark):
    df = spark.createDataFrame(
        [(None, 2020, "NoClassification"), (None, 2020, "RESIDENTIAL"), (1, 2020, "BUSINESS")],
        "Lga bigint, Year int, Type string",
    )
    flags = df.where(F.col("Type") == "NoClassification")
    assert rows_of_flagged_keys(df, flags, ["Lga", "Year"]).count() == 2


def test_histogram_maximum_in_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4, 5]], "v double")
    bins = {r.bin: r.n for r in histogram(df, "v", 5).collect()}
    assert bins[5] == 2 and sum(bins.values()) == 6


def test_quantile_interpolation(spark):
    from uptake.plans.causal import quantile_cuts

    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    assert abs(quantile_cuts(df, "v", 0.33, 0.67).first().low - 1.99) < 1e-12


def test_rurality_tie_is_urban(spark):
    from uptake.plans.causal import rurality

    df = spark.createDataFrame(
        [(1, "Rural", 2.0), (1, "Urban", 2.0), (2, "Rural", 3.0), (2, "Urban", 1.0), (3, "Urban", 1.0)],
        "Lga bigint, Region_Type string, Region_Type_Area double",
    )
    got = {r.Lga: r.Rural for r in rurality(df).collect()}
    assert got == {1: False, 2: True, 3: False}


def test_header_normalisation():
    assert normalise_drop_header("Sum of Solar_Capacity_kVA") == "SolarCapacity"
    assert normalise_drop_header("Post_Code") == "Postcode"
    assert normalise_drop_header("Sum of Num_Battery_Connections") == "BatteryConnections"
    assert normalise_drop_header("Sum of Battery_Storage_kVAh") == "BatteryStorage"
    assert normalise_drop_header("Sum of Installed_OtherDER_Capacity_kVA") == "InstalledOtherderCapacity"
    assert normalise_indicator_header("Unit of Measure") == "Unit"
    assert normalise_indicator_header("LGA_2021") == "Lga"
    assert normalise_indicator_header("TIME_PERIOD") == "TimePeriod"
    assert normalise_indicator_header("Data Item") == "DataItem"


def test_fanout_gives_full_amount_to_each_region(spark):
    from uptake.plans.star import fact_by_region

    cols = ["TotalCapacity", "BatteryCapacity", "SolarCapacity", "OtherCapacity",
            "TotalDerConnections", "BatteryConnections", "SolarConnections", "OtherConnections"]
    inst = spark.createDataFrame(
        [(3000, "RESIDENTIAL", 2021, *[10.0] * 8)], "Postcode bigint, Type string, Year int, " + ", ".join(f"{c} double" for c in cols)
    )
    xw = spark.createDataFrame([(1, 3000), (2, 3000)], "Lga bigint, Postcode bigint")
    got = {r.Lga: r.TotalCapacity for r in fact_by_region(inst, xw).collect()}
    assert got == {1: 10.0, 2: 10.0}


def test_next_non_null_across_partitions(spark):
    import random

    from uptake.operators.windows import next_non_null

    rnd = random.Random(3)
    rows = [(k, rnd.random() if rnd.random() < 0.05 else None) for k in range(2000)]
    df = spark.createDataFrame(rows, "k bigint, v double")
    got = {r.k: r.next_v for r in next_non_null(df, "k", ["v"]).collect()}
    expect, nxt = {}, None
    for k, v in reversed(rows):
        expect[k] = nxt
        if v is not None:
            nxt = v
    assert got == expect
