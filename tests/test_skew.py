"""Correctness under skew: one postcode holds a third of all rows and maps to every region."""

from collections import defaultdict

from pyspark.sql import functions as F

from uptake.operators.relational import group_max_rows
from uptake.plans.star import FACT_MEASURES, fact_by_region

MEASURES = list(FACT_MEASURES)


def test_fact_with_hot_postcode(spark):
    n = 30000
    rows = []
    for i in range(n):
        postcode = 1 if i % 3 == 0 else 2 + i % 500  # postcode 1: a third of all rows
        rows.append((postcode, 2020 + i % 4, "RESIDENTIAL" if i % 2 else "BUSINESS", *[float(i % 7 + j) for j in range(8)]))
    schema = "Postcode bigint, Year int, Type string, " + ", ".join(f"{m} double" for m in MEASURES)
    inst = spark.createDataFrame(rows, schema).repartition(8)
    # postcode 1 in every one of 50 regions, the others in one or two
    links = [(r, 1) for r in range(50)] + [(p % 50, p) for p in range(2, 502)] + [((p + 7) % 50, p) for p in range(2, 502, 5)]
    xw = spark.createDataFrame(links, "Lga bigint, Postcode bigint")
    got = {(r.Lga, r.Year, r.Type): r.TotalCapacity for r in fact_by_region(inst, xw).collect()}
    regions = defaultdict(list)
    for lga, p in links:
        regions[p].append(lga)
    expect = defaultdict(float)
    for p, y, t, *vals in rows:
        for lga in regions.get(p, [None]):
            expect[(lga, y, t)] += vals[0]
    assert got == dict(expect)


def test_group_max_with_hot_key(spark):
    df = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000).alias("Postcode"),
        (F.col("id") % 97).cast("double").alias("MMM_Area"),
        F.col("id"),
    )
    got = sorted(r.id for r in group_max_rows(df, "Postcode", "MMM_Area").collect())
    best = {}
    for i in range(60000):
        k = 0 if i % 3 == 0 else i % 1000
        best.setdefault(k, []).append((i % 97, i))
    expect = sorted(i for vals in best.values() for v, i in vals if v == max(x for x, _ in vals))
    assert got == expect
