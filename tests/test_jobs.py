"""The five runs end to end on raw files derived from the smallest test scale."""

from pyspark.sql import functions as F

from uptake.plans import jobs
from uptake.sources import sinks
from uptake.sources import standin as si

SF = "/root/testdata/sf0.001"


def test_five_runs(spark, tmp_path):
    v = si.StandIn(spark, SF)
    raw = tmp_path / "raw"
    drops = si.write_drop_files(v["drops"], str(raw / "drops"))
    ind = v["indicators"].select(
        F.col("DataItem").alias("Data Item"), F.col("Measure").alias("MEASURE"), F.col("Lga").alias("LGA_2021"),
        F.concat(F.lit("Region "), F.col("Lga").cast("string")).alias("Region"), F.col("Year").alias("TIME_PERIOD"),
        F.col("ObsValue").alias("OBS_VALUE"), F.lit("AUD").alias("Unit of Measure"),
    )
    sinks.write_csv(ind, str(raw / "indicators"))
    dw = v["raw_dwelling"].select(
        F.col("Type").alias("DWTSTRD"), F.col("Lga").alias("REGION"), F.lit("x").alias("Region"),
        F.col("Year").alias("TIME_PERIOD"), F.col("ObsValue").alias("OBS_VALUE"),
    )
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        sinks.write_csv(dw, str(raw / "dwellings"))
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")
    sinks.write_csv(v["crosswalk"], str(raw / "crosswalk"))
    sinks.write_csv(
        v["remoteness"].select(F.lit(0).alias("Unnamed: 0"), "Postcode", "Area", "MMM_Class", "MMM_Area"),
        str(raw / "remoteness"),
    )
    out = str(tmp_path / "out")
    staging = jobs.run_ingest(
        spark, drops, [str(raw / "indicators")], str(raw / "dwellings"), str(raw / "crosswalk"), str(raw / "remoteness"), out
    )
    assert staging["raw_installations"].count() > 0
    star_t = jobs.run_star_schema(
        spark, staging, out, si.STANDIN_POPULATION_MEASURES, si.STANDIN_ECONOMIC_GROUPS, si.STANDIN_ECONOMIC_TOTAL
    )
    # fan-out: every installation amount reaches the fact once per region-dimension row of its postcode
    fanout = star_t["dim_region"].groupBy("Postcode").agg(F.count(F.lit(1)).alias("m"))
    expected = (
        staging["raw_installations"].join(fanout, "Postcode", "left")
        .agg(F.sum(F.col("InstalledDerCapacity") * F.coalesce("m", F.lit(1)))).first()[0]
    )
    assert star_t["fact"].agg(F.sum("TotalCapacity")).first()[0] == expected
    kpis = jobs.run_kpis(spark, star_t, out, si.STANDIN_EXCLUDE_YEARS)
    assert kpis["res_metrics"].count() == kpis["res_panel"].count() > 0
    seg = jobs.run_segmentation(spark, kpis, out)
    assert seg["metrics"].count() == kpis["res_metrics"].count() + kpis["bus_metrics"].count()
    con = jobs.run_contrasts(spark, star_t, out, n_boot=50)
    assert con["area_att"].count() == 1 and con["income_att"].count() == 1
