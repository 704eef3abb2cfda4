"""The five runs a user of the original scripts and notebooks performs, as Spark jobs.

1. ``run_ingest``        raw files -> staging tables (S1-S9)
2. ``run_star_schema``   staging -> dimension and fact tables (K1, K2, A1, A3, A4, P1, S10, S11)
3. ``run_kpis``          star -> residential and business panels and metrics (K3-K9, S13)
4. ``run_segmentation``  metrics -> clusters, PCA, profiles, labelled metrics (M1-M6, K10, S15, S16)
5. ``run_contrasts``     star -> rural and income contrasts (K11-K13, M7-M13)

Each step writes its tables as Parquet under ``out`` (a shared folder on a
cluster) and returns them as DataFrames read back from there, so a later
step starts from materialised tables, not from the whole lineage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uptake.operators.relational import keep_latest
from uptake.plans import causal, kpi, segment, star
from uptake.sources import readers, sinks


def _save(spark: SparkSession, tables: dict[str, DataFrame], out: str, partition: dict | None = None) -> dict[str, DataFrame]:
    saved = {}
    for name, df in tables.items():
        path = f"{out.rstrip('/')}/{name}"
        sinks.write_parquet(df, path, (partition or {}).get(name, ()))
        saved[name] = sinks.read_parquet(spark, path)
    return saved


def run_ingest(
    spark: SparkSession,
    drops: str,
    indicator_files: Sequence[str],
    dwelling_file: str,
    crosswalk_file: str,
    remoteness_file: str,
    out: str,
) -> dict[str, DataFrame]:
    """Read and clean the five raw inputs; write the staging tables."""
    tables = {
        "raw_installations": readers.read_drops(spark, drops),
        "raw_indicators": readers.read_indicators(spark, list(indicator_files)),
        "raw_dwelling": readers.read_dwellings(spark, dwelling_file),
        "crosswalk": readers.read_crosswalk(spark, crosswalk_file),
        "remoteness": readers.read_remoteness(spark, remoteness_file),
    }
    return _save(spark, tables, out)


def run_star_schema(
    spark: SparkSession,
    staging: dict[str, DataFrame],
    out: str,
    population_measures=star.POPULATION_MEASURES,
    economic_groups=star.ECONOMIC_GROUPS,
    economic_total=star.ECONOMIC_TOTAL,
) -> dict[str, DataFrame]:
    """Dimension and fact tables; the fact is partitioned by year."""
    inst = staging["raw_installations"].select(
        "Postcode",
        "State",
        F.col("NmiBusRes").alias("Type"),
        "Year",
        F.col("InstalledDerCapacity").alias("TotalCapacity"),
        "BatteryCapacity",
        "SolarCapacity",
        F.col("InstalledOtherderCapacity").alias("OtherCapacity"),
        F.col("DerConnections").alias("TotalDerConnections"),
        "BatteryConnections",
        "SolarConnections",
        "OtherConnections",
    )
    ind = staging["raw_indicators"].withColumnRenamed("TimePeriod", "Year")
    names = ind.select("Lga", "Region").distinct()
    dwell = staging["raw_dwelling"].select(
        "Type", F.col("LGA_2021").alias("Lga"), F.col("TIME_PERIOD").alias("Year"), F.col("OBS_VALUE").alias("ObsValue")
    )
    dim_region = star.dim_region(inst, staging["crosswalk"], staging["remoteness"], names)
    dims = _save(
        spark,
        {
            "dim_data_item": star.data_items(ind),
            "dim_region": dim_region,
            "dim_population": star.population_wide(ind, population_measures),
            "dim_economic": star.economic_wide(ind, economic_groups, economic_total),
            "dim_dwelling": star.dwelling_total(dwell),
        },
        out,
    )
    # the fact reads the written region dimension, as the original does
    fact = _save(spark, {"fact": star.fact_by_region(inst, dims["dim_region"])}, out, {"fact": ["Year"]})
    return {**dims, **fact}


def run_kpis(
    spark: SparkSession, star_tables: dict[str, DataFrame], out: str, exclude_years: Sequence[int] = ()
) -> dict[str, DataFrame]:
    """Repair, fill, panels and the KPI tables of both customer types."""
    clean = kpi.clean_fact(star_tables["fact"])
    filled = kpi.filled_population(star_tables["dim_population"], star_tables["dim_dwelling"])
    res = kpi.residential_panel(clean, filled, exclude_years)
    bus = kpi.business_panel(clean, star_tables["dim_economic"], exclude_years)
    panels = _save(spark, {"res_panel": res, "bus_panel": bus}, out)
    metrics = {
        "res_metrics": kpi.residential_metrics(panels["res_panel"]),
        "bus_metrics": kpi.business_metrics(panels["bus_panel"]),
    }
    return {**panels, **_save(spark, metrics, out)}


def run_segmentation(spark: SparkSession, kpis: dict[str, DataFrame], out: str) -> dict[str, DataFrame]:
    """Clusters per type (latest year), PCA, profiles, and the labelled metrics table."""
    res_latest = keep_latest(kpis["res_metrics"], "Year")
    bus_latest = keep_latest(kpis["bus_metrics"], "Year")
    res_clusters = segment.cluster(res_latest, "Lga")
    bus_clusters = segment.cluster(bus_latest, "Lga")
    res_scores, res_loadings, res_ratios = segment.pca(res_latest, "Lga")
    bus_scores, bus_loadings, bus_ratios = segment.pca(bus_latest, "Lga")
    res_means, res_ranks = segment.profile_clusters(res_latest, res_clusters, "Lga")
    bus_means, bus_ranks = segment.profile_clusters(bus_latest, bus_clusters, "Lga")
    sinks.write_report(res_means, res_ranks, f"{out.rstrip('/')}/res_segment_report")
    sinks.write_report(bus_means, bus_ranks, f"{out.rstrip('/')}/bus_segment_report")
    tables = {
        "res_clusters": res_clusters,
        "bus_clusters": bus_clusters,
        "res_pca_scores": res_scores,
        "res_pca_loadings": res_loadings,
        "res_pca_ratios": res_ratios,
        "bus_pca_scores": bus_scores,
        "bus_pca_loadings": bus_loadings,
        "bus_pca_ratios": bus_ratios,
        "res_elbow": segment.elbow(res_latest, "Lga", segment.CLUSTER_FEATURES),
        "bus_elbow": segment.elbow(bus_latest, "Lga", segment.CLUSTER_FEATURES),
        "res_profile": res_means,
        "bus_profile": bus_means,
        "metrics": segment.segment_metrics(kpis["res_metrics"], kpis["bus_metrics"], res_clusters, bus_clusters),
    }
    return _save(spark, tables, out)


def run_contrasts(
    spark: SparkSession, star_tables: dict[str, DataFrame], out: str, n_boot: int = causal.N_BOOT
) -> dict[str, DataFrame]:
    """The rural/urban contrast on business solar capacity and the income contrast on residential."""
    rural = causal.rurality(star_tables["dim_region"])
    units = causal.region_covariates(star_tables["dim_population"], star_tables["dim_economic"], rural)
    fact = star_tables["fact"]
    area = causal.contrast(
        units, "Lga", "Rural", list(causal.EDUCATION), causal.outcome(fact, "BUSINESS", "SolarCapacity"),
        "SolarCapacity", n_boot,
    )
    trimmed = causal.trim_tails(units, causal.INCOME)
    trimmed = trimmed.withColumn(causal.INCOME, F.col("treated")).drop("treated")
    income = causal.contrast(
        trimmed, "Lga", causal.INCOME, list(causal.EDUCATION) + ["Rural"],
        causal.outcome(fact, "RESIDENTIAL", "SolarCapacity"), "SolarCapacity", n_boot,
    )
    tables = {}
    for label, parts in (("area", area), ("income", income)):
        for name in ("pairs", "balance", "att", "matched_share"):
            tables[f"{label}_{name}"] = parts[name]
    return _save(spark, tables, out)
