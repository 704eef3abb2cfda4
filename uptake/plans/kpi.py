"""Data repair, panels and adoption KPIs.

A panel is one row per (region, year) for one customer type. All KPI
columns are column expressions on the panel; growth is a per-region
regression slope attached with a window partitioned by region (a region
holds one row per year, so the window groups stay small whatever the data
volume).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from uptake.functions.arith import safe_ratio
from uptake.operators.aggregates import slope
from uptake.operators.relational import drop_null, exclude_values, filter_equal, null_sentinels
from uptake.operators.windows import fill_forward_back

# Customer types and the sentinel type labels treated as missing.
RESIDENTIAL = "RESIDENTIAL"
BUSINESS = "BUSINESS"
TYPE_SENTINELS = ("(blank)", "NoClassification")

# Technology -> (capacity column, connection column).
TECHNOLOGIES = {
    "Total": ("TotalCapacity", "TotalDerConnections"),
    "Battery": ("BatteryCapacity", "BatteryConnections"),
    "Solar": ("SolarCapacity", "SolarConnections"),
    "Other": ("OtherCapacity", "OtherConnections"),
}

METRIC_COLUMNS = tuple(
    f"{kind}{label}" for label in TECHNOLOGIES for kind in ("Pen", "CPD", "CPC", "Growth")
) + ("BSR",)


def clean_fact(fact: DataFrame, sentinels: Sequence[str] = TYPE_SENTINELS) -> DataFrame:
    """Sentinel types -> NULL, then drop rows with a NULL type or region."""
    return drop_null(null_sentinels(fact, "Type", sentinels), ["Type", "Lga"])


def misaligned_regions(fact: DataFrame, label: str = "NoClassification") -> DataFrame:
    """Regions that carry an unclassified type row."""
    return fact.where(F.col("Type") == label).select("Lga").distinct()


def filled_population(
    population: DataFrame, dwellings: DataFrame | None = None, leak: bool = False
) -> DataFrame:
    """J5 + W1 + W2: population LEFT JOIN dwellings, then fill every column per region by year."""
    df = population
    if dwellings is not None:
        df = df.join(dwellings, on=["Lga", "Year"], how="left")
    cols = [c for c in df.columns if c not in ("Lga", "Year")]
    return fill_forward_back(df, "Lga", "Year", cols, leak=leak)


def panel(
    fact_clean: DataFrame,
    customer_type: str,
    dimension: DataFrame,
    exclude_years: Sequence[int] = (),
) -> DataFrame:
    """Fact rows of one type (year filter applied) LEFT JOIN a (Lga, Year) dimension."""
    rows = exclude_values(filter_equal(fact_clean, "Type", customer_type), "Year", exclude_years).drop("Type")
    return rows.join(dimension, on=["Lga", "Year"], how="left")


def residential_panel(fact_clean, population_filled, exclude_years=()) -> DataFrame:
    return panel(fact_clean, RESIDENTIAL, population_filled, exclude_years)


def business_panel(fact_clean, economy, exclude_years=()) -> DataFrame:
    return panel(fact_clean, BUSINESS, economy, exclude_years)


# ------------------------------------------------------------ KPIs


def penetration(panel_df: DataFrame, units: str) -> dict:
    """K3: connections per dwelling (or business), per technology."""
    return {f"Pen{t}": safe_ratio(con, units) for t, (_, con) in TECHNOLOGIES.items()}


def capacity_per_unit(panel_df: DataFrame, units: str) -> dict:
    """K4: capacity per dwelling (or business), per technology."""
    return {f"CPD{t}": safe_ratio(cap, units) for t, (cap, _) in TECHNOLOGIES.items()}


def capacity_per_connection(panel_df: DataFrame) -> dict:
    """K5: capacity per connection, per technology."""
    return {f"CPC{t}": safe_ratio(cap, con) for t, (cap, con) in TECHNOLOGIES.items()}


def growth(panel_df: DataFrame, key: str = "Lga", year: str = "Year") -> dict:
    """K6 = A10 + W4: per-region OLS slope of capacity on year, on every row of the region."""
    w = Window.partitionBy(key)
    return {f"Growth{t}": slope(cap, year, w) for t, (cap, _) in TECHNOLOGIES.items()}


def battery_solar_ratio(panel_df: DataFrame) -> dict:
    """K7: battery connections per solar connection."""
    return {"BSR": safe_ratio("BatteryConnections", "SolarConnections")}


def metrics(panel_df: DataFrame, units: str) -> DataFrame:
    """K8 / K9: Year, Lga and the 17 KPI columns of one panel (keyed by its own rows)."""
    exprs = {}
    exprs.update(penetration(panel_df, units))
    exprs.update(capacity_per_unit(panel_df, units))
    exprs.update(capacity_per_connection(panel_df))
    exprs.update(growth(panel_df))
    exprs.update(battery_solar_ratio(panel_df))
    return panel_df.select("Year", "Lga", *[exprs[c].alias(c) for c in METRIC_COLUMNS])


def residential_metrics(panel_df: DataFrame) -> DataFrame:
    """K8: residential KPIs; units are dwellings."""
    return metrics(panel_df, "TotalDwelling")


def business_metrics(panel_df: DataFrame) -> DataFrame:
    """K9: business KPIs; units are businesses; keyed by the business panel itself."""
    return metrics(panel_df, "TotalBusinesses")


def growth_normalised(panel_df: DataFrame, key: str = "Lga", year: str = "Year") -> DataFrame:
    """D3: slope divided by the capacity of the region's first year (zero rule applies)."""
    aggs = []
    for t, (cap, _) in TECHNOLOGIES.items():
        aggs.append(safe_ratio(slope(cap, year), F.min_by(F.col(cap), F.col(year))).alias(f"GrowthNorm{t}"))
    return panel_df.groupBy(key).agg(*aggs)
