"""Star schema: region dimension (K1), fact by region (K2) and indicator dimensions.

One Spark plan covers dimension and fact; nothing is staged in between
unless the caller writes a table (see ``sources.sinks``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.operators.aggregates import pivot_grouped, pivot_max
from uptake.operators.relational import class_by_membership, filter_equal, group_max_rows

# Measure codes of the statistical-office indicator tables.
POPULATION_MEASURES = {
    "TotalPopulation": "ERP_P_20",
    "PopulationDensity": "ERP_21",
    "MedianAge": "ERP_23",
    "MedianEquivalisedHouseholdIncome": "EQUIV_2",
    "Certificate": "SCHOOL_7",
    "AdvDiploma": "SCHOOL_6",
    "BachelorDegree": "SCHOOL_5",
    "GraduateDiploma": "SCHOOL_4",
    "Postgraduate": "SCHOOL_3",
}
ECONOMIC_TOTAL = ("TotalBusinesses", "CABEE_5")
ECONOMIC_GROUPS = {
    "PrimaryIndustry": ("CABEE_19", "CABEE_28"),
    "SecondaryIndustry": ("CABEE_21", "CABEE_23", "CABEE_27"),
    "TertiaryIndustry": (
        "CABEE_17", "CABEE_18", "CABEE_20", "CABEE_22", "CABEE_24", "CABEE_25", "CABEE_26",
        "CABEE_30", "CABEE_32", "CABEE_33", "CABEE_34", "CABEE_36", "CABEE_37",
    ),
    "QuaternaryIndustry": ("CABEE_31",),
    "SmallBusinesses": ("CABEE_42", "CABEE_43"),
    "MediumBusinesses": ("CABEE_44", "CABEE_45"),
    "LargeBusinesses": ("CABEE_46", "CABEE_47"),
}
# Dwelling structure code of the total, remoteness classes
# counted as urban.
DWELLING_TOTAL_CODE = "_T"
URBAN_CLASSES = (1, 2)

INSTALLATION_MEASURES = (
    ("TotalCapacity", "TotalCapacity"),
    ("BatteryCapacity", "BatteryCapacity"),
    ("SolarCapacity", "SolarCapacity"),
    ("OtherCapacity", "OtherCapacity"),
    ("TotalDerConnections", "TotalDerConnections"),
    ("BatteryConnections", "BatteryConnections"),
    ("SolarConnections", "SolarConnections"),
    ("OtherConnections", "OtherConnections"),
)
FACT_MEASURES = tuple(out for out, _ in INSTALLATION_MEASURES)


# ------------------------------------------------------------ dimensions


def data_items(indicators: DataFrame) -> DataFrame:
    """A1: ``Dim_DataItem`` = distinct (DataItem, Measure)."""
    return indicators.select("DataItem", "Measure").distinct()


def postcode_states(installations: DataFrame) -> DataFrame:
    """A1: distinct (Postcode, State) of the installations."""
    return installations.select("Postcode", "State").distinct()


def remoteness_argmax(remoteness: DataFrame) -> DataFrame:
    """Per postcode the class rows with the largest class area; ties kept."""
    return group_max_rows(remoteness, "Postcode", "MMM_Area")


def remoteness_class(remoteness: DataFrame, urban_classes=URBAN_CLASSES) -> DataFrame:
    """J1 + P5: (Postcode, Area, MMM_Area, Region_Type) for the dominant class rows."""
    top = remoteness_argmax(remoteness)
    return top.select(
        "Postcode",
        "Area",
        "MMM_Area",
        class_by_membership("MMM_Class", urban_classes).alias("Region_Type"),
    )


def dim_region(
    installations: DataFrame,
    crosswalk: DataFrame,
    remoteness: DataFrame,
    region_names: DataFrame,
) -> DataFrame:
    """K1: ``Dim_Region``, one row per (postcode, state, region, class row); not unique on Postcode.

    J2: crosswalk LEFT JOIN classified postcodes (explicit projection, the
    crosswalk's Postcode wins). J3: distinct (Postcode, State) of the
    installations LEFT JOIN that, DISTINCT, then LEFT JOIN distinct
    (Lga, Region) names. Repeated rows (a postcode in several regions, tied
    class areas, a region with two names) are kept: they define the fan-out
    of the fact join.

    The DISTINCT is taken on each table before the joins: tables without
    repeats, joined on Postcode, give rows without repeats. So the fan-out
    passes through its task row by row, and no task keeps its share of it.
    The names, too, meet the crosswalk before the fan-out.
    """
    classes = remoteness_class(remoteness).distinct()
    # a crosswalk row without a region matches no name: a second key, by which
    # such rows differ, spreads them instead of sending all to one task
    spread = F.when(F.col("Lga").isNull(), F.xxhash64("Postcode")).otherwise(F.lit(0).cast("bigint"))
    # (0 on the names' side, in a form that the optimizer does not fold out of the join)
    names = region_names.select("Lga", "Region").distinct().withColumn("__spread", F.pmod(F.xxhash64("Lga"), F.lit(1)))
    links = crosswalk.select("Lga", "Postcode").distinct().withColumn("__spread", spread)
    mapped = links.join(names, on=["Lga", "__spread"], how="left").join(classes, on=["Postcode"], how="left")
    return postcode_states(installations).join(mapped, on=["Postcode"], how="left").select(
        "Postcode",
        "State",
        "Lga",
        "Region",
        F.col("Area").alias("Postcode_Area"),
        F.col("MMM_Area").alias("Region_Type_Area"),
        "Region_Type",
    )


def population_wide(indicators: DataFrame, measures: Mapping[str, str] = POPULATION_MEASURES) -> DataFrame:
    """A3: ``Dim_Population`` = long -> wide with MAX per measure, NULL where absent."""
    return pivot_max(indicators, ["Lga", "Year"], "Measure", "ObsValue", measures)


def economic_wide(
    indicators: DataFrame,
    groups: Mapping[str, Sequence[str]] = ECONOMIC_GROUPS,
    total: tuple[str, str] = ECONOMIC_TOTAL,
    default: float | None = 0.0,
) -> DataFrame:
    """A4: ``Dim_Economic`` = grouped long -> wide, ``ELSE 0`` by default."""
    return pivot_grouped(
        indicators, ["Lga", "Year"], "Measure", "ObsValue", groups, maxima={total[0]: total[1]}, default=default
    )


def dwelling_total(raw_dwelling: DataFrame, total_code: str = DWELLING_TOTAL_CODE) -> DataFrame:
    """``Dim_Dwelling`` = total dwelling rows only (predicate pushed to the scan)."""
    return filter_equal(raw_dwelling, "Type", total_code).select(
        "Lga", "Year", F.col("ObsValue").alias("TotalDwelling")
    )


# ------------------------------------------------------------ fact


def preaggregate_installations(installations: DataFrame) -> DataFrame:
    """Sum raw drop rows to one row per (Postcode, Year, Type) before the fan-out join.

    The sums commute with the join (each region receives the full amount of
    each row), so aggregating first gives the same result while the join and
    its shuffle see at most years x types rows per postcode: a postcode that
    holds a third of all raw rows is collapsed by the map-side partial
    aggregate before any shuffle.
    """
    return installations.groupBy("Postcode", "Year", "Type").agg(
        *[F.sum(src).alias(out) for out, src in INSTALLATION_MEASURES]
    )


def fact_by_region(installations: DataFrame, region_map: DataFrame) -> DataFrame:
    """K2 = J4 + A2: ``Fact_Derr``, eight sums by (Lga, Year, Type).

    Installations LEFT JOIN the many-to-many postcode -> region map: every
    matching region row receives the full amount (fan-out kept on purpose);
    postcodes without a region end up under a NULL Lga.
    """
    pre = preaggregate_installations(installations)
    links = region_map.select("Postcode", "Lga")
    joined = pre.join(links, on=["Postcode"], how="left")
    return joined.groupBy("Lga", "Year", "Type").agg(*[F.sum(m).alias(m) for m in FACT_MEASURES])


def fanout_audit(installations: DataFrame, region_map: DataFrame) -> DataFrame:
    """J4 audit: per installation postcode, region rows matched and capacity before / after fan-out."""
    per_postcode = installations.groupBy("Postcode").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("TotalCapacity").alias("capacity_in")
    )
    links = region_map.groupBy("Postcode").agg(F.count(F.lit(1)).alias("n_regions"))
    out = per_postcode.join(links, on=["Postcode"], how="left").fillna(0, subset=["n_regions"])
    return out.select(
        "Postcode",
        "n_rows",
        "n_regions",
        "capacity_in",
        (F.col("capacity_in").cast("double") * F.greatest(F.col("n_regions"), F.lit(1))).alias("capacity_out"),
    )


def fact_totals(fact: DataFrame) -> DataFrame:
    """Per (Year, Type): regions and the fact sums over all regions (NULL Lga included)."""
    return fact.groupBy("Year", "Type").agg(
        F.count(F.lit(1)).alias("n_regions"), *[F.sum(m).alias(m) for m in FACT_MEASURES]
    )
