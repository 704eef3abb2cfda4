"""Data-quality checks and repairs.

Every check is one aggregate pass or one join; results are small tables
(one row per column, per bin, per region) that a report or a test reads.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.operators.aggregates import (
    correlation_long,
    discrepancy,
    histogram,
    histograms,
    keys_with_n_values,
    null_profile,
    share_of,
    table_counts,
)
from uptake.operators.relational import rows_of_keys_with, unmatched_keys

# Sector and size columns of the economic dimension, the
# tolerance of the parts-versus-total check.
SECTOR_COLUMNS = ("PrimaryIndustry", "SecondaryIndustry", "TertiaryIndustry", "QuaternaryIndustry")
SIZE_COLUMNS = ("SmallBusinesses", "MediumBusinesses", "LargeBusinesses")
TOTAL_COLUMN = "TotalBusinesses"
TOLERANCE = 0.05


def flagged_rows(fact: DataFrame, label: str, keys: Sequence[str] = ("Lga", "Year")) -> DataFrame:
    """Every fact row of a (region, year) that has a row typed ``label``."""
    return rows_of_keys_with(fact, F.col("Type") == label, list(keys))


def type_completeness(fact: DataFrame, label: str, n_types: int = 3) -> DataFrame:
    """Share of flagged (region, year) groups holding exactly ``n_types`` type rows.

    Groups with a NULL region are left out, as pandas ``groupby`` drops them.
    """
    rows = flagged_rows(fact, label).where(F.col("Lga").isNotNull())
    return keys_with_n_values(rows, ["Lga", "Year"], "Type", n_types)


def discrepancies(economy: DataFrame) -> DataFrame:
    """Per (region, year) the sector and size discrepancies against the total."""
    return economy.select(
        "Lga",
        "Year",
        discrepancy(SECTOR_COLUMNS, TOTAL_COLUMN).alias("sector_discrepancy"),
        discrepancy(SIZE_COLUMNS, TOTAL_COLUMN).alias("size_discrepancy"),
    )


def share_within(economy: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Share of rows whose discrepancy is strictly inside the tolerance."""
    d = discrepancies(economy)
    return share_of(
        d,
        {
            "share_sector": F.abs("sector_discrepancy") < tolerance,
            "share_size": F.abs("size_discrepancy") < tolerance,
        },
    )


def discrepancy_histogram(economy: DataFrame, column: str = "sector_discrepancy", bins: int = 50) -> DataFrame:
    """A15 on a discrepancy column."""
    return histogram(discrepancies(economy), column, bins)


def panel_histograms(panel: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """A15 on every numeric column of a panel."""
    return histograms(panel, columns, bins)


def reconcile_totals(economy: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Drop regions with any discrepancy beyond the tolerance, fill NULL parts with 0 elsewhere.

    "At most" the tolerance is kept. A NULL discrepancy (0/0) does not flag.
    """
    d = discrepancies(economy)
    bad = d.where(
        (F.abs("sector_discrepancy") > tolerance) | (F.abs("size_discrepancy") > tolerance)
    ).select("Lga").distinct()
    kept = economy.join(bad, on=["Lga"], how="left_anti")
    return kept.na.fill(0.0, subset=[TOTAL_COLUMN, *SECTOR_COLUMNS, *SIZE_COLUMNS])


def unmatched_postcodes(installations: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Installation postcodes missing from the crosswalk."""
    return unmatched_keys(installations, crosswalk, "Postcode")


def region_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and distinct regions per table."""
    return table_counts(tables, "Lga")


def profile_nulls(df: DataFrame) -> DataFrame:
    """A12 on any table."""
    return null_profile(df)


def log_correlation(panel: DataFrame, columns: Sequence[str], log_columns: Sequence[str]) -> DataFrame:
    """Correlation matrix (long) of ``columns`` after ln of ``log_columns``."""
    return correlation_long(panel, columns, log_columns)
