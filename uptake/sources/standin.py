"""Stand-in domain tables derived from the TPC-H-like test tables.

The domain inputs (installation drops, indicator tables, crosswalk,
remoteness classes) are not available, so every query runs on views that
Spark derives from the given parquet tables. Their work grows with the
tables: nothing here is sampled or capped.

Each view is one SELECT written in the SQL subset that Spark and DuckDB
share. Spark runs it with ``spark.sql(text, lineitem=df, ...)``; the oracle
runs the same text as a CTE (``with_views``), so both engines see identical
fixtures and any difference comes from the operator under test.

Mapping (postcode = part, region = supplier, indicator region = customer):

installations   lineitem x part at month grain, like monthly drop files:
                Postcode=l_partkey, State=p_brand, Type from l_returnflag
                (R residential, A business, N unclassified), Year of ship date;
                capacity from l_extendedprice (solar: status O, battery: F,
                other: price*discount) in whole units (cents, cents x
                percent) held as doubles: every partial sum is an integer
                below 2^53, so sums are exact in any order and both engines
                see identical amounts on the fast primitive path;
                connections from l_quantity (integral doubles, exact), other
                connections = rows with zero discount
crosswalk       distinct (l_suppkey, s_name, l_partkey): many-to-many
crosswalk_partial  crosswalk restricted to parts of size <= 45, so some
                installation postcodes have no region (unmatched-key audit)
remoteness      distinct (part, size, class, class area) per line number;
                classes 1-4 (half urban), class areas tie within a postcode
indicators      one long row per order: Measure=o_orderpriority,
                Lga=o_custkey, Year of order date, ObsValue=o_totalprice
raw_dwelling    line counts per (supplier, year, line number); '_T' = total
economy         wide business counts per (supplier, year); parts do not
                always add up to the total
scored          customer: treated = BUILDING segment, score = acctbal/10000
features        per supplier: average quantity, price, discount, tax, count
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# name -> (dependencies, SELECT text with {dependency} placeholders)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "installations": (("lineitem", "part"), """
SELECT l.l_partkey AS Postcode,
       p.p_brand AS State,
       CASE l.l_returnflag WHEN 'R' THEN 'RESIDENTIAL'
                           WHEN 'A' THEN 'BUSINESS'
                           ELSE 'NoClassification' END AS Type,
       CAST(year(l.l_shipdate) AS INT) AS Year,
       SUM(CAST(FLOOR(l.l_extendedprice * 100 + 0.5) AS DOUBLE)) AS TotalCapacity,
       SUM(CASE WHEN l.l_linestatus = 'O' THEN CAST(FLOOR(l.l_extendedprice * 100 + 0.5) AS DOUBLE) ELSE 0.0 END) AS SolarCapacity,
       SUM(CASE WHEN l.l_linestatus = 'F' THEN CAST(FLOOR(l.l_extendedprice * 100 + 0.5) AS DOUBLE) ELSE 0.0 END) AS BatteryCapacity,
       SUM(CAST(FLOOR(l.l_extendedprice * 100 + 0.5) AS DOUBLE) * CAST(FLOOR(l.l_discount * 100 + 0.5) AS DOUBLE)) AS OtherCapacity,
       SUM(l.l_quantity) AS TotalDerConnections,
       SUM(CASE WHEN l.l_linestatus = 'O' THEN l.l_quantity ELSE 0.0 END) AS SolarConnections,
       SUM(CASE WHEN l.l_linestatus = 'F' THEN l.l_quantity ELSE 0.0 END) AS BatteryConnections,
       CAST(COUNT(CASE WHEN l.l_discount = 0 THEN 1 END) AS DOUBLE) AS OtherConnections
FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey
GROUP BY l.l_partkey, p.p_brand, l.l_returnflag, year(l.l_shipdate), month(l.l_shipdate)
"""),
    "crosswalk": (("lineitem", "supplier"), """
SELECT DISTINCT l.l_suppkey AS Lga, s.s_name AS Region, l.l_partkey AS Postcode
FROM {lineitem} l JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
"""),
    "crosswalk_partial": (("crosswalk", "part"), """
SELECT c.Lga, c.Region, c.Postcode
FROM {crosswalk} c JOIN {part} p ON c.Postcode = p.p_partkey
WHERE p.p_size <= 45
"""),
    "remoteness": (("lineitem", "part"), """
SELECT DISTINCT l.l_partkey AS Postcode,
       CAST(p.p_size AS DOUBLE) AS Area,
       1 + (l.l_linenumber + p.p_size) % 4 AS MMM_Class,
       CAST(p.p_size * (1 + (l.l_linenumber * p.p_size) % 3) AS DOUBLE) AS MMM_Area
FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey
"""),
    "indicators": (("orders",), """
SELECT substr(o.o_orderpriority, 3) AS DataItem,
       o.o_orderpriority AS Measure,
       o.o_custkey AS Lga,
       CAST(year(o.o_orderdate) AS INT) AS Year,
       o.o_totalprice AS ObsValue
FROM {orders} o
"""),
    "raw_dwelling": (("lineitem",), """
SELECT CASE WHEN l.l_linenumber = 1 THEN '_T'
            ELSE concat('L', CAST(l.l_linenumber AS STRING)) END AS Type,
       l.l_suppkey AS Lga,
       CAST(year(l.l_shipdate) AS INT) AS Year,
       CAST(COUNT(*) AS DOUBLE) AS ObsValue
FROM {lineitem} l
GROUP BY l.l_linenumber, l.l_suppkey, year(l.l_shipdate)
"""),
    "economy": (("lineitem",), """
SELECT l.l_suppkey AS Lga,
       CAST(year(l.l_shipdate) AS INT) AS Year,
       CAST(COUNT(*) AS DOUBLE) AS TotalBusinesses,
       CAST(COUNT(CASE WHEN l.l_linenumber IN (1, 2) THEN 1 END) AS DOUBLE) AS PrimaryIndustry,
       CAST(COUNT(CASE WHEN l.l_linenumber IN (3, 4) THEN 1 END) AS DOUBLE) AS SecondaryIndustry,
       CAST(COUNT(CASE WHEN l.l_linenumber IN (5, 6) THEN 1 END) AS DOUBLE) AS TertiaryIndustry,
       CAST(COUNT(CASE WHEN l.l_linenumber = 7 AND l.l_returnflag <> 'N' THEN 1 END) AS DOUBLE) AS QuaternaryIndustry,
       CAST(COUNT(CASE WHEN l.l_quantity < 20 THEN 1 END) AS DOUBLE) AS SmallBusinesses,
       CAST(COUNT(CASE WHEN l.l_quantity >= 20 AND l.l_quantity < 40 THEN 1 END) AS DOUBLE) AS MediumBusinesses,
       CAST(COUNT(CASE WHEN l.l_quantity >= 40 AND l.l_discount > 0 THEN 1 END) AS DOUBLE) AS LargeBusinesses
FROM {lineitem} l
GROUP BY l.l_suppkey, year(l.l_shipdate)
"""),
    "scored": (("customer",), """
SELECT c.c_custkey AS key,
       c.c_mktsegment = 'BUILDING' AS treated,
       c.c_acctbal / 10000 AS score,
       c.c_acctbal AS acctbal,
       CAST(c.c_nationkey AS DOUBLE) AS nation
FROM {customer} c
"""),
    "order_value": (("orders",), """
SELECT o.o_custkey AS key, median(o.o_totalprice) AS outcome
FROM {orders} o
GROUP BY o.o_custkey
"""),
    "features": (("lineitem",), """
SELECT l.l_suppkey AS key,
       AVG(l.l_quantity) AS f1,
       AVG(l.l_extendedprice) AS f2,
       AVG(l.l_discount) AS f3,
       AVG(l.l_tax) AS f4,
       CAST(COUNT(*) AS DOUBLE) AS f5
FROM {lineitem} l
GROUP BY l.l_suppkey
"""),
}


# Views with gaps, so that filters on rare labels, missing regions and zero
# totals have rows to keep and rows to drop.
VIEWS["installations_gaps"] = (("installations",), """
SELECT Postcode, State, Year, TotalCapacity, SolarCapacity, BatteryCapacity, OtherCapacity,
       TotalDerConnections, SolarConnections, BatteryConnections, OtherConnections,
       CASE WHEN Type = 'NoClassification' AND Postcode % 499 <> 0 THEN 'RESIDENTIAL'
            WHEN Type = 'BUSINESS' AND Postcode % 487 = 0 THEN '(blank)'
            ELSE Type END AS Type
FROM {installations}
""")
VIEWS["economy_gaps"] = (("economy",), """
SELECT Lga, Year,
       CASE WHEN (Lga + Year) % 5 = 0 THEN 0.0 ELSE TotalBusinesses END AS TotalBusinesses,
       CASE WHEN (Lga + Year) % 10 = 0 THEN 0.0 ELSE PrimaryIndustry END AS PrimaryIndustry,
       CASE WHEN (Lga + Year) % 10 = 0 THEN 0.0 WHEN Lga % 7 = 0 THEN NULL ELSE SecondaryIndustry END AS SecondaryIndustry,
       CASE WHEN (Lga + Year) % 10 = 0 THEN 0.0 ELSE TertiaryIndustry END AS TertiaryIndustry,
       CASE WHEN (Lga + Year) % 10 = 0 THEN 0.0 ELSE QuaternaryIndustry END AS QuaternaryIndustry,
       SmallBusinesses, MediumBusinesses, LargeBusinesses
FROM {economy}
""")


# The monthly drop files: one row per (postcode, state, type, year, month)
# plus, per (state, type, year, month), an aggregate row whose postcode is
# '<' and the number of postcodes it covers (dropped on ingest, S3).
_DROP_MEASURES = (
    ("DerConnections", "SUM(l.l_quantity)"),
    ("InstalledDerCapacity", "SUM(CAST(FLOOR(l.l_extendedprice * 100 + 0.5) AS DOUBLE))"),
    ("SolarConnections", "SUM(CASE WHEN l.l_linestatus = 'O' THEN l.l_quantity ELSE 0.0 END)"),
    ("SolarCapacity", "SUM(CASE WHEN l.l_linestatus = 'O' THEN CAST(FLOOR(l.l_extendedprice * 100 + 0.5) AS DOUBLE) ELSE 0.0 END)"),
    ("BatteryConnections", "SUM(CASE WHEN l.l_linestatus = 'F' THEN l.l_quantity ELSE 0.0 END)"),
    ("BatteryCapacity", "SUM(CASE WHEN l.l_linestatus = 'F' THEN CAST(FLOOR(l.l_extendedprice * 100 + 0.5) AS DOUBLE) ELSE 0.0 END)"),
    ("BatteryStorage", "SUM(CAST(FLOOR(l.l_tax * 100 + 0.5) AS DOUBLE))"),
    ("OtherConnections", "CAST(COUNT(CASE WHEN l.l_discount = 0 THEN 1 END) AS DOUBLE)"),
    ("InstalledOtherderCapacity", "SUM(CAST(FLOOR(l.l_extendedprice * 100 + 0.5) AS DOUBLE) * CAST(FLOOR(l.l_discount * 100 + 0.5) AS DOUBLE))"),
)
_DROP_TYPE = (
    "CASE l.l_returnflag WHEN 'R' THEN 'RESIDENTIAL' WHEN 'A' THEN 'BUSINESS' ELSE 'NoClassification' END"
)
_DROP_MEASURE_SQL = ", ".join(f"{e} AS {n}" for n, e in _DROP_MEASURES)
VIEWS["drops"] = (("lineitem", "part"), f"""
SELECT p.p_brand AS State, CAST(l.l_partkey AS STRING) AS Postcode, {_DROP_TYPE} AS NmiBusRes,
       CAST(year(l.l_shipdate) AS INT) AS Year, CAST(month(l.l_shipdate) AS INT) AS Month,
       {_DROP_MEASURE_SQL}
FROM {{lineitem}} l JOIN {{part}} p ON l.l_partkey = p.p_partkey
GROUP BY l.l_partkey, p.p_brand, l.l_returnflag, year(l.l_shipdate), month(l.l_shipdate)
UNION ALL
SELECT p.p_brand AS State, concat('<', CAST(COUNT(DISTINCT l.l_partkey) AS STRING)) AS Postcode,
       {_DROP_TYPE} AS NmiBusRes,
       CAST(year(l.l_shipdate) AS INT) AS Year, CAST(month(l.l_shipdate) AS INT) AS Month,
       {_DROP_MEASURE_SQL}
FROM {{lineitem}} l JOIN {{part}} p ON l.l_partkey = p.p_partkey
GROUP BY p.p_brand, l.l_returnflag, year(l.l_shipdate), month(l.l_shipdate)
""")

# Raw header of the stand-in drop files: names chosen so that the header
# clean-up (S2) maps them to the kept column names.
DROP_RAW_HEADERS = {
    "State": "State",
    "Postcode": "Post_Code",
    "NmiBusRes": "NMI_BUS_RES",
    "DerConnections": "Sum of DER_Connections",
    "InstalledDerCapacity": "Sum of Installed_DER_Capacity_kVA",
    "SolarConnections": "Sum of Num_Solar_Connections",
    "SolarCapacity": "Sum of Solar_Capacity_kVA",
    "BatteryConnections": "Sum of Num_Battery_Connections",
    "BatteryCapacity": "Sum of Battery_Capacity_kVA",
    "BatteryStorage": "Sum of Battery_Storage_kVAh",
    "OtherConnections": "Sum of Other_Connections",
    "InstalledOtherderCapacity": "Sum of Installed_OtherDER_Capacity_kVA",
}


def write_drop_files(drops: DataFrame, folder: str) -> str:
    """Write the drop view as CSV files, one folder per period ``YYYY_MM`` with raw headers."""
    from pyspark.sql import functions as F

    out = drops.select(
        *[F.col(c).cast("string").alias(DROP_RAW_HEADERS[c]) for c in DROP_RAW_HEADERS],
        F.format_string("%04d_%02d", F.col("Year"), F.col("Month")).alias("period"),
    )
    out.write.mode("overwrite").partitionBy("period").option("header", True).csv(folder)
    return folder


# Fixed values for the stand-in pivots: indicator measure codes per output
# column. The stand-in has five codes (order priorities); the real data use
# the statistical-office codes listed in plans/star.py.
STANDIN_POPULATION_MEASURES = {
    "TotalPopulation": "1-URGENT",
    "PopulationDensity": "2-HIGH",
    "MedianAge": "3-MEDIUM",
    "MedianEquivalisedHouseholdIncome": "4-NOT SPECIFIED",
    "Certificate": "5-LOW",
    "AdvDiploma": "1-URGENT",
    "BachelorDegree": "2-HIGH",
    "GraduateDiploma": "3-MEDIUM",
    "Postgraduate": "4-NOT SPECIFIED",
}
STANDIN_ECONOMIC_TOTAL = ("TotalBusinesses", "5-LOW")
STANDIN_ECONOMIC_GROUPS = {
    "PrimaryIndustry": ("1-URGENT", "2-HIGH"),
    "SecondaryIndustry": ("3-MEDIUM",),
    "TertiaryIndustry": ("4-NOT SPECIFIED",),
    "QuaternaryIndustry": ("5-LOW",),
    "SmallBusinesses": ("1-URGENT",),
    "MediumBusinesses": ("2-HIGH", "3-MEDIUM"),
    "LargeBusinesses": ("4-NOT SPECIFIED", "5-LOW"),
}
# The last stand-in year is incomplete, like the last real one.
STANDIN_EXCLUDE_YEARS = (2001,)


def _order(names) -> list[str]:
    """Dependencies first, each view once."""
    seen: list[str] = []

    def visit(n):
        if n in BASE_TABLES or n in seen:
            return
        for d in VIEWS[n][0]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


class StandIn:
    """Lazily built stand-in views for one session and one scale directory.

    The views are lazy DataFrames (plans, not data); ``shared`` reuses them
    across queries of the same session so their SQL is parsed and analysed
    once. Every action still reads the parquet files.
    """

    _shared: dict[tuple[str, str, str], "StandIn"] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    @classmethod
    def shared(cls, spark: SparkSession, sf_dir: str) -> "StandIn":
        app = spark.sparkContext.applicationId
        for old in [k for k in cls._shared if k[0] != app]:
            del cls._shared[old]
        k = (app, spark._jsparkSession.sessionUUID(), sf_dir.rstrip("/"))
        if k not in cls._shared:
            cls._shared[k] = cls(spark, sf_dir)
        return cls._shared[k]

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in BASE_TABLES:
                df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                deps, text = VIEWS[name]
                df = self.spark.sql(text, **{d: self.table(d) for d in deps})
            self._cache[name] = df
        return self._cache[name]

    __getitem__ = table


def with_views(body: str, *names: str) -> str:
    """Oracle text: the stand-in views as CTEs in front of ``body``."""
    ordered = _order(names)
    if not ordered:
        return body
    ctes = []
    for n in ordered:
        deps, text = VIEWS[n]
        ctes.append(f"{n} AS ({text.format(**{d: d for d in deps}).strip()})")
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(ctes) + ",\n" + stripped[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
