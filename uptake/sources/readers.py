"""Readers for the raw inputs.

CSV columns are read as strings (no schema inference pass over the data) and
converted with ``try_cast``, so a dirty value becomes NULL instead of failing
the job. Headers are cleaned in Python on the column names only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uptake.functions.names import normalise_drop_header, normalise_indicator_header

# Strings pandas ``read_csv`` treats as missing by default.
PANDAS_NA_STRINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Installation columns kept after stacking the drops.
DROP_COLUMNS = (
    "State", "Postcode", "NmiBusRes", "DerConnections", "InstalledDerCapacity", "SolarConnections",
    "SolarCapacity", "BatteryConnections", "BatteryCapacity", "BatteryStorage", "OtherConnections",
    "InstalledOtherderCapacity", "Year",
)
DROP_TEXT_COLUMNS = ("State", "NmiBusRes")

# Indicator columns (raw names) and the dwelling columns by
# their raw names with the names given to them.
INDICATOR_COLUMNS = ("Data Item", "MEASURE", "LGA_2021", "Region", "TIME_PERIOD", "OBS_VALUE", "Unit of Measure")
DWELLING_COLUMNS = (
    ("DWTSTRD", "Type"), ("REGION", "LGA_2021"), ("Region", "Region"), ("TIME_PERIOD", "TIME_PERIOD"),
    ("OBS_VALUE", "OBS_VALUE"),
)


def _na_to_null(c: str):
    col = F.col(f"`{c}`")
    return F.when(F.trim(col).isin(list(PANDAS_NA_STRINGS)) | col.isNull(), F.lit(None).cast("string")).otherwise(col)


#: Files whose first lines are read at the same time.
HEADER_READERS = 16


def header_lines(spark: SparkSession, path: str | Sequence[str]) -> dict[str, str]:
    """First line of every file under ``path``; an empty file has none.

    Spark lists the files; the first block of each is opened through Spark's
    file systems and closed after a line, some files at a time, so the bytes
    read do not grow with the size of the files. (A scan cannot stop early in
    each file: a task reads its splits to the end, also where Python takes
    one row of it.)
    """
    from concurrent.futures import ThreadPoolExecutor

    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first(uri: str) -> tuple[str, str | None]:
        file = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
        stream = file.getFileSystem(conf).open(file)
        try:
            codec = codecs.getCodec(file)
            text = codec.createInputStream(stream) if codec else stream
            return file.toString(), jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(text, "UTF-8")).readLine()
        finally:
            stream.close()

    files = spark.read.text([path] if isinstance(path, str) else list(path)).inputFiles()
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        return {file: line for file, line in pool.map(first, files) if line is not None}


def _split_header(line: str) -> list[str]:
    import csv

    return next(csv.reader([line]))


def _read_strings(spark: SparkSession, files: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Read CSV files of one header shape as strings, columns renamed c0..cN by position.

    The schema carries the file's own header names when they are non-empty
    and unique (ignoring case), so Spark's header check agrees with it;
    otherwise (an unnamed index column, REGION next to Region) positional
    names are used from the start.
    """
    usable = all(n.strip() for n in names) and len({n.lower() for n in names}) == len(names)
    fields = list(names) if usable else [f"c{i}" for i in range(len(names))]
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    df = spark.read.option("header", True).option("enforceSchema", True).schema(schema).csv(list(files))
    return df.toDF(*[f"c{i}" for i in range(len(names))])


def read_drops(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A directory of periodic installation drops as one table.

    * S1 year and month come from the file name ``YYYY?MM...``: year = first
      four characters, month = from the sixth on (the extension removed);
      for a directory written by Spark the period is the parent folder name.
    * S2 headers are cleaned with ``normalise_drop_header``.
    * S3 pandas NA strings become NULL; a postcode that is not a number (the
      aggregate rows ``<5``, ``>10``) becomes NULL; rows with a NULL in any
      column of their file are dropped; the postcode is truncated to int.
    * S4 files of every header shape are stacked by name; the 13 columns kept.

    Files are grouped by header line and each shape is read by one CSV scan,
    so a column order that changed between drops is still read correctly.
    """
    headers = header_lines(spark, path)
    by_shape: dict[str, list[str]] = {}
    for f, h in headers.items():
        by_shape.setdefault(h, []).append(f)
    frames = []
    for h, files in sorted(by_shape.items()):
        raw_names = _split_header(h)
        names = [normalise_drop_header(n) for n in raw_names]
        df = _read_strings(spark, files, raw_names)
        df = df.select(*[_na_to_null(f"c{i}").alias(n) for i, n in enumerate(names)])
        df = df.withColumn("Postcode", F.col("Postcode").try_cast("double"))
        df = df.na.drop(how="any")
        fname = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
        parent = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
        stem = F.regexp_replace(fname, r"\.[^.]*$", "")
        period = F.when(stem.rlike(r"^\d{4}"), stem).otherwise(F.regexp_replace(parent, r"^[^=]*=", ""))
        df = df.withColumn("Year", F.substring(period, 1, 4).cast("int")).withColumn(
            "Month", F.substring(period, 6, 100)
        )
        numeric = [n for n in names if n not in DROP_TEXT_COLUMNS and n != "Postcode"]
        df = df.select(
            *[
                F.col(n).cast("int").alias(n)
                if n == "Postcode"
                else (F.col(n).try_cast("double").alias(n) if n in numeric else F.col(n))
                for n in names
            ],
            "Year",
            "Month",
        )
        frames.append(df)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.select(*DROP_COLUMNS)


def read_indicators(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The indicator files, seven columns renamed and stacked.

    ``Data Item`` -> DataItem, ``MEASURE`` -> Measure, ``LGA_2021`` -> Lga,
    ``TIME_PERIOD`` -> TimePeriod, ``OBS_VALUE`` -> ObsValue,
    ``Unit of Measure`` -> Unit.
    """
    frames = []
    for p in paths:
        df = spark.read.option("header", True).csv(p)
        df = df.select(*[F.col(f"`{c}`").alias(normalise_indicator_header(c)) for c in INDICATOR_COLUMNS])
        frames.append(df)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.select(
        "DataItem",
        "Measure",
        F.col("Lga").try_cast("double").cast("bigint").alias("Lga"),
        "Region",
        F.col("TimePeriod").try_cast("int").alias("TimePeriod"),
        F.col("ObsValue").try_cast("double").alias("ObsValue"),
        "Unit",
    )


def _positional(spark: SparkSession, path: str, columns: Callable[[list[str]], list[Column]]) -> DataFrame:
    """Files grouped by their own header, each group read once; ``columns`` maps a header to the columns wanted."""
    shapes: dict[str, list[str]] = {}
    for f, h in sorted(header_lines(spark, path).items()):
        shapes.setdefault(h, []).append(f)
    frames = []
    for h, files in shapes.items():
        raw_names = _split_header(h)
        frames.append(_read_strings(spark, files, raw_names).select(*columns(raw_names)))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def read_dwellings(spark: SparkSession, path: str) -> DataFrame:
    """Dwelling counts; the header holds ``REGION`` and ``Region``, so columns are taken by position."""
    out = _positional(spark, path, lambda raw: [F.col(f"c{raw.index(src)}").alias(dst) for src, dst in DWELLING_COLUMNS])
    return out.select(
        "Type",
        F.col("LGA_2021").try_cast("double").cast("bigint").alias("LGA_2021"),
        "Region",
        F.col("TIME_PERIOD").try_cast("int").alias("TIME_PERIOD"),
        F.col("OBS_VALUE").try_cast("double").alias("OBS_VALUE"),
    )


def read_crosswalk(spark: SparkSession, path: str) -> DataFrame:
    """Region code, region name, postcode by position; codes coerced to nullable integers."""
    df = _positional(spark, path, lambda raw: [F.col(f"c{i}") for i in range(3)])
    return df.select(
        F.col("c0").try_cast("double").cast("bigint").alias("Lga"),
        F.col("c1").alias("Region"),
        F.col("c2").try_cast("double").cast("bigint").alias("Postcode"),
    )


def read_remoteness(spark: SparkSession, path: str) -> DataFrame:
    """Drop the unnamed index column, name the rest by position."""
    c = ["c0", "c1", "c2", "c3"]

    def named(raw: list[str]) -> list[Column]:
        start = 1 if raw and raw[0].strip() in ("", "Unnamed: 0") else 0
        return [F.col(f"c{i + start}").alias(x) for i, x in enumerate(c)]

    df = _positional(spark, path, named)
    return df.select(
        F.col(c[0]).try_cast("double").cast("int").alias("Postcode"),
        F.col(c[1]).try_cast("double").alias("Area"),
        F.col(c[2]).alias("MMM_Class"),
        F.col(c[3]).try_cast("double").alias("MMM_Area"),
    )
