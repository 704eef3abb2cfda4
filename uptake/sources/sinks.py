"""Writers and table management.

Tables are Spark catalog tables or Parquet directories; a ``refresh`` flag
chooses overwrite or fail-if-exists, as the original drop-then-create switch
did.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uptake.session import ensure_checkpoint_dir


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, refresh: bool = True, persist: bool = False) -> DataFrame:
    """CTAS. ``persist=False`` registers a view (no job); ``True`` writes a managed table."""
    if not persist:
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    write_tables({name: df}, refresh)
    return df.sparkSession.table(name)


def _swap(spark: SparkSession, name: str, staged: str) -> None:
    """Give a staged table the name of the one it replaces; the old one comes back if that fails."""
    if not spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
        return
    old = f"{name}__old_{uuid.uuid4().hex}"
    spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    except Exception:
        spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        raise
    spark.sql(f"DROP TABLE {old}")


def write_tables(tables: Mapping[str, DataFrame], refresh: bool = True) -> None:
    """Replace (or create) several managed tables.

    With ``refresh`` all tables are written under staging names first and
    renamed only when every write has ended: a write that fails leaves all old
    tables as they were, and a table may be replaced by a result read from it.
    Without it an existing table is an error.
    """
    if not refresh:
        for name, df in tables.items():
            df.write.mode("errorifexists").saveAsTable(name)
        return
    staged: dict[str, str] = {}
    spark = None
    try:
        for name, df in tables.items():
            spark = df.sparkSession
            staged[name] = f"{name}__staged_{uuid.uuid4().hex}"
            df.write.mode("errorifexists").saveAsTable(staged[name])
        for name in list(staged):
            _swap(spark, name, staged[name])
            del staged[name]
    finally:
        # what a failure left behind
        for left in staged.values():
            spark.sql(f"DROP TABLE IF EXISTS {left}")


def drop_tables(spark: SparkSession, names: Sequence[str]) -> None:
    """``DROP TABLE IF EXISTS`` for staging tables and views."""
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")
        spark.catalog.dropTempView(n)


def scan(spark: SparkSession, name: str) -> DataFrame:
    """``SELECT *`` of a catalog table or view."""
    return spark.table(name)


def _ordered(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """O1: sort only at the sink. ``orderBy`` is a distributed range sort:
    part files come out in key order, no single task sees all rows."""
    return df.orderBy(*order_by) if order_by else df


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), order_by: Sequence[str] = ()
) -> None:
    """S13 sink: Parquet, overwritten; the fact table is partitioned by year for pruning."""
    w = _ordered(df, order_by).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S13 source."""
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str, order_by: Sequence[str] = ()) -> None:
    """CSV with a header line; no row-index column; optionally sorted (O1)."""
    _ordered(df, order_by).write.mode("overwrite").option("header", True).csv(path)


def write_report(profile: DataFrame, ranks: DataFrame, path: str) -> None:
    """The cluster report as text, one line per cluster and table (k lines each)."""
    def as_lines(df: DataFrame, title: str) -> DataFrame:
        cols = [c for c in df.columns if c != "Cluster"]
        body = F.concat_ws(" ", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in cols])
        return df.select(F.concat(F.lit(f"{title} cluster="), F.col("Cluster").cast("string"), F.lit(" "), body).alias("value"))

    lines = as_lines(profile, "means").unionByName(as_lines(ranks, "ranks"))
    lines.coalesce(1).write.mode("overwrite").text(path)
