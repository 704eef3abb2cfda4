"""uptake: regional technology-adoption analytics on Spark.

Every public function takes and returns Spark DataFrames. Heavy work stays in
Spark SQL expressions, joins, aggregates, windows and Spark ML; the driver only
ever receives bounded results (one-row statistics, model parameters, k x
feature tables).

Sub-packages
------------
functions  column expressions (safe ratio, guarded log, header clean-up ...)
sources    readers and writers (CSV drops, indicators, crosswalk, sinks) and
           the stand-in views built from the TPC-H-like test tables
operators  generic relational building blocks (filters, joins, aggregates,
           windows, statistics, nearest match, bootstrap)
plans      the domain compositions: star schema, KPIs, quality checks,
           segmentation and causal contrasts
"""

from uptake.session import build_session, ensure_checkpoint_dir  # noqa: F401

__all__ = ["build_session", "ensure_checkpoint_dir"]
