"""Load counters (A1, A2, A4).

All are grouped aggregates (partial + final hash aggregate); totals come
from ``rollup`` in the same job instead of separate ``count()`` actions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def load_counters(found: DataFrame, saved: DataFrame, page_col: str) -> DataFrame:
    """A2: per page the rows ``found`` and ``saved`` (each has ``page_col``), and an
    overall row (page null): two partial counts in one rollup, no join."""
    both = found.select(page_col, F.lit(1).alias("_found"), F.lit(0).alias("_saved")).unionByName(
        saved.select(page_col, F.lit(0).alias("_found"), F.lit(1).alias("_saved"))
    )
    return both.rollup(page_col).agg(
        F.sum("_found").cast("bigint").alias("found"), F.sum("_saved").cast("bigint").alias("saved")
    )


def synced_counts(df: DataFrame, source_col: str) -> DataFrame:
    """A4 (+A1): documents landed per source and in total (source null)."""
    return df.rollup(source_col).agg(F.count(F.lit(1)).cast("bigint").alias("synced"))
