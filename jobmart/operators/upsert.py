"""Set-based merges per key (K5–K7) and insert/update counts (A3).

The crawlers upserted one document at a time; here a batch merges in one shuffle on
the key. ``max_by``/``min_by`` over a ``(version...)`` struct aggregate on the map side,
so a hot key (even one holding a third of all rows) is one row per map task before the
shuffle. The row value is a string-holding struct, so Spark plans a sort-based
aggregate: each map task sorts its own rows by key, and never a whole key in one task.

Ties on the version are broken by the extra ordering columns (always pass a unique one
such as an event id, Hard 5). Rows with a null key belong to no document: ``split_keys``
returns them as rejects, and every merge leaves them out (Hard 1).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FLAG = "synced_to_datalake"


def _version(order_cols: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in order_cols])


def _has_key(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def split_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all key columns, and the rejects that lack one."""
    return df.where(_has_key(keys)), df.where(~_has_key(keys))


def _pick(df: DataFrame, keys: list[str], order_cols: list[str], latest: bool) -> DataFrame:
    row = F.struct(*[F.col(c) for c in df.columns])
    agg = F.max_by(row, _version(order_cols)) if latest else F.min_by(row, _version(order_cols))
    return df.where(_has_key(keys)).groupBy(*keys).agg(agg.alias("_row")).select("_row.*")


def latest_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """K5 (row level): the newest version of each key wins."""
    return _pick(df, keys, order_cols, latest=True)


def first_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """K7 within one batch: the oldest version of each key."""
    return _pick(df, keys, order_cols, latest=False)


def merge_last_wins(existing: DataFrame, batch: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """K5: replace whole rows by newer versions (replaying a batch is a no-op)."""
    return latest_per_key(existing.unionByName(batch, allowMissingColumns=True), keys, order_cols)


def merge_fields(
    existing: DataFrame,
    batch: DataFrame,
    keys: list[str],
    order_cols: list[str],
    fields: list[str],
) -> DataFrame:
    """K5 (field level, ``$set``) and K6: each field takes its newest non-null value; a
    key that the batch touches is unsynced again, any other keeps its newest flag.

    Deviation: a null in a newer version cannot erase an older value (an
    explicit null in the document store would).
    """
    flagged = existing if FLAG in existing.columns else existing.withColumn(FLAG, F.lit(False))
    both = flagged.withColumn("_new", F.lit(False)).unionByName(
        batch.drop(FLAG).withColumn(FLAG, F.lit(False)).withColumn("_new", F.lit(True)), allowMissingColumns=True
    )
    version = _version(order_cols)
    aggs = [F.max_by(F.col(f), F.when(F.col(f).isNotNull(), version)).alias(f) for f in fields]
    aggs += [
        F.max(version).alias("_version"),
        F.max("_new").alias("_touched"),
        F.max_by(FLAG, F.when(F.col(FLAG).isNotNull(), version)).alias("_flag"),
    ]
    out = both.where(_has_key(keys)).groupBy(*keys).agg(*aggs)
    flag = F.when(F.col("_touched"), F.lit(False)).otherwise(F.coalesce("_flag", F.lit(False)))
    return out.select(*keys, *fields, *[F.col("_version")[c].alias(c) for c in order_cols], flag.alias(FLAG))


def insert_if_absent(existing: DataFrame, batch: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """K7 (``$setOnInsert``): existing keys never change; new keys enter with
    their first version in the batch."""
    fresh = first_per_key(batch, keys, order_cols).join(existing.select(*keys), keys, "left_anti")
    return existing.unionByName(fresh, allowMissingColumns=True)


def upsert_counts(existing_keys: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """A3: rows, distinct keys, inserted (new) and updated (existing) keys of a batch,
    and its rows without a key."""
    batch_keys = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    known = existing_keys.where(_has_key(keys)).select(*keys).distinct().withColumn("_known", F.lit(True))
    joined = batch_keys.join(known, keys, "left")
    has = _has_key(keys)
    return joined.agg(
        F.coalesce(F.sum(F.when(has, F.col("_rows"))), F.lit(0)).cast("bigint").alias("batch_rows"),
        F.count_if(has).cast("bigint").alias("batch_keys"),
        F.count_if(has & F.col("_known").isNull()).cast("bigint").alias("inserted"),
        F.count_if(has & F.col("_known").isNotNull()).cast("bigint").alias("updated"),
        F.coalesce(F.sum(F.when(~has, F.col("_rows"))), F.lit(0)).cast("bigint").alias("rejected"),
    )
