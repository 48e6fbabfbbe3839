"""Incremental landing of raw documents.

The document store's per-document loop (read unsynced, put one object, flip
the flag) becomes: filter unsynced -> leave out the keys of the ledger -> derive
key/source/day -> one partitioned write -> append the landed keys to the ledger (or
let a streaming checkpoint do it, see ``jobmart.streaming``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from jobmart import schemas as S
from jobmart.operators.upsert import latest_per_key


def is_unsynced(flag_col: str = "synced_to_datalake") -> Column:
    """Whether a document is not yet landed. Deviation: a missing flag counts as
    unsynced (the store's ``{flag: false}`` match skipped such documents)."""
    return ~F.coalesce(F.col(flag_col), F.lit(False))


def unsynced(df: DataFrame, flag_col: str = "synced_to_datalake") -> DataFrame:
    """Documents not yet landed."""
    return df.where(is_unsynced(flag_col))


def doc_key(job_id: Column, object_id: Column) -> Column:
    """``jobId`` else the document id."""
    return F.coalesce(job_id.cast("string"), object_id.cast("string"))


def doc_source(source: Column) -> Column:
    """Source tag else ``unknown``."""
    return F.coalesce(source, F.lit(S.SOURCE_UNKNOWN))


def landing_time(crawled_at: Column, fetched_at: Column, ingest_ts: Column) -> Column:
    """Y2: parse ``crawled_at`` (timestamp or ISO text); fall back to
    ``fetched_at`` and then the ingest time."""
    return F.coalesce(crawled_at.cast("string").try_cast("timestamp"), fetched_at, ingest_ts)


def landing_path(source: Column, ts: Column, key: Column) -> Column:
    """``<source>/<yyyy>/<MM>/<dd>/<key>.json`` (zero-padded)."""
    return F.concat_ws("/", source, F.date_format(ts, "yyyy/MM/dd"), F.concat(key, F.lit(".json")))


def not_landed(docs: DataFrame, ledger: DataFrame, keys: list[str]) -> DataFrame:
    """The documents whose key the ledger of landed keys does not have. The
    caller lands them and then appends their keys to the ledger, so a run that fails
    in between lands them again, where ``one_per_object`` lets them replace themselves."""
    return docs.join(ledger.select(*keys).distinct(), keys, "left_anti")


def one_per_object(docs: DataFrame, object_cols: list[str], order_cols: list[str]) -> DataFrame:
    """K4: an object is named by source, day and id, so a later document of the same
    name replaces it: of each name the newest row stays (rows without a name go)."""
    return latest_per_key(docs, object_cols, order_cols)


def new_keys_per_batch(df: DataFrame, batch_col: str, keys: list[str]) -> DataFrame:
    """Y5 applied to every batch in order (seen = all earlier batches): a key
    is new in exactly its first batch, so this is one aggregate on the key
    (partial aggregation map-side), not a comparison of batch pairs."""
    return df.groupBy(*keys).agg(F.min(batch_col).alias(batch_col))


def cap_per_batch(df: DataFrame, batch_col: str, order_cols: list[str], row_key: str | None = None,
                  cap: int = S.PAGE_BATCH_CAP) -> DataFrame:
    """The first ``cap`` rows of each batch get a rank; the rest stay as
    pending (``rank`` null) instead of being lost. ``row_key`` (the last order column by
    default) is unique and not null; the order columns before it may be neither (nulls
    first, ties by the key).

    Only the top ``cap`` rows per batch are ranked: Spark plans the
    ``row_number() <= cap`` filter as a per-partition group limit before the
    shuffle, so a huge batch never sorts in one task. The ranked set
    (``cap`` x batches rows) joins back to all rows by their key.
    """
    row_key = row_key or order_cols[-1]
    w = Window.partitionBy(batch_col).orderBy(*[F.col(c) for c in [*order_cols, row_key]])
    top = (
        df.select(batch_col, *dict.fromkeys([*order_cols, row_key]))
        .withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= cap)
        .select(row_key, "rank")
    )
    out = df.join(top, row_key, "left")
    return out.withColumn("pending", F.col("rank").isNull())
