"""Streaming forms of the per-key merges (K7, K5) and incremental landing.

A stream needs no per-key state for these merges: ``version_log`` appends every
version with the time of its micro-batch to a log, exactly once per input file, and
readers compact the log with the batch operators, which aggregate before the shuffle:

* ``first_arrival`` (K7, ``$setOnInsert``): the version of the earliest micro-batch of
  the key, the oldest one within it. This is what arrived first, which differs from
  the oldest version where a late file brings older rows.
* ``latest_per_key`` (K5) from ``jobmart.operators.upsert``: the newest version.

The file source's checkpoint records which input files were processed, so a re-run
with the same checkpoint adds nothing but new files (``landing_stream``: the streaming
equivalent of the ``synced`` flag).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from jobmart.operators.upsert import first_per_key

ARRIVED = "_arrived"


def file_stream(spark: SparkSession, directory: str, schema: str, glob: str | None = None,
                max_files: int | None = None) -> DataFrame:
    """Parquet file source; new files under ``directory`` are picked up by later runs
    with the same checkpoint. ``max_files`` bounds a micro-batch (default: no bound)."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(directory)


def start_available(df: DataFrame, out_path: str, checkpoint: str, partition_by: list[str] | None = None,
                    fmt: str = "parquet", options: dict[str, str] | None = None) -> StreamingQuery:
    """Start to process everything available now into a file sink, exactly once per input
    file (checkpointed)."""
    writer = df.writeStream.format(fmt).option("path", out_path).option("checkpointLocation", checkpoint)
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.outputMode("append").trigger(availableNow=True).start()


def run_available(df: DataFrame, out_path: str, checkpoint: str, **options) -> StreamingQuery:
    """``start_available``, then wait for the end, however long it takes."""
    query = start_available(df, out_path, checkpoint, **options)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


def version_log(versions: DataFrame, log_path: str, checkpoint: str) -> StreamingQuery:
    """Append the versions available now, with their time of arrival, to the log."""
    return run_available(versions.withColumn(ARRIVED, F.current_timestamp()), log_path, checkpoint)


def first_arrival(log: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """K7 over a version log: per key the version that arrived first."""
    return first_per_key(log, keys, [ARRIVED, *order_cols]).drop(ARRIVED)


def landing_stream(docs: DataFrame, out_path: str, checkpoint: str) -> StreamingQuery:
    """Land documents as JSON Lines partitioned by source and day."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    return run_available(
        docs, out_path, checkpoint, partition_by=["source", "dt"], fmt="json",
        options={"timestampFormat": iso, "timestampNTZFormat": iso},
    )


def with_event_day(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    return df.withColumn("dt", F.to_date(ts_col))
