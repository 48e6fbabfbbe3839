"""Progress of a landing stream, batch by batch (A1, A4).

Counters ride on the stream's own plan (``observe``), so they cost no second pass. Every
micro-batch has one time of arrival, which its rows carry and the counters hold; it ties
what has landed to the batch that landed it:

* ``land_with_progress`` lands documents and appends one row for each batch to a table:
  its number, time of arrival, documents found and landed;
* ``landed_by_source`` counts the landed rows by batch and source.

A driver that is lost between a batch's commit and the end of the run loses that batch's
row of the table, never its documents: their counts then have no batch number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.streaming.upserts import ARRIVED, start_available

_PROGRESS_DDL = "batch bigint, arrived bigint, found bigint, landed bigint"
_POLL_SECONDS = 1


def land_with_progress(spark: SparkSession, docs: DataFrame, wanted: Column, out_path: str, checkpoint: str,
                       progress_path: str) -> None:
    """Land the ``wanted`` documents available now, as JSON Lines by source and day, and
    append their batches to the table of progress. Spark keeps the progress of its last
    batches only; they are taken while the stream runs, and a batch that was missed is an
    error, not a silent gap."""
    counted = docs.withColumn(ARRIVED, F.current_timestamp()).observe(
        # Milliseconds, which the time of a batch is exact to: metrics print times by the second.
        "landing", F.max(F.unix_millis(ARRIVED)).alias("arrived"), F.count(F.lit(1)).alias("found"),
        F.count_if(wanted).alias("landed"),
    )
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    query = start_available(
        counted.where(wanted), out_path, checkpoint, partition_by=["source", "dt"], fmt="json",
        options={"timestampFormat": iso + "XXX", "timestampNTZFormat": iso},
    )
    batches: dict[int, tuple] = {}
    ended = False
    while not ended:
        ended = query.awaitTermination(_POLL_SECONDS)
        for progress in query.recentProgress:
            own = progress.observedMetrics.get("landing")
            if own is not None and own["found"]:
                batches[progress.batchId] = (progress.batchId, own["arrived"], own["found"], own["landed"])
    if query.exception() is not None:
        raise query.exception()
    if batches and len(batches) != max(batches) - min(batches) + 1:
        raise RuntimeError("progress of a batch was missed; raise spark.sql.streaming.numRecentProgressUpdates")
    rows = spark.createDataFrame(list(batches.values()), _PROGRESS_DDL)
    rows = rows.withColumn("arrived", F.timestamp_millis("arrived"))
    rows.coalesce(1).write.mode("append").parquet(progress_path)


def landed_by_source(landed: DataFrame, progress: DataFrame) -> DataFrame:
    """A4: landed documents by batch and source, beside what the batch found and landed in
    all. ``landed`` holds ``source`` and the time of arrival. Counts come first, so the join
    has one row for each batch and source."""
    counts = landed.groupBy(F.col(ARRIVED).alias("arrived"), "source").agg(F.count(F.lit(1)).alias("landed"))
    batches = progress.select(
        "batch", "arrived", F.col("found").alias("batch_found"), F.col("landed").alias("batch_landed")
    )
    return counts.join(batches, "arrived", "left").select("batch", "source", "landed", "batch_found", "batch_landed")
