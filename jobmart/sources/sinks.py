"""Sinks for marts, samples and landed documents (K1–K4, K9).

Writes are partitioned files, never one object per document; outputs go to a path that
the caller gives or to the shared folder that the cluster configures
(``spark.checkpoint.dir``; a local folder stands in for it in local mode only).
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from jobmart import schemas as S

LOG = logging.getLogger(__name__)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """K1: overwrite, snappy parquet."""
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


CSV_NULL = "\\N"


def write_csv_sample(df: DataFrame, path: str, order_by: list[str], rows: int = S.SAMPLE_ROWS) -> bool:
    """K2: a small header CSV for inspection: deterministic first ``rows`` by
    ``order_by`` (a top-k, so only ``rows`` rows per task reach the final
    single partition). Nulls are written as ``\\N`` so empty strings and
    nulls stay distinct. Failures are logged, not raised."""
    try:
        sample = df.orderBy(*order_by).limit(rows).coalesce(1)
        sample.write.mode("overwrite").option("header", True).option("nullValue", CSV_NULL).csv(path)
        return True
    except Exception:  # sidecar only; never fail the job for it
        LOG.exception("CSV sample write failed: %s", path)
        return False


def read_csv_sample(spark, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).option("nullValue", CSV_NULL).schema(schema).csv(path)


def write_landing(df: DataFrame, path: str, partition_by: list[str], ts_format: str = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") -> None:
    """K3/K4: JSON Lines partitioned by source/day, appended; timestamps as ISO text."""
    (
        df.write.mode("append")
        .option("timestampFormat", ts_format)
        .option("timestampNTZFormat", ts_format)
        .partitionBy(*partition_by)
        .json(path)
    )


def land_collections(collections: dict[str, DataFrame], root: str, partition_by: list[str]) -> dict[str, str | None]:
    """K3: each collection's snapshot below ``root/<name>``; one that fails is logged and
    the others still land. A snapshot replaces the partitions it has rows for, so a retry
    lands nothing twice. Returns each collection's error (None: landed)."""
    errors: dict[str, str | None] = {}
    for name, df in collections.items():
        try:
            (
                df.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .option("timestampFormat", _ISO)
                .option("timestampNTZFormat", _ISO)
                .partitionBy(*partition_by)
                .json(f"{root}/{name}")
            )
            errors[name] = None
        except Exception as error:  # the other collections must land
            LOG.exception("collection %s did not land", name)
            errors[name] = str(error)
    return errors


def land_run(collections: dict[str, DataFrame], root: str, run: str, partition_by: list[str]) -> dict[str, int | None]:
    """K3: one more snapshot of each collection, in ``root/<name>/run=<run>``, beside those
    of earlier runs. A marker with the number of rows that landed follows once the whole
    snapshot is written, so that a run which stops half-way is never read
    (``readers.read_latest_runs``); landing the same run again replaces what it left. A
    collection that fails is logged and the others still land. Run ids sort as text.
    Returns each collection's rows (None: failed)."""
    landed: dict[str, int | None] = {}
    for name, df in collections.items():
        try:
            counted = Observation()
            (
                df.observe(counted, F.count(F.lit(1)).alias("landed")).write.mode("overwrite")
                .option("timestampFormat", _ISO)
                .option("timestampNTZFormat", _ISO)
                .partitionBy(*partition_by)
                .json(f"{root}/{name}/run={run}")
            )
            landed[name] = counted.get["landed"]
            marker = df.sparkSession.createDataFrame([(name, run, landed[name])], S.RUN_MARKER_DDL)
            marker.coalesce(1).write.mode("append").json(f"{root}/{S.RUN_MARKERS}")
        except Exception:  # the other collections must land
            LOG.exception("run %s of collection %s did not land", run, name)
            landed[name] = None
    return landed


_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """K1 for joins: a catalogue table below ``path``, bucketed and sorted on ``key``, so
    that marts with the same buckets join on it without a shuffle."""
    rows = df.repartition(buckets, key)
    writer = rows.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def to_json_doc(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One JSON document per row (ISO timestamps, ids as text, non-ASCII kept)."""
    cols = columns or df.columns
    options = {"timestampFormat": _ISO, "timestampNTZFormat": _ISO}
    return df.select(F.to_json(F.struct(*cols), options).alias("doc"))


def write_array_files(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """K3 in the legacy form: per partition and task one file holding one JSON array of
    the column ``doc`` (documents as JSON text)."""
    arrays = df.groupBy(*partition_by, F.spark_partition_id().alias("_task")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list("doc"), ",\n"), F.lit("]")).alias("value")
    )
    # A row is a whole file, so no two rows of a folder may share one.
    arrays.drop("_task").write.mode("append").option("maxRecordsPerFile", 1).partitionBy(*partition_by).text(path)


def save_model(model, path: str) -> None:
    """K9: overwrite the fitted pipeline."""
    model.write().overwrite().save(path)
