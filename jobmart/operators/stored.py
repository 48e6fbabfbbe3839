"""Merges into a stored table (K5–K7), batch by batch, and idempotent objects (K4).

A stored table is a folder of Parquet partitions ``bucket=<k>``: a row's bucket is a hash
of its key, so a batch rewrites only the buckets that its keys fall into, and every
other bucket's files stay as they are. The merged buckets are first written beside the
table and then replace the old ones (dynamic partition overwrite).

Each row carries in ``_applied`` the last batch that its bucket has taken. Batch ids
rise; a bucket that has taken a batch skips its replay, also where a failed run had
replaced only some buckets. So a replay changes nothing, not even the sync flag that
the batch had reset. What is read by the driver is the numbers of touched buckets.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.operators.upsert import insert_if_absent, latest_per_key, merge_fields, merge_last_wins, split_keys

BUCKET, APPLIED = "bucket", "_applied"


@dataclass
class StoredTable:
    """``path`` and ``schema`` (DDL, without the two columns above) of a table keyed by ``keys``."""

    spark: SparkSession
    path: str
    schema: str
    keys: list[str]
    buckets: int = 64

    def read(self) -> DataFrame:
        return self._stored().drop(BUCKET, APPLIED)

    def _stored(self) -> DataFrame:
        ddl = f"{self.schema}, {APPLIED} bigint, {BUCKET} int"
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        if not path.getFileSystem(conf).exists(path):
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).parquet(self.path)

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def apply(self, batch: DataFrame, batch_id: int, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """Replaces the buckets of ``batch`` by ``merge(their rows, the batch's rows)``;
        returns how many. Rows without a key are left out."""
        batch, _ = split_keys(batch, self.keys)
        batch = batch.withColumn(BUCKET, self._bucket())
        touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]  # at most ``buckets``
        stored = self._stored().where(F.col(BUCKET).isin(touched))
        done = stored.groupBy(BUCKET).agg(F.max(APPLIED).alias("last")).where(F.col("last") >= batch_id)
        done = {r[0] for r in done.collect()}
        open_buckets = [b for b in touched if b not in done]
        if not open_buckets:
            return 0
        old = stored.where(F.col(BUCKET).isin(open_buckets)).drop(BUCKET, APPLIED)
        merged = merge(old, batch.where(F.col(BUCKET).isin(open_buckets)).drop(BUCKET))
        merged = merged.withColumn(APPLIED, F.lit(batch_id).cast("bigint")).withColumn(BUCKET, self._bucket())
        beside = f"{self.path.rstrip('/')}-next-{uuid.uuid4().hex[:8]}"
        merged.repartition(BUCKET).write.parquet(beside)
        (
            self.spark.read.schema(merged.schema).parquet(beside).repartition(BUCKET)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)
        )
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(beside)
        path.getFileSystem(conf).delete(path, True)
        return len(open_buckets)

    def set_fields(self, batch: DataFrame, batch_id: int, order_cols: list[str], fields: list[str]) -> int:
        """K5 field level and K6: newest non-null values; touched keys are unsynced again."""
        return self.apply(batch, batch_id, lambda old, new: merge_fields(old, new, self.keys, order_cols, fields))

    def replace(self, batch: DataFrame, batch_id: int, order_cols: list[str]) -> int:
        """K5 row level: the newest version stays."""
        return self.apply(batch, batch_id, lambda old, new: merge_last_wins(old, new, self.keys, order_cols))

    def insert(self, batch: DataFrame, batch_id: int, order_cols: list[str]) -> int:
        """K7: keys that are there never change."""
        return self.apply(batch, batch_id, lambda old, new: insert_if_absent(old, new, self.keys, order_cols))


def put_objects(docs: DataFrame, path: str, schema: str, name_cols: list[str], order_cols: list[str], buckets: int = 1) -> None:
    """K4: land documents so that one object stays for each name (source, day, id): the
    partitions (of all name columns but the last, and a hash of that) which the batch
    touches are merged with what lies there, newest first, and replaced (more ``buckets``
    where a folder outgrows what one task should rewrite). Landing the same
    documents again changes nothing. ``schema`` is the documents' DDL."""
    spark = docs.sparkSession
    *folders, key = name_cols
    folders = [*folders, "part"]
    docs = docs.withColumn("part", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(conf).exists(where):
        lies = spark.read.schema(f"{schema}, part int").parquet(path)
        docs = docs.unionByName(lies.join(docs.select(*folders).distinct(), folders, "left_semi"))
    beside = f"{path.rstrip('/')}-next-{uuid.uuid4().hex[:8]}"
    merged = latest_per_key(docs, [*folders, key], order_cols)
    merged.write.parquet(beside)
    (
        spark.read.schema(merged.schema).parquet(beside).repartition(*folders)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)
    )
    path_beside = jvm.org.apache.hadoop.fs.Path(beside)
    path_beside.getFileSystem(conf).delete(path_beside, True)
