"""Streams: several files, several micro-batches, and a second run on one checkpoint."""

import datetime as dt

from pyspark.sql import functions as F

from jobmart.operators import upsert as U
from jobmart.streaming import progress as PR
from jobmart.streaming import upserts as ST
from jobmart.streaming.upserts import ARRIVED

T0 = dt.datetime(2024, 1, 1)
DDL = "k bigint, ts timestamp_ntz, v double"


def test_version_log_and_second_run(spark, tmp_path):
    src, log, checkpoint = (str(tmp_path / x) for x in ("src", "log", "checkpoint"))
    files = [
        [(1, T0, 1.2), (2, T0, 5.0)],
        [(1, T0, 1.9), (2, T0 - dt.timedelta(1), 4.0), (3, None, 1.0)],
    ]
    for rows in files:
        spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(src)
    ST.version_log(ST.file_stream(spark, src, DDL, max_files=1), log, checkpoint)
    read = lambda: spark.read.parquet(log)
    assert read().count() == 5
    latest = {r.k: r.v for r in U.latest_per_key(read(), ["k"], ["ts", "v"]).collect()}
    assert latest == {1: 1.9, 2: 5.0, 3: 1.0}
    first = {r.k: r.v for r in ST.first_arrival(read(), ["k"], ["ts", "v"]).collect()}
    assert first == {1: 1.2, 2: 5.0, 3: 1.0}  # what arrived first, not the oldest
    ST.version_log(ST.file_stream(spark, src, DDL), log, checkpoint)
    assert read().count() == 5
    spark.createDataFrame([(4, T0, 7.0)], DDL).write.mode("append").parquet(src)
    ST.version_log(ST.file_stream(spark, src, DDL), log, checkpoint)
    assert read().count() == 6


def test_landing_lands_new_files_only(spark, tmp_path):
    src, out, checkpoint = (str(tmp_path / x) for x in ("src", "out", "checkpoint"))
    for _ in range(2):
        spark.createDataFrame([(1, T0, 1.0)], DDL).write.mode("append").parquet(src)
        docs = ST.with_event_day(ST.file_stream(spark, src, DDL)).selectExpr("*", "'s' AS source")
        ST.landing_stream(docs, out, checkpoint)
        ST.landing_stream(docs, out, checkpoint)
    assert spark.read.json(out).count() == 2


def test_landing_progress(spark, tmp_path):
    root = str(tmp_path)
    schema = "id int, source string, dt string, done boolean"

    def land(*rows):
        for row in rows:  # a file, and so a micro-batch, for each
            spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(root + "/in")
        stream = ST.file_stream(spark, root + "/in", schema, max_files=1)
        PR.land_with_progress(spark, stream, ~F.col("done"), root + "/out", root + "/checkpoint", root + "/progress")

    land((1, "a", "d1", False), (2, "a", "d1", True), (3, "b", "d2", False))
    land((4, "b", "d2", False))
    land()  # nothing new: no batch
    progress = spark.read.parquet(root + "/progress")
    assert sorted((r.batch, r.found, r.landed) for r in progress.collect()) == [(0, 1, 1), (1, 1, 0), (2, 1, 1), (3, 1, 1)]
    landed = spark.read.schema(f"id int, source string, {ARRIVED} timestamp").json(root + "/out")
    got = PR.landed_by_source(landed, progress)
    assert {(r.batch_found, r.batch_landed) for r in got.collect()} == {(1, 1)}
    assert sum(r.landed for r in got.collect()) == landed.count() == 3
    # Without its row of progress a batch's documents are still counted.
    lost = PR.landed_by_source(landed, progress.where("batch <> 3"))
    assert sum(r.landed for r in lost.collect()) == 3 and [r.source for r in lost.collect() if r.batch is None] == ["b"]
