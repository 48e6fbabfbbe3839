"""Merges per key (K5–K7), counts (A3) and landing helpers (Y1–Y6) — invariants."""

import datetime as dt

from pyspark.sql import functions as F

from jobmart.operators import landing as L
from jobmart.operators import upsert as U

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "k bigint, ts timestamp_ntz, v bigint, a string, b string"


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_last_and_first_wins_with_ties(spark):
    t = T0
    df = _rows(spark, [(1, t, 1, "x", None), (1, t, 2, "y", "q"), (2, t, 5, "z", None), (1, t - dt.timedelta(1), 9, "w", None)])
    last = {r.k: r.v for r in U.latest_per_key(df, ["k"], ["ts", "v"]).collect()}
    first = {r.k: r.v for r in U.first_per_key(df, ["k"], ["ts", "v"]).collect()}
    assert last == {1: 2, 2: 5}
    assert first == {1: 9, 2: 5}


def test_merge_is_idempotent(spark):
    existing = _rows(spark, [(1, T0, 1, "x", "p")])
    batch = _rows(spark, [(1, T0 + dt.timedelta(1), 2, "y", None), (3, T0, 3, "n", None)])
    once = U.merge_last_wins(existing, batch, ["k"], ["ts", "v"])
    twice = U.merge_last_wins(once, batch, ["k"], ["ts", "v"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert once.groupBy("k").count().where("count > 1").count() == 0


def test_merge_fields_keeps_non_null(spark):
    existing = _rows(spark, [(1, T0, 1, "x", "p")])
    batch = _rows(spark, [(1, T0 + dt.timedelta(1), 2, None, "q"), (1, T0 + dt.timedelta(2), 3, "z", None)])
    r = U.merge_fields(existing, batch, ["k"], ["ts", "v"], ["a", "b"]).first()
    assert (r.a, r.b, r.v) == ("z", "q", 3)


def test_insert_if_absent_never_changes_existing(spark):
    existing = _rows(spark, [(1, T0, 1, "old", None)])
    batch = _rows(spark, [(1, T0 - dt.timedelta(5), 0, "older", None), (2, T0, 4, "b", None), (2, T0, 3, "a", None)])
    got = {r.k: r.a for r in U.insert_if_absent(existing, batch, ["k"], ["ts", "v"]).collect()}
    assert got == {1: "old", 2: "a"}


def test_upsert_counts(spark):
    existing = _rows(spark, [(1, T0, 1, None, None)])
    batch = _rows(spark, [(1, T0, 2, None, None), (2, T0, 3, None, None), (2, T0, 4, None, None)])
    r = U.upsert_counts(existing, batch, ["k"]).first()
    assert (r.batch_rows, r.batch_keys, r.inserted, r.updated) == (3, 2, 1, 1)


def test_cap_keeps_overflow_pending(spark):
    rows = [(i % 2, T0 + dt.timedelta(seconds=i), i, None, None) for i in range(10)]
    df = _rows(spark, rows)
    out = L.cap_per_batch(df, "k", ["ts", "v"], cap=3)
    assert out.count() == 10
    assert out.where("NOT pending").groupBy("k").count().collect()[0]["count"] == 3
    assert sorted(r.v for r in out.where("NOT pending AND k = 0").collect()) == [0, 2, 4]


def test_unsynced_and_paths(spark):
    df = spark.createDataFrame(
        [(1, True, None, None, "2024-03-05T10:00:00"), (2, False, "a", "S", "bad"), (3, None, None, "S", None)],
        "oid int, synced_to_datalake boolean, jobId string, source string, crawled_at string",
    )
    left = L.unsynced(df)
    assert sorted(r.oid for r in left.collect()) == [2, 3]
    ingest = F.lit("2024-02-01 00:00:00").cast("timestamp")
    ts = L.landing_time(F.col("crawled_at"), F.lit(None).cast("timestamp"), ingest)
    key = L.doc_key(F.col("jobId"), F.col("oid"))
    paths = [r[0] for r in df.select(L.landing_path(L.doc_source(F.col("source")), ts, key)).collect()]
    assert paths == ["unknown/2024/03/05/1.json", "S/2024/02/01/a.json", "S/2024/02/01/3.json"]


def test_cap_with_null_and_equal_order_values(spark):
    df = _rows(spark, [(1, None, 3, None, None), (1, None, 1, None, None), (1, T0, 2, None, None), (1, T0, 4, None, None)])
    out = L.cap_per_batch(df, "k", ["ts"], "v", cap=3)
    assert {r.v: r["rank"] for r in out.collect()} == {1: 1, 3: 2, 2: 3, 4: None}


def test_null_keys_are_rejects(spark):
    df = _rows(spark, [(None, T0, 1, "x", None), (None, T0, 2, "y", None), (1, T0, 3, "z", None)])
    kept, rejects = U.split_keys(df, ["k"])
    assert (kept.count(), rejects.count()) == (1, 2)
    assert U.latest_per_key(df, ["k"], ["ts", "v"]).count() == 1
    assert [r.k for r in U.merge_fields(df, df, ["k"], ["ts", "v"], ["a"]).collect()] == [1]
    r = U.upsert_counts(df.limit(0), df, ["k"]).first()
    assert (r.batch_rows, r.batch_keys, r.inserted, r.rejected) == (1, 1, 1, 2)


def test_merge_resets_the_flag_of_batch_keys_only(spark):
    flagged = _rows(spark, [(1, T0, 1, "x", "p"), (2, T0, 2, "y", "q")]).withColumn(U.FLAG, F.lit(True))
    batch = _rows(spark, [(1, T0 + dt.timedelta(1), 3, "z", None), (3, T0, 4, "n", None)])
    got = {r.k: r[U.FLAG] for r in U.merge_fields(flagged, batch, ["k"], ["ts", "v"], ["a"]).collect()}
    assert got == {1: False, 2: True, 3: False}


def test_ledger_and_objects(spark):
    docs = _rows(spark, [(1, T0, 1, "s", None), (1, T0, 2, "s", None), (2, T0, 3, "s", None), (None, T0, 4, "s", None)])
    assert sorted(r.v for r in L.not_landed(docs.where("k is not null"), docs.where("k = 1"), ["k"]).collect()) == [3]
    assert sorted(r.v for r in L.one_per_object(docs, ["a", "k"], ["ts", "v"]).collect()) == [2, 3]
