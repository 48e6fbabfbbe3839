"""Stored-table merges, idempotent objects, streams with state, broken files, buckets."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from jobmart.operators.marts import skill_report
from jobmart.operators.pages import extract_links
from jobmart.operators.stored import StoredTable, put_objects
from jobmart.plans.train import LabelEncoder
from jobmart.sources import readers, sinks
from jobmart.streaming import state
from jobmart.streaming.upserts import file_stream

DDL = "id bigint, v string, w string, ts bigint, synced_to_datalake boolean"


def _rows(spark, rows, ddl="id bigint, v string, w string, ts bigint"):
    return spark.createDataFrame(rows, ddl)


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.startswith("part")}


def test_stored_fields_replay_and_untouched_buckets(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "t"), DDL, ["id"], 8)
    assert table.read().count() == 0
    first = [(i, f"a{i}", None, 1) for i in range(50)]
    assert table.set_fields(_rows(spark, first), 1, ["ts"], ["v", "w"]) == 8
    synced = table.read().withColumn("synced_to_datalake", F.lit(True))
    table.apply(synced, 2, lambda old, new: new)
    before = _files(tmp_path / "t")
    batch = _rows(spark, [(3, None, "w3", 2), (None, "x", None, 9)])
    assert table.set_fields(batch, 3, ["ts"], ["v", "w"]) == 1
    after = _files(tmp_path / "t")
    assert len(set(before) & set(after)) == 7 and all(after[f] == before[f] for f in set(before) & set(after))
    got = {r["id"]: r for r in table.read().collect()}
    assert len(got) == 50 and (got[3]["v"], got[3]["w"], got[3]["synced_to_datalake"]) == ("a3", "w3", False)
    assert got[4]["synced_to_datalake"] is True
    # Landed meanwhile, then the batch is replayed: nothing changes, the flag neither.
    table.apply(table.read().where("id = 3").withColumn("synced_to_datalake", F.lit(True)), 4, lambda old, new: old.where("id <> 3").unionByName(new))
    assert table.set_fields(batch, 3, ["ts"], ["v", "w"]) == 0
    assert table.read().where("id = 3 and synced_to_datalake").count() == 1
    assert [d for d in os.listdir(tmp_path) if "next" in d] == []


def test_stored_replace_and_insert(spark, tmp_path):
    ddl = "id bigint, v string, ts bigint"
    last, first = (StoredTable(spark, str(tmp_path / n), ddl, ["id"], 4) for n in "lf")
    for table in (last, first):
        for number, rows in enumerate([[(1, "a", 1), (2, "b", 5)], [(1, "c", 2), (2, "d", 3), (3, "e", 1), (3, "f", 2)]], 1):
            (table.replace if table is last else table.insert)(_rows(spark, rows, ddl), number, ["ts"])
    assert sorted((r["id"], r["v"]) for r in last.read().collect()) == [(1, "c"), (2, "b"), (3, "f")]
    assert sorted((r["id"], r["v"]) for r in first.read().collect()) == [(1, "a"), (2, "b"), (3, "e")]


def test_objects_land_once(spark, tmp_path):
    ddl = "source string, day string, key string, ts bigint"
    rows = [("s", "d1", "a", 1), ("s", "d1", "b", 1), ("t", "d1", "a", 1)]
    path = str(tmp_path / "o")
    for batch in (rows, rows, [("s", "d1", "a", 2), ("s", "d2", "a", 3)]):
        put_objects(_rows(spark, batch, ddl), path, ddl, ["source", "day", "key"], ["ts"])
    got = spark.read.schema(ddl).parquet(path).select("source", "day", "key", "ts").collect()
    assert sorted(map(tuple, got)) == [("s", "d1", "a", 2), ("s", "d1", "b", 1), ("s", "d2", "a", 3), ("t", "d1", "a", 1)]


def test_streams_with_state_restart(spark, tmp_path):
    ddl = "id bigint, v string, ts bigint"
    source, root = str(tmp_path / "in"), str(tmp_path)
    batches = [[(1, "a", 5), (1, "b", 4), (2, "c", 1), (None, "x", 1)], [(1, "d", 3), (2, "e", 9), (3, "f", 1)]]
    for rows in batches:
        _rows(spark, rows, ddl).coalesce(1).write.mode("append").parquet(source)
        state.first_wins(file_stream(spark, source, ddl), ["id"], ["ts"], root + "/first", root + "/c1")
        state.last_wins(file_stream(spark, source, ddl), ["id"], ["ts"], root + "/last", root + "/c2")
        state.unseen_keys(file_stream(spark, source, ddl).select("id"), ["id"], root + "/keys", root + "/c3")
    rows = lambda name: sorted((tuple(r) for r in spark.read.parquet(f"{root}/{name}").collect()), key=str)
    assert rows("first") == [(1, "b", 4), (2, "c", 1), (3, "f", 1)]
    assert rows("last") == [(1, "a", 5), (2, "c", 1), (2, "e", 9), (3, "f", 1)]
    assert rows("keys") == [(1,), (2,), (3,), (None,)]
    with state.rocksdb(spark):
        assert spark.read.format("statestore").load(root + "/c2").count() == 3


@pytest.mark.parametrize(
    ("text", "reason"),
    [('[{"a":1},{"a"', "not json"), ('{"a":', "not json"), ("", "empty"), ("\n ", "empty"), ("<html>", "not json"), ("7", "no document")],
)
def test_broken_files_are_put_aside(spark, tmp_path, text, reason):
    (tmp_path / "good.json").write_text('[{"a":1},\n{"a":2}]\n')
    (tmp_path / "one.json").write_text('{"a":3}')
    (tmp_path / "bad.json").write_text(text)
    docs, rejects = readers.read_array_files_checked(spark, str(tmp_path))
    assert sorted(r[0] for r in docs.select(F.try_variant_get("doc", "$.a", "int")).collect()) == [1, 2, 3]
    [row] = rejects.collect() if text else [*rejects.collect()] or [None]
    assert row is None or (row["file_path"].endswith("bad.json") and row["reason"] == reason)


def test_bucketed_marts_join_without_a_shuffle(spark, tmp_path):
    fact = spark.createDataFrame([("1", 10.0), ("2", 20.0)], "job_id string, salary_avg double")
    skills = spark.createDataFrame([("1", "x"), ("1", "x"), ("2", "x"), ("2", "y")], "job_id string, skill_name string")
    fact = sinks.write_bucketed(fact, "t_fact", str(tmp_path / "f"), "job_id", 4)
    skills = sinks.write_bucketed(skills, "t_skills", str(tmp_path / "s"), "job_id", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = skill_report(fact, skills)
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, report.collect())) == [("x", 2, 15.0), ("y", 1, 20.0)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("drop table t_fact")
        spark.sql("drop table t_skills")
    # One exchange: of the report's groups, above the join.
    assert plan.split("SortMergeJoin")[1].count("Exchange") == 0, plan


def test_label_encoder_keeps_unseen_labels(spark, tmp_path):
    train = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "c string")
    encoder = LabelEncoder.fit(train, "c", str(tmp_path / "labels"))
    again = LabelEncoder(spark, "c", str(tmp_path / "labels"))
    rows = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string")
    want = {"b": 0.0, "a": 1.0, "z": 2.0, None: 2.0}
    assert {r[0]: r[1] for r in encoder.transform(rows, "i").collect()} == want
    assert {r[0]: r[1] for r in again.transform(rows, "i").collect()} == want


def test_long_tags_do_not_end_the_jvm(spark):
    junk = "<a " + "x" * 1_000_000 + ' title="href=no" href="/ok">t</a>' + "<a " + "y " * 4_000_000
    rows = spark.createDataFrame([(1, "https://h.example/", junk)], "page_id int, url string, html string")
    assert [r["link"] for r in extract_links(rows).collect()] == ["https://h.example/ok"]


def test_cell_means_of_null_and_unseen_categories(spark):
    from jobmart.plans.train import cell_means, evaluate

    rows = spark.createDataFrame(
        [("a", "x", 10.0, True), ("a", "x", 20.0, True), (None, "x", 4.0, True), ("a", None, 6.0, True),
         ("a", "x", 15.0, False), (None, "x", 5.0, False), ("a", None, 6.0, False), ("b", "x", 12.0, False)],
        "location string, level string, salary_avg double, is_train boolean",
    )
    found = cell_means(rows)
    test = {(r.location, r.level): r.cell_mean for r in found.where("not is_train").collect()}
    assert test == {("a", "x"): 15.0, (None, "x"): 4.0, ("a", None): 6.0, ("b", "x"): 10.0}
    assert evaluate(found, "cell_mean").first()["rmse"] == pytest.approx((5 / 4) ** 0.5)
    assert cell_means(rows.where("not is_train")).where("cell_mean is not null").count() == 0
