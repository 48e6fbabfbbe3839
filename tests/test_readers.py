"""Latest-day reads over each landed layout, legacy files and extended JSON."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from jobmart.sources import readers, sinks


def _put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_latest_day_of_each_layout(spark, tmp_path):
    for name in ("a/source=x/dt=2024-01-31", "a/source=y/dt=2024-02-01", "a/source=x/dt=__HIVE_DEFAULT_PARTITION__",
                 "b/2023/12/31", "b/2024/01/02", "b/2024/13/40", "c/dt=2024-03-01"):
        _put(tmp_path / name / "part.json", json.dumps({"k": name}))
    for layout, want in (("a", "a/source=y/dt=2024-02-01"), ("b", "b/2024/01/02"), ("c", "c/dt=2024-03-01")):
        rows = readers.read_latest(spark, str(tmp_path / layout), "k string").select("k").collect()
        assert [r.k for r in rows] == [want]
    for name in ("d", "e/dt=soon"):
        _put(tmp_path / name / "x.json", "{}")
        with pytest.raises(Exception, match="no day folders"):
            readers.read_latest(spark, str(tmp_path / name[0]), "k string").collect()


def test_latest_day_is_pruned_by_a_subquery(spark, tmp_path):
    for day in range(1, 10):
        _put(tmp_path / f"s/source=x/dt=2024-01-0{day}" / "p.json", json.dumps({"k": day}))
    df = readers.read_latest(spark, str(tmp_path / "s"), "k int")
    scan = df._jdf.queryExecution().executedPlan().toString()
    filters = scan.split("PartitionFilters: [")[1].split("DataFilters")[0] if "PartitionFilters: [" in scan else ""
    assert "subquery" in filters.lower()
    assert [r.k for r in df.collect()] == [9]


def test_files_of_other_days_are_not_opened(spark, tmp_path):
    # The older days' files are no JSON: reading them strictly would fail.
    for layout in ("h/dt=2024-01-0{}", "y/2024/01/0{}"):
        for day in range(1, 4):
            _put(tmp_path / layout.format(day) / "p.json", json.dumps({"k": day}) if day == 3 else "{broken")
    reader = type(spark.read)
    plain = reader.json
    try:
        reader.json = lambda self, path: plain(self.option("mode", "FAILFAST"), path)
        for layout in "hy":
            rows = readers.read_latest(spark, str(tmp_path / layout), "k int").select("k").collect()
            assert [r.k for r in rows] == [3]
        with pytest.raises(Exception):
            spark.read.schema("k int").json(str(tmp_path / "h")).collect()
    finally:
        reader.json = plain


def test_latest_complete_run(spark, tmp_path):
    root = str(tmp_path / "runs")
    rows = lambda *ids: spark.createDataFrame([(i, f"d{i % 2}") for i in ids], "id int, dt string")
    stop = rows(7, 8).withColumn("id", F.when(F.col("id") == 8, F.raise_error(F.lit("x")).cast("int")).otherwise(F.col("id")))
    assert sinks.land_run({"a": rows(1), "b": rows(2)}, root, "001", ["dt"]) == {"a": 1, "b": 1}
    assert sinks.land_run({"a": rows(3, 4), "b": stop}, root, "002", ["dt"]) == {"a": 2, "b": None}
    # A driver lost after the files and before the marker.
    _put(tmp_path / "runs/a/run=003/dt=d0/part.json", json.dumps({"id": 9}))
    read = lambda: {tuple(r) for r in readers.read_latest_runs(spark, root, ["a", "b"], "id int").select("collection", "run", "id").collect()}
    assert read() == {("a", "002", 3), ("a", "002", 4), ("b", "001", 2)}
    # The run is repeated: it replaces what it left, the earlier ones stay.
    assert sinks.land_run({"a": rows(5), "b": rows(6)}, root, "003", ["dt"]) == {"a": 1, "b": 1}
    assert read() == {("a", "003", 5), ("b", "003", 6)}
    kept = spark.read.schema("id int, run string").json(f"{root}/a").select("run", "id").collect()
    assert {tuple(r) for r in kept} == {("001", 1), ("002", 3), ("002", 4), ("003", 5)}
    # A run without rows is complete as well.
    assert sinks.land_run({"a": rows(1).where("false")}, root, "004", ["dt"]) == {"a": 0}
    assert read() == {("b", "003", 6)}


def test_array_files_and_extended_json(spark, tmp_path):
    docs = [
        {"_id": {"$oid": "a1"}, "at": {"$date": "2024-01-05T10:00:00Z"}},
        {"_id": "b2", "at": {"$date": {"$numberLong": "1704448800000"}}},
        {"_id": 7, "at": "2024-01-05T10:00:00Z"}, {"at": {"$date": 1704448800000}}, {"_id": {"x": 1}, "at": "bad"},
    ]
    _put(tmp_path / "x" / "f.json", json.dumps(docs, indent=1))
    doc = F.col("doc")
    got = readers.read_array_files(spark, str(tmp_path / "x")).select(
        readers.extended_text(doc, "_id"), readers.extended_time(doc, "at")
    )
    want = dt.datetime(2024, 1, 5, 10)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("a1", want), ("b2", want), ("7", want), (None, want), (None, None)], key=str
    )


def test_paths():
    assert readers.normalize_path("s3://b/k") == ("s3a://b/k", "json")
    assert readers.normalize_path("hdfs://h/x.parquet/") == ("hdfs://h/x.parquet/", "parquet")
    with pytest.raises(ValueError):
        readers.normalize_path("https://host/file.json")


def test_json_documents(spark):
    df = spark.sql("SELECT 1L AS id, timestamp_ntz'2024-01-05 10:00:00' AS n, timestamp'2024-01-05 10:00:00' AS t, 'é' AS s")
    assert json.loads(sinks.to_json_doc(df).first()[0]) == {
        "id": 1, "n": "2024-01-05T10:00:00.000000", "t": "2024-01-05T10:00:00.000000", "s": "é",
    }
