"""Readers for landed raw documents and marts.

* Explicit schemas (or a VARIANT column) instead of inference: inference
  is an extra full scan, and one stray value flips a column's type.
* Landed JSON is JSON Lines (splittable); legacy whole-file arrays are read
  with ``multiLine`` into one VARIANT per file and unnested.
* The latest day and the latest complete run are subqueries over file metadata and run
  markers, so that the scan prunes its partitions at run time; only single values reach
  the driver.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.functions.variant import evaluate_once, unnest_documents
from jobmart.schemas import RUN_MARKER_DDL, RUN_MARKERS


def normalize_path(path: str) -> tuple[str, str]:
    """S3: map ``s3://`` to ``s3a://`` and pick the format by suffix
    (``.parquet`` -> parquet, else JSON). Unlike the original script, a
    ``.parquet`` path is read as parquet. A scheme that Spark's file systems do not
    serve is an error."""
    if path.startswith("s3://"):
        path = "s3a://" + path[len("s3://"):]
    scheme = path.split("://", 1)[0].lower() if "://" in path else ""
    if scheme in ("http", "https", "ftp", "mongodb", "jdbc"):
        raise ValueError(f"can't read {scheme}:// paths; land the files in a file system or object store")
    fmt = "parquet" if re.search(r"\.parquet/?$", path) else "json"
    return path, fmt


def read_raw(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON Lines with an explicit DDL schema, or one VARIANT per document."""
    path, fmt = normalize_path(path)
    if fmt == "parquet":
        return spark.read.parquet(path)
    if schema:
        return spark.read.schema(schema).json(path)
    return spark.read.option("singleVariantColumn", "doc").json(path)


def read_collections(spark: SparkSession, root: str, names: list[str], schema: str) -> DataFrame:
    """The landed collections ``names`` below ``root``, each row with its collection."""
    parts = [
        read_raw(spark, f"{root}/{name}", schema).withColumn("collection", F.lit(name)) for name in names
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_array_files(spark: SparkSession, path: str) -> DataFrame:
    """S1 for legacy snapshot files: each file holds one JSON array (or one
    object). Multi-line JSON is not splittable, so each file is one task;
    land to JSON Lines once and read that afterwards."""
    files = spark.read.option("multiLine", True).option("singleVariantColumn", "file").json(path)
    return files.select(unnest_documents(F.col("file")).alias("doc"))


def read_array_files_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S1 for legacy snapshot files, broken ones put aside: the documents (``doc``) with the
    file they come from, and one reject for each file that is empty, no JSON (cut off,
    for one) or holds no document: its path, what is wrong, and its length."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    files = files.select(F.col("_metadata.file_path").alias("file_path"), "value")
    files = evaluate_once(files, F.try_parse_json("value"), "_file")
    kind = F.schema_of_variant("_file")
    files = files.withColumn(
        "reason",
        F.when(~F.col("value").rlike(r"\S"), F.lit("empty"))
        .when(F.col("_file").isNull(), F.lit("not json"))
        .when(~(kind.startswith("ARRAY") | kind.startswith("OBJECT")), F.lit("no document")),
    )
    rejects = files.where("reason is not null").select("file_path", "reason", F.length("value").alias("chars"))
    docs = files.where("reason is null").select("file_path", unnest_documents(F.col("_file")).alias("doc"))
    return docs, rejects


def with_file_times(df: DataFrame, time_col: str = "crawled_at", file_col: str = "source_file") -> DataFrame:
    """Ingest time and source file of each row of a file read, from the file's own
    metadata, so that reading again gives the same."""
    return df.withColumns(
        {time_col: F.col("_metadata.file_modification_time"), file_col: F.col("_metadata.file_path")}
    )


_DAY_IN_PATH = r"/(\d{4})/(\d{2})/(\d{2})/"


def _days(files: DataFrame) -> DataFrame:
    """The newest day of landed files as one value; an error where no file has a day. The
    files' own metadata say it: none is opened."""
    if "dt" in files.columns:
        day = F.col("dt").cast("string").try_cast("date")
    else:
        parts = [F.regexp_extract("path", _DAY_IN_PATH, i) for i in (1, 2, 3)]
        day = F.concat_ws("-", *parts).try_cast("date")
    return files.select(F.max(day).alias("day")).select(
        F.coalesce("day", F.raise_error(F.lit("no day folders")).cast("date")).alias("day")
    )


def read_latest(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """S1+S2: read only the latest day's files. With ``dt=`` folders (below any other
    level) the newest day is a subquery in the scan's partition filters, so it is found and
    the other days are left out at run time. With ``Y/m/d`` folders it is one value that the
    scan's file filter holds. Files without a valid day (the default partition's, for one)
    never are the latest; where no file has one the read fails."""
    root, _ = normalize_path(root)
    files = spark.read.format("binaryFile").load(root)
    rows = spark.read.schema(schema)
    if "dt" in files.columns:
        return rows.json(root).where(F.col("dt").cast("string").try_cast("date") == _days(files).scalar())
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    newest = _days(files).first()["day"]
    rows = rows.option("recursiveFileLookup", True).json(root)
    return rows.where(F.col("_metadata.file_path").contains(f"/{newest:%Y/%m/%d}/"))


def read_latest_runs(spark: SparkSession, root: str, names: list[str], schema: str) -> DataFrame:
    """Of each collection landed by ``land_run`` the newest complete run, with the
    columns ``collection`` and ``run``. A run without its marker is not read, however many
    files it left; a collection without a complete run gives no rows."""
    markers = spark.read.schema(RUN_MARKER_DDL).json(f"{root}/{RUN_MARKERS}")
    parts = []
    for name in names:
        newest = markers.where(F.col("collection") == name).select(F.max("run"))
        rows = spark.read.schema(f"{schema}, run string").json(f"{root}/{name}")
        parts.append(rows.where(F.col("run") == newest.scalar()).withColumn("collection", F.lit(name)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def extended_text(v: Column, field: str) -> Column:
    """An id field of a document: ``{"$oid": text}`` or a plain value, as text."""
    return F.coalesce(
        F.try_variant_get(v, f"$.{field}['$oid']", "string"),
        F.when(~F.schema_of_variant(F.try_variant_get(v, f"$.{field}", "variant")).startswith("OBJECT"),
               F.try_variant_get(v, f"$.{field}", "string")),
    )


def extended_time(v: Column, field: str) -> Column:
    """A time field: ``{"$date": ISO text or epoch milliseconds}`` or ISO text, as a timestamp."""
    path = f"$.{field}['$date']"
    millis = F.coalesce(
        F.try_variant_get(v, f"{path}['$numberLong']", "bigint"), F.try_variant_get(v, path, "bigint")
    )
    text = F.coalesce(F.try_variant_get(v, path, "string"), F.try_variant_get(v, f"$.{field}", "string"))
    return F.coalesce(F.timestamp_millis(millis), F.try_to_timestamp(text))
