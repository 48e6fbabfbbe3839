"""Job-posting documents derived from the driver's TPC-H-style tables.

The test tables hold no postings, so the registered queries derive them
deterministically (the DuckDB oracle builds the same rows from the same base
columns). Every derived row comes from a Spark join/aggregate over the given
tables, so the work grows with them.

Scale notes
-----------
* ``orders ⋈ customer`` is a shuffle (sort-merge) join on the customer key at
  scale; ``nation``/``region`` are fixed 25/5-row dimensions and are left to
  the planner's size-checked broadcast (``autoBroadcastJoinThreshold`` uses
  the scan statistics), never force-broadcast.
* Skills are aggregated per order from ``lineitem ⋈ part``; an order has at
  most a handful of line items (≤ 7 in TPC-H, ≤ 17 in these tables), so the
  per-order list is bounded by the document, like a posting's skill list.
  The aggregate leaves the rows hash-partitioned on the order key, so the
  join back to ``orders`` shuffles only ``orders``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart import schemas as S
from jobmart.session import table_path

# Fixed ingest time for the derived feed, so results repeat run to run (V13
# takes the ingest time as a parameter).
FEED_INGEST_TS = "2024-02-01 00:00:00"
FEED_CURRENCY = "VND"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def feed_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its customer, nation and region names."""
    orders = read_table(
        spark, sf_dir, "orders",
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority",
    )
    customer = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == nation.n_nationkey)
        .join(region, F.col("n_regionkey") == region.r_regionkey)
        .select(
            "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority",
            "c_name", "c_mktsegment", "n_name", "r_name",
        )
    )


def _amounts() -> tuple[Column, Column]:
    low = F.floor("o_totalprice")
    high = low + (F.col("o_custkey") % 10) * 1000
    return low, high


def salary_text(amount: Column, low: Column, high: Column, kind: Column) -> Column:
    """Salary as landed text, one of six shapes chosen by ``kind`` (0..5)."""
    thousands = F.floor(amount / 1000)
    rest = F.lpad((amount % 1000).cast("string"), 3, "0")
    return (
        F.when(kind == 0, amount.cast("string"))
        .when(kind == 1, F.concat(F.lit("$"), thousands.cast("string"), F.lit(","), rest))
        .when(
            kind == 2,
            F.concat(
                F.floor(low / 1000).cast("string"), F.lit("-"),
                F.floor(high / 1000).cast("string"), F.lit(" trieu"),
            ),
        )
        .when(kind == 3, F.lit("Thoa thuan"))
        .when(kind == 4, F.concat(thousands.cast("string"), F.lit("."), rest, F.lit(".000")))
    )


def posted_text(kind: Column) -> Column:
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    return (
        F.when(kind == 0, F.lit("05/01/2024"))
        .when(kind == 1, F.concat(iso, F.lit("T23:30:00-07:00")))
        .when(kind == 2, F.lit(""))
        .otherwise(iso)
    )


def order_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, skills): part types of an order's lines in line order."""
    lineitem = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber")
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_type")
    lines = lineitem.join(part, lineitem.l_partkey == part.p_partkey)
    return lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "p_type"))),
            lambda x: x["p_type"],
        ).alias("skills")
    )


def job_feed(
    spark: SparkSession,
    sf_dir: str,
    with_skills: bool = False,
    ingest_ts: str = FEED_INGEST_TS,
) -> DataFrame:
    """Flattened posting documents as landed (salary and dates still text)."""
    base = feed_base(spark, sf_dir)
    low, high = _amounts()
    k6 = F.col("o_orderkey") % 6
    k7 = F.col("o_orderkey") % 7
    k11 = F.col("o_orderkey") % 11
    doc = base.select(
        F.col("o_orderkey"),
        F.col("o_orderkey").cast("string").alias("jobId"),
        F.lit(S.SOURCE_API).alias("source"),
        F.concat(
            F.lit(S.JOB_URL_TEMPLATE_PREFIX), F.col("o_orderkey").cast("string"),
            F.lit(S.JOB_URL_TEMPLATE_SUFFIX),
        ).alias("jobUrl"),
        F.col("o_orderpriority").alias("jobTitle"),
        F.col("c_mktsegment").alias("jobLevel"),
        F.col("c_name").alias("companyName"),
        F.when(k7 == 0, F.array(F.col("r_name"), F.lit(None).cast("string")))
        .otherwise(F.array(F.col("r_name")))
        .alias("workingLocations"),
        F.when(k7 == 0, F.lit(None).cast("array<string>"))
        .when(k7 == 1, F.array().cast("array<string>"))
        .otherwise(F.array(F.col("n_name")))
        .alias("cities"),
        salary_text(low, low, high, k6).alias("salaryMin"),
        salary_text(high, low, high, k6).alias("salaryMax"),
        F.lit(FEED_CURRENCY).alias("salaryCurrency"),
        posted_text(k11).alias("postedDate"),
        F.lit(ingest_ts).cast("timestamp").alias("crawled_at"),
    )
    if with_skills:
        doc = doc.join(order_skills(spark, sf_dir), "o_orderkey", "left")
    return doc.drop("o_orderkey")
