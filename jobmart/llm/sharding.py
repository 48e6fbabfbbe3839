"""Operator 7, sharding by extendible hashing, DataFrame functions only.

Each row has a hash, written as a string of bits. The directory begins with one bucket;
a bucket whose rows exceed the byte limit splits on its next bit, the others stay, until
every bucket fits. As a bucket's bytes can only shrink with its prefix, the depth of a
leaf is the number of its prefixes that exceed the limit. So the directory needs no
loop over rows: bytes are summed once per cell of a fine hash prefix, a rollup of the
cells gives the bytes of every prefix, and only cells that are still too large at the
finest prefix are looked at again, ``STEP_BITS`` bits deeper.

Rows with equal keys have equal hashes: 60 bits come from the id and the text, then 60
from the row's number in the written key table, so equal rows split, too. A single row
larger than the limit can't be split: it gets a bucket of its own (``oversized``).

Defined results: a null text has no bytes, null ids are hashed like any value; an
empty table has no shards. Columns other than id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.llm.common import read_table, saved

SHARD_BYTES = 1 << 20
HASH_BITS = 60
STEP_BITS = 12


def _bits(text: Column) -> Column:
    """The first 60 bits of the MD5 of ``text``, as a string of 0 and 1."""
    return F.lpad(F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 2), HASH_BITS, "0")


def hash_keys(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, bits): the rows as the directory sees them, without their texts."""
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit("")))
    return docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        _bits(name).alias("_own"),
        F.monotonically_increasing_id().alias("_row"),
    ).select("doc_id", "n_bytes", F.concat("_own", _bits(F.concat("_own", F.lit(":"), F.col("_row").cast("string")))).alias("bits"))


def _depths(cells: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """(cell, depth): for cells of ``high`` bits in a bucket too large at fewer than
    ``low`` bits, the depth of their leaf; ``high`` + 1 if they are too large themselves."""
    deep = F.explode(F.sequence(F.lit(low), F.lit(high))).alias("d")
    prefixes = cells.select("cell", "n_bytes", "n", deep).withColumn("prefix", F.substring("cell", F.lit(1), F.col("d")))
    large = (
        prefixes.groupBy("d", "prefix").agg(F.sum("n_bytes").alias("n_bytes"), F.sum("n").alias("n"))
        .where((F.col("n_bytes") > limit) & (F.col("n") > 1)).select("d", "prefix")
    )
    split = prefixes.join(large, ["d", "prefix"], "left_semi").groupBy("cell").agg(F.count("*").alias("splits"))
    return cells.join(split, "cell", "left").select("cell", (F.coalesce("splits", F.lit(0)) + low).cast("int").alias("depth"))


def directory(keys: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """(cell, bits, depth): leaves by the hash prefix ``cell`` of ``bits`` bits."""
    total = keys.agg(F.sum("n_bytes")).first()[0] or 0
    high = min(HASH_BITS, max(4, (total // limit).bit_length() + 4))
    low, leaves, rest = 0, None, keys
    while True:
        cells = rest.groupBy(F.substring("bits", 1, high).alias("cell")).agg(
            F.sum("n_bytes").alias("n_bytes"), F.count("*").alias("n")
        )
        found = saved(_depths(cells, low, high, limit).withColumn("bits", F.lit(high)), "directory")
        done = found.where(F.col("depth") <= high)
        leaves = done if leaves is None else leaves.union(done)
        more = found.where(F.col("depth") > high)
        if high == 2 * HASH_BITS or more.isEmpty():
            return leaves if high < 2 * HASH_BITS else leaves.union(more.withColumn("depth", F.lit(high)))
        rest = rest.join(more.select("cell"), F.substring("bits", 1, high) == F.col("cell"), "left_semi")
        low, high = high + 1, min(2 * HASH_BITS, high + STEP_BITS)


def assign(keys: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_bytes, shard, depth, shard_bytes, oversized) for each row of ``keys``;
    ``shard`` is the bucket's prefix ('' for the only one)."""
    keys = saved(keys, "shard-keys")
    leaves = directory(keys, limit)
    widths = [r["bits"] for r in leaves.select("bits").distinct().collect()]  # one for each round of splitting
    placed = None
    for width in sorted(widths):
        own = leaves.where(F.col("bits") == width).select("cell", "depth")
        part = keys.join(own, F.substring("bits", 1, width) == F.col("cell"))
        part = part.select("doc_id", "n_bytes", F.expr("substring(bits, 1, depth)").alias("shard"), "depth")
        placed = part if placed is None else placed.union(part)
    if placed is None:
        placed = keys.select("doc_id", "n_bytes", F.lit("").alias("shard"), F.lit(0).alias("depth"))
    sums = placed.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"))
    return placed.join(sums, "shard").select(
        "doc_id", "n_bytes", "shard", "depth", "shard_bytes", (F.col("shard_bytes") > limit).alias("oversized")
    )


def op7_sharding(spark: SparkSession, sf_dir: str, limit: int = SHARD_BYTES) -> DataFrame:
    """The shard of every document."""
    return assign(hash_keys(read_table(spark, sf_dir, "documents").select("doc_id", "text")), limit)


def oracle(limit: int = SHARD_BYTES, deepest: int = 40) -> str:
    """The same in DuckDB SQL, for distinct rows and buckets of up to ``deepest`` bits."""
    return f"""
WITH t AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
    ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents
),
p AS (SELECT doc_id, n_bytes, h, d, h >> (60 - d) AS prefix FROM t, range(0, {deepest + 1}) r(d)),
large AS (SELECT d, prefix FROM p GROUP BY d, prefix HAVING sum(n_bytes) > {limit} AND count(*) > 1),
leaf AS (
  SELECT t.doc_id, any_value(t.n_bytes) AS n_bytes, any_value(t.h) AS h, count(large.d) AS depth
  FROM t JOIN p ON p.doc_id = t.doc_id LEFT JOIN large ON large.d = p.d AND large.prefix = p.prefix GROUP BY t.doc_id
),
s AS (SELECT doc_id, n_bytes, substr(lpad(bin(h), 60, '0'), 1, CAST(depth AS INT)) AS shard, CAST(depth AS INT) AS depth FROM leaf)
SELECT doc_id, n_bytes, shard, depth, CAST(sum(n_bytes) OVER (PARTITION BY shard) AS BIGINT) AS shard_bytes,
  sum(n_bytes) OVER (PARTITION BY shard) > {limit} AS oversized
FROM s
"""
