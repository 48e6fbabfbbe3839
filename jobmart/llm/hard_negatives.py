"""Operator 13, hard-negative mining by segment summary filtering.

An anchor's positives are its best other rows of the same label, its negatives the best
rows of another label whose score lies within a band below a positive's score. A score
is the inner product of integer vectors. For each segment of a vector its mean and
deviation are kept; over a segment of length L an inner product is L times the means'
product, plus or minus L times the deviations' product, at most (Cauchy-Schwarz). These
bounds, first of ``LEVELS[0]`` segments for all pairs of a step, then of the finer
segments for the pairs that are left, rule out pairs that cannot enter the lists; only
the rest is scored, exactly, in 64-bit integers.

The anchors are a stated query set against all rows, in blocks: chunks of at most about
``CHUNK_BYTES`` of anchors go to every task, and a chunk's two passes (positives, then
negatives) stream all rows through it. A task sends its best rows of each anchor only,
so no label or anchor gathers rows in one task, whatever its size.

Defined results: rows with a null id, a null label, a null or empty vector, or a null or
non-finite component take no part, nor do those whose squared norm reaches 2^62 (their
products might not fit 64 bits). Vectors of different lengths are not compared. A row is
known by its id: rows that repeat an id are no partners of each other, and equal scores
of one id count once; an anchor row repeated as a whole is one anchor. Ties go to the
smaller id. Without rows or anchors the result is empty; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobmart.llm.common import read_table, saved

SCALE = 256.0
POSITIVES, NEGATIVES = 5, 3
LOW_PERCENT, HIGH_PERCENT = 50, 95
LEVELS = (4, 16)
CHUNK_BYTES = 16 << 20
STEP_PAIRS = 1 << 20
NORM_LIMIT = 2.0**62


class Vectors:
    """Integer vectors of one length with their summaries."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, values: np.ndarray):
        self.ids, self.labels, self.values = ids, labels, values
        self.norm = np.sqrt((values.astype(np.float64) ** 2).sum(1))
        self.levels = [self._summary(min(x, values.shape[1])) for x in LEVELS]

    def _summary(self, segments: int) -> tuple[np.ndarray, np.ndarray]:
        """Means and deviations, each times the root of the segment's length."""
        n, dim = self.values.shape
        length = -(-dim // segments)
        padded = np.zeros((n, length * segments))
        padded[:, :dim] = self.values
        parts = padded.reshape(n, segments, length)
        mean = parts.mean(2)
        deviation = np.sqrt(((parts - mean[:, :, None]) ** 2).sum(2))
        return mean * np.sqrt(length), deviation

    def take(self, rows) -> Vectors:
        new = object.__new__(Vectors)
        new.ids, new.labels, new.values, new.norm = self.ids[rows], self.labels[rows], self.values[rows], self.norm[rows]
        new.levels = [(m[rows], d[rows]) for m, d in self.levels]
        return new


def bounds(a: Vectors, b: Vectors) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of every pair, by the coarsest segments; a little wider
    than rounding could shift them."""
    (am, ad), (bm, bd) = a.levels[0], b.levels[0]
    middle, radius = am @ bm.T, ad @ bd.T
    radius += 1e-9 * np.outer(a.norm, b.norm) + 1e-6
    return middle - radius, middle + radius


def pair_bounds(a: Vectors, b: Vectors, i: np.ndarray, j: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    (am, ad), (bm, bd) = a.levels[level], b.levels[level]
    middle = np.einsum("ij,ij->i", am[i], bm[j])
    radius = np.einsum("ij,ij->i", ad[i], bd[j]) + 1e-9 * a.norm[i] * b.norm[j] + 1e-6
    return middle - radius, middle + radius


def exact(a: Vectors, b: Vectors, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i), dtype=np.int64)
    step = max(STEP_PAIRS // a.values.shape[1], 1)
    for k in range(0, len(i), step):
        out[k : k + step] = (a.values[i[k : k + step]] * b.values[j[k : k + step]]).sum(1)
    return out


class Best:
    """The best ``size`` (score, id) of each list, higher scores first, ties by smaller id."""

    def __init__(self, lists: int, size: int):
        self.size = size
        self.list = np.zeros(0, dtype=np.int64)
        self.score = np.zeros(0, dtype=np.int64)
        self.id = np.zeros(0, dtype=np.int64)
        self.floor = np.full(lists, -np.inf)

    def add(self, where: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(where):
            return
        where, score, ids = (np.concatenate(x) for x in ((self.list, where), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, where))
        where, score, ids = where[order], score[order], ids[order]
        same = (where[1:] == where[:-1]) & (score[1:] == score[:-1]) & (ids[1:] == ids[:-1])
        own = np.append(True, ~same)
        where, score, ids = where[own], score[own], ids[own]
        rank = np.arange(len(where)) - np.searchsorted(where, where)
        own = rank < self.size
        self.list, self.score, self.id = where[own], score[own], ids[own]
        full = rank == self.size - 1
        self.floor[where[full]] = score[full]


def _vectors(batch: pa.RecordBatch, scale: float) -> dict[int, Vectors]:
    """The batch's usable rows by length: columns id, label (text), vector."""
    column = batch.column("vector")
    usable = column.is_valid().to_numpy(zero_copy_only=False)
    usable &= batch.column("id").is_valid().to_numpy(zero_copy_only=False)
    usable &= batch.column("label").is_valid().to_numpy(zero_copy_only=False)
    flat = column.flatten().cast(pa.float64())
    values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    start = np.cumsum(lengths) - lengths
    ids = batch.column("id").fill_null(0).to_numpy(zero_copy_only=False)
    labels = np.array(batch.column("label").to_pylist(), dtype=object)
    out = {}
    for length in np.unique(lengths[usable]):
        rows = np.flatnonzero(usable & (lengths == length))
        if not length:
            continue
        with np.errstate(over="ignore", invalid="ignore"):
            x = np.floor(scale * values[start[rows][:, None] + np.arange(length)])
            fits = (x**2).sum(1) < NORM_LIMIT  # false for what is not finite
        rows = rows[fits]
        if len(rows):
            out[int(length)] = Vectors(ids[rows], labels[rows], x[fits].astype(np.int64))
    return out


def _steps(v: Vectors, anchors: int) -> Iterator[Vectors]:
    step = max(STEP_PAIRS // max(anchors, 1), 16)
    for at in range(0, len(v.ids), step):
        yield v.take(slice(at, at + step))


def _positives(chunk, scale: float, count: int):
    """A task's best same-label rows of each anchor: (slot, id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length = chunk.value
        best = Best(sum(len(a.ids) for a, _ in by_length.values()), count)
        for batch in batches:
            for length, rows in _vectors(batch, scale).items():
                if length not in by_length:
                    continue
                anchors, slots = by_length[length]
                for label in set(rows.labels) & set(anchors.labels):
                    own = np.flatnonzero(anchors.labels == label)
                    a, slot = anchors.take(own), slots[own]
                    for b in _steps(rows.take(rows.labels == label), len(own)):
                        _, high = bounds(a, b)
                        ok = (high >= best.floor[slot][:, None]) & (a.ids[:, None] != b.ids[None, :])
                        i, j = np.nonzero(ok)
                        for level in range(1, len(LEVELS)):
                            _, high = pair_bounds(a, b, i, j, level)
                            ok = high >= best.floor[slot[i]]
                            i, j = i[ok], j[ok]
                        best.add(slot[i], exact(a, b, i, j), b.ids[j])
        yield _rows(["slot", "id", "score"], [best.list, best.id, best.score])

    return run


def _negatives(chunk, wanted, scale: float, count: int):
    """A task's best rows of another label within the band of each (anchor, positive)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length = chunk.value
        first, low, high = wanted.value  # by list: of a slot the lists first[slot] to first[slot + 1]
        best = Best(len(low), count)
        widest = int(np.diff(first).max(initial=0))
        for batch in batches:
            for length, rows in _vectors(batch, scale).items():
                if length not in by_length:
                    continue
                a, slot = by_length[length]
                for b in _steps(rows, len(a.ids)):
                    least, most = bounds(a, b)
                    other = a.labels[:, None] != b.labels[None, :]
                    ok = np.zeros(other.shape, dtype=bool)
                    for k in range(widest):
                        has = np.flatnonzero(first[slot] + k < first[slot + 1])
                        at = first[slot[has]] + k
                        need = np.maximum(low[at], best.floor[at])
                        ok[has] |= (most[has] >= need[:, None]) & (least[has] <= high[at][:, None])
                    i, j = np.nonzero(ok & other)
                    for level in range(1, len(LEVELS)):
                        least, most = pair_bounds(a, b, i, j, level)
                        keep = np.zeros(len(i), dtype=bool)
                        for k in range(widest):
                            at = np.minimum(first[slot[i]] + k, first[slot[i] + 1] - 1)
                            keep |= (most >= np.maximum(low[at], best.floor[at])) & (least <= high[at])
                        i, j = i[keep], j[keep]
                    score = exact(a, b, i, j)
                    for k in range(widest):
                        at = first[slot[i]] + k
                        own = at < first[slot[i] + 1]
                        at = np.minimum(at, len(low) - 1)
                        own &= (score >= low[at]) & (score <= high[at])
                        best.add(at[own], score[own], b.ids[j[own]])
        yield _rows(["list", "id", "score"], [best.list, best.id, best.score])

    return run


def _rows(names: list[str], columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=names)


def _best(rows: DataFrame, key: str, count: int) -> DataFrame:
    """The best ``count`` (id, score) of each ``key``, with their rank."""
    order = Window.partitionBy(key).orderBy(F.col("score").desc(), "id")
    return rows.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def mine(
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    scale: float = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low_percent: int = LOW_PERCENT,
    high_percent: int = HIGH_PERCENT,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = rows.sparkSession
    table = rows.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    anchors = table.where("anchor and id is not null and label is not null and vector is not null").drop("anchor").distinct()
    size = anchors.agg(F.sum(F.size("vector") * 8 + 64).alias("bytes")).first()["bytes"] or 0
    chunks = int(size // CHUNK_BYTES) + 1
    anchors = saved(anchors.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks))), "anchors")
    table = table.drop("anchor")
    results = []
    for number in range(chunks):
        taken = anchors.where(F.col("chunk") == number).drop("chunk").orderBy("id", "label", "vector").toArrow()
        by_length, slot_ids = {}, []
        for batch in taken.combine_chunks().to_batches():
            for length, vectors in _vectors(batch, scale).items():
                slots = np.arange(len(vectors.ids)) + len(slot_ids)
                slot_ids += vectors.ids.tolist()
                by_length[length] = (vectors, slots)
        if not slot_ids:
            continue
        chunk = spark.sparkContext.broadcast(by_length)
        local = table.mapInArrow(_positives(chunk, scale, positives), "slot long, id long, score long")
        own = saved(_best(local, "slot", positives), "positives").orderBy("slot", "rank").toPandas()
        slot, score = own["slot"].to_numpy(), own["score"].to_numpy()
        # In integers: low_percent * p <= 100 * n <= high_percent * p.
        low, high = -((-low_percent * score) // 100), high_percent * score // 100
        first = np.searchsorted(slot, np.arange(len(slot_ids) + 1))
        wanted = spark.sparkContext.broadcast((first, low, high))
        local = table.mapInArrow(_negatives(chunk, wanted, scale, negatives), "list long, id long, score long")
        lists = spark.createDataFrame(
            pa.table(
                {
                    "list": pa.array(np.arange(len(own)), pa.int64()),
                    "anchor_id": pa.array(np.array(slot_ids, dtype=np.int64)[slot], pa.int64()),
                    "positive_id": pa.array(own["id"].to_numpy(), pa.int64()),
                    "positive_score": pa.array(score, pa.int64()),
                }
            )
        )
        results.append(saved(_best(local, "list", negatives).join(lists, "list"), "negatives"))
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    out = spark.createDataFrame([], schema)
    for found in results:
        out = out.unionByName(
            found.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        )
    return out


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor of ``embeddings`` among all its rows."""
    rows = read_table(spark, sf_dir, "embeddings").select(
        "vec_id", F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)").alias("label"), "embedding"
    )
    return mine(rows, F.expr("vec_id % 50 = 0"))


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS alike,
         CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN pairs USING (anchor_id)
WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
