"""Operator 8, embedding near-duplicates: iterative quantisation and multi-index hashing.

``learn`` fits, on about ``SAMPLE`` vectors of each dimension (a hash of the vector
chooses), the principal axes and the rotation that make the signs of a vector's
coordinates a balanced code (iterative quantisation); dimensions below 64 get the rest
of their 64 bits from further, random rotations of the same axes. Every vector is coded.
A multi-index of the codes has several tables, each for a substring of the bits (read
in a circle): a code is entered under its substring and under those that differ in one
bit, so codes whose substrings differ in up to two bits meet. ``multi_index`` sets the
substrings' width by the logarithm of the largest label's size, at every size, so that
buckets of balanced codes keep their size as the table grows, and the number of tables
by the share of pairs at the threshold that may miss each other (``MISSED``). Pairs
whose codes differ in at most ``RADIUS`` bits are ranked again by the cosine of the
original vectors in double precision, once, in the first bucket (a function of the two
codes alone) that they share.

Only vectors of equal label and dimension are compared. Equal vectors of a label form a
class first, so copies are compared once. Buckets are split into blocks; pieces emit
sums of links and a spanning forest, never all pairs.

Defined results: vectors that are null, empty, zero, or hold nulls or non-finite
values, and those without a label link with nothing and are their own component. Rows
with one id are separate vectors of that id; null ids come last. Components are named
by their smallest vec_id. An empty table gives no rows. Vectors are scaled by powers of
two before their norms are taken, so very large or small components neither overflow
nor vanish, and other cosines keep every bit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.llm import buckets
from jobmart.llm.common import read_table, saved
from jobmart.llm.components import components

COSINE, BITS, RADIUS, SAMPLE, ROUNDS = 0.93, 64, 18, 20_000, 30
LEAST_WIDTH, LEAST_TABLES, SPARE_BITS, MISSED = 12, 4, 4, 0.01


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times the power of two that brings their largest component to [0.5, 1)."""
    _, exponent = np.frexp(np.abs(vectors).max(1, keepdims=True))
    return np.ldexp(vectors, -exponent)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1."""
    x = scaled(vectors)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Quantiser:
    """Centre of the vectors of one dimension, and their projection on the code's bits."""

    def __init__(self, centre: np.ndarray, project: np.ndarray):
        self.centre, self.project = centre, project

    @classmethod
    def fitted(cls, sample: np.ndarray) -> Quantiser:
        rng = np.random.default_rng(7)
        dim = sample.shape[1]
        centre = sample.mean(0)
        # Principal axes from the dim x dim scatter matrix: nothing grows with the sample.
        _, axes = np.linalg.eigh((sample - centre).T @ (sample - centre))
        axes = axes[:, ::-1][:, : min(dim, BITS)]
        flat = (sample - centre) @ axes
        turn, _ = np.linalg.qr(rng.standard_normal((axes.shape[1], axes.shape[1])))
        for _ in range(ROUNDS):
            signs = np.where(flat @ turn >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(signs.T @ flat)
            turn = (left @ right).T
        parts = [axes @ turn]
        while sum(p.shape[1] for p in parts) < BITS:
            parts.append(axes @ np.linalg.qr(rng.standard_normal((axes.shape[1], axes.shape[1])))[0])
        return cls(centre, np.concatenate(parts, axis=1)[:, :BITS])

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        bits = (vectors - self.centre) @ self.project >= 0
        out = np.zeros(len(vectors), dtype=np.uint64)
        for k in range(bits.shape[1]):
            out |= bits[:, k].astype(np.uint64) << np.uint64(k)
        return out.view(np.int64)


def _fit(pdf: pd.DataFrame) -> pd.DataFrame:
    found = Quantiser.fitted(unit(np.stack(pdf["vector"].to_numpy()).astype(np.float64)))
    return pd.DataFrame({"dim": [pdf["dim"].iloc[0]], "centre": [found.centre], "project": [found.project.ravel()]})


def learn(vectors: DataFrame) -> dict[int, Quantiser]:
    """A quantiser for each dimension, from about SAMPLE vectors of each, all fitted in
    one job; vectors of a dimension with fewer than two sampled stay without one."""
    # One row for each length of vectors: no more of them than the longest has components.
    sizes = vectors.groupBy("dim").agg(F.count("*").alias("_all"))
    place = F.pmod(F.xxhash64("cls"), F.lit(1 << 20))
    sample = vectors.join(F.broadcast(sizes), "dim").where(place * F.col("_all") < F.lit(SAMPLE << 20))
    fitted = sample.select("dim", "vector").groupBy("dim").applyInPandas(
        lambda pdf: _fit(pdf) if len(pdf) > 1 else pdf[["dim"]].iloc[:0].assign(centre=None, project=None),
        "dim int, centre array<double>, project array<double>",
    )
    return {
        r["dim"]: Quantiser(np.array(r["centre"]), np.array(r["project"]).reshape(r["dim"], BITS))
        for r in fitted.collect()
    }


def _coded(quantisers: dict[int, Quantiser]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            code = np.zeros(len(pdf), dtype=np.int64)
            for dim, index in pdf.groupby("dim").groups.items():
                at = pdf.index.get_indexer(index)
                if dim in quantisers:
                    x = np.stack(pdf["vector"].to_numpy()[at]).astype(np.float64)
                    code[at] = quantisers[dim].codes(unit(x))
            yield pdf[["cls", "label", "dim"]].assign(code=code)

    return run


@dataclass(frozen=True)
class MultiIndex:
    """Substrings of ``width`` bits of a code read in a circle, one from each of ``starts``."""

    width: int
    starts: tuple[int, ...]

    def substring(self, code: np.ndarray, table: int) -> np.ndarray:
        bits, start = code.view(np.uint64), self.starts[table]
        turned = (bits >> np.uint64(start)) | (bits << np.uint64(-start % BITS))
        return turned & np.uint64((1 << self.width) - 1)

    def column(self) -> Column:
        """The substring of the column ``code`` in the table ``tbl``."""
        start = F.element_at(F.array(*(F.lit(s) for s in self.starts)), F.col("tbl") + 1)
        turned = F.call_function("shiftrightunsigned", F.col("code"), start).bitwiseOR(
            F.call_function("shiftleft", F.col("code"), F.lit(BITS) - start)
        )
        return turned.bitwiseAND(F.lit((1 << self.width) - 1).cast("long"))


def multi_index(largest: int, cosine: float = COSINE) -> MultiIndex:
    """The index for labels of up to ``largest`` codes: SPARE_BITS wider than its logarithm,
    with so many tables that of pairs at ``cosine``, whose bits differ with the chance
    acos(cosine) / pi, a share of MISSED or less differ in three bits in all of them."""
    width = min(BITS - 2, max(LEAST_WIDTH, math.ceil(math.log2(max(largest, 1))) + SPARE_BITS))
    p = math.acos(min(max(cosine, 0.0), 1.0)) / math.pi
    meet = sum(math.comb(width, k) * p**k * (1 - p) ** (width - k) for k in range(3))
    tables = LEAST_TABLES if meet >= 1 else max(LEAST_TABLES, math.ceil(math.log(MISSED) / math.log1p(-meet)))
    # More tables than starts would repeat substrings.
    tables = min(tables, BITS)
    return MultiIndex(width, tuple(t * BITS // tables for t in range(tables)))


def _entries(codes: DataFrame, index: MultiIndex) -> DataFrame:
    """(bucket, key, tbl, cls, code): each code in each table under its substring and
    under those that differ in one bit."""
    tables = F.explode(F.sequence(F.lit(0), F.lit(len(index.starts) - 1))).alias("tbl")
    rows = codes.select("*", tables).withColumn("sub", index.column())
    flips = F.array(F.lit(0).cast("long"), *(F.lit(1 << k).cast("long") for k in range(index.width)))
    rows = rows.withColumn("key", F.explode(F.transform(flips, lambda f: F.col("sub").bitwiseXOR(f))))
    bucket = F.xxhash64("label", "dim", "tbl", "key")
    return rows.select(bucket.alias("bucket"), "key", "tbl", "cls", "code")


def _meetings(pdf: pd.DataFrame, index: MultiIndex) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows within RADIUS whose first common bucket is this one."""
    code = pdf["code"].to_numpy()
    key = pdf["key"].to_numpy().astype(np.uint64)
    table = pdf["tbl"].to_numpy()
    tables = len(index.starts)
    subs = np.stack([index.substring(code, t) for t in range(tables)])
    for i, j in buckets.row_pairs(pdf["_piece"].to_numpy(), pdf["_side"].to_numpy()):
        near = np.bitwise_count((code[i] ^ code[j]).view(np.uint64)) <= RADIUS
        i, j = i[near], j[near]
        if not len(i):
            continue
        first = np.full(len(i), tables)
        for t in range(tables - 1, -1, -1):
            first[np.bitwise_count(subs[t, i] ^ subs[t, j]) <= 2] = t
        ok = first == table[i]
        i, j = i[ok], j[ok]
        a, b = subs[table[i], i], subs[table[i], j]
        differ = a ^ b
        # Equal substrings meet under their own key first; one apart, under either: the
        # smaller; two apart, under the two keys between: the smaller.
        low_bit = differ & (~differ + np.uint64(1))
        two = np.bitwise_count(differ) == 2
        meet = np.where(two, np.minimum(a ^ low_bit, b ^ low_bit), np.minimum(a, b))
        ok = meet == key[i]
        if ok.any():
            yield i[ok], j[ok]


def _needed(index: MultiIndex):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in buckets.by_piece(batches):
            hit = np.zeros(len(pdf), dtype=bool)
            for i, j in _meetings(pdf, index):
                hit[i] = hit[j] = True
            yield pdf.loc[hit, ["_piece", "_side", "bucket", "key", "tbl", "cls", "code"]]

    return run


def _linked(least: float, index: MultiIndex):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in buckets.by_piece(batches, 512):
            links = np.zeros(len(pdf), dtype=np.int64)
            members = pdf["members"].to_numpy()
            vector = [np.asarray(v, dtype=np.float64) for v in pdf["vector"]]
            one, two = [], []
            for i, j in _meetings(pdf, index):
                # Rows of a bucket have one dimension, but two buckets may differ.
                for a in range(0, len(i), 20_000):
                    p, q = i[a : a + 20_000], j[a : a + 20_000]
                    size = np.array([len(vector[k]) for k in p])
                    for dim in np.unique(size):
                        r, s = p[size == dim], q[size == dim]
                        x, y = (scaled(np.stack([vector[k] for k in side])) for side in (r, s))
                        cosine = (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))
                        ok = cosine >= least
                        one.append(r[ok])
                        two.append(s[ok])
            if not one:
                continue
            i, j = np.concatenate(one), np.concatenate(two)
            np.add.at(links, i, members[j])
            np.add.at(links, j, members[i])
            cls = pdf["cls"].to_numpy()
            hit = np.flatnonzero(links)
            yield pd.DataFrame({"cls": cls[hit], "other": None, "links": links[hit]}).astype({"other": "Int64"})
            i, j = buckets.forest(i, j, len(pdf))
            yield pd.DataFrame({"cls": cls[i], "other": cls[j], "links": 0}).astype({"other": "Int64"})

    return run


def vector_classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows (vec_id, row class) and classes (cls, label, dim, vector, first, members)."""
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    valid = F.coalesce(
        F.col("label").isNotNull() & (F.size("embedding") > 0) & finite & F.exists("embedding", lambda x: x != 0),
        F.lit(False),
    )
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding", valid.alias("valid"))
    good = rows.where("valid")
    # -0.0 and 0.0 are one value.
    same = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
    good = good.select("vec_id", "label", F.col("embedding").alias("vector"), F.xxhash64("label", same).alias("cls"))
    classes = good.groupBy("cls").agg(
        F.first("label").alias("label"), F.min(F.coalesce("vec_id", F.lit((1 << 63) - 1))).alias("first"),
        F.count("*").alias("members"), F.first("vector").alias("vector"),
    )
    return rows, classes.withColumn("dim", F.size("vector"))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding, label)."""
    _, found = vector_classes(vectors)
    classes = saved(found, "vectors")
    quantisers = learn(classes)
    coded = saved(
        classes.select("cls", "label", "dim", "vector").mapInPandas(
            _coded(quantisers), classes.select("cls", "label", "dim").schema.add("code", "long")
        ),
        "codes",
    )
    largest = coded.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    index = multi_index(largest, cosine)
    pieces = buckets.dealt(_entries(coded, index), "bucket", "cls")
    schema = "_piece long, _side int, bucket long, key long, tbl int, cls long, code long"
    needed = saved(buckets.sorted_pieces(pieces).mapInPandas(_needed(index), schema), "met")
    full = needed.join(classes.select("cls", "members", "vector").hint("merge"), "cls")
    linked = saved(
        buckets.sorted_pieces(full).mapInPandas(_linked(cosine, index), "cls long, other long, links long"), "linked"
    )
    sums = linked.where("other is null").groupBy("cls").agg(F.sum("links").alias("links"))
    name = classes.select("cls", F.struct("first", "cls").alias("v")).hint("merge")
    edges = (
        linked.where("other is not null").select("cls", "other").join(name.select("cls", F.col("v").alias("u")), "cls")
        .join(name.select(F.col("cls").alias("other"), "v"), "other").select("u", "v")
    )
    group = components(edges).select(F.col("vertex.cls").alias("cls"), F.col("component.first").alias("component"))
    info = classes.select("cls", "first", "members")
    info = info.join(sums.hint("merge"), "cls", "left").join(group.hint("merge"), "cls", "left")
    same = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
    rows, _ = vector_classes(vectors)
    rows = rows.select("vec_id", F.when(F.col("valid"), F.xxhash64("label", same)).alias("cls"))
    out = rows.join(info.hint("merge"), "cls", "left").select(
        "vec_id",
        (F.coalesce("members", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "first", "vec_id").alias("component_id"),
    )
    last = F.lit((1 << 63) - 1)
    out = out.withColumn("component_id", F.when(F.col("component_id") != last, F.col("component_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of every vector of ``embeddings``."""
    return near_duplicates(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


ORACLE = """
WITH v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
l AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93
),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
r AS (
  WITH RECURSIVE r(a, b) AS (SELECT a, a FROM n UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a) SELECT * FROM r
),
c AS (SELECT a, min(b) AS c FROM r GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(c.c, e.vec_id) AS component_id,
  coalesce(c.c, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN c ON c.a = e.vec_id
"""
