"""Joins inside buckets without ever holding, or emitting, all pairs of a bucket.

``dealt`` splits a bucket of more than ``block`` rows into blocks and sends every pair
of blocks to a task of its own, so a hot bucket is many bounded pieces. ``by_piece``
streams the pieces of a sorted partition; ``row_pairs`` lists the pairs of rows of
many pieces at once, in steps of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 256
STEP_PAIRS = 400_000


def dealt(rows: DataFrame, bucket: str, row_id: str, block: int = BLOCK) -> DataFrame:
    """``rows`` of buckets with two rows or more, with _piece (64 bits, one per pair of
    blocks) and _side (0 or 1; pieces of one block have side 0 only).

    Bucket sizes are an aggregate; rows of a small bucket (nearly all) are sent once. Their
    join is never a broadcast: ``rows`` may come from an explode, whose number of rows Spark
    does not estimate, and adaptive execution does not take a planned broadcast back."""
    sizes = rows.groupBy(bucket).agg(F.count("*").alias("_size")).where("_size > 1")
    rows = rows.join(sizes.hint("merge"), bucket)
    blocks = F.ceil(F.col("_size") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(row_id, F.lit("block")), blocks).cast("int")
    rows = rows.withColumn("_blocks", blocks).withColumn("_own", own)
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    piece = F.when(F.col("_blocks") == 1, F.col(bucket)).otherwise(
        F.xxhash64(bucket, F.least("_own", "_other"), F.greatest("_own", "_other"))
    )
    side = F.when(F.col("_own") > F.col("_other"), 1).otherwise(0)
    return rows.withColumn("_piece", piece).withColumn("_side", side).drop("_size", "_blocks", "_own", "_other")


def sorted_pieces(rows: DataFrame) -> DataFrame:
    """Whole pieces in one partition, one after the other."""
    return rows.repartition("_piece").sortWithinPartitions("_piece")


def by_piece(batches: Iterator[pd.DataFrame], most: int = 4096) -> Iterator[pd.DataFrame]:
    """Frames of about ``most`` rows that hold whole pieces."""
    rest = None
    for pdf in batches:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        while True:
            piece = pdf["_piece"].to_numpy()
            ends = np.flatnonzero(piece[1:] != piece[:-1]) + 1
            if not len(ends):
                break
            cut = ends[min(np.searchsorted(ends, most), len(ends) - 1)]
            if len(pdf) <= most and cut != ends[-1]:
                cut = ends[-1]
            yield pdf.iloc[:cut].reset_index(drop=True)
            pdf = pdf.iloc[cut:].reset_index(drop=True)
            if len(pdf) <= most:
                break
        rest = pdf
    if rest is not None and len(rest):
        yield rest


def runs(piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First row and length of each run of equal values."""
    first = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]]))
    return first, np.diff(np.append(first, len(piece)))


def row_pairs(piece: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of rows of one piece, on different sides where it has two."""
    first, size = runs(piece)
    two = np.add.reduceat(side, first) > 0
    ends = np.repeat(first + size, size)
    after = ends - np.arange(len(piece)) - 1  # rows of the piece behind each row
    total = np.cumsum(after)
    start = 0
    while start < len(piece):
        base = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, base + STEP_PAIRS, "right")))
        n = after[start:stop]
        i = np.repeat(np.arange(start, stop), n)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        if two.any():
            ok = (side[i] != side[j]) | ~np.repeat(two, size)[i]
            i, j = i[ok], j[ok]
        if len(i):
            yield i, j
        start = stop


def forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs among (i, j) of a spanning forest over rows 0..n-1 (at most n - 1)."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for k, (a, b) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
        a, b = root(a), root(b)
        if a != b:
            parent[b] = a
            kept.append(k)
    return i[kept], j[kept]
