"""Operator 10, best-fit packing of documents into bins of a fixed length, with conflicts.

Two documents conflict if they share a source or a duplicate cluster; a bin holds no
two that conflict. A cluster is a connected component of near copies: documents with
equal sets of five-word shingles, or linked by a similarity of 0.8 (operator 1). A text longer than a bin is cut: each full piece is a bin of its
own, the rest is packed like a short text. Rows are dealt by a hash of the row (never
by source or cluster) to independent groups of about ``GROUP_ROWS`` pieces, so one hot
source or cluster is spread over all of them and no task holds more than a group.

Within a group pieces go in from the longest to the shortest. Bins are kept in the
order of their residual capacity, with bitmaps of their sources and clusters; the
search starts at the tightest bin that is large enough and goes on to its successors
until one is compatible, and opens a new bin where none is.

Defined results: a null or empty text has length 0 and is packed (into the tightest
compatible bin); a null source conflicts with nothing, a text without words or without
copies is in no cluster; repeated rows are copies of each other; ties go by length, id and cluster,
bins of one residual by age. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.llm.common import read_table, saved
from jobmart.llm.components import components
from jobmart.llm.ngram_join import LAST, jaccard_links

CAPACITY = 8192  # code points
GROUP_ROWS = 4096
_WINDOW = 512
PLACED = "doc_id long, piece int, start long, length int, grp long, bin int, bin_offset int"


class Bins:
    """Open bins ordered by residual (then age), with conflict bitmaps as rows of words."""

    def __init__(self, most: int, words: int):
        self.residual = np.empty(most, dtype=np.int64)
        self.name = np.empty(most, dtype=np.int64)
        self.taken = np.zeros((most, words), dtype=np.uint64)  # by bin
        self.open = 0
        self.made = 0

    def place(self, length: int, marks: list[int], capacity: int) -> tuple[int, int]:
        """(bin, offset) of a piece with the conflict bits ``marks``."""
        words = [m >> 6 for m in marks]
        bits = [np.uint64(1 << (m & 63)) for m in marks]
        at = int(np.searchsorted(self.residual[: self.open], length))
        found = -1
        while at < self.open:
            names = self.name[at : min(at + _WINDOW, self.open)]
            free = np.ones(len(names), dtype=bool)
            for w, b in zip(words, bits, strict=True):
                free &= (self.taken[names, w] & b) == 0
            hit = int(free.argmax())
            if free[hit]:
                found = at + hit
                break
            at += len(names)
        if found < 0:
            name, left = self.made, capacity
            self.made += 1
        else:
            name, left = int(self.name[found]), int(self.residual[found])
            self.residual[found : self.open - 1] = self.residual[found + 1 : self.open]
            self.name[found : self.open - 1] = self.name[found + 1 : self.open]
            self.open -= 1
        for w, b in zip(words, bits, strict=True):
            self.taken[name, w] |= b
        rest = left - length
        low, high = np.searchsorted(self.residual[: self.open], [rest, rest + 1])
        to = int(low + np.searchsorted(self.name[low:high], name))
        self.residual[to + 1 : self.open + 1] = self.residual[to : self.open].copy()
        self.name[to + 1 : self.open + 1] = self.name[to : self.open].copy()
        self.residual[to], self.name[to] = rest, name
        self.open += 1
        return name, capacity - left


def pack(group: pd.DataFrame, capacity: int = CAPACITY) -> pd.DataFrame:
    """The pieces of one group (length, source, cluster) with their bin and offset."""
    group = group.sort_values(["length", "doc_id", "cluster", "piece"], ascending=[False, True, True, True], kind="stable")
    # Only what two pieces share can conflict, so only that gets a bit.
    marks = [[] for _ in range(len(group))]
    used = 0
    for column in ("source", "cluster"):
        value = group[column]
        shared = value.notna() & value.duplicated(keep=False) & (group["length"] < capacity)
        codes, _ = pd.factorize(value[shared])
        for row, code in zip(np.flatnonzero(shared.to_numpy()), codes, strict=True):
            marks[row].append(used + int(code))
        used += int(codes.max()) + 1 if len(codes) else 0
    bins = Bins(len(group) + 1, used // 64 + 1)
    name, offset = [], []
    for length, own in zip(group["length"].tolist(), marks, strict=True):
        if length >= capacity:
            where = (bins.made, 0)  # a full bin, closed at once
            bins.made += 1
        else:
            where = bins.place(length, own, capacity)
        name.append(where[0])
        offset.append(where[1])
    return group.assign(bin=np.array(name, dtype="int32"), bin_offset=np.array(offset, dtype="int32"))


def _packed(capacity: int):
    names = [f.split()[0] for f in PLACED.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            last = pdf["grp"].iloc[-1] if len(pdf) else None
            for grp, part in pdf[pdf["grp"] != last].groupby("grp", sort=False):
                yield pack(part, capacity)[names]
            rest = pdf[pdf["grp"] == last]
        if rest is not None and len(rest):
            yield pack(rest, capacity)[names]

    return run


def clusters_of(docs: DataFrame) -> DataFrame:
    """(_id, _key, cluster): the near-copy component of the rows of ``docs`` (doc_id, text)
    that have copies, once for equal rows; a null id is ``LAST``, _key a hash of the text."""
    found, forest = jaccard_links(docs.select("doc_id", "text"))
    linked = components(forest.select(F.col("cls").alias("u"), F.col("other").alias("v")))
    linked = linked.select(F.col("vertex").alias("cls"), "component")
    rows = found.where("cls is not null and links > 0").join(linked, "cls", "left")
    return rows.select(
        F.coalesce("doc_id", F.lit(LAST)).alias("_id"), F.col("text_key").alias("_key"),
        F.xxhash64(F.coalesce("component", "cls")).alias("cluster"),
    ).distinct()


def best_fit(docs: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per piece of each row of ``docs`` (doc_id, length, source, cluster)."""
    # Cut texts: pieces 0, 1, ... of ``capacity``, the last with what is left.
    pieces = F.when(F.col("length") > 0, F.ceil(F.col("length") / F.lit(capacity))).otherwise(F.lit(1)).cast("int")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "length", "source", "cluster",
        F.monotonically_increasing_id().alias("_row"),
        F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"),
    ).withColumn("start", F.col("piece").cast("long") * capacity)
    rows = saved(
        rows.withColumn("length", F.least(F.col("length") - F.col("start"), F.lit(capacity)).cast("int")), "pieces"
    )
    groups = max(1, -(-rows.count() // group_rows))
    # The row's number salts the hash: equal rows are spread, too; it is read from the table.
    dealt = rows.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "_row"), F.lit(groups)))
    dealt = dealt.repartition("grp").sortWithinPartitions("grp")
    return dealt.select("doc_id", "piece", "start", "length", "source", "cluster", "grp").mapInPandas(
        _packed(capacity), PLACED
    )


def pack_documents(docs: DataFrame) -> DataFrame:
    """Bins of the rows of ``docs`` (doc_id, text, source); also the pipeline's last stage."""
    rows = docs.select(
        "doc_id", F.coalesce(F.char_length("text"), F.lit(0)).alias("length"), F.xxhash64("source").alias("_hash"),
        "source", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("_id"), F.xxhash64("text").alias("_key"),
    )
    source = F.when(F.col("source").isNotNull(), F.col("_hash")).alias("source")
    rows = rows.select("doc_id", "length", source, "_id", "_key")
    rows = rows.join(clusters_of(docs), ["_id", "_key"], "left").select("doc_id", "length", "source", "cluster")
    placed = best_fit(rows)
    return placed.select(
        "doc_id", "piece", "start", "length",
        F.format_string("%d-%d", "grp", "bin").alias("bin_id"), F.col("bin_offset").alias("offset"),
    )


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins for every whole text of ``documents``."""
    return pack_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
