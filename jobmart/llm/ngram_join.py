"""Operator 1, n-gram Jaccard join by chosen paths.

A document is the set of its shingles of five lower-case words (all its words, if it
has fewer). Documents with equal sets form a class; one member stands for it.

A path starts at one of ``runs`` roots. A node samples two of ``COORDINATES`` min-wise
hashes (the same two for everybody at that node), and a class goes on to the child
named by the token its set has there: two sets share a child with the probability of
their similarity. Buckets of at most ``SMALL`` classes are compared by brute force;
larger ones split again, unless a split keeps more than half of its parent, whose
members are then alike, or ``DEPTH`` is reached: those are brute-forced in blocks.
With J the threshold, a run finds a pair with at least 1 - (1 - J x)^2 applied
``DEPTH`` times from x = 1, and ``runs`` is the number of runs that reach ``RECALL``.

A pair is handled in the smallest of the buckets it shares, once: there its sketches
are compared first (a pair of the threshold passes at four standard deviations), then
its whole sets. Pieces emit sums of links and a spanning forest, never all pairs.

Defined results: a null text, or one without words, has no shingles, is its own class
and links with nothing. Equal texts, also rows with one id, share a class, named by
its smallest id (null ids last). Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.llm import buckets
from jobmart.llm.common import no_nulls, read_table, saved, text_steps
from jobmart.llm.components import components

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.999
COORDINATES, BRANCHES, DEPTH, SMALL = 64, 2, 5, 128
SKETCH_SIGMAS = 4.0
LAST = (1 << 63) - 1  # stands for a null id
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def runs_needed(threshold: float, recall: float) -> int:
    found = 1.0
    for _ in range(DEPTH):
        found = 1 - (1 - threshold * found) ** BRANCHES
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - found)))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(31))


def shingles(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts, one after the other, and how many each has.

    A word's hash is a polynomial over its (scrambled) bytes, taken from one running sum."""
    raw = [t.lower().encode() for t in texts]
    joined = b" ".join(raw) + b" "
    byte = np.frombuffer(joined, dtype=np.uint8)
    space = (byte == 32) | ((byte >= 9) & (byte <= 13))
    inner = ~space
    first = np.flatnonzero(inner & np.concatenate([[True], space[:-1]]))
    last = np.flatnonzero(inner & np.concatenate([space[1:], [True]]))
    ends = np.cumsum([len(r) + 1 for r in raw])
    count = np.diff(np.concatenate([[0], np.searchsorted(first, ends)]))
    scramble = _mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
    # sum of T[b_i] * odd^i up to each byte; powers and their inverses modulo 2^64.
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(byte), _ODD)]))
    inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
    back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(byte), inverse)]))
    total = np.concatenate([[np.uint64(0)], np.cumsum(scramble[byte] * powers[:-1])])
    word = _mix((total[last + 1] - total[first]) * back[first] + (last - first).astype(np.uint64))
    owner = np.repeat(np.arange(len(raw)), count)
    start = np.cumsum(count) - count
    place = np.arange(len(word)) - start[owner]
    whole = place <= np.maximum(count[owner] - words, 0)
    at = np.flatnonzero(whole)
    value = np.zeros(len(at), dtype=np.uint64)
    for k in range(words):
        there = place[at] + k < count[owner[at]]
        piece = word[np.minimum(at + k, len(word) - 1)]
        value = (value + np.where(there, piece, np.uint64(0))) * _ODD + np.uint64(k + 1)
        value = value ^ (value >> np.uint64(29))
    return _mix(value), np.bincount(owner[at], minlength=len(raw))


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text."""
    out = []
    for a, b in text_steps(texts):
        value, count = shingles(texts[a:b])
        out += [np.unique(x) for x in np.split(value, np.cumsum(count)[:-1])]
    return out


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return (
        rng.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) | np.uint64(1),
        rng.integers(0, 1 << 63, COORDINATES, dtype=np.uint64),
    )


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    odd, flip = _multipliers()
    for batch in batches:
        texts = ["" if t is None else t for t in batch.column(2).to_pylist()]
        for a, b in text_steps(texts):
            sets = shingle_sets(texts[a:b])
            size = np.array([len(s) for s in sets])
            first = np.cumsum(size) - size
            full = np.flatnonzero(size)
            sketch = np.zeros((len(sets), COORDINATES), dtype=np.int32)
            if len(full):
                every = np.concatenate(sets)
                for k in range(COORDINATES):
                    least = np.minimum.reduceat((every ^ flip[k]) * odd[k], first[full])
                    sketch[full, k] = (least >> np.uint64(32)).astype(np.uint32).view(np.int32)
            part = batch.slice(a, b - a)
            digest = [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets]
            offsets = np.arange(0, sketch.size + 1, COORDINATES, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(digest, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(sketch.ravel()))],
                names=["doc_id", "text_key", "cls", "sketch"],
            )


def _leaves(classes: DataFrame, threshold: float, recall: float) -> DataFrame:
    """(node, cls): the buckets of every class that it shares with another one."""
    sketches = classes.select("cls", "sketch")

    def children(frame: DataFrame) -> DataFrame:
        node, pick = F.col("node"), []
        first = F.pmod(F.xxhash64(node, F.lit("coordinate")), F.lit(COORDINATES)).cast("int")
        step = F.pmod(F.xxhash64(node, F.lit("step")), F.lit(COORDINATES - 1)).cast("int") + 1
        for k in range(BRANCHES):
            at = F.pmod(first + F.lit(k) * step, F.lit(COORDINATES)).cast("int")
            pick.append(F.xxhash64(node, F.lit(k), F.element_at("sketch", at + 1)))
        return frame.select(F.col("node").alias("parent"), "cls", F.explode(F.array(*pick)).alias("node"), "above")

    roots = F.explode(F.sequence(F.lit(1).cast("long"), F.lit(runs_needed(threshold, recall)).cast("long")))
    frontier = sketches.withColumn("node", roots).withColumn("above", F.lit(None).cast("long"))
    leaves = []
    for depth in range(1, DEPTH + 1):
        rows = children(frontier)
        size = rows.groupBy("node").agg(F.count("*").alias("size"), F.first("above").alias("above"))
        size = size.where("size > 1")
        # A split that keeps more than half of its parent has members that are alike.
        stop = (F.col("size") <= SMALL) | (F.col("size") * 2 > F.col("above")) | F.lit(depth == DEPTH)
        size = size.select("node", "size", F.coalesce(stop, F.lit(False)).alias("leaf"))
        placed = saved(rows.select("node", "cls").join(size, "node"), "paths")
        leaves.append(placed.where("leaf").select("node", "cls"))
        large = placed.where("not leaf")
        if large.isEmpty():
            break
        frontier = large.select("node", "cls", F.col("size").alias("above")).join(sketches, "cls")
    out = leaves[0]
    for more in leaves[1:]:
        out = out.union(more)
    return out


def _matrix(column: pd.Series, width: int, dtype) -> np.ndarray:
    out = np.full((len(column), width), -1, dtype=dtype)
    for i, x in enumerate(column):
        out[i, : len(x)] = x
    return out


def _close(pdf: pd.DataFrame, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows whose sketches agree often enough and whose first bucket is this one."""
    sketch = np.stack(pdf["sketch"].to_numpy())
    nodes = _matrix(pdf["nodes"], max(map(len, pdf["nodes"])), np.int64)
    own = pdf["node"].to_numpy()
    for i, j in buckets.row_pairs(pdf["_piece"].to_numpy(), pdf["_side"].to_numpy()):
        # A few coordinates settle most pairs.
        probe = np.zeros(len(i), dtype=np.int8)
        for k in range(0, 16):
            probe += sketch[i, k] == sketch[j, k]
        ok = probe >= max(0, least - (COORDINATES - 16))
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        agree = probe[ok].astype(np.int16)
        for k in range(16, COORDINATES):
            agree += sketch[i, k] == sketch[j, k]
        ok = agree >= least
        i, j = i[ok], j[ok]
        earlier = np.zeros(len(i), dtype=bool)
        for a in range(nodes.shape[1]):
            mine = nodes[i, a]
            for b in range(nodes.shape[1]):
                earlier |= (mine == nodes[j, b]) & (mine != -1) & (mine < own[i])
        i, j = i[~earlier], j[~earlier]
        if len(i):
            yield i, j


def _needed(least: int):
    """Rows of a piece that have a pair to verify there."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in buckets.by_piece(batches):
            hit = np.zeros(len(pdf), dtype=bool)
            for i, j in _close(pdf, least):
                hit[i] = hit[j] = True
            yield pdf.loc[hit, ["_piece", "_side", "node", "cls"]]

    return run


def intersections(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets i and j of one piece."""
    if len(i) <= 3 * len(sets) or len(sets) < 8:
        return np.array(
            [len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j, strict=True)]
        )
    every = np.concatenate(sets)
    token, inverse, n = np.unique(every, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = n[inverse] > 1  # a token of one set alone is in no intersection
    column = (np.cumsum(n > 1) - 1)[inverse[shared]]
    row = row[shared]
    common = np.zeros((len(sets), len(sets)), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, [start, start + 4096])
        part = np.zeros((len(sets), 4096), dtype=np.float32)
        part[row[a:b], column[a:b] - start] = 1
        common += part @ part.T
    return common[i, j].astype(np.int64)


def _verify(least: int, threshold: float):
    """Links of each row within its piece, and the edges of a spanning forest."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in buckets.by_piece(batches, 512):
            sets = shingle_sets(no_nulls(pdf["text"]))
            size = np.array([len(s) for s in sets])
            weight = pdf["members"].to_numpy()
            linked, classes = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
            one, two = [], []
            pairs = list(_close(pdf, least))
            if not pairs:
                continue
            i, j = (np.concatenate(x) for x in zip(*pairs, strict=True))
            piece = pdf["_piece"].to_numpy()
            first, length = buckets.runs(piece)
            group = np.searchsorted(first, i, "right") - 1
            order = np.argsort(group, kind="stable")
            i, j, group = i[order], j[order], group[order]
            for g in np.unique(group):
                a, b = np.searchsorted(group, [g, g + 1])
                gi, gj, low = i[a:b], j[a:b], first[g]
                both = intersections(sets[low : low + length[g]], gi - low, gj - low)
                ok = both >= threshold * (size[gi] + size[gj] - both) - 1e-9
                one.append(gi[ok])
                two.append(gj[ok])
            i, j = np.concatenate(one), np.concatenate(two)
            np.add.at(linked, i, weight[j])
            np.add.at(linked, j, weight[i])
            np.add.at(classes, i, 1)
            np.add.at(classes, j, 1)
            cls = pdf["cls"].to_numpy()
            hit = np.flatnonzero(classes)
            yield pd.DataFrame({"cls": cls[hit], "other": None, "links": linked[hit], "classes": classes[hit]})
            i, j = buckets.forest(i, j, len(pdf))
            yield pd.DataFrame({"cls": cls[i], "other": cls[j], "links": 0, "classes": 0})

    return run


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, text): the first two tell rows apart, but for equal rows."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")


def jaccard_links(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """For ``docs`` (doc_id, text): one row (doc_id, text_key, cls, first, class_id, links,
    linked_classes) per row, where ``first`` names the row that stands for the class, and the edges (cls, other) of a spanning forest of the
    linked classes. ``links`` counts the other rows with a similarity of ``threshold``."""
    rows = keyed(docs)
    sketched = saved(
        rows.mapInArrow(_sketch, "doc_id long, text_key long, cls binary, sketch array<int>"), "sketches"
    )
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("id"), "text_key")).alias("first")
    classes = saved(
        sketched.where("cls is not null").groupBy("cls").agg(
            first, F.min("doc_id").alias("class_id"), F.count("*").alias("members"), F.first("sketch").alias("sketch")
        ),
        "classes",
    )
    least = math.floor(COORDINATES * threshold - SKETCH_SIGMAS * math.sqrt(COORDINATES * threshold * (1 - threshold)))
    leaves = saved(_leaves(classes, threshold, recall), "leaves")
    nodes = leaves.groupBy("cls").agg(F.sort_array(F.collect_set("node")).alias("nodes"))
    known = classes.join(nodes, "cls").select("cls", "first", "members", "sketch", "nodes")
    pieces = buckets.dealt(leaves.join(known.select("cls", "sketch", "nodes"), "cls"), "node", "cls")
    needed = saved(
        buckets.sorted_pieces(pieces).mapInPandas(_needed(least), "_piece long, _side int, node long, cls binary"),
        "needed",
    )
    # The text of one member of each class that has a pair to verify.
    wanted = saved(needed.select("cls").distinct().join(known, "cls"), "wanted")
    at = wanted.select("cls", F.col("first.id").alias("_id"), F.col("first.text_key").alias("_key"))
    texts = (
        rows.withColumn("_id", F.coalesce("doc_id", F.lit(LAST))).withColumnRenamed("text_key", "_key")
        .join(at, ["_id", "_key"]).groupBy("cls").agg(F.min("text").alias("text"))
    )
    verified = saved(
        buckets.sorted_pieces(
            needed.join(wanted.select("cls", "members", "sketch", "nodes"), "cls").join(texts, "cls")
        ).mapInPandas(_verify(least, threshold), "cls binary, other binary, links long, classes long"),
        "links",
    )
    sums = verified.where("other is null").groupBy("cls").agg(
        F.sum("links").alias("_links"), F.sum("classes").alias("_classes")
    )
    found = sketched.select("doc_id", "text_key", "cls")
    found = found.join(classes.select("cls", "first", "class_id", "members"), "cls", "left")
    found = found.join(sums, "cls", "left").select(
        "doc_id", "text_key", "cls", "first",
        F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        (F.coalesce("members", F.lit(1)) - 1 + F.coalesce("_links", F.lit(0))).alias("links"),
        F.coalesce("_classes", F.lit(0)).alias("linked_classes"),
    )
    return found, verified.where("other is not null").select("cls", "other")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document at a similarity of 0.8 or more."""
    found, _ = jaccard_links(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", F.col("links").alias("n_links"), F.col("linked_classes").alias("n_linked_classes"))


ORACLE = r"""
WITH words AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[ \t\n\r\f\v]+'), lambda x: x <> '') AS w FROM documents
), parts AS (
  SELECT DISTINCT doc_id, list_aggregate(w[i : i + 4], 'string_agg', ' ') AS s
  FROM words, LATERAL (SELECT unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i) WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n, md5(string_agg(md5(s), '' ORDER BY s)) AS cls FROM parts GROUP BY 1
), classes AS (
  SELECT cls, min(doc_id) AS class_id, count(*) AS members, min(n) AS n FROM sizes GROUP BY 1
), reps AS (
  SELECT c.class_id, p.s FROM classes c JOIN parts p ON p.doc_id = c.class_id
), pairs AS (
  SELECT a.class_id AS a, b.class_id AS b, count(*) AS both
  FROM reps a JOIN reps b ON a.s = b.s AND a.class_id <> b.class_id GROUP BY 1, 2
), links AS (
  SELECT p.a AS class_id, sum(y.members) AS links, count(*) AS classes
  FROM pairs p JOIN classes x ON x.class_id = p.a JOIN classes y ON y.class_id = p.b
  WHERE p.both >= 0.8 * (x.n + y.n - p.both) - 1e-9 GROUP BY 1
)
SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id,
  CAST(coalesce(c.members, 1) - 1 + coalesce(l.links, 0) AS BIGINT) AS n_links,
  CAST(coalesce(l.classes, 0) AS BIGINT) AS n_linked_classes
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN classes c ON c.cls = s.cls
LEFT JOIN links l ON l.class_id = c.class_id
"""


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """Pipeline stage: of each group of documents that links connect, the row of the
    smallest id stays; rows without words stay as they are."""
    found, forest = jaccard_links(docs)
    name = found.where("cls is not null").select("cls", F.struct("first", "cls").alias("v")).distinct()
    edges = (
        forest.join(name.select("cls", F.col("v").alias("u")), "cls")
        .join(name.select(F.col("cls").alias("other"), "v"), "other").select("u", "v")
    )
    gone = components(edges).where("vertex <> component").select(F.col("vertex.cls").alias("cls"))
    own = F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("id"), "text_key")
    copies = found.where("cls is not null").where(own != F.col("first")).select("doc_id", "text_key")
    drop = found.join(gone, "cls", "left_semi").select("doc_id", "text_key").union(copies)
    drop = drop.distinct().select(F.col("doc_id").alias("_gone_id"), F.col("text_key").alias("_gone_key"))
    same = F.col("doc_id").eqNullSafe(F.col("_gone_id")) & F.xxhash64("text").eqNullSafe(F.col("_gone_key"))
    kept = docs.join(saved(drop, "dropped"), same, "left_anti")
    # Equal rows, one of which stands for its class: one of them stays.
    twice = found.where("cls is not null").groupBy("doc_id", "text_key").count().where("count > 1")
    twice = saved(twice.select(F.col("doc_id").alias("_gone_id"), F.col("text_key").alias("_gone_key")), "repeated")
    if twice.isEmpty():
        return kept
    once = kept.join(twice, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(twice, same, "left_anti").unionByName(once)
