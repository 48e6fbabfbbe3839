"""Operator 11, suffix-array dedup: every byte covered by a 100-byte string that also
starts earlier goes.

A string starts earlier in a document with a smaller id, or at a smaller place of the
same one. The corpus is cut into shards by content, so that equal strings meet: each
string belongs to the least hash of its ``ANCHOR``-byte substrings, and the run of
strings of a document with the same least hash is one *piece*, at most
``MAX_STRINGS`` strings long. Equal pieces of a step are put together before the one
shuffle of piece hashes (no text), by that least hash. Strings whose hash has only one
distinct piece, with that substring in it once, do not repeat; of equal pieces all but
the first go.
The texts of all other distinct pieces are dealt to shards by their hash, and each shard
sorts all suffixes by external induced sorting (``suffix_array``): strings of a run of
suffixes with common prefixes of 100 or more are equal, and all but the first go.
A hash with over ``LARGE_GROUP`` distinct pieces (a passage in very many contexts) is
split string by string instead, with the same first-place rule; no string is left out.
Runs of a document are then united and cut out.

Defined results: a null or empty text has nothing to remove; texts are whole; repeated
rows (equal id and text) are one document and get equal results; rows that share an id
but not a text are told apart by a 23-bit hash of the text, in whose order they come; a
null id is smaller than all others; an empty table gives no rows; other columns,
whatever their names, are not read. Equality of pieces is decided by 128 bits of hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobmart.llm.common import read_table, saved
from jobmart.llm.rolling import Rolling, blocks
from jobmart.llm.suffix_array import Packer, Store, byte_suffixes

LENGTH = 100
ANCHOR = 40
MAX_STRINGS = 256
LARGE_GROUP = 4096
# Bytes of tuples that a shard holds in memory, and records handled in one step.
SHARD_MEMORY, SHARD_BLOCK = 256 << 20, 1 << 19
# A place is a document's tie-break number and an offset in its text.
OFFSET_BITS = 40

PIECE = "low long, digest long, doc long, place long, strings long, sure boolean, inner boolean"


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, tie, text: the null id is the least one."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("doc"),
        F.pmod(F.xxhash64(text), F.lit(1 << 23)).alias("tie"),
        text.alias("text"),
    )


def _extreme(x: np.ndarray, width: int, least) -> np.ndarray:
    """The extreme of every ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        x = least(x[:-span], x[span:])
        span *= 2
    return least(x[: len(x) - (width - span)], x[width - span :]) if span < width else x


def _runs(data: np.ndarray, bounds: np.ndarray, length: int, anchor: int, most: int):
    """The pieces of a step's segments: first string, end, least anchor hash, digest, and
    whether that anchor is in the piece twice (so that it may repeat a string itself)."""
    n = len(data)
    none = np.zeros(0, dtype=np.int64)
    if n < length:
        return none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(bool)
    grams = Rolling(data).grams(anchor)
    width = length - anchor + 1
    low = _extreme(grams, width, np.minimum)
    # An anchor is the least gram of some string that holds it; neighbouring ones of one hash.
    around = _extreme(np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)]), width, np.maximum)
    anchors = np.flatnonzero(around == grams)
    twin = np.flatnonzero(grams[anchors[1:]] == grams[anchors[:-1]])
    twin, twin_end = anchors[twin], np.append(anchors[twin + 1], 2 * n)
    strings = np.maximum(np.diff(bounds) - length + 1, 0)
    first = bounds[:-1][strings > 0]
    last = first + strings[strings > 0]
    step = np.zeros(n + 1, dtype=np.int8)
    step[first] += 1
    step[last] -= 1
    valid = np.cumsum(step[: len(low)], dtype=np.int8) > 0
    new = np.append(True, low[1:] != low[:-1])
    new[first] = True
    start = np.flatnonzero(new & valid)
    end = np.append(start[1:], n)
    end = np.minimum(end, last[np.searchsorted(first, start, side="right") - 1])
    cuts = -(-(end - start) // most)
    part = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    start, whole = np.repeat(start, cuts) + part * most, np.repeat(end, cuts)
    end = np.minimum(start + most, whole)
    inner = twin_end[np.searchsorted(twin, start)] < end + width - 1
    return start, end, low[start], Rolling(data, 1).of(start, end + length - 1), inner


def _first_of_each(low, digest, doc, place) -> np.ndarray:
    """Whether a row's (doc, place) is the least of its (low, digest)."""
    order = np.lexsort((place, doc, digest, low))
    same = (low[order][1:] == low[order][:-1]) & (digest[order][1:] == digest[order][:-1])
    group = np.cumsum(np.append(True, ~same)) - 1
    least = order[np.append(True, ~same)]
    first = np.empty(len(low), dtype=bool)
    first[order] = (doc[order] == doc[least][group]) & (place[order] == place[least][group])
    return first


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64) if x.dtype == np.uint64 else x, pa.int64())


def _ids(ids: np.ndarray, null: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=null)


def _piece_rows(length: int, anchor: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            null = batch.column("doc").is_null().to_numpy(zero_copy_only=False)
            ids = batch.column("doc").fill_null(0).to_numpy(zero_copy_only=False)
            # Documents by order: the null id comes first.
            rank = np.where(null, 0, np.unique(ids, return_inverse=True)[1] + 1)
            tie = batch.column("tie").to_numpy(zero_copy_only=False)
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for data, which, offset, bounds in blocks(texts, length - 1):
                start, end, low, digest, inner = _runs(data, bounds, length, anchor, most)
                segment = np.searchsorted(bounds, start, side="right") - 1
                doc = which[segment]
                place = (tie[doc] << OFFSET_BITS) | (offset[segment] + start - bounds[segment])
                strings = end - start
                first = _first_of_each(low, digest, rank[doc], place)
                # What goes for sure: neighbouring pieces are put together.
                sure = np.flatnonzero(~first)
                head = np.append(True, (start[sure][1:] != end[sure][:-1]) | (segment[sure][1:] != segment[sure][:-1]))
                if len(sure):
                    total = np.add.reduceat(strings[sure], np.flatnonzero(head))
                    at = sure[head]
                    strings = np.concatenate([strings[first], total])
                else:
                    at = sure
                    strings = strings[first]
                rows = np.concatenate([np.flatnonzero(first), at])
                is_sure = np.arange(len(rows)) >= first.sum()
                yield pa.RecordBatch.from_arrays(
                    [
                        # A sure row is alone in its group.
                        _long(np.where(is_sure, digest[rows] ^ place[rows].astype(np.uint64), low[rows])),
                        _long(np.where(is_sure, low[rows] ^ place[rows].astype(np.uint64), digest[rows])),
                        _ids(ids[doc[rows]], null[doc[rows]]),
                        _long(place[rows]),
                        _long(strings),
                        pa.array(is_sure),
                        pa.array(inner[rows]),
                    ],
                    names=["low", "digest", "doc", "place", "strings", "sure", "inner"],
                )

    return run


def _compared(rows: DataFrame) -> DataFrame:
    """``rows`` (PIECE) with ``goes`` (not the first of its piece) and ``pieces`` (the
    distinct pieces that share its ``low``), from one shuffle."""
    equal = Window.partitionBy("low", "digest").orderBy("doc", "place")
    alike = Window.partitionBy("low")
    return (
        rows.repartition("low")
        .withColumn("_first", F.first(F.struct("doc", "place")).over(equal))
        .withColumn("_n", F.row_number().over(equal))
        .withColumn("pieces", F.sum((F.col("_n") == 1).cast("long")).over(alike))
        .withColumn("goes", F.col("sure") | ~F.struct("doc", "place").eqNullSafe(F.col("_first")))
        .drop("_first", "_n")
    )


TEXTS = "low long, digest long, doc long, place long, strings long, sure boolean, piece binary"


def _piece_texts(length: int):
    """Bytes of the pieces listed for each document; those of large groups become one
    row for each string, with its two hashes and no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, digest, doc, places, counts, pieces = [], [], [], [], [], []
            for row in batch.to_pylist():
                text = row["text"].encode("utf-8", "surrogatepass")
                for x in row["found"]:
                    at = x["place"] & ((1 << OFFSET_BITS) - 1)
                    part = text[at : at + x["strings"] + length - 1]
                    if not x["large"]:
                        low.append(np.array([x["low"]]))
                        digest.append(np.array([x["digest"]]))
                        places.append(np.array([x["place"]]))
                        counts.append(np.array([x["strings"]]))
                        pieces.append(part)
                        doc.append(row["doc"])
                        continue
                    data = np.frombuffer(part, dtype=np.uint8)
                    low.append(Rolling(data, 2).grams(length).view(np.int64))
                    digest.append(Rolling(data, 3).grams(length).view(np.int64))
                    places.append(x["place"] + np.arange(x["strings"]))
                    counts.append(np.ones(x["strings"], dtype=np.int64))
                    pieces.extend([None] * x["strings"])
                    doc.extend([row["doc"]] * x["strings"])
            n = len(pieces)
            join = lambda x: pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *x]), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [join(low), join(digest), pa.array(doc, pa.int64()), join(places), join(counts), pa.array([False] * n, pa.bool_()), pa.array(pieces, pa.binary())],
                names=["low", "digest", "doc", "place", "strings", "sure", "piece"],
            )

    return run


def _shard(length: int, memory: int, block: int):
    """Later strings of a shard's pieces, from its suffix array: (doc, place, strings)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Store(memory, block)
        packer = Packer(store)
        ids, nulls, places, strings = [], [], [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            packer.add(batch.column("piece").to_pylist())
            nulls.append(batch.column("doc").is_null().to_numpy(zero_copy_only=False))
            ids.append(batch.column("doc").fill_null(0).to_numpy(zero_copy_only=False))
            places.append(batch.column("place").to_numpy(zero_copy_only=False))
            strings.append(batch.column("strings").to_numpy(zero_copy_only=False))
        if not places:
            return
        ids, null, place, count = (np.concatenate(x) for x in (ids, nulls, places, strings))
        rank = np.where(null, 0, np.unique(ids, return_inverse=True)[1] + 1)
        text, starts = packer.text()
        later = store.array(len(text), np.uint8)
        open_group: list[np.ndarray] = []

        def settle(pos: np.ndarray, group: np.ndarray) -> None:
            """Of each group of equal strings all but the first go."""
            piece = np.searchsorted(starts, pos, side="right") - 1
            offset = pos - starts[piece]
            own = offset < count[piece]
            pos, piece, group, offset = pos[own], piece[own], group[own], offset[own]
            at = place[piece] + offset
            order = np.lexsort((at, rank[piece], group))
            g, r, a = group[order], rank[piece][order], at[order]
            head = np.append(True, g[1:] != g[:-1])[: len(g)]
            lead = np.flatnonzero(head)[np.cumsum(head) - 1] if len(g) else g
            later[pos[order[(r != r[lead]) | (a != a[lead])]]] = 1

        def scanned(items: np.ndarray) -> None:
            new = items["near"] < length
            edges = np.flatnonzero(new)
            if not len(edges):
                open_group.append(items["pos"])
                return
            pos = np.concatenate([*open_group, items["pos"][: edges[-1]]])
            group = np.cumsum(np.concatenate([np.zeros(len(pos) - edges[-1], dtype=np.int64), new[: edges[-1]]]))
            several = np.zeros(len(pos), dtype=bool)
            several[1:] = group[1:] == group[:-1]
            several[:-1] |= several[1:]
            settle(pos[several], group[several])
            open_group[:] = [items["pos"][edges[-1] :]]

        byte_suffixes(text, store, scanned, length)
        scanned(np.zeros(1, dtype=[("pos", np.int64), ("near", np.uint8)]))
        for a in range(0, len(text), block):
            part = np.asarray(later[a : a + block])
            edge = np.diff(part.astype(np.int8), prepend=0, append=0)
            first, last = a + np.flatnonzero(edge > 0), a + np.flatnonzero(edge < 0)
            piece = np.searchsorted(starts, first, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [_ids(ids[piece], null[piece]), _long(place[piece] + first - starts[piece]), _long(last - first)],
                names=["doc", "place", "strings"],
            )

    return run


def later_strings(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    anchor: int = ANCHOR,
    large_group: int = LARGE_GROUP,
    memory: int = SHARD_MEMORY,
    block: int = SHARD_BLOCK,
) -> DataFrame:
    """(doc, place, strings): runs of places where strings of ``length`` bytes start that
    also start earlier. ``place`` holds the document's tie-break number above 40 bits of offset."""
    keyed = _keyed(docs, id_col, text_col)
    pieces = keyed.mapInArrow(_piece_rows(length, anchor, MAX_STRINGS), PIECE)
    found = saved(_compared(pieces).where("goes or pieces > 1 or inner").drop("sure", "inner"), "pieces")
    listed = (
        found.where("not goes")
        .groupBy("doc", F.shiftright("place", OFFSET_BITS).alias("tie"))
        .agg(F.collect_list(F.struct("low", "digest", "place", "strings", (F.col("pieces") > large_group).alias("large"))).alias("found"))
    )
    texts = (
        keyed.alias("k")
        .join(listed.alias("l"), F.expr("k.doc <=> l.doc and k.tie = l.tie"))
        .select("k.doc", "text", "found")
        .mapInArrow(_piece_texts(length), TEXTS)
    )
    texts = saved(texts, "piece-texts")
    # Repeated rows list their pieces twice; a shard takes each once, as equal places are one.
    sorted_out = (
        texts.where("piece is not null").select("low", "doc", "place", "strings", "piece").repartition("low").drop("low")
        .mapInArrow(_shard(length, memory, block), "doc long, place long, strings long")
    )
    split = _compared(texts.where("piece is null").drop("piece")).where("goes")
    columns = ["doc", "place", "strings"]
    known = found.where("goes").select(columns)
    return known.unionByName(sorted_out).unionByName(split.select(columns))


CUT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut(length: int, keep: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text").cast(pa.binary()).to_pylist()
            out = []
            for text, spans in zip(texts, batch.column("_spans").to_pylist(), strict=True):
                kept, at, removed, runs = [], 0, 0, 0
                end = -1
                for first, strings in sorted((x["first"], x["strings"]) for x in spans or ()):
                    last = first + strings + length - 1
                    if first > end:
                        runs += 1
                        kept.append(text[at:first])
                    removed += max(last - max(first, end), 0)
                    at = end = max(end, last)
                kept = b"".join([*kept, text[at:]])
                out.append((len(text), removed, runs, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            added = [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)][: 5 if with_text else 4]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(keep)] + added,
                names=batch.schema.names[:keep] + ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: len(added)],
            )

    return run


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, length: int = LENGTH, **sizes) -> DataFrame:
    """One row per document: ``id_col``, n_bytes, n_removed, n_spans, kept_sha256 and, if
    asked, the kept text (bytes of characters cut apart become U+FFFD)."""
    spans = (
        later_strings(docs, id_col, text_col, length, **sizes)
        .groupBy("doc", F.shiftright("place", OFFSET_BITS).alias("tie"))
        .agg(F.collect_list(F.struct(F.col("place").bitwiseAND((1 << OFFSET_BITS) - 1).alias("first"), "strings")).alias("_spans"))
    )
    rows = _keyed(docs, id_col, text_col).alias("k").join(spans.alias("s"), F.expr("k.doc <=> s.doc and k.tie = s.tie"), "left")
    rows = rows.select(F.col("k.doc").alias(id_col), F.col("text").alias("_text"), "_spans")
    return rows.mapInArrow(_cut(length, 1, with_text), f"{id_col} long, {CUT}" + (", kept string" if with_text else ""))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every whole text of ``documents`` without repeated 100-byte strings."""
    return dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
