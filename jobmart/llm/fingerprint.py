"""Operator 4, document fingerprints by content-defined chunking.

A gear hash runs over the bytes of a text: each byte shifts it left by one and adds its
table value, so 32 bits remember 32 bytes. A chunk ends where bits of the hash are
zero: more bits below the normal chunk size, fewer above it (normalised chunking),
between a least and a greatest size. An insertion moves borders only near itself. The
hash of all places is computed at once by doubling the window five times.

The fingerprint is the set of chunk digests with their lengths, as text:
``digest:length`` in the order of digests, joined by commas (the empty text's is empty).
Likeness is the length of the shared chunks over that of the larger fingerprint: equal
fingerprints have 1, disjoint ones 0. Containment is that length over a fingerprint's own:
1 for a text that lies whole inside another one (but for chunks at its ends).

The query also fingerprints each text with its second half replaced by the beginning
of the next document (ascending id). Documents are dealt to buckets of consecutive ids
and sorted there; the first document of each bucket is also sent, as a successor, to
the bucket before, so each text is shuffled once and no task sees more than it streams.

Defined results: a null text is empty; a fingerprint of an empty text is like another
empty one (1) and like nothing else (0). Rows with one id are ordered by their text,
null ids come last; an empty fingerprint is contained in an empty one only; a single document is its own next one.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobmart.llm.common import mapped, read_table

LEAST, NORMAL, GREATEST = 32, 64, 256
STRICT_BITS, LOOSE_BITS = 7, 5
BUCKETS_PER_PARTITION = 4
_STEP = 1 << 20


def gear_table() -> np.ndarray:
    """256 fixed pseudo-random 32-bit values."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(32)).astype(np.uint32)


_GEAR = gear_table()
_LOOSE = np.uint32(((1 << LOOSE_BITS) - 1) << (32 - LOOSE_BITS))
_STRICT = np.uint32(((1 << STRICT_BITS) - 1) << (32 - STRICT_BITS))


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash at each byte, of it and the 31 bytes before."""
    h = _GEAR[data]
    for width in (1, 2, 4, 8, 16):
        h[width:] = h[width:] + (h[:-width] << np.uint32(width))
    return h


def borders(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``."""
    loose: list[int] = []
    strict: list[int] = []
    for start in range(0, len(data), _STEP):
        low = max(0, start - 31)
        h = gear(np.frombuffer(data[low : start + _STEP], dtype=np.uint8))[start - low :]
        at = np.flatnonzero((h & _LOOSE) == 0)
        hard = (h[at] & _STRICT) == 0
        loose += (at + start + 1).tolist()
        strict += (at[hard] + start + 1).tolist()
    ends, at, size = [], 0, len(data)
    while at < size:
        if size - at <= LEAST:
            ends.append(size)
            break
        k = bisect_left(strict, at + LEAST)
        if k < len(strict) and strict[k] <= at + NORMAL:
            at = strict[k]
        else:
            k = bisect_left(loose, at + NORMAL)
            at = min(loose[k] if k < len(loose) else size, at + GREATEST, size)
        ends.append(at)
    return ends


def chunks(text: str) -> dict[bytes, int]:
    """Digest (8 bytes) and length in bytes of each distinct chunk."""
    import xxhash

    data = text.encode("utf-8", "surrogatepass")
    digest, at, out = xxhash.xxh3_64_digest, 0, {}
    for end in borders(data):
        out[digest(data[at:end])] = end - at
        at = end
    return out


def as_text(found: dict[bytes, int]) -> str:
    return ",".join([f"{d.hex()}:{found[d]}" for d in sorted(found)])


def shared(a: dict[bytes, int], b: dict[bytes, int]) -> int:
    """Length of the chunks that both have."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    return sum(n for d, n in small.items() if d in large)


def compared(a: dict[bytes, int], b: dict[bytes, int]) -> tuple[float, float, float]:
    """Likeness of a and b, the share of a that b holds, the share of b that a holds."""
    if a == b:
        return 1.0, 1.0, 1.0
    both, own, other = shared(a, b), sum(a.values()), sum(b.values())
    return both / max(own, other, 1), both / max(own, 1), both / max(other, 1)


def likeness(a: dict[bytes, int], b: dict[bytes, int]) -> float:
    """Length of the shared chunks over the length of the larger fingerprint."""
    return compared(a, b)[0]


def containment(a: dict[bytes, int], b: dict[bytes, int]) -> float:
    """Length of the shared chunks over the length of the fingerprint a."""
    return compared(a, b)[1]


def fingerprints(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the fingerprint of the text (``_fingerprint``)."""
    keep = docs.columns if keep is None else keep
    return mapped(docs, text_col, keep, {"_fingerprint": "string"}, lambda: lambda ts: ([as_text(chunks(t)) for t in ts],))


def with_successors(docs: DataFrame) -> DataFrame:
    """(bucket, doc_id, text, role): every row once (role 0), sorted by id within its
    bucket, and after each bucket's rows the next bucket's first one (role 1)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    count = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = [k / count for k in range(1, count)]
    splits = rows.agg(F.percentile_approx("doc_id", at, 10_000)).first()[0] or []
    splits = sorted(set(splits))
    # A bucket is the number of splits up to the id.
    edges = np.array(splits, dtype=np.int64)

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, ids.to_numpy(dtype=np.int64), "right").astype(np.int32))

    known = bucket_of(F.coalesce("doc_id", F.lit(0)))
    dealt = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), len(edges) + 1).otherwise(known))
    # The first id of each bucket (a row for each bucket): where its text has to go, too.
    heads = dealt.select("bucket", "doc_id").groupBy("bucket").agg(F.min("doc_id").alias("doc_id"))
    order = Window.orderBy("bucket")  # over one row for each bucket
    heads = heads.select(
        "doc_id", F.col("bucket").alias("own"), F.lag("bucket").over(order).alias("to"),
        F.max("bucket").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("last"),
    ).select("doc_id", "own", F.coalesce("to", "last").alias("to"))
    sent = dealt.join(
        F.broadcast(heads), dealt["doc_id"].eqNullSafe(heads["doc_id"]) & (dealt["bucket"] == heads["own"])
    ).select(F.col("to").alias("bucket"), dealt["doc_id"], "text", F.lit(1).alias("role"))
    # Of rows that share the first id, the one of the least text is first.
    sent = sent.groupBy("bucket", "doc_id", "role").agg(F.min("text").alias("text"))
    sent = sent.select("bucket", "doc_id", "text", "role")
    both = dealt.select("bucket", "doc_id", "text", F.lit(0).alias("role")).union(sent)
    return both.repartition("bucket").sortWithinPartitions("bucket", "role", F.asc_nulls_last("doc_id"), "text")


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, in_edited double, edited_in double, in_next double, next_in double"
)
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
     ("in_edited", pa.float64()), ("edited_in", pa.float64()), ("in_next", pa.float64()), ("next_in", pa.float64())]
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    before = None  # (bucket, doc_id, text, chunks) of the row before, still without its next one
    for batch in batches:
        out: list[tuple] = []
        for bucket, doc_id, text, role in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            own = chunks(text)
            if before is not None and before[0] == bucket:
                _, last_id, last, found = before
                half = len(last) // 2
                edited = last[: len(last) - half] + text[:half]
                edit = chunks(edited)
                digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                near_edited, in_edited, edited_in = compared(found, edit)
                near_next, in_next, next_in = compared(found, own)
                out.append(
                    (last_id, len(last), digest, as_text(found), as_text(edit), near_edited, near_next,
                     in_edited, edited_in, in_next, next_in)
                )
            before = (bucket, doc_id, text, own) if role == 0 else None
            if len(out) >= 500:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ARROW)], schema=_ARROW)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ARROW)], schema=_ARROW)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text of ``documents``, of its edited text, likenesses,
    and containments: in_x is the share of the text's fingerprint that x's holds, x_in the
    share of x's that the text's holds."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_successors(docs).mapInArrow(_compare, _RESULT)
