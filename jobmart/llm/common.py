"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.session import shared_dir

# Characters of text that one vectorised step handles: bounds the arrays of a task.
STEP_CHARS = 1_500_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and
    survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(id_col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(mod))


def text_steps(texts: list[str], limit: int = STEP_CHARS) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts holding about ``limit`` characters each
    (one longer text is a range of its own)."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield first, i
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def no_nulls(series) -> list[str]:
    """A pandas text column as a list, null as the empty text."""
    return ["" if x is None or x != x else x for x in series]


ARROW = {"string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(), "long": pa.int64(), "int": pa.int32()}


def mapped(docs: DataFrame, text_col: str, keep: list[str], added: dict[str, str], make: Callable) -> DataFrame:
    """The columns ``keep`` of ``docs``, as they are, and the columns ``added`` (name to
    type): each task calls ``make()`` once, and what it returns maps a list of texts
    (null as the empty text) to one array for each added column."""
    schema = docs.select(keep).schema
    # A kept text crosses to Python once.
    at = keep.index(text_col) if text_col in keep and schema[text_col].dataType.simpleString() == "string" else len(keep)
    for name, kind in added.items():
        schema = schema.add(name, kind)
    names, kinds = schema.names, [ARROW[k] for k in added.values()]
    own = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(at).to_pylist()]
            new = [pa.array(x, kind, from_pandas=True) for x, kind in zip(work(texts), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(own)] + new, names=names)

    sent = docs.select(*keep) if at < own else docs.select(*keep, docs[text_col].alias("_text"))
    return sent.mapInArrow(run, schema)
