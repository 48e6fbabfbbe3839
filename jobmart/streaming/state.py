"""Streams that keep state by key (K5, K7, Y5), in RocksDB, checkpointed.

The state holds one row per key, so a restart from the checkpoint goes on where the
stream stopped and reads no old input. The streams append to a file sink:

* ``first_wins`` (K7): a key is written once, when it first arrives, with the oldest
  version of that micro-batch;
* ``last_wins`` (K5): a key is written again when a newer version arrives; the sink is
  a log of changes, whose newest version of each key is the current one;
* ``unseen_keys`` (Y5): keys that no earlier run or micro-batch has seen.

The rows of one key in a micro-batch are streamed through the key's function in Arrow
batches, so a hot key needs no more memory than others.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from jobmart.streaming.upserts import run_available

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession):
    """State of the queries started meanwhile is kept in RocksDB, off the heap."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def _keep_one(columns: list[str], order_cols: list[str], latest: bool, once: bool):
    def run(key, parts: Iterator[pd.DataFrame], state):
        best = None
        for part in parts:
            own = part.sort_values(order_cols, ascending=not latest, kind="stable").iloc[[0]]
            if best is None:
                best = own
            else:
                best = pd.concat([best, own]).sort_values(order_cols, ascending=not latest, kind="stable").iloc[[0]]
        version = tuple(str(best[c].iloc[0]) if best[c].dtype.kind in "OM" else best[c].iloc[0].item() for c in order_cols)
        known = state.getOption
        if known is not None and (once or tuple(known) >= version):
            return
        state.update(version)
        yield best[columns]

    return run


def _stateful(stream: DataFrame, keys: list[str], order_cols: list[str], latest: bool, once: bool) -> DataFrame:
    # The state holds the version that won; times as text of fixed width, which sorts alike.
    kinds = {f.name: f.dataType.simpleString() for f in stream.schema.fields}
    state = ", ".join(f"{c} {'string' if kinds[c] in ('string', 'timestamp', 'timestamp_ntz', 'date') else kinds[c]}" for c in order_cols)
    has_key = " and ".join(f"{k} is not null" for k in keys)
    return stream.where(has_key).groupBy(*keys).applyInPandasWithState(
        _keep_one(stream.columns, order_cols, latest, once),
        stream.schema, state, "append", GroupStateTimeout.NoTimeout,
    )


def last_wins(stream: DataFrame, keys: list[str], order_cols: list[str], log_path: str, checkpoint: str) -> StreamingQuery:
    """K5: append each key's newest version to the log of changes whenever it changes."""
    with rocksdb(stream.sparkSession):
        return run_available(_stateful(stream, keys, order_cols, True, False), log_path, checkpoint)


def first_wins(stream: DataFrame, keys: list[str], order_cols: list[str], out_path: str, checkpoint: str) -> StreamingQuery:
    """K7: append each key once, as it arrived first."""
    with rocksdb(stream.sparkSession):
        return run_available(_stateful(stream, keys, order_cols, False, True), out_path, checkpoint)


def unseen_keys(stream: DataFrame, keys: list[str], out_path: str, checkpoint: str) -> StreamingQuery:
    """Append the rows of keys that were never seen, one row for each."""
    with rocksdb(stream.sparkSession):
        return run_available(stream.dropDuplicates(keys), out_path, checkpoint)
