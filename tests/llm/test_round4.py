"""What Spark sizes too low is not broadcast."""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import DataFrame

from jobmart.llm import buckets, components, embedding
from jobmart.llm.common import saved


def _plan(df: DataFrame) -> str:
    """The plan as it ran, if it ran, with what adaptive execution changed."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_dealt_does_not_broadcast_exploded_rows(spark):
    rows = spark.range(40).selectExpr("id AS cls", "explode(array(id % 4, 9, 100 + id)) AS bucket")
    found = buckets.dealt(rows, "bucket", "cls", block=8)
    assert "BroadcastExchange" not in _plan(found)
    pieces: dict = {}
    for r in found.collect():
        pieces.setdefault((r["bucket"], r["_piece"]), []).append((r["cls"], r["_side"]))
    assert "BroadcastExchange" not in _plan(found)
    pairs = set()
    for (bucket, _), piece in pieces.items():
        sides = {side for _, side in piece}
        for (a, x), (b, y) in itertools.combinations(sorted(piece), 2):
            if len(sides) == 1 or x != y:
                pairs.add((bucket, a, b))
    both = list(itertools.combinations(range(40), 2))
    want = {(9, a, b) for a, b in both} | {(a % 4, a, b) for a, b in both if a % 4 == b % 4}
    assert pairs == want


def test_embedding_joins_that_grow_are_not_broadcast(spark, monkeypatch):
    made = []

    def kept(df, name):
        made.append(name)
        assert "BroadcastExchange" not in _plan(df), name
        return saved(df, name)

    monkeypatch.setattr(embedding, "saved", kept)
    monkeypatch.setattr(components, "saved", kept)
    rng = np.random.default_rng(4)
    x = np.repeat(rng.standard_normal((20, 8)), 3, axis=0) + rng.normal(0, 0.01, (60, 8))
    rows = [(k, v.tolist(), k // 3 % 2) for k, v in enumerate(x)] + [(60, None, 0)]
    found = embedding.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    got = {r["vec_id"]: r["component_id"] for r in found.collect()}
    assert "BroadcastExchange" not in _plan(found)
    assert {"vectors", "codes", "met", "linked", "edges", "stars"} <= set(made)
    assert got == {k: k - k % 3 for k in range(61)}
