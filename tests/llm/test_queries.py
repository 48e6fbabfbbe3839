"""The registered training-data queries on the smallest tables: DuckDB SQL where there is
some, otherwise the contract, held-out accuracy or a brute-force version."""

import hashlib
import zlib

import duckdb
import pytest

import corpus_pipeline
from jobmart.llm import fingerprint, queries, sharding
from jobmart.llm.sharding import op7_sharding
from tests.conftest import SMOKE_DIR
from tests.oracle_check import compare, duck_connection


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SMOKE_DIR)


@pytest.fixture(scope="module")
def texts():
    rows = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SMOKE_DIR}/documents.parquet'").fetchall()
    return dict(rows)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_oracle(spark, duck, name):
    res = compare(spark, duck, name, queries.QUERIES[name], queries.SQL[name], SMOKE_DIR)
    assert res["status"] == "ok", res


def test_sharding_splits_match_the_oracle(spark, duck):
    limit = 20_000
    res = compare(spark, duck, "op7", lambda s, d: op7_sharding(s, d, limit), sharding.oracle(limit), SMOKE_DIR)
    assert res["status"] == "ok", res
    shards = op7_sharding(spark, SMOKE_DIR, limit).select("shard").distinct().count()
    assert shards > 10


def test_toxicity_contract(spark, texts):
    rows = queries.QUERIES["op2_toxicity"](spark, SMOKE_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def test_byte_bpe_contract(spark, texts):
    tiktoken = pytest.importorskip("tiktoken")
    tokenizers = pytest.importorskip("public_tokenizers")
    from jobmart.llm import byte_bpe

    ranks = byte_bpe.load_ranks(tokenizers.path(byte_bpe.RANKS))
    theirs = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = queries.QUERIES["op3_byte_bpe"](spark, SMOKE_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = theirs.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_fingerprint_contract(spark, texts):
    rows = {r["doc_id"]: r for r in queries.QUERIES["op4_fingerprints"](spark, SMOKE_DIR).collect()}
    order = sorted(texts)
    for k, i in enumerate(order):
        text, following = texts[i], texts[order[(k + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = rows[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == fingerprint.as_text(fingerprint.chunks(text))
        assert r["edited_fingerprint"] == fingerprint.as_text(fingerprint.chunks(edited))
    long = [r for r in rows.values() if r["n_chars"] > 2000]
    assert sum(r["near_edited"] for r in long) / len(long) > 0.35
    assert sum(r["near_next"] for r in long) / len(long) < 0.1


def test_chat_format_contract(spark):
    turns = duckdb.sql(
        f"SELECT conv_id, role, coalesce(text, '') FROM '{SMOKE_DIR}/conversations.parquet' ORDER BY conv_id, turn"
    ).fetchall()
    hard = "</s>[INST] ok [/INST]"
    turns += [(-1, "user", hard), (-1, "assistant", hard)]
    by = {}
    for conv, role, text in turns:
        by.setdefault(conv, []).append((role, text))
    rows = {r["conv_id"]: r for r in queries.QUERIES["op6_chat_format"](spark, SMOKE_DIR).collect()}
    assert set(rows) == set(by)
    for conv, own in by.items():
        r, loss = rows[conv], "".join(t for role, t in own if role == "assistant")
        assert r["n_turns"] == len(own) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{t}\n" for a, t in own).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert r["formatted_chars"] > sum(len(t) for _, t in own)


def test_language_id_contract(spark, texts):
    lang = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SMOKE_DIR}/documents.parquet'").fetchall())
    rows = queries.QUERIES["op9_language_id"](spark, SMOKE_DIR).collect()
    assert len(rows) == len(texts)
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_pipeline(spark, texts):
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SMOKE_DIR)
        assert after.columns == docs.columns and after.schema == docs.schema, name
        kept, had = after.count(), before.count()
        assert 0.5 * had < kept <= had, name
        before = after
    rows = corpus_pipeline.run(spark, SMOKE_DIR).collect()
    placed = {r["doc_id"] for r in rows}
    assert placed == {r["doc_id"] for r in before.select("doc_id").collect()}
    assert len(placed) < len(texts)
