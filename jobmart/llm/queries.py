"""Registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from jobmart.llm import collocation, embedding, hard_negatives, ngram_join, secrets, sharding
from jobmart.llm.byte_bpe import op3_byte_bpe
from jobmart.llm.chat import op6_chat_format
from jobmart.llm.collocation import op12_phrase_collocations
from jobmart.llm.embedding import op8_embedding_near_dedup
from jobmart.llm.fingerprint import op4_fingerprints
from jobmart.llm.hard_negatives import op13_hard_negatives
from jobmart.llm.language import op9_language_id
from jobmart.llm.ngram_join import op1_ngram_jaccard_join
from jobmart.llm.packing import op10_best_fit_packing
from jobmart.llm.secrets import op5_secret_scan
from jobmart.llm.sharding import op7_sharding
from jobmart.llm.suffix_dedup import op11_suffix_dedup
from jobmart.llm.toxicity import op2_toxicity

QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_toxicity": op2_toxicity,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_fingerprints": op4_fingerprints,
    "op5_secret_scan": op5_secret_scan,
    "op6_chat_format": op6_chat_format,
    "op7_sharding": op7_sharding,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_language_id": op9_language_id,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_hard_negatives": op13_hard_negatives,
}

SQL = {
    "op1_ngram_jaccard_join": ngram_join.ORACLE,
    "op5_secret_scan": secrets.oracle(),
    "op7_sharding": sharding.oracle(),
    "op8_embedding_near_dedup": embedding.ORACLE,
    "op12_phrase_collocations": collocation.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
