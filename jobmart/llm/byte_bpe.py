"""Operator 3, byte-level BPE encoding and decoding in linear time.

The bytes of a piece are mapped to Latin-1, so an Aho-Corasick automaton over the
vocabulary finds the longest token, then the longest from its end, and so on, in one
pass; mostly each may follow the one before, and they are the ids. Else the encoder
takes the longest token, goes on to a shorter one (the longest token that begins it) if
the token can't follow the one before, and backtracks where none can; a place that
failed once is never tried again. Two tokens may follow each other if merging their
joined bytes keeps the border between them, which is looked up by undoing the merges on
both sides of the border and memoised by pair. The result is the one that merging by rank gives.

A piece that is a token as a whole is that token. Tokens that merging can't reach take
part in nothing else. Pieces are memoised by task; texts are split by the pattern.

Defined results: a null text is empty: no tokens, the digests of the empty string.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from jobmart.llm.common import mapped, read_table

RANKS = "byte_bpe_multi_50k.tiktoken"
MAX_MEMO = 400_000
MAX_PAIRS = 200_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (one base64 token and its rank a line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def last_merge(ranks: dict[bytes, int], token: bytes, rank: int) -> tuple[int, int] | None:
    """What merging by rank leaves of ``token`` just before its last merge; None if
    merging does not reach it."""
    pieces = [token[i : i + 1] for i in range(len(token))]
    while len(pieces) > 2:
        best, at = rank, -1
        for i in range(len(pieces) - 1):
            found = ranks.get(pieces[i] + pieces[i + 1])
            if found is not None and found < best:
                best, at = found, i
        if at < 0:
            return None
        pieces[at : at + 2] = [pieces[at] + pieces[at + 1]]
    return ranks[pieces[0]], ranks[pieces[1]]


class Tables:
    """What encoding needs of a vocabulary (bytes to rank, all single bytes included);
    made once on the driver, a few MB for 50,000 tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        # The two tokens that each token is merged from last; a single byte is its own parts.
        self.parts: dict[int, tuple[int, int]] = {}
        for token, rank in ranks.items():
            split = (rank, rank) if len(token) == 1 else last_merge(ranks, token, rank)
            if split is not None:
                self.parts[rank] = split
        # The longest token that begins each token.
        self.shorter: dict[int, int] = {}
        for token, rank in ranks.items():
            for end in range(len(token) - 1, 0, -1):
                found = ranks.get(token[:end])
                if rank in self.parts and found in self.parts:
                    self.shorter[rank] = found
                    break


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, tables: Tables):
        import ahocorasick

        self.ranks, self.parts, self.shorter = tables.ranks, tables.parts, tables.shorter
        self.token = dict(zip(self.ranks.values(), self.ranks.keys(), strict=True))
        self.merged = {split: rank for rank, split in self.parts.items() if len(self.token[rank]) > 1}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        for rank in self.parts:
            self.automaton.add_word(self.token[rank].decode("latin-1"), rank)
        self.automaton.make_automaton()
        # How far before its last byte each token begins.
        self.back = {rank: len(token) - 1 for rank, token in self.token.items()}

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens keeps the border between them."""
        known = self.pairs.get((left, right))
        if known is not None:
            return known
        a, b, limit, answer = left, right, len(self.token) + 1, None
        while answer is None:
            # Would a merge across the border have come before the one that is undone next?
            across = self.merged.get((a, b))
            if across is not None and across < limit:
                answer = False
                break
            undo_left = a > b
            if undo_left and len(self.token[a]) == 1:
                undo_left = False
            if not undo_left and len(self.token[b]) == 1:
                if len(self.token[a]) == 1:
                    answer = True
                    break
                undo_left = True
            if undo_left:
                # On the left a merge of rank a comes first where ranks tie.
                limit, a = a, self.parts[a][1]
            else:
                limit, b = b + 1, self.parts[b][0]
        if len(self.pairs) > MAX_PAIRS:
            self.pairs.clear()
        self.pairs[(left, right)] = answer
        return answer

    def encode_piece(self, piece: bytes) -> list[int]:
        """Token ids of one piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        back, known = self.back, self.pairs
        latin, matches = piece.decode("latin-1"), self.automaton.iter_long
        # The longest token, then the longest from its end, and so on: where each may
        # follow the one before, these are the ids.
        greedy, before = [], -1
        for _, rank in matches(latin):
            if before >= 0:
                fits = known.get((before, rank))
                if not (self.compatible(before, rank) if fits is None else fits):
                    break
            greedy.append(rank)
            before = rank
        else:
            return greedy
        # The longest token from a place, looked for where the encoder comes to.
        longest: list[int | None] = [None] * len(piece)
        out: list[int] = []
        closed = bytearray(len(piece) + 1)
        at, following = 0, greedy[0]
        while True:
            rank, before = following, out[-1] if out else -1
            while rank is not None:
                end = at + back[rank] + 1
                if not closed[end]:
                    fits = before < 0 or known.get((before, rank))
                    if self.compatible(before, rank) if fits is None else fits:
                        break
                rank = self.shorter.get(rank)
            if rank is None:
                # Nothing fits here: the token before was wrong.
                closed[at] = 1
                following = out.pop()
                at -= back[following] + 1
                continue
            out.append(rank)
            at = end
            if at == len(piece):
                return out
            following = longest[at]
            if following is None:
                following = longest[at] = next(matches(latin, at))[1]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class TextCodec:
    """Whole texts: the pieces of the pattern, each encoded separately and memoised as
    its ids in decimal, joined by commas; ids are decoded by such runs, memoised too."""

    def __init__(self, codec: Codec, pattern: str):
        import regex

        self.codec, self.split = codec, regex.compile(pattern).findall
        # Texts and bytes only: the collector of cycles does not walk through them.
        self.memo: dict[str, str] = {}
        self.bytes: dict[str, bytes] = {}

    def _piece(self, piece: str) -> str:
        run = ",".join(map(str, self.codec.encode_piece(piece.encode("utf-8"))))
        if len(self.memo) > MAX_MEMO:
            self.memo.clear()
        self.memo[piece] = run
        return run

    def runs(self, text: str) -> list[str]:
        """The ids of each piece of a text."""
        get, piece = self.memo.get, self._piece
        return [get(p) or piece(p) for p in self.split(text)]

    def encode(self, text: str) -> list[int]:
        return [int(i) for run in self.runs(text) for i in run.split(",")]

    def _run(self, run: str) -> bytes:
        decoded = self.codec.decode(map(int, run.split(",")))
        if len(self.bytes) > MAX_MEMO:
            self.bytes.clear()
        self.bytes[run] = decoded
        return decoded

    def decode_runs(self, runs: list[str]) -> bytes:
        """The bytes that runs of ids stand for."""
        get, decode = self.bytes.get, self._run
        return b"".join([get(r) or decode(r) for r in runs])

    def decode(self, ids: list[int]) -> bytes:
        return self.codec.decode(ids)


def _digests(tables: Tables, pattern: str):
    def make():
        codec = TextCodec(Codec(tables), pattern)

        def work(texts: list[str]):
            count, ids_sha, decoded_sha = [], [], []
            for text in texts:
                runs = codec.runs(text)
                ids = ",".join(runs)
                count.append(ids.count(",") + 1 if ids else 0)
                ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                decoded_sha.append(hashlib.sha256(codec.decode_runs(runs)).hexdigest())
            return np.array(count, dtype=np.int64), ids_sha, decoded_sha

        return work

    return make


def digests(docs: DataFrame, path: str, pattern: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Each row's token count and the digests of its ids and of the decoded bytes."""
    added = {"_tokens": "long", "_ids": "string", "_decoded": "string"}
    return mapped(docs, text_col, docs.columns if keep is None else keep, added, _digests(Tables(load_ranks(path)), pattern))


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the token ids of the text (``_ids``, decimal, joined by commas)."""

    tables = Tables(load_ranks(path))

    def make():
        codec = TextCodec(Codec(tables), pattern)
        return lambda texts: ([",".join(codec.runs(t)) for t in texts],)

    return mapped(docs, text_col, docs.columns, {"_ids": "string"}, make)


def decode(docs: DataFrame, path: str, ids_col: str = "_ids") -> DataFrame:
    """``docs`` with the text that the ids stand for (``_decoded``; bytes that are no
    UTF-8 become the replacement character)."""

    tables = Tables(load_ranks(path))

    def make():
        codec = Codec(tables)
        return lambda rows: (
            [codec.decode([int(i) for i in r.split(",")] if r else []).decode("utf-8", "replace") for r in rows],
        )

    return mapped(docs, ids_col, docs.columns, {"_decoded": "string"}, make)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every whole text of ``documents``, and the text they decode to."""
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = digests(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep=["doc_id"])
    return found.toDF("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
