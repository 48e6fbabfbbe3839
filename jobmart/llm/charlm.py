"""Interpolated Kneser-Ney character models, one per group, in sorted hash arrays.

Counting is one distributed pass: each task packs every character 4-gram into
64 bits, counts them with a sort and emits partial sums; Spark adds them up.
Lower orders need no further pass over the text: their Kneser-Ney counts are
the numbers of distinct left contexts, which are counts over the 4-gram types.
A model holds every type that was counted, whatever the size of its group, so the
discounts come from whole counts; it grows with the number of distinct 4-grams.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmart.llm.common import no_nulls, saved, text_steps

ORDER = 4
PAD, GAP = 1, 32
FLUSH_TYPES = 1_000_000
# No code point from here on is a letter.
LAST_LETTER = 0x32400


def letter_table() -> np.ndarray:
    """Symbol of each code point: lower-case letters and marks keep a 16-bit symbol,
    everything else is the gap symbol (astral letters are folded into 16 bits)."""
    table = np.full(0x110000, GAP, dtype=np.uint16)
    for cp in range(LAST_LETTER):
        if 0xD800 <= cp < 0xE000:
            continue
        char = chr(cp)
        if char.isalpha() or (cp > 0x2FF and unicodedata.category(char)[0] == "M"):
            low = char.lower()
            low_cp = ord(low) if len(low) == 1 else cp
            table[cp] = low_cp if low_cp < 0x10000 else 0xE000 | (low_cp & 0x1FFF)
    return table


def letter_symbols(table: np.ndarray) -> np.ndarray:
    """Whether a symbol stands for a letter; one that only marks have does not."""
    found = np.zeros(1 << 16, dtype=bool)
    found[[table[cp] for cp in range(LAST_LETTER) if table[cp] != GAP and chr(cp).isalpha()]] = True
    return found


def symbols(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts as one symbol array, each led by three pads and ended by a gap, gaps
    in a row merged; and each text's start in it."""
    parts = []
    for text in texts:
        parts.append("\x01\x01\x01")
        parts.append(text.replace("\x01", " ") if "\x01" in text else text)
        parts.append(" ")
    cps = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sym = np.where(cps == PAD, np.uint16(PAD), table[cps])
    gap = sym == GAP
    keep = np.ones(len(sym), dtype=bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    lengths = np.fromiter((len(t) + 4 for t in texts), dtype=np.int64, count=len(texts))
    starts = np.cumsum(lengths) - lengths
    kept_before = np.cumsum(keep) - keep
    return sym[keep], kept_before[starts]


def _numbered(values: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values below ``limit``, ascending, and the number of each value."""
    seen = np.zeros(limit, dtype=bool)
    seen[values] = True
    found = np.flatnonzero(seen)
    del seen
    number = np.empty(limit, dtype=np.int32)
    number[found] = np.arange(len(found), dtype=np.int32)
    return found, number[values]


def grams(sym: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct packed 4-grams ending at symbols that are no pads (ascending), the
    positions of those symbols, and for each position the index of its 4-gram.

    Symbols, then symbol pairs, get dense numbers, so two direct-address tables do
    what sorting all 4-grams would; a huge alphabet falls back to the sort."""
    at = np.flatnonzero(sym != PAD)
    seen = np.bincount(sym, minlength=1 << 16) > 0
    chars = np.flatnonzero(seen).astype(np.uint64)
    dense = (np.cumsum(seen) - 1).astype(np.int32)[sym]
    size = len(chars)
    if size <= 2048:
        pair = dense[:-1] * np.int32(size) + dense[1:]
        pairs, pair = _numbered(pair, size * size)
        if len(pairs) <= 4096:
            four = pair[at - 3] * np.int32(len(pairs)) + pair[at - 1]
            found, four = _numbered(four, len(pairs) ** 2)
            two = (chars[pairs // size] << np.uint64(16)) | chars[pairs % size]
            codes = (two[found // len(pairs)] << np.uint64(32)) | two[found % len(pairs)]
            return codes, at, four
    s = sym.astype(np.uint64)
    code = s[at] | (s[at - 1] << np.uint64(16)) | (s[at - 2] << np.uint64(32)) | (s[at - 3] << np.uint64(48))
    codes, inverse = np.unique(code, return_inverse=True)
    return codes, at, inverse


def _count_grams(table: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def flush():
            for group, (codes, counts) in sums.items():
                yield pd.DataFrame({"grp": group, "code": codes.view(np.int64), "n": counts})
            sums.clear()

        for pdf in batches:
            for group, part in pdf.groupby("grp", sort=False):
                texts = no_nulls(part["text"])
                for a, b in text_steps(texts):
                    codes, _, inverse = grams(symbols(texts[a:b], table)[0])
                    counts = np.bincount(inverse, minlength=len(codes))
                    if group in sums:
                        old, n = sums[group]
                        both = np.concatenate([old, codes])
                        codes, inverse = np.unique(both, return_inverse=True)
                        counts = np.bincount(inverse, weights=np.concatenate([n, counts])).astype(np.int64)
                    sums[group] = (codes, counts.astype(np.int64))
            if sum(len(c) for c, _ in sums.values()) > FLUSH_TYPES:
                yield from flush()
        yield from flush()

    return run


def count_types(rows: DataFrame) -> DataFrame:
    """(grp, code, n) for every character 4-gram of ``rows`` (grp, text)."""
    parts = rows.select("grp", "text").mapInPandas(_count_grams(letter_table()), "grp string, code long, n long")
    return saved(parts.groupBy("grp", "code").agg(F.sum("n").alias("n")), "char-types")


def _lower(keys: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The grams of ``order`` symbols that end the (distinct) ``keys``, and how many
    distinct left contexts each has."""
    return np.unique(keys & np.uint64((1 << (16 * order)) - 1), return_counts=True)


class CharModel:
    """Interpolated Kneser-Ney probabilities of one group, all as sorted arrays."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, size: int):
        index = np.argsort(codes)
        grams_by_order = {ORDER: (codes[index], counts[index])}
        for order in range(ORDER - 1, 0, -1):
            grams_by_order[order] = _lower(grams_by_order[order + 1][0], order)
        self.uniform = -np.log(size)
        self.keys: dict[int, np.ndarray] = {}
        self.logp: dict[int, np.ndarray] = {}
        self.contexts: dict[int, np.ndarray] = {}
        self.backoff: dict[int, np.ndarray] = {}
        for order in range(1, ORDER + 1):
            keys, n = grams_by_order[order]
            n = n.astype(np.float64)
            ones, twos = max((n == 1).sum(), 1), (n == 2).sum()
            discount = min(max(ones / (ones + 2 * twos), 0.1), 0.95)
            context = keys >> np.uint64(16)
            own, first, inverse = np.unique(context, return_index=True, return_inverse=True)
            whole = np.add.reduceat(n, first)
            direct = np.maximum(n - discount, 0) / whole[inverse]
            rest = np.maximum(1 - np.add.reduceat(direct, first), 1e-9)
            below = np.exp(self.log_prob(keys, order - 1))
            self.keys[order] = keys
            self.logp[order] = np.log(direct + rest[inverse] * below).astype(np.float32)
            self.contexts[order] = own
            self.backoff[order] = np.log(rest).astype(np.float32)

    def log_prob(self, codes: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Natural log of P(last symbol | the ``order`` - 1 before it)."""
        out = np.full(len(codes), self.uniform)
        for k in range(1, order + 1):
            mask = np.uint64((1 << (16 * k)) - 1) if k < 4 else np.uint64(0xFFFFFFFFFFFFFFFF)
            key = codes & mask
            context = key >> np.uint64(16)
            at = np.minimum(np.searchsorted(self.contexts[k], context), len(self.contexts[k]) - 1)
            out = out + np.where(self.contexts[k][at] == context, self.backoff[k][at], 0.0)
            at = np.minimum(np.searchsorted(self.keys[k], key), len(self.keys[k]) - 1)
            out = np.where(self.keys[k][at] == key, self.logp[k][at], out)
        return out


def fit(rows: DataFrame) -> dict[str, CharModel]:
    """One model per ``grp`` of ``rows`` (grp, text); an empty table gives no model."""
    counted = count_types(rows).toPandas()
    parts = {
        group: (part["code"].to_numpy().view(np.uint64), part["n"].to_numpy())
        for group, part in counted.groupby("grp", sort=True)
    }
    last = [np.unique(codes & np.uint64(0xFFFF)) for codes, _ in parts.values()]
    alphabet = len(np.unique(np.concatenate(last))) + 1 if last else 1
    return {group: CharModel(codes, n, alphabet) for group, (codes, n) in parts.items()}
