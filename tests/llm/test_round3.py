"""Operators 11 to 13 against brute force, and their defined edge cases."""

from __future__ import annotations

import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobmart.llm import charlm, collocation, embedding, hard_negatives, language, suffix_dedup, toxicity
from jobmart.llm.suffix_array import Packer, Store, byte_suffixes


def _suffixes(pieces, memory, block, cap):
    store = Store(memory, block)
    packer = Packer(store)
    for piece in pieces:
        packer.add([piece])
    text, _ = packer.text()
    out = []
    byte_suffixes(text, store, lambda items: out.append(items.copy()), cap)
    return bytes(text), np.concatenate(out)[::-1]


@pytest.mark.parametrize("seed", range(40))
@pytest.mark.parametrize(("memory", "block"), [(1 << 30, 1 << 16), (200, 4), (1000, 16)])
def test_suffix_array_and_common_prefixes(seed, memory, block):
    rng = random.Random(seed)
    alphabet = rng.choice(["ab", "a", "abc", "abcdefgh ", "é\x00"])
    pieces = ["".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 3, 10, 50]))).encode() for _ in range(rng.randint(0, 8))]
    pieces = [p * rng.randint(1, 6) for p in pieces] + pieces
    cap = rng.choice([3, 10, 100])
    text, got = _suffixes(pieces, memory, block, cap)
    order = sorted(range(len(text)), key=lambda i: text[i:])
    near = [sum(1 for _ in itertools.takewhile(lambda xy: xy[0] == xy[1], zip(text[x:], text[y:]))) for x, y in itertools.pairwise(order)]
    assert got["pos"].tolist() == order
    assert got["near"][:-1].tolist() == [min(x, cap) for x in near]


def _brute_dedup(rows, length):
    seen, out = set(), {}
    for i, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        covered = bytearray(len(data))
        for s in range(len(data) - length + 1):
            if data[s : s + length] in seen:
                covered[s : s + length] = b"\1" * length
            seen.add(data[s : s + length])
        kept = bytes(x for x, c in zip(data, covered) if not c)
        runs = sum(1 for k in range(len(covered)) if covered[k] and (k == 0 or not covered[k - 1]))
        out[i] = (len(data), sum(covered), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("sizes", [{}, {"length": 30, "anchor": 8, "large_group": 3}, {"length": 30, "anchor": 8, "memory": 2000, "block": 64}])
def test_dedup_equals_brute_force(spark, sizes):
    rng = random.Random(len(sizes))
    words = ["alpha", "beta", "gamma", "delta", "día", "x", "yy"]
    base = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(4)]
    rows = [(None, base[0]), (0, None), (1, ""), (2, "a" * 900), (3, "ab" * 400), (4, base[1]), (4, base[1])]
    for i in range(5, 40):
        rows.append((i, rng.choice(base) + rng.choice(base)[rng.randint(0, 80) :] + rng.choice(words) * rng.randint(0, 9)))
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, doc int, found string")
    got = [tuple(r) for r in suffix_dedup.dedup(docs, **sizes).collect()]
    assert len(got) == len(rows)
    assert {r[0]: r[1:] for r in got} == _brute_dedup(rows, sizes.get("length", 100))
    assert suffix_dedup.dedup(docs.where("false"), **sizes).count() == 0


def test_dedup_of_a_very_long_text(spark):
    rng = random.Random(1)
    long = "".join(rng.choice("abcdefghij ") for _ in range(3_000_000))
    docs = spark.createDataFrame([(1, long), (2, "x" + long[1_000_000:2_500_000])], "doc_id long, text string")
    got = {r["doc_id"]: r for r in suffix_dedup.dedup(docs).collect()}
    assert got[1]["n_removed"] == 0 and got[2]["n_removed"] == 1_500_000


def _brute_phrases(rows, size, least):
    import re
    from collections import Counter

    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(lower)):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            totals[lang or "und"] += len(words)
            for k in range(1, size + 1):
                for i in range(len(words) - k + 1):
                    counts[lang or "und", tuple(words[i : i + k])] += 1
    cand = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    out = set()
    for (lang, p), a in cand.items():
        inside = any(
            q[0] == lang and len(q[1]) > len(p) and b >= a and any(q[1][i : i + len(p)] == p for i in range(len(q[1]) - len(p) + 1))
            for q, b in cand.items()
        )
        if not inside:
            cuts = [(1000 * a * totals[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.add((lang, " ".join(p), a, counts[lang, p[:k]], counts[lang, p[k:]], totals[lang], k, score))
    return out


def test_phrases_equal_brute_force(spark):
    rng = random.Random(3)
    words = ["Of", "the", "State", "é", "x1", "ÀB", "\x00"]
    rows = [(None, "en"), ("", None), ("a. b", None)]
    for _ in range(120):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(1, 30)))
        rows.append((text.replace("x1", rng.choice(["x1", "x1,", "x1\t ", "\n", "x1.."])), rng.choice(["en", "de", None])))
    rows += [("one two three four five six seven", "en")] * 12
    docs = spark.createDataFrame([(*r, 1) for r in rows], "text string, lang string, n int")
    for size in (5, 3):
        got = {tuple(r) for r in collocation.phrases(docs, size=size, least=8).select("lang", "phrase", "a", "l", "r", "n", "cut", "score").collect()}
        assert got == _brute_phrases(rows, size, 8)
    assert collocation.phrases(docs.where("false")).count() == 0
    top = collocation.top_phrases(collocation.phrases(docs, least=8), 3).collect()
    assert sorted({r["rank"] for r in top}) == [1, 2, 3]


def test_rare_rows_of_frequent_pairs_make_no_edges(spark):
    from collections import Counter

    rng = random.Random(9)
    words = [f"w{i}" for i in range(20)]
    rows = [(" ".join(rng.choice(words) for _ in range(50)), "en") for _ in range(160)]
    rows += [("w0 w1 w2 w3 w4 w5 w6", "en")] * 12 + [("w0 w1 w2, w3 w4", "de")] * 12
    docs = spark.createDataFrame(rows, "text string, lang string")
    got = {tuple(r) for r in collocation.phrases(docs, least=10).select("lang", "phrase", "a", "l", "r", "n", "cut", "score").collect()}
    assert got == _brute_phrases(rows, 5, 10)

    counts = Counter((lang, *w[i : i + 3]) for text, lang in rows for w in [text.replace(",", " ,").split(" ")] for i in range(len(w) - 2))
    frequent = spark.createDataFrame([(lang, w, 10) for lang in ("en", "de") for w in words], "lang string, word string, n long")
    made = collocation.edges(docs.select("lang", "text"), frequent, 5, 10).collect()
    assert made
    for row in made:
        gram = row["gram"].split(" ")
        assert len(gram) == row["words"]
        assert all(counts[row["lang"], *gram[i : i + 3]] >= 10 for i in range(len(gram) - 2)), row


def _brute_negatives(rows):
    usable = {}
    for i, label, v in rows:
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v):
            usable.setdefault((i, label, tuple(v)), [int(np.floor(256 * x)) for x in v])
    out = set()
    for (i, label, _), x in usable.items():
        if i % 5:
            continue
        score = lambda y: sum(a * b for a, b in zip(x, y))
        others = [(-score(y), j, own) for (j, own, _), y in usable.items() if j != i and len(y) == len(x)]
        best = sorted({(s, j) for s, j, own in others if own == label})[:5]
        for p, j in best:
            band = sorted({(s, k) for s, k, own in others if own != label and 50 * -p <= 100 * -s <= 95 * -p})[:3]
            out |= {(i, j, r, k, -p, -s) for r, (s, k) in enumerate(band, 1)}
    return out


def test_hard_negatives_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        size = 7 if i % 10 == 3 else 24
        v = (np.round(rng.normal(size=size) + (i % 4), 1)).tolist()
        rows.append((i, int(rng.integers(0, 3)), v))
    rows += [(401, None, [1.0] * 24), (402, 1, None), (403, 1, [None] * 24), (404, 1, [float("nan")] * 24), (405, 1, [float("inf")] * 24)]
    rows += [(None, 1, [1.0] * 24), (406, 1, []), (407, 1, [1e300] * 24), rows[5], rows[10], (10, 0, [0.0] * 24)]
    usable = [r for r in rows if r[0] != 407]
    table = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, label int, embedding array<double>, score int")
    got = [tuple(r) for r in hard_negatives.mine(table, F.expr("vec_id % 5 = 0")).collect()]
    assert set(got) == _brute_negatives(usable)
    assert hard_negatives.mine(table.where("false"), F.lit(True)).count() == 0


def test_segment_bounds_hold():
    rng = np.random.default_rng(0)
    a, b = (
        hard_negatives.Vectors(np.arange(n), np.zeros(n), rng.integers(-300, 300, size=(n, 33))) for n in (20, 30)
    )
    true = a.values @ b.values.T
    low, high = hard_negatives.bounds(a, b)
    assert (low <= true).all() and (true <= high).all()
    i, j = (x.ravel() for x in np.indices(true.shape))
    finer = hard_negatives.pair_bounds(a, b, i, j, 1)
    assert (finer[0] <= true.ravel()).all() and (true.ravel() <= finer[1]).all()
    assert (finer[1] - finer[0]).mean() < (high - low).mean()


def _small_model():
    texts = ["you are a stupid idiot and a moron", "the cat sat on the mat, a fat cat", "most idiots are stupid"] * 9
    codes, _, inverse = charlm.grams(charlm.symbols(texts, charlm.letter_table())[0])
    return charlm.CharModel(codes, np.bincount(inverse, minlength=len(codes)), 30)


def test_kneser_ney_equals_a_plain_one():
    from collections import Counter

    texts = ["abracadabra", "banana band", "abba"]
    codes, _, inverse = charlm.grams(charlm.symbols(texts, charlm.letter_table())[0])
    model = charlm.CharModel(codes, np.bincount(inverse, minlength=len(codes)), 9)
    top = Counter()
    for text in texts:
        padded = "\x01\x01\x01" + text + " "
        top.update(padded[i - 3 : i + 1] for i in range(3, len(padded)))
    counts = {4: top}
    for order in (3, 2, 1):
        counts[order] = Counter(g[1:] for g in counts[order + 1])

    def prob(gram):
        if not gram:
            return 1 / 9
        own = counts[len(gram)]
        ones, twos = max(sum(n == 1 for n in own.values()), 1), sum(n == 2 for n in own.values())
        discount = min(max(ones / (ones + 2 * twos), 0.1), 0.95)
        after = {g: n for g, n in own.items() if g[:-1] == gram[:-1]}
        if not after:
            return prob(gram[1:])
        total = sum(after.values())
        direct = max(after.get(gram, 0) - discount, 0) / total
        rest = 1 - sum(max(n - discount, 0) for n in after.values()) / total
        return direct + rest * prob(gram[1:])

    for gram in ["abra", "bana", "zzza", "\x01\x01\x01a", "and ", "xabr", "naxn"]:
        code = np.array([sum(ord(c) << (16 * (3 - i)) for i, c in enumerate(gram))], dtype=np.uint64)
        assert np.exp(model.log_prob(code)[0]) == pytest.approx(prob(gram), rel=1e-5)


@pytest.mark.parametrize("token", ["m0r", "b*t", "caat", "x-y", "b#d", "h*", "f**", "1d10t", "mоr", "a b c", "c**t"])
def test_viterbi_equals_all_paths(token):
    restorer = toxicity.Restorer(_small_model())
    mask = [(c, toxicity.MASK_COST) for c in toxicity.LETTERS] + [("", toxicity.DROP_COST * 4)]
    steps = []
    for options in restorer.lattice(token):
        steps += [mask] * abs(options) if isinstance(options, int) else [options]
    best = {}
    for path in itertools.product(*steps):
        cost, context, text = sum(c for _, c in path), "   ", ""
        for char in "".join(t for t, _ in path) + " ":
            if char == " " and context[-1] == " ":
                continue
            gram = context + char
            if gram not in restorer.costs:
                restorer._look_up([gram])
            cost += restorer.costs[gram]
            context, text = context[1:] + char, text + char
        best[text.strip()] = min(cost, best.get(text.strip(), np.inf))
    read = restorer.restore([token])[token].strip()
    assert best[read] == pytest.approx(min(best.values()), abs=1e-3)


@pytest.mark.parametrize(
    ("text", "word"),
    [("st**id", "stupid"), ("i**ot", "idiot"), ("stu###", "stupid"), ("mo***", "moron"), ("st00pid", "stupid"), ("s****d", "stupid"),
     ("ｍｏｒｏｎ", "moron"), ("mоron", "moron"), ("ⅿoron", "moron")],
)
def test_masks_and_look_alikes_are_restored(text, word):
    [words] = toxicity.words_of([text], toxicity.Restorer(_small_model()))
    assert word.encode() in words


def test_scoring_of_likely_tokens_only_changes_nothing():
    weights = {b" stupid": 2.0, b"mor": 1.0, b" cat": 0.5}
    texts = ["st**id cats", "a m0r0n sat", "c4t!", "nothing of it, aaall right", "", "m o r o n", "Ünstupid stupidd"]
    scorer, restorer = toxicity.Scorer(weights), toxicity.Restorer(_small_model())
    assert list(scorer.of(texts, restorer)) == [scorer.evidence(w) for w in toxicity.words_of(texts, restorer)]


def test_letters_of_language_id():
    table = charlm.letter_table()
    _, letters, _, _ = language.entropies(["ab", "́́", "\U00030010", "12"], table, charlm.letter_symbols(table), [])
    assert letters.tolist() == [2, 0, 1, 0]


# ---- operator 8: norms, ids, the index ------------------------------------------------


def test_embedding_norms_beyond_double_range(spark):
    rows = [
        (1, [1e-200, 2e-200], 0), (2, [2.0, 4.0], 0), (3, [1e300, 2e300], 0), (4, [-1e300, 2e300], 0),
        (5, [5e-324, 1e-323], 0), (6, [4.0, 2.0], 0), (7, [1e308, 1e308, 1e308], 0),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding.near_duplicates(df).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 5: (3, 1), 4: (0, 4), 6: (0, 6), 7: (0, 7)}


def test_embedding_null_and_repeated_ids(spark):
    one, two = [1.0, 0.0, 0.5], [-1.0, 3.0, 0.0]
    rows = [(None, one, 0), (5, one, 0), (5, one, 0), (None, two, 0), (7, two, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(
        ((r["vec_id"] or 0, r["n_links"], r["component_id"]) for r in embedding.near_duplicates(df).collect()), key=str
    )
    assert got == [(0, 0, None), (0, 2, 5), (5, 2, 5), (5, 2, 5), (7, 0, 7)]


def test_embedding_index_widens_with_the_table():
    sizes = [0, 1, 1000, 10**6, 10**9]
    found = [embedding.multi_index(n) for n in sizes]
    assert [f.width for f in found] == [12, 12, 14, 24, 34]
    assert [len(f.starts) for f in found] == sorted(len(f.starts) for f in found)
    rng = np.random.default_rng(3)
    code = rng.integers(-(2**63), 2**63 - 1, 50, dtype=np.int64)
    for index in found:
        for t, start in enumerate(index.starts):
            bits = [f"{c & (2**64 - 1):064b}"[::-1] for c in code.tolist()]
            want = [int((b + b)[start : start + index.width][::-1], 2) for b in bits]
            assert index.substring(code, t).tolist() == want


def test_embedding_substrings_in_spark_equal_numpy(spark):
    rng = np.random.default_rng(5)
    code = rng.integers(-(2**63), 2**63 - 1, 40, dtype=np.int64)
    index = embedding.multi_index(10**7)
    df = spark.createDataFrame([(int(c), t) for c in code for t in range(len(index.starts))], "code long, tbl int")
    for r in df.select("code", "tbl", index.column().alias("sub")).collect():
        assert r["sub"] == index.substring(np.array([r["code"]], dtype=np.int64), r["tbl"])[0]


def test_embedding_short_vectors_against_brute_force(spark):
    rng = np.random.default_rng(17)
    bases = np.repeat(rng.standard_normal((150, 16)), 4, axis=0)
    x = bases + rng.normal(0, 0.25, bases.shape)
    df = spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (u @ u.T >= 0.93).sum(1) - 1
    got = np.array([r["n_links"] for r in embedding.near_duplicates(df).orderBy("vec_id").collect()])
    assert (got <= want).all() and got.sum() >= 0.99 * want.sum() > 300


def test_bpe_looks_for_longest_tokens_only_where_it_needs_them():
    """Ids are those of merging by rank, also where the longest tokens don't follow each
    other, without a scan for all tokens of a piece; memoised values are flat."""
    import random

    from jobmart.llm import byte_bpe as B

    def merged(ranks, piece):
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            found = [(ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks]
            if not found:
                return [ranks[p] for p in parts]
            _, i = min(found)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    ranks = {bytes([i]): i for i in range(256)}
    for token in (b"ab", b"bc", b"abc", b"cd", b"bcd", b"aa", b"aab", b"dd", b"abcd"):
        ranks[token] = len(ranks)
    codec = B.Codec(B.Tables(ranks))

    class NoScan:
        iter_long = codec.automaton.iter_long

    codec.automaton = NoScan()
    draw = random.Random(3)
    pieces = ["".join(draw.choices("abcd", k=draw.randint(1, 12))) for _ in range(2000)]
    for piece in pieces:
        if piece.encode() not in ranks:
            assert codec.encode_piece(piece.encode()) == merged(ranks, piece.encode()), piece
    texts = B.TextCodec(codec, "[a-d]+| ")
    text = " ".join(pieces)
    assert texts.decode_runs(texts.runs(text)) == text.encode() == texts.decode(texts.encode(text))
    assert all(isinstance(run, str) for run in texts.memo.values())
