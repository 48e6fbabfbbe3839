"""Operator 2, toxicity: noisy-channel deobfuscation, then a score of the restored text.

1. ``charlm`` counts the character 4-grams of all texts: the language model.
2. A token is a lattice: leetspeak characters stand for letters, separators inside a
   word may be deleted, runs of a letter may shrink, a mask may be any letter. A run of
   single letters is one token, in which each space may be deleted or kept, so its
   reading may have several words. A Viterbi search over the contexts of the language
   model finds the likeliest reading (``Restorer``). A token made of letters alone, none
   of them doubled, has one path only, which is itself, so only the others are decoded.
3. Words and word beginnings of the restored texts that mark toxic documents become a
   lexicon (counts of distinct texts by label, a likelihood-ratio test), and a logistic
   model over what a text has of it gives the score.

Labels come from rows whose crc32(doc_id) mod 5 is not 0 only: the lexicon from
remainders 1 to 3, the logistic model from remainder 4; at most ``MAX_LABELLED``
labelled rows, chosen by a hash of the id, are learned from. Label, language,
source and id are never inputs of a score.

Defined results: a null or empty text has no lexicon entry and gets the score of
such a text; labels of 0 and 1 only count, rows with the same id and label once;
without any positive label every score is 0.0. Repeated rows are scored alike.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import batched

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.llm import charlm
from jobmart.llm.common import fold, mapped, no_nulls, read_table, saved, text_steps

FOLDS, HELD_OUT, FIT_FOLD = 5, 0, 4
# Labelled rows that are learned from at most (chosen by a hash of the id).
MAX_LABELLED = 200_000
MIN_DOCS = 3
# A lexicon entry's significance and enrichment at least.
MIN_SIGMAS, MIN_ENRICHMENT = 4.5, 4.0
PREFIXES = (4, 5, 6, 7)
FLUSH_FEATURES = 200_000
# Slots of crc32 in which negative features that no candidate shares are left out early.
SLOTS = 1 << 23

# Fixed values of the channel: what a character may stand for.
LEET = {
    "0": "ou", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l",
}
MASKS = "*#%&?"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
# Letters of other scripts that look like Latin ones.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "з": "z", "и": "u", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "п": "n",
    "р": "p", "с": "c", "ѕ": "s", "т": "t", "у": "y", "х": "x", "һ": "h", "ԁ": "d", "ɡ": "g", "ո": "n",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
}
LEET_COST, MASK_COST, DROP_COST, SHRINK_COST, JOIN_COST, LOOK_COST = 1.0, 3.0, 1.0, 0.5, 0.5, 0.5
# From so many masks in a row on, their paths are searched in arrays.
LONG_MASK = 3
# Masks at the end of a token whose best readings are tabulated once, by context.
TAIL_MASKS = 8
# Characters beside a to z whose contexts the table has.
TAIL_CHARS = 14
MAX_CACHE = 100_000
# Longer tokens (runs of single letters) are decoded each time.
MAX_CACHED = 200

# Kinds of code points: '!' stands for a letter, but not after a word.
SPACE, LETTER, STAND_IN, EXCLAMATION, OTHER = range(5)

_EDGES = re.compile(r"^[\"'(\[{<«“]+|[\"')\]}>»”.,;:!?]+$")
_DOUBLED = re.compile(r"(.)\1")
_LEAD = re.compile(r"[a-z]{2,}")
_RUNS = re.compile(rb"(.)\1+")
_REPEATED = re.compile(r"((.)\2+)")
# Masks set apart, as in a dividing line, mask nothing.
_DIVIDER = re.compile(r"(?<!\S)(?:[*#%&?] ){2,}[*#%&?](?!\S)")
# Other signs in a row around a word; masks are no decoration.
_DECORATION = re.compile(r"^([^\w\s*#%&?])\1{2,}|([^\w\s*#%&?])\2{2,}$")


@cache
def _symbols() -> np.ndarray:
    return charlm.letter_table()


@cache
def _kinds() -> np.ndarray:
    """Kind of each code point; letters are those of the language model."""
    table = np.where(_symbols() != charlm.GAP, LETTER, OTHER).astype(np.uint8)
    for cp in range(0x3001):
        if chr(cp).isspace():
            table[cp] = SPACE
    table[[ord(c) for c in (*LEET, *MASKS)]] = STAND_IN
    table[ord("!")] = EXCLAMATION
    return table


@cache
def _odd() -> np.ndarray:
    """1 for letters that look like Latin ones, 2 for those that compatibility
    normalisation (NFKC) changes."""
    table = np.zeros(0x110000, dtype=np.uint8)
    table[[ord(c) for c in LOOKALIKES]] = 1
    for cp in [*range(0xAA, 0x3100), *range(0xFB00, 0xFB07), *range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D800)]:
        if chr(cp).isalpha() and unicodedata.normalize("NFKC", chr(cp)) != chr(cp):
            table[cp] = 2
    return table


def _is_letter(char: str) -> bool:
    return char.isalpha() or unicodedata.category(char)[0] == "M"


class Tails:
    """For masks that end a token, the search from its end, over all contexts of the most
    frequent characters: costs of a letter or the end after each context, and the least
    cost of what 0 to ``TAIL_MASKS`` masks and the end add."""

    def __init__(self, model: charlm.CharModel):
        often = model.keys[1][np.argsort(-model.logp[1], kind="stable")].tolist()
        more = [chr(c) for c in often if chr(c).isalpha() and not 0xE000 <= c < 0xF900 and chr(c) not in LETTERS]
        self.chars = " " + LETTERS + "".join(more[:TAIL_CHARS])
        self.index = {c: i for i, c in enumerate(self.chars)}
        size, after = len(self.chars), 1 + len(LETTERS)
        s = _symbols()[[ord(c) for c in self.chars]].astype(np.uint64)
        three = (s[:, None, None] << np.uint64(48)) | (s[None, :, None] << np.uint64(32)) | (s[None, None, :] << np.uint64(16))
        cost = -model.log_prob((three[..., None] | s[:after]).ravel()).reshape(size, size, size, after)
        out = [cost[..., 0]]
        for _ in range(TAIL_MASKS):
            letter = (cost[..., 1:] + out[-1][None, :, :, 1:after]).min(-1) + MASK_COST
            out.append(np.minimum(letter, out[-1] + DROP_COST * 4))
        self.cost, self.least = cost.astype(np.float32), np.array(out, dtype=np.float32)


class Restorer:
    """Viterbi decoding of a token's character lattice under the language model."""

    def __init__(self, model: charlm.CharModel | None, tails: Tails | None = None):
        self.model = model
        self.tails = Tails(model) if tails is None and model is not None else tails
        self.ends: dict[tuple[str, int], tuple[float, str]] = {}
        self.memo: dict[str, str] = {}
        self.words: dict[str, list[bytes]] = {}
        self.costs: dict[str, float] = {}
        self.tables: dict[str, np.ndarray] = {}

    def _look_up(self, grams: Iterable[str]) -> None:
        grams = [g for g in grams if g not in self.costs]
        if grams:
            self.costs.update(zip(grams, self._cost("".join(grams)).tolist(), strict=True))

    def _cost(self, joined: str) -> np.ndarray:
        """Costs of 4-grams, written one after the other."""
        cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        s = _symbols()[cps].astype(np.uint64).reshape(-1, 4)
        code = s[:, 3] | (s[:, 2] << np.uint64(16)) | (s[:, 1] << np.uint64(32)) | (s[:, 0] << np.uint64(48))
        return -self.model.log_prob(code)

    def _price(self, lattices: Iterable[list[list[tuple[str, float]]]]) -> None:
        """Look up all 4-grams on the paths of the lattices at once, up to a long run of
        masks; what follows one is looked up while decoding."""
        needed: set[str] = set()
        for steps in lattices:
            contexts = {"   "}
            for options in steps:
                if isinstance(options, int):
                    contexts = set()
                    break
                following = set()
                for context in contexts:
                    for text, _ in options:
                        ctx = context
                        for c in text if text != " " or ctx[-1] != " " else "":
                            needed.add(ctx + c)
                            ctx = ctx[1:] + c
                        following.add(ctx)
                contexts = following
            needed.update(context + " " for context in contexts)
        if len(self.costs) > MAX_CACHE:
            self.costs.clear()
        self._look_up(needed)

    def _tail(self, context: str, count: int) -> tuple[float, str]:
        """Least cost and reading of ``count`` masks that end a token, after a context."""
        found = self.ends.get((context, count))
        if found is not None:
            return found
        at = [self.tails.index.get(c) for c in context]
        if None not in at and count <= TAIL_MASKS + 1:
            if not count:
                return float(self.tails.cost[(*at, 0)]), ""
            least = self.tails.least[count - 1]
            letter = self.tails.cost[tuple(at)][1:] + least[at[1], at[2], 1 : 1 + len(LETTERS)]
            best, stay = int(letter.argmin()), float(least[tuple(at)]) + DROP_COST * 4
            cost, char = float(letter[best]) + MASK_COST, LETTERS[best]
            if stay <= cost:
                cost, char = stay, ""
        else:
            self._look_up([context + c for c in (" " + LETTERS if not count else LETTERS)])
            if not count:
                return self.costs[context + " "], ""
            options = [
                (MASK_COST + self.costs[context + c] + self._tail(context[1:] + c, count - 1)[0], c) for c in LETTERS
            ]
            cost, char = min([*options, (DROP_COST * 4 + self._tail(context, count - 1)[0], "")])
        rest = self._tail(context[1:] + char if char else context, count - 1)[1]
        if len(self.ends) > MAX_CACHE:
            self.ends.clear()
        self.ends[context, count] = cost, char + rest
        return cost, char + rest

    def _masked(self, paths: dict[str, tuple[float, tuple]], count: int) -> dict[str, tuple[float, tuple]]:
        """The paths after ``count`` masks, each any letter or nothing: the same search over
        all contexts at once."""
        chars = "".join(sorted(set(LETTERS).union(*paths)))
        size, letters = len(chars), np.array([chars.index(c) for c in LETTERS])
        table = self.tables.get(chars)
        if table is None:
            grams = [a + b + c + d for a in chars for b in chars for c in chars for d in LETTERS]
            if len(self.tables) > 2:
                self.tables.clear()
            table = self._cost("".join(grams)).astype(np.float32).reshape(size, size, size, len(LETTERS))
            self.tables[chars] = table
        cost = np.full((size, size, size), np.inf, dtype=np.float32)
        for context, (own, _) in paths.items():
            cost[tuple(chars.index(c) for c in context)] = own
        back = []
        for _ in range(count):
            longer = cost[..., None] + table
            came = longer.argmin(0)
            best = np.full(cost.shape, np.inf, dtype=np.float32)
            best[:, :, letters] = np.take_along_axis(longer, came[None], 0)[0] + MASK_COST
            source = np.full(cost.shape, -1)
            source[:, :, letters] = came
            stay = cost + DROP_COST * 4
            source[stay <= best] = -1
            cost = np.minimum(best, stay)
            back.append(source)
        ends = np.argwhere(np.isfinite(cost))
        state, read = ends.copy(), np.full((len(ends), count), size)
        for k in range(count - 1, -1, -1):
            came = back[k][tuple(state.T)]
            moved = came >= 0
            read[moved, k] = state[moved, 2]
            state[moved] = np.column_stack([came, state[:, 0], state[:, 1]])[moved]
        shown = np.array([*chars, ""], dtype=object)
        out = {}
        for end, start, text in zip(ends.tolist(), state.tolist(), shown[read].sum(1).tolist(), strict=True):
            before = paths["".join(chars[i] for i in start)][1]
            out["".join(chars[i] for i in end)] = (float(cost[tuple(end)]), (before, text) if text else before)
        return out

    @staticmethod
    def lattice(token: str) -> list[list[tuple[str, float]] | int]:
        """Options (text, cost) of each step of the token; a number stands for so many
        masks in a row, a negative one for those at the end."""
        steps = []
        if token.isalpha() and (token.isascii() or not any(c in LOOKALIKES for c in token)):
            # Letters between doubled ones are one step, but for the first three, after
            # which all paths have one context again.
            for plain, run, _ in batched([*_REPEATED.split(token), "", ""], 3):
                steps += [[(text, 0.0)] for text in (plain[:3], plain[3:]) if text]
                if run:
                    steps.append([(run[0] * 2, SHRINK_COST if len(run) > 2 else 0.0), (run[0], SHRINK_COST)])
            return steps
        i = 0
        while i < len(token):
            char = token[i]
            end = i + 1
            while end < len(token) and token[end] == char:
                end += 1
            run, i = end - i, end
            if char == " ":
                steps.append([("", JOIN_COST), (" ", 0.0)])
            elif _is_letter(char):
                # A doubled letter as it is or single; a longer run as either.
                steps.append([(char * min(run, 2), SHRINK_COST if run > 2 else 0.0)])
                if run > 1:
                    steps[-1].append((char, SHRINK_COST))
                if char in LOOKALIKES:
                    steps[-1] += [(LOOKALIKES[char] * (run if run < 3 else 2), LOOK_COST)]
            elif char in LEET:
                options = [(c * min(run, 2), LEET_COST) for c in LEET[char]]
                if run > 1:
                    options += [(c, LEET_COST + SHRINK_COST) for c in LEET[char]]
                steps.append([*options, ("", DROP_COST * 4 * min(run, 3))])
            elif char in MASKS:
                end_mark = char == "?" and i == len(token) and run == 1
                masks = [[(c, MASK_COST) for c in LETTERS] + [("", 0.0 if end_mark else DROP_COST * 4)]]
                if i == len(token) and run > 1:
                    steps.append(-run)
                else:
                    steps += [run] if run >= LONG_MASK else masks * run
            else:
                steps.append([("", DROP_COST)])
        return steps

    def restore(self, tokens: Iterable[str]) -> dict[str, str]:
        """The likeliest reading of each token (lower case, without outer punctuation; a
        run of single letters has one space between them): its words, space by space."""
        found = {}
        for token in tokens:
            if self.model is None:
                found[token] = token.replace(" ", "")
            elif token in self.memo:
                found[token] = self.memo[token]
        for some in batched([t for t in tokens if t not in found], 1000):
            lattices = [self.lattice(t) for t in some]
            self._price(lattices)
            if len(self.memo) > MAX_CACHE:
                self.memo.clear()
            for token, steps in zip(some, lattices, strict=True):
                found[token] = self._decode(steps)
                if len(token) <= MAX_CACHED:
                    self.memo[token] = found[token]
        return found

    def readings(self, raws: Iterable[str]) -> dict[str, list[bytes]]:
        """The words, as UTF-8, that each token or run of single letters is read as."""
        raws = set(raws)
        found = {raw: self.words[raw] for raw in raws if raw in self.words}
        core = {raw: _core(raw) for raw in raws if raw not in found}
        read = self.restore({c for c in core.values() if c})
        # A doubled letter may also be one after the spaces are gone.
        parts = {w for c, reading in read.items() if " " in c for w in reading.split() if _DOUBLED.search(w)}
        again = self.restore(parts) if parts else {}
        if len(self.words) > MAX_CACHE:
            self.words.clear()
        for raw, token in core.items():
            words = read[token].split() if token else []
            if " " in token:
                words += [again[w] for w in words if w in again]
            found[raw] = [w.encode() for w in dict.fromkeys(words)]
            if len(raw) <= MAX_CACHED:
                self.words[raw] = found[raw]
        return found

    def _decode(self, steps: list[list[tuple[str, float]]]) -> str:
        costs = self.costs
        # Context -> (cost, letters so far as a linked list).
        paths: dict[str, tuple[float, tuple]] = {"   ": (0.0, ())}
        late = False
        for options in steps:
            if isinstance(options, int) and options < 0:
                ends = {x: self._tail(x, -options) for x in paths}
                context = min(paths, key=lambda x: (paths[x][0] + ends[x][0], x))
                return "".join([*_texts(paths[context][1]), ends[context][1]])
            if isinstance(options, int):
                paths, late = self._masked(paths, options), True
                continue
            if late:
                self._look_up({g for x in paths for text, _ in options for g in _grams(x, text)})
            following: dict[str, tuple[float, tuple]] = {}
            for context, (cost, so_far) in paths.items():
                for text, price in options:
                    total, ctx = cost + price, context
                    # Gaps in a row are one, as in the language model.
                    for c in text if text != " " or ctx[-1] != " " else "":
                        total += costs[ctx + c]
                        ctx = ctx[1:] + c
                    best = following.get(ctx)
                    if best is None or total < best[0]:
                        following[ctx] = (total, (so_far, text) if text else so_far)
            paths = following
        if late:
            self._look_up({x + " " for x in paths})
        ends = [(cost + costs[context + " "], context, so_far) for context, (cost, so_far) in paths.items()]
        _, _, node = min(ends, key=lambda x: x[:2])
        return "".join(_texts(node))


def _texts(node: tuple) -> list[str]:
    out = []
    while node:
        node, text = node
        out.append(text)
    return out[::-1]


def _grams(context: str, text: str) -> Iterator[str]:
    for c in text if text != " " or context[-1] != " " else "":
        yield context + c
        context = context[1:] + c


def _core(raw: str) -> str:
    """A token without outer punctuation, but for a question mark after a letter, which
    may be a mask; the letters of a run one space apart, compatibility forms (NFKC) as
    plain letters. Empty: no letters."""
    if not raw.isascii():
        raw = unicodedata.normalize("NFKC", raw).lower()
    token = " ".join(_DIVIDER.sub("", " ".join(raw.split())).split())
    core = _EDGES.sub("", token)
    end = token.find(core) + len(core)
    if core and token[end : end + 1] == "?" and _is_letter(core[-1]):
        core += "?"
    core = _DECORATION.sub("", core).strip()
    return core if any(map(_is_letter, core)) else ""


def suspicious(kind: np.ndarray, cps: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last (exclusive) place of the tokens (white space to white space) whose
    lattice has more than one path, and of runs of three or more single letters (or what
    stands for one), any white space apart, within a text; ``ends`` are those of the texts."""
    letter, other = kind == LETTER, kind >= STAND_IN
    flag = np.zeros(len(kind), dtype=bool)
    flag[:-1] |= other[:-1] & letter[1:]
    flag[1:] |= (kind[1:] == STAND_IN) & letter[:-1]
    flag[1:] |= letter[1:] & (cps[1:] == cps[:-1])
    if cps.max(initial=0) > 0xA9:
        odd = _odd()[cps]
        flag |= odd == 2
        # A letter that looks like a Latin one, beside one that does not.
        flag[1:] |= (odd[1:] != odd[:-1]) & letter[1:] & letter[:-1]
    change = np.diff(np.concatenate([[0], (kind != SPACE).view(np.int8), [0]]))
    first, last = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    at = np.unique(np.searchsorted(first, np.flatnonzero(flag), "right") - 1)
    single = np.flatnonzero((last - first == 1) & (kind[first] != OTHER))
    text = np.searchsorted(ends, first[single], "right")
    new = np.flatnonzero((np.diff(single) != 1) | (np.diff(text) != 0)) + 1
    start, stop = np.append(0, new), np.append(new, len(single))
    long = stop - start >= 3
    start, stop = single[start[long]], single[stop[long] - 1]
    return np.append(first[at], first[start]), np.append(last[at], last[stop])


def parsed(texts: list[str]) -> Iterator[tuple[list[bytes], list[str], np.ndarray]]:
    """For some texts at a time: each one's letters (lower case, UTF-8, others a space),
    the tokens to decode and the text of each."""
    for a, b in text_steps(texts):
        part = [t.lower() for t in texts[a:b]]
        joined = "\n".join([*part, ""])
        ends = np.cumsum([len(p) + 1 for p in part])
        cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kind = _kinds()[cps]
        first, last = suspicious(kind, cps, ends)
        raws = [joined[x:y] for x, y in zip(first.tolist(), last.tolist(), strict=True)]
        plain = np.where(kind == LETTER, cps, np.uint32(32))
        plain[ends - 1] = 10
        lines = plain.astype("<u4").tobytes().decode("utf-32-le").encode().split(b"\n")[:-1]
        yield lines, raws, np.searchsorted(ends, first, "right")


def words_of(texts: list[str], restorer: Restorer) -> Iterator[set[bytes]]:
    """The distinct words of each restored text, lower case, as UTF-8."""
    for lines, raws, where in parsed(texts):
        known = restorer.readings(raws)
        extra: dict[int, list[bytes]] = {}
        for raw, text in zip(raws, where.tolist(), strict=True):
            if known[raw]:
                extra.setdefault(text, []).extend(known[raw])
        for i, line in enumerate(lines):
            words = set(line.split())
            words.update(extra.get(i, ()))
            yield words


def _features(words: set[bytes]) -> set[bytes]:
    """Whole words, marked by a leading space, and their beginnings."""
    out = {b" " + w for w in words}
    for k in PREFIXES:
        out.update(w[:k] for w in words if len(w) > k)
    return out


def _count_features(model, slots: np.ndarray | None = None):
    """Partial counts of the texts that have a feature (in one of the packed ``slots``)."""
    tails = None if model is None else Tails(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer, sums = Restorer(model, tails), Counter()
        wanted = None if slots is None else np.unpackbits(slots).tobytes()
        for pdf in batches:
            for words in words_of(no_nulls(pdf["text"]), restorer):
                features = _features(words)
                sums.update(features if wanted is None else [f for f in features if wanted[zlib.crc32(f) % SLOTS]])
                if len(sums) > FLUSH_FEATURES:
                    yield pd.DataFrame({"feature": list(sums.keys()), "n": list(sums.values())})
                    sums.clear()
        yield pd.DataFrame({"feature": list(sums.keys()), "n": list(sums.values())})

    return run


def _counted(texts: DataFrame, model, slots: np.ndarray | None, name: str) -> DataFrame:
    parts = texts.select("text").mapInPandas(_count_features(model, slots), "feature binary, n long")
    return parts.groupBy("feature").agg(F.sum("n").alias(name))


def lexicon(model, positive: DataFrame, negative: DataFrame) -> dict[bytes, float]:
    """Features that mark positive texts, with their weights. Both counts are joined and
    tested in Spark: only significant features are collected, however rare."""
    n_pos, n_neg = positive.count(), negative.count()
    if not n_pos or not n_neg:
        return {}
    # Fewer positive texts than this can't be significant, even with no negative one.
    rate = n_pos / (n_pos + n_neg)
    least = max(MIN_DOCS, int(np.ceil(MIN_SIGMAS**2 / (2 * np.log(1 / rate)))))
    candidates = saved(_counted(positive, model, None, "p").where(F.col("p") >= least), "toxic-features")
    slots = np.zeros(SLOTS, dtype=bool)
    slots[candidates.select((F.crc32("feature") % SLOTS).alias("slot")).distinct().toPandas()["slot"].to_numpy(int)] = True
    counted = (
        candidates.join(_counted(negative, model, np.packbits(slots), "q"), "feature", "left")
        .withColumn("q", F.coalesce("q", F.lit(0))).where(_may_mark(F.col("p"), F.col("q"), rate)).toPandas()
    )
    pos = {bytes(f): float(n) for f, n in zip(counted["feature"], counted["p"], strict=True)}
    neg = {bytes(f): float(n) for f, n in zip(counted["feature"], counted["q"], strict=True)}
    found = {}
    # From whole words to ever shorter beginnings: a beginning must mean something
    # beside the one longer entry that it holds most often.
    taken: dict[bytes, tuple[float, float]] = {}
    for f in sorted(pos, key=lambda f: (f[:1] != b" ", -len(f), f)):
        child = taken.get(f, (0.0, 0.0)) if f[:1] != b" " else (0.0, 0.0)
        own_p, own_q = pos[f], neg[f]
        if not _marks(own_p - child[0], max(own_q - child[1], 0.0), rate) or not _marks(own_p, own_q, rate):
            continue
        odds = np.log((own_p + 0.5) / (n_pos - own_p + 1)) - np.log((own_q + 0.5) / (n_neg - own_q + 1))
        found[f] = float(odds - np.sqrt(1 / (own_p + 0.5) + 1 / (own_q + 0.5)))
        word = f.removeprefix(b" ")
        for k in PREFIXES:
            if k < len(word) and own_p > taken.get(word[:k], (0.0, 0.0))[0]:
                taken[word[:k]] = (own_p, own_q)
    return {f: found[f] for f in sorted(found, key=lambda f: (-found[f], f)) if found[f] > 0}


def _marks(p: float, q: float, rate: float) -> bool:
    """Whether p positive and q negative texts differ enough from the share ``rate``:
    signed root of the likelihood ratio, and enrichment."""
    n = p + q
    if p <= 0 or p <= n * rate or rate >= 1:
        return False
    ratio = p * np.log(p / (n * rate)) + (q * np.log(q / (n * (1 - rate))) if q else 0.0)
    return 2 * ratio >= MIN_SIGMAS**2 and (p / rate) / ((q + 0.5) / (1 - rate)) >= MIN_ENRICHMENT


def _may_mark(p: Column, q: Column, rate: float) -> Column:
    """``_marks`` as a filter, with room for rounding."""
    n = p + q
    ratio = p * F.log(p / (n * rate)) + F.when(q > 0, q * F.log(q / (n * (1 - rate)))).otherwise(0.0)
    enrichment = (p / rate) / ((q + 0.5) / (1 - rate))
    return (p > n * rate) & (2 * ratio >= MIN_SIGMAS**2 - 1e-6) & (enrichment >= MIN_ENRICHMENT - 1e-6)


class Scorer:
    """Lexicon evidence of a text: the strongest word, all words together, and how many
    words there are."""

    def __init__(self, weights: dict[bytes, float], cache: int = 200_000):
        self.whole = {f[1:]: w for f, w in weights.items() if f[:1] == b" "}
        self.starts = {f: w for f, w in weights.items() if f[:1] != b" "}
        self.heads = {f[: PREFIXES[0]] for f in (*self.whole, *self.starts)}
        self.single_heads = {_RUNS.sub(rb"\1", f) for f in self.heads}
        self.single_begun = {f[:k] for f in self.single_heads for k in range(len(f) + 1)}
        self.begun = {f[:k] for f in self.heads for k in range(len(f) + 1)}
        self.reach: dict[str, bool] = {}
        self.memo: dict[bytes, float] = {}
        self.cache = cache

    def weight(self, word: bytes) -> float:
        if word[: PREFIXES[0]] not in self.heads:
            return 0.0
        found = self.memo.get(word)
        if found is None:
            found = max([self.whole.get(word, 0.0), *(self.starts.get(word[:k], 0.0) for k in PREFIXES if len(word) > k)])
            if len(self.memo) > self.cache:
                self.memo.clear()
            self.memo[word] = found
        return found

    def evidence(self, words: set[bytes]) -> tuple[float, float, float]:
        heads = self.heads
        found = [self.weight(w) for w in words if w[: PREFIXES[0]] in heads]
        best = max(found, default=0.0)
        # Without evidence the length says nothing.
        return best, float(np.log1p(sum(found))), float(np.log1p(len(words))) if best else 0.0


    def may_hold(self, raw: str) -> bool:
        """Whether any path of the token's lattice begins like a lexicon entry; if none
        does, its reading gives no evidence."""
        found = self.reach.get(raw)
        if found is None:
            if len(self.reach) > self.cache:
                self.reach.clear()
            if raw.isascii() and raw.isalpha():
                # A reading differs from letters in how often they are repeated only.
                single = _RUNS.sub(rb"\1", raw.encode())
                found = any(single[:k] in self.single_heads for k in range(1, PREFIXES[0] + 1))
            elif not self._may_begin(raw):
                found = False
            else:
                core = _core(raw)
                found = bool(core) and (" " in core or self._walk(Restorer.lattice(core)))
            self.reach[raw] = found
        return found

    def _may_begin(self, raw: str) -> bool:
        """False if the letters that a token begins with rule out all entries."""
        lead = _LEAD.match(raw)
        if lead is None or len(raw.split(None, 1)) > 1:
            return True
        # A mark may still change the last letter of what is not ASCII.
        lead = _RUNS.sub(rb"\1", (lead[0] if raw.isascii() else lead[0][:-1]).encode())
        return lead in self.single_begun or any(lead[:k] in self.single_heads for k in range(1, PREFIXES[0] + 1))

    def _walk(self, steps: list) -> bool:
        states, size = {b""}, PREFIXES[0]
        for options in steps:
            if isinstance(options, int):
                return True
            following = set()
            for state in states:
                for text, _ in options:
                    longer = state + text.encode()
                    if any(longer[:k] in self.heads for k in range(1, size + 1)):
                        return True
                    if longer in self.begun:
                        following.add(longer)
            if not following:
                return False
            states = following
        return False

    def of(self, texts: list[str], restorer: Restorer) -> Iterator[tuple[float, float, float]]:
        """The evidence of each restored text. Only tokens that may hold some are decoded,
        but for texts that have some: those are restored whole."""
        for lines, raws, where in parsed(texts):
            own = [i for i, raw in enumerate(raws) if self.may_hold(raw)]
            known = restorer.readings([raws[i] for i in own])
            extra: dict[int, list[bytes]] = {}
            for i in own:
                extra.setdefault(int(where[i]), []).extend(known[raws[i]])
            by_text = np.argsort(where, kind="stable")
            starts = np.searchsorted(where[by_text], np.arange(len(lines) + 1))
            for i, line in enumerate(lines):
                words = set(line.split())
                words.update(extra.get(i, ()))
                found = self.evidence(words)
                if found[0]:
                    rest = [raws[k] for k in by_text[starts[i] : starts[i + 1]]]
                    words.update(*restorer.readings(rest).values())
                    found = self.evidence(words)
                yield found


def _evidence(model, weights):
    tails = None if model is None else Tails(model)

    def make():
        restorer, scorer = Restorer(model, tails), Scorer(weights)

        def find(texts: list[str]):
            found = list(scorer.of(texts, restorer))
            return np.array(found, dtype=float).reshape(-1, 3).T

        return find

    return make


def _score(model, weights, coefficients):
    start, *slopes = coefficients
    evidence = _evidence(model, weights)

    def make():
        find = evidence()

        def score(texts: list[str]):
            return (1 / (1 + np.exp(-(start + np.array(slopes) @ find(texts)))),)

        return score

    return make


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[float, ...]:
    """Newton's method for a ridge logistic model with an intercept."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


class Detector:
    """Language model, lexicon and logistic coefficients (None: no positive label)."""

    def __init__(self, model, weights, coefficients):
        self.model, self.weights, self.coefficients = model, weights, coefficients

    def score(self, docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
        """``docs`` (its columns ``keep``, all by default) with _score."""
        keep = docs.columns if keep is None else keep
        if self.coefficients is None:
            return docs.select(*keep, F.lit(0.0).alias("_score"))
        return mapped(docs, text_col, keep, {"_score": "double"}, _score(self.model, self.weights, self.coefficients))


def train(docs: DataFrame, labels: DataFrame) -> Detector:
    """``docs`` (doc_id, text) give the language model, ``labels`` (doc_id, toxic) the classes."""
    model = charlm.fit(docs.select(F.lit("all").alias("grp"), "text").where("text is not null")).get("all")
    allowed = fold("doc_id", FOLDS)
    known = labels.where(F.col("toxic").isin(0, 1) & (allowed != HELD_OUT))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = MAX_LABELLED / max(known.count(), 1)
    if share < 1:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    # At most MAX_LABELLED rows of 12 bytes: a bounded broadcast keeps the texts where they are.
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    # Copies teach once: of equal texts with one label the smallest id.
    once = rows.groupBy(F.xxhash64("text"), "toxic").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "toxic")
    rows = docs.select("doc_id", "text").join(F.broadcast(once), "doc_id").withColumn("part", allowed)
    words = rows.where(F.col("part") != FIT_FOLD)
    weights = lexicon(model, words.where("toxic = 1"), words.where("toxic = 0"))
    if not weights:
        return Detector(model, {}, None)
    fit_rows = rows.where(F.col("part") == FIT_FOLD)
    added = {"_best": "double", "_all": "double", "_size": "double"}
    found = mapped(fit_rows, "text", ["toxic"], added, _evidence(model, weights)).toPandas()
    if not len(found):
        return Detector(model, weights, (-3.0, 1.0, 0.0, 0.0))
    return Detector(
        model, weights, logistic(found[list(added)].to_numpy(), found["toxic"].to_numpy().astype(float))
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text of ``documents``."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    scored = train(docs, labels).score(docs, keep=["doc_id"])
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(True)).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pipeline stage: the rows of ``docs`` that are not predicted toxic."""
    detector = train(docs, labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")))
    return detector.score(docs).where("_score < 0.5").select(docs.columns)
