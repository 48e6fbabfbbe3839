"""Operator 12, phrase collocations from a weighted de Bruijn graph of words.

Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line breaks, and pieces
into words at spaces and tabs. Nodes of the graph are (size - 1)-grams of words, edges
the longest grams (``size`` words), weighted by occurrences. Only edges and the ends of
the word runs are counted over the texts; every shorter count follows from the flow: a
gram occurs as often as the edges that begin with it, plus the runs that end with it
(one row for a run's end: its last words stand for all shorter ends).

A phrase counts only from ``least`` occurrences on, and then so do all its words, word
pairs and triples. Two passes before count words (exactly), then pairs and triples of
frequent words together (by hash, so that their rows follow the words of the input); a
bit table of a fixed size holds those that reach ``least``. Runs are broken where a word
or pair is not in it; at a triple that is not, one run ends with its second word and the
next begins there, so that no pair is in both. That never breaks an occurrence of a
phrase that counts (a false bit costs rows, not results), and rare text makes no edges,
nor does a rare row of frequent pairs.

A unary path is a gram whose occurrences all go on in one way, to the left or the right:
its count equals that of an extension by one word. Compacting such paths keeps only
their longest gram, which drops the phrases that lie in an equally frequent longer one.

Defined results: null text is empty, null lang ``und``; empty tables give no rows;
repeated rows count again; null ids and other columns, whatever their names, are not
read; ties are ordered by count, then phrase (UTF-8 byte order); a text is counted whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobmart.llm.common import read_table, saved
from jobmart.llm.rolling import Rolling, mix

SIZE = 5
LEAST = 100
TOP = 2000
UNKNOWN = "und"
# Bits of a table of frequent words or short grams: 8 MiB, sent to each task at any input size.
TABLE_BITS = 1 << 26
# Bits of the numbers by which short grams are counted.
NUMBER_BITS = 36
# Words of the longest gram that is counted by hash.
SHORT = 3
_BLOCK_BITS = 1 << 13
STEP_BYTES = 1 << 20
FLUSH = 1 << 20
SALTS = 64

_BREAKS = b".,;:!?\n\x0b\x0c\r"
# What each byte is: 0 a word's, 1 a space, 2 the end of a piece.
CLASS = np.zeros(256, dtype=np.uint8)
CLASS[[32, 9]] = 1
CLASS[list(_BREAKS)] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words:
    """The words of some texts: hash, place in ``data``, and whether each goes on in the
    piece of the word before it."""

    def __init__(self, data: np.ndarray):
        self.data = LOWER[data]
        kind = CLASS[data]
        word = np.concatenate([[False], kind == 0, [False]])
        edge = np.flatnonzero(word[1:] != word[:-1])
        self.start, self.end = edge[::2], edge[1::2]
        breaks = np.cumsum(kind == 2, dtype=np.int32)
        piece = breaks[self.start] if len(self.start) else np.zeros(0, dtype=np.int32)
        self.goes_on = np.append(False, piece[1:] == piece[:-1])[: len(piece)]
        self.hash = Rolling(self.data).of(self.start, self.end)

    def text(self, first: np.ndarray, last: np.ndarray) -> list[bytes]:
        """Words first to last, with one space between."""
        raw = self.data.tobytes()
        start, end = self.start.tolist(), self.end.tolist()
        return [
            b" ".join([raw[start[i] : end[i]] for i in range(a, b + 1)])
            for a, b in zip(first.tolist(), last.tolist(), strict=True)
        ]


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray]]:
    """(lang, bytes): whole texts of one language with line breaks between, about
    ``STEP_BYTES`` together (one longer text is a step of its own)."""
    for batch in batches:
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
            if text:
                by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            part, size = [], 0
            for text in texts:
                if size and size + len(text) > STEP_BYTES:
                    yield lang, np.frombuffer(b"\n".join(part), dtype=np.uint8)
                    part, size = [], 0
                part.append(text)
                size += len(text)
            yield lang, np.frombuffer(b"\n".join(part), dtype=np.uint8)


class Sums:
    """Summed counts by 64-bit key, with something made once for each new key."""

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.made: list = []
        self.rows = 0

    def add(self, keys: np.ndarray, make=None) -> None:
        if not len(keys):
            return
        found, first, counts = np.unique(keys, return_index=True, return_counts=True)
        self.keys.append(found)
        self.counts.append(counts)
        self.rows += len(found)
        if make:
            self.made += make(first)

    def compact(self) -> None:
        """Puts equal keys of different steps together."""
        if len(self.keys) > 1:
            keys, counts, made = self.take()
            self.keys, self.counts, self.made, self.rows = [keys], [counts], made, len(keys)

    def take(self) -> tuple[np.ndarray, np.ndarray, list]:
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        found, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        sums = np.bincount(inverse, weights=counts).astype(np.int64)
        made = [self.made[i] for i in first] if self.made else []
        self.__init__()
        return found, sums, made


def _full(sums: list[Sums]) -> bool:
    """Whether so many distinct keys are held that they must go on."""
    if sum(x.rows for x in sums) <= FLUSH:
        return False
    for own in sums:
        own.compact()
    return sum(x.rows for x in sums) > FLUSH // 2


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, Sums] = {}

    def flush():
        for lang, own in sums.items():
            if own.rows:
                _, n, words = own.take()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(n), pa.string()), pa.array(words, pa.binary()).cast(pa.string()), pa.array(n)],
                    names=["lang", "word", "n"],
                )

    for lang, data in _steps(batches):
        words = Words(data)
        sums.setdefault(lang, Sums()).add(words.hash, lambda first, w=words: w.text(first, first))
        if _full(list(sums.values())):
            yield from flush()
    yield from flush()


def _number(lang: str, hashes: np.ndarray) -> np.ndarray:
    """The number of each hash of a language."""
    salt = Rolling(np.frombuffer(lang.encode(), dtype=np.uint8)).of(np.array([0]), np.array([len(lang.encode())]))
    return (pair_hash(salt, hashes) >> np.uint64(64 - NUMBER_BITS)).astype(np.int64)


def _bit(lang: str, hashes: np.ndarray) -> np.ndarray:
    """The bit of each hash of a language in a table."""
    return _number(lang, hashes) % TABLE_BITS


def _word_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [x.encode() for x in batch.column("word").to_pylist()]
        ends = np.cumsum([0, *map(len, words)])
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        hashes = Rolling(data).of(ends[:-1], ends[1:])
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        bits = np.zeros(len(words), dtype=np.int64)
        for lang in set(langs):
            bits[langs == lang] = _bit(lang, hashes[langs == lang])
        yield pa.RecordBatch.from_arrays([pa.array(bits)], names=["bit"])


def bit_table(spark: SparkSession, bits: DataFrame) -> np.ndarray:
    """The table of the bits in ``bits`` (bit), built in blocks by Spark; its size is
    fixed, whatever the number of rows."""

    def block(keys, rows):
        table = np.zeros(_BLOCK_BITS, dtype=bool)
        table[rows["bit"].to_numpy() % _BLOCK_BITS] = True
        return pd.DataFrame({"at": [keys[0]], "part": [np.packbits(table, bitorder="little").tobytes()]})

    blocks = (
        bits.distinct()
        .withColumn("at", F.floor(F.col("bit") / _BLOCK_BITS).cast("long"))
        .groupBy("at")
        .applyInPandas(block, "at long, part binary")
    )
    table = np.zeros(TABLE_BITS // 8, dtype=np.uint8)
    for row in blocks.collect():  # TABLE_BITS in all
        at = row["at"] * _BLOCK_BITS // 8
        table[at : at + _BLOCK_BITS // 8] = np.frombuffer(row["part"], dtype=np.uint8)
    return table


def _has(table: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return (table[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1 == 1


def _frequent_pairs(words: Words, lang: str, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words that follow another frequent one and are frequent, and the pairs' hashes."""
    ok = _has(table, _bit(lang, words.hash))
    second = np.flatnonzero(words.goes_on & ok & np.append(False, ok[:-1])) if len(ok) else np.zeros(0, dtype=np.int64)
    return second, pair_hash(words.hash[second - 1], words.hash[second])


def _triples(words: Words, second: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words that end two pairs on end, among the pairs that end with the words
    ``second``, and the triples' hashes."""
    follows = np.flatnonzero(second[1:] == second[:-1] + 1)
    third = second[follows + 1]
    return third, pair_hash(pairs[follows], words.hash[third])


def _count_short(word_table, size: int):
    """Pairs and, where phrases are as long, triples of frequent words, by number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()

        def flush():
            if sums.rows:
                numbers, n, _ = sums.take()
                yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(n)], names=["number", "n"])

        for lang, data in _steps(batches):
            words = Words(data)
            second, hashes = _frequent_pairs(words, lang, word_table.value)
            if size >= SHORT:
                hashes = np.concatenate([hashes, _triples(words, second, hashes)[1]])
            sums.add(_number(lang, hashes))
            if _full([sums]):
                yield from flush()
        yield from flush()

    return run


def _count_grams(word_table, short_table, size: int):
    """Edges (``size`` words) and the ends of runs: one row with the last 2 to size - 1
    words, as many as the run has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, Sums] = {}

        def flush():
            for lang, own in sums.items():
                if own.rows:
                    _, n, grams = own.take()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(n), pa.string()),
                            pa.array([x.count(b" ") + 1 for x in grams], pa.int32()),
                            pa.array(grams, pa.binary()).cast(pa.string()),
                            pa.array(n),
                        ],
                        names=["lang", "words", "gram", "n"],
                    )

        for lang, data in _steps(batches):
            words = Words(data)
            second, pairs = _frequent_pairs(words, lang, word_table.value)
            ok = _has(short_table.value, _bit(lang, pairs))
            second, pairs = second[ok], pairs[ok]
            linked = np.zeros(len(words.hash) + 1, dtype=bool)
            linked[second] = True
            broken = np.zeros(len(words.hash) + 1, dtype=bool)
            if size >= SHORT:
                third, triples = _triples(words, second, pairs)
                broken[third] = ~_has(short_table.value, _bit(lang, triples))
            # How many words of its run precede each word; a run that begins at a broken
            # triple begins with the word before.
            at = np.arange(len(words.hash))
            first = np.where(linked[:-1], np.where(broken[:-1], at - 1, 0), at)
            depth = at - np.maximum.accumulate(first) if len(at) else at
            ends = ~linked[1:] | broken[1:]
            own = sums.setdefault(lang, Sums())
            for count in range(2, size + 1):
                if count < size - 1:
                    last = np.flatnonzero((depth == count - 1) & ends)
                else:
                    last = np.flatnonzero((depth >= count - 1) & (ends if count < size else True))
                if not len(last):
                    continue
                key = words.hash[last]
                for back in range(1, count):
                    key = pair_hash(words.hash[last - back], key)
                own.add(key, lambda first, w=words, last=last, c=count: w.text(last[first] - c + 1, last[first]))
            if _full(list(sums.values())):
                yield from flush()
        yield from flush()

    return run


def edges(rows: DataFrame, frequent: DataFrame, size: int, least: int) -> DataFrame:
    """Edges and ends of runs of ``rows`` (lang, text), (lang, words, gram, n), as tasks
    pass them on: equal ones of several tasks are not yet put together."""
    spark = rows.sparkSession
    word_table = spark.sparkContext.broadcast(
        bit_table(spark, frequent.select("lang", "word").mapInArrow(_word_bits, "bit long"))
    )
    # Tasks have put equal numbers together; dealt first, the rest are not summed (and held) on both sides.
    short = rows.mapInArrow(_count_short(word_table, size), "number long, n long").repartition("number")
    short = short.groupBy("number").agg(F.sum("n").alias("n"))
    short_bits = short.where(F.col("n") >= least).select((F.col("number") % TABLE_BITS).alias("bit"))
    short_table = spark.sparkContext.broadcast(bit_table(spark, short_bits))
    # Nearly all grams left are frequent and come in every task: one task a core reads its
    # splits one after the other, so that their rows follow the grams, not the splits.
    long_tasks = rows.coalesce(spark.sparkContext.defaultParallelism)
    return long_tasks.mapInArrow(_count_grams(word_table, short_table, size), "lang string, words int, gram string, n long")


def flow_counts(grams: DataFrame, size: int = SIZE) -> DataFrame:
    """Occurrences of every gram of 2 to ``size`` words, (lang, words, gram, n), from the
    edges and run ends of ``grams``: a gram's count is the flow out of it and its ends."""
    counts = None
    level = None
    for words in range(size, 1, -1):
        if level is None:
            own = grams.where(F.col("words") == words).select("lang", "gram", "n")
        else:
            ends = grams.where((F.col("words") >= words) & (F.col("words") < size))
            own = ends.select("lang", F.expr(f"substring_index(gram, ' ', {-words})").alias("gram"), "n")
            own = own.unionByName(level.select("lang", F.expr(f"substring_index(gram, ' ', {words})").alias("gram"), "n"))
        level = own.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        own = level.select("lang", F.lit(words).alias("words"), "gram", "n")
        counts = own if counts is None else counts.unionByName(own)
    return counts


def phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = SIZE, least: int = LEAST) -> DataFrame:
    """Every kept candidate: lang, phrase, a, l, r, n, cut, score."""
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).cast("string").alias("text")
    )
    words = saved(
        rows.mapInArrow(_count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")),
        "words",
    )
    frequent = words.where(F.col("n") >= least)
    grams = edges(rows, frequent, size, least).groupBy("lang", "words", "gram").agg(F.sum("n").alias("n"))
    counts = saved(flow_counts(saved(grams, "grams"), size).where(F.col("n") >= least), "gram-counts")
    # Unary paths: a gram as frequent as one of its extensions by a word.
    longer = counts.where("words > 2")
    inside = longer.select("lang", F.expr("substring_index(gram, ' ', words - 1)").alias("gram"), "n").unionByName(
        longer.select("lang", F.expr("substring_index(gram, ' ', 1 - words)").alias("gram"), "n")
    )
    inside = inside.groupBy("lang", "gram").agg(F.max("n").alias("longest"))
    kept = (
        counts.join(inside, ["lang", "gram"], "left")
        .where("longest is null or longest < n")
        .select("lang", "words", "gram", F.col("n").alias("a"))
    )
    parts = counts.select("lang", "gram", "n").unionByName(frequent.select("lang", F.col("word").alias("gram"), "n"))
    cuts = kept.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "*",
        F.expr("substring_index(gram, ' ', cut)").alias("left"),
        F.expr("substring_index(gram, ' ', cut - words)").alias("right"),
    )
    total = words.groupBy("lang").agg(F.sum("n").alias("total"))
    scored = (
        cuts.join(parts.select("lang", F.col("gram").alias("left"), F.col("n").alias("l")), ["lang", "left"])
        .join(parts.select("lang", F.col("gram").alias("right"), F.col("n").alias("r")), ["lang", "right"])
        .join(total, "lang")
        .withColumn("score", F.expr("cast(1000 * a as decimal(19, 0)) * cast(total as decimal(19, 0)) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"))
    )
    best = scored.groupBy("lang", "gram").agg(
        F.min(F.struct("score", "cut", "a", "l", "r", F.col("total").alias("n"))).alias("best")
    )
    return best.select("lang", F.col("gram").alias("phrase"), "best.a", "best.l", "best.r", "best.n", "best.cut", "best.score")


def top_phrases(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` of each language by score, count and phrase, with their rank. Each
    language is first cut down in several parts, so that no task sorts all of it."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("_r") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return first.drop("_salt", "_r").withColumn("rank", rank).where(F.col("rank") <= top)


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first phrases of ``documents``."""
    found = phrases(read_table(spark, sf_dir, "documents").select("text", "lang"))
    return top_phrases(found).select("lang", "rank", "phrase", "a", "l", "r", "n", "score", F.col("cut").cast("long").alias("cut"))


ORACLE = r"""
WITH pieces AS (
  SELECT doc, coalesce(lang, 'und') AS lang, p.i AS piece,
         list_filter(string_split_regex(p.x, '[ \t]+'), lambda x: x <> '') AS w
  FROM (SELECT row_number() OVER () AS doc, lang,
               string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[.,;:!?\x0A-\x0D]') AS xs
        FROM documents) d, LATERAL (SELECT unnest(xs) AS x, generate_subscripts(xs, 1) AS i) p
),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
f AS (
  SELECT lang, k AS words, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS a
  FROM pieces, LATERAL (SELECT unnest(range(1, 6)) AS k), LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS i)
  GROUP BY ALL HAVING count(*) >= 100
),
c AS (SELECT * FROM f WHERE words > 1),
inner_parts AS (
  SELECT lang, phrase AS longer, a AS b, array_to_string(x[i : i + k - 1], ' ') AS phrase
  FROM (SELECT lang, phrase, a, words, string_split(phrase, ' ') AS x FROM c),
       LATERAL (SELECT unnest(range(2, words)) AS k), LATERAL (SELECT unnest(range(1, words - k + 2)) AS i)
),
kept AS (
  SELECT * FROM c WHERE NOT EXISTS (
    SELECT 1 FROM inner_parts i WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.b >= 100 * c.a)
),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(x[1 : k], ' ') AS lp, array_to_string(x[k + 1 :], ' ') AS rp
  FROM (SELECT *, string_split(phrase, ' ') AS x FROM kept), LATERAL (SELECT unnest(range(1, words)) AS k)
),
scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, k, fl.a AS l, fr.a AS r, n.n,
         (1000::HUGEINT * cuts.a * n.n) // (fl.a::HUGEINT * fr.a) AS score
  FROM cuts JOIN f fl ON fl.lang = cuts.lang AND fl.phrase = lp
            JOIN f fr ON fr.lang = cuts.lang AND fr.phrase = rp JOIN n ON n.lang = cuts.lang
),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a, l, r, n, CAST(score AS BIGINT) AS score, k AS cut
FROM best QUALIFY rank <= 2000
"""
