"""Operator 5, secret scans through a trigram inverted index, DataFrame functions only.

``trigram_query`` derives from each rule's regular expression a Boolean query, an OR
of ANDs of trigrams that every match must contain (over lower-case text, which only
widens it). ``postings`` is the inverted index over the trigrams that the rules ask
for: (trigram, document). ``candidates`` intersects the postings of each AND and
unites them by rule; ``scan`` verifies the candidates with the expressions and reports
every match with its place. A rule without mandatory trigrams scans every text.

Matches are leftmost and do not overlap, per kind; places are code points, the end
exclusive. The gap before each match is extracted with it (from where the last one
ended), so places are running sums of lengths.

Defined results: a null text is empty and has no spans; repeated rows, also with one
id, get equal results; a null id is kept. Columns other than id and text are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.llm.common import read_table


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose group ``group`` has ``least``
    characters or more (the other matches are dropped, what they cover stays covered)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    any_case: bool = False


# The three base rules, then rules of public credential formats.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("url_login", r"://[A-Za-z0-9._-]+:[A-Za-z0-9._-]+@"),
)
RULES = BASE + MORE
_MOST = 64  # alternatives that one expression is expanded into


def _skeletons(tree) -> list[tuple[str | None, ...]]:
    """The alternatives of a parsed expression as literals and gaps (None)."""
    out: list[tuple] = [()]
    for op, value in tree:
        name = str(op)
        if name == "LITERAL":
            options = [(chr(value).lower(),)]
        elif name == "SUBPATTERN":
            options = _skeletons(value[-1])
        elif name == "BRANCH":
            options = [s for branch in value[1] for s in _skeletons(branch)]
        elif name == "IN" and len(value) <= 8 and all(str(o) == "LITERAL" for o, _ in value):
            options = [(chr(v).lower(),) for _, v in value]
        elif name == "MAX_REPEAT":
            low, high, inner = value
            inner = _skeletons(inner)
            if (low, high) == (0, 1):
                options = [(), *inner]
            elif low >= 1 and len(inner) == 1 and None not in inner[0]:
                options = [inner[0] * low + ((None,) if high > low else ())]
            else:
                options = [(None,)]
        else:
            options = [(None,)]
        if len(out) * len(options) > _MOST:
            options = [(None,)]
        out = [a + b for a, b in product(out, options)]
    return list(dict.fromkeys(out))


def trigram_query(rule: Rule) -> list[frozenset[str]] | None:
    """ORed sets of trigrams, one of which every match contains whole; None if a
    match need not contain any."""
    clauses = set()
    for skeleton in _skeletons(re._parser.parse(rule.pattern)):
        runs = "".join("\x00" if p is None else p for p in skeleton).split("\x00")
        trigrams = frozenset(run[i : i + 3] for run in runs for i in range(len(run) - 2))
        if not trigrams:
            return None
        clauses.add(trigrams)
    return sorted((c for c in clauses if not any(d < c for d in clauses)), key=sorted)


def _keys() -> list[Column]:
    return [F.xxhash64("doc_id", "text").alias("_k1"), F.xxhash64("text", F.lit(1)).alias("_k2")]


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, _k1, _k2): which of ``trigrams`` (by number) each document holds."""
    low = docs.select(*_keys(), F.lower("text").alias("_low"))
    held = F.array_compact(
        F.array(*(F.when(F.contains("_low", F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)))
    )
    return low.select(F.explode(held).alias("trigram"), "_k1", "_k2")


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(_k1, _k2, _rules): the documents in the answer of any rule's query, with the
    rules (by bit)."""
    queries = {i: q for i, r in enumerate(rules) if (q := trigram_query(r)) is not None}
    trigrams = sorted(set().union(*(c for q in queries.values() for c in q)))
    wanted = [
        f"({trigrams.index(t)}, {i}, {k}, {1 << place}L, {(1 << len(clause)) - 1}L)"
        for i, query in queries.items()
        for k, clause in enumerate(query)
        for place, t in enumerate(sorted(clause))
    ]
    asked = docs.sparkSession.sql(f"VALUES {', '.join(wanted)}").toDF("trigram", "rule", "clause", "place", "whole")
    return (
        postings(docs, trigrams)
        .join(F.broadcast(asked), "trigram")  # one row for each trigram of the rules' queries
        .groupBy("_k1", "_k2", "rule", "clause", "whole")
        .agg(F.bit_or("place").alias("held"))
        .where("held = whole")
        .groupBy("_k1", "_k2")
        .agg(F.bit_or(F.expr("shiftleft(1L, rule)")).alias("_rules"))
    )


def _spans(rule: Rule, order: int) -> Column:
    """The rule's matches in ``text``: array of (start, order, kind, end)."""
    inner = f"(?i:{rule.pattern})" if rule.any_case else rule.pattern
    whole = F.lit(rf"\G([\s\S]*?)({inner})")

    def part(k: int) -> Column:
        return F.transform(F.regexp_extract_all("text", whole, F.lit(k)), lambda x: F.char_length(x))

    kept = part(rule.group + 2) if rule.group else part(2)
    each = F.arrays_zip(part(1).alias("gap"), part(2).alias("size"), kept.alias("kept"))
    kind = "array<struct<start:int,ord:int,kind:string,end:int>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + x["size"]
        span = F.struct(begin.alias("start"), F.lit(order).alias("ord"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        added = F.when(x["kept"] >= rule.least, F.array_append(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct(end.alias("at"), added.cast(kind).alias("spans"))

    return F.aggregate(each, start, step, lambda acc: acc["spans"])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (doc_id by default) and ``_spans``: all spans of the
    column text, sorted by start, then by the rules' order."""
    keep = ["doc_id"] if keep is None else keep
    found = candidates(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), rules)
    # The names of the kept columns may clash with those made here: they travel in a struct,
    # the text, which is shuffled once, with them.
    kept = F.struct(*keep, *([] if "text" in keep else ["text"])).alias("_kept")
    rows = docs.select(kept, "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("_kept", *_keys()).join(found.hint("shuffle_hash"), ["_k1", "_k2"], "left")
    rows = rows.select("_kept", "_rules", F.coalesce(F.col("_kept")["text"], F.lit("")).alias("text"))
    none = F.array().cast("array<struct<start:int,ord:int,kind:string,end:int>>")
    each = []
    for i, rule in enumerate(rules):
        if trigram_query(rule) is None:
            # No trigram to ask for: one plain search of every text, and places where it hits.
            hit = F.col("text").rlike(f"{rule.pattern.removesuffix('+')}{{{rule.least},}}" if rule.least else rule.pattern)
        else:
            hit = F.coalesce(F.col("_rules").bitwiseAND(F.lit(1 << i)) != 0, F.lit(False))
        each.append(F.when(hit, _spans(rule, i)).otherwise(none))
    spans = F.array_sort(F.concat(*each)).alias("_spans")
    return rows.select(*(F.col("_kept")[c].alias(c) for c in keep), spans)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _of_order(order: int):
    return lambda s: s["ord"] == order


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of ``documents``."""
    found = scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = found.withColumnRenamed("_spans", "spans")
    counts = [F.array_size(F.filter("spans", _of_order(i))).cast("long").alias(f"n_{r.kind}") for i, r in enumerate(BASE)]
    base = F.filter("spans", lambda s: s["ord"] < len(BASE))
    return found.select(
        "doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans")
    )


def oracle(rules: tuple[Rule, ...] = RULES, base: int = len(BASE)) -> str:
    """The same spans in DuckDB SQL, by a plain search of every text."""
    parts = []
    for i, r in enumerate(rules):
        inner = (f"(?i:{r.pattern})" if r.any_case else r.pattern).replace("'", "''")
        whole = rf"([\s\S]*?)({inner})"
        get = [f"regexp_extract_all(x, '{whole}', {k})" for k in (1, 2, r.group + 2 if r.group else 2)]
        parts.append(
            f"SELECT doc_id, {i} AS ord, '{r.kind}' AS kind, {r.least} AS least, "
            f"{get[0]} AS g, {get[1]} AS m, {get[2]} AS v FROM t"
        )
    counts = ", ".join(
        f"CAST(count(*) FILTER (WHERE ord = {i}) AS BIGINT) AS n_{r.kind}" for i, r in enumerate(rules[:base])
    )
    listed = "kind || ':' || s || ':' || (s + l), ',' ORDER BY s, ord"
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
r AS ({' UNION ALL '.join(parts)}),
e AS (
  SELECT doc_id, ord, kind, least, length(v[i]) AS vl, length(m[i]) AS l,
    CAST(list_sum(list_transform(g[1:i], lambda q: length(q))) AS BIGINT)
      + coalesce(CAST(list_sum(list_transform(m[1:i-1], lambda q: length(q))) AS BIGINT), 0) AS s
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM r)
),
k AS (SELECT * FROM e WHERE vl >= least),
a AS (
  SELECT doc_id, {counts}, string_agg({listed}) FILTER (WHERE ord < {base}) AS b, string_agg({listed}) AS spans
  FROM k GROUP BY doc_id
)
SELECT t.doc_id, {', '.join(f'coalesce(n_{r.kind}, 0) AS n_{r.kind}' for r in rules[:base])},
  sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN a ON a.doc_id = t.doc_id
"""


def redact(docs: DataFrame) -> DataFrame:
    """Pipeline stage: the rows of ``docs`` with every span of a secret replaced by
    ``[kind]``; texts without any stay as they are, the number of characters follows."""
    rows = scan(docs, keep=docs.columns)
    kind = "struct<at:int,out:string>"
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out")).cast(kind)

    def step(acc: Column, s: Column) -> Column:
        # Spans of different kinds may overlap: what one has covered is not shown again.
        gap = F.substring(F.col("text"), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        shown = F.when(s["end"] <= acc["at"], F.lit("")).otherwise(F.concat(gap, F.lit("["), s["kind"], F.lit("]")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], shown).alias("out")).cast(kind)

    done = F.aggregate("_spans", start, step)
    rows = rows.withColumn("_done", F.when(F.size("_spans") > 0, done))
    tail = F.expr("substring(text, _done.at + 1, greatest(char_length(text) - _done.at, 0))")
    text = F.when(F.col("_done").isNull(), F.col("text")).otherwise(F.concat(F.col("_done.out"), tail))
    rows = rows.withColumn("_text", text)
    new = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        changed = F.col("_done").isNotNull()
        new["n_chars"] = F.when(changed, F.char_length("_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return rows.select(*(new[c].alias(c) if c in new else F.col(c) for c in docs.columns))
