"""Operator 9, language ID: one interpolated Kneser-Ney character model per language.

``train`` counts the 4-grams of every training text (``charlm``), then calibrates on
a sixteenth of the training rows that the counts leave out: the temperature of the
confidence, and for each language the mean and spread of the cross-entropy of its own
texts. ``identify`` chooses the language of the lowest length-normalised
cross-entropy and rejects a text whose cross-entropy lies ``REJECT_SIGMAS`` above
what texts of that language and length have.

Defined results: a null text, an empty one, or one without letters is ``und``, score
0.0 and rejected; repeated rows are scored alike; with no training rows all is
``und``; a language without enough calibration texts of its own has the limit of all
languages' texts together (without enough of those, too, nothing is rejected by it).
Ties go to the language first in alphabetical order. Extra columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.llm import charlm
from jobmart.llm.common import fold, mapped, no_nulls, read_table, text_steps

UNKNOWN = "und"
FOLDS, HELD_OUT = 3, 1
CALIBRATION = 16
REJECT_SIGMAS = 6.0
MIN_CALIBRATION_TEXTS = 8
TEMPERATURES = (0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.5, 0.75, 1.0)


@dataclass
class Identifier:
    """Models by language, and what calibration has learned."""

    models: dict[str, charlm.CharModel]
    temperature: float
    limits: dict[str, tuple[float, float, float]]  # mean, variance of a text's mean, variance of a character


def entropies(texts: list[str], table: np.ndarray, letter: np.ndarray, models: list[charlm.CharModel], squares: bool = False):
    """Per text: characters scored, letters, and the summed negative log probability
    under each model (and its summed squares)."""
    n = np.zeros(len(texts))
    letters = np.zeros(len(texts))
    sums = np.zeros((len(texts), len(models)))
    squared = np.zeros((len(texts), len(models)))
    for a, b in text_steps(texts):
        sym, starts = charlm.symbols(texts[a:b], table)
        codes, at, inverse = charlm.grams(sym)
        first = np.searchsorted(at, starts)
        n[a:b] = np.diff(np.append(first, len(at)))
        letters[a:b] = np.add.reduceat(letter[sym], starts)
        for k, model in enumerate(models):
            cost = -model.log_prob(codes)
            sums[a:b, k] = np.add.reduceat(cost[inverse], first)
            if squares:
                squared[a:b, k] = np.add.reduceat((cost * cost)[inverse], first)
    return n, letters, sums, squared


def _calibrate(table: np.ndarray, models: dict[str, charlm.CharModel]):
    names = list(models)
    letter = charlm.letter_symbols(table)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf[pdf["lang"].isin(names)]
            n, letters, sums, squared = entropies(no_nulls(pdf["text"]), table, letter, list(models.values()), True)
            own = np.array([names.index(x) for x in pdf["lang"]], dtype=int)
            rows = np.arange(len(own))
            use = letters > 0
            if not use.any():
                continue
            gap = sums - sums[rows, own][:, None]
            loss = [np.log(np.exp(np.clip(-t * gap, -700, 50)).sum(1)) for t in TEMPERATURES]
            mean = sums[rows, own] / np.maximum(n, 1)
            var = np.maximum(squared[rows, own] / np.maximum(n, 1) - mean**2, 0)
            yield pd.DataFrame(
                {"lang": pdf["lang"].to_numpy(), "mean": mean, "var": var, "n": n}
                | {f"loss{i}": x for i, x in enumerate(loss)}
            )[use]

    return run


def train(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Identifier:
    """Models and calibration from labelled rows; rows without a text or a language teach nothing."""
    rows = rows.select(
        F.col(text_col).alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
        F.pmod(F.xxhash64(F.lit("calibration"), F.col(id_col).cast("string")), F.lit(CALIBRATION)).alias("part"),
    ).where("text is not null and lang is not null")
    models = charlm.fit(rows.where("part <> 0").select(F.col("lang").alias("grp"), "text"))
    if not models:
        return Identifier({}, 1.0, {})
    losses = [f"loss{i}" for i in range(len(TEMPERATURES))]
    schema = "lang string, mean double, var double, n double, " + ", ".join(f"{x} double" for x in losses)
    scored = rows.where("part = 0").select("text", "lang").mapInPandas(
        _calibrate(charlm.letter_table(), models), schema
    )
    # Short texts say little about how texts differ, so texts weigh by their length up to 200 characters.
    weight = F.least(F.col("n"), F.lit(200.0))
    stats = (
        scored.groupBy("lang")
        .agg(
            F.count("*").alias("texts"),
            (F.sum(weight * F.col("mean")) / F.sum(weight)).alias("mean"),
            (F.sum(weight * F.col("mean") * F.col("mean")) / F.sum(weight)).alias("square"),
            (F.sum(F.col("var") * F.col("n")) / F.sum("n")).alias("var"),
            F.sum(weight).alias("weight"),
            F.sum("n").alias("n"),
            *(F.sum(x).alias(x) for x in losses),
        )
        .toPandas()
    )
    total = [stats[x].sum() for x in losses]
    temperature = TEMPERATURES[int(np.argmin(total))] if len(stats) else 0.1
    limits = {}
    if stats["texts"].sum() >= MIN_CALIBRATION_TEXTS:
        mean, square = (np.average(stats[x], weights=stats["weight"]) for x in ("mean", "square"))
        pooled = (mean, max(square - mean**2, 0.0), np.average(stats["var"], weights=stats["n"]))
        limits = dict.fromkeys(models, pooled)
    limits |= {
        r.lang: (r.mean, max(r.square - r.mean**2, 0.0), r.var)
        for r in stats.itertuples()
        if r.texts >= MIN_CALIBRATION_TEXTS
    }
    return Identifier(models, temperature, limits)


def _identify(table: np.ndarray, fitted: Identifier):
    names = list(fitted.models)
    letter = charlm.letter_symbols(table)
    models = list(fitted.models.values())
    mean, between, within = (
        np.array([fitted.limits.get(x, (np.inf, 0.0, 0.0))[i] for x in names]) for i in range(3)
    )

    def find(texts: list[str]):
        if not names:
            count = len(texts)
            return [UNKNOWN] * count, [0.0] * count, [None] * count, [True] * count
        n, letters, sums, _ = entropies(texts, table, letter, models)
        best = sums.argmin(1)
        rows = np.arange(len(texts))
        entropy = sums[rows, best] / np.maximum(n, 1)
        gap = sums - sums[rows, best][:, None]
        score = 1.0 / np.exp(-fitted.temperature * gap).sum(1)
        limit = mean[best] + REJECT_SIGMAS * np.sqrt(between[best] + 2 * within[best] / np.maximum(n, 1))
        none = letters == 0
        return (
            np.where(none, UNKNOWN, np.array(names, dtype=object)[best]),
            np.where(none, 0.0, score),
            np.where(none, np.nan, entropy),
            none | (entropy > limit),
        )

    return lambda: find


def identify(docs: DataFrame, fitted: Identifier, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (its columns ``keep``, all by default) with _lang_pred, _score, _entropy, _rejected."""
    added = {"_lang_pred": "string", "_score": "double", "_entropy": "double", "_rejected": "boolean"}
    return mapped(docs, text_col, docs.columns if keep is None else keep, added, _identify(charlm.letter_table(), fitted))


def training_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``documents`` that the query may learn from."""
    return docs.where(fold("doc_id", FOLDS) != HELD_OUT).select("doc_id", "text", "lang")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text of ``documents``."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), train(training_rows(docs)), keep=["doc_id"])
    return found.select(
        "doc_id",
        F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(True)).alias("held_out"),
        F.col("_lang_pred").alias("lang_pred"),
        F.col("_score").alias("score"),
        F.col("_entropy").alias("entropy"),
        F.col("_rejected").alias("rejected"),
    )


def drop_rejected(docs: DataFrame) -> DataFrame:
    """Pipeline stage: the rows of ``docs`` whose language is recognised."""
    fitted = train(training_rows(docs))
    return identify(docs, fitted).where(~F.col("_rejected")).select(docs.columns)
