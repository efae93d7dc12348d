"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton on folded text.

Folding lowers case, maps look-alike letters of other scripts and digits within words to the letters they stand for, and
drops invisible characters. The lexicon holds word beginnings and whole words with their log odds, learned from labelled
rows; exception phrases, learned as well, switch off a match inside them. The sum of the matched weights, raw and
divided by the length, goes through a fitted logistic curve.

Defined cases: null, empty and wordless texts have no match and get the score of no evidence; a table without labels of
both kinds gives an empty lexicon and the score 0; repeated rows get equal scores; an id labelled both ways teaches
nothing; other columns are never looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import crc32_bucket
from tripmart.sources.tables import stored

#: Labelled rows of each kind that are learned from, about (chosen by a hash of the id).
TRAIN_ROWS = 20_000
#: Terms of the lexicon that are looked at, of the highest log odds, and phrases for exceptions, at most.
CANDIDATES = 20_000
PREFIXES = range(4, 9)
#: Toxic rows that a term must occur in, and its least smoothed log odds: the same at every size of the sample.
MIN_ROWS, MIN_LOG_ODDS = 5, 3.0
#: A longer beginning replaces a shorter one if it keeps this share of its toxic rows.
KEPT_SHARE = 0.9
#: Terms that a counting task holds before it passes its counts on.
HELD_TERMS = 200_000
THRESHOLD = 0.3
END = "$"

# Letters of other scripts that look like Latin ones, and digits and signs used in place of letters.
LOOKALIKES = dict(
    zip("аеорсухіјѕһԁɡкмтвнαορντικυγ", "aeopcyxijshdgkmtbhaopvtikuy", strict=True)
)
STANDS_FOR = dict(zip("01345789@$", "oieastbgas", strict=True))
INVISIBLE = "​‌‍⁠﻿­"

_FOLD = {ord(k): v for k, v in LOOKALIKES.items()} | {ord(c): None for c in INVISIBLE}
_FOLD |= {0xFF21 + i: chr(97 + i) for i in range(26)} | {0xFF41 + i: chr(97 + i) for i in range(26)}
_SUBSTITUTES = re.compile(r"(?<=[^\W\d_])[01345789@$]+(?=[^\W\d_])|(?<![\w@$])[01345789@$](?=[^\W\d_])")
_WORD = re.compile(r"[^\W\d_]+")
_STANDS_FOR = str.maketrans(STANDS_FOR)


def fold(text: str | None) -> str:
    text = (text or "").lower()
    if not text.isascii():
        text = text.translate(_FOLD)
    return _SUBSTITUTES.sub(lambda m: m[0].translate(_STANDS_FOR), text)


def terms(word: str) -> Iterator[str]:
    """The beginnings of a word, and the whole word with an end mark."""
    yield from (word[:n] for n in PREFIXES if len(word) >= n)
    if len(word) >= 3:
        yield word + END


class Lexicon:
    """Weights by term, exception phrases and the logistic curve; small, and sent to the tasks as it is."""

    def __init__(self, weights: dict[str, float], exceptions: Iterable[str] = (), curve: tuple = (0.0, 0.0, 0.0)):
        self.weights, self.exceptions, self.curve = dict(weights), frozenset(exceptions), tuple(curve)

    def key(self) -> tuple:
        return tuple(sorted(self.weights.items())), self.exceptions


@lru_cache(maxsize=4)
def _automaton(key: tuple) -> ahocorasick.Automaton | None:
    weights, exceptions = key
    entries: dict[str, list] = {}
    for term, weight in weights:
        entries.setdefault(term.removesuffix(END), [None, None, False])[term.endswith(END)] = weight
    for phrase in exceptions:
        entries.setdefault(phrase, [None, None, False])[2] = True
    if not entries:
        return None
    automaton = ahocorasick.Automaton()
    for entry, value in entries.items():
        automaton.add_word(entry, (len(entry), *value))
    automaton.make_automaton()
    return automaton


def matches(folded: str, key: tuple) -> list[tuple[int, int, float]]:
    """(start, end, weight), one for each word start with a term, the longest; none inside an exception phrase."""
    automaton = _automaton(key)
    if automaton is None:
        return []
    best: dict[int, tuple[int, float]] = {}
    spared = []
    for last, (length, prefix, whole, exception) in automaton.iter(folded):
        start, end = last + 1 - length, last + 1
        if start and folded[start - 1].isalpha():
            continue
        closed = end == len(folded) or not folded[end].isalpha()
        if exception and closed:
            spared.append((start, end))
        weight = whole if closed and whole is not None else prefix
        if weight is not None and best.get(start, (0,))[0] < end:
            best[start] = end, weight
    return [
        (start, end, weight)
        for start, (end, weight) in best.items()
        if not any(a <= start and end <= b for a, b in spared)
    ]


def evidence(text: str | None, key: tuple) -> tuple[float, float]:
    """The summed weights, raw and per length (in units of 200 characters, growing as the root)."""
    folded = fold(text)
    total = sum(weight for *_, weight in matches(folded, key))
    return math.log1p(total), math.log1p(total / math.sqrt(1 + len(folded) / 200))


def _score(features: np.ndarray, curve: tuple) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(curve[0] + features @ np.array(curve[1:]), -30, 30)))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """text and toxic of about ``rows`` labelled rows of each kind, never of a held-out id.

    The sampled labels are at most about twice ``rows`` small rows, which is why they can be broadcast.
    """
    known = labels.select("doc_id", "toxic").filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.filter(crc32_bucket(F.col("doc_id"), 4) != 2).groupBy("doc_id")
    known = known.agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_most")).filter("toxic = _most").drop("_most")
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic") == 1, F.lit(rows / max(counts.get(1, 0), 1))).otherwise(
        F.lit(rows / max(counts.get(0, 0), 1))
    )
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / (1 << 20)
    sampled = known.filter(chance < share)
    return docs.select("doc_id", "text").join(F.broadcast(sampled), "doc_id").select("text", "toxic")


def _counted(sample: DataFrame, of) -> DataFrame:
    """Rows of each kind in which a term occurs; ``of`` gives the terms of a folded text."""

    def passed_on(seen: dict[int, Counter]) -> pd.DataFrame:
        every = sorted(seen[0].keys() | seen[1].keys())
        return pd.DataFrame(
            {"term": every, "clean": [seen[0][t] for t in every], "toxic": [seen[1][t] for t in every]}
        ).astype({"term": object, "clean": "int64", "toxic": "int64"})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                seen[toxic].update(set(of(fold(text))))
                if len(seen[0]) + len(seen[1]) > HELD_TERMS:
                    yield passed_on(seen)
                    seen = {0: Counter(), 1: Counter()}
        yield passed_on(seen)

    partial = sample.mapInPandas(count, "term string, clean long, toxic long")
    return partial.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def _all_terms(folded: str) -> set[str]:
    return {term for word in set(_WORD.findall(folded)) for term in terms(word)}


def _log_odds(n_clean: int, n_toxic: int) -> Column:
    """Smoothed log odds of a counted term, from its columns clean and toxic."""
    return F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))


def _chosen(found: dict[str, tuple[int, float]]) -> dict[str, float]:
    """The terms that stay, of (toxic rows, log odds) of each.

    A beginning gives way to one that is a letter longer and keeps nearly all its toxic rows: ordinary words share the
    short beginnings of a listed word, but seldom the long ones. Otherwise it stands for all that extends it: a stem
    with many endings needs one term. A whole word is kept only where no beginning of it is.
    """
    kept = set(found)
    longer: dict[str, list[str]] = {}
    for term in found:
        if not term.endswith(END) and len(term) > PREFIXES.start:
            longer.setdefault(term[:-1], []).append(term)
    for term in sorted(found, key=lambda t: (len(t.removesuffix(END)), t)):
        word = term.removesuffix(END)
        if any(word[:n] in kept and word[:n] != term for n in PREFIXES if n <= len(word)) or any(
            found[other][0] >= KEPT_SHARE * found[term][0] for other in longer.get(term, [])
        ):
            kept.discard(term)
    return {term: found[term][1] for term in kept}


def _curve(features: np.ndarray, labels: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression of two features, neither with a negative weight: more evidence never lowers a score."""
    both = _logistic(features, labels)
    if both[1] >= 0 and both[2] >= 0:
        return tuple(float(v) for v in both)
    loss, weights = [], []
    for place in (0, 1):
        w = _logistic(features[:, [place]], labels)
        p = _score(features[:, [place]], tuple(w))
        loss.append(-np.log(np.where(labels == 1, p, 1 - p) + 1e-12).sum())
        weights.append((float(w[0]), *(max(float(w[1]), 0.0) if place == k else 0.0 for k in (0, 1))))
    return weights[int(np.argmin(loss))]


def _logistic(features: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Ridge-penalised logistic regression by Newton steps; the two kinds count as in the sample."""
    x = np.hstack([np.ones((len(features), 1)), features])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - labels) + 0.01 * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Lexicon:
    """Learns lexicon, exceptions and curve. All that reaches the driver is bounded by ``rows`` or ``CANDIDATES``.

    The sample is stored: documents and labels are read for it once.
    """
    sample = stored(labelled_sample(docs, labels, rows), "toxicity-sample")
    totals = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_clean, n_toxic = totals.get(0, 0), totals.get(1, 0)
    if not n_clean or not n_toxic:
        return Lexicon({})
    odds = _counted(sample, _all_terms).filter(F.col("toxic") >= MIN_ROWS)
    odds = odds.withColumn("odds", _log_odds(n_clean, n_toxic)).filter(F.col("odds") >= MIN_LOG_ODDS)
    top = odds.orderBy(F.desc("odds"), F.desc("toxic"), "term").limit(CANDIDATES).collect()
    weights = _chosen({r["term"]: (r["toxic"], r["odds"]) for r in top})
    key = Lexicon(weights).key()

    def phrases(folded: str) -> Iterator[str]:
        for start, end, _ in matches(folded, key):
            if word := _WORD.match(folded, start):
                if before := re.search(r"[^\W\d_]+ $", folded[max(0, start - 40) : start]):
                    yield before[0] + word[0]
                if after := re.match(r" [^\W\d_]+", folded[word.end() : word.end() + 40]):
                    yield word[0] + after[0]

    spared = _counted(sample, phrases).filter((F.col("clean") >= 3) & (F.col("toxic") == 0))
    exceptions = [r["term"] for r in spared.orderBy(F.desc("clean"), "term").limit(CANDIDATES).collect()]
    key = Lexicon(weights, exceptions).key()

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = [evidence(text, key) for text in batch["text"]]
            yield pd.DataFrame({"a": [p[0] for p in pairs], "b": [p[1] for p in pairs], "toxic": batch["toxic"]})

    measured = sample.mapInPandas(measure, "a double, b double, toxic int").toPandas()
    curve = _curve(measured[["a", "b"]].to_numpy(), measured["toxic"].to_numpy(dtype=float))
    return Lexicon(weights, exceptions, curve)


def score(docs: DataFrame, lexicon: Lexicon, into: str, text_col: str = "text") -> DataFrame:
    """``docs`` and a score from 0 to 1 in the column ``into``."""
    key, curve, empty = lexicon.key(), lexicon.curve, not lexicon.weights

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        if empty:
            return pd.Series(np.zeros(len(texts)))
        return pd.Series(_score(np.array([evidence(text, key) for text in texts]).reshape(-1, 2), curve))

    return docs.withColumn(into, scored(F.col(f"`{text_col}`")))
