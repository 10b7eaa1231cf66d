"""Toxicity by a chain of linear classifiers.

Categories are predicted in order. Each has a logistic model over the presence of words and word
beginnings, and over the probabilities of the categories before it. Those are out-of-fold when
a later model is trained: each training row gets them from a model that has not seen its fold, so
that a later model meets probabilities of the kind that it gets for new rows.

The supplied labels know two categories: junk (quality 0) and toxic. The models are fitted on
about ``SAMPLE`` labelled documents, a documented bound; the features are chosen by counts that
Spark takes over them. All documents are scored, by their whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tallygate.llm.common import kept, slices, text_of, whole_row

#: The chain, and what counts as a category's positive label.
CATEGORIES = {"junk": "quality = 0", "toxic": "toxic = 1"}
SAMPLE = 20_000
FOLDS = 3
#: Features of a model, at most.
FEATURES = 1000
BEGINNINGS = range(4, 10)
THRESHOLD = 0.5
#: The bias of a category that no labelled row has.
NEVER = -20.0
_TOKEN = re.compile(r"[^\W\d_]+|[^\w\s]+")


class _Features(dict):
    """The features of a token, remembered: itself and its beginnings, or those of them wanted."""

    def __init__(self, wanted: set[str] | None = None):
        self.wanted = wanted

    def __missing__(self, token: str) -> tuple[str, ...]:
        if len(self) > 50_000:
            self.clear()
        found = (token, *[f"{token[:n]}-" for n in BEGINNINGS if len(token) > n])
        if self.wanted is not None:
            found = tuple(f for f in found if f in self.wanted)
        self[token] = found
        return found


def features(text: str | None, known: _Features) -> set[str]:
    return {f for token in set(_TOKEN.findall((text or "").lower())) for f in known[token]}


def sampled(docs: DataFrame, labels: DataFrame, sample: int, categories: dict[str, str] = CATEGORIES) -> DataFrame:
    """text, fold and the categories (1, 0 or null) of about ``sample`` labelled documents. A document
    with several labels is positive where one of them is."""
    named = [F.max(F.expr(f"cast({test} as int)")).alias(c) for c, test in categories.items()]
    marked = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*named)
    share = min(1.0, sample / max(1, marked.count()))
    drawn = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    fold = F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold")  # copies share a fold
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.join(F.broadcast(drawn), "doc_id").select("text", fold, *categories)  # drawn is bounded


def _tally(rows: DataFrame, categories: list[str]) -> DataFrame:
    """How many documents of each fold hold each feature, and how many of them are positive."""
    names = ["feature", "fold", "n", *categories]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Features()
        for batch in slices(batches, "text", 1 << 20):
            marks = [batch[c].to_pylist() for c in categories]
            n, positive = Counter(), [Counter() for _ in categories]
            for text, fold, *ys in zip(batch["text"].to_pylist(), batch["fold"].to_pylist(), *marks):
                own = [(f, fold) for f in features(text, known)]
                n.update(own)
                for y, counter in zip(ys, positive):
                    if y:
                        counter.update(own)
            columns = [[f for f, _ in n], [k for _, k in n], [*n.values()], *[[c[x] for x in n] for c in positive]]
            kinds = [pa.string(), pa.int32(), *[pa.int64()] * (1 + len(categories))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    kinds = ", ".join(f"{c} long" for c in ["n", *categories])
    parts = rows.mapInArrow(counted, f"feature string, fold int, {kinds}")
    sums = [F.sum(F.when(F.col("fold") == k, F.col(c))).alias(f"{c}_{k}") for c in names[2:] for k in range(FOLDS)]
    return kept(parts.groupBy("feature").agg(*sums).na.fill(0))


def least_ratio(candidates: int) -> float:
    """The log-likelihood ratio that a feature needs, so that among so many candidates hardly one gets
    there by chance; a small sample has fewer and asks for less."""
    return 2 * math.log(max(2, candidates)) + 2


def _chosen(
    tally: DataFrame, category: str, folds: list[int], n: int, positive: int, least: float
) -> list[str]:
    """The features that tell most about a category in these folds, by log-likelihood ratio."""
    if not 0 < positive < n:
        return []
    both = [F.greatest(sum(F.col(f"{c}_{k}") for k in folds).cast("double"), F.lit(0.0)) for c in (category, "n")]
    p, held = both[0], both[1]

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    rate = F.lit(positive / n)
    ratio = 2 * (part(p, held * rate) + part(held - p, held * (1 - rate)))
    scored = tally.select("feature", ratio.alias("ratio"), (p > held * rate).alias("more"))
    best = scored.where((F.col("ratio") >= least) & F.col("more")).orderBy(F.desc("ratio"), "feature")
    return [r["feature"] for r in best.limit(FEATURES).collect()]


@dataclass
class Linear:
    """A logistic model: a bias, weights of features, and weights of earlier categories."""

    bias: float
    weights: dict[str, float]
    chained: list[float]

    def probability(self, own: set[str], earlier: list[float]) -> float:
        z = self.bias + sum(w * p for w, p in zip(self.chained, earlier))
        z += sum(map(self.weights.__getitem__, own & self.weights.keys()))
        return float(1 / (1 + np.exp(-z)))


def _fit(rows: list[set[str]], earlier: np.ndarray, y: np.ndarray, names: list[str], rounds: int = 400) -> Linear:
    """Regularized maximum likelihood by accelerated gradient steps."""
    column = {f: k for k, f in enumerate(names)}
    pairs = [(r, column[f]) for r, own in enumerate(rows) for f in own if f in column]
    row, at = np.array(pairs, np.int64).reshape(-1, 2).T
    m, extra = len(names), earlier.shape[1]
    weights = np.zeros(m + extra + 1)
    if not y.any():
        return Linear(NEVER, {}, [0.0] * extra)
    weights[-1] = np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))
    ahead, squares = np.zeros_like(weights), np.zeros_like(weights)
    for t in range(1, rounds + 1):
        z = np.bincount(row, weights[at], len(y)) + earlier @ weights[m : m + extra] + weights[-1]
        off = (1 / (1 + np.exp(-z)) - y) / max(1, len(y))
        slope = np.concatenate([np.bincount(at, off[row], m)[:m], earlier.T @ off, [off.sum()]])
        slope[:-1] += 1e-5 * weights[:-1]
        ahead = 0.9 * ahead + 0.1 * slope
        squares = 0.999 * squares + 0.001 * slope**2
        step = (ahead / (1 - 0.9**t)) / (np.sqrt(squares / (1 - 0.999**t)) + 1e-10)
        weights -= 0.05 * step
    return Linear(float(weights[-1]), dict(zip(names, weights[:m].tolist())), weights[m:-1].tolist())


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, categories: dict[str, str] = CATEGORIES) -> list[Linear]:
    """The chain's models, one for each category in order."""
    rows = kept(sampled(docs, labels, sample, categories))
    names = list(categories)
    tally = _tally(rows, names)
    least = least_ratio(tally.count())
    counts = [x for c in names for x in (F.count(c).alias(f"n_{c}"), F.sum(c).alias(f"p_{c}"))]
    sizes = {}
    for r in rows.groupBy("fold").agg(*counts).collect():
        sizes |= {(c, r["fold"]): (r[f"n_{c}"], r[f"p_{c}"] or 0) for c in names}
    chosen = {}
    for c in names:
        for out in [None, *range(FOLDS)]:
            folds = [k for k in range(FOLDS) if k != out]
            n, p = (sum(sizes.get((c, k), (0, 0))[i] for k in folds) for i in (0, 1))
            chosen[c, out] = _chosen(tally, c, folds, n, p, least)
    wanted = {f for fs in chosen.values() for f in fs}

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Features(wanted)
        for batch in slices(batches, "text", 2 << 20):
            own = [sorted(features(t, known)) for t in batch["text"].to_pylist()]
            columns = [pa.array(own, pa.list_(pa.string())), batch["fold"], *[batch[c] for c in names]]
            yield pa.RecordBatch.from_arrays(columns, ["own", "fold", *names])

    kinds = ", ".join(f"{c} int" for c in names)
    # the sample's rows, each with the chosen features that it holds
    drawn = rows.mapInArrow(held, f"own array<string>, fold int, {kinds}").orderBy("fold", "own", *names).collect()
    own = [set(r["own"]) for r in drawn]
    fold = np.array([r["fold"] for r in drawn], np.int64)
    earlier, models = np.zeros((len(drawn), 0)), []
    for c in names:
        y = np.array([np.nan if r[c] is None else r[c] for r in drawn], float)
        models.append(_fit_rows(own, earlier, y, ~np.isnan(y), chosen[c, None]))
        out_of_fold = np.zeros(len(drawn))
        for k in range(FOLDS):
            part = _fit_rows(own, earlier, y, ~np.isnan(y) & (fold != k), chosen[c, k])
            for at in np.flatnonzero(fold == k):
                out_of_fold[at] = part.probability(own[at], earlier[at].tolist())
        earlier = np.column_stack([earlier, out_of_fold])
    return models


def _fit_rows(own: list[set[str]], earlier: np.ndarray, y: np.ndarray, use: np.ndarray, names: list[str]) -> Linear:
    at = np.flatnonzero(use)
    return _fit([own[k] for k in at], earlier[at], y[at], names)


def score(docs: DataFrame, models: list[Linear], categories: list[str] | None = None) -> DataFrame:
    """``row``, a struct of the columns of ``docs``, and a probability for each category, p_<name>."""
    names = [f"p_{c}" for c in categories or CATEGORIES]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Features({f for m in models for f in m.weights})
        for batch in slices(batches, "text", 2 << 20):
            found = []
            for text in batch["text"].to_pylist():
                own, chain = features(text, known), []
                for model in models:
                    chain.append(model.probability(own, chain))
                found.append(chain)
            columns = [pa.array(p, pa.float64()) for p in zip(*found)]
            yield pa.RecordBatch.from_arrays([batch["row"], *columns], ["row", *names])

    rows = docs.select(whole_row(docs).alias("row"), text_of().alias("text"))
    kinds = [StructField(n, DoubleType()) for n in names]
    return rows.mapInArrow(scored, StructType([rows.schema["row"], *kinds]))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, p_junk, p_toxic and toxic of every row.

    Nulls: a null text has no features and gets the base rate, a null doc_id stays and has no
    label, a null label teaches nothing about its category. Repeated rows get a row each. Without
    labels no row is toxic. Other columns are not looked at; an empty table gives no rows.
    """
    found = score(docs.select("doc_id", "text").select(F.col("doc_id").cast("long"), "text"), fit(docs, labels))
    return found.select("row.doc_id", "p_junk", "p_toxic", (F.col("p_toxic") >= threshold).alias("toxic"))


def not_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that aren't toxic, with all their columns, whatever their names.

    Nulls: a row with a null or empty text is judged by the base rate, so it stays. Repeated rows are
    judged alike. Without labels, and of an empty table, all rows stay.
    """
    return score(docs, fit(docs, labels)).where(F.col("p_toxic") < threshold).select("row.*")
