"""Hard negatives of anchors, with score bounds along spanning trees of anchors.

A score is an integer inner product. For an anchor b next to an anchor a, the score of a candidate
x moves by at most |b - a| |x|, so what is known of x at a bounds what it can be at b. Anchors of one
label are dealt to groups of about ``GROUP``; a group's minimum spanning tree (by distance) is walked
from its root, where all candidates are scored. At each child, the bounds of the parent are
widened by edge length times candidate norm, and only candidates whose bounds overlap the window
that can still matter are scored; the others pass their wider bounds on.

The trees are walked twice over all rows: for the positives (the window goes from the fifth best
score so far upwards), then for the negatives (from the lowest score that some positive still accepts to
the highest). The rows are dealt to tasks, and the trees in passes of about ``ANCHORS_AT_ONCE`` anchors to
each of them, so a task holds one pass of trees and streams its rows past them in blocks. It
gives its own best of each anchor; the best of all tasks follow by a ranking over those. Work is
rows x anchors at most, as the anchors are a stated query set.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygate.llm.common import kept

#: Anchors of a spanning tree, about.
GROUP = 512
#: Anchors whose trees one task holds, about, and rows that it streams past them at most.
ANCHORS_AT_ONCE = 4096
ROWS_AT_ONCE = 1 << 20
#: Candidates that a tree is walked for together.
BLOCK = 4096
#: Inner products below this are exact in double precision.
_EXACT = float(1 << 52)
_TREE = "label long, at array<long>, ids array<long>, parent array<int>, edge array<double>, vectors binary"


@dataclass(frozen=True)
class Rule:
    """How many positives and negatives an anchor gets, and the window of a negative's score in
    hundredths of the positive's, both ends included."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90


def prepared(vectors: DataFrame, label: Column | None = None, scale: float = 256.0) -> DataFrame:
    """vec_id, label and vector (array of long, floor of ``scale`` times each component) of the rows that
    take part: those without a null or non-finite component, a null vector, label or vec_id."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < float("inf")) & ~F.isnan(v))
    rows = vectors.where(x.isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()).where(finite)
    return rows.select(
        F.col("vec_id").cast("long"),
        (F.col("label") if label is None else label).cast("long").alias("label"),
        F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("vector"),
    )


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prim's minimum spanning tree: the order in which rows join it, the place in that order of each
    one's parent (-1 for the root), and the edge lengths."""
    n = len(vectors)
    real = vectors.astype(float)
    order, parent, edge = np.zeros(n, np.int64), np.full(n, -1), np.zeros(n)
    nearest, link = np.full(n, np.inf), np.full(n, -1)
    left = np.ones(n, bool)
    at = 0
    for k in range(n):
        order[k], parent[k], left[at] = at, link[at], False
        edge[k] = nearest[at] if k else 0.0
        away = np.sqrt(((real - real[at]) ** 2).sum(axis=1))
        closer = left & (away < nearest)
        nearest[closer], link[closer] = away[closer], k
        if k + 1 < n:
            at = int(np.argmin(np.where(left, nearest, np.inf)))
    return order, parent, edge


def _matrix(flat: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """Rows of lists of these sizes, zeros behind the shorter ones."""
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def trees(anchors: DataFrame, group: int, width: int) -> DataFrame:
    """A row for each group of anchors of one label: its share, and the tree with anchors in its order."""
    counts = anchors.groupBy("label").agg(F.count("*").alias("n"))
    shares = F.ceil(F.col("n") / group).cast("long")
    dealt = anchors.join(counts, "label").withColumn("share", F.pmod(F.xxhash64("at"), shares))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("at")
        sizes = frame["vector"].map(len).to_numpy()
        vectors = _matrix(np.concatenate(frame["vector"].to_list()), sizes, width)
        order, parent, edge = spanning_tree(vectors)
        row = {
            "share": frame["share"].iloc[0], "label": frame["label"].iloc[0], "at": frame["at"].to_numpy()[order],
            "ids": frame["vec_id"].to_numpy()[order], "parent": parent, "edge": edge, "vectors": vectors[order].tobytes(),
        }
        return pd.DataFrame([row])

    return dealt.select("label", "share", "at", "vec_id", "vector").groupBy("label", "share").applyInPandas(build, f"share long, {_TREE}")


class Walk:
    """A tree, and the best candidates that its anchors have so far.

    windows: for each anchor its (rank, positive_id, low score, high score, positive score); without
    them, rows of the tree's own label are wanted, else those of others.
    """

    def __init__(self, tree: dict, width: int, most: int, windows: dict[int, list[tuple]] | None = None):
        self.label, self.at, self.ids = tree["label"], tree["at"], tree["ids"]
        self.parent, self.edge = tree["parent"], tree["edge"]
        self.vectors = np.frombuffer(tree["vectors"], np.int64).reshape(-1, width)
        self.norm = float(np.sqrt((self.vectors.astype(float) ** 2).sum(axis=1).max()))
        self.most, self.own = most, windows is None
        every = [[(0, None, -np.inf, np.inf, 0)]] * len(self.at)
        self.windows = every if windows is None else [windows.get(a, []) for a in self.at]
        self.best = [[(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in w] for w in self.windows]
        self.last = {p: k for k, p in enumerate(self.parent)}  # the last child of each
        self.scored = self.met = 0

    def _wanted(self, k: int) -> list[float]:
        """The least score that each window of an anchor still takes."""
        return [
            max(low, scores[-1]) if len(scores) == self.most else low
            for (_, _, low, _, _), (scores, _) in zip(self.windows[k], self.best[k])
        ]

    def past(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, norms: np.ndarray) -> None:
        """Streams a block of rows past the tree."""
        use = np.flatnonzero((labels == self.label) == self.own)
        if not len(use):
            return
        ids, vectors, norms = ids[use], vectors[use], norms[use]
        exact = float(norms.max()) * self.norm < _EXACT
        rows = vectors.astype(float) if exact else vectors
        anchors = self.vectors.astype(float) if exact else self.vectors
        slack = 1 + norms * self.norm * 1e-12  # more than scores and sums lose in double precision
        bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for k, parent in enumerate(self.parent):
            if parent < 0:
                low = high = (rows @ anchors[k]).astype(float)
                at = np.arange(len(ids))
                scores = rows @ anchors[k]
            else:
                reach = self.edge[k] * norms * (1 + 1e-9) + slack
                low, high = bounds[parent][0] - reach, bounds[parent][1] + reach
                if self.last[parent] == k:
                    del bounds[parent]
                wanted = self._wanted(k)
                if wanted:
                    most = max(w[3] for w in self.windows[k])
                    at = np.flatnonzero((high >= min(wanted)) & (low <= most))
                else:
                    at = np.empty(0, np.int64)
                scores = rows[at] @ anchors[k]
                low[at] = high[at] = scores
            self.scored += len(at)
            self.met += len(ids)
            if k in self.last:
                bounds[k] = low, high
            self._take(k, ids[at], scores.astype(np.int64))

    def _take(self, k: int, ids: np.ndarray, scores: np.ndarray) -> None:
        if self.own:
            other = ids != self.ids[k]
            ids, scores = ids[other], scores[other]
        for j, (least, window) in enumerate(zip(self._wanted(k), self.windows[k])):
            met = np.flatnonzero((scores >= least) & (scores <= window[3]))
            if len(met):
                s = np.concatenate([self.best[k][j][0], scores[met]])
                i = np.concatenate([self.best[k][j][1], ids[met]])
                first = np.lexsort((i, -s))[: self.most]
                self.best[k][j] = s[first], i[first]

    def found(self) -> Iterator[tuple]:
        """(at, anchor_id, rank and id of the positive, its score, candidate's id, its score)."""
        for k, at in enumerate(self.at):
            for (rank, positive, _, _, own), (scores, ids) in zip(self.windows[k], self.best[k]):
                for s, i in zip(scores.tolist(), ids.tolist()):
                    yield at, self.ids[k], rank, positive, own, i, s


_FOUND = "at long, anchor_id long, positive_rank int, positive_id long, positive_score long, found_id long, score long"
_KINDS = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 4]
_NAMES = [part.split()[0] for part in _FOUND.split(", ")]


def _best_of_tasks(dealt: DataFrame, width: int, most: int) -> DataFrame:
    """The best candidates that each task has for each window. dealt: ``key``, and either a tree (with
    ``windows``) or a row of vectors; a key's trees come first."""

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, walks, held, count = None, [], [], 0

        def stream() -> None:
            nonlocal held, count
            if held:
                ids, labels, vectors = (np.concatenate(part) for part in zip(*held))
                norms = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
                for a in range(0, len(ids), BLOCK):
                    b = a + BLOCK
                    for walk in walks:
                        walk.past(ids[a:b], labels[a:b], vectors[a:b], norms[a:b])
            held, count = [], 0

        def told() -> Iterator[pa.RecordBatch]:
            for walk in walks:
                rows = list(walk.found())
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), _KINDS)], _NAMES)

        for batch in batches:
            keys = batch["key"].to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if b == a:
                    continue
                if keys[a] != key:
                    stream()
                    yield from told()
                    key, walks = keys[a], []
                part = batch.slice(a, b - a)
                given = pa.compute.is_valid(part["tree"])
                for tree, windows in zip(part["tree"].filter(given).to_pylist(), part["windows"].filter(given).to_pylist()):
                    per_anchor: dict[int, list[tuple]] | None = None
                    if windows is not None:
                        per_anchor = {}
                        for w in windows:
                            window = (w["positive_rank"], w["positive_id"], w["low"], w["high"], w["positive_score"])
                            per_anchor.setdefault(w["at"], []).append(window)
                    walks.append(Walk(tree, width, most, per_anchor))
                rows = part.filter(pa.compute.invert(given))
                if rows.num_rows:
                    lists = rows["vector"]
                    sizes = pa.compute.list_value_length(lists).to_numpy()
                    matrix = _matrix(lists.flatten().to_numpy(), sizes, width)
                    held.append((rows["vec_id"].to_numpy(), rows["label"].to_numpy(), matrix))
                    count += rows.num_rows
                    if count >= BLOCK:
                        stream()
        stream()
        yield from told()

    return dealt.mapInArrow(walked, _FOUND)


def _dealt(rows: DataFrame, grown: DataFrame, passes: int, tasks: int) -> DataFrame:
    """Every row once for each pass, and every tree once for each task of its pass, sorted by key."""
    to_task = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(tasks))
    window = "array<struct<at:long,positive_rank:int,positive_id:long,low:long,high:long,positive_score:long>>"
    windows = F.col("windows") if "windows" in grown.columns else F.lit(None)
    tree = F.struct(*[part.split()[0] for part in _TREE.split(", ")])
    of_pass = F.pmod(F.xxhash64("label", "share"), F.lit(passes))
    kinds = grown.select(tree.alias("tree")).schema["tree"].dataType
    left = grown.select(
        of_pass.alias("pass"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tasks - 1).cast("long"))).alias("task"),
        tree.alias("tree"), windows.cast(window).alias("windows"),
        F.lit(None).cast("long").alias("vec_id"), F.lit(None).cast("long").alias("label"), F.lit(None).cast("array<long>").alias("vector"),
    )
    right = rows.withColumn("task", to_task).select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(passes - 1).cast("long"))).alias("pass"), "task",
        F.lit(None).cast(kinds).alias("tree"), F.lit(None).cast(window).alias("windows"), "vec_id", "label", "vector",
    )
    keyed = left.union(right).withColumn("key", F.col("pass") * tasks + F.col("task")).drop("pass", "task")
    return keyed.repartition("key").sortWithinPartitions("key", F.col("tree").isNull())


def hard_negatives(
    rows: DataFrame, anchor: Column, rule: Rule = Rule(), group: int = GROUP,
    anchors_at_once: int = ANCHORS_AT_ONCE, rows_at_once: int = ROWS_AT_ONCE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score: of each anchor and each
    of its positives, the best rows of other labels in the window of the positive's score.

    rows: vec_id, label and vector, as ``prepared`` gives them; anchor: which of them are anchors. Scores are
    ordered downwards, ties by smaller vec_id; a vector that is shorter than another has zeros behind.
    Scores are taken to fit 64 bits. Repeated rows are rows of their own, as candidates and as anchors; a row
    with an anchor's own vec_id is not a positive of it. A positive whose window is empty (a negative
    score) or holds nothing gives no rows. An empty table or one without anchors gives none; other
    columns are not looked at.
    """
    rows = kept(rows.select("vec_id", "label", "vector"))
    n, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    anchors = kept(rows.where(anchor).withColumn("at", F.monotonically_increasing_id()))
    n_anchors = anchors.count()
    grown = kept(trees(anchors, group, width))
    passes = max(1, -(-n_anchors // anchors_at_once))
    slots = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(slots, -(-n // BLOCK)), -(-n // rows_at_once))

    def ranked(found: DataFrame, by: list[str], most: int, name: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), "found_id")
        return found.withColumn(name, F.row_number().over(order)).where(F.col(name) <= most)

    near = _best_of_tasks(_dealt(rows, grown, passes, tasks), width, rule.positives)
    positives = ranked(near.drop("positive_rank"), ["at"], rule.positives, "positive_rank")
    own = F.col("score").cast("decimal(38,0)")
    window = F.struct(
        "at", "positive_rank", F.col("found_id").alias("positive_id"), F.ceil(own * rule.low / 100).cast("long").alias("low"),
        F.floor(own * rule.high / 100).cast("long").alias("high"), F.col("score").alias("positive_score"),
    )
    placed = grown.select("label", "share", F.explode("at").alias("at"))
    told = positives.join(placed, "at").groupBy("label", "share").agg(F.collect_list(window).alias("windows"))
    far = _best_of_tasks(_dealt(rows, kept(grown.join(told, ["label", "share"])), passes, tasks), width, rule.negatives)
    best = ranked(far, ["at", "positive_rank"], rule.negatives, "rank")
    return best.select(
        "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
