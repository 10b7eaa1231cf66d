"""Quality rules: a decision list learned by sequential covering, as Spark conditions.

Everything is DataFrame functions. Statistics are computed in each text's row; the learner only
counts labelled rows by (statistic, bin) in grouped jobs, so it takes all labels and never moves
rows to the driver. A rule is a conjunction of thresholds that covers low-quality rows: literals
are added by information gain on two thirds of the rows, then the last ones are pruned on the
other third; rows that a rule covers are left out when the next one is grown. The outcome is an
ordered list that reads as a conditional expression: the first rule that holds rejects.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygate.llm.common import SPACED, kept, text_of

#: Limits of the fixed rules: fewer words, or a larger share of repeated words, fail.
LEAST_WORDS, MOST_REPEATED = 50, 0.5
RULES, LITERALS, BINS = 12, 4, 64

#: What thresholds are learned on, from the statistics of a row.
MEASURES = {
    "words": "n_words",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols": "n_symbols / greatest(n_words, 1)",
    "repeated": "n_repeat_words / greatest(n_words, 1)",
    "duplicate_lines": "n_dup_lines / greatest(n_lines, 1)",
    "line_words": "n_words / greatest(n_lines, 1)",
    "distinct": "n_distinct / greatest(n_words, 1)",
    "letters": "n_letters / greatest(word_chars, 1)",
    "capitals": "n_capitals / greatest(word_chars, 1)",
    "marks": "n_marks / greatest(n_words, 1)",
}


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counted statistics of every row's whole text; a null text has none."""
    text = F.col("text")

    def left(pattern: str) -> Column:
        return F.length(F.regexp_replace("text", pattern, "")).cast("long")

    words = docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).select(
        "doc_id",
        "text",
        F.regexp_extract_all("text", F.lit(f"({SPACED})"), 0).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(SPACED)).alias("lines"),
    )

    def window(word: Column, i: Column) -> Column:
        return F.xxhash64(word, F.get("words", i + 1), F.get("words", i + 2))

    windows = words.withColumn("windows", F.slice(F.transform("words", window), 1, F.greatest(F.size("words") - 2, F.lit(0))))
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ranked = windows.withColumn("placed", F.when(twice, placed))

    def again(x: Column, k: Column) -> Column:
        return (x["h"] == F.get("placed", k - 1)["h"]) | (x["h"] == F.get("placed", k + 1)["h"])

    found = ranked.withColumn("starts", F.array_sort(F.transform(F.filter("placed", again), lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("starts", lambda s, k: F.least(F.coalesce(F.get("starts", k + 1) - s, F.lit(3)), F.lit(3))),
        F.lit(0).cast("long"),
        lambda n, s: n + s,
    )
    return found.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        left(r"[\x20\x09-\x0D]+").alias("word_chars"),
        left(r"[^#*$%&|<>]+").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        left(r"\P{L}+").alias("n_letters"),
        left(r"\P{Lu}+").alias("n_capitals"),
        left(r"[^!?.,;:]+").alias("n_marks"),
    )


@dataclass(frozen=True)
class Literal:
    measure: str
    above: bool
    cut: float

    def __str__(self) -> str:
        return f"{MEASURES[self.measure]} {'>' if self.above else '<='} {self.cut!r}D"


def condition(rule: list[Literal]) -> Column:
    return F.expr(" AND ".join(f"({x})" for x in rule))


def verdict(rules: list[list[Literal]]) -> Column:
    """True unless a rule of the list, looked at in order, holds."""
    if not rules:
        return F.lit(True)
    first, *rest = rules
    listed = F.when(condition(first), False)
    for rule in rest:
        listed = listed.when(condition(rule), False)
    return listed.otherwise(True)


def learn(stats: DataFrame, labels: DataFrame) -> list[list[Literal]]:
    """The decision list for the labelled rows; quality 0 is what rules reject. Labels without
    quality, or of ids that have no row, are left out; without rows of both kinds it is empty."""
    marked = labels.where("quality is not null").select(
        F.col("doc_id").cast("long"), (F.col("quality") == 0).cast("long").alias("bad")
    )
    measured = [F.expr(f"cast({m} as double)").alias(name) for name, m in MEASURES.items()]
    grows = F.pmod(F.xxhash64("doc_id"), F.lit(3)) > 0
    rows = kept(stats.join(marked, "doc_id").select("bad", grows.alias("grows"), *measured))
    points = [k / BINS for k in range(1, BINS)]
    cut_rows = rows.groupBy("bad").agg(*[F.percentile_approx(m, points, 100 * BINS).alias(m) for m in MEASURES])
    both = cut_rows.collect()  # a row for either kind
    cuts = {m: sorted({x for row in both for x in row[m] or []}) for m in MEASURES}
    if len(both) < 2:
        return []

    def literals(rule: list[tuple[str, bool, int]]) -> Column:
        tests = [(F.col(m) > k) if above else (F.col(m) <= k) for m, above, k in rule]
        return reduce(lambda a, b: a & b, tests, F.lit(True))

    def binned(m: str) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, cuts[m])), lambda c: c < F.col(m))).alias(m)

    left = kept(rows.select("bad", "grows", *[binned(m) for m in MEASURES]))
    sides = F.expr("inline(array(%s))" % ", ".join(f"struct('{m}' as measure, {m} as bin)" for m in MEASURES))
    rules = []
    while len(rules) < RULES:
        rule: list[tuple[str, bool, int]] = []
        now = None
        while len(rule) < LITERALS:
            counted = left.where(F.col("grows") & literals(rule)).select("bad", sides)
            tally = counted.groupBy("measure", "bin").agg(F.sum("bad"), F.sum(1 - F.col("bad"))).collect()
            best, now = _best({(m, b): (p, n) for m, b, p, n in tally}, {m: len(c) for m, c in cuts.items()}, now)
            if best is None:
                break
            rule.append(best)
            if now[1] == 0:
                break
        if not rule:
            break
        starts = [rule[:k] for k in range(1, len(rule) + 1)]
        sums = [
            F.coalesce(F.sum(F.when(literals(r), x)), F.lit(0)) for r in starts for x in (F.col("bad"), 1 - F.col("bad"))
        ]
        counts = left.where(~F.col("grows")).agg(*sums).first()
        worth = [(p - n) / (p + n + 1) for p, n in zip(counts[::2], counts[1::2])]
        k = worth.index(max(worth))
        if worth[k] <= 0:
            break
        rules.append([Literal(m, above, cuts[m][at]) for m, above, at in rule[: k + 1]])
        left = left.where(~literals(rule[: k + 1]))
    return rules


def _best(tally: dict, sizes: dict, now: tuple | None) -> tuple:
    """The literal of the greatest information gain, and what it covers."""
    first = next(iter(sizes))
    bad = sum(p for (m, _), (p, _) in tally.items() if m == first)
    good = sum(n for (m, _), (_, n) in tally.items() if m == first)
    if not bad or not good:
        return None, (bad, good)
    held = math.log2(bad / (bad + good))
    best, gain, covers = None, 1e-9, (bad, good)
    for m, size in sizes.items():
        p = n = 0
        for k in range(size):
            p, n = (a + b for a, b in zip((p, n), tally.get((m, k), (0, 0))))
            for above, x, y in ((False, p, n), (True, bad - p, good - n)):
                if x and (g := x * (math.log2(x / (x + y)) - held)) > gain:
                    best, gain, covers = (m, above, k), g, (x, y)
    return best, covers


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row's statistics with base_failed and kept.

    Nulls: a null text has no words and fails the fixed rules, a null doc_id stays and has no label.
    Repeated rows get a row each; a repeated label counts as often as it stands. Without labels
    only the fixed rules reject. Other columns are not looked at; an empty table gives no rows.
    """
    stats = kept(statistics(docs))
    rules = learn(stats, labels)
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return stats.withColumn("base_failed", failed).withColumn("kept", ~failed & verdict(rules))
