"""Language identification by rank-order profiles.

A profile is a text's or a language's most frequent n-grams of one to three letters, word edges
included, in the order of their counts. A document gets the language from whose profile its own
is out of place least: the sum of how many ranks apart each of its n-grams stands in the two, and
the profile's length where the language lacks it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallygate.llm.common import bounded_sample, slices, text_of

RANKS = 400
LONGEST = 3
#: Rows of each language that a model is fitted on, and languages that it may have.
SAMPLE, LANGUAGES = 1000, 1000
UNKNOWN = "und"
_SPACE = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point its lower-case letter, or a blank if it is no letter. Letters beyond the
    basic plane count as one."""
    table = np.full(0x110000, _SPACE, np.uint16)
    for c in range(0x110000):
        if chr(c).isalpha():
            lower = chr(c).lower()
            low = ord(lower) if len(lower) == 1 else c
            table[c] = low if low < 0xFFFF else 0xFFFF
    return table


def grams(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, n-gram, count) of every n-gram of the texts, by text, then n-gram."""
    codes, owner = [], []
    for k, text in enumerate(texts):
        points = np.frombuffer((text or b"").decode().encode("utf-32-le"), np.uint32)
        codes += [[_SPACE], _letters()[points], [_SPACE]]
        owner.append(len(points) + 2)
    letters = np.concatenate(codes).astype(np.uint64) if codes else np.empty(0, np.uint64)
    doc = np.repeat(np.arange(len(texts), dtype=np.uint64), owner)
    blank = letters == _SPACE
    again = blank[1:] & blank[:-1] & (doc[1:] == doc[:-1])
    stay = ~np.concatenate([np.zeros(len(doc[:1]), bool), again])
    letters, doc, blank = letters[stay], doc[stay], blank[stay]
    keys = []
    for n in range(1, LONGEST + 1):
        if len(letters) < n:
            break
        last = len(letters) - n + 1
        whole = doc[:last] == doc[n - 1 :]
        if n == 1:
            whole &= ~blank
        for k in range(1, n - 1):  # no blank inside
            whole &= ~blank[k : last + k]
        if n == 2:
            whole &= ~(blank[:last] & blank[1:])
        key = doc[:last] << np.uint64(48)
        for k in range(n):
            key = key | letters[k : last + k] << np.uint64(16 * (n - 1 - k))
        keys.append(key[whole])
    found, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *keys]), return_counts=True)
    return (found >> np.uint64(48)).astype(np.int64), (found & np.uint64((1 << 48) - 1)).astype(np.int64), counts


def fit(docs: DataFrame, ranks: int = RANKS, sample: int = SAMPLE) -> dict[str, list[int]]:
    """The n-grams of each language's profile, the most frequent first.

    Fitted on about ``sample`` whole texts of each of the ``LANGUAGES`` most frequent languages. Rows
    without a text or language are left out.
    """
    rows = docs.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    common = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    drawn = bounded_sample(rows, "lang", {r["lang"]: r["count"] for r in common}, F.col("doc_id"), sample)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            owner, gram, n = grams(batch["text"].cast(pa.binary()).to_pylist())
            names = ["lang", "gram", "n"]
            yield pa.RecordBatch.from_arrays([batch["lang"].take(pa.array(owner)), pa.array(gram), pa.array(n)], names)

    tally = drawn.select("text", "lang").mapInArrow(counted, "lang string, gram long, n long")
    total = tally.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    profiles: dict[str, list[int]] = {}
    for r in total.withColumn("rank", rank).where(F.col("rank") <= ranks).orderBy("lang", "rank").collect():
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return profiles


def out_of_place(texts: list[bytes | None], profiles: dict[str, list[int]], ranks: int) -> tuple[np.ndarray, np.ndarray]:
    """The distance of each text to each profile, languages in alphabetical order, and the number of
    n-grams in the text's own profile."""
    owner, gram, n = grams(texts)
    order = np.lexsort((gram, -n, owner))
    owner, gram = owner[order], gram[order]
    place = np.arange(len(owner)) - np.searchsorted(owner, owner)
    keep = place < ranks
    owner, gram, place = owner[keep], gram[keep], place[keep]
    distances = np.zeros((len(texts), len(profiles)))
    for k, lang in enumerate(sorted(profiles)):
        known = np.array(profiles[lang], np.int64)
        by = np.argsort(known)
        at = np.minimum(np.searchsorted(known[by], gram), len(known) - 1)
        same = known[by][at] == gram
        apart = np.where(same, np.abs(by[at] - place), ranks)
        distances[:, k] = np.bincount(owner, apart, len(texts))
    return distances, np.bincount(owner, minlength=len(texts))


def identify(docs: DataFrame, profiles: dict[str, list[int]], ranks: int = RANKS) -> DataFrame:
    """doc_id, lang_pred and score of every row, from its whole text alone.

    lang_pred is ``und``, with score 0, for a null text, one without letters, or a model without
    languages; of equally near languages it is the first in the alphabet. score is how much nearer
    the language is than the second, as a share of the second's distance; 1 if there is no second.
    Repeated rows get a row each and a null doc_id stays; an empty table gives no rows.
    """
    names = np.array([*sorted(profiles), UNKNOWN], object)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            distances, n = out_of_place(batch["text"].cast(pa.binary()).to_pylist(), profiles, ranks)
            if profiles:
                best = np.where(n > 0, distances.argmin(axis=1), len(profiles))
                near = np.sort(distances, axis=1)
                second = near[:, 1] if len(profiles) > 1 else np.full(len(n), np.inf)
                score = np.where((n > 0) & (second > 0), 1 - near[:, 0] / np.maximum(second, 1e-9), 0.0)
            else:
                best, score = np.zeros(len(n), np.int64), np.zeros(len(n))
            columns = [batch["doc_id"], pa.array(names[best], pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    return rows.mapInArrow(named, "doc_id long, lang_pred string, score double")


def held_out_prediction(docs: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """doc_id, held_out, lang_pred and score, learned from the rows outside the held-out fold only.
    A row without doc_id is in no fold: it is neither held out nor learned from."""
    fold = F.crc32(F.col("doc_id").cast("string")) % folds
    profiles = fit(docs.where(fold != held))
    out = F.coalesce(fold == held, F.lit(False))
    return identify(docs, profiles).withColumn("held_out", out)
