from __future__ import annotations

import re

import pytest

from tallygate.llm import decontaminate
from tests.llm.shapes import documents, odd_rows, prose

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, items, window=10):
    own, hit, found = words(text), set(), set()
    for item, t in items:
        ws = words(t)
        n = min(window, len(ws))
        for s in range(max(1, len(ws) - window + 1) if ws else 0):
            for k in range(len(own) - n + 1):
                if own[k : k + n] == ws[s : s + n]:
                    hit.update(range(k, k + n))
                    found |= {item} - {None}
    return len(own), len(hit), sorted(found)


def cases():
    passage = prose(20, 30)
    items = [(1, passage), (1, passage), (2, "Tiny item"), (3, None), (4, ""), (None, prose(21, 12)), (5, prose(22, 10))]
    docs = odd_rows() + [
        (20, f"{prose(23, 40)} {passage.upper()} end"),
        (21, " ".join(passage.split()[5:20])),
        (22, " ".join(passage.split()[5:14])),
        (23, "a tiny, ITEM! and tiny item"),
        (24, f"{prose(22, 10)} {prose(22, 10)}"),
        (25, prose(21, 12)),
    ]
    return docs, items


@pytest.mark.parametrize("most", [decontaminate.BLOCK_BYTES, 60])
def test_results_equal_a_plain_search(spark, monkeypatch, most):
    docs, items = cases()
    blocks = decontaminate.query_blocks
    monkeypatch.setattr(decontaminate, "query_blocks", lambda b, w: blocks(b, w, most))
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as n_hit")
    found = decontaminate.contamination(documents(spark, docs, extra=True), benchmark).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_hit"], sorted(r["items"])) for r in found) == sorted(
        (d or 0, *plain(t, items)) for d, t in docs
    )
    assert all(sum(e - s for s, e in zip(r["starts"], r["ends"])) == r["n_hit"] for r in found)
    clean = decontaminate.clean(documents(spark, docs, extra=True), benchmark)
    assert clean.count() == sum(plain(t, items)[1] == 0 for _, t in docs)
    assert clean.columns == documents(spark, docs, extra=True).columns


def test_proximity_matches_allow_moved_words(spark):
    item = [(1, "one two three four five")]
    docs = [(1, "one two three four five"), (2, "one two extra three four five"), (3, "one x x x x two three four five")]
    benchmark = spark.createDataFrame(item, "item_id long, text string")
    found = decontaminate.contamination(documents(spark, docs), benchmark, slop=1).collect()
    assert {r["doc_id"]: (r["items"], r["near_items"]) for r in found} == {1: ([1], [1]), 2: ([], [1]), 3: ([], [])}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(documents(spark, []), none).count() == 0
    assert {r["n_hit"] for r in decontaminate.contamination(documents(spark), none).collect()} == {0}
