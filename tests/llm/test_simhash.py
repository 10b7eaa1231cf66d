from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallygate.llm import simhash
from tests.llm.shapes import documents, odd_rows, prose


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)][: len(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(fps, most):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("text", ["", None, "one", "Two words", "a b c", "A\tb\x0bC d e  f É É É", prose(2, 5000)])
def test_fingerprint(text):
    assert int.from_bytes(simhash.fingerprint((text or "").encode()), "big") == plain_fingerprint(text)


def test_odd_rows(spark):
    rows = odd_rows()
    found = simhash.near_duplicates(documents(spark, extra=True)).collect()
    groups = plain_groups([plain_fingerprint(t) for _, t in rows], 3)
    least = {}
    for (doc, _), g in zip(rows, groups):
        least[g] = min((x for x in (least.get(g), doc) if x is not None), default=None)
    expected = [(d, plain_fingerprint(t), least[g]) for (d, t), g in zip(rows, groups)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = [(r["doc_id"], r["fp0"] % (1 << 64), r["component_id"]) for r in found]
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


@pytest.mark.parametrize("block", [simhash.BLOCK, 7])
def test_links_join_what_all_pairs_join(spark, block):
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(4)]
    fps = list({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for c in centres for _ in range(60)})
    fps += [rng.getrandbits(64) for _ in range(60)]
    signed = sorted(int(np.uint64(f).astype(np.int64)) for f in fps)
    frame = spark.createDataFrame([(f, f) for f in signed], "node long, fp0 long")
    found = {r["node"]: r["root"] for r in simhash.components(simhash.links(frame, block=block)).collect()}
    groups = plain_groups([f % (1 << 64) for f in signed], 3)
    assert [found.get(f, f) for f in signed] == [signed[g] for g in groups]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 600), (600, 500)], "a long, b long")
    found = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert found == {k: 0 for k in range(1, 201)} | {600: 500}


def test_the_first_of_each_group_stays(spark):
    base = prose(11, 300).split()
    near = list(base)
    near[100] = "changed"
    rows = [(5, " ".join(base)), (6, " ".join(base)), (7, " ".join(near)), (8, prose(12, 300)), (8, prose(12, 300)), (None, prose(13, 9))]
    rows += [(5, prose(14, 90)), (9, prose(14, 90)), (None, " ".join(base)), (None, prose(15, 50)), (None, prose(15, 50)), (20, None), (21, "")]
    given = documents(spark, rows, extra=True).withColumn("my col", F.lit(1))
    stay = simhash.first_of_each(given)
    assert stay.columns == given.columns
    groups = plain_groups([plain_fingerprint(t) for _, t in rows], 3)
    least = {}
    for (doc, text), g in zip(rows, groups):
        place = (doc is None, doc or 0)
        least[g] = min(least.get(g, (True, 1 << 60)), place)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in stay.collect()) == sorted(least.values())
    texts = {r["text"] for r in stay.where("doc_id = 5").collect()}
    assert texts == {" ".join(base), prose(14, 90)}  # both stand for a group
    assert simhash.first_of_each(documents(spark, [])).count() == 0


def test_more_bits_than_the_lists_guarantee(spark):
    with pytest.raises(ValueError, match="up to 3"):
        simhash.near_duplicates(documents(spark), bits=4)
