"""The learned operators: language, toxicity, quality."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallygate.llm import language, quality, toxicity
from tests.llm.shapes import documents, odd_rows, prose

ENDINGS = {"aa": ["ing", "the", "wor", "sh"], "bb": ["eau", "ment", "qué", "oi"], "cc": ["ung", "sch", "heit", "ß"]}


def spoken(lang, seed, n=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(ENDINGS[lang], k=rng.randint(1, 3))) for _ in range(n))


def test_language_of_held_out_rows(spark):
    rows = [(k, spoken(lang, k), lang) for k, lang in enumerate(["aa", "bb", "cc"] * 30)]
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 !!", "cc"), (None, spoken("aa", 7), None), (1003, spoken("bb", 8) * 200, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'x' as lang_pred", "1 as score")
    found = {r["doc_id"]: r for r in language.held_out_prediction(frame).collect()}
    assert len(found) == len(rows)
    for doc, text, lang in rows:
        r = found[doc]
        assert r["held_out"] == (doc is not None and zlib.crc32(str(doc).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
        if doc in (1000, 1001, 1002):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif lang:
            assert r["lang_pred"] == lang
    assert found[None]["lang_pred"] == "aa" and found[1003]["lang_pred"] == "bb"


def test_language_without_rows_or_labels(spark):
    none = documents(spark, [])
    assert language.held_out_prediction(none).count() == 0
    unlabelled = documents(spark, extra=True).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.held_out_prediction(unlabelled).collect()} == {"und"}


def test_distances_equal_plain_profiles():
    texts = ["Abba ab, b!", "éA éa", "", None, "x" * 50]

    def ranked(text):
        count = Counter()
        for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
            padded = f" {word} "
            for n in (1, 2, 3):
                count.update(g for g in (padded[k : k + n] for k in range(len(padded) - n + 1)) if g.strip())
        number = lambda g: sum(ord(c) << 16 * (len(g) - 1 - k) for k, c in enumerate(g))
        return [number(g) for g, _ in sorted(count.items(), key=lambda x: (-x[1], number(x[0])))]

    profiles = {"p": ranked("ab ab ba")[:5], "q": ranked("éa xx")[:5]}
    found, n = language.out_of_place([t and t.encode() for t in texts], profiles, 6)
    for k, text in enumerate(texts):
        own = ranked(text)[:6]
        assert n[k] == len(own)
        for j, lang in enumerate("pq"):
            known = profiles[lang]
            assert found[k, j] == sum(abs(known.index(g) - i) if g in known else 6 for i, g in enumerate(own))


def test_the_chain_finds_held_out_toxic_rows(spark):
    rng = random.Random(6)
    bad = ["grobnak", "grobnik", "zlurt"]
    rows, labels = [], []
    for k in range(900):
        words = prose(k, 60).split()
        toxic, junk = rng.random() < 0.2, rng.random() < 0.2
        if toxic:
            words.insert(rng.randrange(60), rng.choice(bad))
        if junk:
            words = [w + "###" for w in words]
        rows.append((k, " ".join(words)))
        labels.append((k, int(not junk), int(toxic)))
    kinds = "doc_id long, quality int, toxic int"
    docs = documents(spark, rows + odd_rows()[5:7], extra=True)
    models = toxicity.fit(docs, spark.createDataFrame(labels[:600], kinds))
    assert len(models) == 2 and len(models[1].chained) == 1
    found = {r["row"]["doc_id"]: r for r in toxicity.score(docs, models).collect()}
    right = sum((found[k]["p_toxic"] >= 0.5) == bool(t) for k, _, t in labels[600:])
    assert right >= 0.97 * 300
    assert sum((found[k]["p_junk"] >= 0.5) == (not q) for k, q, _ in labels[600:]) >= 0.97 * 300


def test_toxicity_of_odd_rows_and_without_labels(spark):
    labels = spark.createDataFrame([(4, 1, 0), (4, None, 1), (99, 0, 1), (None, 0, 1), (7, 0, None)], "doc_id long, quality int, toxic int")
    docs = documents(spark, extra=True)
    found = toxicity.toxicity(docs, labels).collect()
    assert len(found) == len(odd_rows()) and all(0 <= r["p_toxic"] <= 1 for r in found)
    none = labels.where("false")
    assert not any(r["toxic"] for r in toxicity.toxicity(docs, none).collect())
    stay = toxicity.not_toxic(docs, none)
    assert stay.count() == len(odd_rows()) and stay.columns == docs.columns
    assert toxicity.toxicity(documents(spark, []), labels).count() == 0


def plain_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    count, covered = Counter(windows), set()
    for k, w in enumerate(windows):
        if count[w] > 1:
            covered |= {k, k + 1, k + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_statistics(spark):
    rows = odd_rows() + [(30, "a b c a b c x\n a b c a b c x\n\ny\ny "), (31, "#* a|b <c> " * 40), (32, "x y z x y z x y z"), (33, "one\x00two three")]
    found = quality.quality(documents(spark, rows, extra=True), spark.createDataFrame([], "doc_id long, quality int")).collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    got = [(r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in found]
    assert sorted(got, key=key) == sorted(((d, *plain_statistics(t)) for d, t in rows), key=key)
    for r in found:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (not r["base_failed"])  # nothing is learned without labels


def test_a_decision_list_is_learned(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for k in range(600):
        words = prose(k, 80).split()
        kind = rng.choice(["good", "good", "symbols", "lines"])
        text = " ".join(w + "#" if kind == "symbols" and rng.random() < 0.7 else w for w in words)
        if kind == "lines":
            text = "\n".join([" ".join(words[:9])] * 2 + [" ".join(words)] + ["end of it"] * 9)
        rows.append((k, text))
        labels.append((k, int(kind == "good")))
    labelled = spark.createDataFrame(labels[:400], "doc_id long, quality int")
    found = {r["doc_id"]: r["kept"] for r in quality.quality(documents(spark, rows), labelled).collect()}
    assert sum(found[k] == bool(q) for k, q in labels[400:]) >= 0.97 * 200
    rules = quality.learn(quality.kept(quality.statistics(documents(spark, rows))), labelled)
    assert 1 <= len(rules) <= quality.RULES and all(1 <= len(r) <= quality.LITERALS for r in rules)
    assert "CASE WHEN" in str(quality.verdict(rules)) and quality.quality(documents(spark, []), labelled).count() == 0
