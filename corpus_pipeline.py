"""The corpus pipeline: five stages from ``documents`` to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygate.llm import decontaminate, packing, repeats, simhash, toxicity
from tallygate.llm.common import bounded_batches, scratch, table, vocabulary
from tallygate.sources import files

#: Whole words, and bytes, that a repeated passage has at least before it is cut. Of the repeats of over
#: fifty words in the supplied tables, 99 in 100 have these bytes.
WORDS, PASSAGE = 51, 200


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain calls toxic go; null and empty texts stay, repeated rows are
    judged alike, an empty table stays empty."""
    bounded_batches(spark)
    return toxicity.not_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints of three-word shingles differ in at most three bits, linked or in
    a chain, that with the smallest doc_id stays. Texts without words are one group; rows that repeat doc_id
    and text stay once, others of one doc_id are told apart by their text."""
    bounded_batches(spark)
    return simhash.first_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of passages of over fifty words are cut; documents that had nothing else go. Null and
    empty texts stay."""
    bounded_batches(spark)
    cut = repeats.deduplicated(docs, PASSAGE, WORDS)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item, or a shorter item whole, go. Null and
    empty texts stay; an empty benchmark takes none."""
    bounded_batches(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequence and offset of every piece of what is left; a null or empty text is one end id."""
    bounded_batches(spark)
    return packing.pack_documents(docs, vocabulary())


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("decontaminate", drop_contaminated),
    ("pack", pack),
]

#: No SQL can express learned classifiers, fingerprints or a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet to the shared folder and read again; a
    stage's rows go once the next one's are written."""
    docs = table(spark, sf_dir, "documents")
    place = f"{scratch(spark)}/corpus-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{name}")
        docs = spark.read.parquet(f"{place}/{name}")
        if before is not None:
            files.remove(spark, f"{place}/{before}")
        before = name
    return docs
