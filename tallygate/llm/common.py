"""What the operators of this subpackage share: tables, scratch, Arrow batches, model samples."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The words of the licence and benchmark operators: ASCII letters (lower-cased), digits, non-ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words between white space, for the operators that keep punctuation.
SPACED = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Rows that go to a Python worker at once, at most.
BATCH_ROWS = 256


def bounded_batches(spark: SparkSession) -> None:
    """Hold the session's Arrow batches to ``BATCH_ROWS`` rows: texts are long, and a batch stands
    in the memory of an executor and of its worker at the same time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """A text column; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only, so that no other letter changes."""
    return F.translate(text, UPPER, LOWER)


def whole_row(df: DataFrame) -> Column:
    """All columns of a table as one struct, whatever their names."""
    return F.struct(*[F.col("`" + name.replace("`", "``") + "`") for name in df.columns])


def scratch(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or where checkpoints go already.
    A local session without either gets its own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tallygate-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def kept(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder, so that a lost executor costs no more
    than its own tasks and nothing above is computed twice."""
    scratch(df.sparkSession)
    return df.checkpoint()


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """The place of a public tokenizer's vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column``, of texts or lists, holds about ``most`` bytes or values
    in each; a single longer one makes a batch of its own."""
    for batch in batches:
        length = pc.list_value_length if pa.types.is_list(batch[column].type) else pc.binary_length
        begin = held = 0
        for at, n in enumerate(pc.fill_null(length(batch[column]), 0).to_pylist()):
            if at > begin and held + n > most:
                yield batch.slice(begin, at - begin)
                begin, held = at, 0
            held += n
        if begin < batch.num_rows:
            yield batch.slice(begin)


def bounded_sample(rows: DataFrame, by: str, counts: dict, key: Column, most: int) -> DataFrame:
    """About ``most`` rows of each value of ``by`` that ``counts`` has, chosen by a hash of ``key``:
    the same rows at every partitioning, and all where there are fewer."""
    place = F.pmod(F.xxhash64(key), F.lit(1 << 30))
    shares = [(F.col(by) == v) & (place < int((1 << 30) * min(1.0, most / n))) for v, n in counts.items()]
    return rows.where(reduce(lambda a, b: a | b, shares, F.lit(False)))
