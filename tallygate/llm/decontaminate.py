"""Benchmark decontamination on a document-partitioned positional inverted index.

``build_index`` stores, for every training document, the positional postings of the terms that
the test items use: an index shard is any set of documents, and no posting crosses the network.
``search`` joins the shards of a batch into posting lists, takes each test window's rarest term
there, and intersects the offset-adjusted lists of its other terms from the next rarest on.
An exact phrase leaves each list at its own offset; a proximity match may leave each list up to
``slop`` words away from it.

The test items are a stated query set. They are handed to the tasks in blocks of at most
``BLOCK_BYTES`` of text, one block after another; every block is searched in all documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallygate.llm.common import kept, slices, whole_row

WINDOW = 10
#: Test text handed to the tasks at once.
BLOCK_BYTES = 16 << 20
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")  # all of UTF-8 beyond ASCII counts as letters

#: Parts of a search's result beside n_words and n_hit.
_LISTS = {"starts": pa.int32(), "ends": pa.int32(), "items": pa.int64(), "near_items": pa.int64()}
_FOUND = ["n_words", "n_hit", *_LISTS]
_RESULT = "n_words long, n_hit long, starts array<int>, ends array<int>, items array<long>, near_items array<long>"


def words_of(text: bytes) -> list[bytes]:
    return _WORDS.findall(text.lower())


class Windows:
    """The windows of a block of test items: ``WINDOW`` consecutive words, or a shorter item whole."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int = WINDOW):
        split = [(item, words_of((text or "").encode())) for item, text in items]
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for _, ws in split for w in ws}))}
        rows, lengths, owners = [], [], []
        self.items = [item for item, _ in split]
        for owner, (_, ws) in enumerate(split):
            ids = [self.vocabulary[w] for w in ws]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                row = ids[at : at + window]
                rows.append(row + [-1] * (window - len(row)))
                lengths.append(len(row))
                owners.append(owner)
        self.terms = np.array(rows, np.int64).reshape(len(rows), window)
        self.lengths = np.array(lengths, np.int64)
        self.owners = np.array(owners, np.int64)


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        return -1


def build_index(docs: DataFrame, windows: Windows) -> DataFrame:
    """The rows of ``docs`` with n_words and the positional postings (terms, positions), by term
    then position, of the windows' terms in every whole text. It can be written and searched again."""
    vocabulary = windows.vocabulary

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Ids(vocabulary)
        for batch in slices(batches, "text", 2 << 20):
            counts, terms, positions = [], [], []
            for text in batch["text"].cast(pa.binary()).to_pylist():
                words = words_of(text or b"")
                ids = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
                at = np.flatnonzero(ids >= 0).astype(np.int32)
                order = np.argsort(ids[at], kind="stable")
                counts.append(len(words))
                terms.append(ids[at][order])
                positions.append(at[order])
            ends = np.cumsum([0, *map(len, terms)]).astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(ends, np.concatenate([np.empty(0, np.int32), *part]))
                for part in (terms, positions)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(counts, pa.int64()), *lists],
                [*batch.schema.names, "n_words", "terms", "positions"],
            )

    schema = StructType.fromDDL("n_words long, terms array<int>, positions array<int>")
    return docs.mapInArrow(indexed, StructType([*docs.schema, *schema]))


def _meet(windows: Windows, keys: np.ndarray, span: int, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, start) of every place that the lists of all its terms reach within ``slop``.

    keys: the sorted term * span + position of every posting of the shard.
    """
    width = windows.terms.shape[1]
    used = windows.terms >= 0
    begins = np.searchsorted(keys, np.where(used, windows.terms, 0) * span)
    sizes = np.searchsorted(keys, (np.where(used, windows.terms, 0) + 1) * span) - begins
    sizes = np.where(used, sizes, np.iinfo(np.int64).max)
    live = np.flatnonzero(sizes.min(axis=1, initial=np.iinfo(np.int64).max) > 0)
    order = np.argsort(sizes[live], axis=1, kind="stable")  # from the rarest term on
    rarest = order[:, 0]
    n = sizes[live, rarest]
    row = np.repeat(np.arange(len(live)), n)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = keys[begins[live, rarest][row] + within] % span - rarest[row]
    for k in range(1, width):
        offset = order[row, k]
        term = windows.terms[live[row], offset]
        want = term * span + start + offset
        at = np.minimum(np.searchsorted(keys, want - slop), len(keys) - 1)
        keep = (term < 0) | ((keys[at] >= want - slop) & (keys[at] <= want + slop))
        row, start = row[keep], start[keep]
    return live[row], start


def search(index: DataFrame, windows: Windows, slop: int = 0) -> DataFrame:
    """Per indexed row: n_hit (words inside exact occurrences), starts and ends of the maximal runs
    of such words, items with exact occurrences, and near_items, with all terms of a window
    within ``slop`` words of their places (the same as items at 0). Results that the row
    already has, of other windows, are joined with them."""
    own = [c for c in index.columns if c not in ("n_words", "terms", "positions", "n_hit", *_LISTS)]

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gap = windows.terms.shape[1] + 2 * slop + 1  # so that no match reaches two documents
        for batch in slices(batches, "positions", 1 << 20):
            n = batch["n_words"].to_numpy().astype(np.int64)
            held = pc.list_value_length(batch["terms"]).to_numpy()
            base = np.cumsum(n + gap) - n
            span = int(base[-1] + n[-1]) + gap
            place = batch["positions"].flatten().to_numpy() + np.repeat(base, held)
            keys = np.sort(batch["terms"].flatten().to_numpy().astype(np.int64) * span + place)
            prior = {c: batch[c].to_pylist() for c in _LISTS if c in batch.schema.names}
            items = prior.get("items", [[] for _ in n])
            near_items = prior.get("near_items", [[] for _ in n])
            edge = np.zeros(span + 1, np.int64)
            for doc, (starts, ends) in enumerate(zip(prior.get("starts", []), prior.get("ends", []))):
                np.add.at(edge, base[doc] + np.array(starts, np.int64), 1)
                np.add.at(edge, base[doc] + np.array(ends, np.int64), -1)
            if len(keys) and len(windows.terms):
                window, start = exact = _meet(windows, keys, span, 0)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + windows.lengths[window], -1)
                near = _meet(windows, keys, span, slop) if slop else exact
                for named, (w, s) in ((items, exact), (near_items, near)):
                    doc = np.searchsorted(base, s + (slop if named is near_items else 0), "right") - 1
                    for d, owner in np.unique(np.stack([doc, windows.owners[w]], axis=1), axis=0).tolist():
                        if windows.items[owner] is not None and windows.items[owner] not in named[d]:
                            named[d].append(windows.items[owner])
            runs = np.flatnonzero(np.diff(np.cumsum(edge) > 0, prepend=False)).reshape(-1, 2)
            doc = np.searchsorted(base, runs[:, 0], "right") - 1
            hits = np.bincount(doc, runs[:, 1] - runs[:, 0], len(n)).astype(np.int64)
            ends = np.cumsum(np.bincount(doc, minlength=len(n)), dtype=np.int32)
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            inside = (runs - base[doc][:, None]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in own]
                + [pa.array(n), pa.array(hits)]
                + [pa.ListArray.from_arrays(offsets, np.ascontiguousarray(inside[:, k])) for k in (0, 1)]
                + [pa.array(x, pa.list_(pa.int64())) for x in (items, near_items)],
                [*own, "n_words", "n_hit", *_LISTS],
            )

    schema = [f for f in index.schema if f.name in own]
    return index.mapInArrow(searched, StructType([*schema, *StructType.fromDDL(_RESULT)]))


def query_blocks(benchmark: DataFrame, window: int = WINDOW, most: int = BLOCK_BYTES) -> Iterator[Windows]:
    """The test items in blocks of windows, each of about ``most`` bytes of text, one after another: the
    driver holds one block at a time."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // most + 1
    dealt = benchmark.select(
        F.col("item_id").cast("long"), "text", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).alias("block")
    )
    for k in range(blocks):
        yield Windows([(r[0], r[1]) for r in dealt.where(F.col("block") == k).collect()], window)


def _judged(docs: DataFrame, benchmark: DataFrame, window: int, slop: int, row: Column) -> DataFrame:
    """``row`` beside the results of all blocks. With more than one, the results so far are written before
    the next block is looked at, so that no plan and no task holds two."""
    found, plain = docs.select(row.alias("row"), docs["text"].alias("text")), True
    for block in query_blocks(benchmark, window):
        found = found if plain else kept(found)
        found, plain = search(build_index(found.drop("n_words", "n_hit"), block), block, slop), False
    return found


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, starts and ends of hit runs in words, items and
    near_items (see ``search``).

    Nulls: a null text has no words; a null doc_id stays null; an item without id counts its hits
    but is not named. Repeated rows get a row each, repeated items are named once. An empty table
    of documents gives no rows, an empty benchmark no hits. Other columns are not looked at.
    """
    return _judged(docs, benchmark, window, slop, F.struct(docs["doc_id"])).select("row.doc_id", *_FOUND)


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any occurrence of a window, with all their columns, whatever their names.

    Null and empty texts stay, repeated rows are judged alike, an empty benchmark takes none, and an empty
    table stays empty.
    """
    return _judged(docs, benchmark, window, 0, whole_row(docs)).where("n_hit = 0").select("row.*")
