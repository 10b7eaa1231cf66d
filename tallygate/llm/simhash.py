"""SimHash near-duplicates through a byte-position inverted index with count filtering.

Two 64-bit fingerprints within ``BITS`` = 3 differing bits differ in at most 3 of their 8 bytes,
so they share at least 5 (byte position, byte value) postings. Of any 5 of 8 positions, 3 lie in
the same half, so the pair meets in the posting list of one of 8 position triples (4 of each
half). Within a list the shared positional bytes of each pair are tallied, pairs with fewer than
5 are left out, and the rest are verified bit by bit.

Only distinct fingerprints enter the index; copies follow by their fingerprint. A list that is
longer than ``BLOCK`` is compared block against block in tasks of their own, so no list has to
fit into one task. Each task emits a spanning forest of the links it has verified, never all
pairs: groups come out whole and the output grows with the number of fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygate.llm.common import kept, slices, text_of, whole_row

BITS = 3
SHINGLE = 3
SEED = 42
BYTES = 8
TRIPLES = [t for half in (range(4), range(4, 8)) for t in combinations(half, 3)]
#: Fingerprints of a posting list that are compared in one piece.
BLOCK = 2048
#: Pieces of so few are compared many at a time.
SMALL = 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> bytes:
    """The eight bytes of a text's fingerprint, most significant first.

    A text of fewer words than a shingle is one shingle; a text without words has fingerprint 0.
    """
    split = text.lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not split:
        return bytes(BYTES)
    joined = b" ".join(split)
    if len(split) <= shingle:
        digests = xxhash.xxh64_digest(joined, SEED)
    else:
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        ends = np.cumsum(sizes + 1) - 1
        begins = (ends - sizes).tolist()
        digest = xxhash.xxh64_digest
        digests = b"".join([digest(joined[a:b], SEED) for a, b in zip(begins, ends[shingle - 1 :].tolist())])
    hashes = np.frombuffer(digests, np.uint8).reshape(-1, BYTES)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        ones += np.unpackbits(hashes[at : at + 4096], axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > len(hashes)).tobytes()


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, the fingerprint of every row as a signed 64-bit integer fp0, and ``copy``, a hash of the text
    that tells rows of one doc_id apart; null text counts as empty."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20):
            texts = batch["text"].cast(pa.binary()).to_pylist()
            fps = np.frombuffer(b"".join(fingerprint(t, shingle) for t in texts), ">i8").astype("<i8")
            columns = [batch["doc_id"], batch["copy"], pa.array(fps)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "copy", "fp0"])

    rows = docs.select(F.col("doc_id").cast("long"), _copy().alias("copy"), text_of().alias("text"))
    return rows.mapInArrow(hashed, "doc_id long, copy long, fp0 long")


def _copy() -> F.Column:
    return F.xxhash64(text_of())


def links(distinct: DataFrame, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between nodes: a spanning forest of each piece of each posting list, which joins
    exactly the nodes that verified pairs join.

    distinct: node and fp0, no fingerprint twice. bits: differing bits of a link, ``BITS`` at most, as the
    posting lists guarantee no more.
    """
    if not 0 <= bits <= BITS:
        raise ValueError(f"posting lists by {len(TRIPLES)} position triples find up to {BITS} differing bits, not {bits}")

    def post(number: int, triple: tuple[int, ...]) -> F.Column:
        key = F.lit(number).cast("long")
        for at in triple:
            key = key * 256 + F.shiftrightunsigned("fp0", 56 - 8 * at).bitwiseAND(F.lit(255))
        return key

    lists = F.explode(F.array(*[post(n, t) for n, t in enumerate(TRIPLES)]))
    postings = distinct.select("node", "fp0", lists.alias("list"))
    sizes = postings.groupBy("list").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int")
    pieces = (
        postings.join(sizes, "list")
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("list", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "node", "fp0")
    )

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ["list", "p", "q", "node", "fp0"]
        held = np.empty((0, len(columns)), np.int64)  # rows of the last piece, which may go on
        for batch in batches:
            rows = np.stack([batch[c].to_numpy().astype(np.int64) for c in columns], axis=1)
            if len(held) and len(rows) and (rows[-1, :3] == held[0, :3]).all():
                held = np.concatenate([held, rows])
                continue
            rows = np.concatenate([held, rows])
            last = np.flatnonzero((rows[:, :3] != rows[-1:, :3]).any(axis=1))
            whole = last[-1] + 1 if len(last) else 0
            held = rows[whole:]
            yield _linked(rows[:whole], bits)
        yield _linked(held, bits)

    dealt = pieces.repartition("list", "p", "q").sortWithinPartitions("list", "p", "q")
    return dealt.mapInArrow(linked, "a long, b long").distinct()


def _linked(rows: np.ndarray, bits: int) -> pa.RecordBatch:
    """Verified links within the pieces. rows: the piece's three numbers, node and fingerprint, pieces
    one after another. Pieces of up to ``SMALL`` nodes are compared all at once, row by row with those
    that follow; larger ones give a spanning forest."""
    new = np.concatenate([[True], (rows[1:, :3] != rows[:-1, :3]).any(axis=1)])[: len(rows)]
    begins = np.flatnonzero(new)
    sizes = np.diff(np.append(begins, len(rows)))
    piece = np.cumsum(new) - 1
    nodes, fps = rows[:, 3], np.ascontiguousarray(rows[:, 4:]).view(np.uint64)
    columns = fps.astype(">u8").view(np.uint8)
    found = [np.empty((0, 2), np.int64)]
    small = np.repeat(sizes <= SMALL, sizes)
    for step in range(1, min(SMALL, sizes.max(initial=0))):
        at = np.flatnonzero(small[:-step] & (piece[:-step] == piece[step:]))
        shared = (columns[at] == columns[at + step]).sum(axis=1)  # the tally of shared positional bytes
        at = at[shared >= BYTES - bits]
        at = at[np.bitwise_count(fps[at] ^ fps[at + step]).sum(axis=1) <= bits]
        found.append(np.stack([nodes[at], nodes[at + step]], axis=1))
    for k in np.flatnonzero(sizes > SMALL):
        part = slice(begins[k], begins[k] + sizes[k])
        found.append(_forest(nodes[part], fps[part], columns[part], bits))
    pairs = np.sort(np.concatenate(found), axis=1)
    a, b = np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _forest(nodes: np.ndarray, fps: np.ndarray, columns: np.ndarray, bits: int) -> np.ndarray:
    """Each node of one piece with the first that it reaches there."""
    top = np.arange(len(nodes))
    for at in range(len(nodes) - 1):
        shared = (columns[at:] == columns[at]).sum(axis=1)
        near = np.flatnonzero(shared >= BYTES - bits) + at
        near = near[np.bitwise_count(fps[near] ^ fps[at]).sum(axis=1) <= bits]
        met = np.unique(top[near])
        if len(met) > 1:
            top[np.isin(top, met)] = met[0]
    members = np.flatnonzero(top != np.arange(len(nodes)))
    return np.stack([nodes[top[members]], nodes[members]], axis=1)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of an edge reaches.

    Alternating large-star and small-star rounds; each round is two aggregations and joins on the
    node, without a window, so a node of many edges is combined before it is dealt out.
    """

    def star(pairs: DataFrame, larger: bool) -> DataFrame:
        both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        seen = both if larger else both.where("b < a")
        least = seen.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        hung = seen.join(least, "a")
        if larger:
            return hung.where("b > a").select(F.col("m").alias("a"), "b").distinct()
        own = least.select(F.col("m").alias("a"), F.col("a").alias("b"))
        return hung.where("b <> m").select(F.col("m").alias("a"), "b").union(own).distinct()

    def mark(pairs: DataFrame) -> tuple:
        row = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    pairs = kept(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b"))
    before = mark(pairs)
    while before[0]:
        pairs = kept(star(star(pairs, True), False))
        after = mark(pairs)
        if after == before:
            break
        before = after
    return pairs.select(F.col("b").alias("node"), F.col("a").alias("root"))


def _grouped(docs: DataFrame, shingle: int, bits: int, block: int) -> DataFrame:
    """The rows of ``fingerprints`` with root, the fingerprint that stands for their group."""
    prints = kept(fingerprints(docs, shingle))
    distinct = prints.select(F.col("fp0").alias("node"), "fp0").distinct()
    groups = components(links(distinct, bits, block)).withColumnRenamed("node", "fp0")
    return prints.join(groups, "fp0", "left").withColumn("root", F.coalesce("root", "fp0"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """doc_id, fp0 and component_id of every row.

    component_id is the smallest doc_id that links reach, the row's own included. Nulls: a null
    text is empty, and texts without words share fingerprint 0; a row without doc_id gets a component
    like any other, null only if no member has an id. Repeated rows each get their row. Other columns
    are not looked at; an empty table gives an empty result.
    """
    rooted = _grouped(docs, shingle, bits, block)
    tops = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(tops, "root").select("doc_id", "fp0", "component_id")


def first_of_each(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that stand for their group: one of each, with all its columns.

    That is the row with the group's smallest doc_id; rows without one come after all others, and of
    different texts with the same doc_id that with the smaller hash stays. Rows that repeat doc_id and
    text stay once, whatever other columns say. A null text is empty, and all texts without words are
    one group. An empty table gives none; columns may have any names.
    """
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "copy").alias("place")
    first = _grouped(docs, shingle, bits, block).groupBy("root").agg(F.min(place).alias("first"))
    stay = first.select(F.coalesce("first.doc_id", F.lit(0)).alias("id"), F.col("first.doc_id").isNull().alias("unnamed"), "first.copy")
    key = ["id", "unnamed", "copy"]
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(
        whole_row(docs).alias("row"),
        F.coalesce(doc_id, F.lit(0)).alias("id"), doc_id.isNull().alias("unnamed"), _copy().alias("copy"),
    )
    return rows.join(stay, key, "left_semi").dropDuplicates(key).select("row.*")
