"""Repeated byte strings across documents by longest-previous-factor arrays.

A byte is repeated if a string of ``least`` bytes around it also starts elsewhere. No task could
hold the suffix array of all documents, so the suffixes that can share ``least`` bytes are
brought together first:

1. Of the grams of ``least / 4`` bytes inside a string of ``least`` bytes, the one with the smallest
   hash is its anchor: equal strings have equal anchors at equal places. Each text gives one row for
   each run of string starts with the same anchor; a run's context is all that its strings cover.
2. Contexts are counted before anything else moves. Those that occur again are repeated as a whole,
   however many copies there are; anchors that occur once are done.
3. Only where one anchor has different contexts, at the edges of what is copied, are suffixes
   compared: one context of each kind, with its bytes. A task sorts the suffixes of the run starts
   by prefix doubling, takes the previous and next smaller positions in suffix order, and with them
   the longest previous factor of each (by the larger positions, the longest next factor). A factor
   of ``least`` bytes means an earlier (later) copy.
4. An anchor with more contexts than ``TOGETHER_BYTES`` hold isn't compared in one task: its strings
   are counted by a 128-bit digest instead, which deals them out evenly.

``keep="first"`` removes what has an earlier copy, in the order of doc_id and place; ``keep="none"``
removes every copy.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tallygate.llm.common import kept, slices, text_of, whole_row

LEAST = 400
#: Bytes of an anchor's contexts that one task compares; a context has less than 2 * least.
TOGETHER_BYTES = 4 << 20
#: Bytes whose suffixes a task sorts at once; whole anchors, so at least those of one.
BUFFER = 256 << 10
#: String starts of a text that are looked at in one piece.
_PIECE = 1 << 17
_U = np.uint64
_ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # bases of the two rolling hashes


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**k and its inverse modulo 2**64."""
    both = []
    for b in (base, pow(base, -1, 1 << 64)):
        steps = np.full(n, b, _U)
        steps[0] = 1
        both.append(np.multiply.accumulate(steps))
    return both[0], both[1]


@lru_cache(maxsize=1)
def _symbols() -> np.ndarray:
    return np.random.default_rng(42).integers(1, 1 << 63, 256, dtype=_U)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(29))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(32))


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` values in a row."""
    n = len(values) - width + 1
    full = -(-len(values) // width) * width
    blocks = np.concatenate([values, np.full(full - len(values), np.iinfo(_U).max, _U)]).reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def runs(text: bytes, least: int) -> list[np.ndarray]:
    """anchor, context, first and last string start of each run of a text."""
    gram = max(1, least // 4)
    width = least - gram + 1
    found = []
    for piece in range(0, max(0, len(text) - least + 1), _PIECE):
        data = np.frombuffer(text[piece : piece + _PIECE + least - 1], np.uint8)
        starts = len(data) - least + 1
        sums = []
        for base in _ODD:
            powers, inverse = _powers(base, _PIECE + least)
            terms = _symbols()[data] * powers[: len(data)]
            sums.append((np.concatenate([np.zeros(1, _U), np.cumsum(terms, dtype=_U)]), inverse))
        total, inverse = sums[0]
        hashes = _mixed((total[gram:] - total[:-gram]) * inverse[: len(data) - gram + 1])
        place = np.arange(len(hashes), dtype=_U)
        low = _U((1 << 18) - 1)
        best = _least_of((hashes & ~low) | (low - place), width)  # the last of equal ones
        anchor = (low - (best & low)).astype(np.int64)
        cut = np.flatnonzero(anchor[1:] != anchor[:-1])
        first, last = np.concatenate([[0], cut + 1]), np.concatenate([cut, [starts - 1]])
        at = anchor[first]
        total, inverse = sums[1]
        context = (total[last + least] - total[first]) * inverse[first]
        context = _mixed(context + _U(_ODD[0]) * (at - first).astype(_U) + _U(_ODD[1]) * (last - first).astype(_U))
        found.append((hashes[at].view(np.int64), context.view(np.int64), first + piece, last + piece))
    return [np.concatenate(c) for c in zip(*found)] if found else [np.empty(0, np.int64)] * 4


def suffix_ranks(data: np.ndarray, least: int) -> list[tuple[int, np.ndarray]]:
    """(length, rank of the suffix at each position by its first ``length`` bytes), length by
    doubling up to ``least``. Bytes after the end count as zero."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(_U)
    value = np.zeros(len(data), _U)
    for k in range(8):
        value = (value << _U(8)) | padded[k : k + len(data)]
    ranks = [(8, np.unique(value, return_inverse=True)[1].astype(np.int32))]
    while 2 * ranks[-1][0] <= least:
        length, rank = ranks[-1]
        both = rank.astype(np.int64) * len(rank)
        both[: max(0, len(rank) - length)] += rank[length:]
        ranks.append((2 * length, np.unique(both, return_inverse=True)[1].astype(np.int32)))
    return ranks


def suffix_order(data: np.ndarray, starts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The starts in the order of the ``least`` bytes from each, equal ones by place, and how many
    bytes each shares with the one before it, ``least`` at most. No string goes past the data."""
    ranks = suffix_ranks(data, least)
    length, rank = ranks[-1]
    order = starts[np.lexsort((starts, rank[starts + least - length], rank[starts]))]
    left, right = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(len(left), np.int64)
    same = (rank[left] == rank[right]) & (rank[left + least - length] == rank[right + least - length])
    going = ~same
    for length, rank in reversed(ranks):
        ok = going & (shared + length <= least)
        at = np.flatnonzero(ok)
        equal = at[rank[left[at]] == rank[right[at]]]
        left[equal] += length
        right[equal] += length
        shared[equal] += length
    shared[same] = least
    return order, np.concatenate([[0], shared])  # below least: to within 8 bytes


def previous_factors(order: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """For each suffix in suffix order: how many bytes it shares with an earlier one at most, that is
    with the nearest smaller position before it or after it in the order."""
    longest = np.zeros(len(order), np.int64)
    for step in (1, -1):
        place, between = order[::step], (shared if step == 1 else np.concatenate([shared[1:], [0]])[::-1])
        to, common = np.arange(len(place)) - 1, between.copy()
        going = np.flatnonzero((to >= 0) & (place[to] > place))
        while len(going):  # all between an entry and where it points stand at larger places
            over = to[going]
            common[going] = np.minimum(common[going], common[over])
            to[going] = to[over]
            going = going[(to[going] >= 0) & (place[to[going]] > place[going])]
        common[to < 0] = 0
        longest = np.maximum(longest, common[::step])
    return longest


def repeated_starts(data: np.ndarray, starts: np.ndarray, least: int, keep: str) -> np.ndarray:
    """The starts, in order, whose ``least`` bytes have an earlier copy, or also a later one."""
    order, shared = suffix_order(data, starts, least)
    hit = previous_factors(order, shared) >= least
    if keep == "none":
        hit |= previous_factors(order.max(initial=0) - order, shared) >= least
    return np.sort(order[hit])


def _key_columns() -> list[Column]:
    """A key that repeated rows share and no others: doc (doc_id, a number for null) and id."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.expr("cast(-9223372036854775808 as bigint)"))
    return [doc.alias("doc"), F.xxhash64("doc_id", text_of()).alias("id")]


def _identified(docs: DataFrame) -> DataFrame:
    return docs.select(*_key_columns(), text_of().alias("text"))


_KEY = ["doc", "id"]


def repeated_spans(docs: DataFrame, least: int = LEAST, keep: str = "none", together: int | None = None) -> DataFrame:
    """doc, id, begin and end of byte spans to remove; they may overlap. together: contexts of an anchor
    that one task compares; by default as many as ``TOGETHER_BYTES`` hold."""
    together = max(1, TOGETHER_BYTES // (2 * least)) if together is None else together
    keyed = _identified(docs)
    names = [*_KEY, "anchor", "context", "first", "last"]

    def anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            found = [runs(t, least) for t in batch["text"].cast(pa.binary()).to_pylist()]
            owner = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
            columns = [batch[c].take(owner) for c in _KEY]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(np.concatenate(c)) for c in zip(*found)], names)

    rows = keyed.mapInArrow(anchored, ", ".join(f"{n} long" for n in names))
    counts = rows.groupBy("anchor", "context").count()
    of_anchor = Window.partitionBy("anchor")
    again = counts.withColumns({"seen": F.sum("count").over(of_anchor), "contexts": F.count("*").over(of_anchor)})
    again = again.where("seen > 1")
    members = kept(rows.join(again, ["anchor", "context"]))
    several = members.where("count > 1")
    place = F.struct(*_KEY, "first", "last")
    leads = several.groupBy("anchor", "context", "contexts").agg(F.min(place).alias("lead"))
    whole = several
    if keep == "first":
        led = several.join(leads.select("anchor", "context", "lead"), ["anchor", "context"])
        whole = led.where(F.struct(*_KEY, "first") != F.struct("lead.doc", "lead.id", "lead.first"))
    columns = ["anchor", "contexts", *_KEY, "first", "last"]
    one_each = members.where("count = 1").select(columns).union(
        leads.select("anchor", "contexts", *[f"lead.{c}" for c in columns[2:]])
    )
    found = kept(_compared(one_each.where("contexts > 1"), keyed, least, keep, together))
    counted = found.where("digest is not null").distinct()
    copies = counted.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct(*_KEY, "begin")).alias("lead"))
    met = counted.join(copies.where("n > 1"), "digest")
    if keep == "first":
        met = met.where(F.struct(*_KEY, "begin") != F.col("lead"))
    span = [*_KEY, "begin", "end"]
    return (
        whole.select(*_KEY, F.col("first").alias("begin"), (F.col("last") + least).alias("end"))
        .union(found.where("digest is null").select(span))
        .union(met.select(span))
    )


def _compared(edges: DataFrame, keyed: DataFrame, least: int, keep: str, together: int) -> DataFrame:
    """doc, id, begin, end, digest: spans with a copy among the contexts of their anchor, or, where an
    anchor has over ``together`` contexts, each string of theirs with its digest."""
    own = edges.groupBy(*_KEY).agg(F.collect_list(F.struct("anchor", "contexts", "first", "last")).alias("edges"))
    part_names = ["anchor", "contexts", *_KEY, "first", "covered"]

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            columns = [[] for _ in part_names]
            for doc, id_, text, listed in zip(*(batch[c].to_pylist() for c in (*_KEY, "text", "edges"))):
                data = text.encode()
                for e in listed:
                    row = (e["anchor"], e["contexts"], doc, id_, e["first"], data[e["first"] : e["last"] + least])
                    for column, value in zip(columns, row):
                        column.append(value)
            kinds = [*[pa.int64()] * 5, pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], part_names)

    kinds = ", ".join(f"{n} long" for n in part_names[:-1])
    # an edge's texts are those of its document: no more bytes than the document's edges cover
    data = keyed.join(own, _KEY).mapInArrow(parts, f"{kinds}, covered binary")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, now, before = [], 0, None, None
        for batch in batches:
            out = []
            for anchor, contexts, *key, covered in zip(*(c.to_pylist() for c in batch.columns)):
                if (anchor, *key) == before:
                    continue  # a repeated row
                before = (anchor, *key)
                if contexts > together:
                    doc, id_, first = key
                    for k in range(len(covered) - least + 1):
                        digest = hashlib.blake2b(covered[k : k + least], digest_size=16).digest()
                        out.append((doc, id_, first + k, first + k + least, digest))
                    continue
                if anchor != now and size >= BUFFER:
                    out += _spans(held, least, keep)
                    held, size = [], 0
                now = anchor
                held.append((*key, covered))
                size += len(covered)
                if len(out) > 100_000:
                    yield _span_batch(out)
                    out = []
            yield _span_batch(out)
        if held:
            yield _span_batch(_spans(held, least, keep))

    salt = F.when(F.col("contexts") > together, F.xxhash64(*_KEY, "first"))  # these needn't meet
    dealt = data.repartition("anchor", salt).sortWithinPartitions("anchor", *_KEY, "first")
    return dealt.mapInArrow(compared, "doc long, id long, begin long, end long, digest binary")


def _span_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds, names = [*[pa.int64()] * 4, pa.binary()], [*_KEY, "begin", "end", "digest"]
    columns = list(zip(*rows)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _spans(held: list[tuple], least: int, keep: str) -> list[tuple]:
    """The spans of contexts, (doc, id, first, bytes) in order of place, that have copies there."""
    sizes = np.array([len(x[3]) for x in held], np.int64)
    at = np.cumsum(sizes) - sizes
    n = sizes - least + 1
    starts = np.arange(n.sum()) + np.repeat(at - (np.cumsum(n) - n), n)
    hits = repeated_starts(np.frombuffer(b"".join(x[3] for x in held), np.uint8), starts, least, keep)
    owner = np.searchsorted(at, hits, "right") - 1
    cut = np.flatnonzero((np.diff(hits) > 1) | (np.diff(owner) > 0)) + 1
    found = []
    for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(hits)]):
        if b > a:
            doc, id_, first, _ = held[owner[a]]
            begin = first - int(at[owner[a]])
            found.append((doc, id_, begin + int(hits[a]), begin + int(hits[b - 1]) + least, None))
    return found


def without_repeats(
    docs: DataFrame, least: int = LEAST, keep: str = "none", characters: bool = False, words: int = 0
) -> DataFrame:
    """``row``, a struct of the columns of ``docs``, with begins and ends of the maximal byte spans that
    go from its text, and the bytes kept. With ``characters``, spans are cut back to whole ones; only spans
    that hold ``words`` whole words go.

    Nulls: a null text is empty, a null doc_id is an id like any other. Rows with the same doc_id and
    text are copies of each other under ``none``; under ``first`` they count as one document and each
    keep what it keeps. An empty table gives no rows.
    """
    spans = repeated_spans(docs.select("doc_id", "text"), least, keep)
    own = spans.groupBy(*_KEY).agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    row = whole_row(docs).alias("row")
    keyed = docs.select(row, *_key_columns())
    names = ["row", "begins", "ends", "kept"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a row's text comes within the row alone, so that the join and the worker get it once
        texts_of = (b.append_column("text", pc.fill_null(b["row"].field("text"), "")) for b in batches)
        for batch in slices(texts_of, "text", 2 << 20):
            texts = batch["text"].cast(pa.binary()).to_pylist()
            merged = [_merged(x) for x in batch["spans"].to_pylist()]
            if characters:
                merged = [_whole(t, x) for t, x in zip(texts, merged)]
            if words:
                merged = [[x for x in own if whole_words(t, *x) >= words] for t, own in zip(texts, merged)]
            rest = []
            for text, spans in zip(texts, merged):
                edges = [0, *(x for span in spans for x in span), len(text)]
                rest.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            columns = [pa.array([[s[k] for s in x] for x in merged], pa.list_(pa.int64())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch["row"], *columns, pa.array(rest, pa.binary())], names)

    joined = keyed.join(own, _KEY, "left").select("row", "spans")
    kind = joined.schema["row"].dataType
    lists = StructType.fromDDL("begins array<long>, ends array<long>, kept binary")
    return joined.mapInArrow(cut, StructType([StructField("row", kind), *lists]))


def _merged(spans: list[dict] | None) -> list[list[int]]:
    found: list[list[int]] = []
    for begin, end in sorted((s["begin"], s["end"]) for s in spans or []):
        if found and begin <= found[-1][1]:
            found[-1][1] = max(found[-1][1], end)
        else:
            found.append([begin, end])
    return found


def whole_words(text: bytes, begin: int, end: int) -> int:
    """Words between ASCII white space that stand in a span as a whole."""
    found = len(text[begin:end].split())
    for inside, outside in ((begin, begin - 1), (end - 1, end)):
        if 0 <= outside < len(text) and not text[inside : inside + 1].isspace() and not text[outside : outside + 1].isspace():
            found -= 1  # cut by the span's edge
    return max(0, found)


def _whole(text: bytes, spans: list[list[int]]) -> list[list[int]]:
    found = []
    for begin, end in spans:
        while begin < end and text[begin] & 0xC0 == 0x80:
            begin += 1
        while begin < end < len(text) and text[end] & 0xC0 == 0x80:
            end -= 1
        if begin < end:
            found.append([begin, end])
    return found


def deduplicated(docs: DataFrame, least: int = LEAST, words: int = 0) -> DataFrame:
    """The rows of ``docs`` with later copies of repeated strings cut from their texts, where these hold
    ``words`` whole words.

    A row whose text is all copy goes; one with a null or empty text stays as it is, and so does every
    column but text. Repeated rows, of one doc_id and text, count as one document and each stay. An empty
    table gives no rows; columns may have any names.
    """
    cut = without_repeats(docs, least, "first", characters=True, words=words)
    touched = F.size("begins") > 0
    text = F.when(touched, F.decode("kept", "UTF-8")).otherwise(F.col("row.text"))
    left = cut.where(~touched | (F.octet_length("kept") > 0))
    return left.select(F.col("row").withField("text", text).alias("row")).select("row.*")
