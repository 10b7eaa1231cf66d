"""Packing documents into training sequences: bounded-space online best-fit.

Tasks tokenize whole documents and cut only those longer than a sequence. Packing then sees one
small row for each piece. Every packing task takes at most ``PIECES`` rows, in the order of a
hash, and holds ``OPEN_BINS`` open bins: a bit of one integer stands for each amount of free
space that some open bin has, so the best fit is its lowest bit from the piece's length up. When
no bin fits and all are open, the fullest closes first.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from struct import pack as pack_ids

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygate.llm.common import kept, slices, text_of

SEQUENCE = 2048
END_ID = 0
OPEN_BINS = 4096
#: Pieces that one task packs.
PIECES = 250_000
#: Words and chunks whose ids a task remembers.
REMEMBERED = 200_000

#: The pre-tokenizer's pattern, a fixed value of the vocabulary file.
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Characters that normalization leaves alone but for lower case, white space left out.
_PLAIN = "\\x21-\\x7E\\xA1-\u012f\u0131-\u024f"
_PLAIN_CHUNK = re.compile(f"[{_PLAIN}]+")
_PLAIN_TEXT = re.compile(f"[\\t-\\r {_PLAIN}]*")
#: Characters of a text that are split at once.
_AT_ONCE = 1 << 20


def _plain_split() -> re.Pattern[str]:
    """The pre-tokenizer's pattern for plain characters alone, with their letters and numbers spelled
    out, which is twice as fast."""
    given = [chr(c) for c in range(0x250) if _PLAIN_CHUNK.fullmatch(chr(c))]
    every = sorted({*given, *"".join(given).lower()})
    letters, numbers = ("".join(c for c in every if unicodedata.category(c)[0] == kind) for kind in "LN")
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\s{letters}{numbers}]+")


_SPLIT_PLAIN = _plain_split()
_SPACE = re.compile("[\t-\r ]")


class _Encoder:
    """The tokenizer, made anew by each task, so that an idle worker holds none."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        self.letters = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.tokenizer.model

    def word(self, word: str) -> bytes:
        spelled = word.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.model.tokenize(spelled)]
        return pack_ids(f"<{len(ids)}I", *ids)

    def text(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return pack_ids(f"<{len(ids)}I", *ids)


class _Words(dict):
    """The ids, as little-endian 32-bit bytes, of words that the split pattern gives."""

    def __init__(self, encoder: _Encoder):
        self.encoder = encoder

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = self[word] = self.encoder.word(word)
        return ids


class _Chunks(dict):
    """The ids of chunks between ASCII white space, which no token and no normalization crosses."""

    def __init__(self, path: str):
        self.encoder = _Encoder(path)
        self.words = _Words(self.encoder)

    def __missing__(self, chunk: bytes) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        text = chunk.decode()
        if _PLAIN_CHUNK.fullmatch(text):
            ids = b"".join(map(self.words.__getitem__, _SPLIT.findall(text.lower())))
        else:
            ids = self.encoder.text(text)
        self[chunk] = ids
        return ids


def _cut(text: str) -> Iterator[str]:
    """The text in parts of about ``_AT_ONCE`` characters, cut at ASCII white space."""
    begin = 0
    while len(text) - begin > _AT_ONCE:
        space = _SPACE.search(text, begin + _AT_ONCE)
        end = space.start() if space else len(text)
        yield text[begin:end]
        begin = end
    yield text[begin:]


def token_bytes(text: str, chunks: _Chunks) -> bytes:
    """The ids of a whole text and the end id, as little-endian unsigned 32-bit integers.

    A plain text is split into words at once; others go by their chunks between white space.
    """
    found = []
    for part in _cut(text):
        if _PLAIN_TEXT.fullmatch(part):
            found.append(b"".join(map(chunks.words.__getitem__, _SPLIT_PLAIN.findall(part.lower()))))
        else:
            found.append(b"".join(map(chunks.__getitem__, part.encode().split())))
    return b"".join(found) + END_ID.to_bytes(4, "little")


def pieces(docs: DataFrame, path: str, most: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of each piece of at most ``most`` tokens, and its
    ids where asked for. A null or empty text is the end id alone."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = _Chunks(path)
        for batch in slices(batches, "text", 4 << 20):
            rows = []
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                ids = token_bytes(text, chunks)
                for k, at in enumerate(range(0, len(ids), 4 * most)):
                    part = ids[at : at + 4 * most]
                    row = (doc, k, at // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, np.frombuffer(part, "<u4")) if with_ids else row)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(cut, schema)


class OpenBins:
    """Bounded-space best-fit over bins of ``size``."""

    def __init__(self, size: int = SEQUENCE, most: int = OPEN_BINS):
        self.size, self.most = size, most
        self.bits = 0  # bit f: some open bin has f free
        self.of = [[] for _ in range(size + 1)]
        self.open = self.made = 0

    def _take(self, free: int) -> int:
        number = self.of[free].pop()
        if not self.of[free]:
            self.bits ^= 1 << free
        return number

    def put(self, length: int) -> tuple[int, int]:
        """The bin and the offset in it that a piece of this length gets."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.open == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
                self.open -= 1
            number, free = self.made, self.size
            self.made += 1
            self.open += 1
        left = free - length
        if left:
            if not self.of[left]:
                self.bits |= 1 << left
            self.of[left].append(number)
        else:
            self.open -= 1
        return number, self.size - free


def pack(rows: DataFrame, most: int = SEQUENCE, bins: int = OPEN_BINS, at_once: int = PIECES) -> DataFrame:
    """The rows of ``pieces`` with sequence_id and offset."""
    rows = kept(rows)
    tasks = rows.count() // at_once + 1

    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = TaskContext.get().partitionId() << 40
        open_bins = OpenBins(most, bins)
        for frame in frames:
            places = [open_bins.put(n) for n in frame["length"].tolist()]
            numbers, offsets = np.array(places, np.int64).reshape(-1, 2).T
            yield frame.drop(columns="place").assign(sequence_id=first + numbers, offset=offsets)

    placed = rows.withColumn("place", F.xxhash64("doc_id", "piece", "start", "ids_crc32"))
    dealt = placed.repartition(tasks).sortWithinPartitions("place", "doc_id", "piece", "length", "ids_crc32")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return dealt.mapInPandas(packed, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, most: int = SEQUENCE, bins: int = OPEN_BINS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece.

    Every row of ``docs`` is packed, repeated ones too; a null doc_id stays null. An empty table
    gives no rows. Other columns are not looked at. Sequences are gapless from offset 0.
    """
    return pack(pieces(docs, path, most), most, bins)
