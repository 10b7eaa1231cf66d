"""SentencePiece encoding and decoding through a distinct-chunk table.

The library marks white space by U+2581 and puts one mark before a text. Where no piece has a mark
behind another character, no piece can cross from a word into the mark of the next, so the marked
words of a text, each a run of marks and what follows it, are segmented independently. A task
keeps a table of the distinct marked words that it has met: their ids one after another, and their
decoded text. Each is segmented and decoded once; a text is then a sequence of table places, and
its ids are taken from the table by these positions.

The table belongs to its task and holds at most ``REMEMBERED`` words, then it starts anew; nothing
is shuffled. A vocabulary in which pieces do cross marks has each text segmented as one word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygate.llm.common import slices, text_of

#: The mark of white space.
MARK = "▁"
#: Distinct marked words that a task remembers, and the bytes of their text, at most.
REMEMBERED = 400_000
REMEMBERED_BYTES = 32 << 20


def crosses_marks(pieces: list[str]) -> bool:
    """Whether some piece has a mark behind another character."""
    return any(MARK in piece.lstrip(MARK) for piece in pieces)


class ChunkTable:
    """Distinct marked words with their ids and decoded text, each segmented once."""

    def __init__(self, path: str, most: int = REMEMBERED, most_bytes: int = REMEMBERED_BYTES):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        whole = crosses_marks(pieces)
        self.words = re.compile("(?s:.+)" if whole else f"{MARK}+[^{MARK}]*")
        self.most, self.most_bytes = most, most_bytes
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.held = 0
        self.ids = np.empty(0, np.int32)
        self.ends = np.zeros(1, np.int64)
        self.decoded: list[str] = []

    def split(self, text: str) -> list[str]:
        """The marked words of a text, the library's leading mark included; none of an empty one."""
        return self.words.findall(MARK + text.replace(" ", MARK)) if text else []

    def add(self, words: set[str]) -> None:
        """Segments words that the table does not have."""
        new = [w for w in words if w not in self.place]
        if not new:
            return
        # the library puts the leading mark back, but gives nothing at all for an empty text
        found = self.model.encode([w[1:] for w in new], num_threads=1)
        alone = [self.model.piece_to_id(MARK)]
        found = [ids if len(w) > 1 else alone for w, ids in zip(new, found)]
        # decoding a text leaves its first mark out
        self.decoded += [" " + text for text in self.model.decode(found, num_threads=1)]
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        self.held += sum(map(len, new))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((i for ids in found for i in ids), np.int32, int(sizes.sum()))
        self.ids = np.concatenate([self.ids, flat])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """The ids of all texts one after another, the end of each text in them, and the decoded texts."""
        if len(self.place) > self.most or self.held > self.most_bytes:
            self.clear()
        split = [self.split(text) for text in texts]
        self.add(set().union(*split))
        place, decoded = self.place.__getitem__, self.decoded.__getitem__
        places = [np.fromiter(map(place, words), np.int64, len(words)) for words in split]
        at = np.concatenate([np.empty(0, np.int64), *places])
        begins, sizes = self.ends[at], self.ends[at + 1] - self.ends[at]
        ends = np.cumsum(sizes)
        taken = self.ids[np.repeat(begins - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]
        upto = np.concatenate([[0], ends])[np.cumsum([0, *map(len, split)])]
        return taken, upto, ["".join(map(decoded, p.tolist()))[1:] for p in places]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of int) and decoded of every row.

    ids are the library's for the whole text, without begin or end ids; decoded is what its decode
    gives for them. Nulls: a null text is empty, and an empty text has no ids and decodes to an empty
    one; a null doc_id stays null. Repeated rows each get their row, an empty table gives none, and other
    columns are not looked at. A very long text is encoded whole, in a batch of its own.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(path)
        for batch in slices(batches, "text", 2 << 20):
            ids, ends, texts = table.encode(batch["text"].to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            columns = [batch["doc_id"], lists, pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    return rows.mapInArrow(cut, "doc_id long, ids array<int>, decoded string")
