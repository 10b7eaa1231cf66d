from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallygate.llm import packing
from tallygate.llm.common import vocabulary
from tests.llm.shapes import documents, odd_rows


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(vocabulary())
    made.encode_special_tokens = True
    return made


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_words_apart_have_the_ids_of_the_whole_text(tokenizer):
    rng = random.Random(4)
    parts = ["Hello", "it's", "É", "ß", " ", "\n", "\t", "\x1c", "\x85", "\xa0", " ", "123", "!?", "<|endoftext|>", "é",
             "İ", "Σ", "中文", "\U0001f600", "'ll", "_", "don't", "\x00", "ǅ", "ª"]
    chunks = packing._Chunks(vocabulary())
    for _ in range(2000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 12)))
        got = np.frombuffer(packing.token_bytes(text, chunks), "<u4").tolist()
        assert got == ids_of(tokenizer, text), text


def test_plain_characters_are_split_like_any_other(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "_AT_ONCE", 30)
    rng = random.Random(6)
    chunks = packing._Chunks(vocabulary())
    plain = [chr(c) for c in [*range(9, 14), *range(0x20, 0x7F), *range(0xA1, 0x130), *range(0x131, 0x250)]]
    for _ in range(3000):
        text = "".join(rng.choices(plain[:100] + ["'s", " ", "'LL"] * 3 if rng.random() < 0.6 else plain, k=rng.randint(0, 80)))
        assert packing._PLAIN_TEXT.fullmatch(text)
        got = np.frombuffer(packing.token_bytes(text, chunks), "<u4").tolist()
        assert got == ids_of(tokenizer, text), text


def test_every_piece_is_packed_once_and_without_gaps(spark, tokenizer):
    rows = odd_rows()
    found = packing.pack_documents(documents(spark, rows, extra=True), vocabulary(), 256).collect()
    expected = []
    for doc, text in rows:
        ids = ids_of(tokenizer, text)
        for k in range(0, len(ids), 256):
            part = ids[k : k + 256]
            expected.append((doc or 0, k // 256, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((r[0] or 0, *r[1:5]) for r in found) == sorted(expected)
    held = defaultdict(list)
    for r in found:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 256
    total = sum(r["length"] for r in found)
    assert len(held) <= 1.2 * -(-total // 256)
    assert packing.pack_documents(documents(spark, []), vocabulary()).count() == 0


def test_pieces_carry_their_ids(spark, tokenizer):
    found = packing.pieces(documents(spark, [(1, "Hello there, you")]), vocabulary(), with_ids=True).first()
    assert found["ids"] == ids_of(tokenizer, "Hello there, you")


def test_best_fit_with_a_bounded_number_of_open_bins():
    rng = random.Random(9)
    for most in (1, 3, 50):
        bins, plain = packing.OpenBins(100, most), []  # plain: (free, bin) of the open bins
        made = 0
        for _ in range(500):
            n = rng.randint(1, 100)
            fits = sorted(f for f, _ in plain if f >= n)
            number, offset = bins.put(n)
            if fits:
                assert (fits[0], number) in plain and offset == 100 - fits[0]
                plain.remove((fits[0], number))
                left = fits[0] - n
            else:
                if len(plain) == most:
                    # the fullest closes; of equally full ones the operator says which
                    fullest = min(f for f, _ in plain)
                    still = {b for b_list in bins.of for b in b_list}
                    plain.remove(next(x for x in plain if x[0] == fullest and x[1] not in still))
                assert (number, offset) == (made, 0)
                made += 1
                left = 100 - n
            if left:
                plain.append((left, number))
            assert bins.open == len(plain) <= most
