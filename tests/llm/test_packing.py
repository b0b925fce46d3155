"""Packing against the tokenizer and its own promises."""

from __future__ import annotations

import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerlake.llm import packing
from ledgerlake.llm.common import hand_back
from ledgerlake.llm.queries import QUERIES, TOKENIZERS
from tests.llm.common import ODD, SF, no_docs, odd_docs

PATH = TOKENIZERS("word_bpe_49k.json")


def tokenizer() -> Tokenizer:
    loaded = Tokenizer.from_file(PATH)
    loaded.encode_special_tokens = True
    return loaded


def check(pieces: list, ids_of: list[tuple[int | None, list[int]]]) -> None:
    """Every id in one piece, sequences gapless and of at most LENGTH tokens, little padding."""
    expected = sorted(((-1 if d is None else d), len(ids) + 1) for d, ids in ids_of)
    by_doc: dict = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
    assert sorted(((-1 if d is None else d), p.doc_tokens) for d, ps in by_doc.items() for p in ps if p.start == 0) == expected
    known = {d: np.array([*ids, packing.END], "<u4") for d, ids in ids_of}
    for d, ps in by_doc.items():
        copies = sum(1 for other, _ in ids_of if other == d)
        assert sum(p.length for p in ps) == copies * len(known[d])
        for p in ps:
            assert p.ids_crc32 == zlib.crc32(known[d][p.start : p.start + p.length].tobytes())
    sequences: dict = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    for ps in sequences.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= packing.LENGTH and at & (at - 1) == 0


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    encoded = [e.ids for e in tokenizer().encode_batch([d.text or "" for d in docs], add_special_tokens=False)]
    check(QUERIES["op7_cost_balanced_packing"](spark, SF).collect(), [(d.doc_id, ids) for d, ids in zip(docs, encoded)])


def test_odd_rows(spark):
    pieces = packing.packed(odd_docs(spark), PATH).collect()
    load = tokenizer()
    check(pieces, [(d, load.encode(t or "", add_special_tokens=False).ids) for d, t in ODD])
    assert [p.doc_tokens for p in pieces if p.doc_id in (1, 2, 3)] == [1, 1, 1]
    assert packing.packed(no_docs(spark), PATH).count() == 0


@pytest.mark.parametrize("most", [50, 150_000])
def test_encoder_equals_tokenizer(most):
    draw = random.Random(2)
    letters = "aB'.s tm_-é9\n!d’ÀçŁ½²\x1c\x85　Σςİ̸́日ſJ̌"
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 24))) for _ in range(4000)]
    texts += ["<|endoftext|> x<|startoftext|>", "THING.*** don't!! x). (a) I'LL. A.B.", "'tis .'tis x''s 's", "a" * 3000]
    encoder = packing.WordEncoder(PATH, most)
    expected = [e.ids for e in tokenizer().encode_batch(texts, add_special_tokens=False)]
    for at in range(0, len(texts), 500):
        assert [x.tolist() for x in encoder.encode(texts[at : at + 500])] == expected[at : at + 500]


def test_balance():
    lengths = [900, 30, 2048, 700, 700, 1, 0, 3000]
    pieces, left = packing.balanced(lengths, [2048] * 3)
    filled = [sum(n for _, _, n, s, _ in pieces if s == k) for k in range(3)]
    assert filled == [2048] * 3
    assert sum(n for _, _, n in left) == sum(lengths) - 3 * 2048
    # Longest first: the first piece is the longest document's, cut at the sequence's end.
    assert pieces[0] == (7, 0, 2048, 0, 0)
    # Four equal documents and two sequences: two each, and not all in one.
    shared, _ = packing.balanced([500] * 4, [2048, 2048])
    assert sorted(s for _, _, _, s, _ in shared) == [0, 0, 1, 1]
    assert packing.powers(777) == [512, 256, 8, 1]


def test_added_tokens(spark):
    """Added tokens are one id, as the tokenizer has them with add_special_tokens=False and nothing else set."""
    plain = Tokenizer.from_file(PATH)
    draw = random.Random(4)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "endoftext", "a", "B's", " ", "\n", "日本", "É", "e\u0301", "\u0301"]
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|startoftext|>x<|endoftext|><|endoftext|>"]
    texts += ["".join(draw.choices(parts, k=draw.randint(1, 12))) for _ in range(2000)]
    expected = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert expected[0] == [320, 49407, 321]
    assert [x.tolist() for x in packing.word_encoder(PATH).encode(texts)] == expected
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(packing.packed(docs, PATH).collect(), list(enumerate(expected)))


def test_tables_of_units_stay_small():
    """What a worker looked up stays with it, so units are held only while chunks are learned."""
    encoder = packing.WordEncoder(PATH, 1000)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnprstvxz"]
    for at in range(0, 250, 50):
        encoder.encode([" ".join(f"{word}{end}" for word in words[at : at + 50]) for end in ("", "sh", "ck")])
        assert len(encoder.units.number) <= 1000 // 4 + 150
    assert len(encoder.chunks.number) == 750
    assert encoder.encode(["bal dishck"])[0].tolist() == tokenizer().encode("bal dishck", add_special_tokens=False).ids


def test_freed_memory_goes_back():
    def held() -> int:
        return int(open("/proc/self/statm").read().split()[1]) * os.sysconf("SC_PAGE_SIZE")

    blocks = [bytearray(b"x" * 65_536) for _ in range(1600)]
    last, full = blocks[-1], held()
    del blocks  # the last block keeps the heap's end where it is
    hand_back()
    assert len(last) == 65_536 and held() < full - 50_000_000


class Counted:
    """A tokenizer and its model that count what they are asked to encode."""

    def __init__(self, loaded: Tokenizer):
        self.loaded, self.model, self.asked = loaded, self, Counter()

    def tokenize(self, unit: str) -> list:
        self.asked[unit] += 1
        return self.loaded.model.tokenize(unit)

    def encode_batch_fast(self, units: list[str], **given) -> list:
        self.asked.update(units)
        return self.loaded.encode_batch_fast(units, **given)


def test_common_words_are_encoded_once():
    """A table at its bound gives up rare words and keeps those that come again and again."""
    encoder, plain = packing.WordEncoder(PATH, 400), tokenizer()
    encoder.tokenizer = counted = Counted(encoder.tokenizer)
    common = [f"{a}{b}" for a in "bdfgklmnpr" for b in ("ash", "ish")]
    rare = [f"{a}{b}{c}{d}" for a in "bdfgklmnpr" for b in "aeiou" for c in "stvxz" for d in ("", "ick", "um", "ol")]
    for at in range(0, len(rare), 100):
        # Common words twice in each text; from the second on, one before marks, which is a known chunk.
        text = " ".join([*common, *rare[at : at + 100], *common, f"{common[at // 100]}$$$" if at else "..."])
        assert encoder.encode([text])[0].tolist() == plain.encode(text, add_special_tokens=False).ids
        assert len(encoder.chunks.number) <= 400 + 150 and len(encoder.units.number) <= 100 + 150
    assert {word: counted.asked[word] for word in common + rare} == dict.fromkeys(common + rare, 1)


def test_latin_letters_equal_tokenizer():
    """Lower-case Latin words go to the merges by the spelling of their bytes."""
    letters = [chr(c) for c in range(0x41, 0x250) if chr(c).isalpha()]
    draw = random.Random(5)
    words = letters + ["".join(draw.choices(letters, k=draw.randint(2, 9))) for _ in range(4000)]
    words += [word + draw.choice(["***", "\u0301", "'s", ".", "7"]) for word in words]
    expected = [e.ids for e in tokenizer().encode_batch(words, add_special_tokens=False)]
    assert [x.tolist() for x in packing.WordEncoder(PATH).encode(words)] == expected


def test_stops_and_commas_after_marks():
    texts = ["a. b, c", "x*. y", "x_, y", "x). y, z", "é., a", ". a", "a ., b", "á. b", "..", "a,\nb.\nc_.", "½, ²."]
    expected = [e.ids for e in tokenizer().encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in packing.WordEncoder(PATH).encode(texts)] == expected
