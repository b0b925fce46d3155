"""The merge automaton against the tokenizer library and against merging step by step."""

from __future__ import annotations

import hashlib
import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlake.llm import merge_automaton as m
from ledgerlake.llm.queries import QUERIES, TOKENIZERS
from tests.llm.common import ODD, SF, no_docs, odd_docs

PATH = TOKENIZERS("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(texts: list[str]) -> list[list[int]]:
    return [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def merged(word: bytes, labels: list[bytes], merges: list[tuple[int, int, int]]) -> list[int]:
    """Each merge in turn, everywhere from the left: the definition."""
    tokens = [labels.index(bytes([b])) for b in word]
    for u, v, w in merges:
        at, out = 0, []
        while at < len(tokens):
            hit = tokens[at : at + 2] == [u, v]
            out.append(w if hit else tokens[at])
            at += 1 + hit
        tokens = out
    return tokens


def test_small_vocabularies_against_merging():
    draw = random.Random(3)
    for _ in range(150):
        labels = [b"a", b"b", b"c"]
        merges = []
        while len(merges) < draw.randint(1, 12):
            u, v = draw.randrange(len(labels)), draw.randrange(len(labels))
            # Pairs as training proposes them: such as stand side by side in some result.
            seen = merged(bytes(draw.choices(b"abc", k=60)), labels, merges)
            pairs = list(zip(seen, seen[1:]))
            u, v = draw.choice(pairs) if pairs else (u, v)
            if labels[u] + labels[v] in labels:
                continue
            labels.append(labels[u] + labels[v])
            merges.append((u, v, len(labels) - 1))
        automaton = m.Automaton(labels, merges)
        for _ in range(40):
            word = bytes(draw.choices(b"abc", k=draw.randint(1, 30)))
            assert automaton.encode(word) == merged(word, labels, merges), (labels, merges, word)


def test_a_merge_that_never_fires():
    # ab is always made before b and c can meet, so a + bc is never seen; b + c still is.
    labels = [b"a", b"b", b"c", b"ab", b"bc", b"abc"]
    merges = [(0, 1, 3), (1, 2, 4), (0, 4, 5)]
    automaton = m.Automaton(labels, merges)
    for word in (b"abc", b"bc", b"cabcbc", b"bbcc"):
        assert automaton.encode(word) == merged(word, labels, merges)


def test_equals_the_library():
    draw = random.Random(1)
    marks = "abcdefghijklmnopqrstuvwxyz" * 2 + " '0123ABCéüñ\n\t.,!?-_日本語\U0001f600\x1c\x85\xa0  ²½ªǅʰا̀᠎​͸\U0001fae8\U00010d4a"
    texts = ["".join(draw.choices(marks, k=draw.randint(0, 40))) for _ in range(6000)]
    texts += ["a <|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext", "it's 'twas I'LL we'll", " " * 3000 + "a", " \n" * 3000]
    code = m.coder(PATH)
    for text, expected in zip(texts, ids_of(texts)):
        found = code.encode(text)
        assert found.tolist() == expected, repr(text)
        assert code.decode(found) == LIBRARY.decode(expected, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    code = m.coder(PATH)
    found = code.encode(text)
    assert found.tolist() == ids_of([text])[0]
    assert code.decode(found) == text


def test_every_low_character_is_in_the_librarys_class():
    code = m.coder(PATH)
    for point in range(0x250):
        for before in "a1! ":
            text = f"{before}{chr(point)}b 7"
            assert [w for some in code.words(text) for w in some] == [
                text[a:b] for _, (a, b) in LIBRARY.pre_tokenizer.pre_tokenize_str(text)
            ], repr(text)


def test_long_words_take_linear_time():
    code = m.coder(PATH)
    for unit in ("x", "ab", "日", "=", " "):
        text = unit * 200_000
        begun = time.monotonic()
        found = code.encode(text)
        assert time.monotonic() - begun < 20
        assert code.decode(found) == text
    short = "x" * 5000
    assert code.encode(short).tolist() == ids_of([short])[0]


def test_the_table_of_words_starts_anew(monkeypatch):
    monkeypatch.setattr(m, "MOST_WORDS", 20)
    monkeypatch.setattr(m, "MOST_ARCS", 10)
    code = m.Coder(PATH)
    texts = [" ".join(f"w{k}x{j}" for j in range(30)) for k in range(20)]
    assert [code.encode(t).tolist() for t in texts] == ids_of(texts)


def test_query(spark):
    docs = {d.doc_id: d.text or "" for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op13_merge_automaton"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        ids = np.array(ids_of([docs[r.doc_id]])[0], "<u4")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        back = LIBRARY.decode(ids.tolist(), skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


@pytest.mark.parametrize("docs_of", [odd_docs, no_docs])
def test_odd_rows(spark, docs_of):
    docs = docs_of(spark)
    expected = sorted([(d, t or "") for d, t in ODD], key=repr) if docs_of is odd_docs else []
    coded = m.encoded(docs, PATH)
    assert sorted(((r.doc_id, r.ids) for r in coded.collect()), key=repr) == sorted(
        ((d, ids_of([t])[0]) for d, t in expected), key=repr
    )
    back = m.decoded(coded, PATH)
    assert sorted(((r.doc_id, r.text) for r in back.collect()), key=repr) == expected
    both = m.round_trip(docs, PATH).collect()
    assert sorted(((r.doc_id, r.decoded) for r in both), key=repr) == expected


def test_null_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [50256, None, 64])], "doc_id long, ids array<int>")
    assert sorted((r.doc_id, r.text) for r in m.decoded(rows, PATH).collect()) == [(1, ""), (2, ""), (3, "<|endoftext|>a")]
