"""Section token counts against the tokenizer's own offsets; sampled segmentations against all."""

from __future__ import annotations

import math
import random
import re
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerlake.llm import lattice_sampling as lattice
from ledgerlake.llm import token_counts
from ledgerlake.llm.queries import QUERIES, TOKENIZERS
from tests.llm.common import ODD, SF, no_docs, odd_docs

RANKS = TOKENIZERS("byte_bpe_50k.tiktoken")
MODEL = TOKENIZERS("piece_bpe_32k.model")


def test_spans_equal_the_tokenizers_offsets():
    encode = token_counts.encoder(RANKS, public_tokenizers.PATTERN)
    other = Tokenizer.from_file(TOKENIZERS("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    for text in ["", "a b", "Über das 日本 \U0001f600\n\n ok", "naïve   x\t\n", *(t or "" for _, t in ODD)]:
        ids, begins, ends = encode.spans(text)
        expected = other.encode(text, add_special_tokens=False)
        assert ids.tolist() == expected.ids
        assert list(zip(begins.tolist(), ends.tolist())) == expected.offsets


def brute(text: str, sections: list[tuple[int, int]]) -> dict[int, list[float]]:
    encode = token_counts.encoder(RANKS, public_tokenizers.PATTERN)
    out = {k: [0, 0, 0.0] for k in [*range(len(sections)), -1]}
    for begin, end in zip(*(x.tolist() for x in encode.spans(text)[1:])):
        held = [max(0, min(end, b) - max(begin, a)) for a, b in sections]
        outside = end - begin - sum(held)
        best = held.index(max(held)) if held and max(held) >= outside else -1
        out[best][0] += 1
        out[best][1] += sum(h > 0 for h in held) + (outside > 0) > 1
        for k, h in [*enumerate(held), (-1, outside)]:
            out[k][2] += h / (end - begin)
    return out


def test_query(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op1_token_counts"](spark, SF).collect()
    by_doc: dict = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, {})[r.section] = r
    assert by_doc.keys() == texts.keys()
    for doc_id, text in texts.items():
        lines = text.splitlines(keepends=True) or [""]
        ends = np.cumsum([len(line) for line in lines]).tolist()
        sections = list(zip([0, *ends[:-1]], ends))
        expected = brute(text, sections)
        found = by_doc[doc_id]
        assert [(found[k].begin, found[k].end) for k in range(len(sections))] == sections
        for k, (tokens, crossing, share) in expected.items():
            if k >= 0 or tokens:
                assert (found[k].n_tokens, found[k].n_crossing) == (tokens, crossing)
                assert math.isclose(found[k].token_share, share, abs_tol=1e-9)
        assert sum(r.n_tokens for r in found.values()) == found[0].doc_tokens


def test_sections_of_a_column_with_gaps(spark):
    text = "Title of it: unbelievable consequences   and more"
    sections = [(0, 5), (7, 7), (8, 18), (22, 30), (44, 49)]
    docs = spark.createDataFrame(
        [(1, text, [{"begin": a, "end": b} for a, b in sections], 5), (2, "x y", None, 6), (3, None, [], 7)],
        "doc_id long, text string, parts array<struct<begin:long,end:long>>, n_tokens int",
    )
    rows = token_counts.attributed(docs, RANKS, public_tokenizers.PATTERN, "parts").collect()
    expected = brute(text, sections)
    found = {r.section: r for r in rows if r.doc_id == 1}
    assert {k: (r.n_tokens, r.n_crossing) for k, r in found.items()} == {k: tuple(v[:2]) for k, v in expected.items()}
    assert sum(v[1] for v in expected.values()) > 0
    assert [(r.section, r.n_tokens) for r in rows if r.doc_id == 2] == [(-1, 2)]
    assert not [r for r in rows if r.doc_id == 3]
    with pytest.raises(ValueError, match="disjoint"):
        token_counts.allocated(np.array([0]), np.array([1]), np.array([0, 1]), np.array([3, 4]))


def test_token_odd_rows(spark):
    rows = token_counts.attributed(odd_docs(spark), RANKS, public_tokenizers.PATTERN).collect()
    assert Counter(r.doc_id for r in rows)[6] == 2
    assert [(r.section, r.n_tokens, r.end) for r in rows if r.doc_id == 1] == [(0, 0, 0)]
    assert token_counts.attributed(no_docs(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def all_segmentations(text: str, vocabulary) -> dict[tuple[int, ...], float]:
    """Every path of the text's lattice with its probability."""
    plain = lattice.normalised(text)
    known = {vocabulary.bytes_of[i].decode(): i for i in vocabulary.ids}
    out = {}

    def walk(at, ids, weight):
        if at == len(plain):
            out[tuple(ids)] = weight
            return
        for end in range(at + 1, min(len(plain), at + vocabulary.longest) + 1):
            piece = plain[at:end]
            if piece in known and lattice.SPACE not in piece.lstrip(lattice.SPACE):
                walk(end, [*ids, known[piece]], weight + vocabulary.log_weight[known[piece]])
        if plain[at] not in known:
            spelled = [int(vocabulary.byte_id[b]) for b in plain[at].encode()]
            walk(at + 1, [*ids, *spelled], weight + vocabulary.log_weight[spelled].sum())

    walk(0, [], 0.0)
    total = np.logaddexp.reduce(list(out.values()))
    return {ids: float(np.exp(weight - total)) for ids, weight in out.items()}


@pytest.mark.parametrize("text", ["hello", "ab cd", "  x", "\U0001f600a", ""])
def test_samples_follow_the_distribution(text):
    vocabulary = lattice.vocabulary(MODEL, 0.5)
    p, k, n = all_segmentations(text, vocabulary), 3, 3000
    draws = lattice.samples([text] * n, [k * 7919 + 13 for k in range(n)], k, vocabulary)
    first, second = Counter(), Counter()
    for found in draws:
        ids = [tuple(map(int, s[0])) for s in found]
        assert len(set(ids)) == len(ids) == min(k, len(p))
        assert all(math.isclose(math.exp(s[1]), p[i], rel_tol=1e-9) for s, i in zip(found, ids))
        first[ids[0]] += 1
        if len(ids) > 1:
            second[ids[1]] += 1
    for ids in sorted(p, key=p.get)[-4:]:
        assert abs(first[ids] / n - p[ids]) < 0.04
        if len(p) > 1:
            expected = sum(p[o] * p[ids] / (1 - p[o]) for o in p if o != ids)
            assert abs(second[ids] / n - expected) < 0.04
    # Weighted by inclusion, the samples' probabilities add up to 1 on average.
    assert abs(np.mean([sum(math.exp(s[1] - s[2]) for s in found) for found in draws]) - 1) < 0.06


def test_all_segmentations_are_found_in_the_end():
    vocabulary = lattice.vocabulary(MODEL, 0.5)
    p = all_segmentations("ab cd", vocabulary)
    (found,) = lattice.samples(["ab cd"], [1], 100, vocabulary)
    assert {tuple(map(int, s[0])) for s in found} == p.keys() and all(s[2] == 0 for s in found)


def test_samples_dont_depend_on_company():
    vocabulary = lattice.vocabulary(MODEL, 0.5)
    texts, keys = [t or "" for _, t in ODD[:8]], list(range(8))
    together = lattice.samples(texts, keys, 2, vocabulary)
    for k, text in enumerate(texts):
        (alone,) = lattice.samples([text], [keys[k]], 2, vocabulary)
        assert [s[0].tolist() for s in alone] == [s[0].tolist() for s in together[k]]


def test_sampling_query_and_decoding(spark):
    rows = QUERIES["op2_sampled_segmentations"](spark, SF).collect()
    assert all(r.round_trip and r.log_inclusion <= 0 for r in rows)
    assert Counter(Counter((r.doc_id) for r in rows).values()) == {2: 200}
    docs = odd_docs(spark)
    decoded = lattice.decoded(lattice.sampled(docs, MODEL, 2), MODEL).collect()
    texts = {d: t or "" for d, t in ODD}
    assert all(r.text == texts[r.doc_id] for r in decoded)
    per_doc = Counter(r.doc_id for r in decoded)
    assert per_doc[1] == per_doc[2] == 1 and per_doc[6] == 4
    assert lattice.sampled(no_docs(spark), MODEL, 2).count() == 0


def test_long_runs_of_blanks_are_whole_words(monkeypatch):
    """As the pattern has them where it can take them, and without an error where it can't."""
    encode = token_counts.encoder(TOKENIZERS("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    draw = random.Random(5)
    marks = [" ", "\t", "\n", "\r\n", "\u3000", "\x85"]
    texts = []
    for _ in range(300):
        runs = ["".join(draw.choices(marks[: draw.randint(1, 6)], k=draw.randint(5, 40))) for _ in range(3)]
        words = [draw.choice(["", "a", "it's", "42", "--", "日本", "\x1c", "\x1c \x1d"]) for _ in range(4)]
        texts.append("".join(x for pair in zip(words, [*runs, ""]) for x in pair))
    monkeypatch.setattr(token_counts, "_LONG_BLANKS", re.compile(r"[^\S\x1c-\x1f]{5,}"))
    for text in texts:
        assert encode._ids(text).tolist() == encode.encoding.encode_ordinary(text), repr(text)
    monkeypatch.undo()
    begun = time.monotonic()
    for blank in (" ", "\n", "\t \n"):
        for text in (blank * 1_200_000, "word" + blank * 1_200_000 + "word"):
            ids, begins, ends = encode.spans(text)
            assert ends[-1] == len(text) and begins[0] == 0 and (begins[1:] == ends[:-1]).all()
    assert time.monotonic() - begun < 60


def test_sampling_looks_at_few_sets(monkeypatch):
    """Two samples draw each token twice; of the sets that branch off only the first ones can come next."""
    numbers = []
    plain = lattice.uniform
    monkeypatch.setattr(lattice, "uniform", lambda seeds, counters: numbers.append(len(seeds)) or plain(seeds, counters))
    pieces = lattice.vocabulary(TOKENIZERS("piece_bpe_32k.model"), 0.5)
    text = " ".join(f"{a}ating {b}er some{a}{b}" for a in ["cre", "rel", "rot", "flo"] for b in ["riv", "tow", "pap"] for _ in range(60))
    found = lattice.samples([text], [5], 2, pieces)[0]
    tokens = sum(len(ids) for ids, _, _ in found)
    assert len(found) == 2 and sum(numbers) < 1.3 * tokens


def test_sampling_draws_and_words():
    pieces = lattice.vocabulary(TOKENIZERS("piece_bpe_32k.model"), 0.5)
    words = ["▁interesting", "▁", "▁日本é", "▁aaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "▁the"]
    lattices = lattice.Lattices(words, pieces)
    states = np.repeat(np.arange(lattices.states), 50)
    draws = np.tile(np.append(np.linspace(0, 1, 49, endpoint=False), 1 - 2.0**-53), lattices.states)
    edges = np.searchsorted(lattices.cumulative, states + draws, "right")
    assert (lattices.draw(states, draws) == np.clip(edges, lattices.begin[states], lattices.begin[states + 1] - 1)).all()
    for text in ["", " ", "  a", "a  b ", "a ", " a", "▁x ▁", "a\n b\tc", "one two"]:
        marked = ["▁" + word for word in lattice.words_of(text)]
        assert marked == re.findall("▁*[^▁]+|▁+", lattice.normalised(text))
