"""Periodic runs against a brute-force search for every period."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from ledgerlake.llm import periodic_runs as p
from ledgerlake.llm.queries import QUERIES
from tests.llm.common import ODD, SF, no_docs, odd_docs


def smallest_period(words: list) -> int:
    return next(q for q in range(1, len(words) + 1) if words[q:] == words[: len(words) - q])


def brute_force(words: list, least: int, times: int) -> list[tuple[int, int, int]]:
    """For every period, the stretches of words that equal those a period later."""
    numbers = np.unique(np.array(words, dtype=object), return_inverse=True)[1]
    runs = []
    for q in range(1, len(words) // times + 1):
        differs = np.flatnonzero(numbers[:-q] != numbers[q:])
        begins, ends = np.concatenate([[-1], differs]) + 1, np.concatenate([differs, [len(words) - q]])
        for at, end in zip(begins.tolist(), ends.tolist()):
            length = end - at + q
            if end > at and length >= max(least, times * q) and smallest_period(words[at : at + length]) == q:
                runs.append((at, length, q))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def planted(words: list[str], doc_id: int | None) -> list[str]:
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    q = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % q] for i in range(n)]


def expected(doc_id: int | None, text: str | None) -> tuple:
    words = planted(re.findall(r"[^\x20\x09-\x0D]+", text or ""), doc_id)
    runs = brute_force(words, 24, 3)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    best = p.strongest(runs) if runs else (None, None, None)
    milli = 1000 * best[1] // best[2] if runs else None
    digests = (hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept))
    return (doc_id, len(runs), *best, milli, *digests)


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


@pytest.mark.parametrize("least", [3, 6, 24])
def test_small_alphabets(least):
    draw = random.Random(least)
    for _ in range(400):
        texts = []
        for _ in range(draw.randint(1, 5)):
            words = draw.choices("abc"[: draw.randint(1, 3)], k=draw.randint(0, 50))
            for _ in range(draw.randint(0, 3)):  # periods of many lengths, one inside another too
                root = draw.choices("abc", k=draw.randint(1, 12))
                words += root * draw.randint(1, 5) + root[: draw.randint(0, len(root))]
            texts.append(words)
        numbers = [*(ord(c) for c in "abc")]
        flat, document = [], []
        for k, words in enumerate(texts):
            flat += [numbers.index(ord(c)) for c in words] + [100_000 + k]
            document += [k] * (len(words) + 1)
        found = [tuple(r) for r in p.runs_in(np.array(flat), np.array(document), least, 3).tolist()]
        at, brute = 0, []
        for words in texts:
            brute += [(s + at, n, q) for s, n, q in brute_force(words, least, 3)]
            at += len(words) + 1
        assert found == brute


def test_long_roots_and_texts():
    draw = random.Random(9)
    root = [str(draw.random()) for _ in range(777)]
    words = [str(draw.random()) for _ in range(500)] + root * 3 + ["end"] + ["x"] * 30 + (["y", "z"] * 20)
    runs, strongest, collapsed = p._documents([" ".join(words).encode()], 24, 3)
    assert [tuple(r.values()) for r in runs.to_pylist()[0]] == brute_force(words, 24, 3)
    assert strongest.to_pylist() == [{"start": 2832, "length": 30, "period": 1}]
    assert collapsed.to_pylist()[0].split() == words[:1277] + ["end", "x", "y", "z"]
    begun = time.monotonic()
    for text in ("w " * 1_000_000, "a b c " * 300_000, " ".join(str(k % 1000) for k in range(600_000))):
        p._documents([text.encode()], 24, 3)
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 200_000:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    p._documents([" ".join(fibonacci[-1]).encode()], 24, 3)
    assert time.monotonic() - begun < 60


def test_strongest_is_exact_and_ties_go_to_the_first():
    assert p.strongest([(5, 30, 10), (0, 27, 9), (0, 24, 8)]) == (0, 24, 8)
    assert p.strongest([(0, 3 * 10**17, 10**17), (1, 3 * 10**17 + 1, 10**17)])[0] == 1
    with pytest.raises(ValueError):
        p.runs_in(np.zeros(3, np.int64), np.zeros(3, np.int64), 24, 2)


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op12_periodic_runs"](spark, SF).select(*COLUMNS).collect()
    assert sorted(map(tuple, found)) == sorted(expected(d.doc_id, d.text) for d in docs)
    assert any(r.n_runs for r in found)


@pytest.mark.parametrize("docs_of", [odd_docs, no_docs])
def test_odd_rows(spark, docs_of):
    from ledgerlake.llm.queries import runs_of

    found = runs_of(docs_of(spark)).select(*COLUMNS).collect()
    rows = ODD if docs_of is odd_docs else []
    assert sorted(map(tuple, found), key=repr) == sorted((expected(d, t) for d, t in rows), key=repr)
    long_one = [r for r in found if r.doc_id == 7]
    assert not rows or (long_one[0].n_runs, long_one[0].period) == (1, 5)


def test_no_length_of_a_text_hides_white_space(spark):
    docs = spark.createDataFrame([(4, "a b c \x1c x\x0by\x0cz\x85")], "doc_id long, text string")
    row = p.found(docs).collect()[0]
    assert row.collapsed == "a b c \x1c x y z\x85" and row.runs == [] and row.strongest is None
