"""Order MinHash against the same definition in plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import xxhash

from ledgerlake.llm import order_minhash as om
from ledgerlake.llm.queries import QUERIES
from tests.llm.common import SF, no_docs, odd_docs

FULL = 1 << 64


def signed(x: int) -> int:
    return x - FULL if x >= FULL // 2 else x


def chained(values) -> int:
    """Spark's xxhash64 over several columns; nulls are passed over."""
    seed = 42
    for v in values:
        if v is not None:
            data = v.encode() if isinstance(v, str) else (v % FULL).to_bytes(8, "little") if isinstance(v, int) else v
            seed = xxhash.xxh64_intdigest(data, seed=seed)
    return signed(seed)


def with_occurrence(group: int, occurrence: int) -> int:
    seed = xxhash.xxh64_intdigest((group % FULL).to_bytes(8, "little"), seed=42)
    return signed(xxhash.xxh64_intdigest(occurrence.to_bytes(4, "little"), seed=seed))


def fingerprint(text: str | None) -> str:
    words = re.findall(rf"[^ \t\n\x0b\f\r]{{1,{om.LONGEST}}}", text or "")
    count = max(len(words) - om.WORDS + 1, min(len(words), 1))
    kmers = [chained(words[k : k + om.WORDS]) for k in range(count)]
    met: Counter = Counter()
    ranked = []
    for place, kmer in enumerate(kmers):
        group = kmer >> om.PLACE_BITS
        hashed = with_occurrence(group, met[group])
        met[group] += 1
        ranked.append((hashed >> om.PLACE_BITS, place))
    bins: dict[int, list[int]] = {}
    for hashed, place in sorted(ranked):
        chosen = bins.setdefault(hashed >> (64 - om.BIN_BITS - om.PLACE_BITS), [])
        if len(chosen) < om.TUPLE:
            chosen.append(place)
    return ".".join(
        f"{b + om.BINS // 2:02X}-{chained([kmers[p] for p in sorted(places)]) % FULL:016x}" for b, places in sorted(bins.items())
    )


def likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    left, right = set(filter(None, a.split("."))), set(filter(None, b.split(".")))
    return len(left & right) / max(1, len({e[:2] for e in left | right}))


def check(rows, docs) -> None:
    texts = [t or "" for _, t in docs]
    assert len(rows) == len(docs)
    for k, r in enumerate(rows):
        text, following = texts[k], texts[(k + 1) % len(texts)]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == fingerprint(text) and r.edited_fingerprint == fingerprint(edited)
        assert r.near_edited == likeness(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == likeness(r.fingerprint, fingerprint(following))


def test_query(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    rows = sorted(QUERIES["op6_order_minhash"](spark, SF).collect(), key=lambda r: r.doc_id)
    check(rows, docs)
    assert sum(r.near_edited for r in rows) / len(rows) > 0.3 > sum(r.near_next for r in rows) / len(rows)


def test_repeats_short_and_blank_texts(spark):
    draw = random.Random(1)
    docs = [(k * 7 - 50, " ".join(draw.choices("ab", k=draw.randint(0, 40)))) for k in range(60)]
    docs += [(1000, None), (1001, ""), (1002, " \t"), (1003, "one"), (1004, "one two"), (1005, "x" * 3000), (1006, "\U0001f600é " * 9)]
    rows = om.compared(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    check(sorted(rows, key=lambda r: r.doc_id), docs)


def test_order_matters():
    words = [f"w{k}" for k in range(200)]
    halves = fingerprint(" ".join(words[100:] + words[:100]))
    assert likeness(fingerprint(" ".join(words)), halves) < 0.75


def test_odd_rows(spark):
    rows = om.compared(odd_docs(spark)).collect()
    assert len(rows) == 11
    same = [r.fingerprint for r in rows if r.doc_id in (5, 6)]
    assert len(same) == 3 and len(set(same)) == 1
    assert om.compared(no_docs(spark)).count() == 0
    lone = om.compared(odd_docs(spark).where("doc_id = 5")).first()
    assert lone.near_next == 1.0


def test_native(spark):
    plan = om.compared(odd_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_insertion_into_a_text_without_blanks(spark):
    """One character put in, or taken out, anywhere changes the entries around it only."""
    draw = random.Random(3)
    texts = ["".join(chr(draw.randint(0x4E00, 0x9FA5)) for _ in range(3000)), "".join(draw.choices("ACGT", k=3000)),
             "".join(draw.choices("\u0e01\u0e02\U00020000x", k=3000))]
    pairs = [(t, edited) for t in texts for edited in ("\u4e00" + t, t[:1500] + "\u4e00" + t[1500:], t[1:], t[:700] + t[701:])]
    found = om.with_fingerprint(om.with_fingerprint(spark.createDataFrame(pairs, "t string, u string"), "t", "a"), "u", "b")
    assert min(r[0] for r in found.select(om.likeness("a", "b")).collect()) > 0.75
    others = spark.createDataFrame([(texts[0], texts[0][::-1])], "t string, u string")
    others = om.with_fingerprint(om.with_fingerprint(others, "t", "a"), "u", "b")
    assert others.select(om.likeness("a", "b")).first()[0] < 0.2
