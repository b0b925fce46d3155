"""Source divergence against a plain count, the skyband against its definition."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import divergence as d
from ledgerlake.llm.queries import ORACLE, QUERIES
from tests.llm.common import SF, no_docs, odd_docs

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_force(rows: list[tuple], least_docs: int, top: int) -> list[tuple]:
    rows = [tuple(x or "" for x in r) for r in rows]
    terms = [(lang, source, TERM.findall(text.translate(LOWER))) for text, lang, source in rows]
    out = []
    for lang in {r[1] for r in rows}:
        in_docs = Counter(t for g, _, ts in terms if g == lang for t in set(ts))
        kept = sorted(t for t, n in in_docs.items() if n >= least_docs)
        count = {s: Counter() for s in {r[2] for r in rows if r[1] == lang}}
        whole = Counter()
        for g, s, ts in terms:
            if g == lang:
                count[s].update(t for t in ts if t in set(kept))
        for c in count.values():
            whole.update(c)
        v = len(kept)

        def shares(c: Counter) -> list[int]:
            return [1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * v) for t in kept]

        p, q = {s: shares(c) for s, c in count.items()}, shares(whole)
        for s in count:
            pairs = [(-sum(abs(a - b) for a, b in zip(p[s], p[o])), o) for o in count if o != s]
            out += [(lang, s, "pair", o, -f, k) for k, (f, o) in enumerate(sorted(pairs), 1)]
            above = [(b - a, t) for t, a, b in zip(kept, p[s], q) if count[s][t] and a > b]
            out += [(lang, s, "term", t, -f, k) for k, (f, t) in enumerate(sorted(above)[:top], 1)]
    return sorted(out)


def rows_of(frame) -> list[tuple]:
    return sorted(tuple(r) for r in frame.select("lang", "source", "part", "item", "value", "rank").collect())


def some_rows(seed: int, n: int) -> list[tuple]:
    draw = random.Random(seed)
    words = ["a", "B", "b", "Été", "été", "Ä", "日本", "x1y", "it's", "\U0001f600", "￿", "z" * 40, "don-t"]
    langs, sources = ["en", "de", None, ""], ["s1", "s2", "s3", "S1", None, "ü", "日"]
    return [
        (
            None if draw.random() < 0.05 else " ".join(draw.choices(words[: draw.randint(1, 13)], k=draw.randint(0, 30))),
            draw.choice(langs),
            draw.choice(sources),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("least_docs,top", [(1, 3), (4, 50), (1000, 5)])
def test_against_brute_force(spark, least_docs, top):
    rows = some_rows(least_docs, 150)
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    assert rows_of(d.audited(docs, least_docs, top)) == brute_force(rows, least_docs, top)


def test_query_and_its_sql(spark):
    import duckdb

    table = spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang", "source")
    rows = [tuple(r) for r in table.collect()]
    found = rows_of(QUERIES["op11_source_divergence"](spark, SF))
    assert found == brute_force(rows, 30, 50)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    assert found == sorted(con.execute(ORACLE["op11_source_divergence"]).fetchall())


def test_blocks_of_sources_and_terms(spark):
    """Blocks smaller than the number of sources and terms give the same sums."""
    rows = some_rows(7, 120)
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    kept = d.kept_terms(docs, 2).cache()
    groups = d.group_totals(docs, kept).cache()
    expected = [r[:2] + r[3:] for r in brute_force(rows, 2, 1) if r[2] == "pair"]
    for block, terms in ((2, 3), (1, 1), (128, 4096)):
        found = d.source_pairs(kept, groups, block, terms).select("lang", "source", "item", "value", "rank")
        assert sorted(map(tuple, found.collect())) == expected


@pytest.mark.parametrize("k", [1, 3, 50])
def test_skyband(k):
    draw = np.random.default_rng(k)
    for n, most in ((0, 5), (1, 5), (60, 4), (300, 20), (1500, 10**6)):
        count, lang_count = draw.integers(1, most + 1, n), draw.integers(1, most + 1, n)
        spelling = draw.permutation(n)
        dominated = (
            (count[None, :] >= count[:, None])
            & (lang_count[None, :] <= lang_count[:, None])
            & (spelling[None, :] < spelling[:, None])
        ).sum(1)
        assert sorted(d.skyband(count, lang_count, spelling, k).tolist()) == np.flatnonzero(dominated < k).tolist()


def test_shares_are_exact_beyond_64_bits(spark):
    cases = [(0, 0, 1), (10**17, 10**18 + 7, 3), (9 * 10**15 + 1, 9 * 10**15 + 2, 10**7), (999_999_999, 10**9, 10**9), (5, 5, 0)]
    found = spark.createDataFrame(cases, "n long, total long, terms long").select("n", "total", "terms", d.share("n", "total", "terms").alias("p"))
    for n, total, terms, p in found.collect():
        assert p == (1 + 10**9 * (n + 5) // (total + 5 * terms) if terms else None)


def test_full_tables_of_counts_are_handed_on(spark):
    """Texts longer than a slice, and more terms than a table takes, are counted whole."""
    letters = ["".join(x) for x in itertools.product("abcdefghijklmnop", repeat=4)]
    text = " ".join(letters) * 6
    docs = spark.createDataFrame([(text, "en", "s"), (text, "en", "s")], "text string, lang string, source string").repartition(1)
    found = d.counted(docs).groupBy("term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).collect()
    expected = Counter(text.split())
    assert {r.term: r.n for r in found} == {t: 2 * n for t, n in expected.items()}
    assert {r.docs for r in found} == {2}


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = [tuple(r) for r in docs.select("text", "lang", "source").collect()]
    assert rows_of(d.audited(docs, 1, 2)) == brute_force(rows, 1, 2)
    assert d.audited(no_docs(spark)).count() == 0
    one = spark.createDataFrame([("a a b", None, None)], "text string, lang string, source string")
    assert d.audited(one, 1).count() == 0  # one source is all of its language and has no other
