"""Near-duplicate classes against a comparison of all pairs."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import near_dup
from ledgerlake.llm.common import with_ids, without_ids
from ledgerlake.llm.components import connected_components
from ledgerlake.llm.queries import QUERIES
from tests.llm.common import SF, no_docs, odd_docs


def shingles(text: str | None) -> set[bytes]:
    words = (text or "").encode().lower().split()
    width = min(5, len(words))
    return {b" ".join(words[k : k + width]) for k in range(len(words) - width + 1)} if words else set()


def brute_classes(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    sets = {i: shingles(t) for i, t in rows}
    of = {i: i for i in sets}

    def find(x):
        while of[x] != x:
            x = of[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                small, large = sorted((len(sets[a]), len(sets[b])))
                if 100 * small >= 75 * large and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    low, high = sorted((find(a), find(b)))
                    of[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


def classes(docs) -> dict[int, tuple[int, int]]:
    return {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.classes(docs).collect()}


def test_query_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    found = QUERIES["op4_minhash_near_dedup"](spark, SF).collect()
    expected = brute_classes([tuple(r) for r in docs.collect()])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    assert len(found) == docs.count()


@pytest.mark.parametrize("small", [2, 24])
def test_chains_and_large_buckets(spark, monkeypatch, small):
    """Copies with more and more edits: many meet in large buckets without being linked."""
    monkeypatch.setattr(near_dup, "SMALL_BUCKET", small)
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    draw = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(draw.choice([1, 2, 3, 5, 8])):
            words[draw.randrange(len(words))] = f"x{draw.random()}"
        rows.append((i * 3 + 1, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_classes(rows)
    assert 1 < len({c for _, c in expected.values()}) < len(rows)
    assert classes(docs) == expected


def test_threshold_is_exact(spark):
    """Sets of 100 and 75 shingles, one within the other: 75 of 100 is a link, 74 is none."""
    words = [f"v{k}" for k in range(104)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:79])), (3, " ".join(words[:78]).upper()), (4, "other words are here now")]
    rows[2] = (3, " ".join(words[26:]).upper())
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert classes(docs) == brute_classes(rows)
    assert classes(docs)[2] == (75, 1) and classes(docs)[3] == (74, 3)


def test_odd_rows(spark):
    found = near_dup.classes(odd_docs(spark).where("doc_id is not null")).collect()
    assert len(found) == 10
    of = {r.doc_id: r for r in found}
    assert [of[i].n_shingles for i in (1, 2, 3, 4, 5)] == [0, 0, 0, 1, 6]
    assert [of[i].component_id for i in (1, 2, 3, 5, 6)] == [1, 2, 3, 5, 5]
    assert near_dup.classes(no_docs(spark)).count() == 0


def test_deduplicated_keeps_columns_and_one_row(spark):
    docs = odd_docs(spark)
    kept = near_dup.deduplicated(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter([1, 2, 3, 4, 5, 7, 8, None, 9])
    assert near_dup.deduplicated(no_docs(spark)).count() == 0
    twice = docs.where("doc_id = 6")
    assert near_dup.deduplicated(twice).count() == 1


def test_components(spark):
    draw = random.Random(3)
    edges = [(draw.randrange(200), draw.randrange(200)) for _ in range(150)] + [(1000 + k, 1001 + k) for k in range(60)]
    edges += [(5, 5), (7, None)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    of = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}

    def find(x):
        while of[x] != x:
            x = of[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            low, high = sorted((find(a), find(b)))
            of[high] = low
    assert found == {x: find(x) for x in of}


def test_blocks_count_exactly():
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 60, 40)).astype(np.uint64) for _ in range(40)]
    parts = np.arange(40)
    forest = near_dup.forest_of_block(parts, parts, sets)
    of = list(range(40))

    def find(x):
        while of[x] != x:
            x = of[x]
        return x

    for a, b in forest:
        assert near_dup.linked(sets[a], sets[b])
        of[find(a)] = find(b)
    for a in range(40):
        for b in range(a):
            if near_dup.linked(sets[a], sets[b]):
                assert find(a) == find(b)


def test_id_filter_is_exact(spark):
    rows = spark.range(3000).withColumnRenamed("id", "doc_id").unionAll(spark.sql("select cast(null as bigint)"))
    ids = rows.where("doc_id % 3 = 0").unionAll(rows.where("doc_id = 6"))
    assert with_ids(rows, ids).count() == 1000
    assert without_ids(rows, ids).count() == 2001
    assert without_ids(rows, ids.where(F.lit(False))).count() == 3001
    narrow = rows.withColumn("doc_id", F.col("doc_id").cast("int"))
    assert with_ids(narrow, ids).count() == 1000 and without_ids(narrow, ids).count() == 2001


def test_blocks_meet_across_components_only(spark, monkeypatch):
    """Every pair of different parts shares a pair of blocks; a large part's own blocks meet no other of its."""
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    parts = [0] * 100 + [1] * 30 + [2] * 8 + [3] * 7 + list(range(10, 25))
    rows = [(7, len(parts), k, part) for k, part in enumerate(parts)] + [(8, 41, 500 + k, int(k == 0)) for k in range(41)]
    rows += [(9, 40, 600 + k, k % 2) for k in range(40)]
    members = spark.createDataFrame(rows, "key long, n long, doc_id long, part long")
    groups = {}
    for r in near_dup._block_pairs(members).collect():
        groups.setdefault((r.key, r.low, r.high), []).append((r.doc_id, r.part))
    met = {(key, *sorted((a[0], b[0]))) for (key, _, _), held in groups.items() for a in held for b in held if a[1] != b[1]}
    wanted = {(x[0], *sorted((x[2], y[2]))) for x in rows for y in rows if x[0] == y[0] and x[3] != y[3]}
    assert met == wanted
    # One member apart from 40: 40 rows and the one with each of their five blocks, not all pairs of blocks.
    assert sum(len(held) for (key, _, _), held in groups.items() if key == 8) <= 40 + 5 + 1
