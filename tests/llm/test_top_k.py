"""Top-k search against all inner products."""

from __future__ import annotations

import math

import duckdb
import numpy as np
from pyspark.sql import functions as F

from ledgerlake.llm import top_k
from ledgerlake.llm.queries import ORACLE, QUERIES
from tests.llm.common import SF

ROWS = "vec_id long, embedding array<float>, rank int, score double"


def brute(rows, k):
    seen = {}
    for vec_id, vector in rows:
        if vec_id is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            weights = tuple(math.floor(64 * float(np.float32(x))) for x in vector)
            seen[vec_id, weights] = None
    out = []
    for query, of_query in seen:
        if query % 20 == 0:
            scores = [(-sum(a * b for a, b in zip(of_query, w)), v) for v, w in seen if v != query]
            out += [(query, rank, v, -s) for rank, (s, v) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def found(frame):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in frame.collect())


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    rows = con.execute(f"select query_id, rank, vec_id, score from ({ORACLE['op5_exact_top_k']})").fetchall()
    assert found(QUERIES["op5_exact_top_k"](spark, SF)) == sorted(rows)


def test_ties_blocks_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(top_k, "BLOCK", 40)
    monkeypatch.setattr(top_k, "QUERY_BLOCK", 3)
    draw = np.random.default_rng(2)
    rows = [(k, [float(x) for x in draw.integers(-2, 3, 6) / 64]) for k in range(300)]
    rows += [(k, [0.5, 0.25, 0.0, 0.0, 0.0, 0.0]) for k in range(300, 420)]  # one vector many times
    rows += [(500, None), (520, [1.0, None]), (540, [float("nan")]), (560, [float("inf"), 0.0]), (None, [1.0]), (580, [])]
    rows += [rows[40], (600, [1.0] * 9), (601, [0.015])]
    frame = spark.createDataFrame([(*r, 1, 2.0) for r in rows], ROWS)
    assert found(top_k.searched(frame, F.col("vec_id") % 20 == 0, 7)) == brute(rows, 7)


def test_few_and_no_rows(spark):
    one = spark.createDataFrame([(0, [1.0], 1, 1.0)], ROWS)
    assert found(top_k.searched(one, F.col("vec_id") % 20 == 0)) == []
    assert found(top_k.searched(one.where("false"), F.col("vec_id") % 20 == 0)) == []
    two = spark.createDataFrame([(0, [1.0], 1, 1.0), (3, [0.5], 1, 1.0)], ROWS)
    assert found(top_k.searched(two, F.col("vec_id") % 20 == 0)) == [(0, 1, 3, 2048)]
