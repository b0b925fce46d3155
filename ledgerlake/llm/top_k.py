"""Exhaustive top-k search by inner product, a term at a time.

Vectors become sparse rows of integer weights, floor(64 * x) per component, zeros left out. The
candidates are dealt into blocks of about ``BLOCK`` rows, the queries into blocks of about
``QUERY_BLOCK``, and every pair of blocks is worked on by itself: the candidates' block is
turned into postings, a list of rows and weights for each term, and each query's terms scatter
their weighted postings into one dense array of scores. Of that array the k best are selected
by partition; what the blocks select for a query is merged at the end.

A query meets every candidate, as asked; what is shuffled are the candidates, once for each
block of queries, the queries, once for each block of candidates, and k rows per query and
block. Blocks are dealt by a hash of the whole row, so that no vector or id, however common,
makes a block large.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlake.llm.common import settle

SCALE = 64
K = 20
BLOCK = 8192
QUERY_BLOCK = 1024


def integer_weights(vector: str) -> Column:
    """floor(SCALE * x) of every component x, taken as double; null for vectors that don't count."""
    usable = F.col(vector).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long")))


def postings(ids_of_terms: list[np.ndarray], weights: list[np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By term: the rows that have it, ascending, and their weights."""
    if not ids_of_terms:
        return {}
    rows = np.repeat(np.arange(len(ids_of_terms)), [len(t) for t in ids_of_terms])
    terms, values = np.concatenate(ids_of_terms), np.concatenate(weights)
    order = np.argsort(terms, kind="stable")
    rows, terms, values = rows[order], terms[order], values[order]
    starts = np.flatnonzero(np.append(True, terms[1:] != terms[:-1])) if len(terms) else []
    ends = [*starts[1:], len(terms)]
    return {int(terms[a]): (rows[a:b], values[a:b]) for a, b in zip(starts, ends)}


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by smaller id, in that order."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        level = np.flatnonzero(scores == least)
        wanted = k - len(above)
        if len(level) > wanted:
            level = level[np.argpartition(ids[level], wanted - 1)[:wanted]] if wanted else level[:0]
        places = np.concatenate([above, level])
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))]


def _sparse(weights: pd.Series) -> tuple[list[np.ndarray], list[np.ndarray]]:
    terms, values = [], []
    for row in weights:
        row = np.asarray(row, dtype=np.int64)
        present = np.flatnonzero(row)
        terms.append(present)
        values.append(row[present])
    return terms, values


def _searched(k: int):
    def search(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(queries) and len(candidates):
            ids = candidates["vec_id"].to_numpy()
            lists = postings(*_sparse(candidates["weights"]))
            for query_id, terms, values in zip(queries["vec_id"], *_sparse(queries["weights"])):
                scores = np.zeros(len(ids), np.int64)
                for term, weight in zip(terms.tolist(), values.tolist()):
                    if term in lists:
                        rows, of_rows = lists[term]
                        scores[rows] += weight * of_rows
                others = np.flatnonzero(ids != query_id)
                found = others[best(scores[others], ids[others], k)]
                out["query_id"].append(np.full(len(found), query_id))
                out["vec_id"].append(ids[found])
                out["score"].append(scores[found])
        return pd.DataFrame({name: np.concatenate(parts) if parts else np.zeros(0, np.int64) for name, parts in out.items()})

    return search


def searched(vectors: DataFrame, is_query: Column, k: int = K, vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of each query.

    ``vectors`` needs vec_id and the vector's column. Queries are the rows for which
    ``is_query`` holds; candidates are all rows with another vec_id. Rows whose vec_id is null,
    or whose vector is null or holds a null, a NaN or an infinity, take no part; a vector
    without components scores 0, as components beyond the shorter vector do. Repeated rows are
    one row. With fewer candidates than k all are returned. Ties go to the smaller vec_id.
    """
    usable = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), integer_weights(vector).alias("weights"), is_query.alias("asks"))
        .where("vec_id is not null and weights is not null")
        .dropDuplicates(["vec_id", "weights"])
    )
    usable = settle(usable, "weights")
    total, asking = usable.agg(F.count("*"), F.count_if("asks")).first()
    blocks = max(1, math.ceil(total / BLOCK))
    query_blocks = max(1, math.ceil(asking / QUERY_BLOCK))
    dealt = F.xxhash64("vec_id", "weights")
    candidates = usable.select(
        "vec_id", "weights", F.pmod(dealt, F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_block"),
    )
    queries = usable.where("asks").select(
        "vec_id", "weights", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.pmod(F.xxhash64(dealt), F.lit(query_blocks)).cast("int").alias("query_block"),
    )
    found = (
        queries.groupBy("block", "query_block")
        .cogroup(candidates.groupBy("block", "query_block"))
        .applyInPandas(_searched(k), "query_id long, vec_id long, score long")
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
