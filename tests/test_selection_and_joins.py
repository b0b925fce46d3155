"""Selection, block minima, as-of and interval joins against brute force on small rows, and their plans."""

from __future__ import annotations

import math
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from ledgerlake.operators import timeseries
from ledgerlake.operators.ordered import centred_minima, previous_row, with_slice
from ledgerlake.operators.periods import interval_join
from ledgerlake.operators.timeseries import asof_join, intervals, local_minima, rank_quantiles
from tests.test_registered import SF_DIR, needs_data

SHARES = {"least": 0.0, "low": 0.1, "third": 1 / 3, "half": 0.5, "high": 0.95, "most": 1.0}


def by_rank(values: list, p: float):
    """The definition: the smallest value whose percent_rank reaches p."""
    if not values:
        return None
    for v in sorted(set(values)):
        below = sum(x < v for x in values)
        if (below / (len(values) - 1) if len(values) > 1 else 0.0) >= p:
            return v
    return None


def same(found, wanted) -> bool:
    return found == wanted if None in (found, wanted) else float(found) == pytest.approx(wanted)


def values_of(kind: str, draw: random.Random, n: int) -> list:
    if kind == "bigint":
        return [draw.choice([-(10**15), 0, 1, 2, 10**15]) + draw.randint(0, 3) for _ in range(n)]
    if kind == "double":
        return [draw.choice([1e-300, 1.0, -1e300, math.inf, 3.5, draw.random()]) for _ in range(n)]
    return [draw.choice([7, 7, 7, draw.randint(0, 10**6)]) / 100 for _ in range(n)]


@pytest.mark.parametrize("few,buckets,passes", [(10_000, 4096, 6), (3, 4, 30), (0, 2, 2)])
@pytest.mark.parametrize("kind", ["bigint", "double", "decimal(12,2)"])
def test_rank_quantiles_by_selection(spark, monkeypatch, kind, few, buckets, passes):
    """With few rows left, over many narrow passes, and after passes that did not part the values."""
    monkeypatch.setattr(timeseries, "FEW", few)
    monkeypatch.setattr(timeseries, "BUCKETS", buckets)
    monkeypatch.setattr(timeseries, "PASSES", passes)
    draw = random.Random(few)
    groups = {"a": values_of(kind, draw, 150), "b": [values_of(kind, draw, 1)[0]] * 40, "c": values_of(kind, draw, 1), None: values_of(kind, draw, 33)}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("a", None), ("z", None)]
    df = spark.createDataFrame(rows, "k string, v double").withColumn("v", F.col("v").cast(kind)).repartition(3)
    found = {r.k: r for r in rank_quantiles(df, ["k"], "v", SHARES).collect()}
    assert set(found) == set(groups)
    for k, vs in groups.items():
        for name, p in SHARES.items():
            assert same(found[k][name], by_rank(vs, p)), (k, name)
    everything = [v for vs in groups.values() for v in vs]
    (whole,) = rank_quantiles(df, [], "v", SHARES).collect()
    for name, p in SHARES.items():
        assert same(whole[name], by_rank(everything, p)), name
    (none,) = rank_quantiles(df.where("v is null"), [], "v", {"half": 0.5}).collect()
    assert none.half is None


@needs_data
def test_selection_shuffles_no_rows_of_the_history(spark):
    plan = QUERIES["rank_quantiles_global"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    # What is left is within the bounds of one bucket before it is dealt by value.
    assert "BroadcastNestedLoopJoin" in plan and "l_extendedprice" in plan


@pytest.mark.parametrize("half,chunk_rows", [(1, 1), (2, 16), (5, 40), (60, 1 << 18)])
def test_block_minima(spark, half, chunk_rows):
    draw = random.Random(half)
    series = {k: [draw.choice([None, draw.randint(0, 30), draw.randint(0, 30)]) for _ in range(n)] for k, n in (("a", 300), ("b", 2 * half + 1), (None, 77), ("c", 3))}
    rows = [(k, t, v) for k, vs in series.items() for t, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "k string, t int, v int").repartition(4)
    found = centred_minima(with_slice(df, ["k", "t"]), ["k"], "t", "v", half, chunk_rows)
    want = []
    for k, vs in series.items():
        for t in range(half, len(vs) - half):
            seen = [v for v in vs[t - half : t + half + 1] if v is not None]
            want.append((k, t, vs[t], min(seen, default=None)))
    got = [tuple(r) for r in found.select("k", "t", "v", "__low").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    for gap in (None, 4):
        both = [
            sorted(map(tuple, local_minima(df.where("v is not null"), ["k"], "t", "v", half, gap, small).collect()), key=repr)
            for small in (True, False)
        ]
        assert both[0] == both[1]


def test_previous_row_crosses_slices(spark):
    rows = [(k, t, t * 10) for k in ("a", "b", None) for t in range(0, 400, 3)]
    df = spark.createDataFrame(rows, "k string, t int, v int").repartition(5)
    found = previous_row(with_slice(df, ["k", "t"]), ["k"], "t", {"before": "v", "at": "t"})
    assert found.select("__slice").distinct().count() > 2
    for r in found.collect():
        assert (r.before, r.at) == ((r.v - 30, r.t - 3) if r.t else (None, None))


@needs_data
@pytest.mark.parametrize("name,scans", [("trough_intervals_daily", 2), ("local_minima_daily", 2), ("wide_minima_daily", 2)])
def test_minima_read_the_source_twice_at_most(spark, name, scans):
    before = _actions(spark)
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet", plan)) <= scans
    assert _actions(spark) - before <= 3  # a count and a sample for the cut points, the settled hits


def _actions(spark) -> int:
    """Queries run so far; reading a plan is none."""
    return spark._jsparkSession.sharedState().statusStore().executionsCount()


@pytest.mark.parametrize("n", [0, 1, 40, 600])
def test_asof_join(spark, n):
    draw = random.Random(n)
    keys = ["a"] * 6 + ["b", None]
    left = [(k, draw.choice(keys), draw.choice([None, *range(30)])) for k in range(n)] + [(n, "a", 15)] * 3
    right = [(draw.choice(keys), draw.choice([None, *range(0, 30, 2)]), draw.choice([None, draw.randint(0, 5)])) for _ in range(n)]
    a = spark.createDataFrame(left, "id int, k string, t int").repartition(4)
    b = spark.createDataFrame(right, "k string, s int, price int").repartition(3)
    found = sorted(map(tuple, asof_join(a, b, ["k"], "t", "s", ["s", "price"]).select("id", "k", "t", "s", "price").collect()), key=repr)
    want = []
    for i, k, t in left:
        met = [(s, -1 if p is None else p) for key, s, p in right if key == k and None not in (k, s, t) and s <= t]
        s, p = max(met, default=(None, None))
        want.append((i, k, t, s, None if p == -1 else p))
    assert found == sorted(want, key=repr)


@needs_data
def test_asof_join_confines_no_key(spark):
    plan = QUERIES["orders_asof_prices"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for window in re.findall(r"Window \[(.*)", plan):
        assert "__slice" in window
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("width", [1, 60, 86_400])
def test_interval_join(spark, width):
    draw = random.Random(width)
    hour = 3600
    facts = [(k, draw.choice([None, draw.randint(0, 200 * hour)])) for k in range(150)] + [(999, 100 * hour)] * 5
    spans = []
    for k in range(60):
        begin = draw.randint(-50 * hour, 220 * hour)
        spans.append((k, draw.choice([None, begin, begin, begin]), draw.choice([None, begin, begin + draw.randint(-10, 10**draw.randint(1, 6))])))
    spans += [(100, 100 * hour, 100 * hour)] * 2 + [(101, -(10**9), None), (102, 10**9, None)]

    def at(c):
        return F.timestamp_seconds(c).alias(c)

    a = spark.createDataFrame(facts, "id int, t long").select("id", at("t"))
    b = spark.createDataFrame(spans, "span int, begins long, ends long").select("span", at("begins"), at("ends"))
    joined = interval_join(a, b, "t", "begins", "ends", width)
    want = sorted((i, s) for i, t in facts for s, x, y in spans if None not in (t, x) and x <= t and (y is None or t <= y))
    assert sorted((r.id, r.span) for r in joined.select("id", "span").collect()) == want
    assert interval_join(a.where("false"), b, "t", "begins", "ends", width).count() == 0
    assert interval_join(a, b.where("false"), "t", "begins", "ends", width).count() == 0


def test_interval_join_deals_the_facts_of_wide_spans(spark):
    """All facts lie in two buckets of a wider level; no task gets half of them, nor a level without spans."""
    held = {"spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(8000).select("id", F.timestamp_seconds(F.col("id") * 45).alias("t"))
        spans = spark.range(3).select(F.col("id").alias("span"), F.timestamp_seconds(F.lit(0)).alias("begins"), F.lit(None).cast("timestamp").alias("ends"))
        joined = interval_join(facts, spans, "t", "begins", "ends")
        counts = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(counts) == 24_000 and max(counts) < 12_000


def test_interval_join_deals_a_single_file_of_facts(spark):
    """Also where the spans are broadcast."""
    facts = spark.range(2000, numPartitions=1).select("id", F.timestamp_seconds(F.col("id") * 45).alias("t"))
    spans = spark.range(3).select(F.timestamp_seconds(F.lit(0)).alias("begins"), F.lit(None).cast("timestamp").alias("ends"))
    joined = interval_join(facts, F.broadcast(spans), "t", "begins", "ends")
    counts = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(counts) == 6000 and len(counts) > 1


def test_interval_join_lays_pairs_close(spark, tmp_path):
    """Pairs of few facts and few spans lie together, so that a file of very many pairs needs few bytes for each."""
    facts = spark.range(6000).select("id", F.timestamp_millis(F.col("id") * 7919 % 3_600_000).alias("t"))
    begins = F.col("id") * 104_729 % 3_600_000
    spans = spark.range(6000).select(
        F.col("id").alias("span"),
        F.timestamp_millis(begins).alias("begins"),
        F.when(F.col("id") % 5 != 0, F.timestamp_millis(begins + F.col("id") * 31 % 3_000_000)).alias("ends"),
    )
    joined = interval_join(facts, spans, "t", "begins", "ends").select("id", "span")
    joined.coalesce(1).write.parquet(out := f"{tmp_path}/pairs", compression="snappy")
    inside = (F.col("begins") <= F.col("t")) & (F.col("ends").isNull() | (F.col("t") <= F.col("ends")))
    pairs = facts.join(spans, inside).count()
    assert spark.read.parquet(out).count() == pairs > 1_000_000
    assert sum(f.stat().st_size for f in Path(out).glob("*.parquet")) < 0.5 * pairs


@needs_data
def test_interval_join_has_an_equality_key(spark):
    plan = QUERIES["events_in_promotions"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    joins = re.findall(r"(\w*Join\w*) (.*)", plan)
    assert not [j for j in joins if "NestedLoop" in j[0] and "__bucket" not in j[1] and "Cross" not in j[1]]
    assert any("__bucket" in rest for _, rest in joins)


def test_intervals_use_up_the_slices(spark):
    rows = [("a", t, abs(t % 20 - 10)) for t in range(200)]
    df = spark.createDataFrame(rows, "k string, t int, v int")
    found = intervals(local_minima(df, ["k"], "t", "v", 5, 7, keep_slice=True), ["k"], "t", "previous", "gap")
    assert found.columns == ["k", "t", "v", "previous", "gap"]
    assert [(r.t, r.gap) for r in found.orderBy("t").collect()][:3] == [(10, None), (30, 20), (50, 20)]


def test_rank_quantiles_shuffle_no_rows_of_hot_keys(spark, monkeypatch):
    """Two keys hold all rows but a few; the rows that a task reads of a shuffle stay far below a key's."""
    monkeypatch.setattr(timeseries, "FEW", 100)
    n = 40_000
    df = spark.range(n, numPartitions=8).selectExpr("if(id % 400 = 0, 'few' || id % 7, if(id % 2 = 0, 'a', 'b')) as k", "(id * 7919) % 30011 as v")
    plans = []
    inside = timeseries._inside

    def kept(rows, state, keys, *more):
        found = inside(rows, state, keys, *more)
        largest = found.groupBy("k", F.spark_partition_id()).count().agg(F.max("count")).head()[0]
        plans.append(largest)
        return found

    monkeypatch.setattr(timeseries, "_inside", kept)
    found = {r.k: r for r in rank_quantiles(df, ["k"], "v", SHARES).collect()}
    assert plans and max(plans) <= len(SHARES) * n // 8 // 2
    values = {}
    for k, v in df.collect():
        values.setdefault(k, []).append(v)
    for k, vs in values.items():
        vs.sort()
        for name, p in SHARES.items():
            below = next(i for i, v in enumerate(vs) if i / (len(vs) - 1) >= p and (i == 0 or vs[i - 1] != v))
            assert found[k][name] == vs[below], (k, name)
