"""Ordered operators against brute force, with one key holding a third of all rows or more."""

from __future__ import annotations

import random
from bisect import bisect_left
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.ordered import rows_frame, running_before
from ledgerlake.operators.timeseries import (
    asof_lookback,
    latest_by,
    local_minima,
    percentile_of,
    rank_quantiles,
    value_percentiles,
    with_lag,
    with_percentile,
)

SMALL = pytest.mark.parametrize("small_groups", [False, True])


@pytest.fixture(scope="module")
def data():
    rng = random.Random(7)
    rows = []
    for key, n in (("hot", 1500), ("a", 400), ("b", 300), ("c", 7), ("d", 1)):
        steps = sorted(rng.sample(range(10_000), n))
        # small integers, so equal values are common; half of the hot key is one value
        rows += [(key, t, 5 if key == "hot" and rng.random() < 0.5 else rng.randrange(40)) for t in steps]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def df(spark, data):
    return spark.createDataFrame(data, "k string, t int, v int").repartition(6)


@pytest.fixture(scope="module")
def groups(data):
    out = defaultdict(list)
    for k, t, v in sorted(data):
        out[k].append((t, v))
    return out


@SMALL
def test_running_before(df, groups, small_groups):
    got = {(r.k, r.t): r.s for r in running_before(df, ["k"], ["t"], F.col("v"), "s", small_groups).collect()}
    for k, rows in groups.items():
        total = 0
        for t, v in rows:
            assert got[k, t] == total
            total += v
    assert len(got) == sum(map(len, groups.values()))


def test_running_before_without_keys(df, data):
    got = {(r.k, r.t): r.s for r in running_before(df, [], ["t", "k"], F.lit(1), "s").collect()}
    for i, (t, k) in enumerate(sorted((t, k) for k, t, _ in data)):
        assert got[k, t] == i


@SMALL
def test_rows_frame(df, groups, small_groups):
    frames = {"low": (F.min("v"), -3, 3), "n": (F.count(F.lit(1)), -3, 3), "ahead": (F.max("v"), 2, 2)}
    out = rows_frame(df, ["k"], ["t"], frames, small_groups, chunk_rows=50).collect()
    got = {(r.k, r.t): (r.low, r.n, r.ahead) for r in out}
    assert len(out) == len(got) == sum(map(len, groups.values()))
    for k, rows in groups.items():
        for i, (t, _) in enumerate(rows):
            near = [v for _, v in rows[max(0, i - 3) : i + 4]]
            ahead = rows[i + 2][1] if i + 2 < len(rows) else None
            assert got[k, t] == (min(near), len(near), ahead)


@SMALL
def test_lag(df, groups, small_groups):
    got = {(r.k, r.t): r.p for r in with_lag(df, ["k"], "t", {"p": "v"}, 5, small_groups).collect()}
    for k, rows in groups.items():
        for i, (t, _) in enumerate(rows):
            assert got[k, t] == (rows[i - 5][1] if i >= 5 else None)


@SMALL
@pytest.mark.parametrize("gap", [None, 30])
def test_local_minima(df, groups, small_groups, gap):
    got = {(r.k, r.t) for r in local_minima(df, ["k"], "t", "v", 4, gap, small_groups).collect()}
    want = set()
    for k, rows in groups.items():
        hits = [
            t for i, (t, v) in enumerate(rows)
            if 4 <= i < len(rows) - 4 and v == min(x for _, x in rows[i - 4 : i + 5])
        ]
        want |= {(k, t) for i, t in enumerate(hits) if gap is None or i == 0 or t - hits[i - 1] > gap}
    assert got == want and want


def share(values, v):
    return sum(x < v for x in values) / (len(values) - 1) if len(values) > 1 else 0.0


@SMALL
def test_percentiles_per_key(df, groups, small_groups):
    got = {(r.k, r.t): (r.pctile, r.n_obs) for r in with_percentile(df, ["k"], "v", small_groups).collect()}
    for k, rows in groups.items():
        values = [v for _, v in rows]
        for t, v in rows:
            assert got[k, t] == (share(values, v), len(values))


def test_percentiles_global(df, data):
    values = [v for *_, v in data]
    got = {r.v: (r.n, r.pctile) for r in value_percentiles(df, [], "v").collect()}
    assert got == {v: (values.count(v), share(values, v)) for v in set(values)}


@pytest.mark.parametrize("hot", [0.0, None])
def test_percentiles_send_no_hot_value_to_one_task(spark, hot):
    """A third of the rows, identical ones, hold one value; as a null key too."""
    key = "b" if hot is not None else None
    rows = [(key, 7.0)] * 4000 + [("b" if k % 2 else key, k / 7) for k in range(8000)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(8)
    adaptive = "spark.sql.adaptive.enabled"
    spark.conf.set(adaptive, "false")
    try:
        got = with_percentile(df, ["k"], "v").withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set(adaptive, "true")
    tasks = Counter(r.task for r in got)
    assert max(tasks.values()) < 2 * len(rows) / 4  # four shuffle partitions
    assert max(Counter(r.task for r in got if r.v == 7.0).values()) < 1000  # where they were, over eight
    values = {k: sorted(v for key, v in rows if key == k) for k in {k for k, _ in rows}}
    assert Counter((r.k, r.v, r.pctile, r.n_obs) for r in got) == Counter(
        (k, v, bisect_left(values[k], v) / (len(values[k]) - 1), len(values[k])) for k, v in rows
    )


def test_percentiles_skip_missing_values(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "v double")
    assert {r.v: (r.pctile, r.n_obs) for r in with_percentile(df, [], "v").collect()} == {1.0: (0.0, 2), 3.0: (1.0, 2)}


@SMALL
def test_rank_quantiles(df, groups, small_groups):
    got = {r.k: (r.q1, r.q3) for r in rank_quantiles(df, ["k"], "v", {"q1": 0.25, "q3": 0.75}, small_groups).collect()}
    for k, rows in groups.items():
        values = [v for _, v in rows]
        want = tuple(min((v for v in values if share(values, v) >= p), default=None) for p in (0.25, 0.75))
        assert got[k] == want


def test_percentile_of_one_value(df, groups):
    newest = latest_by(df, ["k"], ["t"]).select("k", F.col("v").alias("now"))
    got = {r.k: (r.now, r.pctile, r.n_obs, r.first) for r in
           percentile_of(df, ["k"], "v", newest, "now", {"first": F.min("t")}).collect()}
    for k, rows in groups.items():
        values = [v for _, v in rows]
        assert got[k] == (values[-1], share(values, values[-1]), len(values), rows[0][0])


def test_latest_by_takes_the_newest_rows(df, groups):
    got = defaultdict(set)
    for r in latest_by(df, ["k"], ["t"], rows=3).collect():
        got[r.k].add(r.t)
    assert got == {k: {t for t, _ in rows[-3:]} for k, rows in groups.items()}


def test_hot_key_leaves_each_partition_as_one_row(df):
    plan = latest_by(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_asof_lookback(spark):
    df = spark.sql(
        "select * from values ('x', date'2026-01-31', 1.0D), ('x', date'2026-02-27', 2.0D), ('x', date'2026-03-31', 3.0D),"
        " ('y', date'2026-03-01', 9.0D) as t(k, d, v)"
    )
    offsets = {"m1": ("months", 1), "d60": ("days", 60), "m12": ("months", 12)}
    got = {r.k: (r.latest_value, r.m1, r.d60, r.m12) for r in asof_lookback(df, ["k"], "d", "v", offsets).collect()}
    assert got == {"x": (3.0, 2.0, None, None), "y": (9.0, None, None, None)} or got == {
        "x": (3.0, 2.0, 1.0, None), "y": (9.0, None, None, None)
    }
    # 2026-03-31 minus 60 days is 2026-01-30, a day before the first row
    assert got["x"][2] is None


@pytest.mark.parametrize("kind", ["decimal(12,2)", "double"])
def test_both_plans_agree_on_null_keys_and_fractions(spark, kind):
    rows = [(k, t, t * 1.25) for t in range(300) for k in (None, "a", "b")[: 1 + t % 3]]
    df = spark.createDataFrame(rows, "k string, t int, v double").withColumn("v", F.col("v").cast(kind)).repartition(5)

    def both(run):
        plans = [run(small) for small in (True, False)]
        assert plans[0].schema == plans[1].schema
        found = [sorted(map(tuple, plan.collect()), key=repr) for plan in plans]
        assert found[0] == found[1]
        return found[0]

    ran = both(lambda small: running_before(df, ["k"], ["t"], F.col("v"), "s", small))
    assert len(ran) == len(rows) and any(float(r[3]) % 1 for r in ran)
    assert len(both(lambda small: with_percentile(df, ["k"], "v", small))) == len(rows)
    assert len(both(lambda small: with_lag(df, ["k"], "t", {"p": "v"}, 3, small))) == len(rows)
