from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.history import current_rows, first_history, scd2_merge, status_counts


def history_of(spark, *batches):
    """batches: (day, {lead: status}); returns sorted (lead, status, from, to)."""
    history = None
    for day, leads in batches:
        snapshot = spark.createDataFrame(list(leads.items()), "lead_id int, status string")
        at = F.lit(day)
        history = (
            first_history(snapshot, at) if history is None else scd2_merge(history, snapshot, ["lead_id"], ["status"], at)
        )
    return history


def spans(history):
    rows = [(r.lead_id, r.status, str(r.valid_from.date()), r.valid_to and str(r.valid_to.date())) for r in history.collect()]
    return sorted(rows, key=lambda r: (r[0], r[2]))


def test_change_closes_and_opens(spark):
    got = spans(history_of(spark, ("2026-01-01", {1: "warm", 2: "warm"}), ("2026-02-01", {1: "sent", 2: "warm", 3: "new"})))
    assert got == [
        (1, "warm", "2026-01-01", "2026-02-01"), (1, "sent", "2026-02-01", None),
        (2, "warm", "2026-01-01", None), (3, "new", "2026-02-01", None),
    ]


def test_rerun_changes_nothing(spark):
    batches = [("2026-01-01", {1: "warm"}), ("2026-02-01", {1: "sent"})]
    assert spans(history_of(spark, *batches, ("2026-03-01", {1: "sent"}))) == spans(history_of(spark, *batches))


def test_status_may_return(spark):
    got = spans(history_of(spark, ("2026-01-01", {1: "a"}), ("2026-02-01", {1: "b"}), ("2026-03-01", {1: "a"})))
    assert [g[1:] for g in got] == [("a", "2026-01-01", "2026-02-01"), ("b", "2026-02-01", "2026-03-01"), ("a", "2026-03-01", None)]


def test_null_is_a_status_of_its_own(spark):
    got = spans(history_of(spark, ("2026-01-01", {1: None, 2: "a"}), ("2026-02-01", {1: None, 2: None})))
    assert got == [(1, None, "2026-01-01", None), (2, "a", "2026-01-01", "2026-02-01"), (2, None, "2026-02-01", None)]


def test_vanished_lead_stays_open(spark):
    got = spans(history_of(spark, ("2026-01-01", {1: "a", 2: "b"}), ("2026-02-01", {2: "b"})))
    assert (1, "a", "2026-01-01", None) in got


@pytest.mark.parametrize("top", [1, 10])
def test_open_status_counts(spark, top):
    history = history_of(spark, ("2026-01-01", {1: "a", 2: "a", 3: "b"}), ("2026-02-01", {1: "b", 2: "a", 3: "b"}))
    assert current_rows(history).count() == 3
    assert [(r.status, r.leads) for r in status_counts(history, top=top).collect()] == [("b", 2), ("a", 1)][:top]
