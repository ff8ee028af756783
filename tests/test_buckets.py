"""Lookups over stored buckets say what the plain lookup says, and move no rows."""

import pytest

from ledgerloom.operators.joins import processor_id_lookup
from ledgerloom.sources.buckets import KEY, bucketed_id_lookup, store_bucketed, store_ids

BUCKETS = 4


@pytest.fixture
def tables(spark):
    ids = ["a1", "A1 ", "b2", None, "", "c3", "c3", None, "zz", "\n1"]
    ledger = spark.createDataFrame([(i, x, f"n{i}") for i, x in enumerate(ids)] + [(90 + i, None, "same") for i in range(9)], "n INT, ref STRING, id STRING")
    report = spark.createDataFrame([(x,) for x in ["A1", "a1", "B2", "b2", None, "", "c3", "c3", "other"]], "txn STRING")
    return ledger, report


def stored(tables):
    ledger, report = tables
    return store_bucketed(ledger, "ledger", "ref", BUCKETS), store_ids(report, "ids", "txn", BUCKETS)


def test_equals_the_plain_lookup(spark, tables):
    got = bucketed_id_lookup(*stored(tables), "ref")
    want = processor_id_lookup(*tables, "ref", "txn")
    assert sorted(map(tuple, got.select(want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_empty_tables(tables):
    ledger, report = tables
    none = stored((ledger.limit(0), report.limit(0)))
    assert bucketed_id_lookup(*none, "ref").count() == 0
    assert {r[0] for r in bucketed_id_lookup(stored(tables)[0], none[1], "ref").select("processor_txn_id").collect()} == {""}


def test_no_exchange(spark, tables, capsys):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bucketed_id_lookup(*stored(tables), "ref").explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert "Exchange" not in plan and "Aggregate" not in plan


def test_rows_without_id_are_spread(tables):
    ledger, _ = stored(tables)
    assert ledger.where("ref is null").select(KEY).distinct().count() > 1
