"""What must not grow with the tables: rows sent through the driver, a task's memory, partitions of cells."""

import pytest

from monthgrain.plans import warehouse
from monthgrain.plans.warehouse import BucketedPanel
from monthgrain.sources import panel


@pytest.fixture
def lines(spark, small):
    """The panel's cells as a plan of their own, closed after the test."""
    own = panel.Panel(spark, small)
    yield lambda: own.lines
    own.close()


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_dimension_of_many_rows_is_not_broadcast(lines, monkeypatch):
    monkeypatch.setattr(panel, "FEW_ROWS", 10, raising=False)
    assert "BroadcastHashJoin" not in _plan(lines())


def test_dimension_of_few_rows_is_broadcast(lines):
    assert "BroadcastHashJoin" in _plan(lines())


def test_shuffled_dimensions_give_the_same_cells(spark, small, monkeypatch):
    few = panel.Panel(spark, small)
    rows = {tuple(r) for r in few.lines.collect()}
    few.close()
    monkeypatch.setattr(panel, "FEW_ROWS", 10, raising=False)
    many = panel.Panel(spark, small)
    assert {tuple(r) for r in many.lines.collect()} == rows
    many.close()


def test_buckets_hold_few_bytes(spark, small, monkeypatch):
    monkeypatch.setattr(warehouse.panel, "stamp", lambda *_: (("lineitem.parquet", 6 << 30, 0), ("orders.parquet", 1 << 30, 0)))
    assert (6 << 30) / BucketedPanel(spark, small, "unused").buckets <= 32 << 20


def test_cells_are_kept_in_few_partitions(spark, small, monkeypatch):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        own = panel.Panel(spark, small)
        assert own.lines.rdd.getNumPartitions() <= 8 and own.orders.rdd.getNumPartitions() <= 8
        own.close()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
