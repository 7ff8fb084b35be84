"""Lot balances by period and stepwise allocation over the published store."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from shelflife.operators import allocation as M10
from shelflife.operators import inventory as M
from shelflife.operators import staging as J
from shelflife.sources import allocation_steps as steps
from shelflife.sources import balances as Q
from shelflife.sources import files as A

DATES = [dt.date(1994, 1, 1), dt.date(1995, 9, 30), dt.date(1996, 12, 31)]


@pytest.fixture(scope="module")
def store(spark, small):
    return A.full_refresh(spark, small, A.scratch_path(spark, "test-balances"), validate=False, unit="year", buckets=2)


@pytest.fixture(scope="module")
def root(spark, store):
    folder = A.scratch_path(spark, "balances")
    Q.build(store, folder)
    return folder


def same(a, b):
    rows = lambda df: sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=str)
    assert sorted(a.columns) == sorted(b.columns)
    assert rows(a) == rows(b)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("day", DATES)
def test_stock_and_writeoffs_at_a_date(spark, small, root, day):
    stock, gone = Q.stock_on_hand(spark, root, day, "year"), Q.expiry_writeoffs(spark, root, day, "year")
    same(stock, M.stock_on_hand(small, day))
    same(gone, M.expiry_writeoffs(small, day))
    for df in (stock, gone):
        text = plan(df)
        assert "PartitionFilters: [isnotnull(period" in text and "fact_" not in text
    # both scans of the stock read one period alone
    filters = re.findall(r"PartitionFilters: \[([^]]*)]", plan(stock))
    assert len(filters) == 2 and all(re.search(rf"\(period#\d+ = {day.year}-01-01\)", f) for f in filters)


def test_writeoffs_since_a_day(spark, small, root):
    since, day = dt.date(1995, 3, 1), dt.date(1995, 9, 30)
    got = Q.expiry_writeoffs(spark, root, day, "year", since)
    same(got, M.expiry_writeoffs(small, day).where(F.col("adjustment_date") >= F.lit(since)))
    assert "<= 1995-01-01)" in plan(got) and ">= 1995-01-01)" in plan(got)


def test_ageing_from_stored_positions(spark, small, root):
    day = DATES[1]
    same(J.inventory_aging(small, day, Q.positions(spark, root, day, "year")), J.inventory_aging(small, day))


def test_a_period_added_equals_the_whole_build(spark, small, store, root):
    part = A.scratch_path(spark, "balances-part")
    period = dt.date(1996, 1, 1)
    Q.build(store, part, until=period)
    assert period not in {r[0] for r in Q._read(spark, part, "snapshots").select("period").distinct().collect()}
    Q.advance(store, part, period)
    Q.advance(store, part, period)      # a step that is run again changes nothing
    now = F.col("period") == F.lit(period)
    for name in ("movements", "snapshots", "expired"):
        same(Q._read(spark, part, name).where(now), Q._read(spark, root, name).where(now))
    with pytest.raises(ValueError):
        Q.advance(store, part, dt.date(1997, 2, 1))


def test_steps_equal_the_whole_allocation(spark, small, store, monkeypatch):
    folder = A.scratch_path(spark, "test-steps")
    assert steps.allocated(spark, folder).count() == 0 and steps.open_lots(spark, folder).count() == 0
    read = []
    between = type(store).between
    monkeypatch.setattr(type(store), "between", lambda self, *a: read.append(between(self, *a)) or read[-1])
    steps.step(store, folder, dt.date(1995, 1, 1))
    read.clear()
    # a killed step: its log row was never written
    with monkeypatch.context() as m:
        m.setattr(steps.time, "time_ns", lambda: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            steps.step(store, folder, dt.date(1996, 1, 1))
    assert len(steps.steps(spark, folder)) == 1
    steps.step(store, folder, dt.date(2100, 1, 1))
    with pytest.raises(ValueError):
        steps.step(store, folder, dt.date(1996, 1, 1))
    whole = M10.batch_allocation_dated(small)
    same(steps.allocated(spark, folder), whole)
    # the later steps read no earlier period
    assert all(f.split("period=")[1][:4] >= "1995" for df in read for f in df.inputFiles())


def test_open_lots_hold_what_was_not_taken(spark, small, store):
    folder, end = A.scratch_path(spark, "test-open"), dt.date(1996, 1, 1)
    steps.step(store, folder, end)
    taken = steps.allocated(spark, folder).groupBy("batch_id").agg(F.sum("quantity_from_batch").alias("q"))
    lots = (small["fact_goods_receipts"].where((F.col("receipt_date") < F.lit(end)) & (F.col("expiry_date") > F.lit(end)))
            .join(taken, "batch_id", "left")
            .select("batch_id", "warehouse_id", "product_id", "expiry_date",
                    (F.col("quantity_received") - F.coalesce("q", F.lit(0))).alias("units_left")).where("units_left > 0"))
    same(steps.open_lots(spark, folder), lots)


def test_snapshots_are_dealt_out_once(spark):
    lots = spark.createDataFrame(
        [("B1", "W1", "P1", dt.date(1994, 12, 30), dt.date(1996, 1, 5), 9, dt.date(y, 1, 1), 0) for y in (1994, 1995, 1996)]
        + [("B2", "W1", "P1", dt.date(1995, 2, 1), dt.date(1995, 2, 9), 4, dt.date(1995, 1, 1), 0)],
        Q.LOT + ", period date, q long")
    moves = spark.createDataFrame([("B1", dt.date(1994, 1, 1), 2), ("B1", dt.date(1995, 1, 1), 3), ("B1", dt.date(1995, 1, 1), 1),
                                   ("B3", dt.date(1995, 1, 1), 7)], "batch_id string, period date, q long")
    got = Q._before(lots, moves)
    assert plan(got).count("Exchange") == 1
    assert sorted((r["batch_id"], r["period"].year, r["out_before"]) for r in got.collect()) == [
        ("B1", 1994, 0), ("B1", 1995, 2), ("B1", 1996, 6), ("B2", 1995, 0)]


def test_balances_are_built_for_the_queries_that_read_them(spark, monkeypatch):
    from shelflife.plans import registry
    built = []
    monkeypatch.setattr(registry, "_BALANCES", {})
    monkeypatch.setattr(registry.balances, "build", lambda store, root, build=Q.build: built.append(root) or build(store, root))
    margin = registry.gross_margin_published(spark, "/root/testdata/sf0.001").count()
    assert margin and not built
    assert registry.stock_on_hand_snapshot(spark, "/root/testdata/sf0.001").count()
    assert registry.expiry_writeoffs_snapshot(spark, "/root/testdata/sf0.001").count() and len(built) == 1


def test_units_gone_before_the_expiry_come_with_the_snapshot(spark):
    """One dealing gives what left a lot before a period and, in the period of its expiry, until that day."""
    day = lambda *x: dt.date(*x)
    lots = spark.createDataFrame(
        [(b, "W1", "P1", day(1994, 12, 30), day(1995, 1, 5), 9, day(y, 1, 1), 0) for b in ("B1", None) for y in (1994, 1995)]
        + [("B2", "W1", "P1", day(1995, 2, 1), day(1995, 2, 9), 4, day(1995, 1, 1), 0)], Q.LOT + ", period date, q long")
    moves = spark.createDataFrame(
        [("B1", day(1994, 1, 1), 2, day(1994, 12, 31)), ("B1", day(1995, 1, 1), 3, day(1995, 1, 4)),
         ("B1", day(1995, 1, 1), 1, day(1995, 1, 5)), (None, day(1995, 1, 1), 5, day(1995, 1, 2)), ("B3", day(1995, 1, 1), 7, day(1995, 1, 2))],
        "batch_id string, period date, q long, day date")
    got = Q._before(lots, moves)
    assert plan(got).count("Exchange") == 1
    assert sorted(((r["batch_id"], r["period"].year, r["out_before"], r["out_unexpired"]) for r in got.collect()), key=str) == [
        ("B1", 1994, 0, 2), ("B1", 1995, 2, 3), ("B2", 1995, 0, None), (None, 1994, 0, None), (None, 1995, 0, None)]


def test_balances_by_year_are_written_where_they_are_made(spark, small, store, monkeypatch):
    written = []
    monkeypatch.setattr(Q, "in_periods", lambda df, unit, n, order, f=Q.in_periods: written.append(f(df, unit, n, order)) or written[-1])
    folder = A.scratch_path(spark, "test-where")
    Q.build(store, folder)
    # movements, snapshots, expired, positions: no ranges, and what ran out is a scan of the snapshots
    assert len(written) == 4 and not any("rangepartitioning" in plan(df) for df in written)
    assert "Exchange" not in plan(written[2])
    same(Q.expiry_writeoffs(spark, folder, DATES[2], "year"), M.expiry_writeoffs(small, DATES[2]))
