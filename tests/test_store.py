"""The published store: layout, co-located joins, date ranges, sessions and killed loads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelflife.operators import analytics as K
from shelflife.operators import marts as L
from shelflife.sources import files as A
from shelflife.sources import store as S


@pytest.fixture(scope="module")
def root(spark, small):
    folder = A.scratch_path(spark, "test-layout")
    A.full_refresh(spark, small, folder, unit="year", buckets=4)
    return folder


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_tables_are_the_same(spark, small, root):
    t = A.load_current(spark, root)
    for n in t:
        assert t[n].columns == small[n].columns
        assert t[n].exceptAll(small[n]).count() == 0 and small[n].exceptAll(t[n]).count() == 0


@pytest.mark.parametrize("query", [K.gross_margin_by_category_month, K.gross_margin_allocated, L.margin_by_month])
def test_sales_meet_the_bridge_without_exchange(spark, small, root, query):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    was = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = query(A.load_current(spark, root))
        assert "hashpartitioning(sale_id" not in plan(got)
        assert plan(got).count("Bucketed: true") >= 2
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, query(small).collect()), key=str)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_date_range_reads_its_periods_alone(spark, small, root):
    t = A.load_current(spark, root)
    start, end = dt.date(1994, 3, 1), dt.date(1995, 2, 1)
    for n, c in (("fact_sales", "sale_date"), ("fact_goods_receipts", "receipt_date")):
        got = t.between(n, start, end)
        want = small[n].where((F.col(c) >= F.lit(start)) & (F.col(c) < F.lit(end)))
        assert got.count() == want.count() and got.exceptAll(want).count() == 0
        assert "PartitionFilters: [isnotnull(period" in plan(got)
        files = {f.split("period=")[1][:4] for f in got.inputFiles()}
        assert files <= {"1994", "1995"}


def test_bridge_lies_in_its_sales_period(spark, small, root):
    t = A.load_current(spark, root)
    start, end = dt.date(1994, 1, 1), dt.date(1995, 1, 1)
    got = t.between("fact_sale_batch_map", start, end)
    ids = small["fact_sales"].where(F.year("sale_date") == 1994).select("sale_id")
    want = small["fact_sale_batch_map"].join(ids, "sale_id", "left_semi").select(got.columns)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_another_session_finds_the_layout(spark, root):
    """A catalog that never saw the tables registers them from the folder alone."""
    folder = A.load_current(spark, root).folder
    rows = A.load_current(spark, root)["fact_sales"].count()
    S.forget_store(spark, folder)
    t = S.load_store(spark, folder)
    joined = t["fact_sales"].hint("merge").join(t["fact_sale_batch_map"], "sale_id")
    assert t["fact_sales"].count() == rows and "hashpartitioning(sale_id" not in plan(joined)
    assert "Bucketed: true" in plan(joined)


def test_a_killed_refresh_leaves_the_old_version(spark, small, root, monkeypatch):
    before = A.load_current(spark, root).folder

    def killed(*a, **k):
        raise KeyboardInterrupt
    monkeypatch.setattr(A, "violations", killed)
    with pytest.raises(KeyboardInterrupt):
        A.full_refresh(spark, small, root, unit="year", buckets=4)
    t = A.load_current(spark, root)
    assert t.folder == before and t["fact_sales"].count() == small["fact_sales"].count()


def test_a_half_written_version_is_refused(spark, small, monkeypatch):
    folder = A.scratch_path(spark, "test-half")
    broken = small.replace(fact_sales=small["fact_sales"].withColumn("sale_date", F.raise_error(F.lit("lost")).cast("date")))
    with pytest.raises(Exception, match="lost"):
        S.save_store(spark, broken, folder, "year", 2)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        S.load_store(spark, folder)
    S.forget_store(spark, folder)


def test_periods():
    day = dt.date(2024, 11, 30)
    assert [S.first_day(day, u) for u in S.UNITS] == [dt.date(2024, 11, 1), dt.date(2024, 10, 1), dt.date(2024, 1, 1)]
    assert [S.next_period(day, u) for u in S.UNITS] == [dt.date(2024, 12, 1), dt.date(2025, 1, 1), dt.date(2025, 1, 1)]
    with pytest.raises(ValueError):
        S.period_of("d", "week")


def test_stored_tables_are_packed(spark, small):
    import glob
    store = A.full_refresh(spark, small, A.scratch_path(spark, "test-packed"), validate=False, unit="year", buckets=2)
    for name in ("dim_products", "fact_sales", "fact_goods_receipts"):
        files = glob.glob(f"{store.folder.removeprefix('file:')}/{name}/**/*.parquet", recursive=True)
        assert files and all(".zstd." in f for f in files)


def test_years_are_written_without_an_exchange(spark, small):
    rows = small["fact_goods_receipts"].withColumn(S.PERIOD, S.period_of("receipt_date", "year"))
    assert "Exchange" not in plan(S.in_periods(rows, "year", 4, "receipt_id"))
    assert plan(S.in_periods(rows, "month", 4, "receipt_id")).count("Exchange rangepartitioning(period") == 1
