"""The rollup: reports read it alone, and only changed periods are made again."""

import pytest
from pyspark.sql import functions as F

from shelflife.operators import analytics as K
from shelflife.operators import marts as L
from shelflife.operators.cells import CELLS
from shelflife.plans.registry import FIXTURE_CATEGORIES
from shelflife.sources import files as A
from shelflife.sources import rollup as R

REPORTS = [L.kpi_executive, L.revenue_by_month, L.revenue_by_category, L.revenue_vs_expiry_by_warehouse,
           L.expiry_loss_by_month, L.kpi_stockout, L.stockouts_by_month, L.stockout_rate_by_category,
           L.purchase_price_by_month, L.supplier_reliability_vs_price, L.margin_by_month, L.margin_by_category,
           L.margin_heatmap, L.margin_by_quarter, K.gross_margin_by_category_month, K.gross_margin_allocated,
           K.cumulative_revenue_and_expiry, K.expiry_loss_by_category, K.supplier_cost_volatility]


@pytest.fixture(scope="module")
def store(spark, small):
    return A.full_refresh(spark, small, A.scratch_path(spark, "test-rolled"), validate=False, unit="year", buckets=2)


@pytest.fixture(scope="module")
def root(spark, store):
    folder = A.scratch_path(spark, "test-rollup")
    done = R.refresh(store, folder)
    assert set(done) == set(CELLS) and all(done.values())
    return folder


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("report", REPORTS, ids=lambda f: f.__name__)
def test_reports_read_the_rollup_alone(small, store, root, report):
    got = report(R.Rollup(store, root))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "fact_" not in plan and "Bucketed: true" not in plan
    want = report(small)
    assert got.columns == want.columns and rows(got) == rows(want)


def test_heatmap_and_years(small, store, root):
    t = R.Rollup(store, root)
    assert rows(L.stockout_heatmap(t, FIXTURE_CATEGORIES)) == rows(L.stockout_heatmap(small, FIXTURE_CATEGORIES))
    assert rows(L.revenue_by_month(t, by_year=True)) == rows(L.revenue_by_month(small, by_year=True))
    assert rows(K.gross_margin_allocated(t, by_year=True)) == rows(K.gross_margin_allocated(small, by_year=True))


def test_only_changed_periods_are_made_again(spark, small):
    store = A.full_refresh(spark, small, A.scratch_path(spark, "test-change"), validate=False, unit="year", buckets=2)
    root = A.scratch_path(spark, "test-change-rollup")
    R.refresh(store, root)
    assert not any(R.refresh(store, root).values())
    # one year's write-offs are loaded anew, another year's are gone
    path = f"{store.folder}/fact_inventory_adjustments"
    years = sorted(R._folders(spark, path))
    year, lost = years[2], years[4]
    more = small["fact_inventory_adjustments"].where(F.year("adjustment_date") == int(year[:4])).withColumn(
        "quantity_adjusted", F.col("quantity_adjusted") + 3)
    more.write.mode("overwrite").parquet(f"{path}/period={year}")
    A._remove_path(spark, f"{path}/period={lost}")
    spark.sql(f"ALTER TABLE {store._names['fact_inventory_adjustments']} DROP PARTITION (period = date '{lost}')")
    spark.catalog.refreshTable(store._names["fact_inventory_adjustments"])
    assert R.refresh(store, root) == {name: [year, lost] if name == "expiry" else [] for name in CELLS}
    assert not any(R.refresh(store, root).values())
    now = small.replace(fact_inventory_adjustments=store["fact_inventory_adjustments"])
    assert rows(L.expiry_loss_by_month(R.Rollup(store, root))) == rows(L.expiry_loss_by_month(now))
    assert rows(L.expiry_loss_by_month(now)) != rows(L.expiry_loss_by_month(small))


def test_a_report_makes_its_own_measures_alone(spark, small, store):
    folder = A.scratch_path(spark, "test-fresh-rollup")
    t = R.Rollup(store, folder, fresh=True)
    assert rows(L.purchase_price_by_month(t)) == rows(L.purchase_price_by_month(small))
    assert [n for n in CELLS if R._folders(spark, f"{folder}/{n}")] == ["receipts"]
    # the other measures follow when a report asks for them, and none is made twice
    assert rows(L.kpi_executive(t)) == rows(L.kpi_executive(small))
    assert {n for n in CELLS if not any(R.refresh(store, folder, [n]).values())} == {
        "receipts", "sales", "expiry", "stockouts", "margin"}


@pytest.mark.parametrize("name", CELLS)
def test_a_measure_is_dealt_out_once(spark, store, name):
    sums = R._sums(store, name, sorted(R.sources(store, name)))
    text = sums._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
