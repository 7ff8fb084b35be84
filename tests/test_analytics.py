"""Business queries: expected values of FIXTURES.md §3 and invariants."""

from decimal import Decimal

from pyspark.sql import functions as F

from shelflife.functions.dates import BAND_ORDER
from shelflife.operators import analytics as K
from shelflife.operators import staging as J
from shelflife.sources.fixture import FIXTURE_AS_OF


def test_warehouse_ranking_w001(medium):
    r = K.warehouse_ranking(medium).where(F.col("warehouse_id") == "W001").first()
    assert r.total_revenue == Decimal("280943763.62")
    assert r.total_expiry_loss == Decimal("9274659.94")
    assert r.total_stockout_events == 4666
    assert r.expiry_loss_percent_of_revenue == Decimal("3.30")
    assert (r.revenue_rank, r.expiry_loss_percent_rank, r.stockout_rank) == (5, 5, 1)


def test_ranks_are_dense(small):
    ranks = sorted(r[0] for r in K.warehouse_ranking(small).select("revenue_rank").collect())
    assert ranks == list(range(1, len(ranks) + 1))


def test_expiry_rate_economy(medium):
    r = K.expiry_loss_rate_by_category(medium).where(F.col("category") == "ECONOMY").first()
    assert r.total_units_received == 268267
    assert r.total_units_lost_to_expiry == 10934.0
    assert r.expiry_loss_rate_percent == Decimal("4.08")


def test_expiry_by_warehouse_africa(medium):
    r = K.expiry_loss_by_warehouse(medium).where(F.col("warehouse_name") == "AFRICA HUB").first()
    assert (r.total_expiry_events, r.total_unit_lost_to_expiry) == (1330, 13947)
    assert r.total_cost_lost_to_expiry == Decimal("9274659.94")


def test_stockout_rate_w001_economy(medium):
    r = (K.stockout_rate(medium)
         .where((F.col("warehouse_name") == "AFRICA HUB") & (F.col("category") == "ECONOMY")).first())
    assert r.total_stockout_events == 725
    assert r.stockout_rate_percent == Decimal("39.40")


def test_aging_bands(medium):
    from shelflife.operators.marts import aging_by_band
    got = {r.age_band: (r.total_batches, r.total_units_at_risk, r.estimated_stock_value)
           for r in aging_by_band(medium, FIXTURE_AS_OF).collect()}
    assert got["Critical"] == (42, 461, Decimal("320368.93"))
    assert got["Near Expiry"] == (73, 787, Decimal("546286.69"))
    assert got["Ageing"] == (39, 393, Decimal("266865.42"))
    assert got["Fresh"] == (6578, 69480, Decimal("46085800.50"))
    per_wh = K.inventory_aging_summary(medium, FIXTURE_AS_OF).groupBy("age_category").agg(
        F.sum("total_batches").alias("b")).collect()
    assert {r.age_category: r.b for r in per_wh} == {k: v[0] for k, v in got.items()}


def test_fanout_vs_allocated_revenue(medium):
    fan = K.gross_margin_by_category_month(medium).agg(F.sum("total_revenue")).first()[0]
    alloc = K.gross_margin_allocated(medium).agg(F.sum("total_revenue")).first()[0]
    assert fan == Decimal("1962952950.66")
    assert alloc == Decimal("1447930203.18")


def test_allocated_revenue_equals_gross_revenue(small):
    alloc = K.gross_margin_allocated(small).agg(F.sum("total_revenue")).first()[0]
    s = small["fact_sales"].agg(F.sum(F.col("quantity_sold") * F.col("selling_price_per_unit"))).first()[0]
    assert abs(alloc - s) < Decimal("0.01") * 12 * 10


def test_band_counts_sum_to_view(small):
    n = J.inventory_aging(small, FIXTURE_AS_OF).count()
    s = K.inventory_aging_summary(small, FIXTURE_AS_OF).agg(F.sum("total_batches")).first()[0]
    assert n == s


def test_sorted_summary_is_band_ordered(small):
    out = [(r.warehouse_name, BAND_ORDER.index(r.age_category))
           for r in K.inventory_aging_summary_sorted(small, FIXTURE_AS_OF).collect()]
    assert out == sorted(out)


def test_by_year_separates_years(small):
    a = K.gross_margin_allocated(small, by_year=True)
    assert "sale_year" in a.columns
    assert a.select("sale_year").distinct().count() > 1
