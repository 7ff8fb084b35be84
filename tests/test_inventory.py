"""Stock operators: rules and invariants."""

import datetime as dt

from pyspark.sql import functions as F

from shelflife.operators import inventory as M
from shelflife.sources.fixture import FIXTURE_AS_OF
from tests.conftest import rows


def test_primary_supplier_unique_and_flagged(small):
    ps = M.primary_supplier(small)
    assert ps.count() == ps.select("product_id").distinct().count()
    flagged = small["dim_supplier_products"].where("is_primary = 1").select("product_id", "supplier_id")
    assert ps.exceptAll(flagged).count() == 0


def test_primary_supplier_fallback(spark):
    sp = spark.createDataFrame([("P1", "S3", 0), ("P1", "S2", 0), ("P2", "S9", 1), ("P2", "S1", 0)],
                               "product_id string, supplier_id string, is_primary int")
    assert sorted(rows(M.primary_supplier({"dim_supplier_products": sp}))) == [("P1", "S2"), ("P2", "S9")]


def test_stockable_pairs_rule(spark):
    p = spark.createDataFrame([("A", "Milk"), ("B", "Bread")], "product_id string, category string")
    w = spark.createDataFrame([("W1", 1), ("W2", 0)], "warehouse_id string, cold_storage_flag int")
    got = sorted(rows(M.stockable_pairs({"dim_products": p, "dim_warehouses": w})))
    assert got == [("A", "W1"), ("B", "W1"), ("B", "W2")]


def test_expected_demand_rules(spark):
    s = spark.createDataFrame(
        [("W1", "P1", dt.date(2024, 1, 1), 10), ("W1", "P1", dt.date(2024, 1, 1), 5),
         ("W1", "P1", dt.date(2024, 1, 2), 10), ("W2", "P1", dt.date(2024, 1, 2), 0)],
        "warehouse_id string, product_id string, sale_date date, quantity_sold int")
    w = spark.createDataFrame([("W1", "South"), ("W2", "Mars")], "warehouse_id string, region string")
    t = {"fact_sales": s, "dim_warehouses": w}
    sat = dict(((a, b), (c, d)) for a, b, c, d in rows(M.expected_demand(t, day=dt.date(2024, 1, 6))))
    # 12.5 * 1.55 * 1.10 = 21.3125 -> 21 ; W2 has demand 0 -> floor of 1
    assert sat[("W1", "P1")] == (12.5, 21)
    assert sat[("W2", "P1")] == (0.0, 1)
    mon = dict(((a, b), d) for a, b, _, d in rows(M.expected_demand(t, day=dt.date(2024, 1, 8))))
    assert mon[("W1", "P1")] == 14   # 12.5 * 1.10 = 13.75 -> 14


def test_cost_variance_flag(spark):
    r = spark.createDataFrame([("B1", "P1", dt.date(2024, 8, 1), 12.0), ("B2", "P1", dt.date(2024, 5, 1), 10.5)],
                              "batch_id string, product_id string, receipt_date date, price double")
    r = r.withColumn("purchase_price_per_unit", F.col("price").cast("decimal(10,4)")).drop("price")
    p = spark.createDataFrame([("P1", 10.0)], "product_id string, c double").select(
        "product_id", F.col("c").cast("decimal(10,2)").alias("base_cost"))
    got = {b: (str(sc), str(v), o) for b, sc, _, v, o in
           rows(M.purchase_cost_variance({"fact_goods_receipts": r, "dim_products": p}))}
    assert got["B1"] == ("10.5000", "14.29", 1)   # Q3 standard 10.50, actual 12.00
    assert got["B2"] == ("10.0000", "5.00", 0)


def test_ledger_end_balance(small):
    led = M.inventory_ledger(small)
    end = led.groupBy("warehouse_id", "product_id").agg(F.max_by("balance", "ledger_date").alias("b"))
    total_end = end.agg(F.sum("b")).first()[0]
    rec = small["fact_goods_receipts"].agg(F.sum("quantity_received")).first()[0]
    sold = small["fact_sales"].agg(F.sum("quantity_sold")).first()[0]
    adj = small["fact_inventory_adjustments"].agg(F.sum("quantity_adjusted")).first()[0]
    assert total_end == rec - sold - adj


def test_reorder_has_one_row_per_storable_pair(small):
    from shelflife.plans.registry import FIXTURE_COLD
    r = M.reorder_candidates(small, FIXTURE_AS_OF, FIXTURE_COLD)
    pairs = M.stockable_pairs(small, FIXTURE_COLD).join(
        M.active_products(small, FIXTURE_AS_OF).select("product_id"), "product_id")
    assert r.count() == pairs.count() == r.select("warehouse_id", "product_id").distinct().count()
    assert set(x[0] for x in rows(r, "reorder")) == {0, 1}
    gone = r.where("stock = 0 and base_daily_demand > 0")
    assert gone.count() > 0 and gone.where("coverage_days <> 0 or reorder <> 1").count() == 0


def test_reorder_rules(spark, small):
    """A sold-out pair is reordered; an inactive product and a cold product in a warm site
    are not listed; a pair without demand is covered."""
    import datetime as dt
    day = dt.date(2024, 5, 1)
    product = "product_id string, category string, status string, launch_date date"
    old = dt.date(2020, 1, 1)
    t = {
        "dim_products": spark.createDataFrame(
            [("P1", "Snacks", "Active", old), ("P2", "Snacks", "Inactive", old),
             ("P3", "Milk", "Active", old), ("P4", "Snacks", "Active", dt.date(2024, 6, 1))], product),
        "dim_warehouses": spark.createDataFrame([("W1", 0), ("W2", 1)],
                                                "warehouse_id string, cold_storage_flag int"),
        "dim_suppliers": spark.createDataFrame([("S1", 2)], "supplier_id string, average_lead_time_days int"),
        "dim_supplier_products": spark.createDataFrame(
            [(p, "S1", 1) for p in ("P1", "P2", "P3", "P4")], "product_id string, supplier_id string, is_primary int"),
        "fact_sales": spark.createDataFrame(
            [("s1", day, "W1", "P1", 10)],
            "sale_id string, sale_date date, warehouse_id string, product_id string, quantity_sold int"),
        "fact_sale_batch_map": spark.createDataFrame(
            [("s1", "B1", 10)], "sale_id string, batch_id string, quantity_from_batch int"),
        "fact_goods_receipts": spark.createDataFrame(
            [("B1", "W1", "P1", day, dt.date(2024, 6, 1), 10)],
            "batch_id string, warehouse_id string, product_id string, receipt_date date, "
            "expiry_date date, quantity_received int"),
        "fact_inventory_adjustments": spark.createDataFrame(
            [], "batch_id string, adjustment_date date, quantity_adjusted int")}
    got = {(r.warehouse_id, r.product_id): (r.stock, r.coverage_days, r.reorder)
           for r in M.reorder_candidates(t, day).collect()}
    assert got == {("W1", "P1"): (0, 0.0, 1), ("W2", "P1"): (0, 999.0, 0), ("W2", "P3"): (0, 999.0, 0)}


def test_forecast_does_not_see_its_own_day(small):
    day = FIXTURE_AS_OF
    got = M.expected_demand(small, day=day)
    before = M.base_daily_demand(small, until=day.replace(day=day.day - 1))
    j = got.join(before.withColumnRenamed("base_daily_demand", "b"), ["warehouse_id", "product_id"])
    assert got.count() == j.where("base_daily_demand = b").count() > 0


def test_stockout_days_drop_served_days(small):
    days = M.stockout_days(small)
    sold = small["fact_sales"].select("sale_date", "warehouse_id", "product_id").distinct().count()
    assert 0 < days.count() < sold
    assert days.where("shortfall <= 0").count() == 0


def test_expiry_writeoffs_positive(small):
    w = M.expiry_writeoffs(small, FIXTURE_AS_OF)
    assert w.where("quantity_adjusted <= 0").count() == 0
    assert w.where(F.col("adjustment_date") > F.lit(FIXTURE_AS_OF)).count() == 0
