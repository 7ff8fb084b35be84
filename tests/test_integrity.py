"""Key, null, foreign-key and domain checks on clean and dirty tables."""

import re

from pyspark.sql import functions as F

from shelflife.operators import integrity as B
from shelflife.sources.fixture import dirty_tables
from tests.conftest import rows


def test_clean_fixture_has_no_violations(small):
    assert B.pk_violations(small).where("duplicate_keys > 0").count() == 0
    assert B.not_null_violations(small).where("violations > 0").count() == 0
    assert B.fk_violations(small).where("orphans > 0").count() == 0


def test_dirty_fixture_violations(small):
    d = dirty_tables(small)
    s = d["fact_sales"]
    ok = F.substring("sale_id", 2, 8).cast("bigint")
    dup_keys = s.where(ok % 997 == 3).select("sale_id").distinct().count()
    pk = dict(((t, k), n) for t, k, n in rows(B.pk_violations(d)))
    assert pk[("fact_sales", "sale_id")] == dup_keys > 0
    nn = dict(((t, c), n) for t, c, n in rows(B.not_null_violations(d)))
    assert nn[("fact_sales", "warehouse_id")] == s.where(F.col("warehouse_id").isNull()).count() > 0
    fk = dict(((c, col), n) for c, col, _, n in rows(B.fk_violations(d)))
    assert fk[("fact_sale_batch_map", "sale_id")] == 9
    assert fk[("fact_sale_batch_map", "batch_id")] == 110


def test_domain_widths_parameter(small):
    tight = {("fact_sales", "sale_id"): 5}
    got = rows(B.domain_violations(small, widths=tight).where("column_name = 'sale_id'"))
    assert got == [("fact_sales", "sale_id", 6000)]


def test_foreign_keys_move_one_by_one(spark):
    """No tuple of keys is moved; null keys are no orphans, repeated parents count once."""
    t = {"fact_sale_batch_map": spark.createDataFrame(
            [("S1", "B1"), ("S1", "B9"), ("S9", "B9"), (None, "B1"), ("S9", None), ("S2", "B1")], "sale_id string, batch_id string"),
         "fact_sales": spark.createDataFrame([("S1",), ("S1",), ("S2",), (None,)], "sale_id string"),
         "fact_goods_receipts": spark.createDataFrame([("B1",), ("B1",)], "batch_id string")}
    got = B.fk_violations({**t, "fact_sales": t["fact_sales"].selectExpr("sale_id", "'W' warehouse_id", "'P' product_id"),
                           "dim_warehouses": spark.sql("SELECT 'W' warehouse_id"), "dim_products": spark.sql("SELECT 'X' product_id"),
                           "fact_goods_receipts": t["fact_goods_receipts"].selectExpr(
                               "batch_id", "'P' product_id", "CAST(null AS string) supplier_id", "'W' warehouse_id"),
                           "dim_suppliers": spark.sql("SELECT 'U' supplier_id")})
    assert rows(got, "child", "fk_column", "orphans") == [
        ("fact_sales", "warehouse_id", 0), ("fact_sales", "product_id", 4), ("fact_goods_receipts", "product_id", 2),
        ("fact_goods_receipts", "supplier_id", 0), ("fact_goods_receipts", "warehouse_id", 0),
        ("fact_sale_batch_map", "sale_id", 2), ("fact_sale_batch_map", "batch_id", 2)]
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(batch_id" in text and "hashpartitioning(sale_id" in text
    assert not re.search(r"hashpartitioning\(\w+#\d+, [a-z_]", text)
    # every row is counted before it meets its parent
    assert "LeftAnti" not in text and "LeftOuter" in text
