"""Profiling and data-quality queries (row counts, scope, revenue splits, checks A-E)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflife.functions.money import MONEY, avg_half_up, ratio_half_up
from shelflife.operators.common import Tables, union_all
from shelflife.schemas import TABLE_NAMES


def row_counts(t: Tables) -> DataFrame:
    """``table_name, row_count`` for the nine tables."""
    return union_all([
        t[n].agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(n).alias("table_name"), "row_count")
        for n in TABLE_NAMES
    ])


def sales_scope(t: Tables) -> DataFrame:
    """Sale date range and distinct products / warehouses sold."""
    return t["fact_sales"].agg(
        F.max("sale_date").alias("latest_sale_date"),
        F.min("sale_date").alias("earliest_sale_date"),
        F.count_distinct("product_id").alias("unique_products_sold"),
        F.count_distinct("warehouse_id").alias("unique_warehouses_involved"),
    )


def net_line_revenue(discount_scale: int = 100):
    """``quantity * price * (1 - discount / discount_scale)``, exact decimal.

    The model stores discounts as fractions but the profiling formula divides
    by 100, so by default a 5 % discount removes 0.05 %; pass
    ``discount_scale=1`` for the fractional reading.
    """
    return (F.col("quantity_sold") * F.col("selling_price_per_unit")
            * (F.lit(1) - F.col("discount_percent") / F.lit(discount_scale)))


def sales_by_warehouse(t: Tables, discount_scale: int = 100) -> DataFrame:
    """Transactions, units, net revenue and average price per warehouse."""
    return (
        t["fact_sales"].groupBy("warehouse_id").agg(
            F.count(F.lit(1)).alias("total_sales_transactions"),
            F.sum("quantity_sold").alias("total_units_sold"),
            F.sum(net_line_revenue(discount_scale)).cast(MONEY).alias("total_revenue"),
            avg_half_up(F.col("selling_price_per_unit"), 2).alias("average_selling_price_per_unit"),
        )
    )


def sales_by_category(t: Tables, discount_scale: int = 100) -> DataFrame:
    """Per product category: transactions, units, net revenue, average discount.

    Sales are first reduced to one row per product (map-side partial
    aggregation), so the join to products moves one row per product instead of
    one per sale, and a hot product cannot skew the join.
    """
    per_product = t["fact_sales"].groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("quantity_sold").alias("units"),
        F.sum(net_line_revenue(discount_scale)).alias("revenue"),
        F.sum("discount_percent").alias("disc_sum"),
        F.count("discount_percent").alias("disc_n"),
    )
    p = t["dim_products"].select("product_id", "category")
    return (
        per_product.join(p, "product_id")
        .groupBy(F.col("category").alias("product_category"))
        .agg(
            F.sum("n").alias("total_sales_transactions"),
            F.sum("units").alias("total_units_sold"),
            F.sum("revenue").cast(MONEY).alias("total_revenue"),
            ratio_half_up(F.sum("disc_sum"), F.sum("disc_n"), num_scale=2, den_scale=0,
                          out=T.DecimalType(5, 2)).alias("average_discount_percent"),
        )
    )


# ---- checks A-E --------------------------------------------------------------

def dq_nonpositive_sales(t: Tables) -> DataFrame:
    """Check A: sales with quantity <= 0."""
    return t["fact_sales"].where(F.col("quantity_sold") <= 0)


def dq_expiry_before_receipt(t: Tables) -> DataFrame:
    """Check B: batches whose expiry is on or before their receipt date."""
    return t["fact_goods_receipts"].where(F.col("expiry_date") <= F.col("receipt_date"))


def dq_nonpositive_batch_qty(t: Tables) -> DataFrame:
    """Check C: bridge rows drawing <= 0 units from a batch."""
    return t["fact_sale_batch_map"].where(F.col("quantity_from_batch") <= 0)


def dq_orphan_sales(t: Tables) -> DataFrame:
    """Check D: bridge rows whose sale does not exist (anti join, not outer + IS NULL)."""
    return t["fact_sale_batch_map"].join(t["fact_sales"].select("sale_id"), "sale_id", "left_anti")


def dq_orphan_batches(t: Tables) -> DataFrame:
    """Check E: bridge rows whose batch does not exist."""
    return t["fact_sale_batch_map"].join(
        t["fact_goods_receipts"].select("batch_id"), "batch_id", "left_anti")


# The five checks as listed in the model's quality report.
DQ_CHECKS = (
    ("A", "Sales with zero or negative quantity", dq_nonpositive_sales),
    ("B", "Batches expired before receipt date", dq_expiry_before_receipt),
    ("C", "Zero quantities in batch map", dq_nonpositive_batch_qty),
    ("D", "Orphaned sale IDs in batch map", dq_orphan_sales),
    ("E", "Orphaned batch IDs in batch map", dq_orphan_batches),
)


def dq_summary(t: Tables) -> DataFrame:
    """Checks A-E as one table: ``check_id, check_name, violations, passed``."""
    return union_all([
        fn(t).agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(cid).alias("check_id"), F.lit(name).alias("check_name"),
            "violations", (F.col("violations") == 0).alias("passed"))
        for cid, name, fn in DQ_CHECKS
    ])
