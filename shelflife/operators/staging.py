"""Staging frames: enriched facts and the per-batch expiry / ageing views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflife.functions.dates import DEFAULT_AS_OF, age_band, as_date, days_until
from shelflife.operators.common import Tables, products, warehouses

PRODUCT_COLS = ("product_name", "category", "base_cost", "base_price", "shelf_life_days")
WAREHOUSE_COLS = ("warehouse_name", "region", "cold_storage_flag")
SUPPLIER_COLS = ("supplier_name", "supplier_city", "average_lead_time_days", "reliability_score")


def sales_enriched(t: Tables) -> DataFrame:
    """Sales with product and warehouse attributes (inner joins)."""
    s = t["fact_sales"]
    return (
        s.join(products(t, *PRODUCT_COLS), "product_id")
        .join(warehouses(t, "warehouse_id", *WAREHOUSE_COLS), "warehouse_id")
        .select("sale_id", "sale_date", "warehouse_id", "product_id", "quantity_sold",
                "selling_price_per_unit", "discount_percent", "promotion_flag",
                *PRODUCT_COLS, *WAREHOUSE_COLS)
    )


def goods_receipts_enriched(t: Tables) -> DataFrame:
    """Receipts with product, warehouse and supplier attributes (inner joins)."""
    r = t["fact_goods_receipts"]
    sup = t["dim_suppliers"].select("supplier_id", *SUPPLIER_COLS)
    return (
        r.join(products(t, *PRODUCT_COLS), "product_id")
        .join(warehouses(t, "warehouse_id", *WAREHOUSE_COLS), "warehouse_id")
        .join(sup, "supplier_id")
        .select("receipt_id", "receipt_date", "warehouse_id", "product_id",
                "quantity_received", "purchase_price_per_unit", "supplier_id", "batch_id",
                *PRODUCT_COLS, *WAREHOUSE_COLS, *SUPPLIER_COLS)
    )


def adjustments_enriched(t: Tables) -> DataFrame:
    """Inventory adjustments with product and warehouse attributes (inner joins)."""
    a = t["fact_inventory_adjustments"]
    return (
        a.join(products(t, *PRODUCT_COLS), "product_id")
        .join(warehouses(t, "warehouse_id", *WAREHOUSE_COLS), "warehouse_id")
        .select("adjustment_id", "adjustment_date", "warehouse_id", "product_id", "batch_id",
                "adjustment_type", "quantity_adjusted", "reason_notes",
                *PRODUCT_COLS, *WAREHOUSE_COLS)
    )


def _expired_per_batch(adj: DataFrame, name: str) -> DataFrame:
    return (adj.where(F.col("adjustment_type") == "Expiry")
            .groupBy("batch_id").agg(F.sum("quantity_adjusted").alias(name)))


def expiry_by_receipt(t: Tables) -> DataFrame:
    """One row per receipt with the units later written off as expired (0 if none)."""
    r = t["fact_goods_receipts"]
    exp = _expired_per_batch(t["fact_inventory_adjustments"], "qe")
    return (
        r.join(exp, "batch_id", "left")
        .join(products(t, "category"), "product_id")
        .join(warehouses(t, "warehouse_id", "warehouse_name", "region"), "warehouse_id")
        .select("product_id", "category", "warehouse_id", "warehouse_name", "region",
                "receipt_date", "quantity_received",
                F.coalesce(F.col("qe"), F.lit(0)).alias("quantity_expired"))
    )


def lot_position(lots: DataFrame, bridge: DataFrame, adjustments: DataFrame) -> DataFrame:
    """Per lot of ``lots``: received, sold (from the bridge), written off as expired, what is left."""
    sold = bridge.groupBy("batch_id").agg(F.sum("quantity_from_batch").alias("us"))
    wo = _expired_per_batch(adjustments, "wo")
    sold_n = F.coalesce(F.col("us"), F.lit(0))
    wo_n = F.coalesce(F.col("wo"), F.lit(0))
    return (
        lots.join(sold, "batch_id", "left").join(wo, "batch_id", "left")
        .select("batch_id", "product_id", "warehouse_id", "receipt_date", "expiry_date",
                "quantity_received", "purchase_price_per_unit",
                sold_n.alias("total_units_sold"), wo_n.alias("total_units_written_off"),
                (F.col("quantity_received") - sold_n - wo_n).alias("current_stock"))
    )


def batch_position(t: Tables, as_of=DEFAULT_AS_OF, adjustments: DataFrame | None = None) -> DataFrame:
    """Per batch: received, sold (from the bridge), written off as expired, current stock.

    Only batches that expire after ``as_of`` and still hold stock are kept.  Bridge
    and adjustments are first cut to the lots that outlive ``as_of``: with a shelf
    life of days almost the whole history falls away before it is summed.
    """
    r = t["fact_goods_receipts"].where(F.col("expiry_date") > as_date(as_of))
    ids = r.select("batch_id")
    adj = adjustments if adjustments is not None else t["fact_inventory_adjustments"]
    return lot_position(r, t["fact_sale_batch_map"].join(ids, "batch_id", "left_semi"),
                        adj.join(ids, "batch_id", "left_semi")).where(F.col("current_stock") > 0)


def inventory_aging(t: Tables, as_of=DEFAULT_AS_OF, position: DataFrame | None = None) -> DataFrame:
    """Open batches at ``as_of`` with stock, days to expiry and age band.

    ``position`` replaces :func:`batch_position` where it is stored."""
    b = batch_position(t, as_of) if position is None else position
    days = days_until(F.col("expiry_date"), as_of)
    return (
        b.join(products(t, "category"), "product_id")
        .join(warehouses(t, "warehouse_id", "warehouse_name", "region"), "warehouse_id")
        .select("batch_id", "product_id", "category", "warehouse_id", "warehouse_name", "region",
                "receipt_date", "expiry_date", "purchase_price_per_unit", "quantity_received",
                "total_units_sold", "total_units_written_off", "current_stock",
                days.alias("days_until_expiry"), age_band(days).alias("age_band"))
    )
