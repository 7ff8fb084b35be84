"""Declared schemas, keys, foreign keys and column widths of the nine tables.

These mirror the relational model the analytics are written against: three
dimensions, one product x supplier junction, and five facts.  Spark does not
enforce keys or NOT NULL, so :mod:`shelflife.operators.integrity` checks them.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()
D = T.DateType()


def dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


def _struct(*cols) -> T.StructType:
    # every column is declared NOT NULL in the model; readers still produce
    # nullable fields, so the declaration lives in ``NOT_NULL`` / B2.
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


SCHEMAS: dict[str, T.StructType] = {
    "dim_products": _struct(
        ("product_id", S), ("product_name", S), ("category", S), ("unit_size", S),
        ("base_cost", dec(10, 2)), ("base_price", dec(10, 2)), ("shelf_life_days", I),
        ("launch_date", D), ("status", S),
    ),
    "dim_warehouses": _struct(
        ("warehouse_id", S), ("warehouse_name", S), ("city", S), ("region", S),
        ("storage_capacity_units", I), ("cold_storage_flag", I),
    ),
    "dim_suppliers": _struct(
        ("supplier_id", S), ("supplier_name", S), ("supplier_city", S),
        ("average_lead_time_days", I), ("reliability_score", dec(5, 2)),
        ("contract_start_date", D),
    ),
    "dim_supplier_products": _struct(
        ("product_id", S), ("supplier_id", S), ("is_primary", I),
    ),
    "fact_sales": _struct(
        ("sale_id", S), ("sale_date", D), ("warehouse_id", S), ("product_id", S),
        ("quantity_sold", I), ("selling_price_per_unit", dec(10, 2)),
        ("discount_percent", dec(5, 2)), ("promotion_flag", I),
    ),
    "fact_goods_receipts": _struct(
        ("receipt_id", S), ("batch_id", S), ("product_id", S), ("supplier_id", S),
        ("warehouse_id", S), ("receipt_date", D), ("manufacture_date", D),
        ("expiry_date", D), ("quantity_received", I),
        ("purchase_price_per_unit", dec(10, 4)), ("total_batch_cost", dec(12, 2)),
    ),
    "fact_sale_batch_map": _struct(
        ("sale_id", S), ("batch_id", S), ("quantity_from_batch", I),
        ("unit_cost_at_sale", dec(10, 4)),
    ),
    "fact_inventory_adjustments": _struct(
        ("adjustment_id", S), ("adjustment_date", D), ("warehouse_id", S),
        ("product_id", S), ("batch_id", S), ("adjustment_type", S),
        ("quantity_adjusted", I), ("reason_notes", S),
    ),
    "fact_stockout_events": _struct(
        ("stockout_id", S), ("stockout_date", D), ("warehouse_id", S),
        ("product_id", S), ("quantity_demanded", I), ("quantity_supplied", I),
        ("shortfall", I),
    ),
}

TABLE_NAMES: tuple[str, ...] = tuple(sorted(SCHEMAS))

# Fixed values of the model: primary keys and the one UNIQUE constraint.
PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "dim_products": ("product_id",),
    "dim_warehouses": ("warehouse_id",),
    "dim_suppliers": ("supplier_id",),
    "dim_supplier_products": ("product_id", "supplier_id"),
    "fact_sales": ("sale_id",),
    "fact_goods_receipts": ("receipt_id",),
    "fact_sale_batch_map": ("sale_id", "batch_id"),
    "fact_inventory_adjustments": ("adjustment_id",),
    "fact_stockout_events": ("stockout_id",),
}
UNIQUE_KEYS: dict[str, tuple[str, ...]] = {"fact_goods_receipts": ("batch_id",)}

# Fixed values of the model: the 14 foreign keys as (child, column, parent, parent column).
FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("dim_supplier_products", "product_id", "dim_products", "product_id"),
    ("dim_supplier_products", "supplier_id", "dim_suppliers", "supplier_id"),
    ("fact_sales", "warehouse_id", "dim_warehouses", "warehouse_id"),
    ("fact_sales", "product_id", "dim_products", "product_id"),
    ("fact_goods_receipts", "product_id", "dim_products", "product_id"),
    ("fact_goods_receipts", "supplier_id", "dim_suppliers", "supplier_id"),
    ("fact_goods_receipts", "warehouse_id", "dim_warehouses", "warehouse_id"),
    ("fact_sale_batch_map", "sale_id", "fact_sales", "sale_id"),
    ("fact_sale_batch_map", "batch_id", "fact_goods_receipts", "batch_id"),
    ("fact_inventory_adjustments", "warehouse_id", "dim_warehouses", "warehouse_id"),
    ("fact_inventory_adjustments", "product_id", "dim_products", "product_id"),
    ("fact_inventory_adjustments", "batch_id", "fact_goods_receipts", "batch_id"),
    ("fact_stockout_events", "warehouse_id", "dim_warehouses", "warehouse_id"),
    ("fact_stockout_events", "product_id", "dim_products", "product_id"),
)

# Fixed values of the model: declared VARCHAR widths per (table, column).
VARCHAR_WIDTHS: dict[tuple[str, str], int] = {
    ("dim_products", "product_id"): 10, ("dim_products", "product_name"): 100,
    ("dim_products", "category"): 50, ("dim_products", "unit_size"): 20,
    ("dim_products", "status"): 10,
    ("dim_warehouses", "warehouse_id"): 10, ("dim_warehouses", "warehouse_name"): 100,
    ("dim_warehouses", "city"): 50, ("dim_warehouses", "region"): 20,
    ("dim_suppliers", "supplier_id"): 10, ("dim_suppliers", "supplier_name"): 100,
    ("dim_suppliers", "supplier_city"): 50,
    ("dim_supplier_products", "product_id"): 10, ("dim_supplier_products", "supplier_id"): 10,
    ("fact_sales", "sale_id"): 15, ("fact_sales", "warehouse_id"): 10,
    ("fact_sales", "product_id"): 10,
    ("fact_goods_receipts", "receipt_id"): 15, ("fact_goods_receipts", "batch_id"): 15,
    ("fact_goods_receipts", "product_id"): 10, ("fact_goods_receipts", "supplier_id"): 10,
    ("fact_goods_receipts", "warehouse_id"): 10,
    ("fact_sale_batch_map", "sale_id"): 15, ("fact_sale_batch_map", "batch_id"): 15,
    ("fact_inventory_adjustments", "adjustment_id"): 15,
    ("fact_inventory_adjustments", "warehouse_id"): 10,
    ("fact_inventory_adjustments", "product_id"): 10,
    ("fact_inventory_adjustments", "batch_id"): 15,
    ("fact_inventory_adjustments", "adjustment_type"): 20,
    ("fact_inventory_adjustments", "reason_notes"): 200,
    ("fact_stockout_events", "stockout_id"): 15, ("fact_stockout_events", "warehouse_id"): 10,
    ("fact_stockout_events", "product_id"): 10,
}


def decimal_columns(table: str) -> list[tuple[str, int, int]]:
    """(column, precision, scale) of every decimal column of ``table``."""
    return [
        (f.name, f.dataType.precision, f.dataType.scale)
        for f in SCHEMAS[table].fields
        if isinstance(f.dataType, T.DecimalType)
    ]
