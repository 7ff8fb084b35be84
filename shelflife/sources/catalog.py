"""The nine tables and the five staging views in Spark's catalog.

With these registered, SQL written against the model's tables and views runs
as Spark SQL: ``spark.sql("SELECT ... FROM vw_sales_enriched ...")``.  Views
are temporary views over the lazy operator plans, so Catalyst still prunes
and pushes filters through them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from shelflife.functions.dates import DEFAULT_AS_OF
from shelflife.operators import staging as J
from shelflife.schemas import FOREIGN_KEYS, PRIMARY_KEYS, TABLE_NAMES
from shelflife.sources.store import Store

VIEW_NAMES = ("vw_sales_enriched", "vw_goods_receipts_enriched", "vw_inventory_adjustments_enriched",
              "vw_expiry_rate_by_category", "vw_inventory_aging")


def ensure_database(spark: SparkSession, name: str) -> None:
    """Create the database only if it does not exist yet."""
    if not spark.catalog.databaseExists(name):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


# What each table holds, as its comment in the catalog.
COMMENTS = {
    "dim_products": "products: category, cost, price, shelf life", "dim_warehouses": "warehouses and their storage",
    "dim_suppliers": "suppliers: lead time, reliability", "dim_supplier_products": "which supplier delivers which product",
    "fact_sales": "one row a sale of a product in a warehouse", "fact_goods_receipts": "one row a batch received",
    "fact_sale_batch_map": "which batches a sale was taken from, and their cost",
    "fact_inventory_adjustments": "write-offs and other corrections of a batch",
    "fact_stockout_events": "demand that could not be served",
}


def table_exists(spark: SparkSession, database: str, name: str) -> bool:
    return spark.catalog.tableExists(f"`{database}`.`{name}`")


def create_tables(spark: SparkSession, database: str, store: Store) -> list[str]:
    """Create the database and its nine tables over a published store, each only
    if it does not exist; returns the names created.

    Catalog tables with declared columns, keys and meaning as comments; they read the
    store's files in their layout (partitions, buckets) and outlive the session wherever
    the session's catalog does.
    """
    ensure_database(spark, database)
    created = []
    for name in (n for n in TABLE_NAMES if not table_exists(spark, database, n)):
        notes = {c: "primary key" for c in PRIMARY_KEYS[name]}
        notes |= {c: f"references {parent}.{pcol}" for child, c, parent, pcol in FOREIGN_KEYS if child == name}
        store.create(name, f"`{database}`.`{name}`", COMMENTS[name], notes)
        created.append(name)
    return created


def register_tables(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Temporary views named after the nine tables."""
    for n in TABLE_NAMES:
        tables[n].createOrReplaceTempView(n)


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame], as_of=DEFAULT_AS_OF) -> None:
    """The five staging views (the ageing view at ``as_of``)."""
    J.sales_enriched(tables).createOrReplaceTempView("vw_sales_enriched")
    J.goods_receipts_enriched(tables).createOrReplaceTempView("vw_goods_receipts_enriched")
    J.adjustments_enriched(tables).createOrReplaceTempView("vw_inventory_adjustments_enriched")
    J.expiry_by_receipt(tables).createOrReplaceTempView("vw_expiry_rate_by_category")
    J.inventory_aging(tables, as_of).createOrReplaceTempView("vw_inventory_aging")


def register_all(spark: SparkSession, tables: Mapping[str, DataFrame], as_of=DEFAULT_AS_OF) -> None:
    register_tables(spark, tables)
    register_views(spark, tables, as_of)
