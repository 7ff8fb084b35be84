"""Measures of the facts, by row or already added up by (warehouse, product, month).

Every report reduces its facts to (warehouse, product, period) first.  What it sums are
the columns given here.  Over plain tables they come one row a fact row; tables that
hold a rollup (``cells`` method, see :mod:`shelflife.sources.rollup`) give the stored
sums instead, dated on the first of their month, and the same report adds those up.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflife.operators.common import Tables, expiry_rows

PAIR = ("warehouse_id", "product_id")


@dataclass(frozen=True)
class Cell:
    facts: tuple[str, ...]          # what it is made from; the first decides the period
    date: str
    rows: Callable[[Tables], DataFrame]
    sums: tuple[str, ...]
    keys: tuple[str, ...] = PAIR
    tops: tuple[str, ...] = ()      # kept by max, resp. min
    lows: tuple[str, ...] = ()

    def added(self, df: DataFrame, *by) -> DataFrame:
        """The measures of ``df`` by the keys and ``by``."""
        return df.groupBy(*self.keys, *by).agg(
            *[F.sum(c).alias(c) for c in self.sums], *[F.max(c).alias(c) for c in self.tops],
            *[F.min(c).alias(c) for c in self.lows])


def _sales(t: Tables) -> DataFrame:
    return t["fact_sales"].select(
        *PAIR, "sale_date", F.lit(1).alias("sales"), F.col("quantity_sold").alias("units"),
        (F.col("quantity_sold") * F.col("selling_price_per_unit")).alias("rev"))


def _margin(t: Tables) -> DataFrame:
    """Sales by bridge: revenue by lot quantity, revenue by sale quantity (a sale of two lots
    twice), and cost."""
    s = t["fact_sales"].select("sale_id", "sale_date", *PAIR, "quantity_sold", "selling_price_per_unit")
    b = t["fact_sale_batch_map"].select("sale_id", "quantity_from_batch", "unit_cost_at_sale")
    price = F.col("selling_price_per_unit")
    return s.join(b, "sale_id").select(
        *PAIR, "sale_date", (F.col("quantity_from_batch") * price).alias("rev"),
        (F.col("quantity_sold") * price).alias("sale_rev"),
        (F.col("quantity_from_batch") * F.col("unit_cost_at_sale")).alias("cost"))


def _expiry(t: Tables) -> DataFrame:
    return expiry_rows(t).select(*PAIR, "adjustment_date", F.lit(1).alias("events"),
                                 F.col("quantity_adjusted").alias("units"))


def _stockouts(t: Tables) -> DataFrame:
    return t["fact_stockout_events"].select(*PAIR, "stockout_date", F.lit(1).alias("events"), "shortfall")


def _receipts(t: Tables) -> DataFrame:
    p = F.col("purchase_price_per_unit")
    return t["fact_goods_receipts"].select(
        "supplier_id", "product_id", "warehouse_id", "receipt_date", F.lit(1).alias("receipts"),
        F.col("quantity_received").alias("units"), p.alias("price_sum"), p.isNotNull().cast("int").alias("priced"),
        p.alias("price_max"), p.alias("price_min"))


CELLS: dict[str, Cell] = {
    "sales": Cell(("fact_sales",), "sale_date", _sales, ("sales", "units", "rev")),
    "margin": Cell(("fact_sales", "fact_sale_batch_map"), "sale_date", _margin, ("rev", "sale_rev", "cost")),
    "expiry": Cell(("fact_inventory_adjustments",), "adjustment_date", _expiry, ("events", "units")),
    "stockouts": Cell(("fact_stockout_events",), "stockout_date", _stockouts, ("events", "shortfall")),
    "receipts": Cell(("fact_goods_receipts",), "receipt_date", _receipts,
                     ("receipts", "units", "price_sum", "priced"),
                     ("supplier_id", "product_id", "warehouse_id"), ("price_max",), ("price_min",)),
}


def cells(t: Tables, name: str) -> DataFrame:
    """The measures ``name`` of the tables: stored sums by month if they hold a rollup."""
    stored = getattr(t, "cells", None)
    return stored(name) if stored else CELLS[name].rows(t)


def reduced(t: Tables, name: str, *by) -> DataFrame:
    """The measures ``name`` added up by their keys and ``by`` (date parts)."""
    return CELLS[name].added(cells(t, name), *by)
