"""Dashboard marts: the aggregates behind the six report pages.

Revenue here is gross and without the bridge fan-out (each sale counted once);
margin uses batch-allocated revenue and cost (as K7b).  Like the business
queries, facts are reduced to (warehouse, product[, period]) before the
dimension joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflife.functions.dates import DEFAULT_AS_OF
from shelflife.functions.money import MONEY, pct, ratio_half_up
from shelflife.operators.analytics import receipts_reduced, batches_per_supplier
from shelflife.operators.cells import cells, reduced
from shelflife.operators.common import Tables, products, union_all, warehouses
from shelflife.operators.distinct import bitmaps, distinct_counts
from shelflife.operators.staging import inventory_aging

MONTHS = tuple(range(1, 13))


def _period(c: str, name: str, kind: str, by_year: bool) -> list[Column]:
    fn = {"month": F.month, "quarter": F.quarter}[kind]
    cols = [fn(c).alias(name)]
    if by_year:
        cols.insert(0, F.year(c).alias(name.replace(kind, "year")))
    return cols


def _revenue(t: Tables, *period: Column) -> DataFrame:
    """Gross revenue per (warehouse, product, period...), only rows the enriched view keeps."""
    return (reduced(t, "sales", *period).join(products(t, "category"), "product_id")
            .join(warehouses(t, "warehouse_id", "warehouse_name"), "warehouse_id"))


def _expiry(t: Tables, *period: Column) -> DataFrame:
    return (reduced(t, "expiry", *period).join(products(t, "category", "base_cost"), "product_id")
            .join(warehouses(t, "warehouse_id", "warehouse_name"), "warehouse_id")
            .withColumn("loss", F.col("units") * F.col("base_cost")))


def _allocated_margin(t: Tables, *period: Column) -> DataFrame:
    return (reduced(t, "margin", *period).join(products(t, "category"), "product_id")
            .join(warehouses(t, "warehouse_id"), "warehouse_id"))


def _margin_cols(rev: Column, cost: Column) -> list[Column]:
    return [rev.cast(MONEY).alias("total_revenue"), cost.cast(MONEY).alias("total_cost"),
            (rev - cost).cast(MONEY).alias("gross_margin"),
            pct(rev - cost, rev, num_scale=4, den_scale=2).alias("gross_margin_percent")]


# ---- page 1: executive summary -------------------------------------------------

def kpi_executive(t: Tables) -> DataFrame:
    """L1: one row: revenue, expiry loss, stock-out events, expiry % of revenue, margin %.

    The four facts' one-row sums are stacked, each in its own columns, and folded by
    one aggregate: no join.
    """
    wide = T.DecimalType(38, 4)
    none = F.lit(None).cast(wide)

    def part(df: DataFrame, **sums) -> DataFrame:
        names = ("rev", "loss", "events", "arev", "acost")
        return df.agg(*[F.sum(sums[n]).cast(wide).alias(n) if n in sums else none.alias(n)
                        for n in names])

    j = union_all([
        part(_revenue(t), rev="rev"), part(_expiry(t), loss="loss"),
        part(cells(t, "stockouts"), events="events"),
        part(_allocated_margin(t), arev="rev", acost="cost"),
    ]).agg(*[F.max(n).alias(n) for n in ("rev", "loss", "events", "arev", "acost")])
    rev, loss = F.col("rev").cast(MONEY), F.col("loss").cast(MONEY)
    return j.select(
        rev.alias("total_revenue"), loss.alias("total_expiry_loss"),
        F.coalesce(F.col("events"), F.lit(0)).cast("bigint").alias("total_stockout_events"),
        pct(loss, rev, num_scale=2, den_scale=2).alias("expiry_loss_percent_of_revenue"),
        pct(F.col("arev") - F.col("acost"), F.col("arev"), num_scale=4, den_scale=2)
        .alias("gross_margin_percent"))


def revenue_by_month(t: Tables, by_year: bool = False) -> DataFrame:
    """L2: gross revenue per sale month."""
    p = _period("sale_date", "sale_month", "month", by_year)
    keys = [c for c in (["sale_year"] if by_year else []) + ["sale_month"]]
    return _revenue(t, *p).groupBy(*keys).agg(F.sum("rev").cast(MONEY).alias("total_revenue"))


def revenue_by_category(t: Tables) -> DataFrame:
    """L3: gross revenue per category."""
    return _revenue(t).groupBy("category").agg(F.sum("rev").cast(MONEY).alias("total_revenue"))


def revenue_vs_expiry_by_warehouse(t: Tables) -> DataFrame:
    """L4: revenue and expiry loss per warehouse (loss 0 where none)."""
    rev = _revenue(t).groupBy("warehouse_id", "warehouse_name").agg(
        F.sum("rev").cast(MONEY).alias("total_revenue"))
    loss = _expiry(t).groupBy("warehouse_id").agg(F.sum("loss").cast(MONEY).alias("loss"))
    return rev.join(loss, "warehouse_id", "left").select(
        "warehouse_id", "warehouse_name", "total_revenue",
        F.coalesce(F.col("loss"), F.lit(0).cast(MONEY)).alias("total_expiry_loss"))


# ---- page 2: expiry --------------------------------------------------------------

def expiry_loss_by_month(t: Tables, by_year: bool = False) -> DataFrame:
    """Expiry loss (units x base cost) per write-off month."""
    p = _period("adjustment_date", "adjustment_month", "month", by_year)
    keys = (["adjustment_year"] if by_year else []) + ["adjustment_month"]
    return _expiry(t, *p).groupBy(*keys).agg(
        F.sum("units").alias("total_units_expired"),
        F.sum("loss").cast(MONEY).alias("total_expiry_loss"))


# ---- page 3: stock-outs ------------------------------------------------------------

def kpi_stockout(t: Tables) -> DataFrame:
    """One row: stock-out events and units short."""
    return cells(t, "stockouts").agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("total_stockout_events"),
        F.sum("shortfall").alias("total_units_short"))


def stockouts_by_month(t: Tables, by_year: bool = False) -> DataFrame:
    """Stock-out events and units short per month."""
    p = _period("stockout_date", "stockout_month", "month", by_year)
    return cells(t, "stockouts").groupBy(*p).agg(
        F.sum("events").alias("total_stockout_events"),
        F.sum("shortfall").alias("total_units_short"))


def stockout_heatmap(t: Tables, categories: tuple[str, ...]) -> DataFrame:
    """Warehouse x category matrix of stock-out events (0 where none).

    The category columns are given, so the pivot needs no extra pass to discover
    them; ``other`` counts the events of all further categories and ``total`` all.
    """
    per = (reduced(t, "stockouts").withColumnRenamed("events", "n")
           .join(products(t, "category"), "product_id")
           .join(warehouses(t, "warehouse_id", "warehouse_name"), "warehouse_id"))
    column = F.when(F.col("category").isin(*categories), F.col("category")).otherwise("other")
    names = [*categories, "other"]
    wide = per.withColumn("c", column).groupBy("warehouse_name").pivot("c", names).agg(F.sum("n"))
    cells = [F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("bigint") for c in names]
    return wide.select("warehouse_name", *[x.alias(c) for x, c in zip(cells, names)],
                       sum(cells[1:], cells[0]).alias("total"))


def stockout_rate_by_category(t: Tables) -> DataFrame:
    """Stock-out events per 100 sales, per category."""
    def per_cat(cell: str, n: str, name: str) -> DataFrame:
        return (reduced(t, cell).join(products(t, "category"), "product_id")
                .join(warehouses(t, "warehouse_id"), "warehouse_id")
                .groupBy("category").agg(F.sum(n).alias(name)))
    so = per_cat("stockouts", "events", "total_stockout_events")
    sa = per_cat("sales", "sales", "total_sales_events")
    return so.join(sa, "category").select(
        "category", "total_stockout_events", "total_sales_events",
        pct(F.col("total_stockout_events"), F.col("total_sales_events"), num_scale=0, den_scale=0)
        .alias("stockout_rate_percent"))


# ---- page 4: suppliers -------------------------------------------------------------

def purchase_price_by_month(t: Tables, by_year: bool = False) -> DataFrame:
    """Average purchase price per unit per receipt month."""
    p = _period("receipt_date", "receipt_month", "month", by_year)
    keys = (["receipt_year"] if by_year else []) + ["receipt_month"]
    return receipts_reduced(t, *p).groupBy(*keys).agg(
        F.sum("receipts").alias("total_batches"),
        ratio_half_up(F.sum("price_sum"), F.sum("priced"), num_scale=4, den_scale=0)
        .alias("avg_cost_per_unit"))


def supplier_reliability_vs_price(t: Tables) -> DataFrame:
    """Reliability score and average unit price per supplier."""
    s = t["dim_suppliers"].select("supplier_id", "supplier_name", "reliability_score")
    per = receipts_reduced(t).groupBy("supplier_id").agg(
        ratio_half_up(F.sum("price_sum"), F.sum("priced"), num_scale=4, den_scale=0)
        .alias("avg_cost_per_unit"))
    return per.join(s, "supplier_id").select(
        "supplier_id", "supplier_name", "reliability_score", "avg_cost_per_unit")


def batch_volume_by_supplier(t: Tables) -> DataFrame:
    """Distinct batches and units received per supplier."""
    s = t["dim_suppliers"].select("supplier_id", "supplier_name")
    units = receipts_reduced(t).groupBy("supplier_id").agg(F.sum("units").alias("total_units_received"))
    batches = batches_per_supplier(t).groupBy("supplier_id").agg(
        F.count(F.lit(1)).alias("total_batches_received"))
    return units.join(batches, "supplier_id").join(s, "supplier_id").select(
        "supplier_id", "supplier_name", "total_batches_received", "total_units_received")


def supplier_batch_bitmaps(t: Tables, numbers: DataFrame) -> DataFrame:
    """(supplier_id, receipt_month, bucket, bitmap): the batches of L12 by month, to be kept."""
    r = (t["fact_goods_receipts"].join(products(t), "product_id", "left_semi")
         .join(warehouses(t, "warehouse_id"), "warehouse_id", "left_semi"))
    return bitmaps(r, "batch_id", ["supplier_id", F.trunc("receipt_date", "month").alias("receipt_month")], numbers)


def batch_volume_from_months(t: Tables, maps: DataFrame) -> DataFrame:
    """L12 with its distinct batches merged from monthly bitmaps, units from the cells."""
    s = t["dim_suppliers"].select("supplier_id", "supplier_name")
    units = receipts_reduced(t).groupBy("supplier_id").agg(F.sum("units").alias("total_units_received"))
    return units.join(distinct_counts(maps, ["supplier_id"], "total_batches_received"), "supplier_id").join(
        s, "supplier_id").select("supplier_id", "supplier_name", "total_batches_received", "total_units_received")


# ---- page 5: margin ----------------------------------------------------------------

def margin_by_month(t: Tables, by_year: bool = False) -> DataFrame:
    """Allocated revenue, cost, margin and margin % per sale month."""
    p = _period("sale_date", "sale_month", "month", by_year)
    keys = (["sale_year"] if by_year else []) + ["sale_month"]
    g = _allocated_margin(t, *p).groupBy(*keys).agg(F.sum("rev").alias("rev"),
                                                     F.sum("cost").alias("cost"))
    return g.select(*keys, *_margin_cols(F.col("rev"), F.col("cost")))


def margin_by_category(t: Tables) -> DataFrame:
    """Allocated revenue split into cost and margin, per category."""
    g = _allocated_margin(t).groupBy("category").agg(F.sum("rev").alias("rev"),
                                                     F.sum("cost").alias("cost"))
    return g.select("category", *_margin_cols(F.col("rev"), F.col("cost")))


def margin_heatmap(t: Tables) -> DataFrame:
    """Category x month matrix of margin % (columns m1..m12, NULL where no sales)."""
    g = (_allocated_margin(t, F.month("sale_date").alias("sale_month"))
         .groupBy("category").pivot("sale_month", list(MONTHS))
         .agg(F.sum("rev").alias("rev"), F.sum("cost").alias("cost")))
    cells = [pct(F.col(f"{m}_rev") - F.col(f"{m}_cost"), F.col(f"{m}_rev"),
                 num_scale=4, den_scale=2).alias(f"m{m}") for m in MONTHS]
    return g.select("category", *cells)


def margin_by_quarter(t: Tables, by_year: bool = False) -> DataFrame:
    """Allocated margin per (category, quarter)."""
    p = _period("sale_date", "sale_quarter", "quarter", by_year)
    keys = (["sale_year"] if by_year else []) + ["sale_quarter"]
    g = _allocated_margin(t, *p).groupBy("category", *keys).agg(
        F.sum("rev").alias("rev"), F.sum("cost").alias("cost"))
    return g.select("category", *keys, *_margin_cols(F.col("rev"), F.col("cost")))


# ---- page 6: ageing ----------------------------------------------------------------

def aging_by_band(t: Tables, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Batches, units and stock value per age band."""
    return inventory_aging(t, as_of).groupBy("age_band").agg(
        F.count(F.lit(1)).alias("total_batches"),
        F.sum("current_stock").alias("total_units_at_risk"),
        F.sum(F.col("current_stock") * F.col("purchase_price_per_unit")).cast(MONEY)
        .alias("estimated_stock_value"))


def at_risk_by_warehouse_category(t: Tables, as_of=DEFAULT_AS_OF,
                                  bands: tuple[str, ...] = ("Critical", "Near Expiry")) -> DataFrame:
    """Units and value at risk (in the given bands) per warehouse and category."""
    a = inventory_aging(t, as_of).where(F.col("age_band").isin(*bands))
    return a.groupBy("warehouse_name", "category").agg(
        F.count(F.lit(1)).alias("total_batches"),
        F.sum("current_stock").alias("total_units_at_risk"),
        F.sum(F.col("current_stock") * F.col("purchase_price_per_unit")).cast(MONEY)
        .alias("estimated_stock_value"))

