"""Business queries: expiry, stock-outs, suppliers, margin, ageing, warehouses.

Plan pattern used throughout: reduce each fact to its (warehouse, product[,
month]) grain with a partial + final aggregation first, then join the
dimensions and roll up.  A fact row therefore crosses the network once, inside
a map-side-combined aggregate, however skewed its keys are; the dimension
joins see one row per key.  Every measure rolled up this way composes exactly
(sums of decimal products and counts).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelflife.functions.dates import DEFAULT_AS_OF, age_band, band_rank, days_until
from shelflife.functions.money import CUM_MONEY, MONEY, RATE, pct, ratio_half_up
from shelflife.operators.cells import reduced
from shelflife.operators.common import Tables, products, warehouses
from shelflife.operators.staging import batch_position


def _month(c: str, by_year: bool) -> list:
    cols = [F.month(c).alias("sale_month")]
    if by_year:
        cols.insert(0, F.year(c).alias("sale_year"))
    return cols


# ---- expiry ------------------------------------------------------------------

def _expiry_by_product_warehouse(t: Tables) -> DataFrame:
    """Expiry write-offs reduced to (warehouse, product), joined to both dims.

    Same rows as filtering the enriched adjustments view on 'Expiry'.
    """
    return (
        reduced(t, "expiry").join(products(t, "category", "base_cost"), "product_id")
        .join(warehouses(t, "warehouse_id", "warehouse_name", "region"), "warehouse_id")
        .withColumn("cost", F.col("units") * F.col("base_cost"))
    )


def expiry_loss_by_category(t: Tables) -> DataFrame:
    """K1: expiry events, units and cost (units x base cost) per category."""
    return _expiry_by_product_warehouse(t).groupBy("category").agg(
        F.sum("events").alias("total_expiry_events"),
        F.sum("units").alias("total_unit_lost_to_expiry"),
        F.sum("cost").cast(MONEY).alias("total_cost_lost_to_expiry"),
    )


def expiry_loss_rate_by_category(t: Tables) -> DataFrame:
    """K2: units received vs units expired per category, with the loss rate.

    Categories with no expiry at all drop out (inner join), as in the model.
    """
    rec = (t["fact_goods_receipts"].groupBy("warehouse_id", "product_id", "supplier_id")
           .agg(F.sum("quantity_received").alias("units")))
    rec = (rec.join(products(t, "category"), "product_id")
           .join(warehouses(t, "warehouse_id"), "warehouse_id")
           .join(t["dim_suppliers"].select("supplier_id"), "supplier_id")
           .groupBy("category").agg(F.sum("units").alias("total_units_received")))
    exp = (_expiry_by_product_warehouse(t).groupBy("category")
           .agg(F.sum("units").alias("expired")))
    rate = pct(F.col("expired"), F.col("total_units_received"), num_scale=0, den_scale=0)
    return rec.join(exp, "category").select(
        "category", "total_units_received",
        F.col("expired").cast("double").alias("total_units_lost_to_expiry"),
        F.when(F.col("total_units_received") > 0, rate)
        .otherwise(F.lit(0).cast(RATE)).alias("expiry_loss_rate_percent"),
    )


def expiry_loss_by_warehouse(t: Tables) -> DataFrame:
    """K3: K1's measures per (warehouse name, region) and average cost per event."""
    return _expiry_by_product_warehouse(t).groupBy("warehouse_name", "region").agg(
        F.sum("events").alias("total_expiry_events"),
        F.sum("units").alias("total_unit_lost_to_expiry"),
        F.sum("cost").cast(MONEY).alias("total_cost_lost_to_expiry"),
        ratio_half_up(F.sum("cost"), F.sum("events"), num_scale=2, den_scale=0)
        .alias("avg_cost_lost_per_expiry_event"),
    )


# ---- stock-outs --------------------------------------------------------------

def _by_warehouse_category(df: DataFrame, t: Tables, **aggs) -> DataFrame:
    per = df.groupBy("warehouse_id", "product_id").agg(*[v.alias(k) for k, v in aggs.items()])
    return (per.join(products(t, "category"), "product_id")
            .groupBy("warehouse_id", "category")
            .agg(*[F.sum(k).alias(k) for k in aggs]))


def stockout_rate(t: Tables) -> DataFrame:
    """K4: stock-out events, units short and events per 100 sales, per (warehouse, category)."""
    so = _by_warehouse_category(t["fact_stockout_events"], t,
                                so_events=F.count(F.lit(1)), so_short=F.sum("shortfall"))
    sa = _by_warehouse_category(t["fact_sales"], t, sales_events=F.count(F.lit(1)))
    j = (so.join(sa, ["warehouse_id", "category"])
         .join(warehouses(t, "warehouse_id", "warehouse_name", "region"), "warehouse_id"))
    g = j.groupBy("warehouse_name", "category", "region").agg(
        F.sum("so_events").alias("total_stockout_events"),
        F.sum(F.col("so_short").cast("double")).alias("total_units_short"),
        F.sum("sales_events").alias("sales_events"),
    )
    return g.select(
        "warehouse_name", "category", "region", "total_stockout_events", "total_units_short",
        pct(F.col("total_stockout_events"), F.col("sales_events"), num_scale=0, den_scale=0)
        .alias("stockout_rate_percent"),
    )


# ---- suppliers ---------------------------------------------------------------

def receipts_reduced(t: Tables, *keys: Column | str) -> DataFrame:
    """Receipts of known products and warehouses, reduced to (supplier, product, warehouse,
    ``keys``) before the dimensions are tested: count, units, and price sum, max, min."""
    r = reduced(t, "receipts", *keys)
    return (r.join(products(t), "product_id", "left_semi")
            .join(warehouses(t, "warehouse_id"), "warehouse_id", "left_semi"))


def batches_per_supplier(t: Tables) -> DataFrame:
    """(supplier, batch) pairs with a receipt of a known product and warehouse, once each.

    ``batch_id`` is the key of the receipts, so this holds one row per receipt at most."""
    r = t["fact_goods_receipts"].groupBy("supplier_id", "batch_id", "product_id", "warehouse_id").agg(
        F.count(F.lit(1)).alias("n"))
    return (r.join(products(t), "product_id", "left_semi")
            .join(warehouses(t, "warehouse_id"), "warehouse_id", "left_semi")
            .groupBy("supplier_id", "batch_id").agg(F.sum("n").alias("n")))


def _average_cost() -> Column:
    return ratio_half_up(F.sum("price_sum"), F.sum("priced"), num_scale=4, den_scale=0).alias(
        "avg_cost_per_unit")


def supplier_delivery(t: Tables) -> DataFrame:
    """K5: distinct batches, units, average unit cost and reliability per supplier."""
    keys = ["supplier_name", "supplier_city", "reliability_score"]
    sup = t["dim_suppliers"].select("supplier_id", *keys)
    sums = receipts_reduced(t).join(sup, "supplier_id").groupBy(*keys).agg(
        F.sum("units").alias("total_units_received"), _average_cost())
    batches = batches_per_supplier(t).join(sup, "supplier_id").groupBy(*keys).agg(
        F.count_distinct("batch_id").alias("total_batches_received"))
    return sums.join(batches, keys).select(
        "supplier_name", "supplier_city", "total_batches_received",
        "total_units_received", "avg_cost_per_unit", "reliability_score")


def supplier_cost_volatility(t: Tables) -> DataFrame:
    """K6: average, max, min and range of unit cost per supplier, with lead time."""
    keys = ["supplier_name", "average_lead_time_days", "reliability_score"]
    r = receipts_reduced(t).join(t["dim_suppliers"].select("supplier_id", *keys), "supplier_id")
    top, low = F.max("price_max"), F.min("price_min")
    return r.groupBy(*keys).agg(
        _average_cost(), top.cast(RATE).alias("max_cost_per_unit"),
        low.cast(RATE).alias("min_cost_per_unit"), (top - low).cast(RATE).alias("price_range"))


# ---- margin ------------------------------------------------------------------

def _margin(t: Tables, revenue: str, by_year: bool) -> DataFrame:
    per = reduced(t, "margin", *_month("sale_date", by_year)).withColumn("rev", F.col(revenue))
    month_cols = ["sale_year", "sale_month"] if by_year else ["sale_month"]
    g = (per.join(products(t, "category"), "product_id")
         .join(warehouses(t, "warehouse_id"), "warehouse_id")
         .groupBy(*month_cols, "category")
         .agg(F.sum("rev").alias("rev"), F.sum("cost").alias("cost")))
    margin = F.col("rev") - F.col("cost")
    return g.select(
        *month_cols, "category",
        F.col("rev").cast(MONEY).alias("total_revenue"),
        F.col("cost").cast(MONEY).alias("total_cost"),
        margin.cast(MONEY).alias("gross_margin"),
        pct(margin, F.col("rev"), num_scale=4, den_scale=2).alias("gross_margin_percent"),
    )


def gross_margin_by_category_month(t: Tables, by_year: bool = False) -> DataFrame:
    """K7: revenue, cost, margin and margin % per (month, category).

    As written in the model, revenue is summed after joining sales to the
    sale-to-batch bridge, so a sale drawn from two batches counts twice; see
    :func:`gross_margin_allocated` for the corrected measure.  ``MONTH()``
    merges years unless ``by_year``.
    """
    return _margin(t, "sale_rev", by_year)


def gross_margin_allocated(t: Tables, by_year: bool = False) -> DataFrame:
    """As K7 with revenue allocated by batch quantity (no double count)."""
    return _margin(t, "rev", by_year)


# ---- warehouses --------------------------------------------------------------

def _warehouse_summaries(t: Tables) -> DataFrame:
    sales = (reduced(t, "sales").join(products(t), "product_id")
             .groupBy("warehouse_id").agg(F.sum("rev").cast(MONEY).alias("total_revenue")))
    w = warehouses(t, "warehouse_id", "warehouse_name", "region")
    expiry = (_expiry_by_product_warehouse(t).groupBy("warehouse_id")
              .agg(F.sum("cost").cast(MONEY).alias("total_expiry_loss")))
    so = (t["fact_stockout_events"].groupBy("warehouse_id")
          .agg(F.count(F.lit(1)).alias("total_stockout_events")))
    return (w.join(sales, "warehouse_id").join(expiry, "warehouse_id").join(so, "warehouse_id")
            .withColumn("expiry_loss_percent_of_revenue",
                        pct(F.col("total_expiry_loss"), F.col("total_revenue"),
                            num_scale=2, den_scale=2)))


def warehouse_scorecard(t: Tables) -> DataFrame:
    """K8: gross revenue, expiry loss, stock-outs and loss % of revenue per warehouse."""
    return _warehouse_summaries(t).select(
        "warehouse_id", "warehouse_name", "region", "total_revenue", "total_expiry_loss",
        "total_stockout_events", "expiry_loss_percent_of_revenue")


def warehouse_ranking(t: Tables) -> DataFrame:
    """The scorecard with dense ranks by revenue, loss % and stock-outs.

    The rank windows have no partition key: they run after the data is reduced
    to one row per warehouse, so the single window task holds one row per site.
    """
    s = _warehouse_summaries(t)
    rank = lambda *o: F.dense_rank().over(Window.orderBy(*o))
    return s.select(
        "warehouse_id", "warehouse_name", "region", "total_revenue",
        rank(F.desc("total_revenue")).alias("revenue_rank"),
        "total_expiry_loss",
        rank(F.asc_nulls_first("expiry_loss_percent_of_revenue")).alias("expiry_loss_percent_rank"),
        "total_stockout_events",
        rank(F.asc("total_stockout_events")).alias("stockout_rank"),
        "expiry_loss_percent_of_revenue",
    )


# ---- ageing ------------------------------------------------------------------

def active_batches(t: Tables, as_of=DEFAULT_AS_OF) -> DataFrame:
    """K9: open batches with stock at ``as_of``.

    Write-offs come from the enriched adjustments (rows whose product and
    warehouse exist), as in the model's query.
    """
    adj = (t["fact_inventory_adjustments"]
           .join(products(t), "product_id", "left_semi")
           .join(warehouses(t, "warehouse_id"), "warehouse_id", "left_semi"))
    return batch_position(t, as_of, adjustments=adj)


def inventory_aging_summary(t: Tables, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Batches, units and stock value per (warehouse, region, age band)."""
    b = active_batches(t, as_of).join(
        warehouses(t, "warehouse_id", "warehouse_name", "region"), "warehouse_id")
    band = age_band(days_until(F.col("expiry_date"), as_of))
    return (
        b.groupBy("warehouse_name", "region", band.alias("age_category")).agg(
            F.count(F.lit(1)).alias("total_batches"),
            F.sum("current_stock").alias("total_units_at_risk"),
            F.sum(F.col("current_stock") * F.col("purchase_price_per_unit")).cast(MONEY)
            .alias("estimated_stock_value"),
        )
    )


def inventory_aging_summary_sorted(t: Tables, as_of=DEFAULT_AS_OF) -> DataFrame:
    """K10 in report order: warehouse, then band severity."""
    return (inventory_aging_summary(t, as_of)
            .orderBy("warehouse_name", band_rank(F.col("age_category"))))


# ---- running totals ----------------------------------------------------------

def _monthly_revenue_by_category(t: Tables, by_year: bool) -> DataFrame:
    per = reduced(t, "sales", *_month("sale_date", by_year))
    month_cols = ["sale_year", "sale_month"] if by_year else ["sale_month"]
    return (per.join(products(t, "category"), "product_id")
            .join(warehouses(t, "warehouse_id"), "warehouse_id")
            .groupBy(*month_cols, "category")
            .agg(F.sum("rev").cast(MONEY).alias("monthly_revenue")))


def _monthly_expiry_by_category(t: Tables, by_year: bool) -> DataFrame:
    e = reduced(t, "expiry", *_month("adjustment_date", by_year))
    month_cols = ["sale_year", "sale_month"] if by_year else ["sale_month"]
    return (e.join(products(t, "category", "base_cost"), "product_id")
            .join(warehouses(t, "warehouse_id"), "warehouse_id")
            .groupBy(*month_cols, "category")
            .agg(F.sum(F.col("units") * F.col("base_cost")).cast(MONEY)
                 .alias("monthly_expiry_loss")))


def cumulative_revenue_and_expiry(t: Tables, by_year: bool = False) -> DataFrame:
    """Monthly revenue and expiry loss per category with running totals.

    Months missing on either side drop out before the running sums (inner
    join first, window second).  The window runs over one row per
    (category, month) — at most 12 per category, or 12 per year with ``by_year``.
    """
    month_cols = ["sale_year", "sale_month"] if by_year else ["sale_month"]
    j = _monthly_revenue_by_category(t, by_year).join(
        _monthly_expiry_by_category(t, by_year), [*month_cols, "category"])
    w = Window.partitionBy("category").orderBy(*month_cols)
    return j.select(
        *month_cols, "category", "monthly_revenue",
        F.sum("monthly_revenue").over(w).cast(CUM_MONEY).alias("cumulative_revenue"),
        "monthly_expiry_loss",
        F.sum("monthly_expiry_loss").over(w).cast(CUM_MONEY).alias("cumulative_expiry_loss"),
    )
