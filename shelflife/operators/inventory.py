"""Stock operators built from the rules of the model's stock process.

Supplier choice, cold-storage eligibility, launch/status, expected demand,
purchase-cost variance, stock on hand, reorder points, the daily inventory
ledger, expiry write-offs and stock-out detection — each re-expressed as a
table operation over the recorded facts (no randomness, no day loop).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from shelflife.functions.dates import DEFAULT_AS_OF, as_date
from shelflife.functions.money import pct
from shelflife.operators.common import Tables, union_all, warehouses

# Fixed values of the model's stock rules.
COLD_CATEGORIES = ("Milk", "Fresh Juice", "Yogurt", "Ready Meals")
WEEKEND_MULTIPLIER = 1.55
REGION_DEMAND_MULTIPLIERS = {"North": 1.00, "South": 1.10, "East": 0.90, "West": 1.05, "Central": 1.20}
REORDER_BUFFER_DAYS = 1
NO_DEMAND_COVERAGE = 999.0
INFLATION_QUARTER, INFLATION_FACTOR = 3, "1.05"
DIP_QUARTER, DIP_FACTOR = 1, "0.96"
COST_BAND = "0.08"


def _dec(x: str, p: int = 3, s: int = 2) -> Column:
    from decimal import Decimal
    return F.lit(Decimal(x)).cast(T.DecimalType(p, s))


# ---- M1 ---------------------------------------------------------------------------

def primary_supplier(t: Tables) -> DataFrame:
    """One supplier per product: the flagged primary, else the lowest supplier id.

    A min over a (not-primary, supplier_id) struct: hash aggregation with
    map-side partial results, so a product with many suppliers cannot skew it.
    """
    sp = t["dim_supplier_products"]
    pick = F.min(F.struct((F.lit(1) - F.col("is_primary")).alias("rank"), F.col("supplier_id")))
    return sp.groupBy("product_id").agg(pick.alias("m")).select(
        "product_id", F.col("m.supplier_id").alias("supplier_id"))


# ---- M2 ---------------------------------------------------------------------------

def stockable_pairs(t: Tables, cold_categories=COLD_CATEGORIES) -> DataFrame:
    """(product, warehouse) pairs the cold-storage rule allows.

    Written as an equi join: a product needs cold storage or not; a warehouse
    with cold storage serves both needs, one without serves only the ambient
    need.
    """
    p = t["dim_products"].select(
        "product_id", F.col("category").isin(*cold_categories).cast("int").alias("need"))
    serves = F.when(F.col("cold_storage_flag") == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    w = warehouses(t, "warehouse_id", "cold_storage_flag").select(
        "warehouse_id", F.explode(serves).alias("need"))
    return p.join(w, "need").select("product_id", "warehouse_id")


# ---- M3 ---------------------------------------------------------------------------

def active_products(t: Tables, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Products with status 'Active' launched on or before ``as_of``."""
    p = t["dim_products"]
    return p.where((F.col("status") == "Active") & (F.col("launch_date") <= as_date(as_of)))


# ---- M4 ---------------------------------------------------------------------------

def base_daily_demand(t: Tables, until=None) -> DataFrame:
    """Average units sold per selling day, per (warehouse, product).

    Two aggregates: daily totals first (bounded by days per pair), then the
    average — no distinct-count expansion, and a hot pair is reduced map-side.
    """
    s = t["fact_sales"]
    if until is not None:
        s = s.where(F.col("sale_date") <= as_date(until))
    daily = s.groupBy("warehouse_id", "product_id", "sale_date").agg(F.sum("quantity_sold").alias("u"))
    return daily.groupBy("warehouse_id", "product_id").agg(
        (F.sum("u") / F.count(F.lit(1))).alias("base_daily_demand"))


def expected_demand(t: Tables, day=DEFAULT_AS_OF, region_factors=None, promo_boost: float = 1.0,
                    until=None) -> DataFrame:
    """Expected units for ``day`` per (warehouse, product).

    base x 1.55 on Saturday/Sunday x region factor (1.0 for an unlisted
    region) x promotion boost, rounded half to even, at least 1.  The base is made
    from sales up to ``until``, by default the day before ``day``.
    """
    factors = REGION_DEMAND_MULTIPLIERS if region_factors is None else region_factors
    fmap = F.create_map(*[x for k, v in factors.items() for x in (F.lit(k), F.lit(float(v)))])
    weekend = F.weekday(as_date(day)) >= 5
    d = F.col("base_daily_demand")
    d = F.when(weekend, d * F.lit(WEEKEND_MULTIPLIER)).otherwise(d)
    d = d * F.coalesce(fmap[F.col("region")], F.lit(1.0))
    d = d * F.lit(float(promo_boost))
    w = warehouses(t, "warehouse_id", "region")
    until = F.date_sub(as_date(day), 1) if until is None else until
    return base_daily_demand(t, until).join(w, "warehouse_id").select(
        "warehouse_id", "product_id", "base_daily_demand",
        F.greatest(F.lit(1), F.bround(d, 0).cast("int")).alias("expected_demand"))


# ---- M5 ---------------------------------------------------------------------------

def purchase_cost_variance(t: Tables) -> DataFrame:
    """Per batch: standard cost (base cost x quarter factor), actual cost, variance %.

    ``outside_band`` is 1 when the actual cost differs from standard by more
    than 8 %.
    """
    r = t["fact_goods_receipts"].select("batch_id", "product_id", "receipt_date",
                                        "purchase_price_per_unit")
    p = t["dim_products"].select("product_id", "base_cost")
    q = F.quarter("receipt_date")
    factor = (F.when(q == INFLATION_QUARTER, _dec(INFLATION_FACTOR))
              .when(q == DIP_QUARTER, _dec(DIP_FACTOR)).otherwise(_dec("1.00")))
    std = (F.col("base_cost") * factor).cast(T.DecimalType(10, 4))
    j = r.join(p, "product_id").select("batch_id", "purchase_price_per_unit", std.alias("standard_cost"))
    diff = F.col("purchase_price_per_unit") - F.col("standard_cost")
    return j.select(
        "batch_id", "standard_cost", "purchase_price_per_unit",
        pct(diff, F.col("standard_cost"), num_scale=4, den_scale=4).alias("variance_percent"),
        F.when(F.abs(diff) > F.col("standard_cost") * _dec(COST_BAND), 1).otherwise(0)
        .alias("outside_band"))


# ---- M6 / M9 ------------------------------------------------------------------------

def _outflow(t: Tables, lots: DataFrame, until: Column) -> DataFrame:
    """Units sold and adjusted per batch of ``lots`` where ``until`` (a condition on ``day``).

    Bridge and adjustments keep the lots in question alone (a semi-join on few keys)
    and are reduced to (batch, day) before their dates are tested.
    """
    ids = lots.select("batch_id")
    sales = t["fact_sales"].select("sale_id", F.col("sale_date").alias("day"))
    sold = (t["fact_sale_batch_map"].select("sale_id", "batch_id", F.col("quantity_from_batch").alias("q"))
            .join(ids, "batch_id", "left_semi").join(sales, "sale_id").select("batch_id", "day", "q"))
    adjusted = (t["fact_inventory_adjustments"].select(
        "batch_id", F.col("adjustment_date").alias("day"), F.col("quantity_adjusted").alias("q"))
        .join(ids, "batch_id", "left_semi"))
    daily = sold.unionByName(adjusted).groupBy("batch_id", "day").agg(F.sum("q").alias("q"))
    dates = lots.select("batch_id", "expiry_date")
    return (daily.join(dates, "batch_id").where(until)
            .groupBy("batch_id").agg(F.sum("q").alias("out")))


def stock_on_hand(t: Tables, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Units on hand at ``as_of`` per (warehouse, product), over unexpired batches.

    received (on or before ``as_of``) - sold (sales on or before ``as_of``, via
    the bridge) - adjusted (any type, on or before ``as_of``).
    """
    d = as_date(as_of)
    r = t["fact_goods_receipts"].where((F.col("receipt_date") <= d) & (F.col("expiry_date") > d))
    left = F.col("quantity_received") - F.coalesce(F.col("out"), F.lit(0))
    return (r.join(_outflow(t, r, F.col("day") <= d), "batch_id", "left")
            .groupBy("warehouse_id", "product_id").agg(F.sum(left).alias("stock")))


def expiry_writeoffs(t: Tables, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Write-off rows for batches expired by ``as_of`` that still hold units.

    The units left at expiry are those received minus sold and adjusted
    before the expiry date; the write-off is dated on the expiry date.
    """
    r = t["fact_goods_receipts"].where(F.col("expiry_date") <= as_date(as_of))
    left = F.col("quantity_received") - F.coalesce(F.col("out"), F.lit(0))
    return (r.join(_outflow(t, r, F.col("day") < F.col("expiry_date")), "batch_id", "left")
            .select("batch_id", "warehouse_id", "product_id",
                    F.col("expiry_date").alias("adjustment_date"),
                    F.lit("Expiry").alias("adjustment_type"),
                    left.alias("quantity_adjusted"))
            .where(F.col("quantity_adjusted") > 0))


# ---- M7 ---------------------------------------------------------------------------

def reorder_candidates(t: Tables, as_of=DEFAULT_AS_OF, cold_categories=COLD_CATEGORIES) -> DataFrame:
    """Coverage days and the reorder decision at ``as_of``, for every product that is on
    sale and every warehouse that may store it.

    coverage = stock / base daily demand (999 when there is no demand, 0 when there is
    demand but no stock); reorder when coverage < primary supplier lead time + 1 day.
    On-hand stock only (open orders are not netted), as in the model's rule.
    """
    keys = ["warehouse_id", "product_id"]
    pairs = stockable_pairs(t, cold_categories).join(
        active_products(t, as_of).select("product_id"), "product_id", "left_semi")
    sup = t["dim_suppliers"].select("supplier_id", F.col("average_lead_time_days").alias("lead_time_days"))
    terms = primary_supplier(t).join(sup, "supplier_id")
    # stock and demand are one row per pair; stacked, they meet the pairs in one exchange
    state = union_all([
        stock_on_hand(t, as_of).select(*keys, "stock", F.lit(None).cast("double").alias("base")),
        base_daily_demand(t, until=as_of).select(*keys, F.lit(None).cast("bigint").alias("stock"),
                                                 F.col("base_daily_demand").alias("base")),
    ]).groupBy(*keys).agg(F.max("stock").alias("stock"), F.max("base").alias("base"))
    j = pairs.join(state, keys, "left").join(terms, "product_id")
    stock = F.coalesce("stock", F.lit(0)).cast("bigint")
    base = F.coalesce("base", F.lit(0.0))
    cover = F.when(base == 0, F.lit(NO_DEMAND_COVERAGE)).otherwise(stock / base)
    return j.select(
        *keys, "supplier_id", stock.alias("stock"), base.alias("base_daily_demand"),
        cover.alias("coverage_days"), "lead_time_days",
        (cover < F.col("lead_time_days") + REORDER_BUFFER_DAYS).cast("int").alias("reorder"))


# ---- M8 ---------------------------------------------------------------------------

def inventory_ledger(t: Tables) -> DataFrame:
    """Daily running stock per (warehouse, product): + receipts - sales - adjustments.

    The three signed streams are reduced to one row per (pair, day) before
    the running-sum window, so the window sorts at most one row per calendar
    day for each pair, however many transactions a hot pair has.
    """
    k = ["warehouse_id", "product_id"]
    moves = (
        t["fact_goods_receipts"].select(*k, F.col("receipt_date").alias("ledger_date"),
                                        F.col("quantity_received").cast("bigint").alias("q"))
        .unionByName(t["fact_sales"].select(*k, F.col("sale_date").alias("ledger_date"),
                                            (-F.col("quantity_sold")).cast("bigint").alias("q")))
        .unionByName(t["fact_inventory_adjustments"].select(
            *k, F.col("adjustment_date").alias("ledger_date"),
            (-F.col("quantity_adjusted")).cast("bigint").alias("q")))
    )
    daily = moves.groupBy(*k, "ledger_date").agg(F.sum("q").alias("net_change"))
    w = Window.partitionBy(*k).orderBy("ledger_date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select(*k, "ledger_date", "net_change", F.sum("net_change").over(w).alias("balance"))


def balance_at_period_ends(t: Tables, unit: str = "month") -> DataFrame:
    """M8 at the last day of every period, from a pair's first movement to its last: the
    balance after the last movement on or before that day (an as-of join)."""
    from shelflife.operators.running import as_of
    k, months = ["warehouse_id", "product_id"], {"month": 1, "quarter": 3, "year": 12}[unit]
    ledger = inventory_ledger(t)
    span = ledger.groupBy(*k).agg(F.min("ledger_date").alias("a"), F.max("ledger_date").alias("b"))
    firsts = F.sequence(F.trunc("a", unit), F.trunc("b", unit), F.expr(f"interval {months} months"))
    asks = span.select(*k, F.explode(firsts).alias("first")).select(
        *k, F.date_sub(F.add_months("first", months), 1).alias("ledger_date"))
    return as_of(asks, ledger, k, "ledger_date", ["balance"]).withColumnRenamed("ledger_date", "period_end")


# ---- M11 --------------------------------------------------------------------------

def stockout_detection(demand: DataFrame) -> DataFrame:
    """Days on which supply fell short of demand, per (date, warehouse, product).

    ``demand`` has ``stockout_date, warehouse_id, product_id,
    quantity_demanded, quantity_supplied`` rows (any number per key).
    """
    k = ["stockout_date", "warehouse_id", "product_id"]
    g = demand.groupBy(*k).agg(F.sum("quantity_demanded").alias("quantity_demanded"),
                               F.sum("quantity_supplied").alias("quantity_supplied"))
    return (g.withColumn("shortfall", F.col("quantity_demanded") - F.col("quantity_supplied"))
            .where(F.col("shortfall") > 0))


def stockout_days(t: Tables) -> DataFrame:
    """M11 over all recorded demand: stock-out events, and sales as demand that was served."""
    k = ["stockout_date", "warehouse_id", "product_id"]
    served = t["fact_sales"].select(
        F.col("sale_date").alias("stockout_date"), "warehouse_id", "product_id",
        F.col("quantity_sold").alias("quantity_demanded"), F.col("quantity_sold").alias("quantity_supplied"))
    return stockout_detection(served.unionByName(
        t["fact_stockout_events"].select(*k, "quantity_demanded", "quantity_supplied")))


# ---- S9-S18: scalar rules in one projection ----------------------------------------

def scalar_derivations(t: Tables, max_units: int = 40) -> DataFrame:
    """Per sale: the row-level rules of the model as column expressions.

    Pack-size token of the product name, weekend flag, quarter, best-before
    date (sale date + shelf life), quantity clamped to [1, ``max_units``],
    net unit price rounded half to even, a day-scoped padded transaction
    number, ISO date text and the promotion flag.

    The transaction number counts sales inside (warehouse, day) in sale-id
    order; the running count is made in two levels (see
    :mod:`shelflife.operators.running`), so a busy warehouse-day is never one task.
    """
    from shelflife.functions import scalar as S
    from shelflife.operators.running import running_total
    s = t["fact_sales"].select("sale_id", "warehouse_id", "sale_date", "product_id", "quantity_sold",
                               "selling_price_per_unit", "discount_percent", F.lit(1).alias("_one"))
    s = running_total(s, ["warehouse_id", "sale_date"], ["sale_id"], "_one", "_seq")
    p = t["dim_products"].select("product_id", "product_name", "shelf_life_days")
    net = F.col("selling_price_per_unit") * (F.lit(1) - F.col("discount_percent"))
    return s.join(p, "product_id").select(
        "sale_id",
        S.last_token(F.col("product_name")).alias("name_token"),
        S.is_weekend(F.col("sale_date")).alias("is_weekend"),
        F.quarter("sale_date").alias("sale_quarter"),
        F.date_add("sale_date", F.col("shelf_life_days")).alias("best_before"),
        S.clamp(F.col("quantity_sold"), 1, max_units).alias("clamped_units"),
        F.bround(net, 2).cast(T.DecimalType(10, 2)).alias("net_unit_price"),
        F.concat_ws("-", "warehouse_id", F.date_format("sale_date", "yyyyMMdd"),
                    S.padded_id("T", F.col("_seq"), 5)).alias("txn_no"),
        S.iso_date(F.col("sale_date")).alias("sale_date_text"),
        S.flag(F.col("discount_percent") > 0).alias("discounted"),
    )
