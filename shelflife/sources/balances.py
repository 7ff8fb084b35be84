"""Lot balances by period: snapshots at the start of each period and the movements since.

Stock at a date needs all that left a lot up to that date.  Read from the facts that is
the whole history of sales and bridge for every date asked.  Here the history is added up
once: ``snapshots`` hold, for each period, the lots that are alive in it and what had left
them before it; ``movements`` hold what left each lot, day by day, in its period.  A date
is answered from the one snapshot and the one period of movements that hold it, found by
their partitions; ``expired`` keeps the lots that ran out of time in each period with the
units they still held, ``positions`` each lot's totals by the period of its expiry.

:func:`build` makes all periods in one pass over the facts; :func:`advance` adds the next
period from the facts of that period and the snapshot before it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelflife.functions.dates import as_date
from shelflife.operators.common import EXPIRY
from shelflife.operators.staging import lot_position
from shelflife.session import PACKED
from shelflife.sources.store import PERIOD, Store, first_day, in_periods, next_period, period_of

LOT = "batch_id string, warehouse_id string, product_id string, receipt_date date, expiry_date date, quantity_received int"
SCHEMAS = {
    "movements": f"batch_id string, day date, q long, {PERIOD} date",
    "snapshots": f"{LOT}, out_before long, {PERIOD} date",
    "expired": "batch_id string, warehouse_id string, product_id string, expiry_date date, quantity_left long, "
               f"{PERIOD} date",
    "positions": f"{LOT}, purchase_price_per_unit decimal(10,4), total_units_sold long, "
                 f"total_units_written_off long, current_stock long, {PERIOD} date",
}
LOT_COLUMNS = ["batch_id", "warehouse_id", "product_id", "receipt_date", "expiry_date", "quantity_received"]


def _movements(sales: DataFrame, bridge: DataFrame, adjustments: DataFrame) -> DataFrame:
    """(batch_id, day, q): units that left each lot on each day, sold or adjusted."""
    sold = bridge.join(sales.select("sale_id", F.col("sale_date").alias("day")), "sale_id").select(
        "batch_id", "day", F.col("quantity_from_batch").alias("q"))
    adjusted = adjustments.select("batch_id", F.col("adjustment_date").alias("day"), F.col("quantity_adjusted").alias("q"))
    return sold.unionByName(adjusted).groupBy("batch_id", "day").agg(F.sum("q").cast("long").alias("q"))


def _read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{root.rstrip('/')}/{name}")


def _ran_out(snapshots: DataFrame, movements: DataFrame, unit: str) -> DataFrame:
    """Lots whose expiry lies in the period of their snapshot, with the units left then."""
    lots = snapshots.where(period_of("expiry_date", unit) == F.col(PERIOD))
    out = (movements.join(lots.select("batch_id", PERIOD, "expiry_date"), ["batch_id", PERIOD])
           .where(F.col("day") < F.col("expiry_date")).groupBy("batch_id").agg(F.sum("q").alias("out")))
    left = F.col("quantity_received") - F.col("out_before") - F.coalesce("out", F.lit(0))
    return (lots.join(out, "batch_id", "left").where(left > 0)
            .select("batch_id", "warehouse_id", "product_id", "expiry_date", left.alias("quantity_left"), PERIOD))


def _before(alive: DataFrame, moves: DataFrame) -> DataFrame:
    """Lots by the periods that they are alive in, with the units that had left them before.

    Lots' periods and movements meet in one dealing out by lot, which both the sums by
    period and the running sum over them keep to.  Where movements have their ``day``, the
    units that left a lot in a period before it expired are added up on the way (``out_unexpired``).
    """
    own = ["batch_id", PERIOD, "q"]
    by_day = "day" in moves.columns
    whole = (alive.select(*own, F.struct(*LOT_COLUMNS[1:]).alias("lot"))
             .unionByName(moves.select(*own, *["day"] * by_day), allowMissingColumns=True).repartition("batch_id"))
    sums = [F.sum("q").alias("q"), F.first("lot", True).alias("lot")]
    if by_day:
        here = Window.partitionBy("batch_id", PERIOD)
        whole = whole.withColumn("lot", F.first("lot", True).over(here))
        sums.append(F.sum(F.when(F.col("batch_id").isNotNull() & (F.col("day") < F.col("lot.expiry_date")), F.col("q")))
                    .alias("out_unexpired"))
    per = whole.groupBy("batch_id", PERIOD).agg(*sums)
    before = Window.partitionBy("batch_id").orderBy(PERIOD).rowsBetween(Window.unboundedPreceding, -1)
    return (per.withColumn("out_before", F.coalesce(F.sum("q").over(before), F.lit(0)))
            .where("lot is not null")
            .select("batch_id", "lot.*", "out_before", *["out_unexpired"] * by_day, PERIOD))


def build(store: Store, root: str, until: dt.date | None = None) -> None:
    """Write the balances of all periods (before ``until``) from the published facts.

    A lot is in the snapshot of every period from its receipt to its expiry; what left it
    before is a running sum over its periods, one row each, however many sales it served.
    What left it in the period of its expiry is stored with that, so the lots that ran out of
    time are read from their snapshots alone.  Movements dated before the period of their lot's receipt count from that period on.
    """
    spark, unit, root = store["fact_sales"].sparkSession, store.unit, root.rstrip("/")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(df: DataFrame, name: str, *more: str) -> DataFrame:
        columns = [c.split()[0] for c in SCHEMAS[name].split(", ")]
        (in_periods(df.select(*more, *columns), unit, n, "batch_id")
         .write.mode("overwrite").options(**PACKED).partitionBy(PERIOD).parquet(f"{root}/{name}"))
        return _read(spark, root, name)

    facts = [store.between(f, None, until) for f in ("fact_sales", "fact_sale_batch_map", "fact_inventory_adjustments")]
    moves = write(_movements(*facts).withColumn(PERIOD, period_of("day", unit)), "movements")
    lots = store.between("fact_goods_receipts", None, until)
    last = F.least(period_of("expiry_date", unit),
                   F.lit(None).cast("date") if until is None else F.lit(first_day(until - dt.timedelta(days=1), unit)))
    first = period_of("receipt_date", unit)
    step = F.expr({"month": "interval 1 month", "quarter": "interval 3 months", "year": "interval 1 year"}[unit])
    alive = lots.where(first <= last).select(
        *LOT_COLUMNS, F.explode(F.sequence(first, last, step)).alias(PERIOD), F.lit(0).cast("long").alias("q"))
    write(_before(alive, moves), "snapshots", "out_unexpired")
    snaps = spark.read.schema(f"out_unexpired long, {SCHEMAS['snapshots']}").parquet(f"{root}/snapshots")
    left = F.col("quantity_received") - F.col("out_before") - F.coalesce("out_unexpired", F.lit(0))
    ended = snaps.where((period_of("expiry_date", unit) == F.col(PERIOD)) & (left > 0))
    write(ended.withColumn("quantity_left", left), "expired")
    write(lot_position(lots, facts[1], facts[2]).withColumn(PERIOD, period_of("expiry_date", unit)), "positions")


def advance(store: Store, root: str, period: dt.date) -> None:
    """Add the period that begins on ``period`` to balances that end before it.

    Reads the facts of that period, and the snapshot and movements of the one before.
    Each folder is written whole, so a step that was killed is simply run again.
    """
    spark, unit, root = store["fact_sales"].sparkSession, store.unit, root.rstrip("/")
    if period != first_day(period, unit):
        raise ValueError(f"{period} is not the first day of a {unit}")
    end, old = next_period(period, unit), F.col(PERIOD) == F.lit(first_day(period - dt.timedelta(days=1), unit))
    facts = [store.between(f, period, end) for f in ("fact_sales", "fact_sale_batch_map", "fact_inventory_adjustments")]
    _movements(*facts).write.mode("overwrite").parquet(f"{root}/movements/{PERIOD}={period}")
    gone = _read(spark, root, "movements").where(old).groupBy("batch_id").agg(F.sum("q").alias("q"))
    kept = (_read(spark, root, "snapshots").where(old & (F.col("expiry_date") >= F.lit(period)))
            .join(gone, "batch_id", "left")
            .select(*LOT_COLUMNS, (F.col("out_before") + F.coalesce("q", F.lit(0))).alias("out_before")))
    new = store.between("fact_goods_receipts", period, end).where(F.col("expiry_date") >= F.lit(period)).select(
        *LOT_COLUMNS, F.lit(0).cast("long").alias("out_before"))
    kept.unionByName(new).write.mode("overwrite").parquet(f"{root}/snapshots/{PERIOD}={period}")
    now = F.col(PERIOD) == F.lit(period)
    (_ran_out(_read(spark, root, "snapshots").where(now), _read(spark, root, "movements").where(now), unit)
     .drop(PERIOD).write.mode("overwrite").parquet(f"{root}/expired/{PERIOD}={period}"))


# ---- questions at a date ---------------------------------------------------------

def stock_on_hand(spark: SparkSession, root: str, as_of: dt.date, unit: str) -> DataFrame:
    """M6 from one snapshot and one period of movements: stock per (warehouse, product)."""
    d, now = as_date(as_of), F.col(PERIOD) == F.lit(first_day(as_of, unit))
    lots = _read(spark, root, "snapshots").where(now & (F.col("receipt_date") <= d) & (F.col("expiry_date") > d))
    out = (_read(spark, root, "movements").where(now & (F.col("day") <= d))
           .groupBy("batch_id").agg(F.sum("q").alias("out")))
    left = F.col("quantity_received") - F.col("out_before") - F.coalesce("out", F.lit(0))
    return (lots.join(out, "batch_id", "left").groupBy("warehouse_id", "product_id")
            .agg(F.sum(left).alias("stock")))


def expiry_writeoffs(spark: SparkSession, root: str, as_of: dt.date, unit: str,
                     since: dt.date | None = None) -> DataFrame:
    """M9 from the lots that ran out of time, in the periods up to ``as_of``; with
    ``since``, those that did on or after it alone."""
    day: Column = F.col("expiry_date")
    rows = _read(spark, root, "expired").where((F.col(PERIOD) <= F.lit(first_day(as_of, unit))) & (day <= as_date(as_of)))
    if since is not None:
        rows = rows.where((F.col(PERIOD) >= F.lit(first_day(since, unit))) & (day >= as_date(since)))
    return rows.select("batch_id", "warehouse_id", "product_id", day.alias("adjustment_date"),
                       F.lit(EXPIRY).alias("adjustment_type"), F.col("quantity_left").alias("quantity_adjusted"))


def positions(spark: SparkSession, root: str, as_of: dt.date, unit: str) -> DataFrame:
    """Lots that expire after ``as_of`` and hold stock, from the periods of their expiry:
    the input of J5, K9 and K10."""
    return (_read(spark, root, "positions")
            .where((F.col(PERIOD) >= F.lit(first_day(as_of, unit))) & (F.col("expiry_date") > as_date(as_of)))
            .where(F.col("current_stock") > 0).drop(PERIOD))
