"""The published store: versions of the nine tables that keep their layout.

Facts are partitioned by the period (month, quarter, year) of their date, so a date range
reads its own folders; sales and the sale-to-batch bridge are besides bucketed and
sorted on ``sale_id`` inside each period, so their join needs no exchange on either side.
The bridge has no date of its own and takes its sales' period.

Buckets and partitions are properties of catalog tables.  A version writes down its
layout beside its data, so any later session registers the same tables over the files
(:func:`load_store`); the store does not depend on the catalog that wrote it.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflife.schemas import SCHEMAS, TABLE_NAMES
from shelflife.session import PACKED, tidy
from shelflife.tables import Tables

PERIOD = "period"       # the partition column: first day of the period
UNITS = ("month", "quarter", "year")


@dataclass(frozen=True)
class Layout:
    date: str                   # its date decides the period
    bucket: str | None = None   # bucketed and sorted on this column


LAYOUT: dict[str, Layout] = {
    "fact_sales": Layout("sale_date", "sale_id"),
    "fact_sale_batch_map": Layout("sale_date", "sale_id"),      # the date of its sale
    "fact_goods_receipts": Layout("receipt_date"),
    "fact_inventory_adjustments": Layout("adjustment_date"),
    "fact_stockout_events": Layout("stockout_date"),
}


def period_of(day: Column | str, unit: str) -> Column:
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}, not {unit!r}")
    return F.trunc(F.col(day) if isinstance(day, str) else day, unit)


def first_day(day: dt.date, unit: str) -> dt.date:
    """First day of the period of ``day``."""
    month = {"month": day.month, "quarter": (day.month - 1) // 3 * 3 + 1, "year": 1}[unit]
    return dt.date(day.year, month, 1)


def next_period(day: dt.date, unit: str) -> dt.date:
    """First day of the period after that of ``day``."""
    first, step = first_day(day, unit), {"month": 1, "quarter": 3, "year": 12}[unit]
    months = first.year * 12 + first.month - 1 + step
    return dt.date(months // 12, months % 12 + 1, 1)


def in_periods(df: DataFrame, unit: str, n: int, order: str) -> DataFrame:
    """``df`` as it is written by period.

    Where periods are years they are few: each task adds one file of its own to each, and no
    row moves.  Months and quarters would leave crumbs, so their rows are dealt out in ranges of
    (period, ``order``), which cut a period over as many tasks as its rows ask for.
    """
    return df if unit == "year" else df.repartitionByRange(n, PERIOD, order)


class Store(Tables):
    """The tables of one version, with their declared columns; periods by :meth:`between`."""

    def __init__(self, spark: SparkSession, folder: str, names: dict[str, str], unit: str):
        def build(n: str) -> DataFrame:
            if n in names:
                return spark.table(names[n]).select(*SCHEMAS[n].names)
            return spark.read.schema(SCHEMAS[n]).parquet(f"{folder}/{n}")
        super().__init__({n: (lambda n=n: build(n)) for n in TABLE_NAMES})
        self.folder, self.unit, self._spark, self._names = folder, unit, spark, names

    def create(self, name: str, table: str, comment: str, notes: Mapping[str, str]) -> None:
        """A catalog table over the files of ``name``, with comments on it and its columns."""
        buckets = self._spark.catalog.listColumns(self._names[name]) if name in self._names else []
        buckets = [c.name for c in buckets if c.isBucket]
        n = None
        if buckets:
            rows = self._spark.sql(f"DESCRIBE EXTENDED {self._names[name]}").where("col_name = 'Num Buckets'").collect()
            n = int(rows[0]["data_type"])
        _create(self._spark, self.folder, name, table, LAYOUT[name].bucket if n else None, n, comment, notes)

    def between(self, name: str, start: dt.date | None, end: dt.date | None) -> DataFrame:
        """Rows of a fact dated in [start, end), read from those periods alone.

        Of the bridge: the rows of all sales of these periods (join them to the sales
        between the same dates).  No bound on a side where the date is None.
        """
        df, day = self._spark.table(self._names[name]), LAYOUT[name].date
        if start is not None:
            df = df.where(F.col(PERIOD) >= F.lit(first_day(start, self.unit)))
        if end is not None:
            df = df.where(F.col(PERIOD) < F.lit(end))
        if day in SCHEMAS[name].names:
            if start is not None:
                df = df.where(F.col(day) >= F.lit(start))
            if end is not None:
                df = df.where(F.col(day) < F.lit(end))
        return df.select(*SCHEMAS[name].names)


def _registered(folder: str, name: str) -> str:
    return "shelflife_" + re.sub(r"\W", "_", folder.rstrip("/").rsplit("/", 1)[-1]) + "_" + name


def save_store(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str, unit: str = "month",
               buckets: int | None = None) -> None:
    """Write the nine tables to ``folder`` in their layout, then the note that says so.

    ``buckets`` per period; default: the shuffle partitions.  A killed write leaves a
    folder without a note, which :func:`load_store` refuses.
    """
    from shelflife.sources.files import _each

    tidy(spark)
    folder = folder.rstrip("/")
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(name: str) -> None:
        df, layout = tables[name].select(*SCHEMAS[name].names), LAYOUT.get(name)
        if layout is None:
            df.write.mode("overwrite").options(**PACKED).parquet(f"{folder}/{name}")
            return
        if layout.date in df.columns:
            df = df.withColumn(PERIOD, period_of(layout.date, unit))
        else:   # a sale's date; one row an id, so that no row of the bridge is multiplied
            days = tables["fact_sales"].groupBy("sale_id").agg(F.min("sale_date").alias("sale_date"))
            df = df.join(days, "sale_id", "left").withColumn(PERIOD, period_of("sale_date", unit)).drop("sale_date")
        if layout.bucket:
            # one bucket a task: a file a bucket and period
            out = (df.repartition(n, layout.bucket).write.bucketBy(n, layout.bucket).sortBy(layout.bucket))
        else:
            out = in_periods(df, unit, n, *SCHEMAS[name].names[:1]).write
        out.partitionBy(PERIOD).mode("overwrite").options(**PACKED).option("path", f"{folder}/{name}").saveAsTable(
            _registered(folder, name))

    _each([*TABLE_NAMES], write)
    note = [(name, layout.bucket, n if layout.bucket else None, unit) for name, layout in LAYOUT.items()]
    spark.createDataFrame(note, "table string, bucket string, buckets int, unit string").coalesce(1) \
        .write.mode("overwrite").json(f"{folder}/_layout")


def _create(spark: SparkSession, folder: str, name: str, table: str, bucket: str | None, buckets: int | None,
            comment: str, notes: Mapping[str, str]) -> None:
    """CREATE TABLE over the files of a version, in the layout that they have."""
    columns = [f"`{f.name}` {f.dataType.simpleString()} COMMENT '{notes.get(f.name, '')}'" for f in SCHEMAS[name].fields]
    layout = ""
    if name in LAYOUT:
        columns.append(f"{PERIOD} date COMMENT 'first day of the period of {LAYOUT[name].date}'")
        layout = f"PARTITIONED BY ({PERIOD})"
        if bucket:
            layout += f" CLUSTERED BY ({bucket}) SORTED BY ({bucket}) INTO {buckets} BUCKETS"
    spark.sql(f"CREATE TABLE {table} ({', '.join(columns)}) USING parquet {layout} "
              f"COMMENT '{comment}' LOCATION '{folder}/{name}'")
    if name in LAYOUT:
        spark.catalog.recoverPartitions(table)


def load_store(spark: SparkSession, folder: str) -> Store:
    """The tables of a folder; registers them in this session's catalog if it has not."""
    folder = folder.rstrip("/")
    note = spark.read.schema("table string, bucket string, buckets int, unit string").json(f"{folder}/_layout")
    names, unit = {}, None
    for r in note.collect():    # one row a fact
        unit, name = r["unit"], r["table"]
        names[name] = _registered(folder, name)
        if spark.catalog.tableExists(names[name]):
            continue
        _create(spark, folder, name, names[name], r["bucket"], r["buckets"], "", {})
    return Store(spark, folder, names, unit)


def forget_store(spark: SparkSession, folder: str) -> None:
    """Take a version's tables out of the catalog; their files stay."""
    for name in LAYOUT:
        spark.sql(f"DROP TABLE IF EXISTS {_registered(folder, name)}")
