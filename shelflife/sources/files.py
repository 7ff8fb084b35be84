"""Readers and writers for the nine tables, full refresh, and extract row counts.

CSV is the interchange format of the model (headered, comma separated);
Parquet is the store.  Paths may be any Hadoop-compatible URI.  Scratch and
staging locations are always under a caller-given folder or the session's
shared checkpoint folder (never a machine-local temp dir).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflife.operators.common import union_all
from shelflife.schemas import SCHEMAS, TABLE_NAMES
from shelflife.session import scratch_path  # noqa: F401
from shelflife.sources.store import Store, forget_store, load_store, save_store
from shelflife.tables import Tables

NOT_FOUND = "NOT FOUND"


# ---- CSV ----------------------------------------------------------------------

def read_csv_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One headered CSV table with its declared schema; malformed rows fail the read.

    ``enforceSchema=False`` makes Spark check the header against the schema.
    """
    return (spark.read.schema(SCHEMAS[name])
            .option("header", True).option("mode", "FAILFAST")
            .option("enforceSchema", False).option("encoding", "UTF-8")
            .csv(path))


def load_tolerant(spark: SparkSession, path: str, name: str, staging: str, header: bool = True,
                  max_rejects: int | None = None) -> tuple[DataFrame, DataFrame]:
    """One table from CSV, malformed rows set apart: (good rows, rejects).

    Rejects: ``table_name, file, row_text, reason``; the reason names the number of fields
    where it is wrong, else the first column whose text does not fit its type.  The files
    are parsed once, into ``staging``; both results read that.  (Parsed for some columns
    only, a row is not found to be malformed in others.)  More than ``max_rejects`` rejected
    rows are an error.
    """
    schema = SCHEMAS[name]
    parsed = (spark.read.schema(T.StructType([*schema.fields, T.StructField("_row", T.StringType())]))
              .option("header", header).option("mode", "PERMISSIVE").option("encoding", "UTF-8")
              .option("columnNameOfCorruptRecord", "_row").csv(path))
    parsed.select("*", F.col("_metadata.file_path").alias("_file")).write.mode("overwrite").parquet(staging)
    staged = spark.read.parquet(staging)
    good = staged.where("_row is null").select(*schema.names)
    names = [f"c{i}" for i in range(len(schema.names))]
    text = F.from_csv("_row", ", ".join(f"{c} string" for c in names), {"mode": "PERMISSIVE"})
    fields = F.size(F.split("_row", ',(?=(?:[^"]*"[^"]*")*[^"]*$)'))    # commas outside of quotes
    wrong = [F.when(F.col(f"t.{c}").isNotNull() & F.col(f"t.{c}").try_cast(f.dataType).isNull(),
                    F.lit(f"{f.name} is not {f.dataType.simpleString()}")) for c, f in zip(names, schema.fields)]
    reason = F.when(fields != len(names), F.concat_ws(" ", fields.cast("string"), F.lit(f"fields of {len(names)}")))
    rejects = staged.where("_row is not null").withColumn("t", text).select(
        F.lit(name).alias("table_name"), F.col("_file").alias("file"), F.col("_row").alias("row_text"),
        F.coalesce(reason, *wrong, F.lit("unreadable")).alias("reason"))
    if max_rejects is not None and (n := rejects.count()) > max_rejects:
        raise RefreshFailed([f"{n} rows of {name} are malformed, {max_rejects} allowed"])
    return good, rejects


def load_csv(spark: SparkSession, folder: str, names: Iterable[str] = TABLE_NAMES) -> Tables:
    """A1: ``{name: DataFrame}`` over ``folder/<name>`` CSV extracts (lazy)."""
    folder = folder.rstrip("/")
    return Tables({n: (lambda n=n: read_csv_table(spark, f"{folder}/{n}", n)) for n in names})


def save_csv(df: DataFrame, path: str) -> None:
    """A3: write a table as headered CSV (one folder of part files)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def _each(names: Iterable[str], fn, parallel: int = 4) -> None:
    """Run ``fn(name)`` for every table; the writes are independent Spark jobs,
    so a few driver threads submit them together and they share the executors."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        list(pool.map(fn, list(names)))


def export_csv(tables: Mapping[str, DataFrame], folder: str,
               names: Iterable[str] = TABLE_NAMES) -> None:
    folder = folder.rstrip("/")
    _each(names, lambda n: save_csv(tables[n], f"{folder}/{n}"))


# ---- Parquet ------------------------------------------------------------------

def save_parquet(tables: Mapping[str, DataFrame], folder: str,
                 names: Iterable[str] = TABLE_NAMES) -> None:
    folder = folder.rstrip("/")
    _each(names, lambda n: tables[n].write.mode("overwrite").parquet(f"{folder}/{n}"))


def load_parquet(spark: SparkSession, folder: str, names: Iterable[str] = TABLE_NAMES) -> Tables:
    folder = folder.rstrip("/")
    return Tables({n: (lambda n=n: spark.read.schema(SCHEMAS[n]).parquet(f"{folder}/{n}"))
                   for n in names})


# ---- extract row counts -------------------------------------------------------

def file_row_counts(spark: SparkSession, folder: str,
                    names: Iterable[str] = TABLE_NAMES) -> DataFrame:
    """Data rows per extract, ``NOT FOUND`` for a missing one, and a total row.

    Columns: ``file_name, row_count, status``.  Each count is a distributed
    scan of that extract; missing extracts are detected by the failed read.
    """
    folder = folder.rstrip("/")
    frames = []
    for n in names:
        try:
            df = read_csv_table(spark, f"{folder}/{n}", n)
            df.schema  # noqa: B018 - resolves the path
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            frames.append(spark.range(1).select(
                F.lit(n).alias("file_name"), F.lit(None).cast("bigint").alias("row_count"),
                F.lit(NOT_FOUND).alias("status")))
            continue
        frames.append(df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(n).alias("file_name"), "row_count", F.lit("OK").alias("status")))
    per_file = union_all(frames)
    total = per_file.agg(F.sum("row_count").cast("bigint").alias("row_count")).select(
        F.lit("TOTAL ROWS").alias("file_name"),
        F.coalesce(F.col("row_count"), F.lit(0).cast("bigint")).alias("row_count"),
        F.lit("OK").alias("status"))
    return per_file.unionByName(total)


# ---- full refresh -------------------------------------------------------------

class RefreshFailed(RuntimeError):
    """A load that breaks a constraint; ``problems`` lists every broken one."""

    def __init__(self, problems: list[str]):
        super().__init__("constraint violations: " + "; ".join(problems))
        self.problems = problems


def problems(duplicates: DataFrame, nulls: DataFrame, orphans: DataFrame, domains: DataFrame) -> DataFrame:
    """One row per broken constraint: ``problem, rows``."""
    def named(df: DataFrame, kind: str, n: str, *names: str) -> DataFrame:
        return df.where(F.col(n) > 0).select(
            F.concat_ws(" ", F.lit(kind), *names).alias("problem"), F.col(n).alias("rows"))

    return union_all([
        named(duplicates, "duplicate key", "duplicate_keys", "table_name", "key_columns"),
        named(nulls, "null", "violations", "table_name", "column_name"),
        named(orphans, "orphan", "orphans", "child", "fk_column"),
        named(domains, "domain", "violations", "table_name", "column_name")])


def violations(t: Mapping[str, DataFrame]) -> DataFrame:
    """One row per broken constraint (B1, B2, B3, B5): ``problem, rows``."""
    from shelflife.operators.integrity import (domain_violations, fk_violations,
                                               not_null_violations, pk_violations)
    return problems(pk_violations(t), not_null_violations(t), fk_violations(t), domain_violations(t))


def full_refresh(spark: SparkSession, source: Mapping[str, DataFrame], target_root: str,
                 validate: bool = True, keep: int = 2, unit: str = "month",
                 buckets: int | None = None) -> Store:
    """Replace all nine tables with a new extract, validate, then publish.

    The new version is written to its own folder under ``target_root``; keys, NOT
    NULL, foreign keys and column domains are checked on what was written, and only
    if all hold is a row naming the version appended to the ``_published`` log.
    Readers take the latest row, so they never see a half-loaded or invalid version,
    and the publish step (a new file in an append-only log) never leaves a moment
    without a valid pointer.  A rejected version is removed; of the published ones
    the latest ``keep`` stay.  Facts are partitioned by the ``unit`` of their date, sales
    and bridge bucketed (:mod:`shelflife.sources.store`).  Returns the published tables.
    """
    import time

    root = target_root.rstrip("/")
    version = f"{root}/v-{uuid.uuid4().hex[:12]}"
    save_store(spark, source, version, unit, buckets)
    if validate:
        # at most one row per constraint
        found = violations(load_store(spark, version)).orderBy("problem").collect()
        if found:
            _remove(spark, version)
            raise RefreshFailed([f"{r.problem} ({r.rows})" for r in found])
    entry = spark.createDataFrame([(version, time.time_ns())], "version string, published_ns long")
    entry.coalesce(1).write.mode("append").json(f"{root}/_published")
    for old in _published(spark, root).offset(keep).collect():
        _remove(spark, old.version)
    return load_current(spark, root)


def _remove(spark: SparkSession, path: str) -> None:
    forget_store(spark, path)
    _remove_path(spark, path)


def _remove_path(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _published(spark: SparkSession, root: str) -> DataFrame:
    """The publish log, latest first: one row per refresh."""
    log = spark.read.schema("version string, published_ns long").json(f"{root}/_published")
    return log.orderBy(F.desc("published_ns"))


def load_current(spark: SparkSession, target_root: str) -> Store:
    """The tables of the version most recently published by :func:`full_refresh`, in the
    layout that they were written in, also in a session that did not write them."""
    root = target_root.rstrip("/")
    return load_store(spark, _published(spark, root).first()["version"])


def table_preview(df: DataFrame, order_by: list[str], n: int = 10,
                  columns: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows in an explicit key order (top-k, no full sort)."""
    out = df.select(*columns) if columns else df
    return out.orderBy(*order_by).limit(n)


def schema_columns(tables: Mapping[str, DataFrame], spark: SparkSession) -> DataFrame:
    """A5: column count per table, from the tables' actual schemas."""
    rows = [(n, len(tables[n].columns)) for n in sorted(tables)]
    return spark.createDataFrame(rows, "table_name string, column_count int")
