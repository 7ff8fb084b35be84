"""Helpers shared by the operators: shared-folder tables, worker caches, Arrow batches."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflife.session import scratch_path

# The white space every operator agrees on, space and \t \n \v \f \r.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: fixes row order and keys,
    cuts lineage, and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{tag}")
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker process (over many tasks)."""
    return sys.modules.setdefault("_shelflife_worker", types.ModuleType("_shelflife_worker")).__dict__


def text_bytes(col: str = "text") -> Column:
    """A text column as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(col), F.lit("")).cast("binary")


def slices(batches: Iterator[pa.RecordBatch], col: str, limit: int = 8 << 20
           ) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a slice holds about ``limit`` bytes of ``col`` (one row at least)."""
    for batch in batches:
        i, n = 0, batch.num_rows
        if not n:
            continue
        ends = batch.column(batch.schema.get_field_index(col))
        sizes = pa.compute.binary_length(ends).to_pylist()
        size = 0
        for j in range(n):
            if j > i and size + sizes[j] > limit:
                yield batch.slice(i, j - i)
                i, size = j, 0
            size += sizes[j]
        yield batch.slice(i, n - i)
    pa.default_memory_pool().release_unused()


def partitions(spark: SparkSession, factor: int = 1) -> int:
    """Partitions for an explicit repartition: the session's shuffle width times ``factor``."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) * factor)


def key_crc(col: str = "doc_id") -> Column:
    """crc32 of an id written as text (null: of the empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))
