"""Exact distinct counts that can be merged.

Ids are numbered once by a dictionary; the numbers seen by a key in a period are bits of
bitmaps (Spark's bitmap functions: 32,768 numbers a bitmap).  Bitmaps of periods merge by
OR, and counting bits gives the exact distinct count of any set of periods, without
reading an id again.  Numbers follow the order of ``near`` and the id, so that the ids of
one key lie in few bitmaps.  Ids found later get higher numbers: no bitmap ever changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelflife.operators.running import dealt


def dictionary(ids: DataFrame, col: str, near: list[str] | None = None, known: DataFrame | None = None) -> DataFrame:
    """(``col``, n): a number from 1 for each distinct id (null has none).

    With ``known``, a dictionary made before, only what it lacks, numbered on from its end:
    the whole is their union.  Of an id with several ``near`` values the smallest counts.
    """
    near = near or []
    new = ids.where(F.col(col).isNotNull()).groupBy(col).agg(F.lit(1).alias("_one"), *[F.min(c).alias(c) for c in near])
    start = 1
    if known is not None:
        new = new.join(known, col, "left_anti")
        start = known.agg(F.coalesce(F.max("n") + 1, F.lit(1))).first()[0]
    d = dealt(new.drop("_one"), [], [*near, col])
    chunks = d.groupBy("_chunk").agg(F.count(F.lit(1)).alias("rows"), F.min("_at").alias("first"))
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)    # one row a chunk
    base = chunks.select("_chunk", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    return d.join(F.broadcast(base), "_chunk").select(
        col, (F.lit(start) + F.col("base") + F.col("_at") - F.col("first")).alias("n"))


def bitmaps(df: DataFrame, col: str, keys: list, numbers: DataFrame) -> DataFrame:
    """(keys, bucket, bitmap): the ids that each key has."""
    n = df.join(numbers, col)
    return n.groupBy(*keys, F.bitmap_bucket_number("n").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bitmap"))


def merge(maps: DataFrame, keys: list[str]) -> DataFrame:
    """Bitmaps by fewer keys."""
    return maps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_counts(maps: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The exact distinct count of each key."""
    return merge(maps, keys).groupBy(*keys).agg(
        F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).cast("bigint").alias(name))
