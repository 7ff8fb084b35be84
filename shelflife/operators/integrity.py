"""Key, NOT NULL, foreign-key and domain checks.

Spark enforces none of the model's constraints, so each is a distributed
check returning one row per constraint with the number of offenders.  All
checks are aggregates (partial + final) or anti joins; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflife.operators.common import Tables, union_all
from shelflife.schemas import (FOREIGN_KEYS, PRIMARY_KEYS, SCHEMAS, TABLE_NAMES,
                               UNIQUE_KEYS, VARCHAR_WIDTHS, decimal_columns)


def _duplicates(df: DataFrame, table: str, keys: tuple[str, ...]) -> DataFrame:
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.count_if(F.col("n") > 1).alias("duplicate_keys"))
            .select(F.lit(table).alias("table_name"),
                    F.lit(", ".join(keys)).alias("key_columns"), "duplicate_keys"))


def pk_violations(t: Tables) -> DataFrame:
    """B1: per primary / unique key, the number of key values held by more than one row."""
    checks = [(n, k) for n, k in PRIMARY_KEYS.items()] + [(n, k) for n, k in UNIQUE_KEYS.items()]
    return union_all([_duplicates(t[n], n, k) for n, k in checks])


def not_null_violations(t: Tables) -> DataFrame:
    """B2: per (table, column), the number of NULLs (every column is declared NOT NULL).

    One scan per table: all null counts are one aggregate, then unpivoted.
    """
    frames = []
    for n in (n for n in TABLE_NAMES if n in t):
        cols = [f.name for f in SCHEMAS[n].fields]
        wide = t[n].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        frames.append(
            wide.unpivot([], cols, "column_name", "violations")
            .select(F.lit(n).alias("table_name"), "column_name", "violations"))
    return union_all(frames)


def fk_violations(t: Tables, parents=None) -> DataFrame:
    """Per foreign key, the child rows whose parent key does not exist (NULL keys excluded).

    A child's rows are counted per value of a key (map-side combined, so a hot key costs one
    row) before they meet the parent's keys: what moves are values of that key, not rows or
    tuples of keys, and a child stored in buckets of its key does not move.  ``parents`` gives
    the parent's keys for (child, column, parent, parent column) where they do not come
    from ``t``.
    """
    frames = []
    for child, col, parent, pcol in (k for k in FOREIGN_KEYS if k[0] in t):
        keys = (parents(child, col, parent, pcol) if parents else t[parent]).select(F.col(pcol).alias("_k")).distinct()
        values = t[child].where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
        # (the optimizer would push an anti join below the counts, and move every row)
        lost = F.sum(F.when(F.col("_k").isNull(), F.col("n")))
        orphans = values.join(keys, F.col(col) == F.col("_k"), "left").agg(
            F.coalesce(lost, F.lit(0)).cast("bigint").alias("orphans"))
        frames.append(orphans.select(
            F.lit(child).alias("child"), F.lit(col).alias("fk_column"), F.lit(parent).alias("parent"), "orphans"))
    return union_all(frames)


def post_load_counts(t: Tables) -> DataFrame:
    """Row count per table as load confirmation."""
    from shelflife.operators.quality import row_counts
    return row_counts(t)


def domain_violations(t: Tables, widths: dict | None = None) -> DataFrame:
    """Values outside the declared column domain.

    Strings longer than their declared width, and decimals that do not fit
    their declared precision and scale (checked with ``try_cast`` so text
    columns read without a schema are covered too).
    """
    widths = dict(VARCHAR_WIDTHS if widths is None else widths)
    frames = []
    for n in (n for n in TABLE_NAMES if n in t):
        checks = []
        for (tn, c), w in widths.items():
            if tn == n:
                checks.append((c, F.count_if(F.length(F.col(c)) > w)))
        for c, p, s in decimal_columns(n):
            v = F.col(c)
            fitted = F.expr(f"try_cast(`{c}` AS DECIMAL({p},{s}))")
            exact = fitted.cast(T.DecimalType(38, 18)) == v.cast(T.DecimalType(38, 18))
            checks.append((c, F.count_if(v.isNotNull() & (fitted.isNull() | ~exact))))
        if not checks:
            continue
        wide = t[n].agg(*[e.alias(c) for c, e in checks])
        frames.append(
            wide.unpivot([], [c for c, _ in checks], "column_name", "violations")
            .select(F.lit(n).alias("table_name"), "column_name", "violations"))
    return union_all(frames)
