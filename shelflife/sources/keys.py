"""Checks of an append against stored keys.

A load of new rows can break keys and foreign keys only through the new rows.  The keys of
what is already loaded lie in an index: one folder of hash buckets a key, each sorted.  A
delta is checked against those buckets that its own keys and references fall into; the
tables themselves are not read.  NOT NULL and domains concern the delta alone.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflife.operators import integrity as B
from shelflife.operators.common import union_all
from shelflife.schemas import FOREIGN_KEYS, PRIMARY_KEYS, SCHEMAS, UNIQUE_KEYS

BUCKETS = 64
BUCKET = "key_bucket"
KEYS = [*PRIMARY_KEYS.items(), *UNIQUE_KEYS.items()]


def _bucket(*cols: str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(BUCKETS)).cast("int")


def _path(root: str, table: str, keys: tuple[str, ...]) -> str:
    return f"{root.rstrip('/')}/{table}-{'-'.join(keys)}"


def add(tables: Mapping[str, DataFrame], root: str) -> None:
    """Add the keys of tables (a first load or a checked delta) to the index."""
    from shelflife.sources.files import _each

    def write(item) -> None:
        table, keys = item
        if table in tables:
            (tables[table].select(*keys, _bucket(*keys).alias(BUCKET)).repartition(BUCKET)
             .sortWithinPartitions(BUCKET, *keys).write.mode("append").partitionBy(BUCKET).parquet(_path(root, table, keys)))
    _each(KEYS, write)


def _known(spark: SparkSession, root: str, table: str, keys: tuple[str, ...], touched: DataFrame) -> DataFrame:
    """Stored keys in the buckets of ``touched`` (its columns are those of the key)."""
    schema = T.StructType([*[SCHEMAS[table][k] for k in keys], T.StructField(BUCKET, T.IntegerType())])
    at = [r[0] for r in touched.select(_bucket(*touched.columns)).distinct().collect()]    # at most BUCKETS numbers
    try:
        return spark.read.schema(schema).parquet(_path(root, table, keys)).where(F.col(BUCKET).isin(at)).select(*keys)
    except AnalysisException as e:      # nothing is loaded yet
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return touched.limit(0)


def duplicate_keys(delta: Mapping[str, DataFrame], root: str) -> DataFrame:
    """B1 of the tables of the delta: keys held by more than one row, old or new."""
    out = []
    for table, keys in KEYS:
        if table in delta:
            new = delta[table].select(*keys)
            old = _known(new.sparkSession, root, table, keys, new.select(*keys)).join(new.distinct(), list(keys), "left_semi")
            out.append(B._duplicates(new.unionByName(old), table, keys))
    return union_all(out)


def orphans(delta: Mapping[str, DataFrame], root: str) -> DataFrame:
    """B3 of the tables of the delta: new rows whose parent is neither loaded nor new."""
    def parent(child: str, col: str, table: str, pcol: str) -> DataFrame:
        refs = delta[child].select(F.col(col).alias(pcol)).where(F.col(pcol).isNotNull())
        old = _known(refs.sparkSession, root, table, (pcol,), refs)
        return old.unionByName(delta[table].select(pcol)) if table in delta else old
    if not any(child in delta for child, *_ in FOREIGN_KEYS):
        spark = next(iter(delta.values())).sparkSession
        return spark.createDataFrame([], "child string, fk_column string, parent string, orphans long")
    return B.fk_violations(delta, parent)


def check(delta: Mapping[str, DataFrame], root: str) -> DataFrame:
    """``problem, rows`` of every constraint that the delta breaks, worded as
    :func:`shelflife.sources.files.violations` words them for whole tables."""
    from shelflife.sources.files import problems
    return problems(duplicate_keys(delta, root), B.not_null_violations(delta), orphans(delta, root),
                    B.domain_violations(delta))
