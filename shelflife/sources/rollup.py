"""A rollup that keeps itself: the reports' measures by (warehouse, product, month).

Made from a published store period by period.  Beside the sums lies the state of the
files that each period was made from (number, bytes, latest change); :func:`refresh`
compares it with the store and makes only those periods again whose files changed, each
from its own partitions.  Reports over :class:`Rollup` read the sums and the dimensions,
never a fact.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflife.operators.cells import CELLS
from shelflife.session import PACKED
from shelflife.sources.store import PERIOD, Store, next_period, period_of
from shelflife.tables import Tables

STATE = "period string, files string, written_ns long"


class Rollup(Tables):
    """The tables of a store with stored measures: ``cells`` gives them to the reports.

    With ``fresh`` a measure is brought up to date (:func:`refresh`) when it is first read;
    otherwise the caller has refreshed ``root``.
    """

    def __init__(self, store: Store, root: str, fresh: bool = False):
        super().__init__({n: (lambda n=n: store[n]) for n in store})
        self._spark, self._root, self._store = store["dim_products"].sparkSession, root.rstrip("/"), store
        self._stale, self._lock = set(CELLS) if fresh else set(), threading.Lock()

    def cells(self, name: str) -> DataFrame:
        with self._lock:
            if name in self._stale:
                refresh(self._store, self._root, [name])
                self._stale.remove(name)
        return self._spark.read.parquet(f"{self._root}/{name}").drop(PERIOD)


def _folders(spark: SparkSession, path: str) -> dict[str, str]:
    """{period: state of its files} of a partitioned folder, by listing it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = {}
    for folder in fs.listStatus(p) if fs.exists(p) else []:
        name = folder.getPath().getName()
        if folder.isDirectory() and name.startswith(f"{PERIOD}="):
            files = [f for f in fs.listStatus(folder.getPath()) if f.isFile()]
            out[name.split("=", 1)[1]] = (f"{len(files)} {sum(f.getLen() for f in files)} "
                                          f"{max((f.getModificationTime() for f in files), default=0)}")
    return out


def sources(store: Store, name: str) -> dict[str, str]:
    """{period: state of the fact files that the cell's period is made from}."""
    spark = store["dim_products"].sparkSession
    per = [_folders(spark, f"{store.folder}/{fact}") for fact in CELLS[name].facts]
    return {p: " / ".join(f.get(p, "-") for f in per) for p in per[0]}


def _known(spark: SparkSession, root: str, name: str) -> dict[str, str]:
    """{period: state of the files that it was last made from}."""
    try:
        log = spark.read.schema(STATE).json(f"{root}/_sources/{name}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    latest = log.groupBy("period").agg(F.max_by("files", "written_ns").alias("files")).where("files <> 'gone'")
    return {r["period"]: r["files"] for r in latest.collect()}    # one row a period


def _sums(store: Store, name: str, periods: list[str]) -> DataFrame:
    """A cell's rows of some periods: one exchange, that of the sums.  It deals each period
    over the tasks, so the write needs no other."""
    cell = CELLS[name]
    facts = Tables({f: (lambda f=f: _periods(store, f, periods)) for f in cell.facts})
    sums = cell.added(cell.rows(facts), F.trunc(cell.date, "month").alias(cell.date))
    return sums.withColumn(PERIOD, period_of(cell.date, store.unit))


def refresh(store: Store, root: str, names: Iterable[str] = tuple(CELLS)) -> dict[str, list[str]]:
    """Bring the cells ``names`` (all) of the rollup under ``root`` up to date; returns the
    periods made again, by cell.

    A period's folder is replaced whole and its state noted after that, so a refresh that
    was killed makes the period again.
    """
    import time

    from shelflife.sources.files import _each, _remove_path

    spark, root = store["dim_products"].sparkSession, root.rstrip("/")
    done: dict[str, list[str]] = {}

    def bring(name: str) -> None:
        now, known = sources(store, name), _known(spark, root, name)
        changed = sorted(p for p, files in now.items() if known.get(p) != files)
        gone = sorted(p for p in known if p not in now)
        if changed:
            (_sums(store, name, changed)
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**PACKED)
             .partitionBy(PERIOD).parquet(f"{root}/{name}"))
        for p in gone:
            _remove_path(spark, f"{root}/{name}/{PERIOD}={p}")
        done[name] = changed + gone
        note = [(p, now.get(p, "gone"), time.time_ns()) for p in changed + gone]
        if note:
            spark.createDataFrame(note, STATE).coalesce(1).write.mode("append").json(f"{root}/_sources/{name}")

    _each(names, bring)
    return done


def _periods(store: Store, fact: str, periods: list[str]) -> DataFrame:
    """A fact's rows in some periods.  Neighbouring periods are one range of the scan."""
    days = sorted(dt.date.fromisoformat(p) for p in periods)
    out, start, end = None, days[0], next_period(days[0], store.unit)
    for d in [*days[1:], None]:
        if d == end:
            end = next_period(d, store.unit)
            continue
        part = store.between(fact, start, end)
        out = part if out is None else out.unionByName(part)
        if d is not None:
            start, end = d, next_period(d, store.unit)
    return out
