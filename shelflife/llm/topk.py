"""Exact top-k search by distributed histogram selection.

Queries are stated rows of the table; every row of it is a candidate for each.

1. Vectors are turned into whole numbers once and written (:func:`quantised`).
2. Queries go out in groups of at most ``GROUP_ROWS`` rows and ``GROUP_BYTES`` bytes: a
   group is the only thing broadcast, whatever the size of the table.
3. For a group, every task scores all its candidates and counts them in histograms, one
   per query, of ``BINS`` bins over the range that still holds the query's kth score.
   Spark adds up the counts; the bin that the kth score lies in becomes the next range,
   ``BINS`` times finer, until a bin is one score wide and the kth score is known.
4. A last pass keeps the scores above the kth, and of those equal to it the smallest ids
   that are still wanted.  At most k rows a query leave a task, also where thousands of
   equal vectors tie; a window over the few rows left numbers the ranks.

Scores are recomputed in each pass, so no pass stores more than counts.  A task reports
a histogram from the top down to its own kth score: what lies below cannot hold the kth
score of all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelflife.llm.common import stored
from shelflife.session import scratch_path

GROUP_ROWS = 4096        # queries of one group
GROUP_BYTES = 16 << 20   # bytes of their vectors
BITS = 11
BINS = 1 << BITS
ROWS_AT_ONCE, QUERIES_AT_ONCE = 2048, 256   # sides of the block of scores that a task holds
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def quantised(df: DataFrame, scale: float) -> DataFrame:
    """(id, v, asked) to (id, v, top, asked): floor(scale * component) as whole doubles, and
    their largest size.

    Null vectors and those with a null, NaN or infinite component (also after scaling)
    are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vecs, asked = batch.columns
            offsets = np.asarray(vecs.offsets) - vecs.offsets[0].as_py() if len(vecs) else np.zeros(1, int)
            flat = vecs.flatten()
            with np.errstate(all="ignore"):
                v = np.floor(scale * flat.to_numpy(zero_copy_only=False).astype(np.float64))
            bad = ~np.isfinite(v) | np.asarray(flat.is_null())
            n_bad = np.concatenate(([0], np.cumsum(bad)))
            ok = (n_bad[offsets[1:]] == n_bad[offsets[:-1]]) & np.asarray(vecs.is_valid())
            rows = [v[a:b] for a, b, good in zip(offsets[:-1], offsets[1:], ok) if good]
            yield pa.RecordBatch.from_arrays(
                [ids.filter(pa.array(ok)), pa.array(rows, pa.list_(pa.float64())),
                 pa.array([float(np.abs(r).max()) if len(r) else 0.0 for r in rows], pa.float64()),
                 asked.filter(pa.array(ok))], names=["id", "v", "top", "asked"])

    # a null array would have no room in the flat values: it is left out before
    return (df.select(F.col("id").cast("long").alias("id"), F.col("v").cast("array<double>").alias("v"), "asked")
            .where(F.col("v").isNotNull()).mapInArrow(run, "id long, v array<double>, top double, asked boolean"))


def matrix(vecs: list[np.ndarray], width: int) -> np.ndarray:
    """Rows of one width; shorter vectors end in zeros, what is beyond the width has no partner."""
    out = np.zeros((len(vecs), width))
    for i, v in enumerate(vecs):
        out[i, :min(width, len(v))] = v[:width]
    return out


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows as int64; beyond 64 bits the nearest long."""
    bound = (np.abs(a).max(initial=0) * np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if bound < 2 ** 53:     # every partial sum is a whole number that a double holds
        return (a @ b.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in r] for r in m], dtype=object).reshape(m.shape)
    return np.clip(whole(a) @ whole(b).T, LEAST, MOST).astype(np.int64)


class Group:
    """The queries of one group, as they go out to the tasks."""

    def __init__(self, rows: list):
        self.rows = np.array([r.row for r in rows], np.int64)
        self.ids = [r.id for r in rows]
        width = max((len(r.v) for r in rows), default=0)
        self.vecs = matrix([np.array(r.v) for r in rows], width)

    def scored(self, batch: pa.RecordBatch) -> Iterator[tuple]:
        """Blocks of (first candidate, first query, scores, which of them are the query itself)."""
        rows = batch.column(batch.schema.get_field_index("row")).to_numpy()
        col = batch.column(batch.schema.get_field_index("v"))
        offsets, flat = np.asarray(col.offsets), np.asarray(col.values)
        for i in range(0, len(rows), ROWS_AT_ONCE):
            ends = offsets[i:i + ROWS_AT_ONCE + 1]
            lengths, width = np.diff(ends), self.vecs.shape[1]
            if len(lengths) and (lengths == width).all():
                m = flat[ends[0]:ends[-1]].reshape(-1, width)
            else:
                m = matrix([flat[x:y] for x, y in zip(ends[:-1], ends[1:])], width)
            for j in range(0, len(self.rows), QUERIES_AT_ONCE):
                s = inner_products(self.vecs[j:j + QUERIES_AT_ONCE], m)
                own = self.rows[j:j + QUERIES_AT_ONCE, None] == rows[None, i:i + ROWS_AT_ONCE]
                yield i, j, s, own


def histograms(group: Group, low: np.ndarray, shift: int, bins: int, wanted: np.ndarray):
    """Count the scores of a task in ``bins`` bins of 2**shift from ``low``, from the top down
    to the bin in which the task's own ``wanted``-th score lies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((len(low), bins), np.int64)
        for batch in batches:
            for _, j, s, own in group.scored(batch):
                # differences as unsigned numbers: what lies below the range wraps to beyond it
                at = (s.view(np.uint64) - low[j:j + len(s), None].view(np.uint64)) >> np.uint64(shift)
                inside = (at < bins) & ~own
                flat = (np.arange(len(s))[:, None] * bins + at.astype(np.int64))[inside]
                n[j:j + len(s)] += np.bincount(flat, minlength=len(s) * bins).reshape(-1, bins)
        above = np.cumsum(n[:, ::-1], axis=1)[:, ::-1] - n
        q, at = np.nonzero((n > 0) & (above < wanted[:, None]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(q.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(n[q, at])],
            names=["q", "bin", "n"])
    return run


def winners(group: Group, kth: np.ndarray, ties: np.ndarray):
    """A task's scores above the kth, and its ``ties`` smallest ids of those equal to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        equal = np.zeros((4, 0), np.int64)      # query, id is null, id, row
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]

        def rows(q, ids, none, row, score):
            return pa.RecordBatch.from_arrays(
                [pa.array(q, types[0]), pa.array(ids, types[1], mask=none.astype(bool)),
                 pa.array(row, types[2]), pa.array(score, types[3])], names=["q", "id", "row", "score"])

        for batch in batches:
            col = batch.column(batch.schema.get_field_index("id"))
            none, ids = np.asarray(col.is_null()), np.asarray(col.fill_null(0))
            row = batch.column(batch.schema.get_field_index("row")).to_numpy()
            for i, j, s, own in group.scored(batch):
                t = kth[j:j + len(s), None]
                q, c = np.nonzero((s > t) & ~own)
                if len(q):
                    yield rows(q + j, ids[c + i], none[c + i], row[c + i], s[q, c])
                q, c = np.nonzero((s == t) & ~own)
                if len(q):
                    equal = np.concatenate([equal, [q + j, none[c + i], ids[c + i], row[c + i]]], axis=1)
                    equal = equal[:, np.lexsort(equal[::-1])]
                    first = np.searchsorted(equal[0], equal[0], "left")
                    equal = equal[:, np.arange(equal.shape[1]) - first < ties[equal[0]]]
        q, none, ids, row = equal
        yield rows(q, ids, none, row, kth[q])
    return run


def _kth(cands: DataFrame, group: Group, k: int, top: float) -> tuple[np.ndarray, np.ndarray]:
    """The kth score of each query of a group, and how many equal to it are wanted.

    A query with fewer than k candidates gets the least long: all its candidates pass.
    """
    n, width = len(group.rows), group.vecs.shape[1]
    bound = min(int(np.abs(group.vecs).max(initial=0)) * int(top) * width, MOST - 1) + 1
    low = np.full(n, -bound, np.int64)
    above = np.zeros(n, np.int64)
    left = max(1, (2 * bound).bit_length())     # the range in bits
    short = np.zeros(n, bool)
    while left > 0:
        shift = max(0, left - BITS)
        counts = (cands.mapInArrow(histograms(group, low, shift, 1 << (left - shift), k - above), "q int, bin int, n long")
                  .groupBy("q", "bin").agg(F.sum("n").alias("n")))
        down = Window.partitionBy("q").orderBy(F.desc("bin"))
        at = (counts.withColumn("upto", F.sum("n").over(down))
              .join(cands.sparkSession.createDataFrame([(i, int(k - a)) for i, a in enumerate(above)],
                                                       "q int, wanted long"), "q")
              .where(F.col("upto") >= F.col("wanted"))
              .groupBy("q").agg(F.max_by(F.struct("bin", (F.col("upto") - F.col("n")).alias("over")), "bin")
                                .alias("b")).select("q", "b.*"))
        short[:] = True
        for q, bin_, over in at.collect():      # one row a query of the group
            short[q] = False
            low[q] = (int(low[q]) + (bin_ << shift) + (1 << 63)) % (1 << 64) - (1 << 63)
            above[q] += over
        if short.all():
            break
        left = shift
    kth = np.where(short, LEAST, low)
    return kth, np.where(short, k, k - above)


def top_k(df: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: float = 1024.0) -> DataFrame:
    """The ``k`` rows with the highest inner product for every query row, exactly.

    ``is_query`` is a condition on the table's columns that states the queries; all rows
    are candidates, but for a query's own row.  Vectors are floor(``scale`` * component).
    Returns query_id, rank (from 1), vec_id, score; fewer than ``k`` rows where there are
    fewer candidates.

    Ties go to the smaller id (null last).  Vectors that are null, or hold a null or
    non-finite component, take no part.  Where lengths differ, the shorter vector counts as
    ending in zeros; an empty vector scores 0.  Sums are exact whole numbers, also beyond
    double precision; a score outside of 64 bits becomes the nearest long.  Repeated rows are
    rows: a copy of a query is a candidate of it and, if its id is a query's, a query too.  A
    null id is a candidate; it is a query if ``is_query`` holds for it.  An empty table, or
    one without queries, gives no rows.  Other columns are not read.
    """
    spark = df.sparkSession
    asked = F.coalesce(F.expr(is_query) if isinstance(is_query, str) else is_query, F.lit(False))
    named = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"), asked.alias("asked"))
    cands = stored(quantised(named, scale).withColumn("row", F.monotonically_increasing_id()), "vectors")
    queries = stored(_grouped(stored(cands.where("asked"), "asked")), "queries")
    groups, top = queries.agg(F.max("grp")).first()[0], cands.agg(F.max("top")).first()[0]
    schema = "query_id long, rank int, vec_id long, score long"
    if groups is None:
        return spark.createDataFrame([], schema)
    out = scratch_path(spark, "llm-topk")
    bare = cands.select("row", "id", "v")
    for g in range(groups + 1):
        group = Group(queries.where(F.col("grp") == g).orderBy("row").collect())
        if not len(group.rows):
            continue
        kth, ties = _kth(bare, group, k, top)
        names = spark.createDataFrame([(i, v) for i, v in enumerate(group.ids)], "q int, query_id long")
        best = Window.partitionBy("q").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row")
        (bare.mapInArrow(winners(group, kth, ties), "q int, id long, row long, score long")
         .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
         .join(F.broadcast(names), "q")   # GROUP_ROWS rows at most
         .select("query_id", "rank", F.col("id").alias("vec_id"), "score")
         .write.mode("append").parquet(out))
    return spark.read.schema(schema).parquet(out)


def _grouped(queries: DataFrame) -> DataFrame:
    """Number the queries through and cut them into groups of bounded rows and bytes.

    Rows are counted per written part and numbered inside it, so no task sees them all.
    """
    q = queries.withColumn("part", F.shiftright("row", 33))
    sizes = q.groupBy("part").agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)   # one row a written part
    base = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    width = queries.agg(F.coalesce(F.max(F.size("v")), F.lit(0))).first()[0]
    size = max(1, min(GROUP_ROWS, GROUP_BYTES // max(1, 8 * width)))
    inside = Window.partitionBy("part").orderBy("row")
    return (q.withColumn("at", F.row_number().over(inside)).join(base, "part")
            .select("id", "v", "row", F.expr(f"cast((base + at - 1) div {size} as int)").alias("grp")))
