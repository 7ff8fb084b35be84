import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelflife.llm import queries, topk


def brute(rows, is_query, k=10):
    """rows: (vec_id, vector or None).  Every query row against every other row."""
    whole = []
    for i, (vid, v) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) and math.isfinite(1024 * x) for x in v):
            whole.append((i, vid, [math.floor(1024 * x) for x in v]))
    out = []
    for i, vid, a in whole:
        if not is_query(vid):
            continue
        scored = []
        for j, other, b in whole:
            if j != i:
                s = max(topk.LEAST, min(topk.MOST, sum(x * y for x, y in zip(a, b))))
                scored.append((-s, other is None, other or 0, other))
        out += [(vid, n + 1, s[3], -s[0]) for n, s in enumerate(sorted(scored)[:k])]
    return out


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return df.withColumns({c: F.lit(5) for c in ("id", "v", "row", "q", "score", "rank", "top", "grp")})


def got(df):
    return sorted((tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()), key=str)


HUNDRED = "vec_id % 100 = 0"


def hundred(i):
    return i is not None and i % 100 == 0


def check(spark, rows, k=10):
    assert got(topk.top_k(table(spark, rows), HUNDRED, k)) == sorted(brute(rows, hundred, k), key=str)


def test_random_vectors_many_files(spark):
    r = random.Random(1)
    rows = [(i, [r.gauss(0, 0.2) for _ in range(7)]) for i in range(900)]
    df = table(spark, rows).repartition(6)
    assert got(topk.top_k(df, HUNDRED)) == sorted(brute(rows, hundred), key=str)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (100, None), (200, [1.0, None]), (300, [nan, 1.0]), (400, [1.0, inf]),
            (500, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 1.0]), (None, None),
            (600, []), (7, [0.5]), (8, [0.5, 0.25, 9.0]), (0, [1.0, 2.0]), (-100, [-1.0, -0.0001]), (9, [1e306, 1.0])]
    check(spark, rows)
    check(spark, rows, k=3)


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 0.0]) for i in range(400)] + [(1000 + i, [2.0, 1.0]) for i in range(5)]
    random.Random(3).shuffle(rows)
    check(spark, rows)


def test_scores_beyond_double_precision(spark):
    r = random.Random(5)
    rows = [(i, [r.uniform(-1, 1) * 10 ** r.choice([0, 3, 7, 9]) for _ in range(3)]) for i in range(301)]
    check(spark, rows)
    check(spark, rows + [(700, [1e12, 1e30]), (701, [-1e14, -1e30])])


def test_empty_and_without_queries(spark):
    assert topk.top_k(table(spark, []), HUNDRED).count() == 0
    assert topk.top_k(table(spark, [(1, [1.0])]), HUNDRED).count() == 0
    assert topk.top_k(table(spark, [(100, [1.0])]), HUNDRED).count() == 0   # no candidate but itself


def test_small_groups_give_the_same(spark, monkeypatch):
    r = random.Random(2)
    rows = [(i, [r.gauss(0, 0.3) for _ in range(4)]) for i in range(0, 1500, 5)]
    whole = got(topk.top_k(table(spark, rows).repartition(4), HUNDRED))
    monkeypatch.setattr(topk, "GROUP_ROWS", 4)
    assert got(topk.top_k(table(spark, rows).repartition(4), HUNDRED)) == whole == sorted(brute(rows, hundred), key=str)


def test_histograms_count_every_score(spark):
    """Without a limit on what is wanted, the bins hold all scores."""
    class Row:
        def __init__(self, row, id, v):
            self.row, self.id, self.v = row, id, v
    import pyarrow as pa
    r = np.random.default_rng(1)
    vecs = np.floor(r.normal(0, 100, (300, 3)))
    group = topk.Group([Row(i, i, list(vecs[i])) for i in range(5)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(list(vecs))], names=["row", "v"])
    low = np.full(5, -(1 << 20), np.int64)
    out = list(topk.histograms(group, low, 10, topk.BINS, np.full(5, 10 ** 9))(iter([batch])))[0].to_pylist()
    want = {}
    for q in range(5):
        for c in range(300):
            if c != q:
                at = (int(vecs[q] @ vecs[c]) + (1 << 20)) >> 10
                want[q, at] = want.get((q, at), 0) + 1
    assert {(x["q"], x["bin"]): x["n"] for x in out} == {k: v for k, v in want.items() if k[1] < topk.BINS}


@pytest.mark.parametrize("path", ["/root/testdata/sf0.01"])
def test_query_against_brute_force(spark, path):
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert got(queries.op13_histogram_topk(spark, path)) == sorted(brute(rows, hundred), key=str)
