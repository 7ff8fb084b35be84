"""As-of join and balances at period ends."""

import datetime as dt
import random

from pyspark.sql import functions as F

from shelflife.operators import inventory as M
from shelflife.operators.running import as_of, dealt


def test_as_of_against_brute_force(spark):
    """Hot, null and factless keys over many chunks; asks before, at and after facts."""
    rng = random.Random(6)
    day0 = dt.date(2024, 1, 1)
    facts, asks = {}, []
    for i in range(400):
        k = rng.choice(["HOT"] * 6 + [None, "A", "B"])
        facts[k, day0 + dt.timedelta(days=rng.randrange(5, 900))] = (i, None if rng.random() < .1 else i * 2)
    for i in range(300):
        asks.append((rng.choice(["HOT"] * 6 + [None, "A", "C"]), day0 + dt.timedelta(days=rng.randrange(900))))
    asks += asks[:20]
    want = []
    for k, d in asks:
        seen = [x for (kk, x) in facts if kk == k and x <= d]
        want.append((k, d, *(facts[k, max(seen)] if seen else (None, None))))
    f = spark.createDataFrame([(k, d, *v) for (k, d), v in facts.items()], "k string, t date, a int, b int")
    q = spark.createDataFrame(asks, "k string, t date")
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    try:
        got = as_of(q, f, ["k"], "t", ["a", "b"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_as_of_without_facts_or_asks(spark):
    f = spark.createDataFrame([("a", 1, 5)], "k string, t int, v int")
    q = spark.createDataFrame([("a", 0), ("a", 1), ("b", 9)], "k string, t int")
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(as_of(q, f, ["k"], "t", ["v"])) == [("a", 0, None), ("a", 1, 5), ("b", 9, None)]
    assert rows(as_of(q, f.limit(0), ["k"], "t", ["v"])) == [("a", 0, None), ("a", 1, None), ("b", 9, None)]
    assert rows(as_of(q.limit(0), f, ["k"], "t", ["v"])) == []


def test_a_hot_pair_is_split(spark):
    n = 20_000
    rows = spark.range(n).select(F.when(F.col("id") % 3 > 0, F.lit("HOT")).otherwise(
        F.concat(F.lit("P"), F.col("id").cast("string"))).alias("k"), F.col("id").alias("t"), F.lit(0).alias("side"))
    spark.conf.set("spark.sql.shuffle.partitions", 64)
    try:
        assert dealt(rows, ["k"], ["t", "side"]).groupBy("_chunk").count().agg(F.max("count")).first()[0] < 0.04 * n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_balances_at_month_ends(small):
    got = M.balance_at_period_ends(small, "month")
    assert "BroadcastNestedLoopJoin" not in got._jdf.queryExecution().executedPlan().toString()
    pair = got.groupBy("warehouse_id", "product_id").count().orderBy("warehouse_id", "product_id").first()
    one = (F.col("warehouse_id") == pair[0]) & (F.col("product_id") == pair[1])
    ledger = sorted((r.ledger_date, r.balance) for r in M.inventory_ledger(small).where(one).collect())
    rows = sorted((r.period_end, r.balance) for r in got.where(one).collect())
    months = (ledger[-1][0].year - ledger[0][0].year) * 12 + ledger[-1][0].month - ledger[0][0].month + 1
    assert len(rows) == months
    for end, balance in rows:
        assert balance == [b for d, b in ledger if d <= end][-1]
