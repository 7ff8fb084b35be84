"""Mergeable distinct counts."""

import random

from pyspark.sql import functions as F

from shelflife.operators import distinct as D
from shelflife.operators import marts as L


def frame(spark, n=3000, seed=1):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "a", "b", None]), rng.randrange(6), f"id{rng.randrange(900):04d}" if rng.random() < .9 else None)
            for _ in range(n)]
    return spark.createDataFrame(rows, "k string, month int, id string")


def as_dict(df):
    return {tuple(r)[:-1]: tuple(r)[-1] for r in df.collect()}


def test_numbers_are_dense_and_near(spark):
    df = frame(spark)
    got = D.dictionary(df, "id", ["k"]).orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, len(got) + 1))
    assert {r.id for r in got} == {r.id for r in df.where("id is not null").select("id").distinct().collect()}


def test_merged_months_equal_count_distinct(spark):
    df = frame(spark)
    numbers = D.dictionary(df, "id", ["k"])
    maps = D.bitmaps(df, "id", ["k", "month"], numbers)
    for keys in (["k", "month"], ["k"], ["month"], []):
        got = D.distinct_counts(maps, keys, "n")
        assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
        # a key without any id has no bitmap
        assert as_dict(got) == as_dict(df.where("id is not null").groupBy(*keys).agg(F.count_distinct("id")))
    part = F.col("month").isin(1, 2, 5)
    assert as_dict(D.distinct_counts(maps.where(part), ["k"], "n")) == as_dict(
        df.where(part & F.col("id").isNotNull()).groupBy("k").agg(F.count_distinct("id")))


def test_later_months_extend_the_dictionary(spark):
    old, new = frame(spark, 400, 2).withColumn("month", F.lit(1)), frame(spark, 900, 3).withColumn("month", F.lit(2))
    first = D.dictionary(old, "id")
    more = D.dictionary(new, "id", known=first)
    numbers = first.unionByName(more)
    assert numbers.count() == numbers.select("n").distinct().count() == numbers.select("id").distinct().count()
    # the first month's bitmaps stay as they are
    maps = D.bitmaps(old, "id", ["month"], first).unionByName(D.bitmaps(new, "id", ["month"], numbers))
    want = old.unionByName(new).agg(F.count_distinct("id")).first()[0]
    assert D.distinct_counts(maps, [], "n").first()[0] == want
    assert D.dictionary(old, "id", known=numbers).count() == 0
    assert D.dictionary(old.limit(0), "id", known=old.limit(0).select("id", F.lit(1).alias("n"))).count() == 0


def test_ids_of_many_bitmaps(spark):
    df = spark.range(100_000).select((F.col("id") % 3).alias("k"), F.col("id").cast("string").alias("id"))
    numbers = D.dictionary(df, "id", ["k"])
    maps = D.bitmaps(df, "id", ["k"], numbers)
    assert maps.select("bucket").distinct().count() == 4      # 32,768 numbers each
    assert maps.groupBy("k").count().agg(F.max("count")).first()[0] <= 3    # a key's ids are neighbours
    assert as_dict(D.distinct_counts(maps, ["k"], "n")) == {(0,): 33334, (1,): 33333, (2,): 33333}
    assert D.distinct_counts(maps, [], "n").first()[0] == 100_000


def test_batches_of_suppliers(spark, small):
    numbers = D.dictionary(small["fact_goods_receipts"], "batch_id", ["supplier_id"])
    got = L.batch_volume_from_months(small, L.supplier_batch_bitmaps(small, numbers))
    assert sorted(got.collect()) == sorted(L.batch_volume_by_supplier(small).collect())
