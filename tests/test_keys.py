"""Checks of an append against stored keys: the verdict of the full check."""

import pytest
from pyspark.sql import functions as F

from shelflife.sources import files as A
from shelflife.sources import keys as X
from shelflife.tables import Tables


@pytest.fixture(scope="module")
def split(spark, small):
    """The fixture before 1996, and the sales with their bridge from then on."""
    s, b = small["fact_sales"], small["fact_sale_batch_map"]
    later = F.col("sale_date") >= "1996-01-01"
    new = s.where(later)
    delta = {"fact_sales": new, "fact_sale_batch_map": b.join(new.select("sale_id"), "sale_id", "left_semi")}
    old = small.replace(fact_sales=s.where(~later),
                        fact_sale_batch_map=b.join(new.select("sale_id"), "sale_id", "left_anti"))
    root = A.scratch_path(spark, "test-keys")
    X.add(old, root)
    return old, delta, root


def verdict(df):
    return sorted(map(tuple, df.collect()))


def whole(old, delta):
    return Tables({n: (lambda n=n: old[n].unionByName(delta[n]) if n in delta else old[n]) for n in old})


def test_a_clean_delta_passes_and_is_added(spark, split, small):
    old, delta, root = split
    assert verdict(X.check(delta, root)) == [] == verdict(A.violations(whole(old, delta)))


def test_planted_defects_get_the_full_verdict(spark, split):
    old, delta, root = split
    s, b = delta["fact_sales"], delta["fact_sale_batch_map"]
    n = F.pmod(F.hash("sale_id"), F.lit(50))
    again = old["fact_sales"].where(n == 1)                          # keys that are loaded already
    s = s.unionByName(again).unionByName(s.where(n == 2))             # and twice in the delta
    s = s.withColumn("warehouse_id", F.when(n == 3, F.lit(None).cast("string")).otherwise(F.col("warehouse_id")))
    s = s.withColumn("product_id", F.when(n == 4, F.lit("nowhere")).when(n == 5, F.lit("far too long an id"))
                     .otherwise(F.col("product_id")))
    b = b.withColumn("batch_id", F.when(n == 6, F.lit("B-none")).otherwise(F.col("batch_id")))
    b = b.withColumn("sale_id", F.when(n == 7, F.lit("S-none")).otherwise(F.col("sale_id")))
    b = b.unionByName(old["fact_sale_batch_map"].where(n == 8))
    bad = {"fact_sales": s, "fact_sale_batch_map": b}
    got = verdict(X.check(bad, root))
    assert got == verdict(A.violations(whole(old, bad)))
    assert {p.rsplit(" ", 1)[0] for p, _ in got} >= {"duplicate key fact_sales", "null fact_sales", "orphan fact_sales",
                                                    "orphan fact_sale_batch_map", "domain fact_sales"}


def test_only_touched_buckets_are_read(spark, split):
    old, delta, root = split
    few = delta["fact_sales"].orderBy("sale_id").limit(3)
    touched = {r[0] for r in few.select(X._bucket("sale_id")).collect()}
    known = X._known(spark, root, "fact_sales", ("sale_id",), few.select("sale_id"))
    plan = known._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert X.BUCKET in filters and len(touched) <= 3
    read = {r[0] for r in known.select(X._bucket("sale_id")).distinct().collect()}
    assert read <= touched


def test_delta_is_known_once_added(spark, small):
    root = A.scratch_path(spark, "test-keys-add")
    first = {"dim_products": small["dim_products"]}
    assert verdict(X.check(first, root)) == []      # nothing loaded before
    X.add(first, root)
    n = small["dim_products"].count()
    assert verdict(X.check(first, root)) == [("duplicate key dim_products product_id", n)]
