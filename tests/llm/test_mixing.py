import re
from collections import defaultdict

import pytest
from edge import ROWS, documents, empty

from shelflife.llm import mixing as M


def water_fill(sizes):
    """Targets by the rule as worded: share, cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {s: 0.0 for s in names}
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        for s in list(open_):
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    return target


def check(spark, docs, bucket_rows):
    got = M.mix_report(docs, bucket_rows).collect()
    source = {(r.doc_id, len(r.text or "")): r.source for r in docs.collect()}
    words = {k: 0 for k in source}
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    by_doc = docs.select("doc_id", "text", "source").collect()
    assert len(got) == len(by_doc)
    for r in by_doc:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        sizes[r.source] += n
        largest[r.source] = max(largest[r.source], n)
    want = water_fill(dict(sizes))
    per_source = {(r.source_size, round(r.target, 6)) for r in got}
    assert per_source == {(sizes[s], round(want[s], 6)) for s in sizes}
    out = M.mix(docs, bucket_rows).collect()
    for r in out:
        taken[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6
    assert all(r.taken in (0, r.size, 2 * r.size) for r in got)
    assert sum(r.taken for r in got) == sum(taken.values())
    return words


@pytest.mark.parametrize("bucket_rows", [M.BUCKET_ROWS, 3])
def test_targets_and_taken_words(spark, bucket_rows):
    check(spark, documents(spark), bucket_rows)


def test_hot_source_in_buckets(spark):
    from pyspark.sql import functions as F
    docs = spark.range(2000).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit("w "), (F.col("id") % 37).cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("source"))
    check(spark, docs, 50)


def test_reruns_agree_and_columns_stay(spark):
    docs = documents(spark)
    a, b = (sorted(map(tuple, M.mix_report(d).collect()), key=repr)
            for d in (docs, docs.repartition(5)))
    assert a == b
    assert M.mix(docs).columns == docs.columns


def test_empty(spark):
    assert M.mix_report(empty(spark)).count() == 0
    assert M.mix(empty(spark)).count() == 0
    one = documents(spark, ROWS[3:4])
    assert [tuple(r) for r in M.mix_report(one).collect()] == [(3, 0, 0, 0.0, 0)]


def test_no_python_on_the_path(spark):
    plan = M.mix(documents(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|MapIn", plan)


def test_repeated_rows_at_the_edge_are_counted_off(spark):
    """Equal rows share a key; the mixture takes as many of them as its words allow."""
    from pyspark.sql import functions as F
    docs = spark.range(400).select(
        F.lit(5).cast("long").alias("doc_id"), F.lit("one two three").alias("text"),
        F.when(F.col("id") < 300, "a").otherwise("b").alias("source"))
    check(spark, docs, 50)


def test_inclusion_follows_the_chances(spark):
    """Sources of the same documents are samples of their own: in each class the share that is
    taken once more is p, and p differs between the sizes of a source."""
    from pyspark.sql import functions as F
    docs = spark.range(24_000).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit("w "), F.element_at(F.array(*map(F.lit, (1, 3, 6, 12, 25, 50))),
                                           (F.col("id") % 6 + 1).cast("int"))).alias("text"),
        F.format_string("s%03d", (F.col("id") / 600).cast("long")).alias("source"))
    rows = M.sample(docs, 100).groupBy("weight", F.round("p", 6).alias("p"), "whole").agg(
        F.avg(F.col("extra").cast("int")).alias("share"), F.count("*").alias("n")).collect()
    big = [r for r in rows if r.n >= 1000 and 0 < r.p < 1]
    assert len({r.p for r in big}) >= 6
    for r in big:
        assert abs(r.share - r.p) < 5 * (r.p * (1 - r.p) / r.n) ** 0.5 + 0.02, r
    per_source = M.sample(docs, 100).filter("p > 0").groupBy("source").agg(
        F.countDistinct("p").alias("n")).collect()
    # the sources of weight 5, every third one, are taken twice as a whole
    assert len(per_source) == 26 and all(r.n > 1 for r in per_source)


def test_copies_grow_with_weight_and_stop(spark):
    from pyspark.sql import functions as F
    docs = documents(spark)
    for r in M.sample(docs).collect():
        assert 0 <= r.whole + r.p <= M.MOST
    flat = M.sample(docs, weight=lambda size: F.lit(1)).filter("size > 0").collect()
    by_source = defaultdict(set)
    for r in flat:
        by_source[r.source].add((r.whole, r.p))
        assert r.whole + r.p == pytest.approx(r.target / r.source_size)
    assert all(len(v) == 1 for v in by_source.values())


def test_another_seed_is_another_sample_of_the_same_targets(spark):
    from pyspark.sql import functions as F
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 40).cast("int")).alias("text"),
        F.concat(F.lit("s"), (F.col("id") % 4).cast("string")).alias("source"))
    a, b = ({r.doc_id: r for r in M.mix_report(docs, seed=x).collect()} for x in ("", "7"))
    assert {i: r.target for i, r in a.items()} == {i: r.target for i, r in b.items()}
    assert sum(a[i].taken != b[i].taken for i in a) > 300
