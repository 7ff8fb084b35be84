import hashlib
import re
from collections import defaultdict

import pytest
from edge import ROWS, documents, empty

from shelflife.llm import dedup


def strip(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


@pytest.mark.parametrize("table_bytes", [dedup.TABLE_BYTES, 200])
def test_groups_match_brute_force(spark, table_bytes):
    got = dedup.exact_groups(documents(spark), table_bytes).collect()
    groups = defaultdict(list)
    for r in ROWS:
        groups[strip(r[1])].append((-len(r[1] or ""), r[0] is None, r[0] or 0, r[0]))
    assert len(got) == len(ROWS)
    assert sum(r.kept for r in got) == len(groups)
    for r in got:
        own = next(g for t, g in groups.items()
                   if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        assert (r.keep_id, r.group_size) == (min(own)[3], len(own))
        assert not r.kept or r.doc_id == r.keep_id


def test_drop_exact_keeps_whole_rows(spark):
    docs = documents(spark)
    kept = dedup.drop_exact(docs, 200)
    assert kept.columns == docs.columns
    got = {strip(r.text): r for r in kept.collect()}
    assert len(got) == kept.count() == len({strip(r[1]) for r in ROWS})
    best = got[strip(ROWS[0][1])]  # the longer spelling stays
    assert (best.doc_id, best.text, best.hash) == (2, ROWS[1][1], 7)


def test_empty_table(spark):
    assert dedup.exact_groups(empty(spark)).count() == 0
    assert dedup.drop_exact(empty(spark)).count() == 0


def test_buckets_split_until_they_fit(spark):
    """Many contents and one hot one: every bucket's distinct contents fit the table."""
    from pyspark.sql import functions as F
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot " * 50)).otherwise(
            F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    got = dedup.exact_groups(docs, 2000)
    assert got.count() == 3000
    assert got.filter("kept").count() == 2001
    assert got.filter("group_size = 1000").select("keep_id").distinct().collect()[0][0] == 0


def test_table_compares_contents_not_hashes():
    t = dedup.OpenTable()
    assert [t.find(5, b"a"), t.find(5, b"b"), t.find(5, b"a"), t.find(6, b"a")] == [0, 1, 0, 2]
    for i in range(5000):
        assert t.find(i * 1024, str(i).encode()) == 3 + i
    assert t.find(0, b"0") == 3
