import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from edge import LONG, documents, empty
from pyspark.sql import functions as F

from shelflife.llm import queries, runs

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, min_words=24, min_periods=3):
    """Every period: maximal stretches in which words that far apart agree."""
    out = {}
    for q in range(1, len(words) // min_periods + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(min_words, min_periods * q):
                out.setdefault((s, i + q - s), q)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def echo(doc_id, words):
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = echo(doc_id, SPLIT.findall(text or ""))
    found = brute(words)
    drop = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
            sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def random_words(r, n):
    """Words of few kinds with runs planted at random places, some inside of others."""
    words = [r.randrange(r.choice([1, 2, 3, 50])) for _ in range(n)]
    for _ in range(r.randrange(4)):
        p, a = r.randrange(1, 12), r.randrange(n)
        for i in range(a + p, min(n, a + r.randrange(60))):
            words[i] = words[i - p]
    return words


def test_find_runs_against_brute_force():
    r = random.Random(4)
    docs = [random_words(r, r.randrange(1, 150)) for _ in range(400)] + [[], [0], [0] * 200, [0, 1] * 40]
    got = runs.find_runs([np.array(d, np.int64) for d in docs])
    assert [g for g in got] == [brute(d) for d in docs]
    assert sum(map(bool, got)) > 100


@pytest.mark.parametrize("min_words, min_periods", [(1, 2), (2, 2), (5, 3), (24, 3), (30, 5)])
def test_other_bounds(min_words, min_periods):
    r = random.Random(min_words)
    docs = [random_words(r, r.randrange(1, 60)) for _ in range(300)]
    got = runs.find_runs([np.array(d, np.int64) for d in docs], min_words, min_periods)
    assert got == [brute(d, min_words, min_periods) for d in docs]


def test_fibonacci_word_and_powers():
    """Texts full of squares: Fibonacci and Thue-Morse words, a power of a power."""
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    thue = [bin(i).count("1") % 2 for i in range(512)]
    nested = ([0, 1, 0, 1, 0, 1, 2] * 5 + [3]) * 4
    docs = [b, thue, nested, [1] * 1000, list(range(500)) * 3]
    got = runs.find_runs([np.array(d, np.int64) for d in docs], 4, 2)
    assert got == [brute(d, 4, 2) for d in docs]


def test_lcp_and_suffix_array():
    r = random.Random(9)
    docs = [np.array([r.randrange(2) for _ in range(40)], np.int64) for _ in range(5)]
    text, _ = runs._joined(docs, range(5))
    sa, lcp, _ = runs._sorted(text, len(text))
    t = text.tolist()
    assert sa.tolist() == sorted(range(len(t)), key=lambda i: t[i:])
    for k in range(1, len(t)):
        a, b = t[sa[k - 1]:], t[sa[k]:]
        assert lcp[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def through_query(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return got(queries.op12_periodic_runs(spark, str(tmp_path)))


def test_odd_rows(spark, tmp_path):
    docs = documents(spark).withColumns({c: F.lit(3) for c in ("words", "n", "g", "h", "a", "p", "runs", "best")})
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert (6, LONG) in rows
    assert through_query(spark, docs, tmp_path) == sorted((expected(*r) for r in rows), key=str)


def test_empty_table(spark, tmp_path):
    assert through_query(spark, empty(spark), tmp_path) == []


def test_operator_outputs(spark):
    text = "start " + "a b c " * 10 + "end"
    docs = spark.createDataFrame([(1, text), (2, "plain  text\nhere"), (3, None)], "doc_id long, text string")
    out = {r.doc_id: r for r in runs.periodic_runs(docs).collect()}
    assert [tuple(x) for x in out[1].runs] == [(1, 30, 3)] and out[1].collapsed == "start a b c end"
    assert (out[2].runs, out[2].collapsed, out[2].n_words) == ([], "plain text here", 3)
    assert (out[3].runs, out[3].collapsed, out[3].n_words) == ([], "", 0)


def test_small_batches_give_the_same(spark, monkeypatch):
    r = random.Random(8)
    rows = [(i, " ".join(f"w{w}" for w in random_words(r, r.randrange(1, 120)))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted((r.doc_id, str(r.runs)) for r in runs.periodic_runs(docs).collect())
    monkeypatch.setattr(runs, "BATCH_WORDS", 50)
    assert sorted((r.doc_id, str(r.runs)) for r in runs.periodic_runs(docs).collect()) == want


def test_query_against_brute_force(spark):
    path = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    assert got(queries.op12_periodic_runs(spark, path)) == sorted((expected(*r) for r in rows), key=str)
