import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from edge import documents, empty
from pyspark.sql import functions as F

from shelflife.llm import common, merkle, queries

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + arity])) for i in range(0, len(out[-1]), arity)])
    return out


def walk(tree, i, arity):
    """(left, right) siblings of node i, level by level."""
    for level in tree[:-1]:
        a = i - i % arity
        yield level[a:i], level[i + 1:a + arity]
        i //= arity


def brute(rows, arity=16):
    """rows: (doc_id, source, lang, n_chars, text)"""
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = levels([leaf(r) for r in own], arity)
    top = levels([trees[s][-1][0] for s in names], arity)
    out = []
    for at, s in enumerate(names):
        for i, r in enumerate(by[s]):
            steps = [*walk(trees[s], i, arity), *walk(top, at, arity)]
            digest = leaf(r)
            if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 == 0 and r[4] is not None:
                digest = leaf((*r[:4], r[4].translate({c: c + 32 for c in range(65, 91)})))
            for left, right in steps:
                digest = h("".join(left) + digest + "".join(right))
            proof = h("".join("".join(left + right) for left, right in steps))
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], proof, digest, digest == top[-1][0]))
    return sorted(out, key=str)


def table(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    return df.withColumns({c: F.lit(5) for c in ("tree", "pos", "total", "key", "id", "digest", "root", "part")})


def got(docs):
    out = merkle.document_proofs(docs, common.key_crc() % 5 == 0, F.translate("text", queries.UPPER, queries.LOWER))
    return sorted((tuple(r) for r in out.select(*COLUMNS).collect()), key=str)


def test_odd_rows(spark):
    docs = documents(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert got(docs) == brute(rows)


def test_empty_and_one_row(spark):
    assert got(empty(spark)) == []
    rows = [(1, None, None, None, None)]
    assert got(table(spark, rows)) == brute(rows)
    assert merkle.build(empty(spark).select(F.lit("a").alias("key"), F.col("doc_id").alias("id"),
                                            F.lit(b"").alias("digest"), F.lit(None).cast("binary").alias("other"))
                        ).root is None


def test_many_sizes_of_sources(spark):
    """Sources of every size around the powers, a hot one, more sources than a run holds."""
    r = random.Random(16)
    rows, i = [], 0
    for s, n in enumerate([1, 2, 3, 15, 16, 17, 31, 33, 255, 256, 257, 400, 1000, 272, *[1] * 20]):
        for _ in range(n):
            rows.append((i * 7 % 10007, None if s == 13 else f"S{s}é", "en", i, f"Text {i} A" if r.random() < .9 else None))
            i += 1
    rows += rows[:40]      # repeated rows are leaves of their own
    r.shuffle(rows)
    assert got(table(spark, rows)) == brute(rows)


@pytest.mark.parametrize("arity, n", [(2, 1), (2, 2), (2, 37), (3, 27), (3, 28), (16, 17), (16, 4097)])
def test_frontier_witnesses(arity, n):
    nodes = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    tree = merkle.Frontier(arity)
    for i, d in enumerate(nodes):
        tree.append(d, i)
    root, records = tree.finish()
    want = levels([d.hex() for d in nodes], arity)
    assert root.hex() == want[-1][0]
    assert sorted(m for members, _, _ in records for m in members) == list(range(n))
    for members, digests, witness in records:
        for k, m in enumerate(members):
            assert digests[32 * k:32 * k + 32] == nodes[m]
            steps = list(walk(want, m, arity))[1:]
            assert [(a, o.hex()) for a, o in witness or []] == [(len(a), "".join(a + b)) for a, b in steps]


def test_a_source_of_many_blocks(spark):
    """More leaves than a block holds: block roots are appended to a tree of their own."""
    n = 16 ** 3 * 2 + 5
    rows = [(i, "hot", None, i, f"T{i}") for i in range(n)] + [(i, "b", "en", 1, "X") for i in range(5)]
    assert got(table(spark, rows).repartition(3)) == brute(rows)


def test_frontier_in_blocks_equals_the_whole():
    """Blocks closed apart, their roots appended: the same root as one stream."""
    nodes = [hashlib.sha256(str(i).encode()).digest() for i in range(3 * 4 ** 2 + 3)]
    whole = merkle.Frontier(4)
    for i, d in enumerate(nodes):
        whole.append(d, i)
    above = merkle.Frontier(4)
    for b in range(0, len(nodes), 16):
        block = merkle.Frontier(4)
        for i, d in enumerate(nodes[b:b + 16]):
            block.append(d, b + i)
        above.append(block.finish(2)[0], b)
    assert above.finish()[0] == whole.finish()[0]


def test_open_runs_are_all_that_a_frontier_holds():
    tree = merkle.Frontier(16)
    for i in range(16 ** 3):
        tree.append(hashlib.sha256(b"%d" % i).digest(), i)
        assert all(len(run) < 16 for run in tree.runs)


def test_witness_table(spark):
    rows = [(i, f"s{i % 3}", "en", i, f"T{i}") for i in range(100)]
    docs = table(spark, rows).select(F.col("source").alias("key"), F.col("doc_id").alias("id"),
                                     merkle.leaf(*[merkle.field(c) for c in merkle.FIELDS]).alias("digest"),
                                     F.lit(None).cast("binary").alias("other"))
    m = merkle.build(docs)
    seen = 0
    for r in m.witnesses().collect():
        up = bytes(r.digest)
        for w in r.witness:
            up = merkle.step_up(up, w["at"], bytes(w["others"]))
        assert up == m.root == bytes(r.root)
        seen += 1
    assert seen == 100


def test_query_against_brute_force(spark):
    path = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    out = queries.op11_merkle_manifest(spark, path).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in out), key=str) == brute(rows)
    assert 0 < sum(not r.verified for r in out) < len(rows) / 3
