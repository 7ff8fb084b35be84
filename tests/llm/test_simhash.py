import re

import numpy as np
import pytest
import xxhash
from edge import ROWS, documents, empty

from shelflife.llm import simhash as S


def brute_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(points, radius=2):
    parent = {int(p): int(p) for p in points}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, p in enumerate(points):
        for q in points[i + 1:][np.bitwise_count(points[i + 1:] ^ p) <= radius]:
            a, b = find(int(p)), find(int(q))
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in parent}


def planted(n, copies, seed=0):
    """Random fingerprints, and neighbours at one to three bits."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    out = [base]
    for _ in range(copies):
        own = base[:n // 3].copy()
        for _ in range(int(rng.integers(1, 4))):
            own ^= np.uint64(1) << rng.integers(0, 64, len(own), dtype=np.uint64)
        out.append(own)
    return np.unique(np.concatenate(out))


def joined(links):
    parent = {}

    def find(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in links:
        a, b = find(int(a)), find(int(b))
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in list(parent)}


def test_fingerprints(spark):
    got = S.simhash_components(documents(spark)).collect()
    assert len(got) == len(ROWS)
    want = {f"{brute_fingerprint(r[1]):016x}" for r in ROWS}
    assert {r.fingerprint for r in got} == want
    assert {r.fingerprint for r in got if r.doc_id in (3, 4, 5)} == {"0" * 16}
    assert {r.component_id for r in got if r.doc_id in (1, 2)} == {1}
    assert {r.component_id for r in got if r.doc_id in (3, 4, 5)} == {3}
    lone = brute_fingerprint("no id at all")
    assert [r.component_id for r in got if r.fingerprint == f"{lone:016x}"] == [None]


def test_fingerprint_seed_and_hash_are_sparks(spark):
    from pyspark.sql import functions as F
    row = spark.createDataFrame([("one two three",)], "t string").select(F.xxhash64("t")).first()
    assert S.fingerprint(b"One two  three") == row[0] % 2 ** 64


@pytest.mark.parametrize("n,leaf", [(300, 16), (3000, 64), (2500, 1024)])
def test_tree_finds_every_link(monkeypatch, n, leaf):
    monkeypatch.setattr(S, "LEAF", leaf)
    points = planted(n, 4)
    want = brute_components(points)
    got = joined(S.near_links(points, 2))
    for p, root in want.items():
        assert got.get(p, p) == root


def ball(n, bits, seed=0):
    """Distinct fingerprints that differ from one centre in up to ``bits`` bits."""
    rng = np.random.default_rng(seed)
    out = np.full(n, rng.integers(0, 1 << 63, dtype=np.uint64))
    for _ in range(bits):
        flip = rng.random(n) < 0.9
        out[flip] ^= np.uint64(1) << rng.integers(0, 64, int(flip.sum()), dtype=np.uint64)
    return np.unique(out)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
@pytest.mark.parametrize("bits,held", [(3, 1 << 22), (6, 5000), (12, 1 << 22)])
def test_removals_find_every_link_of_a_ball(monkeypatch, radius, bits, held):
    monkeypatch.setattr(S, "HELD", held)
    points = ball(1500, bits)
    want = brute_components(points, radius)
    label = S._by_removals(points, radius)
    assert {int(p): int(points[i]) for p, i in zip(points, label)} == want
    assert (S._pairwise(points, radius) == label).all()


def test_a_dense_ball_takes_no_square_of_its_size(monkeypatch):
    monkeypatch.setattr(S, "_pairwise", None)
    points = ball(60_000, 5)
    got = joined(S.near_links(points, 2))
    some = points[::500]
    label = {int(p): got.get(int(p), int(p)) for p in points}
    for p in some:
        for q in points[np.bitwise_count(points ^ p) <= 2]:
            assert label[int(p)] == label[int(q)]


def test_links_over_shards_equal_brute_force(spark):
    points = planted(4000, 3, seed=3)
    df = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    found = S.links(df, 2, shard_rows=300)
    got = joined([(r.a % 2 ** 64, r.b % 2 ** 64) for r in found.collect()])
    for p, root in brute_components(points).items():
        assert got.get(p, p) == root


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150), (7, 7)]
    got = dict((r.node, r.root) for r in
               S.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(1, 61)} | {200: 100, 150: 100}


def test_drop_near_keeps_one_row_of_each(spark):
    docs = documents(spark)
    kept = S.drop_near(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.select("doc_id").collect() if r.doc_id is not None)
    assert ids == [-3, 1, 3, 6, 7, 8, 9, 10]
    assert kept.filter("doc_id is null").count() == 1


def test_empty(spark):
    assert S.simhash_components(empty(spark)).count() == 0
    assert S.drop_near(empty(spark)).count() == 0
