"""SimHash near-duplicates: exact pairs through vantage-point trees.

Fingerprints are computed per document; equal ones are folded first, so a group of
copies is one fingerprint.  A vantage-point tree over a bounded sample cuts the
space of fingerprints into shards by Hamming distance to vantage points.  The
triangle inequality bounds what can be near: two fingerprints within ``r`` bits on
different sides of a threshold ``m`` have distances of at least ``m - r + 1`` (the
inner one) and at most ``m + r`` to the vantage point, so the inner ones of that
band also go to the outer side, and every near pair meets in some shard.  Inside a
shard the same tree goes on down to small leaves.  What lies in a few bits of one centre cannot be cut: there, points
are sets of the bits in which they differ from the centre, and those within ``r`` bits
become equal once at most ``r`` bits in all are removed from the two, which a sort of all
removals finds.  Leaves return links that span their components; links are joined by
large and small stars.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflife.llm.common import partitions, slices, stored, text_bytes

SHARD_ROWS = 16384      # fingerprints of a shard, about, while shards are fewer than partitions
WIDE_ROWS = 131072      # fingerprints of a shard beyond that: fewer shards copy fewer rows
MAX_SHARDS = 4096       # beyond this, shards grow and their own trees get deeper
SAMPLE_PER_SHARD = 64   # sampled fingerprints for each shard of the first tree
LEAF = 1024             # a leaf of so many is compared pair by pair
REMOVALS = 64           # a leaf with no more removals a point, on average, needs no cut
HELD = 1 << 22          # removals sorted at a time


def fingerprint(text: bytes, n_words: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    buf = b" ".join(words)
    k = len(words) - n_words + 1
    if k <= 1:
        return xxhash.xxh64_intdigest(buf, seed)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[:k].tolist(), ends[n_words - 1:].tolist()
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(buf[a:b], seed) for a, b in zip(starts, ends)], np.uint64)
    ones = np.zeros(64, np.int64)
    for a in range(0, k, 1 << 16):
        part = hashes[a:a + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > k, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, columns: list, n_words: int = 3) -> DataFrame:
    """``columns`` of the documents and ``fp``, the fingerprint as a signed long."""
    rows = docs.select(text_bytes().alias("raw"), F.struct(*columns).alias("rec"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "raw"):
            fps = np.array([fingerprint(t, n_words) for t in part.column(0).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([part.column(1), pa.array(fps.view(np.int64))],
                                             names=["rec", "fp"])

    schema = rows.select("rec", F.lit(0).cast("long").alias("fp")).schema
    return rows.mapInArrow(run, schema)


# ---- vantage-point trees ----------------------------------------------------------

def _split(points: np.ndarray, radius: int, rng: np.random.Generator):
    """Vantage point and threshold with the cheapest two sides, or None if no cut helps.

    The choice is made on up to 4096 points; it decides cost alone.
    """
    seen = points if len(points) <= 4096 else points[rng.integers(0, len(points), 4096)]
    best = None
    for v in seen[rng.integers(0, len(seen), 4)]:
        upto = np.cumsum(np.bincount(np.bitwise_count(seen ^ v), minlength=65))[:64]
        outer = len(seen) - np.concatenate([np.zeros(radius, int), upto[:64 - radius]])
        cost = upto ** 2.0 + outer ** 2.0
        m = int(np.argmin(cost))
        if best is None or cost[m] < best[0]:
            best = (cost[m], v, m)
    return best[1:] if best[0] < 0.97 * len(seen) ** 2.0 else None


def _sides(points: np.ndarray, v: np.uint64, m: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks of the inner side (distance to ``v`` up to ``m``) and the outer with its band."""
    d = np.bitwise_count(points ^ v)
    return d <= m, d > m - radius


def shard_tree(sample: np.ndarray, leaf: int, radius: int) -> list:
    """Nested [v, m, inner, outer]; a leaf is its shard number."""
    rng, n = np.random.default_rng(0), [0]

    def grow(points):
        cut = _split(points, radius, rng) if len(points) > leaf else None
        if cut is None:
            n[0] += 1
            return n[0] - 1
        inner, outer = _sides(points, *cut, radius)
        return [*cut, grow(points[inner]), grow(points[outer])]

    return grow(sample)


def route(tree, points: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, points) for every shard that holds some of the points."""
    if not len(points):
        return
    if not isinstance(tree, list):
        yield tree, points
        return
    v, m, inner_tree, outer_tree = tree
    inner, outer = _sides(points, v, m, radius)
    yield from route(inner_tree, points[inner], radius)
    yield from route(outer_tree, points[outer], radius)


def _labels(label: np.ndarray, near: np.ndarray) -> np.ndarray:
    """The lowest number of each group that ``label`` and the links ``near`` (n, 2) connect."""
    old = np.flatnonzero(label != np.arange(len(label)))
    near = np.concatenate([near, np.stack([old, label[old]], axis=1)])
    while len(near):  # the lowest number spreads through each group
        low = np.minimum(label[near[:, 0]], label[near[:, 1]])
        new = label.copy()
        np.minimum.at(new, near[:, 0], low)
        np.minimum.at(new, near[:, 1], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _pairwise(own: np.ndarray, radius: int) -> np.ndarray:
    """Labels of the groups of near points, comparing all with all, in blocks."""
    rows = max(1, (1 << 20) // max(1, len(own)))
    label = np.arange(len(own))
    near = [np.zeros((0, 2), int)]
    for a in range(0, len(own), rows):
        close = np.bitwise_count(own[a:a + rows, None] ^ own[None, :]) <= radius
        i, j = np.divmod(np.flatnonzero(close), len(own))
        keep = i + a < j
        near.append(np.stack([i[keep] + a, j[keep]], axis=1))
        if sum(map(len, near)) > HELD:
            label, near = _labels(label, np.concatenate(near)), [np.zeros((0, 2), int)]
    return _labels(label, np.concatenate(near))


def _centre(own: np.ndarray) -> np.uint64:
    """The point whose every bit is that of the majority (of up to 4096 points)."""
    seen = np.ascontiguousarray(own[::max(1, len(own) // 4096)])
    ones = np.unpackbits(seen.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0)
    return np.packbits(2 * ones > len(seen), bitorder="little").view(np.uint64)[0]


def _removals(diff: np.ndarray, radius: int) -> np.ndarray:
    """How many ways there are to take up to ``radius`` bits from each point."""
    d = np.bitwise_count(diff).astype(np.int64)
    ways, total = np.ones(len(d), np.int64), np.ones(len(d), np.int64)
    for k in range(radius):
        ways = ways * np.maximum(d - k, 0) // (k + 1)
        total += ways
    return total


def _removed(diff: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(bits removed, what is left, number of the point) for each way to remove up to ``radius``."""
    todo = [(0, diff, diff, np.arange(len(diff), dtype=np.int32))]
    while todo:
        k, key, rest, at = todo.pop()
        yield k, key, at
        while k < radius:  # bits are removed in ascending order, so each way comes once
            some = rest != 0
            key, rest, at = key[some], rest[some], at[some]
            if not len(at):
                break
            lowest = rest & (~rest + np.uint64(1))
            rest = rest ^ lowest
            todo.append((k + 1, key ^ lowest, rest, at))


def _by_removals(own: np.ndarray, radius: int) -> np.ndarray:
    """Labels of the groups of near points, by what is left of them when bits are removed.

    Two points within ``radius`` bits leave the same when each loses what only it has;
    points that leave the same are as near as the number of bits they lost together, so
    a star around the one that lost least connects all such pairs.
    """
    diff = own ^ _centre(own)
    passes = 1 + int(_removals(diff, radius).sum()) // HELD
    label = np.arange(len(own))
    for p in range(passes):
        held: list[list] = [[] for _ in range(radius + 1)]
        for a in range(0, len(own), 1 << 16):
            for k, key, at in _removed(diff[a:a + (1 << 16)], radius):
                if passes > 1:
                    mine = ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(passes) == p
                    key, at = key[mine], at[mine]
                held[k].append((key, at + a))
        lost = np.repeat(np.arange(radius + 1), [sum(len(k) for k, _ in h) for h in held])
        key = np.concatenate([k for h in held for k, _ in h])
        at = np.concatenate([i for h in held for _, i in h])
        order = np.argsort(key, kind="stable")  # of equal ones, who lost least comes first
        key, at, lost = key[order], at[order], lost[order]
        begins = np.append(True, key[1:] != key[:-1])
        head = np.flatnonzero(begins)[np.cumsum(begins) - 1] if len(key) else np.zeros(0, int)
        near = ~begins[:len(key)] & (lost + lost[head] <= radius)
        label = _labels(label, np.stack([at[near], at[head[near]]], axis=1).astype(np.int64))
    return label


def near_links(points: np.ndarray, radius: int) -> np.ndarray:
    """Links (n, 2) that connect every pair within ``radius`` bits, spanning each leaf's groups."""
    rng, links, todo = np.random.default_rng(0), [], [points]
    while todo:
        own = todo.pop()
        dense = False
        if len(own) > LEAF:
            ways = _removals(own[::max(1, len(own) // 4096)] ^ _centre(own), radius).mean()
            dense = ways <= REMOVALS
            cut = None if dense else _split(own, radius, rng)
            if cut is not None:
                inner, outer = _sides(own, *cut, radius)
                todo += [own[inner], own[outer]]
                continue
            dense = dense or 16 * ways < len(own)
        label = _by_removals(own, radius) if dense else _pairwise(own, radius)
        linked = np.flatnonzero(label != np.arange(len(own)))
        links.append(np.stack([own[linked], own[label[linked]]], axis=1))
    return np.concatenate(links) if links else np.zeros((0, 2), np.uint64)


def links(fps: DataFrame, radius: int = 2, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp`` that span their near groups.

    The sample that places the cuts is bounded by MAX_SHARDS * SAMPLE_PER_SHARD times
    a small factor; it decides balance alone, every fingerprint is routed.  Fingerprints
    in the band of a cut are routed to both sides, so the copies of one grow with the
    number of shards.
    """
    spark = fps.sparkSession
    n = fps.count()
    shards = min(MAX_SHARDS, max(1, min(n // shard_rows, partitions(spark)), n // WIDE_ROWS))
    share = min(1.0, shards * SAMPLE_PER_SHARD / max(1, n))
    sample = fps.filter((F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1))
    points = np.array([r.fp for r in sample.select("fp").collect()], np.int64).view(np.uint64)
    points.sort()
    tree = shard_tree(points, SAMPLE_PER_SHARD * 2, radius) if shards > 1 else 0

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.asarray(batch.column(0)).view(np.uint64)
            for shard, part in route(tree, own, radius):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), shard, np.int32)), pa.array(part.view(np.int64))],
                    names=["shard", "fp"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held = None, []

        def found():
            got = near_links(np.concatenate(held), radius).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(got[:, 0]), pa.array(got[:, 1])],
                                              names=["a", "b"])

        for batch in batches:
            shard, own = np.asarray(batch.column(0)), np.asarray(batch.column(1)).view(np.uint64)
            cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1), len(shard)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if held and shard[a] != here:
                    yield found()
                    held = []
                here = shard[a]
                held.append(own[a:b].copy())
        if held:
            yield found()

    dealt = (fps.select("fp").mapInArrow(deal, "shard int, fp long")
             .repartition(partitions(spark), "shard").sortWithinPartitions("shard"))
    return dealt.mapInArrow(search, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component with a link, by alternating stars.

    Large stars link larger neighbours to the smallest one, small stars link a node
    and its smaller neighbours to the smallest; both keep the components and end in
    stars.  Every round is written to the shared folder.
    """
    def oriented(e):
        return e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter(
            "u > v").distinct()

    def mark(e):
        return e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(
            F.xxhash64("v", "u").cast("decimal(38,0)"))).first()

    edges = stored(oriented(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))), "links")
    before = mark(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = oriented(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v")))
        edges = stored(oriented(small), "stars")
        now = mark(edges)
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def _groups(marked: DataFrame, radius: int, ids: list) -> DataFrame:
    """(of, low): each fingerprint and the struct ``low``, smallest of ``ids`` in its component."""
    groups = stored(marked.groupBy("fp").agg(F.min(F.struct(*ids)).alias("low")), "fingerprints")
    roots = components(links(groups.select("fp"), radius))
    placed = groups.join(roots, groups["fp"] == roots["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = placed.groupBy("root").agg(F.min("low").alias("least"))
    return placed.join(lowest, "root").select(F.col("fp").alias("of"), "least")


def simhash_components(docs: DataFrame, n_words: int = 3, radius: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Null text counts as empty; texts without words share the fingerprint zero, linked
    like any other.  ``component_id`` is null only where no document of the component
    has an id.  Repeated rows give repeated rows; an empty table gives none.
    """
    marked = fingerprints(docs, [F.col("doc_id").cast("long").alias("doc_id")], n_words)
    marked = stored(marked.select("rec.doc_id", "fp"), "simhash")
    groups = _groups(marked, radius, [F.col("doc_id").isNull().alias("no_id"), F.col("doc_id")])
    return marked.join(groups, marked["fp"] == groups["of"]).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("least.doc_id").alias("component_id"))


def drop_near(docs: DataFrame, n_words: int = 3, radius: int = 2) -> DataFrame:
    """The document with the smallest id of each component (one row of it), all columns."""
    marked = fingerprints(docs, ["*"], n_words).withColumn("row", F.monotonically_increasing_id())
    marked = stored(marked, "simhash-rows")
    ids = marked.select("fp", "row", F.col("rec.doc_id").alias("doc_id"))
    groups = _groups(ids, radius, [F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"),
                                   F.col("row")])
    stay = groups.select(F.col("least.row").alias("stay")).distinct()
    return marked.join(stay, marked["row"] == stay["stay"], "left_semi").select("rec.*")
