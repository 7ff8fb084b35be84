"""Periodic runs of words by an enhanced suffix array.

A run is a stretch of words with a smallest period q, repeated three times or more, that
no neighbouring word extends.  A batch of documents is searched at once, whole:

1. Words become numbers.  Suffixes are sorted by prefix doubling; the first key holds the
   document, so that suffixes of different documents part at once, and only groups that
   are still equal are sorted again.  The ranks of every doubling stay: two suffixes have
   equal ranks of level j where their first 2**j words are equal.
2. LCP values of neighbours follow from those ranks.  A run's first two periods share
   ``share`` words at least, so a document whose largest value is smaller has no run.
3. Each LCP value d > 0 splits its interval of the suffix array into two sides, whose
   bounds come from the previous and next smaller value: no tree is built.  For each
   suffix i of the smaller side, the other side is asked through the inverse array for
   i + d and i - d.  A hit is a branching tandem repeat: a square of period d that cannot
   be moved to the right.  Every suffix is on a smaller side O(log n) times.
4. Squares are rotated to the left as far as words repeat, which gives stretches that
   neither side extends; equal stretches are merged to the one of smallest period.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflife.llm.common import WORD, slices, text_bytes

MIN_WORDS, MIN_PERIODS = 24, 3
BATCH_WORDS = 1 << 17    # words of the documents that are sorted together
PAIRS = 1 << 20          # pairs that are asked for at once


def numbered(words: list[bytes]) -> np.ndarray:
    numbers: dict = defaultdict(itertools.count().__next__)
    return np.fromiter((numbers[w] for w in words), np.int64, len(words))


def levels(keys: np.ndarray, last: int) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... keys, until ``last`` or no two are equal.

    ``keys`` ends in a key that occurs once, and so does every document, so equal suffixes
    never reach beyond their document's end.
    """
    n = len(keys)
    order = np.argsort(keys)
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(keys[order][1:], keys[order][:-1], out=new[1:])
    rank = np.empty(n, np.int64)
    start = np.flatnonzero(new)
    rank[order] = np.repeat(start, np.diff(np.append(start, n)))
    out, h = [rank], 1
    while True:
        # groups of two or more, in the order of the suffix array
        size = np.diff(np.append(start, n))
        many = np.repeat(size > 1, size)
        if h >= last or not many.any():
            break
        place, at = np.flatnonzero(many), order[many]
        first, then = rank[at], rank[at + h]
        by = np.argsort(first * n + then)
        at, first, then = at[by], first[by], then[by]
        order[place] = at
        head = np.empty(len(at), bool)
        head[0] = True
        head[1:] = (first[1:] != first[:-1]) | (then[1:] != then[:-1])
        new[place] |= head
        start = np.flatnonzero(new)
        rank = rank.copy()
        rank[at] = place[np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))]
        out.append(rank)
        h *= 2
    return out


def common_prefix(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that suffixes a and b share (a != b, pairwise)."""
    a, b = a.copy(), b.copy()
    out = np.zeros(len(a), np.int64)
    for j in range(len(ranks) - 1, -1, -1):
        same = ranks[j][a] == ranks[j][b]
        step = np.where(same, 1 << j, 0)
        out += step
        a += step
        b += step
    return out


def common_suffix(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that the texts before a and before b share (pairwise, a < b)."""
    a, b = a.copy(), b.copy()
    out = np.zeros(len(a), np.int64)
    for j in range(len(ranks) - 1, -1, -1):
        h = 1 << j
        same = a >= h
        same[same] = ranks[j][a[same] - h] == ranks[j][b[same] - h]
        step = np.where(same, h, 0)
        out += step
        a -= step
        b -= step
    return out


def sides(lcp: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For each place k of the LCP array the bounds [l, r) of its two sides [l, k), [k, r):
    up to the previous value that is smaller, and before the next that is smaller or equal.
    Equal values of an interval split it one after the other, so that suffixes of two of
    its children are on two sides exactly once."""
    n = len(lcp)
    left, right, open_ = [0] * n, [n] * n, []
    for k, v in enumerate(lcp):
        while open_ and lcp[open_[-1]] >= v:
            right[open_.pop()] = k
        left[k] = open_[-1] if open_ else 0
        open_.append(k)
    return np.array(left, np.int64), np.array(right, np.int64)


def squares(sa: np.ndarray, isa: np.ndarray, lcp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Branching tandem repeats (start, period): suffixes start and start + period share
    exactly ``period`` words."""
    n = len(sa)
    left, right = sides(lcp.tolist())
    at = np.flatnonzero(lcp > 0)
    k, left, right, d = at, left[at], right[at], lcp[at]
    small = np.minimum(k - left, right - k)
    is_left = (k - left) <= (right - k)
    lo, other_lo = np.where(is_left, left, k), np.where(is_left, k, left)
    other_hi = np.where(is_left, right, k)
    done = np.cumsum(small)
    a = 0
    while a < len(k):
        b = max(a + 1, int(np.searchsorted(done, (done[a - 1] if a else 0) + PAIRS, "right")))
        size = small[a:b]
        of = np.repeat(np.arange(a, b), size)
        within = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
        i = sa[lo[of] + within]
        for sign in (1, -1):
            j = i + sign * d[of]
            inside = (j >= 0) & (j < n)
            p, o = isa[j[inside]], of[inside]
            hit = (p >= other_lo[o]) & (p < other_hi[o])
            if hit.any():
                yield np.minimum(i, j)[inside][hit], d[o[hit]]
        a = b


def find_runs(documents: list[np.ndarray], min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS
              ) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of every document, by start and period.

    A document is an array of word numbers.  Runs have at least ``min_words`` words and
    ``min_periods`` (at least 2) periods.
    """
    found: list[list] = [[] for _ in documents]
    # a run of n >= max(min_words, min_periods * q) words shares n - q words with itself
    share = max(1, min_words - min_words // min_periods)
    live = [i for i, d in enumerate(documents) if len(d) >= max(2, min_words)]
    if not live:
        return found
    # documents in which no stretch of that length comes twice have no run
    text, starts = _joined(documents, live)
    sa, lcp, _ = _sorted(text, share)
    longest = np.zeros(len(text), np.int64)
    longest[sa] = lcp
    live = [i for i, t in zip(live, np.maximum.reduceat(longest, starts).tolist()) if t >= share]
    if not live:
        return found
    text, starts = _joined(documents, live)
    sa, lcp, ranks = _sorted(text, len(text))
    for i, d in squares(sa, ranks[-1], lcp):
        # the square ends the stretch: words part after i + 2d; rotate it to the left
        start = i - common_suffix(ranks, i, i + d)
        length = i + 2 * d - start
        long = length >= np.maximum(min_words, min_periods * d)
        doc = np.searchsorted(starts, start[long], "right") - 1
        for x, s, n, q in zip(doc.tolist(), start[long].tolist(), length[long].tolist(), d[long].tolist()):
            found[live[x]].append((s - int(starts[x]), n, q))
    for i in live:
        least: dict = {}
        for s, n, q in found[i]:
            if q < least.get((s, n), q + 1):
                least[s, n] = q
        found[i] = sorted(((s, n, q) for (s, n), q in least.items()), key=lambda r: (r[0], r[2]))
    return found


def _sorted(text: np.ndarray, last: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Suffix array, LCP of each suffix and the one before it (exact up to ``last``), ranks."""
    ranks = levels(text, last)
    sa = np.argsort(ranks[-1])
    lcp = np.zeros(len(text), np.int64)
    lcp[1:] = common_prefix(ranks, sa[:-1], sa[1:])
    return sa, lcp, ranks


def _joined(documents, live) -> tuple[np.ndarray, np.ndarray]:
    """The documents end to end, each with a key of its own behind it; their starts."""
    width = 1 + max(int(documents[i].max()) for i in live)
    parts = []
    for x, i in enumerate(live):
        parts += [documents[i] + (x * (width + 1) + 1), [x * (width + 1)]]
    starts = np.cumsum([0] + [len(documents[i]) + 1 for i in live])[:-1]
    return np.concatenate(parts), starts


# ---- tables ----------------------------------------------------------------------

RUN = "struct<start:long,length:long,period:long>"


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS,
                  text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs and the collapsed text of every document.

    ``runs`` lists start (word number), length and period of all runs, by start and period;
    ``collapsed`` is the text without the words that a run holds after its first period,
    words joined by one space.

    A null text counts as empty: no words, no runs, an empty ``collapsed``.  Repeated rows
    and rows without ``doc_id`` are rows like others; an empty table gives no rows.  A text
    of any length is searched whole, by itself if it is longer than a batch (memory: some
    eight bytes a word and doubling).  Other columns are not read.
    """
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, runs array<{RUN}>, collapsed string"
    schema = T._parse_datatype_string(schema)
    run_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(ids, texts, id_type):
            numbers: dict = defaultdict(itertools.count().__next__)
            arrays = [np.fromiter((numbers[w] for w in t), np.int64, len(t)) for t in texts]
            found = find_runs(arrays, min_words, min_periods)
            rows = [[{"start": s, "length": n, "period": q} for s, n, q in runs] for runs in found]
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array([len(t) for t in texts], pa.int64()), pa.array(rows, run_type),
                 pa.array([b" ".join(collapsed(t, r)).decode() for t, r in zip(texts, found)], pa.string())],
                names=schema.names)

        ids, texts, n, id_type = [], [], 0, None
        for batch in slices(batches, "raw"):
            id_type = batch.column(0).type
            for at, raw in enumerate(batch.column(1)):
                words = raw.as_py().split()     # of bytes: splits at the six characters of SPACE
                if texts and n + len(words) > BATCH_WORDS:
                    yield emit(ids, texts, id_type)
                    ids, texts, n = [], [], 0
                ids.append(batch.column(0)[at].as_py())
                texts.append(words)
                n += len(words)
        if texts:
            yield emit(ids, texts, id_type)

    return docs.select("doc_id", text_bytes(text_col).alias("raw")).mapInArrow(run, schema)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words outside of what repeats: of each run its first period stays."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for s, n, q in runs:
        edges[s + q] += 1
        edges[s + n] -= 1
    return list(itertools.compress(words, np.cumsum(edges[:-1]) == 0))


def echoed(docs: DataFrame, key: Column) -> DataFrame:
    """Documents of which a tenth, by ``key``, repeat themselves from some word to their end.

    With h = key, g = h div 10: if h % 10 = 0, each word i >= a = g % n becomes word
    a + (i - a) % p, where p = 1 + (n - a) div (3 + g % 8).
    """
    g = F.expr("h div 10")
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), 1)
    cut = docs.select("doc_id", "text", key.alias("h")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("words"))
    cut = cut.withColumn("a", (g % F.greatest("n", F.lit(1))).cast("int"))
    cut = cut.withColumn("p", F.expr("cast(1 + (n - a) div (3 + (h div 10) % 8) as int)"))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    echo = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.element_at("words", 1 + place(i)))
    return cut.select("doc_id", F.when(F.col("n") > 0, F.array_join(echo, " ")).otherwise(F.col("text")).alias("text"))
