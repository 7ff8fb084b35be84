"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A paragraph is a line, cut further after words that a hash picks or a few words, so that
an edit changes the paragraphs it touches and no others.  The digests of a text (repeats
told apart by their number) go into a sketch: each into one cell of three tables,
and a cell keeps how many, and the sum of the digests, whose last 16 bits check the rest.
Cells are numbered by the top bits of a hash, so adding neighbours folds a sketch to half
its size.  A text's sketch is retried, twice as large, until peeling lists all its digests;
its size and content depend on the text alone.

Two fingerprints are compared from their strings alone: the larger is folded to the size
of the smaller, they subtract cell by cell, equal paragraphs cancel out, and peeling
cells that hold one paragraph recovers the digests that differ.  Where more differ than
the smaller size holds, each side is peeled at its own, larger size instead, which cannot
get stuck; so a likeness is always exact.

The order of documents (each one's next document) comes from ranges of ``doc_id``:
every range carries a copy of the first document of the following one, so no window
runs over the whole table.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflife.llm.common import partitions, slices, text_bytes

TABLES = 3
LOAD = 1.6              # digests a cell of one table where a sketch's size starts
ROUNDS = 200            # peeling that takes longer counts as stuck
PICK, MOST = 4, 8       # a paragraph is cut after one word in PICK, about, and after MOST words
LONG_WORD = 64          # a longer word is cut into pieces of so many bytes
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
MINUS = np.uint64(0xFFFFFFFFFFFFFFFF)  # -1 in sums modulo 2**64
CELL = np.dtype([("n", "u1"), ("sum", ">u8")])


def paragraphs(text: bytes) -> list[bytes]:
    """The paragraphs of a text in order; white space only separates them."""
    out, h = [], xxhash.xxh32_intdigest
    for line in text.split(b"\n"):
        words = line.split()
        a = 0
        for i, w in enumerate(words, 1):
            if len(w) > LONG_WORD:
                if a < i - 1:
                    out.append(b" ".join(words[a:i - 1]))
                out += [w[k:k + LONG_WORD] for k in range(0, len(w), LONG_WORD)]
                a = i
            elif i - a == MOST or not h(w) % PICK:
                out.append(b" ".join(words[a:i]))
                a = i
        if a < len(words):
            out.append(b" ".join(words[a:]))
    return out


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ np.uint64(salt)) * M1
    x ^= x >> np.uint64(29)
    x *= M2
    return x ^ (x >> np.uint64(32))


def sealed(hashes: np.ndarray) -> np.ndarray:
    """Digests: the first 48 bits of each hash, and 16 bits that check them."""
    high = hashes >> np.uint64(16)
    return (high << np.uint64(16)) | (_mix(high, 77) >> np.uint64(48))


def digests(text: bytes) -> np.ndarray:
    """Distinct digests of the paragraphs; the k-th repeat of one has its own."""
    seen: dict[int, int] = {}
    out = []
    h = xxhash.xxh64_intdigest
    for p in paragraphs(text):
        d = h(p)
        k = seen.get(d >> 16, 0)
        seen[d >> 16] = k + 1
        out.append(h(p, k) if k else d)
    return np.unique(sealed(np.array(out, np.uint64)))


# ---- sketches: (2, texts, TABLES, cells) of counts and digest sums, modulo 2**64 ----

def _places(owner: np.ndarray, keys: np.ndarray, cells: int) -> list[np.ndarray]:
    """The cell of each key in each table of its owner's sketch: the top bits of a hash."""
    shift = np.uint64(65 - cells.bit_length())
    return [(owner * TABLES + t) * cells + (_mix(keys, t + 1) >> shift).astype(np.int64)
            for t in range(TABLES)]


def _put(sketch: np.ndarray, places: list[np.ndarray], keys: np.ndarray, times: np.ndarray) -> None:
    n, total = sketch.reshape(2, -1)
    for at in places:
        np.add.at(n, at, times)
        np.add.at(total, at, keys * times)


def sketches(texts: list[np.ndarray], cells: int) -> np.ndarray:
    """Sketches of the digests of some texts with ``cells`` (a power of two) cells a table."""
    out = np.zeros((2, len(texts), TABLES, cells), np.uint64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    keys = np.concatenate([np.zeros(0, np.uint64), *texts])
    _put(out, _places(owner, keys, cells), keys, np.ones(len(keys), np.uint64))
    return out


def folded(sketch: np.ndarray, cells: int) -> np.ndarray:
    """The sketch of the same digests with fewer cells."""
    return sketch.reshape(*sketch.shape[:-1], cells, -1).sum(axis=-1)


def peel(sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(owner, digest, 1 or -1) of what the sketches hold, by owner, and whose peeling got stuck.

    Every round takes all cells that hold one digest; the sketches are used up.
    """
    texts, cells = sketch.shape[1], sketch.shape[3]
    n, total = sketch.reshape(2, -1)
    one, found = np.uint64(1), []
    at = np.flatnonzero((n == one) | (n == MINUS))
    for _ in range(ROUNDS):
        if not len(at):
            break
        sign = n[at]
        key = total[at] * sign
        good = sealed(key) == key
        at, sign, key = at[good], sign[good], key[good]
        row = at // cells
        owner, table = row // TABLES, row % TABLES
        places = _places(owner, key, cells)
        # it must lie in its own cell; alone in several cells, it is taken from the first
        first = np.choose(table, places) == at
        for t in range(TABLES - 1):
            own = places[t]
            first &= ~((table > t) & (n[own] == sign) & (total[own] == key * sign))
        owner, key, sign = owner[first], key[first], sign[first]
        if not len(key):
            break
        places = [p[first] for p in places]
        found.append((owner, key, sign))
        _put(sketch, places, key, sign * MINUS)
        at = np.unique(np.concatenate(places))
        at = at[(n[at] == one) | (n[at] == MINUS)]
    stuck = sketch.any(axis=(0, 2, 3))
    empty = (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    owner, key, sign = (np.concatenate(x) for x in zip(empty, *found))
    order = np.lexsort((key, owner))
    owner, key, sign = owner[order], key[order], sign[order]
    # a cell that only looked like one digest may be taken back later: not to be trusted
    twice = (owner[1:] == owner[:-1]) & (key[1:] == key[:-1])
    stuck[owner[1:][twice]] = True
    return owner, key, np.where(sign == one, 1, -1), stuck


class Fingerprint:
    """The sketch (2, TABLES, cells) of one text, and the digests that it gives back."""

    def __init__(self, sketch: np.ndarray, held: np.ndarray | None = None):
        self.sketch, self._held = sketch, held

    @property
    def cells(self) -> int:
        return self.sketch.shape[-1]

    @property
    def n(self) -> int:
        """How many digests it holds."""
        return int(self.sketch[0, 0].sum())

    @property
    def held(self) -> np.ndarray:
        if self._held is None:
            self._held = peel(self.sketch[:, None].copy())[1]
        return self._held

    def __str__(self) -> str:
        """Counts (8 bits) and digest sums (64 bits) of all cells, in base64."""
        cells = np.zeros(TABLES * self.cells, CELL)
        cells["n"], cells["sum"] = self.sketch.reshape(2, -1)
        return base64.b64encode(cells.tobytes()).decode()

    @classmethod
    def read(cls, text: str) -> "Fingerprint":
        cells = np.frombuffer(base64.b64decode(text), CELL)
        return cls(np.stack([cells["n"].astype(np.uint64), cells["sum"].astype(np.uint64)])
                   .reshape(2, TABLES, -1))


def start(n: int) -> int:
    """Cells a table where the size of a sketch of ``n`` digests starts."""
    return max(2, 1 << max(0, int(np.ceil(n / LOAD)) - 1).bit_length())


def fingerprint(texts: list[np.ndarray]) -> list[Fingerprint]:
    """Of each text's digests, the smallest sketch that peels, from :func:`start` on."""
    out: list = [None] * len(texts)
    todo: dict[int, list[int]] = {}
    for i, t in enumerate(texts):
        todo.setdefault(start(len(t)), []).append(i)
    while todo:
        cells = min(todo)
        own = todo.pop(cells)
        made = sketches([texts[i] for i in own], cells)
        owner, key, _, stuck = peel(made.copy())
        stuck |= (made[0] > np.uint64(255)).any(axis=(1, 2))
        ends = np.searchsorted(owner, np.arange(len(own) + 1))
        for j, i in enumerate(own):
            if stuck[j]:
                todo.setdefault(2 * cells, []).append(i)
            else:
                out[i] = Fingerprint(made[:, j], key[ends[j]:ends[j + 1]])
    return out


def differences(pairs: list[tuple[Fingerprint, Fingerprint]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per pair the digests only in the first and only in the second, ascending.

    Pairs are subtracted at the smaller of their sizes; where the share of cells that do
    not cancel out tells that peeling cannot end, or it gets stuck, both sides are
    peeled at their own sizes.
    """
    out: list = [None] * len(pairs)
    sizes: dict[int, list[int]] = {}
    for i, (a, b) in enumerate(pairs):
        sizes.setdefault(min(a.cells, b.cells), []).append(i)
    for cells, own in sizes.items():
        diff = np.stack([folded(pairs[i][0].sketch, cells) - folded(pairs[i][1].sketch, cells)
                         for i in own], axis=1)
        # d digests leave a share of exp(-d / cells) of the cells empty
        hope = (~diff.any(axis=0)).mean(axis=(1, 2)) > np.exp(-2.3)
        own = [i for i, h in zip(own, hope) if h]
        owner, key, sign, stuck = peel(diff[:, hope].copy())
        ends = np.searchsorted(owner, np.arange(len(own) + 1))
        for j, i in enumerate(own):
            if not stuck[j]:
                k, g = key[ends[j]:ends[j + 1]], sign[ends[j]:ends[j + 1]]
                out[i] = (k[g > 0], k[g < 0])
    for i, (a, b) in enumerate(pairs):
        if out[i] is None:
            out[i] = (np.setdiff1d(a.held, b.held, True), np.setdiff1d(b.held, a.held, True))
    return out


def likeness(pairs: list[tuple[Fingerprint, Fingerprint]]) -> list[float]:
    """Per pair of fingerprints, the shared share of all their paragraphs (1 for two empty ones)."""
    return [1.0 if a.n + len(only_b) == 0 else (a.n - len(only_a)) / (a.n + len(only_b))
            for (a, _), (only_a, only_b) in zip(pairs, differences(pairs))]


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the beginning of ``following``."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


def _dealt(docs: DataFrame) -> DataFrame:
    """Rows (part, copy, doc_id, text) so that ordering a part gives each row's next one.

    Parts are ranges of doc_id, descending, null last.  ``copy`` marks the one row that
    stands at the end of a part and belongs to the following part; the last part gets
    the very first row.  What the driver holds is one row per part.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    # numbers that ascend as the order goes on; null ids come after all others
    rank = F.coalesce(-F.col("doc_id").cast("decimal(20,0)"), F.lit("1" + "0" * 19).cast("decimal(20,0)"))
    keyed = rows.select("*", rank.alias("rank"), F.xxhash64("text").alias("h"))
    cuts = keyed.select(F.col("rank").cast("double").alias("r")).agg(
        F.percentile_approx("r", [i / n for i in range(1, n)], 10_000)).first()[0] if n > 1 else []
    cuts = sorted(set(cuts or []))
    part = F.lit(0)
    if cuts:
        at = F.array(*map(F.lit, cuts))
        part = F.size(F.filter(at, lambda c: c < F.col("rank").cast("double")))
    keyed = keyed.withColumn("part", part)
    first = keyed.groupBy("part").agg(F.min(F.struct("rank", "h")).alias("low")).collect()
    heads = sorted((r["part"], r["low"]["rank"], r["low"]["h"]) for r in first)
    if not heads:
        return keyed.select("part", F.lit(False).alias("copy"), "rank", "h", "doc_id", "text")
    before = [heads[i - 1][0] for i in range(len(heads))]  # of the first: the last part
    ends = spark.createDataFrame([(p, r, h, b) for (p, r, h), b in zip(heads, before)],
                                 "p int, r decimal(20,0), hh long, before int")
    own = keyed.select("part", F.lit(False).alias("copy"), "rank", "h", "doc_id", "text")
    # one row a part, so at most as many as partitions
    copies = keyed.join(F.broadcast(ends), (F.col("part") == F.col("p")) & (F.col("rank") == F.col("r"))
                        & (F.col("h") == F.col("hh")))
    copies = copies.select(F.col("before").alias("part"), F.lit(True).alias("copy"),
                           "rank", "h", "doc_id", "text").dropDuplicates(["part"])
    return own.unionByName(copies)


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    The last two follow from the strings alone: ``likeness`` of what ``Fingerprint.read``
    makes of them (the next document's being its own row's ``fingerprint``).  A string has
    36 characters for each cell of a table, 22 to 45 a paragraph, about, so it grows with its text.
    The next document is the one before it by ``doc_id`` (null ids last, equal ids by a
    hash of the text), that of the last is the first; a single document is its own
    next.  Null text counts as empty, and two texts without paragraphs are alike (1).
    An empty table gives no rows.
    """
    out = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                     ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                     ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held = None, None  # the row that waits for its next one
        for batch in slices(batches, "text", 1 << 20):
            rows, at = ([held[0]], [held[1]]) if held else ([], [])
            pairs = []  # numbers of a row and its next one
            keys, new = list(at), []
            for part, copy, doc, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if held is not None and part == here:
                    pairs.append((len(rows) - 1, len(rows)))
                here, text = part, raw.decode()
                rows.append((doc, text))
                keys.append(digests(raw))
                held = None if copy else rows[-1]
            texts = [edited(rows[i][1], rows[j][1]).encode() for i, j in pairs]
            own, new = fingerprint(keys), fingerprint([digests(t) for t in texts])
            held = held and (held, keys[-1])
            if pairs:
                cols = ([rows[i][0] for i, _ in pairs], [len(rows[i][1]) for i, _ in pairs],
                        [hashlib.sha256(t).hexdigest() for t in texts],
                        [str(own[i]) for i, _ in pairs], [str(f) for f in new],
                        likeness([(own[i], f) for (i, _), f in zip(pairs, new)]),
                        likeness([(own[i], own[j]) for i, j in pairs]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(cols, out)], schema=out)

    dealt = (_dealt(docs).repartitionById(partitions(docs.sparkSession), F.col("part"))
             .sortWithinPartitions("part", "copy", "rank", "h"))
    return dealt.select("part", "copy", "doc_id", "text").mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
             "edited_fingerprint string, near_edited double, near_next double")
