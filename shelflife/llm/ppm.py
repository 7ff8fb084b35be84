"""Language-model scoring by prediction by partial matching, pretrained on the corpus.

The model is a trie of byte contexts, read backwards from the byte before the one to
predict.  A context predicts the symbols it has seen by their counts, or escapes to
the next shorter one, where symbols that longer contexts have seen are excluded.
Below the empty context all symbols are equally likely.  A text is its bytes and one
end symbol, and its score the sum of the log10 probabilities under the longest context
of each position.

Counts come from all training documents, added up in each task before the shuffle.
The trie is cut by the last bytes of the context into shards of a bounded number of
contexts, and a scoring pass holds one shard: what is broadcast is bounded however
large the corpus, and every position is scored in exactly one pass.  What escape
estimates are learned from is added up over all contexts first, so scores do not
depend on how many shards there are.

The baseline is a word unigram.  A bounded number of most frequent words is broadcast;
the others are joined, so no key of that join is hot.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflife.llm.common import key_crc, partitions, slices, stored, text_bytes, worker_cache

ORDER = 5               # bytes of the longest context
LOW = 3                 # shards are cut by so many last bytes; shorter contexts go to every shard
END = 256               # the symbol after a text
DENSE = 3               # steps of a walk that go through a table of all bytes
MAX_CONTEXTS = 1 << 19  # longest contexts of a shard (those with the same last bytes are 2**16 at most)
HOT_WORDS = 1 << 16     # words whose counts are broadcast, at most
FLUSH = 1 << 20         # distinct items that a counting task holds


def _positions(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One array of bytes with ``order`` zero bytes before each text and one after it; the
    positions to predict (all bytes and the end of each text); where each text's begin."""
    gap = b"\0" * order
    raw = np.frombuffer(gap + (b"\0" + gap).join(texts) + b"\0", np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    first = np.cumsum(sizes + order) - sizes
    wanted = np.ones(len(raw), bool)
    for k in range(1, order + 1):
        wanted[first - k] = False
    at = np.flatnonzero(wanted)
    return raw, at, np.cumsum(sizes) - sizes


def _symbols(raw: np.ndarray, at: np.ndarray, begins: np.ndarray) -> np.ndarray:
    out = raw[at].astype(np.int64)
    out[np.append(begins[1:], len(at)) - 1] = END
    return out


def _gram_keys(texts: list[bytes], order: int) -> np.ndarray:
    """Context and symbol of every position as one number: context bytes, then 9 bits."""
    raw, at, begins = _positions(texts, order)
    key = np.zeros(len(at), np.int64)
    for k in range(order, 0, -1):
        key = (key << 8) | raw[at - k]
    return (key << 9) | _symbols(raw, at, begins)


def gram_counts(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, n) over all texts of column ``raw``."""
    def folded(held):
        keys, where = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        return keys, np.bincount(where, np.concatenate([n for _, n in held])).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0  # counts of slices, folded together when they are many
        for part in slices(batches, "raw", 2 << 20):
            got = _gram_keys([t.lower() for t in part.column(0).to_pylist()], order)
            held.append(np.unique(got, return_counts=True))
            size += len(held[-1][0])
            if size > FLUSH:
                held = [folded(held)]
                size = len(held[0][0])
                if size > FLUSH // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], names=["gram", "n"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in folded(held)], names=["gram", "n"])

    part = texts.select("raw").mapInArrow(run, "gram long, n long")
    return part.groupBy("gram").agg(F.sum("n").alias("n"))


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts of column ``raw``; the end of a text is the empty word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())],
                names=["word", "n"])

        for part in slices(batches, "raw"):
            for t in part.column(0).to_pylist():
                total.update(t.lower().split())
                total[b""] += 1
                if len(total) > FLUSH // 4:
                    yield out()
                    total = Counter()
        yield out()

    part = texts.select("raw").mapInArrow(run, "word binary, n long")
    return part.groupBy("word").agg(F.sum("n").alias("n"))


class _Level:
    """Contexts of ``k`` bytes (sorted grams), linked to the level of one byte less, if given."""

    def __init__(self, grams: tuple, k: int, above: "_Level | None"):
        ctx, self.sym, self.n = grams
        begins = np.ones(len(ctx), bool)  # grams are sorted, so a context's stand together
        np.not_equal(ctx[1:], ctx[:-1], out=begins[1:])
        self.nodes = ctx[begins]
        self.node = node = np.cumsum(begins, dtype=np.int32) - 1
        self.size = max(1, len(self.nodes))
        self.d = np.bincount(node, minlength=self.size)
        self.total = np.bincount(node, self.n, minlength=self.size)
        self.keys = (node.astype(np.int64) << 9) | self.sym
        if above:
            self.at = np.searchsorted(above.nodes, self.nodes & ((1 << (8 * (k - 1))) - 1))
            self.seen_up = above.n[np.searchsorted(above.keys, (self.at[node] << 9) | self.sym)]
            self.rest = above.total[self.at] - np.bincount(node, self.seen_up, minlength=len(self.nodes))
            self.d_rest = above.d[self.at] - self.d

    def learned(self) -> "_Escapes":
        """From contexts as they are, leaving out one occurrence at a time."""
        node, once, e = self.node, self.n == 1, _Escapes()
        e.learn(self.total[node] - 1, self.d[node] - once, once, np.where(once, 1, self.n))
        return e

    def learned_after(self) -> "_Escapes":
        """From the contexts above, without what the longer context that escaped has seen."""
        node, once, e = self.node, self.n == 1, _Escapes()
        e.learn((self.rest[node] + self.seen_up - 1)[once],
                (self.d_rest[node] + (self.seen_up > 1))[once],
                (self.seen_up == 1)[once], np.ones(once.sum()))
        return e


class Trie:
    """Contexts of a shard, the symbols seen after them, and their escape estimates.

    ``low`` are the grams (context, symbol, n) of order up to LOW and ``high`` those of
    the full order that belong to the shard.  A shorter context counts each longer one
    that saw a symbol once (update exclusion).  How likely a context is to meet a new
    symbol is estimated, per order, from all contexts of like count and like number of
    symbols: leaving out one occurrence at a time, a symbol seen once would have been
    new.  The same is done for contexts reached by an escape, with what is excluded.  For
    orders above LOW, where a shard has its own contexts alone, ``learned`` has what was
    learned from all of them (:func:`escapes_of_all`).
    """

    def __init__(self, low: tuple, high: tuple, order: int, learned: dict | None = None):
        self.order = order
        grams = {min(order, LOW): low, order: high if order > LOW else low}
        for k in range(order - 1, -1, -1):
            if k not in grams:
                ctx, sym, _ = grams[k + 1]
                grams[k] = _summed(ctx & ((1 << (8 * k)) - 1), sym)
        seen = np.unique(grams[0][1])
        self.column = np.full(END + 1, len(seen), np.int32)  # unseen symbols share the last one
        self.column[seen] = np.arange(len(seen))
        self.width = w = len(seen) + 1
        keys, logp, logc, child, far, far_node = [], [], [], [], [], []
        escape, excluded, left, parent = [], [], [], []
        base, above, learned = 0, None, learned or {}
        for k in range(order + 1):
            level = _Level(grams[k], k, above)
            node, nodes, sym, n = level.node, level.nodes, level.sym, level.n
            e = learned.get((k, 0)) or level.learned()
            own = e.estimate(level.total, level.d)
            if len(nodes) == 0:
                own[:] = 1
            if k == 0:
                up = np.zeros(1, np.int64)
                out, rest = np.ones(1), np.ones(1)
            else:
                at, rest = level.at, level.rest
                last = (nodes >> (8 * (k - 1))) & 255
                if k <= DENSE:
                    child[-1][at, self.column[last]] = base + np.arange(len(nodes))
                else:
                    far.append(((p_base + at) << 9) | last)
                    far_node.append(base + np.arange(len(nodes)))
                e = learned.get((k, 1)) or level.learned_after()
                out = np.where(level.d_rest > 0, e.estimate(rest, level.d_rest), 1.0)
                up = p_base + at
            with np.errstate(divide="ignore"):
                logp.append(np.log10((1 - own[node]) * n / level.total[node]).astype(np.float32))
                logc.append(np.log10(n).astype(np.float32))
                escape.append(np.log10(own))
                excluded.append(np.log10(out))
                left.append(np.log10((1 - out) / np.maximum(rest, 1)))
            keys.append(((base + node.astype(np.int64)) << 9) | sym)
            parent.append(up)
            if k < min(order, DENSE):
                child.append(np.full((level.size, w), -1, np.int32))
            grams[k] = None
            above, p_base = level, base
            base += level.size
        self.n_inner = sum(map(len, child))
        # one more row, where a walk that found no child stays
        self.child = np.append(np.concatenate(child).reshape(-1) if child else [],
                               np.full(w, -1)).astype(np.int32)
        f32 = lambda x: np.concatenate(x).astype(np.float32, copy=False)
        self.logp, self.logc = f32(logp), f32(logc)
        self.escape, self.excluded, self.left = f32(escape), f32(excluded), f32(left)
        self.parent = np.concatenate(parent).astype(np.int32)
        self.unseen = math.log10(1 / max(1, END + 1 - len(seen)))
        self.entries = _Slots(np.concatenate(keys))
        self.far = _Slots(np.concatenate(far) if far else np.zeros(0, np.int64))
        self.far_node = np.concatenate([*far_node, [-1]]).astype(np.int32)

    def scores(self, texts: list[bytes], mine: np.ndarray | None) -> np.ndarray:
        """log10 probability of each text; with ``mine`` only of the positions whose last
        LOW bytes it marks."""
        raw, at, begins = _positions(texts, self.order)
        if not len(begins):
            return np.zeros(0)
        sym = _symbols(raw, at, begins)
        if mine is None:
            value = self.position_scores(raw, at, sym)
        else:
            last = np.zeros(len(at), np.int64)
            for k in range(LOW, 0, -1):
                last = (last << 8) | raw[at - k]
            own = np.flatnonzero(mine[last])
            value = np.zeros(len(at), np.float32)
            value[own] = self.position_scores(raw, at[own], sym[own])
        return np.add.reduceat(value, begins, dtype=np.float64)

    def position_scores(self, raw: np.ndarray, at: np.ndarray, sym: np.ndarray) -> np.ndarray:
        """log10 probability of the symbol ``sym`` at each position ``at``."""
        col, w = self.column[raw], self.width
        walk = np.zeros(len(at), np.int32)
        node = walk.copy()
        for k in range(1, min(self.order, DENSE) + 1):
            walk = self.child[walk * w + col[at - k]]
            found = walk >= 0
            np.copyto(node, walk, where=found)
            if k < min(self.order, DENSE):
                walk[~found] = self.n_inner
        live = np.flatnonzero(walk >= 0)
        for k in range(DENSE + 1, self.order + 1):
            got = self.far_node[self.far.find((node[live].astype(np.int64) << 9) | raw[at[live] - k])]
            live = live[got >= 0]
            node[live] = got[got >= 0]
        entry = self.entries.find((node.astype(np.int64) << 9) | sym)
        value = self.logp[entry]
        # escapes: to the next shorter context, without what the longer one has seen
        todo = np.flatnonzero(entry < 0)
        below = node[todo]
        value[todo] = self.escape[below]
        while len(todo):
            root = below == 0
            value[todo[root]] += self.unseen
            todo, below = todo[~root], below[~root]
            up = self.parent[below]
            entry = self.entries.find((up.astype(np.int64) << 9) | sym[todo])
            hit = entry >= 0
            value[todo[hit]] += self.logc[entry[hit]] + self.left[below[hit]]
            value[todo[~hit]] += self.excluded[below[~hit]]
            todo, below = todo[~hit], up[~hit]
        return value


class _Slots:
    """Numbers of distinct keys by open addressing, for whole arrays at a time."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(len(keys) * 2.5).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int32)
        self.keys = np.append(keys, -1)
        at, todo = self._slot(keys), np.arange(len(keys), dtype=np.int32)
        while len(todo):  # the last writer has the slot, the others move on
            free = self.slots[at] < 0
            self.slots[at[free]] = todo[free]
            lost = self.slots[at] != todo
            at, todo = (at[lost] + 1) & (len(self.slots) - 1), todo[lost]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key, -1 for others."""
        at = self._slot(keys)
        got = self.slots[at]
        wrong = np.flatnonzero((got >= 0) & (self.keys[got] != keys))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & (len(self.slots) - 1)
            e = self.slots[at[wrong]]
            got[wrong] = e
            wrong = wrong[(e >= 0) & (self.keys[e] != keys[wrong])]
        return got


class _Escapes:
    """Escape frequencies by class of (count, number of symbols)."""

    N, D = 64, 24

    def __init__(self):
        self.new, self.all = np.zeros(self.N * self.D), np.zeros(self.N * self.D)

    def _cell(self, n, d):
        size = np.minimum(3 * np.log2(np.maximum(n, 1)), self.N - 1).astype(int)
        return np.clip(d, 0, self.D - 1).astype(int) * self.N + size

    def learn(self, n, d, new, weight) -> None:
        ok = d > 0
        cell = self._cell(n, d)[ok]
        k = self.N * self.D
        self.new = np.bincount(cell, weight[ok] * new[ok], k)
        self.all = np.bincount(cell, weight[ok], k)

    def estimate(self, n, d) -> np.ndarray:
        """With two imagined cases at the rate of symbols to count."""
        cell = self._cell(n, d)
        prior = d / np.maximum(2.0 * n, 1)
        return np.clip((self.new[cell] + 2 * np.clip(prior, 0, 0.9)) / (self.all[cell] + 2),
                       1e-6, 0.99)


def _summed(ctx: np.ndarray, sym: np.ndarray) -> tuple:
    """Grams of shorter contexts: the number of longer ones that saw the symbol."""
    key, n = np.unique((ctx << 9) | sym, return_counts=True)
    return key >> 9, (key & 511).astype(np.int16), n.astype(np.int32)


def _arrays(grams: DataFrame) -> tuple:
    """Sorted (context, symbol, n); collected, so bounded by the caller."""
    got = grams.select("gram", "n").toArrow()
    key = got.column("gram").to_numpy()
    order = np.argsort(key)
    key = key[order]
    return key >> 9, (key & 511).astype(np.int16), got.column("n").to_numpy()[order]


def _shorter(grams: DataFrame, order: int, to: int) -> DataFrame:
    """Grams of ``to`` bytes from those of ``order``: per length, how many longer saw the symbol."""
    for k in range(order - 1, to - 1, -1):
        key = F.shiftleft(F.shiftright("gram", 9).bitwiseAND((1 << (8 * k)) - 1), 9).bitwiseOR(
            F.col("gram").bitwiseAND(511))
        grams = grams.groupBy(key.alias("gram")).agg(F.count("*").alias("n"))
    return grams


def _end() -> Column:
    """The last LOW bytes of a gram's context."""
    return F.shiftright("gram", 9).bitwiseAND((1 << (8 * LOW)) - 1)


def escapes_of_all(grams: DataFrame, order: int) -> dict[tuple[int, int], _Escapes]:
    """What is learned from all contexts of more than LOW bytes, by (order, 1 if after an escape).

    Contexts of the same last LOW bytes come together, so a task sees all that a context
    and those above it have seen; the cells, a bounded number, are whole numbers and added up.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {(k, kind): (np.zeros(_Escapes.N * _Escapes.D), np.zeros(_Escapes.N * _Escapes.D))
                 for k in range(LOW + 1, order + 1) for kind in (0, 1)}

        def learn(gram, n):
            by = np.argsort(gram)
            key = gram[by]
            grams = {order: (key >> 9, (key & 511).astype(np.int16), n[by])}
            for k in range(order - 1, LOW - 1, -1):
                ctx, sym, _ = grams[k + 1]
                grams[k] = _summed(ctx & ((1 << (8 * k)) - 1), sym)
            level = _Level(grams[LOW], LOW, None)
            for k in range(LOW + 1, order + 1):
                level = _Level(grams[k], k, level)
                for kind, e in enumerate((level.learned(), level.learned_after())):
                    total[k, kind][0][:] += e.new
                    total[k, kind][1][:] += e.all

        held, size, room = [], 0, FLUSH
        for b in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in b.columns])
            size += b.num_rows
            if size > room:  # all but the last end are whole
                end, gram, n = map(np.concatenate, zip(*held))
                cut = np.searchsorted(end, end[-1])
                if cut:
                    learn(gram[:cut], n[:cut])
                held, size = [[end[cut:], gram[cut:], n[cut:]]], len(end) - cut
                room = max(FLUSH, 2 * size)
        if size:
            _, gram, n = map(np.concatenate, zip(*held))
            learn(gram, n)
        for (k, kind), (new, every) in total.items():
            cell = np.flatnonzero(every)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(cell), k)), pa.array(np.full(len(cell), kind)), pa.array(cell),
                 pa.array(new[cell].astype(np.int64)), pa.array(every[cell].astype(np.int64))],
                names=["k", "kind", "cell", "new", "every"])

    rows = grams.select(_end().alias("end"), "gram", "n").repartition(
        partitions(grams.sparkSession), "end").sortWithinPartitions("end")
    cells = rows.mapInArrow(run, "k long, kind long, cell long, new long, every long").groupBy(
        "k", "kind", "cell").agg(F.sum("new").alias("new"), F.sum("every").alias("every"))
    out = {(k, kind): _Escapes() for k in range(LOW + 1, order + 1) for kind in (0, 1)}
    for r in cells.collect():
        out[r.k, r.kind].new[r.cell], out[r.k, r.kind].all[r.cell] = r.new, r.every
    return out


def shards(grams: DataFrame, order: int, max_contexts: int) -> list[np.ndarray | None]:
    """Last bytes (LOW of them, as numbers) that make up each shard; None is all of them."""
    if order <= LOW:
        return [None]
    ctx = F.shiftright("gram", 9)
    if grams.select(ctx).distinct().count() <= max_contexts:
        return [None]
    ends = grams.select(ctx.alias("ctx")).distinct().groupBy(
        F.col("ctx").bitwiseAND((1 << (8 * LOW)) - 1).alias("end")).count().collect()
    out, room = [], 0
    for r in sorted(ends, key=lambda r: (-r["count"], r["end"])):
        if r["count"] > room:
            out.append([])
            room = max_contexts
        out[-1].append(r["end"])
        room -= r["count"]
    return [np.array(x, np.int64) for x in out]


def held_out(col: str = "doc_id") -> Column:
    return key_crc(col) % 5 == 1


def score(docs: DataFrame, order: int = ORDER, max_contexts: int = MAX_CONTEXTS,
          hot_words: int = HOT_WORDS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null and empty texts are the end alone; a null ``doc_id`` has the crc32 of the
    empty text; repeated rows are scored each; without training documents all symbols
    and the end are equally unknown; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                       text_bytes().alias("raw"))
    train = rows.filter(~F.col("held_out"))
    grams = stored(gram_counts(train, order), "grams")
    words = stored(word_counts(train), "words")
    n_all, v_all = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    norm = math.log10(n_all + 0.5 * (v_all + 1))

    # hot words: all from a power of two on, so that they are hot_words at most
    sizes = {r["p"]: r["count"] for r in
             words.groupBy(F.floor(F.log2("n")).cast("int").alias("p")).count().collect()}
    least, held = 63, 0
    while least > 0 and held + sizes.get(least - 1, 0) <= hot_words:
        least -= 1
        held += sizes.get(least, 0)
    hot = {bytes(r.word): r.n for r in words.filter(F.col("n") >= F.lit(1 << least)).collect()}
    hot.setdefault(b"", words.filter(F.col("word") == F.lit(b"")).agg(F.sum("n")).first()[0] or 0)
    hot_bc = spark.sparkContext.broadcast({w: math.log10(n + 0.5) for w, n in hot.items()})
    end_known = int(hot[b""] > 0)

    low = _arrays(_shorter(grams, order, min(order, LOW)))

    def model(mine, first):
        own = grams
        if mine is not None:
            names = spark.createDataFrame([(int(p),) for p in mine], "end long")
            own = grams.join(names, F.col("end") == _end(), "left_semi")
        high = _arrays(own) if order > LOW else None
        return _Model(spark.sparkContext.broadcast((low, high, mine, first, learned)))

    def trie(bc) -> Trie:
        cache = worker_cache()
        if cache.get("ppm") != bc.id_key:
            cache["ppm_trie"] = None
            low, high, mine, first, learned = bc.value
            marks = None
            if mine is not None:  # ends without longer contexts are scored in the first pass
                marks = np.full(1 << (8 * LOW), first is not None)
                marks[mine if first is None else first] = first is None
            cache["ppm_trie"] = Trie(low, high, order, learned), marks
            cache["ppm"] = bc.id_key
        return cache["ppm_trie"]

    marks = shards(grams, order, max_contexts)
    learned = escapes_of_all(grams, order) if len(marks) > 1 else None
    # positions whose last bytes are in no shard have short contexts alone: the first pass
    # scores whatever the later ones do not
    others = np.concatenate(marks[1:]) if len(marks) > 1 else None
    whole = _scored(rows, model(marks[0], others), hot_bc, end_known, trie)
    whole = stored(whole.withColumn("row", F.monotonically_increasing_id()), "scores")

    # words beyond the hot ones
    cold = whole.select("row", F.explode("cold").alias("c")).select("row", "c.word", "c.n")
    counts = words.select(F.col("word").alias("w"), F.col("n").alias("count"))
    c = F.coalesce("count", F.lit(0))
    cold = cold.join(counts, F.col("word") == F.col("w"), "left").groupBy("row").agg(
        F.sum(F.col("n") * F.log10(c + 0.5)).alias("cold_sum"),
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("cold_known"))
    out = whole.join(cold.withColumnRenamed("row", "of_row"), F.col("row") == F.col("of_row"), "left")

    for i, mine in enumerate(marks[1:]):
        more = _scored(rows, model(mine, None), None, 0, trie).select(
            F.col("doc_id").alias("d"), F.col("hash").alias("h"), F.col("score").alias(f"more{i}"))
        more = stored(more.dropDuplicates(["d", "h"]), "scores")
        out = out.join(more, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("hash") == F.col("h"))
                       ).withColumn("score", F.col("score") + F.col(f"more{i}")).drop("d", "h")

    return out.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("cold_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("hot_sum") + F.coalesce("cold_sum", F.lit(0.0)) - F.col("n_tokens") * norm
         ).alias("base_score"), "score")


class _Model:
    """A broadcast shard with a name by which workers know a trie they have built."""

    def __init__(self, bc):
        self.bc, self.id_key = bc, (id(bc), bc._jbroadcast.id() if bc._jbroadcast else 0)

    def __getstate__(self):
        return self.bc, self.id_key

    def __setstate__(self, state):
        self.bc, self.id_key = state

    @property
    def value(self):
        return self.bc.value


def _scored(rows: DataFrame, model: _Model, hot_bc, end_known: int, trie) -> DataFrame:
    """Per document: its PPM score under the shard, sums over hot words, and its cold words."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("hash", pa.int64()),
                        ("n_tokens", pa.int64()), ("known", pa.int64()), ("hot_sum", pa.float64()),
                        ("score", pa.float64()),
                        ("cold", pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, marks = trie(model)
        hot = hot_bc.value if hot_bc else None
        for part in slices(batches, "raw", 1 << 20):
            texts = [t.lower() for t in part.column(2).to_pylist()]
            scores = own.scores(texts, marks)
            n_tokens, known, sums, cold = [], [], [], []
            for t in texts if hot is not None else ():
                ws = t.split()
                got = list(map(hot.get, ws))
                ends = hot[b""]
                n_tokens.append(len(ws) + 1)
                other = Counter(w for w, g in zip(ws, got) if g is None)
                got = [g for g in got if g is not None]
                known.append(len(got) + end_known)
                sums.append(math.fsum(got) + ends)
                cold.append([{"word": w, "n": n} for w, n in other.items()])
            if hot is None:
                n_tokens = known = sums = cold = [None] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(3), pa.array(n_tokens, pa.int64()),
                 pa.array(known, pa.int64()), pa.array(sums, pa.float64()), pa.array(scores),
                 pa.array(cold, schema.field("cold").type)], schema=schema)

    return rows.select("doc_id", "held_out", "raw", F.xxhash64("raw").alias("hash")).mapInArrow(
        run, "doc_id long, held_out boolean, hash long, n_tokens long, known long, "
             "hot_sum double, score double, cold array<struct<word:binary,n:long>>")
