"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a text in both directions, labels every byte
with a language distribution, and a document's probabilities are the mean over all
its bytes.  It is trained in numpy by backpropagation through time on windows of a
bounded sample of labelled documents; its size does not depend on the data.  Texts
are cut into windows whose states start anew, so thousands of windows advance
together, and no byte is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflife.llm.common import key_crc, slices, text_bytes

HIDDEN = 16
WINDOW = 128            # bytes that are read in one go
PAD = 256               # stands after the end of a text; leaves the state as it is
SAMPLE_ROWS = 512       # labelled documents a language, about
SAMPLE_CHARS = 512      # of each, from a hashed position
TRAIN_WINDOW, BATCH, STEPS, RATE = 64, 128, 240, 0.01


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters: per direction ``wx`` (byte to gates) and ``u`` (state to gates), then
    ``wo`` and ``bo`` (both states to languages).  Gates stand in the order z, r, n."""

    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.langs, self.h = langs, hidden
        g = 3 * hidden
        self.p = {}
        for d in "fb":
            self.p["wx" + d] = rng.normal(0, 0.3, (PAD + 1, g)).astype(np.float32)
            self.p["u" + d] = rng.normal(0, hidden ** -0.5, (hidden, g)).astype(np.float32)
            self.p["wx" + d][PAD] = 0
            self.p["wx" + d][PAD, :hidden] = 30  # z is 1: the state stays
        self.p["wo"] = rng.normal(0, 0.3, (2 * hidden, len(langs))).astype(np.float32)
        self.p["bo"] = np.zeros(len(langs), np.float32)

    # ---- training ------------------------------------------------------------------

    def _run(self, x: np.ndarray, d: str) -> list[tuple]:
        """States before and after each byte, with the gates; ``x`` is (batch, time)."""
        h, k = np.zeros((len(x), self.h), np.float32), self.h
        steps = []
        wx, u = self.p["wx" + d], self.p["u" + d]
        for t in range(x.shape[1]):
            a, b = wx[x[:, t]], h @ u
            z, r = _sigmoid(a[:, :k] + b[:, :k]), _sigmoid(a[:, k:2 * k] + b[:, k:2 * k])
            m = b[:, 2 * k:]
            n = np.tanh(a[:, 2 * k:] + r * m)
            new = z * h + (1 - z) * n
            steps.append((h, z, r, m, n, new))
            h = new
        return steps

    def _back(self, x: np.ndarray, d: str, steps: list[tuple], dout: np.ndarray) -> dict:
        """Gradients of one direction; ``dout`` is (time, batch, hidden)."""
        u = self.p["u" + d]
        du, dh = np.zeros_like(u), np.zeros_like(steps[0][0])
        das = np.empty((len(steps), len(x), 3 * self.h), np.float32)
        for t in range(len(steps) - 1, -1, -1):
            h, z, r, m, n, _ = steps[t]
            dh = dh + dout[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * m * r * (1 - r)
            das[t] = np.concatenate([dz, dr, dn], axis=1)
            db = np.concatenate([dz, dr, dn * r], axis=1)
            du += h.T @ db
            dh = dh * z + db @ u.T
        hot = np.zeros((PAD + 1, x.size), np.float32)
        hot[x.T.reshape(-1), np.arange(x.size)] = 1
        dwx = hot @ das.reshape(-1, das.shape[2])
        dwx[PAD] = 0
        return {"wx" + d: dwx, "u" + d: du}

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean cross-entropy over all bytes, and its gradients."""
        back = x[:, ::-1]
        f, b = self._run(x, "f"), self._run(back, "b")
        states = np.concatenate([np.stack([s[5] for s in f]),
                                 np.stack([s[5] for s in b])[::-1]], axis=2)
        logits = states @ self.p["wo"] + self.p["bo"]
        logits -= logits.max(axis=2, keepdims=True)
        prob = np.exp(logits)
        prob /= prob.sum(axis=2, keepdims=True)
        rows = np.arange(len(y))
        real = (x.T != PAD)
        n = max(1, real.sum())
        loss = -np.log(prob[:, rows, y] + 1e-9)[real].sum() / n
        prob[:, rows, y] -= 1
        prob *= (real / n)[:, :, None]
        ds = (prob @ self.p["wo"].T).astype(np.float32)
        out = {"wo": np.tensordot(states, prob, ([0, 1], [0, 1])), "bo": prob.sum(axis=(0, 1))}
        out |= self._back(x, "f", f, ds[:, :, :self.h])
        out |= self._back(back, "b", b, ds[::-1, :, self.h:])
        return float(loss), out

    def train(self, texts: list[bytes], labels: list[int], steps: int = STEPS) -> "Network":
        """Adam over random windows, as many from each language."""
        rng = np.random.default_rng(1)
        by = [[t for t, y in zip(texts, labels) if y == k and t] for k in range(len(self.langs))]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        for step in range(1, steps + 1):
            x = np.full((BATCH, TRAIN_WINDOW), PAD)
            y = rng.integers(0, len(self.langs), BATCH)
            for i, k in enumerate(y):
                if by[k]:
                    text = by[k][rng.integers(len(by[k]))]
                    a = rng.integers(max(1, len(text) - TRAIN_WINDOW + 1))
                    own = np.frombuffer(text[a:a + TRAIN_WINDOW], np.uint8)
                    x[i, :len(own)] = own
            _, grads = self.gradients(x, y)
            rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, g in grads.items():
                g = np.clip(g, -1, 1)
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.01 * (g * g - v[k])
                self.p[k] -= (rate * (m[k] / (1 - 0.9 ** step))
                              / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
        return self

    # ---- prediction ----------------------------------------------------------------

    def _sweep(self, x: np.ndarray, d: str, logits: np.ndarray) -> None:
        """Run one direction over windows (time, batch), adding each state's part to
        ``logits`` (time, language, batch).  One contiguous array per gate."""
        k, n = self.h, x.shape[1]
        wx, u = self.p["wx" + d], self.p["u" + d]
        # sigmoid(a) = (1 + tanh(a / 2)) / 2, the inner half goes into the weights
        wz, wr, wn = (np.ascontiguousarray(wx[:, i * k:(i + 1) * k] * f)
                      for i, f in enumerate((0.5, 0.5, 1)))
        uz, ur, un = (np.ascontiguousarray(u[:, i * k:(i + 1) * k] * f)
                      for i, f in enumerate((0.5, 0.5, 1)))
        wo = np.ascontiguousarray((self.p["wo"][:k] if d == "f" else self.p["wo"][k:]).T)
        h, a, b, c = (np.zeros((n, k), np.float32) for _ in range(4))
        part = np.empty((len(self.langs), n), np.float32)
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            np.take(wr, x[t], axis=0, out=a, mode="clip")
            a += np.matmul(h, ur, out=b)
            np.tanh(a, out=a)
            a += 1                                  # 2 r
            np.matmul(h, un, out=b)
            b *= a
            b *= 0.5
            b += np.take(wn, x[t], axis=0, out=a, mode="clip")
            np.tanh(b, out=b)                       # n
            np.take(wz, x[t], axis=0, out=a, mode="clip")
            a += np.matmul(h, uz, out=c)
            np.tanh(a, out=a)
            a += 1                                  # 2 z
            h -= b                                  # h = n + z (h - n)
            h *= a
            h *= 0.5
            h += b
            logits[t] += np.matmul(wo, h.T, out=part)

    def window_probs(self, x: np.ndarray) -> np.ndarray:
        """Sum over the bytes of each window (time, batch) of the language distributions."""
        logits = np.zeros((len(x), len(self.langs), x.shape[1]), np.float32)
        logits += self.p["bo"][:, None]
        self._sweep(x, "f", logits)
        self._sweep(x, "b", logits)
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        scale = np.where(x == PAD, 0, 1 / logits.sum(axis=1))
        return np.einsum("tln,tn->nl", logits, scale)

    def predict(self, texts: list[bytes], rows: int = 1024) -> np.ndarray:
        """Pooled probabilities (texts, languages); zeros for an empty text."""
        sizes = np.array([len(t) for t in texts], np.int64)
        n_win = -(-sizes // WINDOW)
        owner = np.repeat(np.arange(len(texts)), n_win)
        base = np.cumsum(sizes) - sizes
        first = np.cumsum(n_win) - n_win
        starts = base[owner] + (np.arange(len(owner)) - first[owner]) * WINDOW
        ends = (base + sizes)[owner]
        raw = np.frombuffer(b"".join(texts) + b"\0" * WINDOW, np.uint8)
        out = np.zeros((len(texts), len(self.langs)))
        for a in range(0, len(owner), rows):
            at = np.arange(WINDOW)[:, None] + starts[None, a:a + rows]
            x = raw[at].astype(np.int64)
            x[at >= ends[None, a:a + rows]] = PAD
            np.add.at(out, owner[a:a + rows], self.window_probs(x))
        return out / np.maximum(sizes, 1)[:, None]


def held_out(col: str = "doc_id") -> Column:
    return key_crc(col) % 4 == 2


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Network | None:
    """Train on about ``sample_rows`` distinct labelled texts of each language, held-out ones apart.

    The share of a language is set from its count of distinct texts; which of them are
    drawn, and which SAMPLE_CHARS of each, follows from a hash of the text, so copies
    count once.  None if nothing is labelled.
    """
    known = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # copies are folded before the shuffle, and only hashes go through it
    key = F.xxhash64("text")
    distinct = known.select("lang", key.alias("key")).distinct()
    counts = {r["lang"]: r["count"] for r in distinct.groupBy("lang").count().collect()}
    if not counts:
        return None
    langs = sorted(counts)
    share = F.create_map(*[F.lit(x) for k in langs
                           for x in (k, min(1.0, sample_rows / counts[k]))])
    h = F.pmod(key, F.lit(1 << 30))
    start = 1 + F.pmod(F.xxhash64("text", F.lit(1)),
                       F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1)
    sample = known.filter(h < share[F.col("lang")] * (1 << 30)).select(
        "lang", key.alias("key"),
        F.substring("text", start.cast("int"), F.lit(SAMPLE_CHARS)).alias("part"))
    # about sample_rows a language by the share, and no more than four times that by hash order
    drawn: dict[str, list] = {k: [] for k in langs}
    for r in sample.distinct().collect():
        drawn[r["lang"]].append((r["key"] % (1 << 30), r["key"], r["part"]))
    rows = sorted((k, part) for k in langs for _, _, part in sorted(drawn[k])[:4 * sample_rows])
    number = {k: i for i, k in enumerate(langs)}
    net = Network(langs)
    if len(langs) > 1:
        net.train([p.encode() for _, p in rows], [number[k] for k, _ in rows])
    return net


def predict(docs: DataFrame, net: Network | None, columns: list) -> DataFrame:
    """(rec, lang_pred, score): ``columns`` of each document, its language and probability.

    ``und`` with score 0 for texts that are null, empty or without a letter, and for
    every text when no language was learned.
    """
    rows = docs.select(text_bytes().alias("raw"), F.struct(*columns).alias("rec"),
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    schema = rows.select("rec", F.lit("").alias("lang_pred"),
                         F.lit(0.0).alias("score")).schema
    bc = docs.sparkSession.sparkContext.broadcast((net.langs, net.h, net.p) if net else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = None
        if bc.value:
            net = Network(*bc.value[:2])
            net.p = bc.value[2]
        for part in slices(batches, "raw", 4 << 20):
            texts = [t if ok else b"" for t, ok in zip(part.column(0).to_pylist(),
                                                       part.column(2).to_pylist())]
            if net is None:
                lang, score = ["und"] * len(texts), [0.0] * len(texts)
            else:
                prob = net.predict(texts)
                best = prob.argmax(axis=1)
                lang = [net.langs[b] if t else "und" for b, t in zip(best, texts)]
                score = np.clip(prob[np.arange(len(texts)), best], 0, 1)
            yield pa.RecordBatch.from_arrays(
                [part.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=["rec", "lang_pred", "score"])

    return rows.mapInArrow(run, schema)


def languages(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    A null ``doc_id`` has the crc32 of the empty text; repeated rows are predicted
    each; an empty table gives no rows.
    """
    out = predict(docs, fit(docs), [F.col("doc_id"), held_out().alias("held_out")])
    return out.select("rec.doc_id", "rec.held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents that get a language, all their columns; ``und`` ones go.

    When no language was learned, only texts that are null or have no letter go.
    """
    net = fit(docs)
    if net is None:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    out = predict(docs, net, ["*"])
    return out.filter(F.col("lang_pred") != "und").select("rec.*")
