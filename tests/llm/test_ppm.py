import math
import zlib
from collections import Counter

import numpy as np
import pytest
from edge import ROWS, documents, empty

from shelflife.llm import ppm as P

SF001 = "/root/testdata/sf0.001"


def trie(texts, order):
    keys, n = np.unique(P._gram_keys(texts, order), return_counts=True)
    high = low = (keys >> 9, keys & 511, n)
    for k in range(order - 1, min(order, P.LOW) - 1, -1):
        low = P._summed(low[0] & ((1 << (8 * k)) - 1), low[1])
    return P.Trie(low, high, order)


@pytest.mark.parametrize("order", [1, 2, 3, 4, 5])
def test_model_is_a_distribution(order):
    """The next symbol's probabilities add up to 1, by a plain walk over contexts."""
    texts = [b"the cat sat on the mat", b"the dog", b"on and on and on", b"", b"aaaa"]
    t = trie(texts, order)
    for context in (b"", b"the ", b"on a", b"zzz", b"th", b"aaa"):
        total = 0.0
        for b in [*range(256), P.END]:
            # the score of context + symbol less that of what surrounds the symbol
            if b == P.END:
                total += 10 ** (t.scores([context], None)[0] - prefix(t, context))
            else:
                total += 10 ** (prefix(t, context + bytes([b])) - prefix(t, context))
        assert abs(total - 1) < 1e-4


def prefix(t, text):
    """log10 probability of the bytes alone: marks leave out the end symbol's position."""
    raw, at, begins = P._positions([text], t.order)
    keep = np.ones(len(at), bool)
    keep[-1] = False
    value = t.position_scores(raw, at, P._symbols(raw, at, begins))
    return float(value[keep].sum())


def test_seen_text_scores_better():
    texts = [b"abcabcabc", b"abcabd"]
    t = trie(texts, 3)
    good, bad, odd = t.scores([b"abcabc", b"cbacba", b"\xff\xfe\xfd"], None)
    assert good > bad > odd


@pytest.mark.parametrize("order,contexts,hot", [(5, 1 << 19, 100), (4, 40, 3), (2, 100, 1 << 17)])
def test_scores(spark, order, contexts, hot):
    got = P.score(documents(spark), order, contexts, hot).collect()
    assert len(got) == len(ROWS)
    held = {r[0]: zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 5 == 1 for r in ROWS}
    words = Counter(w for r in ROWS if not held[r[0]]
                    for w in (r[1] or "").encode().lower().split() + [b""])
    n, v = sum(words.values()), len(words)
    for r in got:
        assert r.held_out == held[r.doc_id] and r.train_tokens == n and r.score < 0
        if r.doc_id is None:
            continue
        own = next(x[1] for x in ROWS if x[0] == r.doc_id)
        ws = (own or "").encode().lower().split() + [b""]
        assert (r.n_tokens, r.n_known) == (len(ws), sum(words[w] > 0 for w in ws))
        base = sum(math.log10((words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert r.base_score == pytest.approx(base, rel=1e-9)


def test_shards_score_every_position_once(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(40)
    one = {r.doc_id: r.score for r in P.score(docs, 4).collect()}
    many = {r.doc_id: r.score for r in P.score(docs, 4, 4000).collect()}
    assert one.keys() == many.keys()
    for d in one:
        assert many[d] == pytest.approx(one[d], rel=1e-9)


@pytest.mark.parametrize("order,contexts,flush", [(4, 4000, 1 << 20), (5, 3000, 500)])
def test_scores_do_not_depend_on_the_number_of_shards(spark, monkeypatch, order, contexts, flush):
    monkeypatch.setattr(P, "FLUSH", flush)
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(40)
    one = {r.doc_id: r.score for r in P.score(docs, order).collect()}
    many = {r.doc_id: r.score for r in P.score(docs, order, contexts).collect()}
    assert one.keys() == many.keys()
    off = max(abs(many[d] / one[d] - 1) for d in one)
    assert off < 1e-9, off


def test_empty(spark):
    assert P.score(empty(spark)).count() == 0
    lone = P.score(documents(spark, [ROWS[0]] * 2)).collect()
    assert len(lone) == 2 and len({tuple(r) for r in lone}) == 1
