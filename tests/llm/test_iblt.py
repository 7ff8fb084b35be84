import hashlib

import numpy as np
import pytest
from edge import ROWS, documents, empty

from shelflife.llm import iblt as I


def random_digests(rng, n):
    return np.unique(I.sealed(rng.integers(0, 1 << 63, n, dtype=np.uint64)))


@pytest.mark.parametrize("n", [0, 1, 5, 60, 700, 5000])
def test_peeling_recovers_the_difference(n):
    rng = np.random.default_rng(n)
    pairs = []
    for _ in range(5):
        a = random_digests(rng, n)
        b = np.unique(np.concatenate([a[:n * 2 // 3], random_digests(rng, n // 3)]))
        c = np.unique(np.concatenate([a[n // 20:], random_digests(rng, n // 30)]))
        pairs += [(a, b), (b, a), (a, c), (a, a), (a, a[:0]), (a, random_digests(rng, 9)),
                  (random_digests(rng, 3), a)]
    made = list(zip(I.fingerprint([a for a, _ in pairs]), I.fingerprint([b for _, b in pairs])))
    read = [tuple(I.Fingerprint.read(str(f)) for f in pair) for pair in made]
    for (a, b), got, again in zip(pairs, I.differences(made), I.differences(read)):
        for here, there in (got, again):
            assert set(here) == set(a) - set(b) and set(there) == set(b) - set(a)


def test_small_sketches_get_stuck_and_the_next_size_peels():
    a = random_digests(np.random.default_rng(1), 200)
    *_, stuck = I.peel(I.sketches([a, a[:2], a[:0]], 32))
    assert stuck.tolist() == [True, False, False]
    for text in (a, a[:7], a[:1], a[:0]):
        f, = I.fingerprint([text])
        size = I.start(len(text))
        while size < f.cells:
            assert I.peel(I.sketches([text], size))[3][0]
            size *= 2
        assert f.n == len(text) and set(I.Fingerprint.read(str(f)).held) == set(text)


def test_folding_gives_the_smaller_sketch():
    a = random_digests(np.random.default_rng(2), 300)
    assert (I.folded(I.sketches([a], 256), 16) == I.sketches([a], 16)).all()


def test_paragraphs_hold_all_words_and_edits_stay_local():
    words = [b"w%d" % i for i in range(300)]
    text = b" ".join(words[:100]) + b"\n" + b"  ".join(words[100:])
    assert b" ".join(I.paragraphs(text)).split() == words
    assert b"".join(I.paragraphs(b"x" * 1000)) == b"x" * 1000
    changed = text.replace(b"w250", b"other")
    a, b = set(I.digests(text).tolist()), set(I.digests(changed).tolist())
    assert 0 < len(a - b) <= 4


def test_repeats_have_digests_of_their_own():
    d = I.digests(b"same line\n" * 50)
    assert len(set(d.tolist())) == len(d) >= 50


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_documents(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = I.fingerprints(documents(spark)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == len(ROWS)
    # ids are unique here but for 2, whose rows are equal, and null, which comes last
    known = sorted([r for r in ROWS if r[0] is not None], key=lambda r: -r[0])
    for i, row in enumerate(known[:-1]):
        text, following = row[1] or "", known[i + 1][1] or ""
        k = len(text) // 3
        edited = text[:len(text) - k] + following[:k]
        shas = {r.edited_sha256 for r in got if r.doc_id == row[0]}
        assert hashlib.sha256(edited.encode()).hexdigest() in shas
    prints = {}
    for r in got:
        text = next(x[1] for x in ROWS if x[0] == r.doc_id) if r.doc_id is not None else None
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if text is not None:
            assert r.n_chars == len(text)
            assert prints.setdefault(text, r.fingerprint) == r.fingerprint
    long = next(r for r in got if r.doc_id == 6)
    assert long.near_edited > 0.6


def test_likeness_is_the_shared_share(spark):
    a, b = b"one two three four five six " * 9, b"one two three four five six " * 5 + b"else " * 9
    x, y = I.digests(a), I.digests(b)
    want = len(set(x) & set(y)) / len(set(x) | set(y))
    f, g, empty_one = I.fingerprint([x, y, x[:0]])
    assert I.likeness([(f, g), (f, f), (empty_one, empty_one), (f, empty_one)]) == pytest.approx(
        [want, 1.0, 1.0, 0.0])


def test_likenesses_follow_from_the_returned_strings(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted(I.fingerprints(docs).collect(), key=lambda r: -r.doc_id)
    own, new = ([I.Fingerprint.read(r[c]) for r in rows] for c in ("fingerprint", "edited_fingerprint"))
    assert I.likeness(list(zip(own, new))) == [r.near_edited for r in rows]
    assert I.likeness(list(zip(own, own[1:] + own[:1]))) == [r.near_next for r in rows]
    # and they are the exact shares of the paragraphs of the texts
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r, following in zip(rows, rows[1:] + rows[:1]):
        text, then = texts[r.doc_id], texts[following.doc_id]
        a, b, c = (set(I.digests(t.encode())) for t in (text, then, I.edited(text, then)))
        assert r.near_next == (len(a & b) / len(a | b) if a | b else 1.0)
        assert r.near_edited == (len(a & c) / len(a | c) if a | c else 1.0)


def test_empty_and_single(spark):
    assert I.fingerprints(empty(spark)).count() == 0
    one = I.fingerprints(documents(spark, ROWS[:1])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
