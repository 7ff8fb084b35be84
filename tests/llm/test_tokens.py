import pathlib
import subprocess
import sys
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from edge import ROWS, documents, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelflife.llm import huffman as H
from shelflife.llm import packing
from shelflife.llm.tokens import Encoder

WORDS = public_tokenizers.path("word_bpe_49k.json")
ROOT = pathlib.Path(__file__).parents[2]
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", "don't stop's a'b 'S x's", "café café ＡＢ", "a\xa0b c\x1cd\x85e",
       "ΣΑΣ Ὀδυσσεύς.", "<|endoftext|>x a<|startoftext|>b <|endof",
       "İstanbul ǅ ß ÀÉ×÷", "≮ ≮ ≠ é", "12345 ½ ٣ x1y2",
       "日本語 テキスト。", "\x00\x01 a\tb  ", " \n", "\U0001f642!!…—“q”", "A" * 3000]


@pytest.fixture(scope="module")
def words():
    return Encoder(WORDS)


def same(enc, texts):
    ids, ends = enc.encode(pa.array([t.encode() for t in texts], pa.binary()))
    for i, t in enumerate(texts):
        assert ids[ends[i]:ends[i + 1]].tolist() == enc.tok.encode(t, add_special_tokens=False).ids


def test_encoder_equals_the_library(words):
    same(words, ODD)
    same(Encoder(BYTES), ODD)
    same(Encoder(WORDS, cache_runs=2), ODD * 2)


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.sampled_from("aBzéÉ×'<|>$! \t\n\xa0́Σ日1½"), max_size=25), max_size=4))
def test_encoder_equals_the_library_on_any_text(words, texts):
    same(words, texts)


def expected(tokenizer, end_id):
    tok = Encoder(tokenizer).tok
    out = defaultdict(list)
    for r in ROWS:
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids + [end_id]
        out[r[0]].append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return out


@pytest.mark.parametrize("block", [50, 1 << 19])
def test_token_files_round_trip(spark, block):
    path = H.token_files(documents(spark), WORDS, end_id=1, block=block)
    got = H.read_digests(spark, path).collect()
    want = expected(WORDS, 1)
    assert len(got) == len(ROWS)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        assert (r.n_tokens, r.ids_crc32) in want[r.doc_id]
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    pieces = H.read_blocks(spark, path).collect()
    assert sum(len(p.ids) // 4 for p in pieces) == at


READER = """
import sys
from shelflife.llm import huffman as H
from shelflife.session import get_session
spark = get_session(master="local[2]")
for r in H.read_digests(spark, sys.argv[1]).collect():
    print(r.doc_id, r.start, r.n_tokens, r.ids_crc32)
"""


def test_another_process_reads_the_files_from_their_path(spark, tmp_path):
    """Nothing is handed over but the path."""
    path = H.token_files(documents(spark), WORDS, end_id=1, path=str(tmp_path / "files"))
    want = sorted(f"{r.doc_id} {r.start} {r.n_tokens} {r.ids_crc32}"
                  for r in H.read_digests(spark, path).collect())
    got = subprocess.run([sys.executable, "-c", READER, path], cwd=ROOT, capture_output=True,
                         text=True, timeout=300, check=True).stdout
    assert sorted(got.splitlines()) == want and len(want) == len(ROWS)


def test_a_header_that_is_not_whole_is_refused(spark, tmp_path):
    path = H.token_files(documents(spark), WORDS, path=str(tmp_path / "files"))
    header = H.read_header(spark, path)
    assert header.end_id == 1 and header.lengths[1] > 0
    other = str(tmp_path / "other")
    row = spark.read.parquet(f"{path}/header").withColumn("end_id", F.lit(7).cast("long"))
    row.write.parquet(f"{other}/header")
    with pytest.raises(ValueError, match="check sum"):
        H.read_blocks(spark, other)
    row.withColumn("version", F.lit(9)).write.parquet(f"{other}2/header")
    with pytest.raises(ValueError, match="version"):
        H.read_blocks(spark, other + "2")


def test_check_points_of_other_steps_are_read_by_the_header():
    ids = np.arange(700, dtype=np.uint16) % 9
    lengths = H.code_lengths(np.bincount(ids), 8)
    stream, _ = H.encode_bits(ids, lengths, H.canonical(lengths))
    points = np.cumsum(np.append(0, lengths[ids].astype(np.int64)))[:-1:100]
    assert (H.decode_bits(stream, points, 700, H.decode_table(lengths), step=100) == ids).all()


def test_token_files_of_an_empty_table(spark):
    assert H.read_digests(spark, H.token_files(empty(spark), WORDS)).count() == 0


@settings(max_examples=60, deadline=None)
@given(counts=st.lists(st.integers(0, 10 ** 6), min_size=1, max_size=80), limit=st.integers(7, 20))
def test_code_lengths_are_an_optimal_limited_prefix_code(counts, limit):
    import heapq
    counts = np.array(counts)
    lengths = H.code_lengths(counts, limit)
    used = np.flatnonzero(counts)
    assert (lengths[counts == 0] == 0).all() and lengths.max(initial=0) <= limit
    if len(used) > 1:
        assert sum(2.0 ** -int(n) for n in lengths[used]) == 1.0
        heap = [(int(c), 0) for c in counts[used]]
        heapq.heapify(heap)
        cost = 0
        while len(heap) > 1:
            a, b = heapq.heappop(heap)[0], heapq.heappop(heap)[0]
            cost += a + b
            heapq.heappush(heap, (a + b, 0))
        own = int((counts * lengths).sum())
        assert own >= cost and (limit < 20 or own == cost)


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000])
def test_bits_round_trip(n):
    rng = np.random.default_rng(n)
    counts = np.bincount(rng.zipf(1.4, 3000) % 400, minlength=400)
    lengths = H.code_lengths(counts, 12)
    ids = rng.choice(np.flatnonzero(counts), n).astype(np.uint16)
    stream, points = H.encode_bits(ids, lengths, H.canonical(lengths))
    assert (H.decode_bits(stream, points, n, H.decode_table(lengths)) == ids).all()


def test_joined_crc():
    a, b = b"some bytes", b"and more of them" * 50
    assert H.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@pytest.mark.parametrize("capacity,n_open", [(2048, 4096), (8, 2)])
def test_packing_is_gapless_and_whole(spark, capacity, n_open):
    got = packing.pack(documents(spark), WORDS, 0, capacity, n_open, with_ids=True).collect()
    want = expected(WORDS, 0)
    sequences, lengths = defaultdict(list), defaultdict(int)
    for r in got:
        assert 0 < r.length <= capacity
        assert r.ids_crc32 == zlib.crc32(bytes(r.ids)) and len(r.ids) == 4 * r.length
        assert r.start == r.piece * capacity
        sequences[r.sequence_id].append((r.offset, r.length))
        lengths[r.doc_id] += r.length
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    assert lengths == {d: sum(n for n, _ in v) for d, v in want.items()}
    assert packing.pack(empty(spark), WORDS).count() == 0


def test_best_fit_and_closing():
    bins = packing.OpenBins(10, 2)
    assert bins.place(6) == (0, 0) and bins.place(7) == (1, 0)
    assert bins.place(3) == (1, 7)          # the tighter of the two
    assert bins.place(8) == (2, 0)          # two are open: 0 (room 4) and 2 (room 2)
    assert bins.place(9) == (3, 0)          # the fullest, 2, closes
    assert bins.place(2) == (0, 6)
    assert bins.place(10) == (4, 0)


@settings(max_examples=40, deadline=None)
@given(lengths=st.lists(st.integers(1, 64), max_size=300), n_open=st.integers(1, 70))
def test_bins_never_overflow(lengths, n_open):
    bins, fill = packing.OpenBins(64, n_open), defaultdict(int)
    for n in lengths:
        b, offset = bins.place(n)
        assert offset == fill[b] and offset + n <= 64
        fill[b] += n
        assert bins.n <= n_open
