"""Token files: canonical length-limited Huffman coding in independent blocks.

Writing: documents are ordered by ``doc_id`` over range shards, encoded to ids,
and kept as an intermediate table; the ids are counted over all documents; the
code lengths (package merge, no code longer than the decoding table) define the
canonical code alone, so a header holds one length per id.  A block
holds consecutive ids of a shard: a bit stream and, for every ``step`` ids, the
bit offset at which they start.  Reading decodes any block alone: all check
points of a block advance together, one table look-up per id.

Files are a folder of two Parquet tables, so Spark writes, commits and reads them on
any store: ``blocks``, whose rows are the blocks, and ``header``, one row with all
that a reader needs.  The header is written last; a folder without it is unfinished.
Nothing but the path is needed to read the ids, in any session.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflife.llm.common import partitions, slices, stored, text_bytes
from shelflife.llm.tokens import encoder
from shelflife.session import scratch_path

STEP = 512          # ids between two check points
BLOCK = 1 << 19     # ids of a block, about
VERSION = 1         # of the file format
HEADER = "version int, step int, end_id long, id_type string, lengths binary, crc long"
BLOCKS = ("shard int, seq long, part int, n_ids long, docs array<long>, sizes array<long>, "
          "points binary, stream binary")


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``limit`` bits; 0 for unused symbols.

    Package merge: each round pairs the cheapest items of the last list and merges
    the pairs with the symbols.  Reading the lists backwards, every symbol among the
    first items needed gets one bit more.  One used symbol gets length 1.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n <= 1:
        lengths[used] = 1
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    is_symbol, items = [np.ones(n, bool)], weights
    for _ in range(limit - 1):
        pairs = items[:len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, pairs])
        rank = np.argsort(both, kind="stable")
        items = both[rank]
        is_symbol.append(rank < n)
    need, bits = 2 * n - 2, np.zeros(n, np.int64)
    for flags in reversed(is_symbol):
        symbols = int(flags[:need].sum())
        bits[:symbols] += 1
        need = 2 * (need - symbols)
    lengths[order] = bits
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes by (length, symbol): the first is 0, the next adds 1 and shifts to its length."""
    codes = np.zeros(len(lengths), np.uint32)
    order = np.flatnonzero(lengths)
    order = order[np.argsort(lengths[order], kind="stable")]
    spans = np.uint64(1) << (np.uint64(32) - lengths[order].astype(np.uint64))
    left = np.cumsum(spans) - spans  # left-aligned in 32 bits
    codes[order] = left >> (np.uint64(32) - lengths[order].astype(np.uint64))
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbol and length for each string of ``width`` bits, ``width`` the longest code."""
    width = max(1, int(lengths.max(initial=0)))
    order = np.flatnonzero(lengths)
    order = order[np.argsort(lengths[order], kind="stable")]
    reps = 1 << (width - lengths[order].astype(np.int64))
    fill = (1 << width) - int(reps.sum())
    symbols = np.append(np.repeat(order, reps), np.zeros(fill, np.int64)).astype(np.uint32)
    sizes = np.append(np.repeat(lengths[order], reps), np.ones(fill, np.uint8))
    return symbols, sizes.astype(np.int64), width


def encode_bits(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray
                ) -> tuple[bytes, np.ndarray]:
    """The bit stream of ``ids`` (big-endian 32-bit words) and its check points."""
    n = lengths[ids].astype(np.int64)
    ends = np.cumsum(n)
    at = ends - n
    total = int(ends[-1]) if len(ids) else 0
    words = np.zeros(total // 32 + 2, np.uint64)
    if len(ids):
        # a code of up to 32 bits lies in the 64 bits that begin at its word
        wide = codes[ids].astype(np.uint64) << (64 - n - (at & 31)).astype(np.uint64)
        word = at >> 5
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        sums = np.add.reduceat(wide, first)  # bits do not overlap, so sums are unions
        words[word[first]] += sums >> np.uint64(32)
        words[word[first] + 1] += sums & np.uint64(0xFFFFFFFF)
    return words.astype(">u4").tobytes(), at[::STEP]


def decode_bits(stream: bytes, points: np.ndarray, n_ids: int,
                table: tuple[np.ndarray, np.ndarray, int], step: int = STEP) -> np.ndarray:
    """All ids of a block; every check point is a lane of the same table walk."""
    symbols, sizes, width = table
    words = np.frombuffer(stream + b"\0" * 8, ">u4").astype(np.uint64)
    pairs = (words[:-1] << np.uint64(32)) | words[1:]
    at = points.astype(np.int64)
    out = np.zeros((step, len(at)), np.uint32)
    shift, mask = 64 - width, (1 << width) - 1
    last = len(pairs) * 32 - 32
    for k in range(min(step, n_ids)):
        bits = (pairs[at >> 5] >> (shift - (at & 31)).astype(np.uint64)).astype(np.int64) & mask
        out[k] = symbols[bits]
        at += sizes[bits]
        if k + 1 >= n_ids - (len(points) - 1) * step:  # the last lane may have ended
            np.minimum(at, last, out=at)
    return out.T.reshape(-1)[:n_ids]


def token_table(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Documents in order, as stored ids: (shard, seq, doc_id, n_tokens, ids).

    Shards are ranges of ``doc_id`` (nulls first) and ``seq`` counts the rows of a
    shard.  Equal ids are told apart by their text's hash, so they may share ranges.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, seq, shard = encoder(tokenizer), 0, TaskContext.get().partitionId()
        for part in slices(batches, "text", 4 << 20):
            ids, ends = enc.encode(part.column(1))
            end = enc.dtype.type(end_id).tobytes()
            own = [ids[a:b].tobytes() + end for a, b in zip(ends, ends[1:])]
            n = len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * n, pa.int32()), pa.array(range(seq, seq + n), pa.int64()),
                 part.column(0), pa.array(np.diff(ends) + 1, pa.int64()), pa.array(own)],
                names=["shard", "seq", "doc_id", "n_tokens", "ids"])
            seq += n

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    spark = docs.sparkSession
    rows = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    ids = rows.mapInArrow(run, "shard int, seq long, doc_id long, n_tokens long, ids binary")
    return stored(ids, "ids")


def id_counts(tokens: DataFrame, dtype: str) -> DataFrame:
    """(id, n) over all documents, added up in each task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for part in slices(batches, "ids"):
            ids = np.frombuffer(b"".join(part.column(0).to_pylist()), dtype)
            n = np.bincount(ids, minlength=len(total))
            n[:len(total)] += total
            total = n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    part = tokens.select("ids").mapInArrow(run, "id long, n long")
    return part.groupBy("id").agg(F.sum("n").alias("n"))


class Header(NamedTuple):
    """What a reader must know: code lengths by id, ids a check point, the id that ends a
    document, and the numpy type of an id as it was encoded."""

    lengths: np.ndarray
    step: int
    end_id: int
    id_type: str

    def crc(self) -> int:
        """Guards all fields: a header that was cut or changed is not decoded with."""
        fields = f"{VERSION},{self.step},{self.end_id},{self.id_type},"
        return zlib.crc32(fields.encode() + self.lengths.tobytes())


def write_header(spark: SparkSession, path: str, header: Header) -> None:
    """One row, as large as the vocabulary."""
    row = (VERSION, header.step, header.end_id, header.id_type,
           bytearray(header.lengths.tobytes()), header.crc())
    spark.createDataFrame([row], HEADER).coalesce(1).write.parquet(f"{path}/header")


def read_header(spark: SparkSession, path: str) -> Header:
    """The header of the files under ``path``; another version, a missing row or a wrong
    check sum is an error."""
    rows = spark.read.schema(HEADER).parquet(f"{path}/header").collect()
    if len(rows) != 1 or rows[0].version != VERSION:
        raise ValueError(f"{path}: no header of format version {VERSION}")
    row = rows[0]
    header = Header(np.frombuffer(bytes(row.lengths), np.uint8), row.step, row.end_id, row.id_type)
    if header.crc() != row.crc:
        raise ValueError(f"{path}: the header's check sum is wrong")
    return header


def write_blocks(tokens: DataFrame, path: str, lengths: np.ndarray, dtype: str,
                 block: int = BLOCK) -> None:
    """Encode the stored ids; one row per block, written under ``path``.

    A block belongs to one shard and names the documents it holds: ``docs`` with the
    ids of each in this block (a document longer than a block goes on in the next).
    """
    bc = tokens.sparkSession.sparkContext.broadcast(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = bc.value
        codes = canonical(lengths)
        schema = pa.schema([("shard", pa.int32()), ("seq", pa.int64()), ("part", pa.int32()),
                            ("n_ids", pa.int64()), ("docs", pa.list_(pa.int64())),
                            ("sizes", pa.list_(pa.int64())), ("points", pa.binary()),
                            ("stream", pa.binary())])
        rows: list[tuple] = []

        def close(shard, seq, part, docs, sizes, pieces):
            ids = np.concatenate(pieces)
            stream, points = encode_bits(ids, lengths, codes)
            rows.append((shard, seq, part, len(ids), docs, sizes,
                         points.astype("<u4").tobytes(), stream))

        def flush():
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows.clear()
            return out

        head, held, following = None, 0, None
        docs, sizes, pieces = [], [], []
        for batch in slices(batches, "ids"):
            for shard, seq, doc, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if head and (shard, seq) != following:
                    close(*head, docs, sizes, pieces)
                    head, held, docs, sizes, pieces = None, 0, [], [], []
                ids, a, part = np.frombuffer(raw, dtype), 0, 0
                while a < len(ids):
                    if head is None:
                        head = (shard, seq, part)
                    take = ids[a:a + block - held]
                    docs.append(doc)
                    sizes.append(len(take))
                    pieces.append(take)
                    a, held, part = a + len(take), held + len(take), part + 1
                    if held >= block:
                        close(*head, docs, sizes, pieces)
                        head, held, docs, sizes, pieces = None, 0, [], [], []
                following = (shard, seq + 1)
            if rows:
                yield flush()
        if head:
            close(*head, docs, sizes, pieces)
        if rows:
            yield flush()

    tokens.select("shard", "seq", "doc_id", "ids").mapInArrow(run, BLOCKS).write.parquet(
        f"{path}/blocks")
    bc.unpersist()


def read_blocks(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """Decode the files under ``path``: one row per piece of a document, (shard, seq, part,
    doc_id, n, ids as u32).

    ``seq`` is the document's number in its shard and ``part`` orders its pieces.  With
    ``digest`` the last column is ``crc``, the crc32 of the ids (u32), instead of them.
    """
    header = read_header(spark, path)
    step, bc = header.step, spark.sparkContext.broadcast(header.lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decode_table(bc.value)
        for row in (r for batch in batches for i in range(batch.num_rows)
                    for r in batch.slice(i, 1).to_pylist()):
            ids = decode_bits(row["stream"], np.frombuffer(row["points"], "<u4"),
                              row["n_ids"], table, step).astype("<u4")
            n = np.array(row["sizes"])
            ends = np.cumsum(n)
            k = len(n)
            own = [ids[b - m:b].tobytes() for b, m in zip(ends, n)]
            last = pa.array(map(zlib.crc32, own), pa.int64()) if digest else pa.array(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["shard"]] * k, pa.int32()),
                 pa.array(range(row["seq"], row["seq"] + k), pa.int64()),
                 pa.array([row["part"]] + [0] * (k - 1), pa.int32()),
                 pa.array(row["docs"], pa.int64()), pa.array(n, pa.int64()), last],
                names=["shard", "seq", "part", "doc_id", "n", "crc" if digest else "ids"])

    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    return blocks.mapInArrow(run, "shard int, seq long, part int, doc_id long, n long, "
                             + ("crc long" if digest else "ids binary"))


def joined_crc(first: int, second: int, n_second: int) -> int:
    """crc32 of two byte strings end to end, from their crc32 and the second's length.

    Appending ``n`` zero bytes is a linear map of the 32 register bits; the map of
    one zero bit squares to two, four, ... and the powers that make up ``8 n`` apply.
    """
    def times(m: list[int], v: int) -> int:
        out = 0
        for col in m:
            if v & 1:
                out ^= col
            v >>= 1
        return out

    power, n = [0xEDB88320] + [1 << i for i in range(31)], 8 * n_second
    while n:
        if n & 1:
            first = times(power, first)
        power = [times(power, col) for col in power]
        n >>= 1
    return first ^ second


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 1, max_bits: int = 20,
                block: int = BLOCK, path: str | None = None) -> str:
    """Write all documents as token files; returns their folder.

    Without ``path`` that is a new one in the shared folder.  The collected counts are
    one row per id of the vocabulary.
    """
    enc, spark = encoder(tokenizer), docs.sparkSession
    path = path or scratch_path(spark, "llm-token-files")
    tokens = token_table(docs, tokenizer, end_id)
    counts = np.zeros(max(enc.tok.get_vocab_size(), end_id + 1), np.int64)
    for row in id_counts(tokens, enc.dtype.str).collect():
        counts[row.id] = row.n
    lengths = code_lengths(counts, max_bits)
    write_blocks(tokens, path, lengths, enc.dtype.str, block)
    write_header(spark, path, Header(lengths, STEP, end_id, enc.dtype.str))
    return path


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files under ``path``: doc_id, start, n_tokens, ids_crc32.

    Null texts are the end token alone; repeated ids follow each other; an empty
    table gives no rows.
    """
    pieces = stored(read_blocks(spark, path, digest=True), "digests")
    # ids before each shard: one row per shard, as many as partitions
    totals = pieces.groupBy("shard").agg(F.sum("n").alias("n")).collect()
    bases, total = [], 0
    for row in sorted(totals, key=lambda r: r.shard):
        bases.append((row.shard, total))
        total += row.n
    base = spark.createDataFrame(bases, "shard int, base long")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by (shard, seq, part); pieces of a document are joined."""
        shard, doc, out = None, None, None

        def batch(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*rows)],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

        for b in batches:
            done = []
            for s, seq, part, i, n, crc, at in zip(*(c.to_pylist() for c in b.columns)):
                if out and (s, seq) == doc:
                    out = [out[0], out[1], out[2] + n, joined_crc(out[3], crc, 4 * n)]
                else:
                    if out:
                        done.append(out)
                    before = out[1] + out[2] if s == shard else at
                    shard, doc, out = s, (s, seq), [i, before, n, crc]
            if done:
                yield batch(done)
        if out:
            yield batch([out])

    ordered = (pieces.join(base, "shard").repartition(partitions(spark), "shard")
               .sortWithinPartitions("shard", "seq", "part")
               .select("shard", "seq", "part", "doc_id", "n", "crc", "base"))
    return ordered.mapInArrow(fold, "doc_id long, start long, n_tokens long, ids_crc32 long")
