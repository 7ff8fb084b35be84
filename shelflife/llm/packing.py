"""Best-fit packing: token sequences of whole documents into windows of fixed length.

Each task packs the documents of its split in arrival order: bounded-space online
best fit.  A fixed number of bins is open; a bitset keyed by free space finds the
open bin with the least room that still takes a piece, and when all places are
taken the fullest open bin closes first.  State per task is the open bins alone,
no row leaves its split, so nothing is shuffled and a lost task repeats itself.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflife.llm.common import slices, text_bytes
from shelflife.llm.tokens import encoder


class OpenBins:
    """At most ``n_open`` bins below ``capacity``; :meth:`place` returns (bin, offset).

    ``free[r]`` lists the open bins with ``r`` units of room and bit ``r`` of
    ``rooms`` tells that the list is not empty, so the best fit is the lowest set
    bit at or above the length.  Ties go to the bin that got its room last.
    """

    def __init__(self, capacity: int, n_open: int):
        if capacity < 1 or n_open < 1:
            raise ValueError("capacity and n_open must be at least 1")
        self.capacity, self.n_open = capacity, n_open
        self.free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.rooms = 0
        self.n = self.next = 0

    def _take(self, room: int) -> int:
        bins = self.free[room]
        got = bins.pop()
        if not bins:
            self.rooms &= ~(1 << room)
        self.n -= 1
        return got

    def place(self, length: int) -> tuple[int, int]:
        fits = self.rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            got = self._take(room)
        else:
            if self.n >= self.n_open:  # no place left: the fullest closes
                self._take((self.rooms & -self.rooms).bit_length() - 1)
            room, got = self.capacity, self.next
            self.next += 1
        if room > length:
            self.free[room - length].append(got)
            self.rooms |= 1 << (room - length)
            self.n += 1
        return got, self.capacity - room


OUT = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                 ("length", pa.int64()), ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()),
                 ("offset", pa.int64())])
OUT_DDL = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
           "sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048,
         n_open: int = 4096, with_ids: bool = False) -> DataFrame:
    """One row per piece of a document: where its tokens lie in which sequence.

    A document is its ids plus ``end_id``; only one longer than ``capacity`` is cut,
    into full pieces and a rest.  ``sequence_id`` is unique over the whole table and
    pieces fill a sequence from offset 0 without gaps.  Null and empty texts are one
    end token; repeated rows are packed each; null ``doc_id`` stays null; an empty
    table gives no rows.  ``with_ids`` adds the ids themselves (binary, u32).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, bins = encoder(tokenizer), OpenBins(capacity, n_open)
        task = TaskContext.get()
        base = (task.partitionId() if task else 0) << 40
        for part in slices(batches, "text", 4 << 20):
            ids, ends = enc.encode(part.column(1))
            out: list[list] = [[] for _ in range(7 + with_ids)]
            for i, doc in enumerate(part.column(0).to_pylist()):
                own = np.append(ids[ends[i]:ends[i + 1]], end_id).astype("<u4")
                for piece, a in enumerate(range(0, len(own), capacity)):
                    raw = own[a:a + capacity].tobytes()
                    length = len(raw) // 4
                    seq, offset = bins.place(length)
                    row = (doc, piece, a, length, zlib.crc32(raw), base + seq, offset)
                    for col, v in zip(out, (*row, raw) if with_ids else row):
                        col.append(v)
            schema = OUT.append(pa.field("ids", pa.binary())) if with_ids else OUT
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text"))
    return rows.mapInArrow(run, OUT_DDL + (", ids binary" if with_ids else ""))
