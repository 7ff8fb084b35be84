"""Exact duplicates by Grace hashing.

1. Each task folds its own rows first: an open-addressing table of bounded size
   merges equal texts into partial groups (a content, the ids that had it, the
   best of them).  A group of copies, however large, leaves a task as few rows.
2. The partial groups are partitioned by a hash of the content into buckets, which
   are spill files: tables in the shared folder.  Buckets whose distinct contents
   do not fit the table are partitioned again, finer, until each fits.
3. Each bucket is folded by one open-addressing table, which compares complete
   contents; copies stream through and only distinct contents are held.

Equal means identical after deleting white space.  Of equal texts the row with the
most code points stays, then the smallest ``doc_id`` (null last), then the first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflife.llm.common import SPACE, partitions, slices, stored

TABLE_BYTES = 32 << 20   # distinct content that one table holds
TABLE_ROWS = 1 << 18     # rows whose ids a task gathers before it hands its groups on
FAN_OUT = 16             # parts of a bucket that does not fit


def strip_space(text: bytes) -> bytes:
    return text.translate(None, SPACE.encode())


class OpenTable:
    """Open addressing with linear probing over complete contents.

    ``find`` returns the entry's number, adding one for a new content.  The slots
    hold entry numbers; they double when half of them are taken.
    """

    def __init__(self):
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def find(self, h: int, content: bytes) -> int:
        mask = len(self.slots) - 1
        at = h & mask
        while (e := self.slots[at]) >= 0:
            if self.hashes[e] == h and self.contents[e] == content:
                return e
            at = (at + 1) & mask
        self.slots[at] = e = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        self.bytes += len(content) + 64
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return e

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for e, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = e


def _rank(n_chars: int, doc_id: int | None) -> tuple:
    return (-n_chars, doc_id is None, doc_id or 0)


def _partial_groups(rows: DataFrame, table_bytes: int) -> DataFrame:
    """(rec) -> (hash, sha, n_bytes, ids, rank_chars, best_id, best_at, rec), one per content and fold."""
    rec = rows.schema["rec"]
    schema = T.StructType([
        T.StructField("hash", T.LongType()), T.StructField("sha", T.StringType()),
        T.StructField("n_bytes", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType())),
        T.StructField("best_chars", T.LongType()), T.StructField("best_id", T.LongType()),
        T.StructField("best_at", T.IntegerType()), rec])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, groups, n = OpenTable(), [], 0
        rec_type = None

        def emit():
            cols = zip(*(g[1:] for g in groups))
            types = [pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int64(),
                     pa.int64(), pa.int32(), rec_type]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)],
                names=["hash", "sha", "n_bytes", "ids", "best_chars", "best_id", "best_at", "rec"])

        for part in slices(batches, "raw"):
            rec_type = part.schema.field("rec").type
            for raw, doc, r in zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                                   part.column(2).to_pylist()):
                content = strip_space(raw)
                digest = hashlib.sha256(content).digest()
                e = table.find(int.from_bytes(digest[:8], "little", signed=True), content)
                n_chars = len(raw.decode())
                rank = _rank(n_chars, doc)
                if e == len(groups):
                    groups.append([rank, table.hashes[e], digest.hex(), len(content), [doc],
                                   n_chars, doc, 0, r])
                else:
                    g = groups[e]
                    if rank < g[0]:
                        g[0], g[5:] = rank, [n_chars, doc, len(g[4]), r]
                    g[4].append(doc)
                n += 1
                if table.bytes > table_bytes or n >= TABLE_ROWS:
                    yield emit()
                    table, groups, n = OpenTable(), [], 0
        if groups:
            yield emit()

    return rows.select("raw", "doc_id", "rec").mapInArrow(run, schema)


def _buckets(partials: DataFrame, table_bytes: int) -> DataFrame:
    """Partition the partial groups into buckets that fit a table: adds (level, bucket)."""
    spark = partials.sparkSession
    total = partials.agg(F.sum("n_bytes")).first()[0] or 0
    # several buckets a task, so that tasks hold about as much as each other
    n, level, done, rest = max(partitions(spark, 8), 4 * total // table_bytes), 0, [], partials
    while True:
        rest = rest.withColumn("level", F.lit(level)).withColumn(
            "bucket", F.pmod("hash", F.lit(n * FAN_OUT ** level)))
        sizes = (rest.groupBy("bucket", "hash").agg(F.max("n_bytes").alias("n"))
                 .groupBy("bucket").agg(F.sum(F.col("n") + 64).alias("size"),
                                        F.count("*").alias("n_hashes")))
        # a single content always counts as fitting: it is held once
        over = stored(sizes.filter((F.col("size") > table_bytes) & (F.col("n_hashes") > 1)), "over")
        if over.isEmpty():
            done.append(rest)
            return reduce(DataFrame.unionByName, done)
        done.append(rest.join(over, "bucket", "left_anti").select(rest.columns))
        rest = stored(rest.join(over, "bucket", "left_semi").select(partials.columns),
                      f"spill-{level + 1}")
        level += 1


def _folded(bucketed: DataFrame, keep_rec: bool) -> DataFrame:
    """Fold each bucket; pair rows (class_id, ids, at) and class rows (class_id, keep_id, ...).

    ``class_id`` is unique over the table: (task-independent) bucket, level and a
    running number.  With ``keep_rec`` only class rows come out, with the row that stays.
    """
    rec = bucketed.schema["rec"]
    fields = "level int, bucket long, class int, part int, ids array<long>, sha string, " \
             "keep_id long, keep_part int, keep_at int, group_size long"
    schema = T.StructType([*T._parse_datatype_string(fields).fields, *([rec] if keep_rec else [])])
    n_fields = 10

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.string(),
                 pa.int64(), pa.int32(), pa.int32(), pa.int64()]
        here, table, classes = None, None, []
        names = [f.name for f in schema.fields]

        def emit(rows, rec_type):
            t = types + ([rec_type] if keep_rec else [])
            return pa.RecordBatch.from_arrays(
                [pa.array(c, x) for c, x in zip(zip(*rows), t)], names=names)

        def closed():
            return [(*here, i, None, None, c[1], c[2], c[3], c[4], c[5], *c[6:])
                    for i, c in enumerate(classes)]

        for batch in slices(batches, "raw"):
            rec_type = batch.schema.field("rec").type
            out = []
            for row in batch.to_pylist():
                if (row["level"], row["bucket"]) != here:
                    if here:
                        out += closed()
                    here, table, classes, part = (row["level"], row["bucket"]), OpenTable(), [], 0
                e = table.find(row["hash"], strip_space(row["raw"]))
                rank = (*_rank(row["best_chars"], row["best_id"]), part)
                best = [row["best_id"], part, row["best_at"]]
                kept = [row["rec"]] if keep_rec else []
                if e == len(classes):
                    classes.append([rank, row["sha"], *best, len(row["ids"]), *kept])
                else:
                    c = classes[e]
                    c[5] += len(row["ids"])
                    if rank < c[0]:
                        c[0], c[2:5] = rank, best
                        c[6:] = kept
                if not keep_rec:
                    out.append((*here, e, part, row["ids"], row["sha"], None, None, None, None))
                part += 1
            if out:
                yield emit(out, rec_type)
        if here:
            yield emit(closed(), rec_type)

    cols = ["level", "bucket", "hash", "sha", "best_chars", "best_id", "best_at", "ids",
            F.coalesce("rec.text", F.lit("")).cast("binary").alias("raw"), "rec"]
    dealt = (bucketed.repartition(partitions(bucketed.sparkSession), "level", "bucket")
             .sortWithinPartitions("level", "bucket"))
    assert len(fields.split(",")) == n_fields
    return dealt.select(*cols).mapInArrow(run, schema)


def _bucketed(docs: DataFrame, columns: list[str], table_bytes: int) -> DataFrame:
    rows = docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("raw"),
                       F.col("doc_id").cast("long").alias("doc_id"),
                       F.struct(*columns).alias("rec"))
    return _buckets(stored(_partial_groups(rows, table_bytes), "spill-0"), table_bytes)


def exact_groups(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty.  Repeated rows are copies of each other: exactly one
    row of a group is kept, even where ids repeat.  A null ``doc_id`` stays null and
    is kept only if its group has no other id.  An empty table gives no rows.
    """
    folded = stored(_folded(_bucketed(docs, ["text"], table_bytes), keep_rec=False), "groups")
    key = ["level", "bucket", "class"]
    classes = folded.filter("group_size is not null").select(
        *key, "keep_id", "keep_part", "keep_at", "group_size")
    pairs = folded.filter("ids is not null").select(*key, "part", "ids", "sha")
    each = pairs.join(classes, key).select(
        F.posexplode("ids").alias("at", "doc_id"), "part", "sha", "keep_id", "keep_part", "keep_at",
        "group_size")
    kept = (F.col("part") == F.col("keep_part")) & (F.col("at") == F.col("keep_at"))
    return each.select("doc_id", "keep_id", "group_size", kept.alias("kept"),
                       F.col("sha").alias("text_sha256"))


def drop_exact(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows that stay, with all their columns."""
    return _folded(_bucketed(docs, docs.columns, table_bytes), keep_rec=True).select("rec.*")
