"""Merkle manifest of a dataset by incremental witnesses.

Every row is a leaf.  The leaves of a key (a source) ascend by their order column and
form a tree of ``ARITY`` children a node; the keys' roots, in key order, form the tree
above.  The witness of a leaf is, level by level, the other members of its run.

Leaves are appended one after the other to a :class:`Frontier`.  It holds the open run
of each level, and attached to each node of an open run the partial witnesses of what
lies below it.  When the last sibling of a run arrives, the run becomes its hash one
level up and all witnesses attached to it are extended by their siblings.  The members
of a lowest run share all that lies above it, so they are one witness record.

Appending is distributed by aligned blocks: a block of ``ARITY ** HEIGHT`` leaves is
closed by one task, whatever else the key holds, and its root is a further append to
the next tree of blocks; the witness of a block is found in the same way and extends
those inside it.  A key with a third of all rows is as many blocks as its rows ask for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelflife.llm.common import partitions, stored

ARITY = 16
HEIGHT = 3      # levels that one block closes: blocks of 16 ** 3 leaves

#: One level of a witness: how many siblings stand to the left, and all siblings' digests.
STEP = "struct<at:int,others:binary>"
WITNESS = f"array<{STEP}>"


def field(c: str | Column) -> Column:
    """A value as text that no other value gives: ``-`` for null, else its length in bytes,
    a colon and itself."""
    v = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v))


def leaf(*columns: Column) -> Column:
    """The digest of a row's fields, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*columns).cast("binary"), 256))


def node(children: bytes) -> bytes:
    """The digest of some digests end to end: of their text in lowercase hex."""
    return hashlib.sha256(children.hex().encode()).digest()


def step_up(digest: bytes, at: int, others: bytes) -> bytes:
    """The parent of ``digest`` with its siblings."""
    return node(others[:32 * at] + digest + others[32 * at:])


class Frontier:
    """An append-only tree: the open run of every level and the witnesses attached to it.

    A node of an open run is (digest, records); a record is [members, digests, witness]:
    a closed lowest run and the witness that it has so far.
    """

    def __init__(self, arity: int = ARITY):
        self.arity = arity
        self.runs: list[list] = [[]]

    def append(self, digest: bytes, member) -> None:
        self.runs[0].append((digest, member))
        level = 0
        while len(self.runs[level]) == self.arity:
            self._close(level)
            level += 1

    def _close(self, level: int) -> None:
        """The run of a level becomes one node of the level above."""
        run, self.runs[level] = self.runs[level], []
        digests = b"".join(d for d, _ in run)
        if level == 0:
            records = [[[m for _, m in run], digests, []]]
        else:
            records = []
            for at, (_, below) in enumerate(run):
                others = digests[:32 * at] + digests[32 * at + 32:]
                for r in below:
                    r[2].append((at, others))
                records += below
        if level + 1 == len(self.runs):
            self.runs.append([])
        self.runs[level + 1].append((node(digests), records))

    def finish(self, height: int | None = None) -> tuple[bytes, list]:
        """Close what is open and return the root and all records.

        With a ``height``, exactly so many levels (the block is one of several); without,
        as many as it takes to one node, none for a lone leaf.
        """
        level = 0
        while level != height and not (height is None and self._single(level)):
            if self.runs[level]:
                self._close(level)
            level += 1
        (digest, records), = self.runs[level]
        if level == 0:
            records = [[[records], digest, None]]     # a lone leaf: no level above it
        return digest, records

    def _single(self, level: int) -> bool:
        return len(self.runs[level]) == 1 and not any(self.runs[level + 1:])


# ---- blocks ----------------------------------------------------------------------

MEMBER = "struct<id:bigint,other:binary>"
BLOCK = (f"tree binary, block long, members array<{MEMBER}>, digests binary, witness {WITNESS}, "
         "alone boolean, root binary")


def _append_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (tree, block, many, member, digest), sorted inside each block, to one row a
    lowest run, and one a block with its root."""
    types = [pa.binary(), pa.int64(), pa.list_(pa.struct([("id", pa.int64()), ("other", pa.binary())])),
             pa.binary(), pa.list_(pa.struct([("at", pa.int32()), ("others", pa.binary())])),
             pa.bool_(), pa.binary()]
    names = ["tree", "block", "members", "digests", "witness", "alone", "root"]
    here, many, open_tree = None, False, None
    out: list = []

    def close():
        root, records = open_tree.finish(HEIGHT if many else None)
        for members, digests, witness in records:
            steps = [{"at": a, "others": o} for a, o in witness or []]
            out.append((*here, members, digests, steps, witness is None, None))
        out.append((*here, None, None, None, None, root))

    def emit():
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
        out.clear()
        return batch

    for batch in batches:
        for tree, block, more, member, digest in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if (tree, block) != here:
                if here is not None:
                    close()
                here, many, open_tree = (tree, block), more, Frontier()
                if len(out) > 2000:
                    yield emit()
            open_tree.append(digest, member)
    if here is not None:
        close()
    if out:
        yield emit()


def _close_blocks(nodes: DataFrame, tag: str) -> DataFrame:
    """Append (tree, total, pos, member, digest) by aligned blocks; see ``BLOCK``."""
    size = ARITY ** HEIGHT
    rows = nodes.select("tree", F.expr(f"pos div {size}").alias("block"),
                        (F.col("total") > size).alias("many"), "member", "digest", "pos")
    dealt = (rows.repartition(partitions(nodes.sparkSession), "tree", "block")
             .sortWithinPartitions("tree", "block", "pos"))
    return stored(dealt.mapInArrow(_append_blocks, BLOCK), tag)


def _no_steps() -> Column:
    return F.array().cast(WITNESS)


def _above(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tree, block, above): the witness of each block's root inside its tree; (tree, root).

    Block roots are further appends: each turn has 4096 times fewer of them."""
    tops = blocks.where("root is not null").select("tree", "block", "root")
    n = tops.groupBy("tree").agg(F.count("*").alias("total"))
    lone = tops.join(n.where("total = 1"), "tree")
    above, roots = lone.select("tree", "block", _no_steps().alias("above")), lone.select("tree", "root")
    more = n.where("total > 1")
    if not more.isEmpty():
        w, r = _node_witnesses(tops.join(more, "tree").select("tree", "total", F.col("block").alias("pos"),
                                                              F.col("root").alias("digest")))
        above = above.unionByName(w.select("tree", F.col("pos").alias("block"), F.col("witness").alias("above")))
        roots = roots.unionByName(r)
    return above, roots


def _node_witnesses(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tree, pos, witness) and (tree, root) of whole trees of (tree, total, pos, digest)."""
    member = F.struct(F.col("pos").alias("id"), F.lit(None).cast("binary").alias("other"))
    blocks = _close_blocks(nodes.withColumn("member", member), "merkle-above")
    above, roots = _above(blocks)
    own = witnesses(blocks.where("root is null")).select("tree", "block", F.col("id").alias("pos"), "witness")
    return own.join(above, ["tree", "block"]).select(
        "tree", "pos", F.concat("witness", "above").alias("witness")), roots


def witnesses(runs: DataFrame) -> DataFrame:
    """One row a member of the runs: tree, block, id, other, digest, and its witness as far
    as the runs' own goes."""
    each = runs.select("tree", "block", F.posexplode("members").alias("i", "m"), "digests", "alone", "witness")
    at = 32 * F.col("i")
    others = F.concat(F.substring("digests", F.lit(1), at), F.substring("digests", at + 33, F.octet_length("digests")))
    first = F.array(F.struct(F.col("i").alias("at"), others.alias("others")))
    return each.select("tree", "block", "m.id", "m.other", F.substring("digests", at + 1, F.lit(32)).alias("digest"),
                       F.when(F.col("alone"), _no_steps()).otherwise(F.concat(first, "witness")).alias("witness"))


# ---- numbering -------------------------------------------------------------------

def _numbered(rows: DataFrame, order: list, tag: str) -> DataFrame:
    """Add ``pos`` (place inside the tree in ``order``, from 0) and ``total`` (its rows).

    Rows are dealt by sampled ranges of (tree, order), sorted and written; a row's place is
    its place in its part plus the rows of its tree in earlier parts.  One row a tree and
    part meets a window.
    """
    at = stored(rows.repartitionByRange(partitions(rows.sparkSession), "tree", *order)
                .sortWithinPartitions("tree", *order)
                .withColumn("at", F.monotonically_increasing_id()), tag)
    at = at.withColumn("part", F.shiftright("at", 33))
    parts = at.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("tree", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
                         F.sum("n").over(tree).alias("total"))
    return (at.join(parts, ["tree", "part"])
            .withColumn("pos", F.col("base") + F.col("at") - F.col("first"))
            .drop("part", "first", "base", "at"))


# ---- the manifest ----------------------------------------------------------------

class Manifest:
    """Tables of a manifest, all in the shared folder.

    ``runs``: one row a lowest run - tree, block, members (id, other), digests, alone,
    witness (from the run to the block's root).  ``blocks``: tree, block, above (from
    the block's root to the dataset's), subroot, root.  ``root``: 32 bytes; None if empty.
    """

    def __init__(self, runs: DataFrame, blocks: DataFrame, root: bytes | None):
        self.runs, self.blocks, self.root = runs, blocks, root

    def witnesses(self) -> DataFrame:
        """(tree, id, other, digest, witness, subroot, root) of every row."""
        w = witnesses(self.runs).join(self.blocks, ["tree", "block"])
        return w.select("tree", "id", "other", "digest", F.concat("witness", "above").alias("witness"),
                        "subroot", "root")

    def proofs(self) -> DataFrame:
        """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

        ``folded_root`` is the root recomputed from ``other`` where there is one, else from
        the leaf, with the row's siblings.  A run's witness is read once for its members."""
        rows = self.runs.join(self.blocks, ["tree", "block"]).select(
            "members", "digests", "alone", F.concat("witness", "above").alias("witness"), "subroot", "root")
        return rows.mapInArrow(_prove, "id long, leaf string, subroot string, root string, "
                                       "proof_sha256 string, folded_root string, verified boolean")


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for members, digests, alone, witness, subroot, root in zip(*(c.to_pylist() for c in batch.columns)):
            steps = [(w["at"], w["others"]) for w in witness]
            siblings = b"".join(o for _, o in steps).hex().encode()
            subroot, whole, known = subroot.hex(), root.hex(), {}
            for i, m in enumerate(members):
                digest = digests[32 * i:32 * i + 32]
                others = digests[:32 * i] + digests[32 * i + 32:]
                at = m["other"] or digest
                parent = at if alone else step_up(at, i, others)
                if parent not in known:     # members that were not changed share what is above
                    up = parent
                    for place, beside in steps:
                        up = step_up(up, place, beside)
                    known[parent] = up.hex()
                proof = hashlib.sha256(others.hex().encode())
                proof.update(siblings)
                out.append((m["id"], digest.hex(), subroot, whole, proof.hexdigest(), known[parent],
                            known[parent] == whole))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) if n else pa.array(c, pa.int64()) for n, c in enumerate(zip(*out))],
                names=["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])


def build(rows: DataFrame) -> Manifest:
    """The manifest of rows (key string, id long, digest binary of 32, other binary).

    Rows of a key ascend by id (null first; equal ids by digest, then ``other``), keys by
    their bytes, null first and apart from the empty text.  Repeated rows are leaves of
    their own.  ``other`` is carried along for :meth:`Manifest.proofs`.  An empty table has
    no rows and no root.
    """
    spark = rows.sparkSession
    tree = F.when(F.col("key").isNull(), F.lit(b"")).otherwise(F.concat(F.lit(b"="), F.col("key").cast("binary")))
    member = F.struct(F.col("id").cast("long").alias("id"), F.col("other").alias("other"))
    # stored first: dealing by ranges reads its input twice, and that must not be the texts
    named = stored(rows.select(tree.alias("tree"), "digest", member.alias("member")), "merkle-digests")
    order = [F.col(c).asc_nulls_first() for c in ("member.id", "digest", "member.other")]
    closed = _close_blocks(_numbered(named, order, "merkle-leaves"), "merkle-runs")
    above, roots = _above(closed)
    # the keys' roots are the leaves of one more tree
    keys = _numbered(roots.select(F.lit(b"").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest")),
                     [F.col("name")], "merkle-keys")
    top, root = _node_witnesses(keys)
    root = root.first()
    root = bytes(root["root"]) if root else None
    keys = keys.join(top, ["tree", "pos"]).select(
        F.col("name").alias("tree"), F.col("digest").alias("subroot"), F.col("witness").alias("rest"))
    blocks = above.join(keys, "tree").select("tree", "block", F.concat("above", "rest").alias("above"), "subroot",
                                             F.lit(root).cast("binary").alias("root"))
    return Manifest(closed.where("root is null").drop("root"), stored(blocks, "merkle-blocks"), root)


# The fields of a leaf of a document, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def document_proofs(docs: DataFrame, tampered: Column | None = None, changed: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every document.

    Leaves are documents (``FIELDS``; a null field is ``-``), keys are sources.  Where
    ``tampered`` holds, the root is folded from a leaf whose text is ``changed``; a null
    condition counts as not tampered.  A null ``doc_id`` is a leaf in front of its source's
    others.  Texts of any length are hashed whole.  Other columns are not read.
    """
    own = leaf(*[field(c) for c in FIELDS])
    other = F.lit(None).cast("binary")
    if tampered is not None:
        other = F.when(tampered, leaf(*[field(c) for c in FIELDS[:-1]], field(changed)))
    rows = docs.select(F.col("source").cast("string").alias("key"), F.col("doc_id").cast("long").alias("id"),
                       own.alias("digest"), other.alias("other"))
    return build(rows).proofs().withColumnRenamed("id", "doc_id")
