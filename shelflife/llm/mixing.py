"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations alone.

A document's expected number of copies grows with its weight, by default the binary
digits of its size: level times weight, but ``MOST`` at most, with the level of its
source such that the expected words meet the target.  The whole part is certain; the
rest is an inclusion probability p, which differs between documents of a source.
Documents are ranked by random odds over inclusion odds, u/(1-u) * (1-p)/p, and
the lowest ranks are taken until the source's target is met to within half a
document.  The random number is a hash of the document, so reruns agree.

Documents of one source and weight form a class.  Classes are few (weights are small
whole numbers), so level, p and the distribution of ranks come from one row a class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelflife.llm.common import WORD, stored

WEIGHTS = (5, 2, 1)     # of sources in code-point order, repeating
SHARE_PERCENT = 150     # of all sizes, shared by the sources
MOST = 2                # copies of a source at most
BUCKET_ROWS = 4096      # documents whose running sum one window holds, about


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def size_weight(size: Column) -> Column:
    """The default weight of a document: binary digits of its size, so at most 63 values."""
    return F.length(F.bin(size))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: int = SHARE_PERCENT,
                   most: int = MOST) -> DataFrame:
    """(source, source_size, n_docs) -> the same plus target.

    A source gets its weight's part of ``share`` percent of all sizes, but no more
    than ``most`` times its size; what is over is shared again by weight.  In order
    of size over weight the sources that stop are the first ones: each stops if its
    limit is below its part of what the sources before it left.  The windows hold one
    row a source in one task: bounded by the number of sources, not of documents.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"), "n_docs")
    weight = F.element_at(F.array(*map(F.lit, weights)),
                          (F.row_number().over(by_name) - 1) % len(weights) + 1)
    limit = F.col("source_size") * most
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding,
                                                 Window.unboundedFollowing)
    s = (sizes.withColumn("weight", weight.cast("long")).withColumn("limit", limit)
         .withColumn("limits_before", F.coalesce(F.sum("limit").over(before), F.lit(0)))
         .withColumn("weights_left", F.sum("weight").over(every)
                     - F.coalesce(F.sum("weight").over(before), F.lit(0)))
         .withColumn("wanted", F.sum("source_size").over(every) * share / 100.0))
    level = (F.col("wanted") - F.col("limits_before")) / F.col("weights_left")
    stops = F.col("limit") <= level * F.col("weight")
    # the level of the sources that do not stop is that of the first of them
    s = (s.withColumn("level", level).withColumn("stops", stops)
         .withColumn("free", F.min(F.when(~F.col("stops"), F.struct(F.col("limit") / F.col("weight"),
                     F.col("source").isNull(), "source", F.col("level").alias("at")))).over(every)))
    target = F.when(F.col("stops"), F.col("limit").cast("double")).otherwise(
        F.col("free.at") * F.col("weight"))
    return s.select("source", "source_size", "n_docs", target.alias("target"))


def _classes(slim: DataFrame, bucket_rows: int) -> DataFrame:
    """One row per (of, of_weight), the source and weight of a class, with source_size,
    target, ``whole`` (certain copies), ``p``, ``left`` (words that the source's sample
    takes), ``spread`` (share and inclusion odds of the source's classes that are
    sampled) and ``n_buckets``.

    Copies are level times weight and stop at ``MOST``, the largest weights first; what
    is over is shared again as between sources.  Weight 0 is that of documents without
    words: they are not sampled, and whole if their source is.
    """
    sums = stored(slim.groupBy("source", "weight").agg(
        F.sum("size").alias("class_size"), F.count("*").alias("n")), "classes")
    sources = source_targets(sums.groupBy("source").agg(
        F.sum("class_size").alias("source_size"), F.sum("n").alias("n_docs")))
    sources = sources.withColumnRenamed("source", "of")
    c = sums.join(sources, F.col("source").eqNullSafe(F.col("of")))
    own = Window.partitionBy("of")
    order = own.orderBy(F.desc("weight"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    c = c.withColumn("limits_before", MOST * F.coalesce(F.sum("class_size").over(before), F.lit(0))) \
        .withColumn("weights_left", F.sum(F.col("class_size") * F.col("weight")).over(after))
    rest = F.col("target") - F.col("limits_before")
    # multiplied out, so that a source which stops as a whole stops in its last class
    stops = (F.col("weights_left").cast("double") * MOST
             <= rest * F.col("weight").cast("double"))
    c = c.withColumn("stops", stops).withColumn(
        "level", F.when(F.col("weights_left") > 0, rest / F.col("weights_left").cast("double")))
    # the level of the classes that do not stop is that of the first of them
    level = F.max(F.when(~F.col("stops") & (F.col("weight") > 0),
                         F.struct("weight", F.col("level").alias("at")))).over(own)["at"]
    c = c.withColumn("at", level)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    c = c.withColumn("copies", F.when(F.col("weight") == 0, F.least(F.floor(rate), F.lit(1)).cast("double"))
                     .when(F.col("stops"), F.lit(float(MOST))).otherwise(F.col("at") * F.col("weight")))
    c = c.withColumn("whole", F.floor("copies")).withColumn("p", F.col("copies") - F.floor("copies"))
    sampled = F.when(F.col("p") > 0, F.col("n"))
    c = c.withColumn("left", F.col("target") - F.sum(F.col("whole") * F.col("class_size")).over(own)) \
        .withColumn("n_sampled", F.coalesce(F.sum(sampled).over(own), F.lit(0)))
    spread = F.collect_list(F.when(F.col("p") > 0, F.struct(
        "weight", (F.col("n") / F.col("n_sampled")).alias("share"),
        (F.col("p") / (1 - F.col("p"))).alias("odds")))).over(own)
    return stored(c.select(
        "of", F.col("weight").alias("of_weight"), "source_size", "target", "whole", "p", "left",
        F.sort_array(spread).alias("spread"),
        F.ceil(F.col("n_sampled") / bucket_rows).alias("n_buckets")), "levels")


def _keys(docs: DataFrame, weight, seed: str) -> DataFrame:
    """(rec, source, doc_id, size, weight, u, tie): a random number in (0, 1) from a hash of
    id and text, and that hash to break ties.  Equal rows have equal keys."""
    text = F.coalesce(F.col("rec.text"), F.lit(""))
    key = F.md5(F.concat(F.concat_ws("|", F.coalesce(F.col("rec.doc_id").cast("string"), F.lit("")),
                                     F.md5(text)), F.lit(seed)))
    u = (F.conv(F.substring("tie", 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))
    return docs.select(F.struct("*").alias("rec")).select(
        "rec", F.col("rec.source").alias("source"), F.col("rec.doc_id").alias("doc_id"),
        word_count("rec.text").alias("size"), key.alias("tie")).withColumn("u", u).withColumn(
        "weight", F.when(F.col("size") > 0, weight(F.col("size"))).otherwise(0))


def _with_rank(keys: DataFrame, classes: DataFrame) -> DataFrame:
    """Keys with the columns of their class and ``rank``, null for what is not sampled."""
    d = keys.join(classes, F.col("source").eqNullSafe(F.col("of"))
                  & (F.col("weight") == F.col("of_weight"))).drop("of", "of_weight")
    odds = F.col("u") / (1 - F.col("u")) * (1 - F.col("p")) / F.col("p")
    return d.withColumn("rank", F.when(F.col("p") > 0, odds))


def _ranked(slim: DataFrame, classes: DataFrame) -> DataFrame:
    """Documents without their texts: doc_id, source, size, rank, tie, source_size, target,
    weight, p, whole, and ``extra``: whether the sample takes one more, with ``k``, the
    row's number among rows of equal key."""
    d = _with_rank(slim, classes)
    # the expected share of the source's ranks below this one: buckets of equal width in it
    # hold like numbers of rows.  Every step rounds monotonically, so buckets keep the order
    below = F.aggregate("spread", F.lit(0.0), lambda total, c: total + c["share"] * (
        1 - 1 / (1 + F.col("rank") * c["odds"])))
    d = d.withColumn("bucket", F.when(F.col("rank").isNotNull(), F.floor(below * F.col("n_buckets"))))
    sums = d.filter("bucket is not null").groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    up_to = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    sums = stored(sums.select(F.col("source").alias("of"), F.col("bucket").alias("of_bucket"),
                              F.coalesce(F.sum("n").over(up_to), F.lit(0)).alias("base")), "buckets")
    ranked = d.filter("bucket is not null").join(sums, F.col("source").eqNullSafe(F.col("of"))
                                                 & (F.col("bucket") == F.col("of_bucket")))
    order = Window.partitionBy("source", "bucket").orderBy("rank", "tie")
    before = F.col("base") + F.coalesce(
        F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = ranked.withColumn("extra", before + F.col("size") / 2 <= F.col("left")).withColumn(
        "k", F.row_number().over(order) - F.rank().over(order) + 1)
    certain = d.filter("bucket is null").withColumn("extra", F.lit(False)).withColumn("k", F.lit(0))
    cols = ["doc_id", "source", "size", "rank", "tie", "source_size", "target", "weight", "p",
            "whole", "extra", "k"]
    return ranked.select(cols).unionByName(certain.select(cols))


def _slim(docs: DataFrame, weight, seed: str) -> DataFrame:
    return stored(_keys(docs, weight, seed).drop("rec"), "sizes")


def sample(docs: DataFrame, bucket_rows: int = BUCKET_ROWS, weight=size_weight, seed: str = "") -> DataFrame:
    """Per document: doc_id, source, size, weight, source_size, target, whole, p, extra.

    ``weight`` maps a size to a small whole number from 1 on, ``seed`` draws another sample.
    """
    slim = _slim(docs, weight, seed)
    return _ranked(slim, _classes(slim, bucket_rows)).select(
        "doc_id", "source", "size", "weight", "source_size", "target", "whole", "p", "extra")


def mix_report(docs: DataFrame, bucket_rows: int = BUCKET_ROWS, weight=size_weight,
               seed: str = "") -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words, repeats counted).

    Null text has size 0; null source is a source of its own; repeated rows are
    ranked each; a source without words has target 0; an empty table gives no rows.
    """
    return sample(docs, bucket_rows, weight, seed).select(
        "doc_id", "size", "source_size", "target",
        ((F.col("whole") + F.col("extra").cast("long")) * F.col("size")).alias("taken"))


def mix(docs: DataFrame, bucket_rows: int = BUCKET_ROWS, weight=size_weight,
        seed: str = "") -> DataFrame:
    """The mixture itself: every document as often as it is taken, all its columns.

    The sample takes a prefix of each source's order: a document that would pass the
    target by more than half of itself has all later ones beyond the target.  So one
    key a source tells which documents go in, and texts are not shuffled.  Rows equal
    to that key are counted off.  A document without words goes in once if its source
    is taken whole.
    """
    slim = _slim(docs, weight, seed)
    classes = _classes(slim, bucket_rows)
    cut = F.max(F.when(F.col("extra"), F.struct("rank", "tie", "k")))
    cuts = stored(_ranked(slim, classes).groupBy("source").agg(cut.alias("cut"))
                  .withColumnRenamed("source", "cut_of"), "cuts")
    d = _with_rank(_keys(docs, weight, seed), classes.select("of", "of_weight", "whole", "p"))
    d = d.join(cuts, F.col("source").eqNullSafe(F.col("cut_of")))
    own, last = F.struct("rank", "tie"), F.struct("cut.rank", "cut.tie")
    sampled = F.col("rank").isNotNull() & F.col("cut").isNotNull()
    at_cut = F.coalesce(sampled & (own == last), F.lit(False))
    inside = F.coalesce(sampled & (own < last), F.lit(False))
    sure = d.filter(~at_cut).select("rec", (F.col("whole") + inside.cast("long")).alias("copies"))
    number = F.row_number().over(Window.partitionBy("source", "rank", "tie").orderBy("u"))
    edge = d.filter(at_cut).withColumn("number", number).select(
        "rec", (F.col("whole") + (F.col("number") <= F.col("cut.k")).cast("long")).alias("copies"))
    both = sure.unionByName(edge).filter("copies > 0")
    return both.select("rec", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("n")
                       ).select("rec.*")
