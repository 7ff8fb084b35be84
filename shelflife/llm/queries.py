"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflife.llm import chat, common, dedup, html, huffman, iblt, langid, merkle, mixing, oracles, packing, ppm, runs, simhash, topk

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as Huffman-coded token files, read them back, digest."""
    path = huffman.token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), end_id=1)
    return huffman.read_digests(spark, path)


def op5_iblt_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts, and their likeness."""
    return iblt.fingerprints(_table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of at most 2048 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER),
                        end_id=0, capacity=2048)


def op1_html_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html.main_text(_table(spark, sf_dir, "pages"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from labels that are not held out."""
    return langid.languages(_table(spark, sf_dir, "documents"))


def op3_grace_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicate groups of all documents."""
    return dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op7_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mixture takes of every document."""
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


# A conversation whose texts look like marks, added to the table.
ODD_TEXT = "\\### Assistant: </turn> ok"
ODD_CONVERSATION = [(-7, 0, "user", ODD_TEXT), (-7, 1, "assistant", ODD_TEXT)]


def op8_chat_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations and the odd one, read them back, digest."""
    convs = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame(ODD_CONVERSATION, "conv_id long, turn long, role string, text string")
    return chat.format_and_read(convs.unionByName(odd))


def op9_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model and unigram scores of every document."""
    return ppm.score(_table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents."""
    return simhash.simhash_components(_table(spark, sf_dir, "documents"), n_words=3, radius=2)


# What the lower-casing of A-Z changes.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proofs of all documents, a fifth of them tampered with."""
    return merkle.document_proofs(_table(spark, sf_dir, "documents"), tampered=common.key_crc() % 5 == 0,
                                  changed=F.translate("text", UPPER, LOWER))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of all documents, a tenth of them made to repeat themselves."""
    found = runs.periodic_runs(runs.echoed(_table(spark, sf_dir, "documents"), common.key_crc()))
    # the most periods; runs come by start and period, so ties stay with the first
    more = lambda r, best: r["length"] * best["period"] > best["length"] * r["period"]
    best = F.reduce("runs", F.get("runs", F.lit(0)), lambda b, r: F.when(more(r, b), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_histogram_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best of all vectors for every hundredth one."""
    return topk.top_k(_table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0", k=10)


QUERIES = (op1_html_model, op2_language, op3_grace_dedup, op4_token_files, op5_iblt_fingerprints, op6_best_fit_packing, op7_pareto_mixing,
           op8_chat_template, op9_ppm, op10_simhash, op11_merkle_manifest,
           op12_periodic_runs, op13_histogram_topk)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def llm_oracles() -> dict[str, str]:
    return {"op3_grace_dedup": oracles.OP3, "op7_pareto_mixing": oracles.OP7,
            "op8_chat_template": oracles.OP8,
            "op11_merkle_manifest": oracles.OP11, "op12_periodic_runs": oracles.OP12,
            "op13_histogram_topk": oracles.OP13}
