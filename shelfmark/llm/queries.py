"""One query per operator over the given tables, and SQL where SQL can say the same."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (bpe, blocks, cotrain, mixing, nearvec, ngramjoin, postings, repair, secretscan, shards,
               tokencount, toxicity, trie)
from ..scratch import settle

GOOD = 0.5      # least quality score of a document that is kept
TOXIC = 0.7     # score from which a document counts as toxic


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Path of a public rank file; SHELFMARK_VOCABULARY names another folder."""
    folder = os.environ.get("SHELFMARK_VOCABULARY")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = vocabulary()
    coded = bpe.decode(bpe.encode(docs, path), path)
    return coded.select(
        "doc_id", bpe.id_count(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokencount.section_counts(docs, vocabulary())


def op3_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return postings.nearest(rows, rows.where("vec_id % 20 = 0"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = cotrain.fit(docs, _table(spark, sf_dir, "labels"))
    return cotrain.score(docs, model).select(
        "doc_id", "score", (F.col("score") >= GOOD).alias("kept"))


def op5_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id", shards.byte_size().alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    cut = shards.shard_by_bytes(rows, F.col("size"), [F.col("doc_id"), F.col("text_crc32")], 8)
    return cut.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op6_graph_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearvec.groups(_table(spark, sf_dir, "embeddings"), 0.9)


def op7_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id", "source", mixing.word_count().alias("words"),
        mixing.plain_share().alias("quality"))
    return mixing.mix(rows, F.col("words"), F.col("quality"), [F.col("doc_id")]).select(
        "doc_id", "size", "source_size", "target", "taken")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.join_documents(_table(spark, sf_dir, "documents"), 4, 85)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", (~toxicity.in_training_fold(F.col("doc_id"))).alias("held_out"), "score",
        F.when(F.col("score") >= TOXIC, 1).otherwise(0).alias("predicted"))


def op10_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = blocks.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = settle(repair.damage(_table(spark, sf_dir, "conversations")))
    plan = repair.plans(damaged)
    same = F.col("p.conv_id").eqNullSafe(F.col("d.conv_id"))
    hashed = repair.digests(repair.repaired(damaged, plan))
    return plan.alias("p").join(hashed.alias("d"), same, "left").select(
        "p.conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256))
        .alias("repaired_sha256"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rebuilt = trie.with_shared_beginnings(
        settle(trie.numbered(_table(spark, sf_dir, "conversations"))))
    return trie.build(rebuilt).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256")


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secretscan.scan(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *[secretscan.count_of("base", k).alias(f"n_{k}") for k in secretscan.KINDS[:3]],
        F.sha2(secretscan.listed("base").cast("binary"), 256).alias("base_sha256"),
        secretscan.listed("spans").alias("spans"))


def functions() -> dict:
    names = [op1_byte_bpe, op2_token_counts, op3_posting_lists, op4_quality, op5_byte_shards,
             op6_graph_near_duplicates, op7_weighted_mix, op8_ngram_join, op9_toxicity,
             op10_page_text, op11_conversation_repair, op12_conversation_trie,
             op13_secret_scan]
    return {f.__name__: f for f in names}


def sql_texts() -> dict[str, str]:
    return {}
