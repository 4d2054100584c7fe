"""The pipeline over ``documents``: quality, toxicity, near duplicates, mixing, encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's rows
as Parquet to the shared scratch folder and hands the reread table to the next one. All stages but
the last return the columns of ``documents``. A filtering stage keeps rows whose score is null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.llm import bpe, cotrain, mixing, ngramjoin, toxicity
from shelfmark.llm.queries import GOOD, TOXIC, vocabulary
from shelfmark.scratch import settle

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: SQL cannot train the classifiers or draw the exponential keys' digests in the same way.
ORACLE_SQL = None


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _numbered(docs: DataFrame) -> DataFrame:
    """The documents with a number _row that stays with each, so that narrow rows can stand for them."""
    return settle(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier finds good."""
    model = cotrain.fit(docs, _labels(spark, sf_dir))
    return cotrain.score(docs, model).where(F.col("score") >= GOOD).select(*COLUMNS)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    model = toxicity.fit(docs, _labels(spark, sf_dir))
    return toxicity.score(docs, model).where(F.col("score") < TOXIC).select(*COLUMNS)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one of least id, null ids last, and of rows that
    repeat this id the one of least text digest. All rows of empty texts stay: they are like none."""
    rows = _numbered(docs)
    parts = ngramjoin.join_documents(rows.select(F.col("_row").alias("doc_id"), "text"), 5, 80)
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "_digest", "_row")
    # Digests are taken before the join, which else would shuffle the texts.
    narrow = rows.select("_row", "doc_id", F.sha2("text", 256).alias("_digest"))
    kept = (narrow.join(parts.select(F.col("doc_id").alias("_row"), "component_id"), "_row")
            .groupBy("component_id").agg(F.min(first)["_row"].alias("_row")).select("_row"))
    # The same join at every size: a broadcast would do for few documents only.
    return rows.join(kept.hint("merge"), "_row", "left_semi").select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a document is there as often as it is taken."""
    rows = _numbered(docs)
    narrow = rows.select("_row", "doc_id", "source", mixing.word_count().alias("_words"),
                         mixing.plain_share().alias("_plain"),
                         F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("_crc"))
    mixed = mixing.mix(narrow, F.col("_words"), F.col("_plain"), [F.col("doc_id"), F.col("_crc")])
    taken = mixed.where(F.col("times") > 0).select("_row", "times")
    return mixing.repeat(rows.join(taken.hint("merge"), "_row")).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (packed little-endian unsigned 32-bit) of every row, with their number."""
    coded = bpe.encode(docs.select(*COLUMNS), vocabulary())
    return coded.select("doc_id", "lang", "source", bpe.id_count(F.col("ids")).alias("n_tokens"),
                        "ids", F.sha2("ids", 256).alias("ids_sha256"))


STAGES = [("quality", quality), ("toxicity", clean), ("near_duplicates", distinct),
          ("mixture", mixture), ("encoding", encoded)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
