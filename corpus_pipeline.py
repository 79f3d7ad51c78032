"""A training corpus from raw documents, in stages that each call one operator.

Every stage takes what its predecessor kept, written as Parquet and read again. All but the
last return the columns of ``documents``; the last returns the encoded corpus.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor_metrics.context import shared_dir
from corridor_metrics.llm import byte_bpe, byte_cnn, exact_dedup, simhash, wu_manber
from corridor_metrics.llm.common import payload, ship, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _keep(docs: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """Rows of ``docs`` whose id and ``key`` are named in ``kept``, one row for each."""
    named = kept.select(F.col("doc_id").alias("_id"), F.col(key).alias("_key"))
    rows = docs.join(named, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key")), "left_semi")
    return rows.dropDuplicates(["doc_id", "_text_key"]).select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    ship(spark)
    model = byte_cnn.train(docs, table(spark, sf_dir, "labels"))
    return docs.select(*COLUMNS).where(byte_cnn.score(model, F.col("text")) >= byte_cnn.THRESHOLD)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    ship(spark)
    docs = docs.select(*COLUMNS)
    groups = exact_dedup.duplicate_groups(docs)
    folded = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return _keep(docs.withColumn("_text_key", F.sha2(folded, 256)), groups.where("kept"), "text_sha256")


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the least id, and of these the least SHA-256 of the text.

    A NULL id stays only where the group has no other. Ids may repeat in other groups.
    """
    ship(spark)
    docs = docs.select(*COLUMNS).withColumn("_text_key", F.sha2(payload("text"), 256))
    found = simhash.near_duplicates(docs, carried=("_text_key",))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_text_key")).alias("first")
    return _keep(docs, found.groupBy("root").agg(first).select("first.doc_id", "first._text_key"), "_text_key")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    ship(spark)
    return docs.select(*COLUMNS).where(~wu_manber.contaminated(F.col("text"), table(spark, sf_dir, "benchmark")))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as token ids, with digests of ids and decoded text."""
    ship(spark)
    return byte_bpe.bpe_round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("simhash near-dedup", simhash_stage),
    ("benchmark decontamination", decontamination_stage),
    ("byte-level bpe", encoding_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored in the shared folder before the next."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
