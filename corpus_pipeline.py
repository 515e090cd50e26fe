"""A training-data pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next stage's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landstat.llm import bpe, decontaminate, linededup, quality, simhash
from landstat.llm.common import fresh, remove, shared_dir, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier takes (predicted 1), unchanged."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines whose three-line windows occurred before; ``n_chars`` follows a changed text."""
    kept = linededup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast("long")).select(docs.columns)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id; rows with a null id stay."""
    groups = simhash.near_duplicates(docs).select(F.col("doc_id").alias(k := fresh(docs, "member")), "component_id").filter(F.col(k) != F.col("component_id")).select(k).distinct()
    return docs.join(groups, F.col("doc_id") == F.col(k), "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by ``benchmark``, unchanged."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256 and the ids themselves."""
    import public_tokenizers

    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = bpe.encode(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN).drop("text")
    return bpe.decode(coded, ranks).select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("token_ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "token_ids",
    )


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", remove_repeated_lines),
    ("simhash near-dedup", one_of_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE", encode),
]

#: No SQL: a trained classifier, SimHash groups and BPE are beyond it. Tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what is between them is written to the shared folder, and only the last of it stays there.

    Ids are taken to be unique: rows that repeat an id go or stay together in the near-duplicate stage. No rows give no rows.
    """
    docs = table(spark, sf_dir, "documents")
    at = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{at}/{k}")
            docs = spark.read.parquet(f"{at}/{k}")
            remove(spark, f"{at}/{k - 1}")
    return docs.drop("token_ids")
