"""The corpus pipeline: five stages over the documents table, each a table that the next one reads.

Stages take (spark, docs, sf_dir). All but the last return the columns of `documents`; each works
on whatever the stage before it kept. Missing texts and ids, repeated rows, empty tables and
further columns are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorspark.llm import bpe, mixing, pii, quality_rules, simhash
from sensorspark.llm.queries import SHARES, TOKENIZER, table
from sensorspark.plans.shared import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that policy v2 of the quality rules keeps."""
    return quality_rules.keep_documents(docs, quality_rules.POLICIES["v2"])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of linked fingerprints."""
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced; n_chars follows the text."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their shares, in shuffled order."""
    return mixing.mix(docs, SHARES).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, packed, and digests of the ids and of the text they decode to."""
    coded = bpe.encode(docs, TOKENIZER, round_trip=True)
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality_rules", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("mixture", mixture), ("tokens", tokens)]

# Fingerprints, boosted trees and token ids are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table of a folder."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, name)
    return docs
