"""The documents table from raw texts to packed sequences, in stages that each write a table.

Toxic documents go; of near-duplicates the one with the smallest doc_id stays; documents that
hold a benchmark item go; personal data becomes surrogates; what is left is packed. Every
stage but the last returns the columns of ``documents``. An empty table gives no pieces; null texts pass every
stage and are packed as empty documents (of several, near-duplicate removal keeps one).
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwork import session
from tillwork.llm import decontam, packing, pii, simhash, toxicity
from tillwork.llm.common import ship, table
from tillwork.llm.queries import PII_KEY

#: Session setting with the key of the surrogates.
KEY_SETTING = "spark.tillwork.surrogates.key"


def _ready(spark: SparkSession) -> SparkSession:
    return ship(session.tune(spark))


def _key(spark: SparkSession) -> bytes:
    """The secret behind the surrogates; the public one of the registered query if the session names none."""
    secret = spark.conf.get(KEY_SETTING, None)
    if secret is None:
        warnings.warn(f"{KEY_SETTING} is not set: anyone can reverse these surrogates", stacklevel=3)
        return PII_KEY
    return secret.encode()


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.learn(docs, table(_ready(spark), sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(_ready(spark), sf_dir, "benchmark"))


def with_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key = _key(_ready(spark))
    pii.check_distinct(docs, key)
    return pii.replace(docs, key)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return packing.pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "source")


STAGES = [
    ("toxicity", without_toxic),
    ("near-duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("surrogates", with_surrogates),
    ("packing", packed),
]

#: SQL cannot express the fitted model; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = session.materialise(stage(spark, docs, sf_dir))
    return docs
