"""The corpus pipeline: five stages over ``documents``, each written and read again.

Language identification, exact deduplication, near duplicates by the n-gram
Jaccard join, pseudonyms for personal data, packing.  Every stage works on all
that the one before kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorum.llm import exact_dedup, jaccard_join, langid, packing, pii
from quorum.llm.common import fresh, ship_package, table, written
from quorum.llm.sp_tokens import read_model

#: A document goes when its best language scores less: the text points away from every language.
LEAST_LANGUAGE_SCORE = 0.5
#: Near duplicates: words of a shingle and percent of similarity.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told (rejected: no letter, or no language near)."""
    ship_package(spark)
    languages, prototypes = langid.learn(docs)
    own = {c: fresh(docs, f"own_{c}") for c in docs.columns if c.lower() in ("lang_pred", "score")}
    told = langid.predict(docs.withColumnsRenamed(own), languages, prototypes)
    kept = told.filter((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return kept.select(*(F.col(f"`{own.get(c, c)}`").alias(c) for c in docs.columns))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts."""
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every component of near duplicates."""
    return jaccard_join.drop_near_duplicates(docs, words=SHINGLE_WORDS, percent=SIMILAR_PERCENT)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pseudonyms in the texts."""
    found = fresh(docs, "n_replaced")
    return pii.pseudonymised(docs, found_col=found).drop(found)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(docs, read_model(public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [("language ID", language), ("exact dedup", exact), ("n-gram Jaccard join", near), ("PII", private), ("packing", packed)]

#: Learned and tokenised stages have no SQL; tests hold run() against a version without Spark.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
