"""From raw documents to packed training sequences, stage by stage.

Each stage takes what its predecessor kept, as written Parquet, and returns a DataFrame: the first three the documents
that stay, with the columns of ``documents``, the last the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import classifier, ngram_join, packing, quality_rules, scratch, shipping

#: Documents whose probability of good quality is lower are rejected.
LEAST_QUALITY = 0.5
#: Words whose ids a worker keeps; the workers of the stages before are still there, so it is less than elsewhere.
KNOWN_WORDS = 100_000


#: Rows and bytes that a Python worker is handed at a time: the workers of one stage are still there in the next.
HANDED = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def prepared(spark: SparkSession) -> None:
    """Send the package to the executors, and keep what their Python workers hold small."""
    shipping.ship(spark)
    for name, value in HANDED.items():
        spark.conf.set(name, value)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier rejects; it learns from the labelled rows outside the held-out quarter."""
    prepared(spark)
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    model = classifier.fit(docs.where(~held_out), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return classifier.accepted(docs, model, LEAST_QUALITY)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that break the base rules or a threshold."""
    prepared(spark)
    return quality_rules.kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of linked documents."""
    prepared(spark)
    return ngram_join.representatives(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of at most 2048 tokens."""
    prepared(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), most_words=KNOWN_WORDS)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", rules),
    ("ngram_jaccard_join", near_duplicates),
    ("best_fit_packing", packed),
]

#: The classifier is fitted and the texts are tokenized, which SQL cannot express; a test compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again before the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
