"""The registered queries of the operators: thin, over whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    byte_bpe, classifier, collocations, embedding_join, lexical_search, mixing, ngram_join, packing, quality_rules, scratch, sharding, shipping,
    token_files, url_lists, wrappers,
)

SHARDS = 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    shipping.ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extracted(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


def captures_and_list(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Every page as a capture of a day, and a log of list entries that about an eleventh of the pages gave rise to."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("day", F.pmod(F.col("page_id") * 7919, F.lit(366)).cast("int"))
    k = F.col("page_id") * 37 + F.length("url")
    host = F.lower(F.regexp_extract("url", url_lists.HOST, 1))
    folder = F.concat(host, F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^/?#]*/)", 1))
    pattern = F.when(F.pmod(k, F.lit(3)) == 0, F.concat(F.lit("host:"), host)).when(
        F.pmod(k, F.lit(3)) == 1, F.concat(F.lit("path:"), folder)).otherwise(
        F.concat(F.lit("domain:"), F.regexp_extract(host, r"([^.]+\.[^.]+\.[^.]+)$", 1)))
    entries = pages.where(F.pmod(k, F.lit(11)) == 0).select(
        pattern.alias("pattern"), F.pmod(k * 13, F.lit(366)).cast("int").alias("day"), (F.pmod(F.floor(k / 11), F.lit(3)) != 0).alias("listed"))
    return captures, entries


def op2_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures, entries = captures_and_list(spark, sf_dir)
    return url_lists.judged(captures, entries)


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scratch.stored(sharding.measured(table(spark, sf_dir, "documents"), "doc_id", "text"), "sizes")
    found = sharding.sharded(rows, "doc_id", SHARDS)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def op4_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    to = scratch.folder(spark, "token-files")
    found = token_files.write(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), to)
    back = token_files.read(found, to)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").cast("bigint").alias("ids_crc32"))


def op6_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    found = byte_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, public_tokenizers.PATTERN)
    return found.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(byte_bpe.decode(F.col("ids"), path), 256).alias("decoded_sha256"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judged(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select(
        "doc_id", *[F.col(f"_m.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        (F.size("_base") > 0).alias("base_failed"), ((F.size("_base") == 0) & (F.size("_broken") == 0)).alias("kept"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    held_out = F.coalesce(held_out, F.lit(False))
    model = classifier.fit(docs.where(~held_out), table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out.alias("held_out"), classifier.score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixed(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {
    q.__name__: q
    for q in (
        op1_page_text, op2_url_lists, op3_shards, op4_packed_sequences, op5_token_files, op6_embedding_join, op7_byte_bpe, op8_ngram_join,
        op9_quality_rules, op10_quality_classifier, op11_lexical_search, op12_collocations, op13_source_mix)
}
