"""The registered queries of this subpackage and their comparison SQL.

A query applies one operator to its whole table and returns the columns of its contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from starhouse.llm import decontamination, language_id, line_dedup, mixing, near_dedup, nearest, personal_data, sharding
from starhouse.llm import collocations, hard_negatives, license_query, quality_rules, url_queries
from starhouse.llm.common import stored, table


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = language_id.train(docs.filter(~language_id.held_out()))
    predicted = language_id.predict(docs.drop("lang"), profiles)
    return predicted.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "found.n_words", "found.n_hit", F.size("found.items").cast("long").alias("n_items"),
        decontamination.items_digest().alias("items_sha256"), decontamination.contaminated().alias("contaminated"),
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    dropped = stored(line_dedup.duplicate_lines(docs), "dropped")
    n_lines = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"))) + 1
    return docs.select("doc_id", F.coalesce(n_lines, F.lit(0)).cast("long").alias("n_lines")).join(dropped, "doc_id", "left").select(
        "doc_id", "n_lines", F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce(F.array_join(F.col("dropped").cast("array<string>"), ","), F.lit("")).alias("dropped_lines"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal_data.detect(docs, personal_data.learn(docs))
    counts = [personal_data.count_of("found.base", kind).alias(f"n_{kind}") for kind in personal_data.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(personal_data.listed(F.col("found.base")), 256).alias("base_sha256"),
        personal_data.listed(F.col("found.spans")).alias("spans"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = stored(mixing.sizes(table(spark, sf_dir, "documents")), "sizes")
    targets = stored(mixing.capped_targets(mixing.cyclic_weights(sized)), "targets")
    taken = mixing.take(sized, mixing.plan(sized, targets)).alias("d")
    return taken.join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")), "left").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null text has size 1 and no checksum: text_crc32 is null. That of an empty text is 0."""
    text = F.col("text")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    return sharding.shard(docs, order=["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("source")


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licenses": license_query.op1_licenses,
    "op2_url_filters": url_queries.op2_url_filters,
    "op3_language_id": op3_language_id,
    "op4_decontamination": op4_decontamination,
    "op5_line_dedup": op5_line_dedup,
    "op6_personal_data": op6_personal_data,
    "op7_mixing": op7_mixing,
    "op8_sharding": op8_sharding,
    "op9_near_dedup": op9_near_dedup,
    "op10_nearest": op10_nearest,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_collocations": op12_collocations,
    "op13_quality_rules": op13_quality_rules,
    "pipeline": corpus_pipeline.run,
}

LLM_ORACLE: dict[str, str] = {
    "op1_licenses": license_query.ORACLE,
    "op2_url_filters": url_queries.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op12_collocations": collocations.ORACLE,
    "op13_quality_rules": quality_rules.ORACLE,
} | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
