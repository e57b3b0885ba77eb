"""The corpus pipeline: documents in, a shuffled and sharded training mix out.

Each stage takes (spark, docs, sf_dir) and returns a table, which ``run`` writes as Parquet and reads back
as the next stage's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starhouse.llm import decontamination, language_id, mixing, near_dedup, sharding
from starhouse.llm.common import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Language identification, permutations and copies by hash have no counterpart in SQL.
ORACLE_SQL: str | None = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose text is in one of the languages of the labelled documents. Null and letterless texts go.

    The cosine that a text must reach is learned from labelled documents of its length.
    """
    learned = docs.filter(~language_id.held_out())
    profiles = language_id.train(learned)
    return language_id.speaks(docs.select(COLUMNS), profiles, language_id.limits(learned, profiles))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the smallest id, of each group of documents that share 80 percent of their shingles."""
    return near_dedup.distinct_documents(docs.select(COLUMNS), percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that benchmark passages cover to a twentieth or more, and cuts passages out of the others."""
    return decontamination.clean(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"), lengths="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mix of sources (weights 5, 2, 1 in turn, 150 % of all words) asks for."""
    sized = stored(mixing.sizes(docs), "sizes")
    targets = stored(mixing.capped_targets(mixing.cyclic_weights(sized)), "targets")
    return mixing.repeated(mixing.mix(docs, targets, sized=sized), COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot, counts at most one apart. Copies of a document are numbered one by one."""
    return sharding.shard(docs.select(COLUMNS), order=["doc_id", "source", "n_chars"])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(COLUMNS)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
