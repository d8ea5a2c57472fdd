"""The corpus pipeline: five stages over the table documents, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import decontaminate, mixture, shards, simhash, toxicity
from marketloom.llm.common import table
from marketloom.session import cut

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SHARDS = 40


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score lies under the threshold; the model learns from the labelled documents."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return simhash.drop_near_duplicates(docs).select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, small sources repeated until the sources meet their target weights, in the order of the mixture."""
    mixed = mixture.mix(docs, ties=("n_chars",))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return mixed.repartitionByRange(parts, "position").sortWithinPartitions("position").select(*COLUMNS)


def shard_rows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row of the mixture with its shard and its slot in the shard."""
    return shards.shard(docs, SHARDS, ties=("n_chars",)).select(*COLUMNS, "shard", "slot")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixture", mix_sources),
    ("shards", shard_rows),
]

#: Trained scores and 64-bit hashes are beyond SQL; tests/llm/test_pipeline.py replays the decisions of the stages plainly.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
