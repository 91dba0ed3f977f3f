"""From raw documents to shards: what the classifier keeps, one of each near-duplicate group, nothing from a benchmark,
sources mixed to weights, rows dealt into shards of equal bytes. Each stage is written and read again by ``run``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, mixing, quality, sharding, simhash
from tidemark.plans.scratch import written
from tidemark.session import table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (fitted on the labels of these documents) does not reject."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of every SimHash group: three words, at most two differing bits."""
    return simhash.one_of_each(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs, items without an id included."""
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"), unnamed=True)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with size, text_crc32, shard and slot."""
    names = {c: f"__doc{i}" for i, c in enumerate(docs.columns) if c not in ("size", "text_crc32", "shard", "slot")}
    inner = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    made = sharding.shard(inner, keep=list(names.values()), id_col=names["doc_id"], text=names["text"])
    return made.select(*[F.col(n).alias(c) for c, n in names.items()], "size", "text_crc32", "shard", "slot")


STAGES = [
    ("quality classifier", good),
    ("SimHash near-dedup", unique),
    ("benchmark decontamination", clean),
    ("mixing sources to target weights", mixed),
    ("sharding", sharded),
]
#: fingerprints, the fitted classifier and checksums have no SQL; tests hold every stage against a plain Python version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
