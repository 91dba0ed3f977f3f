"""How the driver tables stand in for sensor logs, inference logs and evaluation sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import Contract
from tidemark.session import table

LOG = Contract(entity=("user_id",), time="ts")
LINES = Contract(entity=("l_partkey",), time="l_shipdate", tie=("l_orderkey", "l_linenumber"))


def events(spark: SparkSession, sf: str) -> DataFrame:
    """The sensor log: entity user_id, time ts, reading value, kind event_type."""
    return table(spark, sf, "events")


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Events with the 0/1 label "is an error"."""
    return events(spark, sf).withColumn("label", (F.col("event_type") == "error").cast("int"))


def inference_log(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    """Events (a table, or a stream given as ``rows``) read as served requests."""
    failed = F.col("event_type") == "error"
    return (events(spark, sf) if rows is None else rows).select(
        "event_id",
        "ts",
        F.concat(F.lit("m"), (F.col("user_id") % 3).cast("string")).alias("model"),
        F.when(failed, "error").otherwise("ok").alias("status"),
        F.when(failed, F.concat(F.lit("E"), (F.col("user_id") % 4).cast("string"))).alias("error_type"),
        (F.col("value") / 100.0).alias("latency_s"),
        (F.col("value") / 500.0).alias("prediction"),
    )


INFERENCE_SQL = """
  SELECT event_id, ts, 'm' || (user_id % 3) AS model,
         CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status,
         CASE WHEN event_type = 'error' THEN 'E' || (user_id % 4) END AS error_type,
         value / 100.0::DOUBLE AS latency_s, value / 500.0::DOUBLE AS prediction
  FROM events
"""


def rounded(df: DataFrame, places: int = 6, **special: int) -> DataFrame:
    """All double columns rounded, so that results compare across engines."""
    names = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({n: F.round(F.col(n).cast("double"), special.get(n, places)) for n in names})


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """A binary evaluation set: label ``quality``, score from the document length."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return (
        table(spark, sf, "labels")
        .join(docs, "doc_id")
        .select(
            "doc_id",
            "lang",
            "source",
            F.col("quality").alias("label"),
            (F.col("n_chars") / (F.col("n_chars") + 1000.0)).alias("score"),
        )
    )


SCORED_SQL = """
  SELECT l.doc_id, d.lang, d.source, l.quality AS label,
         d.n_chars / (d.n_chars + 1000.0::DOUBLE) AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id
"""
