"""The append-only log of decisions, as files of JSON lines and as a stream that keeps the latest of each item."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.operators.review import DECISIONS

LOG = "review_id string, decision string, notes string, reviewer string, reviewed_at string, run_id string, version string, seq long"


def append(spark: SparkSession, path: str, rows: list[dict]) -> None:
    """Add decisions; a value that isn't allowed raises before anything is written."""
    for r in rows:
        if r.get("decision") not in DECISIONS:
            raise ValueError(f"decision must be one of {', '.join(DECISIONS)}")
        if not r.get("review_id"):
            raise ValueError("review_id is needed")
    spark.createDataFrame([tuple(r.get(c.split()[0]) for c in LOG.split(", ")) for r in rows], LOG).coalesce(1).write.mode("append").json(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG).json(path)


def latest_stream(spark: SparkSession, path: str) -> DataFrame:
    """A stream of the latest decision of each item, for output mode complete or update."""
    rows = spark.readStream.schema(LOG).json(path)
    return rows.groupBy("review_id").agg(F.max_by(F.struct("decision", "notes", "reviewer", "reviewed_at", "seq"), "seq").alias("last")).select("review_id", "last.*")


def counts(log: DataFrame) -> DataFrame:
    from concord.operators.explore import latest_decisions

    return latest_decisions(log).groupBy("decision").agg(F.count("*").alias("items"))
