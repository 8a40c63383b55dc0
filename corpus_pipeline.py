"""The corpus pipeline: each stage is one training-data operator on all that the stage before it kept.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a frame, which is
written as Parquet and read again for the next. All but the last return the columns of ``documents``.

Defined results, of every stage: an empty table gives an empty table; columns besides doc_id, text and lang are
carried along as they are, whatever their names; a null id is a row like others and is the last choice to stay;
of rows with equal id and text one stays; texts are read whole, of any length. A null or empty text has no
language and goes at the first stage; a stage that is given one all the same keeps it as the one empty text
(exact dedup), links it with nothing, finds no benchmark in it and packs its end id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm.common import located, set_aside, small_batches, written
from concord.llm.decontamination import decontaminated
from concord.llm.exact_dedup import exact_dedup
from concord.llm.language_id import held_for_test, identified, learn
from concord.llm.minhash_join import near_duplicates
from concord.llm.packing import cost_balanced_packing


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null text, or no letter in it) go; where ``lang`` is null, it becomes the one identified."""
    small_batches(spark)
    return identified(docs, learn(docs.where(~held_for_test())))


def without(docs: DataFrame, decide) -> DataFrame:
    """The rows of docs that are not among those decided against; both sides see the same places."""
    renamed, names = set_aside(docs)
    places = located(renamed)
    gone = decide(places).where("not kept").select(F.col("__file").alias("__gone_file"), F.col("__row").alias("__gone_row"))
    same = (places["__file"] == gone["__gone_file"]) & (places["__row"] == gone["__gone_row"])
    return places.join(gone, same, "left_anti").select(*renamed.columns).withColumnsRenamed(names)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays."""
    return without(docs, exact_dedup)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five words, a similarity of 0.8."""
    small_batches(spark)
    return without(docs, lambda places: near_duplicates(places, shingle_words=5, percent=80))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    small_batches(spark)
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 2048 tokens."""
    small_batches(spark)
    return cost_balanced_packing(docs)


STAGES = [("language_id", language_id), ("exact_dedup", exact), ("near_dedup", near), ("decontamination", decontamination), ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's frame but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
