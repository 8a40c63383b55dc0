"""Shared plumbing of the training-data operators.

Intermediate tables go to the folder that all machines share
(``spark.checkpoint.dir``), as Parquet: a lost executor loses no finished
step, and the lineage is cut without ``localCheckpoint``.
"""

from __future__ import annotations

import gc
import sys
import tempfile
import types
import uuid
from functools import lru_cache

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where it is unset, a local one of this process, on a local master only."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (found or _own_dir()).rstrip("/")


@lru_cache(maxsize=1)
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="concord-shared-")


def fresh(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no one else uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """df, written once to the shared folder and read from there."""
    spark, path = df.sparkSession, fresh(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder, in whatever store it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class Scratch:
    """Tables that one call writes to the shared folder and removes when no later step reads them."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.path, self.names = spark, fresh(spark, label), {}

    def written(self, df: DataFrame, name: str) -> DataFrame:
        self.names[name] = path = f"{self.path}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            delete(self.spark, self.names.pop(name))

    def release(self) -> None:
        """Let Spark clean up what finished steps have shuffled: it does when the driver's JVM collects garbage, which may be long in coming."""
        gc.collect()
        self.spark._jvm.System.gc()


PLACE = {"place": True}  # metadata of the columns that ``located`` adds


def set_aside(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with its own columns of the names that ``located`` uses renamed, and {new name: own name}."""
    own = [c for c in docs.columns if c in ("__file", "__row") and not docs.schema[c].metadata.get("place")]
    names = {f"__own{c}": c for c in own}
    return docs.withColumnsRenamed({c: n for n, c in names.items()}) if own else docs, names


def plain_scan(df: DataFrame) -> bool:
    """Whether each row is one row of a file, with columns chosen and rows left out at most: after a join or a union places don't tell rows apart."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().apply(0)
    return plan.getClass().getSimpleName() == "LogicalRelation"


def located(docs: DataFrame) -> DataFrame:
    """docs with ``__file`` and ``__row``, which tell equal rows apart and stay the same when a task runs again.

    Rows that come straight from files have a place there; others are written to the shared folder first.
    Columns of docs that have these names are renamed (``set_aside``).
    """
    docs, _ = set_aside(docs)
    if {"__file", "__row"} <= set(docs.columns):
        return docs
    if not plain_scan(docs):
        return located(written(docs, "located"))
    place = [F.col(f"_metadata.{c}").alias(n, metadata=PLACE) for c, n in (("file_path", "__file"), ("row_index", "__row"))]
    try:
        return docs.select("*", *place)
    except AnalysisException:  # a format whose rows have no number
        return located(written(docs, "located"))


def cached(key, make):
    """make(), once in each Python worker: what a task needs and later tasks of the worker need again."""
    held = sys.modules.setdefault("__concord_worker__", types.ModuleType("__concord_worker__")).__dict__.setdefault("held", {})
    if key not in held:
        held[key] = make()
    return held[key]


#: Bytes of a batch that a Python worker is sent. Spark's own limit is rows alone: 10,000 texts of any length, held several times at once.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """From now on Python workers of the session get batches of at most BATCH_BYTES, or of fewer where that is set; a longer row by itself."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def text_of(name: str = "text") -> Column:
    """The text as a string, null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(a, b) edges to (id, root): root is the smallest id reachable; only ids with edges appear.

    Alternating large-star and small-star (Kiveris et al. 2014): every step keeps at most one edge per
    vertex and neighbour, so no list of neighbours is ever gathered. Each round is written to the shared
    folder. An edge's end that is a hub is handled by joins that adaptive execution can split.
    """
    def toward_min(pairs: DataFrame, larger_only: bool) -> DataFrame:
        # pairs (u, v): link neighbours v of u to the least of u and its neighbours
        least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        out = pairs.join(least, "u")
        if larger_only:
            out = out.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = out.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    scratch = Scratch(edges.sparkSession, label)
    first = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    at, now = "0", scratch.written(first, "0")
    mark, step = None, 0
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = toward_min(both, larger_only=True)
        # small star: each u with its smaller neighbours
        small = toward_min(large, larger_only=False)
        step += 1
        now, before, at = scratch.written(small, str(step)), at, str(step)
        scratch.drop(before)
        # done when nothing changes: one aggregate of one row tells, so no other pass over the links is needed
        found = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if found == mark or not found[0]:
            break
        mark = found
    roots = now.select(F.col("v").alias("id")).distinct().withColumn("root", F.col("id"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(roots)
