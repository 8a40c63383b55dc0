"""Exact deduplication by a stateful stream.

A digest log (one small row per document: SHA-256 of the normalised text,
the stable id, and the place of the content: file and row) feeds a Structured
Streaming aggregation whose keyed state lives on disk (RocksDB) and never
expires. Per digest the state retains the smallest id, that row's place and
the number of rows. New files add to the same state. The full bytes of the
rows that share a digest are checked against each other and, where an earlier
ingest has the digest, against the content at the place retained from it;
rows that share a digest but not the bytes are grouped anew by their bytes,
those of earlier ingests too, whose files must still be there (Parquet).

Only DataFrame operations: text goes through the executors' JVM alone.

Defined results: a null text is empty; a null id is a row like others and
sorts after all ids; of rows with equal text and id the first by place stays;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm.common import WHITE, fresh, located, text_of, written

#: The state's store; without preallocation an open store takes the disk that it fills and not 4 MB a partition more.
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def keep() -> Column:
    """What the state retains of a row; the least of a group stays."""
    return F.struct("no_id", "doc_id", "__file", "__row")


def normalised(text: Column) -> Column:
    """White space runs become one space; nothing else changes."""
    return F.regexp_replace(text, WHITE, " ")


def sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


class DedupState:
    """The digest log and keyed state below one path; ``ingest`` adds documents, ``groups`` reads the state.

    The log has one folder for each ingest. ``key`` makes the state's key of a digest (a test can give a weak one).
    """

    LOG = "no_id boolean, doc_id {}, __file string, __row long, sha string, batch int"

    def __init__(self, spark: SparkSession, path: str | None = None, key=None, max_bytes_per_trigger: int = 1 << 36):
        self.spark, self.path, self.bytes = spark, path or fresh(spark, "dedup"), max_bytes_per_trigger
        self.key = key or (lambda digest: digest)

    def _schema(self, doc_id: str) -> str:
        return self.LOG.format(doc_id)

    def ingests(self, of: str = "log") -> int:
        """How many ingests have left a table."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{of}")
        fs = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sum(s.getPath().getName().startswith("batch=") for s in fs.listStatus(at)) if fs.exists(at) else 0

    def ingest(self, docs: DataFrame) -> int:
        """Log the digests of docs and run the stream until it has seen all of the log; the ingest's number, from 0."""
        batch, self.id_type = self.ingests(), docs.schema["doc_id"].dataType.simpleString()
        rows = located(docs).select(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__file", "__row", sha(normalised(text_of())).alias("sha"))
        rows.write.parquet(f"{self.path}/log/batch={batch}")
        conf = self.spark.conf
        before = {name: conf.get(name, None) for name in STORE}
        for name, value in STORE.items():
            conf.set(name, value)
        try:
            stream = self.spark.readStream.schema(self._schema(self.id_type)).option("maxBytesPerTrigger", self.bytes).parquet(f"{self.path}/log")
            (
                stream.groupBy(self.key(F.col("sha")).alias("key")).agg(F.min(keep()).alias("keep"), F.count("*").alias("n"))
                .writeStream.outputMode("update").format("noop").option("checkpointLocation", f"{self.path}/state").trigger(availableNow=True)
                .start().awaitTermination()
            )
        finally:
            for name, value in before.items():
                conf.set(name, value) if value is not None else conf.unset(name)
        return batch

    def log(self) -> DataFrame:
        """The rows of all ingests, with their key."""
        return self.spark.read.schema(self._schema(self.id_type)).parquet(f"{self.path}/log").withColumn("key", self.key(F.col("sha")))

    def groups(self) -> DataFrame:
        """key, keep (no_id, doc_id, __file, __row), n: the whole state."""
        state = self.spark.read.format("statestore").load(f"{self.path}/state")
        (key,), (first, second) = (state.schema[c].dataType.names for c in ("key", "value"))
        return state.select(F.col(f"key.{key}").alias("key"), F.col(f"value.{first}").alias("keep"), F.col(f"value.{second}").alias("n"))

    def content(self, places: DataFrame) -> DataFrame:
        """places (__file, __row and others), with norm: the normalised text of the row there, read from its file."""
        files = [r[0] for r in places.select("__file").distinct().collect()]  # as many as files were read, at most
        if not files:
            return places.withColumn("norm", F.lit(""))
        texts = located(self.spark.read.schema("text string").parquet(*files)).select("__file", "__row", normalised(text_of()).alias("norm"))
        return places.join(texts, ["__file", "__row"])

    def check(self, docs: DataFrame, batch: int) -> DataFrame:
        """Keys that stand for several texts, of all ingests; those that the present one brings are found by all its bytes.

        The rows of one key are equal in each earlier ingest, or their key is noted; so of the earlier rows, the content at the
        place that was retained then is enough to hold the new rows against. Equal texts meet before they are exchanged.
        """
        texts = located(docs).select(normalised(text_of()).alias("norm")).select(self.key(sha(F.col("norm"))).alias("key"), "norm")
        if batch:
            log = self.log()
            hit = log.where(F.col("batch") == batch).select("key").distinct()
            retained = log.where(F.col("batch") < batch).join(hit, "key", "left_semi").groupBy("key").agg(F.min(keep()).alias("keep"))
            texts = texts.unionByName(self.content(retained.select("key", "keep.__file", "keep.__row")).select("key", "norm"))
        several = texts.distinct().groupBy("key").agg(F.count("*").alias("texts")).where("texts > 1").select("key")
        several.write.parquet(f"{self.path}/unequal/batch={batch}")
        return self.spark.read.schema("key string, batch int").parquet(f"{self.path}/unequal").select("key").distinct()


def exact_dedup(docs: DataFrame, state: DedupState | None = None) -> DataFrame:
    """doc_id, __file, __row, keep_id, group_size, kept, text_sha256: one row per row of docs and of the state's earlier ingests."""
    state = state or DedupState(docs.sparkSession)
    docs = located(docs).select("doc_id", "text", "__file", "__row")
    batch = state.ingest(docs)
    groups, log = written(state.groups(), "groups"), state.log()
    wrong = state.check(docs, batch)
    kept = F.col("keep.__file").eqNullSafe(F.col("__file")) & F.col("keep.__row").eqNullSafe(F.col("__row"))
    answer = ["doc_id", "__file", "__row", F.col("keep.doc_id").alias("keep_id"), F.col("n").alias("group_size"), kept.alias("kept"), F.col("sha").alias("text_sha256")]
    if wrong.isEmpty():
        return log.join(groups, "key").select(*answer)
    # one key, several texts: those rows, of all ingests, are grouped by their whole bytes
    text = state.content(log.join(wrong, "key", "left_semi"))
    exact = text.groupBy("norm").agg(F.min(keep()).alias("keep"), F.count("*").alias("n"))
    again = text.join(exact, "norm").select(*answer)
    return log.join(wrong, "key", "left_anti").join(groups, "key").select(*answer).unionByName(again)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE = {
    "op1_exact_dedup": r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents),
g AS (SELECT h, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY h)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.h AS text_sha256 FROM d JOIN g USING (h)"""
}
QUERIES = {"op1_exact_dedup": op1_exact_dedup}
