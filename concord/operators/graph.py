"""Connected components of links between records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.sources.checkpoints import written


def components(edges: DataFrame, left: str = "record_id_l", right: str = "record_id_r") -> DataFrame:
    """record_id and root, the least id reachable, for each id in an edge (also in an edge to itself).

    Labels start as ids and fall to the least among neighbours, then to the label's own label (pointer
    jumping), so the number of rounds grows with the logarithm of the longest chain. Each round is one
    aggregate with map-side combine and is written to the shared folder.
    """
    links = written(edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a is not null and b is not null").distinct(), "links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = written(both.select(F.col("a").alias("record_id")).distinct().withColumn("root", F.col("record_id")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("record_id", "b"), "b").groupBy(F.col("a").alias("record_id")).agg(F.min("root").alias("near"))
        # the root hears of the least label that its members see, and members take it
        heard = labels.join(near, "record_id").select(F.col("root").alias("record_id"), F.least("root", "near").alias("near")).groupBy("record_id").agg(F.min("near").alias("near"))
        lowered = labels.join(near, "record_id").select("record_id", F.least("root", "near").alias("root"))
        lowered = lowered.join(heard, "record_id", "left").select("record_id", F.least("root", F.coalesce("near", "root")).alias("root"))
        up = lowered.select(F.col("record_id").alias("root"), F.col("root").alias("up"))
        new = written(lowered.join(up, "root", "left").select("record_id", F.coalesce("up", "root").alias("root")), "labels")
        changed = new.withColumnRenamed("root", "now").join(labels, "record_id").where("now <> root").limit(1).count()
        labels = new
        if not changed:
            return labels
