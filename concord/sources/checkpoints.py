"""Frames written to the folder that all machines share, in place of long lineages."""

from __future__ import annotations

import gc
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame


@lru_cache(maxsize=1)
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="concord-shared-")


def written(df: DataFrame, label: str) -> DataFrame:
    """df, written once below ``spark.checkpoint.dir`` and read from there. Where that is unset, a new local folder, on a local master only."""
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _own_dir()
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def step(df: DataFrame, label: str) -> DataFrame:
    """df, written; the shuffle files of this and of finished steps go, which else stay until the driver happens to collect its garbage."""
    out = written(df, label)
    del df
    gc.collect()
    out.sparkSession._jvm.System.gc()
    return out
