"""Sharding by histogram sort.

Documents are ordered by a key (hash of the text, then hash of id and place, so equal texts are neighbours
and yet divisible). The driver holds a probe set; every round counts the exact bytes and rows below each
probe over all partitions, keeps for each splitter the two probes around its target, and draws new probes
from the keys between them, until each splitter is within tolerance or between two neighbouring rows. Then
the rows are exchanged once, by ranges that hold a bounded number of rows; since the rows below each range
are known exactly, a row's slot in its shard is the range's base plus its rank in the range.

The driver holds probes and counts only: about 64 for each splitter and one for each range.

Defined results: a null text has size 16; null ids and repeated rows are rows like others; an empty table
gives an empty result; shards can be empty when there are fewer rows than shards.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from concord.llm.common import located, partitions, text_of, written

PER_SPLITTER = 64
KEY = 32


def key_of() -> Column:
    """32 hexadecimal digits: a hash of the text, then one of the id and the place."""
    digits = lambda c: F.lpad(F.hex(c), 16, "0")
    return F.concat(digits(F.xxhash64(text_of())), digits(F.xxhash64("doc_id", "__file", "__row")))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and key."""
    text = text_of()
    return located(docs).select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), key_of().alias("key"))


def _keys(column) -> np.ndarray:
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:]
    return np.frombuffer(column.buffers()[2], f"S{KEY}", len(column), int(offsets[0])) if len(column) else np.array([], f"S{KEY}")


def below(keys: DataFrame, probes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows with a key under each probe, and at the end in all; one pass."""
    sorted_probes = np.array(probes, f"S{KEY}")

    def count(batches):
        sizes, rows = np.zeros(len(sorted_probes) + 1, np.int64), np.zeros(len(sorted_probes) + 1, np.int64)
        for b in batches:
            at = np.searchsorted(sorted_probes, _keys(b.column(0)), side="right")
            sizes += np.bincount(at, b.column(1).to_numpy().astype(float), len(sizes)).astype(np.int64)
            rows += np.bincount(at, minlength=len(rows))
        some = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sizes[some]), pa.array(rows[some])], ["bucket", "size", "rows"])

    parts = keys.select("key", "size").mapInArrow(count, "bucket long, size long, rows long")
    sizes, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    for bucket, size, n in parts.groupBy("bucket").agg(F.sum("size"), F.sum("rows")).collect():
        sizes[bucket], rows[bucket] = size, n
    return np.cumsum(sizes), np.cumsum(rows)


def draw(keys: DataFrame, segments: list[tuple[bytes, bytes, float]], seed: int) -> list[bytes]:
    """Keys between each segment's ends, each with the segment's probability."""
    low, high = (np.array([s[i] for s in segments], f"S{KEY}") for i in (0, 1))
    share = np.array([s[2] for s in segments])

    def pick(batches):
        for b in batches:
            k = _keys(b.column(0))
            at = np.maximum(np.searchsorted(low, k, side="right") - 1, 0)
            yes = (k > low[at]) & (k < high[at]) & (b.column(1).to_numpy() < share[at] * (1 << 30))
            yield pa.RecordBatch.from_arrays([pa.array(k[yes].astype(str).tolist(), pa.string())], ["key"])

    chance = F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 << 30)).alias("chance")
    return sorted({r.key.encode() for r in keys.select("key", chance).mapInArrow(pick, "key string").collect()})


def splitters(keys: DataFrame, shards: int, tolerance: float) -> list[bytes]:
    """shards - 1 keys: the bytes below the k-th are k/shards of all, within tolerance of a shard or as near as rows allow."""
    first, last = b"", b"g" * KEY  # below and above all hexadecimal digits
    (total,), (rows,) = below(keys, [])
    targets = [total * k / shards for k in range(1, shards)]
    at = {first: (0, 0), last: (int(total), int(rows))}  # probe: bytes and rows below it
    near = lambda t: min(at, key=lambda p: (abs(at[p][0] - t), p))
    for seed in range(64):
        known = sorted(at)
        below_known = np.array([at[p][0] for p in known])
        segments: dict[tuple[bytes, bytes], int] = {}
        for t in targets:
            if abs(at[near(t)][0] - t) > tolerance * total / shards:
                i = int(np.searchsorted(below_known, t, side="right"))
                ends = known[max(i - 1, 0)], known[min(i, len(known) - 1)]
                if at[ends[1]][1] - at[ends[0]][1] > 1:
                    segments[ends] = segments.get(ends, 0) + 1
        if not segments:
            break
        wanted = [(lo, hi, min(1.0, PER_SPLITTER * n / (at[hi][1] - at[lo][1]))) for (lo, hi), n in sorted(segments.items())]
        probes = [p for p in draw(keys, wanted, seed) if p not in at]
        if not probes:
            if all(share == 1 for *_, share in wanted):
                break  # equal keys only
            continue
        sizes, counts = below(keys, probes)
        at |= {p: (int(s), int(n)) for p, s, n in zip(probes, sizes, counts, strict=False)}
    return [near(t) for t in targets]


@dataclass(frozen=True)
class Cuts:
    """Bounds of ranges of keys, and for each range its shard and the rows below it in the shard."""

    bounds: np.ndarray
    shard: np.ndarray
    base: np.ndarray


def cut(keys: DataFrame, shards: int, tolerance: float, rows_per_range: int) -> Cuts:
    """The splitters of the shards, and finer bounds so that a range has a bounded number of rows."""
    cuts = splitters(keys, shards, tolerance)
    _, rows = below(keys, sorted(set(cuts)))
    share = min(1.0, 4.0 / rows_per_range) if rows[-1] > rows_per_range * shards else 0
    finer = draw(keys, [(b"", b"g" * KEY, share)], 99) if share else []
    bounds = sorted({*cuts, *finer})
    _, counts = below(keys, bounds)
    starts = np.array([0, *counts[:-1]])  # rows below each range
    shard = np.searchsorted(np.array(sorted(cuts), f"S{KEY}"), np.array([b"", *bounds], f"S{KEY}"), side="right")
    first = np.array([starts[np.flatnonzero(shard == s)[0]] if (shard == s).any() else 0 for s in range(shards)])
    return Cuts(np.array(bounds, f"S{KEY}"), shard.astype(np.int32), starts - first[shard])


def placed(rows: DataFrame, cuts: Cuts, key: str) -> DataFrame:
    """rows, exchanged once, with shard and slot; key: the name of their key's column."""
    at, (bounds, shard, base) = rows.columns.index(key), (cuts.bounds, cuts.shard, cuts.base)
    more = StructType([StructField("__range", IntegerType()), StructField("shard", IntegerType()), StructField("__base", LongType())])

    def place(batches):
        for b in batches:
            r = np.searchsorted(bounds, _keys(b.column(at)), side="right")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(r.astype(np.int32)), pa.array(shard[r]), pa.array(base[r])], [*b.schema.names, "__range", "shard", "__base"])

    n = max(partitions(rows.sparkSession), len(bounds) + 1)
    rank = F.expr(f"row_number() over (partition by __range order by `{key}`, doc_id)")
    out = rows.mapInArrow(place, StructType([*rows.schema.fields, *more.fields])).repartition(n, "__range")
    return out.withColumn("slot", F.col("__base") + rank - 1).drop("__base", "__range")


def histogram_shards(docs: DataFrame, shards: int = 40, tolerance: float = 0.0005, rows_per_range: int = 200_000) -> DataFrame:
    """doc_id, size, text_crc32, key, shard, slot for each row of docs."""
    keys = written(keyed(docs), "keys")
    return placed(keys, cut(keys, shards, tolerance, rows_per_range), "key")


def write_shards(docs: DataFrame, path: str, shards: int = 40, tolerance: float = 0.0005, rows_per_range: int = 200_000) -> None:
    """docs, with shard and slot, as one folder for each shard; the texts are exchanged once. Own columns of these names become own_<name>."""
    docs = located(docs.withColumnsRenamed({c: f"own_{c}" for c in ("shard", "slot") if c in docs.columns}))  # once: the keys are made of the places
    cuts = cut(written(keyed(docs).select("key", "size"), "keys"), shards, tolerance, rows_per_range)
    rows = docs.withColumn("__key", key_of()).drop("__file", "__row")
    placed(rows, cuts, "__key").drop("__key").write.partitionBy("shard").parquet(path)


def op2_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return histogram_shards(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op2_histogram_shards": op2_histogram_shards}
