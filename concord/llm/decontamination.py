"""Benchmark decontamination by spaced seeds.

Words (lower case, letters and digits only) are hashed in windows under three fixed masks of seven positions
in a span of at most ten; the positions left out may differ. Any 13 words in a row with at most two
substitutions agree under at least one mask. Training windows are looked up among the benchmark's; each hit
gives a diagonal (document place less item place), on which the longest stretch with at least the wanted
share of equal words is the overlap. Stretches of at least ``min_words`` count. Items shorter than that must
appear whole and unchanged; items of under four words are no evidence and match nothing.

The benchmark is taken in blocks of bounded size, each sent to all tasks and held against all whole
documents. No row is exchanged.

Defined results: null or empty texts match nothing; null ids and repeated rows are rows like others; empty
tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm.common import text_of
from concord.llm.words import WordHash, windows

MASKS = ((0, 1, 2, 4, 5, 6, 8), (0, 1, 2, 4, 7, 8, 9), (0, 3, 4, 5, 7, 8, 9))
MIN_WORDS, SHARE, LEAST_ITEM = 13, 0.8, 4
BLOCK_WORDS = 2_000_000
TABLE_BITS = 22
SCHEMA = "doc_id long, item_id long, doc_start long, item_start long, n_words long, n_matched long"


class Block:
    """Seeds of some benchmark items: sorted hashes with their item and place, for each mask."""

    def __init__(self, items: list[tuple[int | None, str]], min_words: int = MIN_WORDS, share: float = SHARE):
        hasher = WordHash(plain_words=True)
        self.min_words, self.share = min_words, share
        self.ids, self.words = [i for i, _ in items], [hasher.of((t or "").encode()) for _, t in items]
        short = sorted({len(w) for w in self.words if LEAST_ITEM <= len(w) < min_words})
        self.tables = []
        for offsets, fits in [(m, lambda n: n >= min_words) for m in MASKS] + [(tuple(range(n)), n.__eq__) for n in short]:
            seeds = [(windows(w, offsets), k) for k, w in enumerate(self.words) if fits(len(w))]
            h = np.concatenate([s for s, _ in seeds] or [np.zeros(0, np.uint64)])
            item = np.repeat([k for _, k in seeds], [len(s) for s, _ in seeds]).astype(np.int64)
            place = np.concatenate([np.arange(len(s)) for s, _ in seeds] or [np.zeros(0, np.int64)])
            order = np.argsort(h, kind="stable")
            known = np.zeros(1 << TABLE_BITS, bool)
            known[h >> np.uint64(64 - TABLE_BITS)] = True
            self.tables.append((offsets, h[order], item[order], place[order], known))

    def overlaps(self, doc: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(item, doc_start, item_start, n_words, n_matched): the longest overlap with each item."""
        diagonals = set()
        for offsets, h, item, place, known in self.tables:
            seeds = windows(doc, offsets)
            at = np.flatnonzero(known[seeds >> np.uint64(64 - TABLE_BITS)]) if len(h) else []
            if not len(at):
                continue
            lo, hi = np.searchsorted(h, seeds[at], "left"), np.searchsorted(h, seeds[at], "right")
            for p, a, b in zip(at[hi > lo], lo[hi > lo], hi[hi > lo], strict=True):
                diagonals.update((int(k), int(p) - int(q)) for k, q in zip(item[a:b], place[a:b], strict=True))
        best: dict[int, tuple] = {}
        for k, shift in sorted(diagonals):
            found = self.stretch(doc, self.words[k], shift)
            if found and (k not in best or found[2] > best[k][2]):
                best[k] = found
        return [(k, *v) for k, v in sorted(best.items())]

    def stretch(self, doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int, int] | None:
        """The longest stretch on a diagonal that starts and ends with equal words and has the share of them."""
        lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
        same = doc[lo + shift:hi + shift] == item[lo:hi]
        need = min(self.min_words, len(item))
        share = self.share if len(item) >= self.min_words else 1.0
        gain = np.concatenate([[0.0], np.cumsum(same - share + 1e-9)])
        # for each end the first begin with no higher sum, by bisection in the falling prefix minima
        begins = np.searchsorted(-np.minimum.accumulate(gain), -gain, side="left")
        lengths = np.arange(len(gain)) - begins
        end = len(gain) - 1 - int(lengths[::-1].argmax())
        best = (int(begins[end]), end)
        at = np.flatnonzero(same[best[0]:best[1]]) + best[0]
        if not len(at) or at[-1] - at[0] + 1 < need:
            return None
        return int(at[0] + lo + shift), int(at[0] + lo), int(at[-1] - at[0] + 1), len(at)


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS):
    """The items, in lists of at most block_words words (a longer item by itself)."""
    held, words = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), text_of().alias("text")).toLocalIterator():
        n = row.text.count(" ") + row.text.count("\n") + 1
        if held and words + n > block_words:
            yield held
            held, words = [], 0
        held.append((row.item_id, row.text))
        words += n
    if held:
        yield held


def overlaps(docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS, share: float = SHARE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, item_id, doc_start, item_start, n_words, n_matched: for each row of docs and each item in it, the longest overlap."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().cast("binary").alias("text"))
    spark = docs.sparkSession

    def against(items):
        sent = spark.sparkContext.broadcast(items)

        def run(batches):
            block, hasher = Block(sent.value, min_words, share), WordHash(plain_words=True)
            for b in batches:
                rows = []
                for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    rows += [(doc_id, block.ids[k], *rest) for k, *rest in block.overlaps(hasher.of(text.as_buffer().to_pybytes()))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], SCHEMA.replace(" long", "").split(", "))

        return texts.mapInArrow(run, SCHEMA)

    out = None
    for items in blocks(benchmark, block_words):
        found = against(items)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], SCHEMA) if out is None else out


def decontaminated(docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS, share: float = SHARE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of docs without an overlap, with all their columns and no others; the benchmark's blocks one after the other."""
    at = docs.columns.index("text")
    spark = docs.sparkSession

    def clean_of(items):
        sent = spark.sparkContext.broadcast(items)

        def run(batches):
            block, hasher = Block(sent.value, min_words, share), WordHash(plain_words=True)
            for b in batches:
                clean = [t.as_py() is None or not block.overlaps(hasher.of(t.as_buffer().to_pybytes())) for t in b.column(at)]
                yield b.filter(pa.array(clean, pa.bool_()))

        return run

    out = docs
    for items in blocks(benchmark, block_words):
        out = out.mapInArrow(clean_of(items), docs.schema)
    return out


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {"op9_decontamination": op9_decontamination}
