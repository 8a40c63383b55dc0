"""Language identification by error-correcting output codes.

Each language has a codeword of bits. A binary logistic classifier over hashed byte n-grams (one to four
bytes, lower case) predicts each bit; a document goes to the codeword of least loss, where a bit's loss is
log(1 + exp(-margin)), weighted by the classifier's accuracy on the rows it was fitted on. A document is
flagged ambiguous where the second codeword's loss is near the first's.

The classifier is fitted on a bounded sample: ``per_language`` labelled rows of each language, those of least
hash of the text, read whole. Everything else covers all rows and whole texts. n-gram counts are made on the
executors; the driver gets only the sample's count vectors.

Defined results: a text that is null or has no letter is ``und`` with score 0; null languages are not learned
from; with no labelled rows every document is ``und``; with one language all others are that one; null ids
are held out of learning; repeated rows are rows like others; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


BITS = 12
WIDTH = 1 << BITS
LETTER = re.compile(r"[^\W\d_]")
PIECE = 1 << 20


def buckets(raw: np.ndarray, n: int) -> np.ndarray:
    """The bucket of each n-gram of bytes."""
    m = len(raw) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64)
    code = np.full(m, n, np.uint32)
    for i in range(n):
        code = (code * np.uint32(0x01000193)) ^ raw[i:m + i]
    return ((code ^ (code >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(32 - BITS)).astype(np.int64)


def features(text: bytes) -> np.ndarray:
    """Square roots of the shares of the n-grams, all of a whole text; of length one."""
    raw = np.frombuffer(b" " + text.lower() + b" ", np.uint8).astype(np.uint32)
    total = np.zeros(WIDTH)
    for at in range(0, len(raw), PIECE):  # long texts by the piece, which overlap by three bytes
        for n in (1, 2, 3, 4):
            total += np.bincount(buckets(raw[at:at + PIECE + n - 1], n), minlength=WIDTH)
    total = np.sqrt(total)
    return (total / np.linalg.norm(total)).astype(np.float32)


def codewords(n: int) -> np.ndarray:
    """n rows of bits (1, -1), distinct and far apart: all splits of up to five languages, else a random code of most distance."""
    if n <= 5:
        splits = [[1 if i == 0 or mask >> (i - 1) & 1 else -1 for i in range(n)] for mask in range(2 ** max(n - 1, 0) - 1)]
        return np.array(splits or [[1] * n]).T
    rng, bits = np.random.default_rng(7), int(np.ceil(10 * np.log2(n)))
    codes = [rng.choice([-1, 1], (n, bits)) for _ in range(200)]
    usable = lambda c: (abs(c.sum(0)) < n).all()
    apart = lambda c: min((c[i] != c[j]).sum() for i in range(n) for j in range(i))
    return max(filter(usable, codes), key=apart)


def fit(x: np.ndarray, labels: np.ndarray, n: int, steps: int = 300, rate: float = 0.05, decay: float = 1e-5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights (features and bias by bit), codewords and each bit's weight in decoding."""
    codes = codewords(n)
    target = codes[labels].astype(np.float32)
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    each = (1 / np.bincount(labels, minlength=n).clip(1))[labels][:, None].astype(np.float32) / n
    w = np.zeros((x.shape[1], codes.shape[1]), np.float32)
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):  # Adam on the whole sample
        margin = target * (x @ w)
        grad = x.T @ (-target * each / (1 + np.exp(np.clip(margin, -30, 30)))) + decay * w
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad * grad
        w -= rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
    right = ((target * (x @ w) > 0) * each).sum(0)
    weight = np.log(right.clip(0.51, 0.999) / (1 - right.clip(0.51, 0.999)))
    return w, codes, (weight / weight.sum()).astype(np.float32)


class Identifier:
    """languages, and the classifiers of the bits."""

    def __init__(self, languages: list[str], w: np.ndarray, codes: np.ndarray, weight: np.ndarray):
        self.languages, self.w, self.codes, self.weight = languages, w, codes, weight

    def losses(self, text: bytes) -> np.ndarray:
        margin = np.append(features(text), np.float32(1)) @ self.w
        return (np.log1p(np.exp(-np.clip(self.codes * margin, -30, 30))) * self.weight).sum(1)

    def predict(self, text: bytes | None) -> tuple[str, float, bool]:
        """Language, score (a probability from the losses) and whether it's ambiguous."""
        if text is None or not self.languages or not LETTER.search(text.decode("utf-8", "replace")):
            return "und", 0.0, False
        loss = self.losses(text)
        p = np.exp(-4 * (loss - loss.min()))
        order = np.argsort(loss, kind="stable")
        return self.languages[order[0]], float(p[order[0]] / p.sum()), len(loss) > 1 and bool(loss[order[1]] - loss[order[0]] < 0.1)


def learn(docs: DataFrame, per_language: int = 400, most_languages: int = 200) -> Identifier:
    """Fit on the rows of docs that have a language; at most per_language of each. More than most_languages are an error.

    What the driver gathers, 16 KB a row of the sample, is bounded by the two.
    """
    row = F.expr("row_number() over (partition by __lang, __salt order by __hash)")
    sample = docs.where("lang is not null and text is not null").select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("__lang"), F.xxhash64("text").alias("__hash"))
    languages = sample.select("__lang").distinct().limit(most_languages + 1).count()
    if languages > most_languages:
        raise ValueError(f"over {most_languages} languages")
    # first within 64 salts of a language, then among those that are left: no task sorts a whole language
    sample = sample.withColumn("__salt", F.pmod("__hash", F.lit(64))).select("__lang", "__salt", "__hash", "text")
    few = sample.select("__lang", "__salt", "__hash").distinct().withColumn("__n", row).where(f"__n <= {per_language}").withColumn("__salt", F.lit(0)).withColumn("__n", row).where(f"__n <= {per_language}").select("__lang", "__hash")
    chosen = sample.join(few, ["__lang", "__hash"], "left_semi").dropDuplicates(["__lang", "__hash"])

    def vectors(batches):
        for b in batches:
            found = [(lang, h, features(t.encode())) for lang, h, t in zip(*(c.to_pylist() for c in b.columns), strict=True) if LETTER.search(t)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found]) for i in (0, 1)] + [pa.array([f[2].tobytes() for f in found], pa.binary())], ["lang", "hash", "x"])

    rows = chosen.select("__lang", "__hash", "text").mapInArrow(vectors, "lang string, hash long, x binary").toArrow().sort_by([("lang", "ascending"), ("hash", "ascending")])
    languages = sorted(set(rows["lang"].to_pylist()))
    if not languages:
        return Identifier([], np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0))
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), np.float32).reshape(len(rows), WIDTH)
    return Identifier(languages, *fit(x, np.array([languages.index(lang) for lang in rows["lang"].to_pylist()]), len(languages)))


def identify(docs: DataFrame, model: Identifier, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns to keep, with lang_pred, score and ambiguous; the text alone decides."""
    fields = [docs.schema[c] for c in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", lang_pred string, score double, ambiguous boolean"
    names = [*keep, "lang_pred", "score", "ambiguous"]

    def run(batches):
        for b in batches:
            found = [model.predict(None if t.as_py() is None else t.as_buffer().to_pybytes()) for t in b.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())], names)

    return docs.select(*keep, F.col("text").cast("string").cast("binary").alias("__text")).mapInArrow(run, schema)


def identified(docs: DataFrame, model: Identifier) -> DataFrame:
    """The rows of docs that get a language, with all their columns and no others; where ``lang`` is null it is the one predicted."""
    at = docs.columns.index("text")
    known = docs.columns.index("lang") if "lang" in docs.columns else None

    def run(batches):
        for b in batches:
            found = [model.predict(None if t.as_py() is None else t.as_buffer().to_pybytes())[0] for t in b.column(at)]
            if known is not None:
                said = b.column(known)
                b = b.set_column(known, b.schema.field(known), pc.coalesce(said, pa.array(found, said.type)))
            yield b.filter(pa.array([x != "und" for x in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_for_test():
    """Rows that nothing is learned from: a remainder of 2, and null ids."""
    return F.coalesce(remainder(4) == 2, F.lit(True))


def remainder(n: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs.where(~held_for_test()))
    found = identify(docs.select("text", "doc_id"), model)
    return found.select("doc_id", held_for_test().alias("held_out"), "lang_pred", "score", "ambiguous")


QUERIES = {"op5_language_id": op5_language_id}
