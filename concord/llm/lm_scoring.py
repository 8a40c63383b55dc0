"""Scoring of texts by a log-bilinear neural language model.

Tokens are words between white space, A-Z lowered, and an end. The neural part predicts units: the ``units`` most
frequent words and the end, one unit each; ``CLASSES`` classes of the other words of the head; and one for all words
beyond the head. A unit's score in the context of the unit before it is ``r_unit . q_context + b_unit`` (Mnih and
Hinton, 2007). The parameters are trained in numpy by noise-contrastive estimation (Mnih and Teh, 2012) on the counts
of unit pairs over all training rows; the expectation over noise from the unit frequencies is taken exactly instead of
by draws, so training is deterministic. Batched matrix products over all units give normalised log-probabilities.

The classes are learned: frequent words are grouped by what follows them, each other word of the head is counted
under the group of the last frequent word before it, over all training rows, and words of like counts are a class.

Within a class a word has its share of the class. The words never seen are one event, as in the base: its probability in
a context is the sum over classes of the class's probability and of the share of it that the words seen once suggest
(Good-Turing). So known words, the end and that event add up to one in each context. An unseen word leaves the context
as it is.

Counts of words, of unit pairs and of words by group cover all training rows and are summed before they are exchanged.
A task holds the ``head`` most frequent words, a bound that is a parameter; the counts of other words are joined. What
tasks get are plain lists and arrays: executors need not have this package.

Defined results: a null or empty text is an end alone; null ids are held out; repeated rows are scored each;
with nothing to learn from, all units are equally likely; an empty table gives an empty result.
"""

from __future__ import annotations

import collections
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm.common import text_of, written

UNITS, HEAD, CLASSES, WIDTH, NOISE, GROUPS = 1400, 150_000, 144, 48, 10, 16
FLUSH = 300_000


def word_counts(texts: DataFrame) -> DataFrame:
    """word (binary) and c over all texts."""

    def run(batches):
        found = collections.Counter()
        out = lambda: pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "c"])
        for b in batches:
            for text in b.column(0):
                found.update(text.as_buffer().to_pybytes().lower().split())
                if len(found) > FLUSH:
                    yield out()
                    found.clear()
        yield out()

    return texts.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Codes(dict):
    """Code of a word: its rank in the head, or len(head) for all others."""

    def __init__(self, head: list[bytes]):
        self.update(zip(head, range(len(head)), strict=True))
        self.other = len(head)

    def __missing__(self, word: bytes) -> int:
        return self.other

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def carried(marks: np.ndarray) -> np.ndarray:
    """For each place the last mark before it that is not negative; the first place has one."""
    at = np.maximum.accumulate(np.where(marks >= 0, np.arange(len(marks)), 0))
    return marks[at]


def pair_counts(texts: DataFrame, head: list[bytes], of: np.ndarray, n: int) -> np.ndarray:
    """Counts of (unit before, unit), over all texts; an end stands before the first word. of: each head word's unit and, last, that of others."""
    sent = texts.sparkSession.sparkContext.broadcast((head, of))

    def run(batches):
        head, of = sent.value
        codes, total = Codes(head), np.zeros(n * n, np.int64)
        for b in batches:
            parts = []
            for text in b.column(0):
                parts += [np.zeros(1, np.int64), of[codes.of(text.as_buffer().to_pybytes().lower().split())]]
                if len(parts) > 2000:
                    total += pairs_in(parts, n)
                    parts = []
            total += pairs_in(parts, n)
        yield from cells(total, "pair")

    table = texts.mapInArrow(run, "pair int, c long").groupBy("pair").agg(F.sum("c").alias("c")).toArrow()
    return dense(table, "pair", n * n).reshape(n, n)


def group_counts(texts: DataFrame, head: list[bytes], group: np.ndarray, groups: int) -> np.ndarray:
    """For each head word how often the last frequent word before it was of each group; group: -1 for words that aren't frequent."""
    sent, n = texts.sparkSession.sparkContext.broadcast((head, group)), len(head)

    def run(batches):
        head, group = sent.value
        codes, total = Codes(head), np.zeros((n + 1) * groups, np.int32)
        for b in batches:
            for text in b.column(0):
                code = codes.of(text.as_buffer().to_pybytes().lower().split())
                if len(code):
                    before = carried(np.append(0, group[code]))[:-1]
                    np.add.at(total, code * groups + before, 1)
        total[n * groups:] = 0
        yield from cells(total, "cell")

    table = texts.mapInArrow(run, "cell int, c long").groupBy("cell").agg(F.sum("c").alias("c")).toArrow()
    return dense(table, "cell", n * groups).reshape(n, groups)


def cells(total: np.ndarray, name: str):
    """The cells of a table that aren't empty, in batches."""
    some = np.flatnonzero(total)
    for at in range(0, len(some), 1 << 16):
        part = some[at:at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part].astype(np.int64))], [name, "c"])


def dense(table: pa.Table, name: str, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    out[table[name].to_numpy()] = table["c"].to_numpy()
    return out


def clusters(rows: np.ndarray, weight: np.ndarray, k: int, steps: int = 12) -> np.ndarray:
    """Groups of rows of counts by k-means on the square roots of their shares; the start is spread by farthest rows."""
    if len(rows) <= k:
        return np.arange(len(rows))
    x = np.sqrt((rows + rows.sum(0) / max(rows.sum(), 1)) / (rows.sum(1, keepdims=True) + 1)).astype(np.float32)
    seeds, far = [int(weight.argmax())], np.full(len(x), np.inf, np.float32)
    while len(seeds) < k:
        far = np.minimum(far, ((x - x[seeds[-1]]) ** 2).sum(1))
        seeds.append(int((far * np.sqrt(weight)).argmax()))
    centre = x[seeds]
    for _ in range(steps):
        of = np.concatenate([(x[at:at + 8192] @ centre.T * 2 - (centre**2).sum(1)).argmax(1) for at in range(0, len(x), 8192)])
        mass = np.bincount(of, weight, k)
        for d in range(x.shape[1]):
            centre[:, d] = np.where(mass > 0, np.bincount(of, weight * x[:, d], k) / np.maximum(mass, 1e-9), centre[:, d])
    return of


def pairs_in(parts: list[np.ndarray], n: int) -> np.ndarray:
    """Pairs of a run of texts, each with its end before it; the last one's end follows."""
    if not parts:
        return np.zeros(n * n, np.int64)
    units = np.concatenate([*parts, np.zeros(1, np.int64)])
    return np.bincount(units[:-1] * n + units[1:], minlength=n * n)


def train(pairs: np.ndarray, width: int = WIDTH, noise: int = NOISE, steps: int = 250, rate: float = 0.05) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context vectors, unit vectors and biases."""
    n = len(pairs)
    total = max(pairs.sum(), 1)
    q = (pairs.sum(0) + 0.5) / (pairs.sum() + 0.5 * n)
    rng = np.random.default_rng(5)
    f = np.float32
    p = [(rng.standard_normal((n, width)) * 0.1).astype(f), (rng.standard_normal((n, width)) * 0.1).astype(f), np.log(q).astype(f)]
    # each context's share, tempered so that rarer contexts are learned in as many steps
    seen = pairs.sum(1, keepdims=True)
    share = np.sqrt(seen / total)
    data = (pairs / np.maximum(seen, 1) * share).astype(f)
    against = (noise * q[None, :] * share).astype(f)
    shift = np.log(noise * q).astype(f)
    mean, square = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
    for t in range(1, steps + 1):
        delta = p[0] @ p[1].T + p[2] - shift
        true = 1 / (1 + np.exp(-np.clip(delta, -30, 30)))
        g = true * against - (1 - true) * data
        grads = [g @ p[1] + f(1e-6) * p[0], g.T @ p[0] + f(1e-6) * p[1], g.sum(0)]
        step = rate * (1 - t / (steps + 1))
        for x, d, m, s in zip(p, grads, mean, square, strict=True):
            m += 0.1 * (d - m)
            s += 0.001 * (d * d - s)
            x -= step * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + f(1e-9))
    return tuple(p)


def log10_table(context: np.ndarray, unit: np.ndarray, bias: np.ndarray, batch: int = 256) -> np.ndarray:
    """Normalised log10-probability of each unit in each context, by batches of contexts."""
    out = np.empty((len(context), len(unit)), np.float32)
    for at in range(0, len(context), batch):
        logits = context[at:at + batch] @ unit.T + bias
        top = logits.max(1, keepdims=True)
        out[at:at + batch] = (logits - top - np.log(np.exp(logits - top).sum(1, keepdims=True))) / math.log(10)
    return out


class Model:
    """head: the words that tasks know; of: their units and, last, the unit of others; own: how many have a unit each.

    class_c, class_once: tokens, and words seen once, of each class, the last for the words beyond the head.
    """


def learn(texts: DataFrame, units: int = UNITS, head: int = HEAD) -> tuple[Model, DataFrame]:
    """The model, and the counts of all words as a table in the shared folder."""
    counts = written(word_counts(texts), "words")
    ends = texts.count()
    level = F.floor(16 * F.log2("c"))
    levels = sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("n"), F.sum("c").alias("c"), F.count_if(F.col("c") == 1).alias("once")).collect(), reverse=True)
    least, held = math.inf, 0
    for r in levels:
        held += r.n
        if held > head:
            break
        least = r.level
    top = counts.where(level >= least).toArrow() if levels and least < math.inf else None
    order = sorted(zip(top["c"].to_pylist(), top["word"].to_pylist(), strict=True), key=lambda x: (-x[0], x[1])) if top else []
    m = Model()
    m.head, m.head_c = [w for _, w in order], np.array([c for c, _ in order], np.int64)
    m.ends, m.total = ends, sum(r.c for r in levels) + ends
    m.distinct = sum(r.n for r in levels) + (ends > 0)
    m.own = own = min(units, len(m.head))
    # units: the end, frequent words, classes, words beyond the head
    rest = classes_of(texts, m)
    m.n = 1 + own + CLASSES + 1
    m.of = np.concatenate([1 + np.arange(own), 1 + own + rest, [m.n - 1]]).astype(np.int64)
    m.parameters = train(pair_counts(texts, m.head, m.of, m.n))
    m.class_c, m.class_once = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    np.add.at(m.class_c, rest, m.head_c[own:])
    np.add.at(m.class_once, rest, m.head_c[own:] == 1)
    beyond = [r for r in levels if r.level < least]
    m.class_c[-1], m.class_once[-1] = sum(r.c for r in beyond), sum(r.once for r in beyond)
    m.class_once = np.maximum(m.class_once, 0.5)
    return m, counts


def classes_of(texts: DataFrame, m: Model) -> np.ndarray:
    """The class of each head word without a unit of its own."""
    own, rest = m.own, m.head_c[m.own:]
    if not len(rest):
        return np.zeros(0, np.int64)
    first = np.concatenate([1 + np.arange(own), np.full(len(rest) + 1, own + 1)]).astype(np.int64)
    follow = pair_counts(texts, m.head, first, own + 2)
    frequent = min(own, 400)  # what follows by the most frequent words tells enough
    groups = clusters(follow[1:own + 1, 1:frequent + 1].astype(float), m.head_c[:own].astype(float), GROUPS)
    group = np.concatenate([groups, np.full(len(rest) + 1, -1)]).astype(np.int64)
    seen = group_counts(texts, m.head, group, GROUPS)
    return clusters(seen[own:].astype(float), rest.astype(float), CLASSES)


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, words array<binary>, times array<int>, known array<double>, unseen array<double>"


def score(docs: DataFrame, m: Model, counts: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of docs, which has held_out."""
    sent = docs.sparkSession.sparkContext.broadcast(dict(vars(m)))
    scale = math.log10(m.total + 0.5 * (m.distinct + 1))

    def run(batches):
        v = sent.value
        head, n, own, of = len(v["head"]), v["n"], v["own"], v["of"]
        table, codes = log10_table(*v["parameters"]), Codes(v["head"])
        mass = v["class_c"] + v["class_once"]
        # an unseen word in each context: what the words seen once are of each class
        unseen = np.log10((10.0 ** table[:, 1 + own:].astype(np.float64)) @ (v["class_once"] / mass))
        table = table.ravel()
        base = np.append(np.log10(v["head_c"] + 0.5) - scale, 0.0)
        within = np.concatenate([np.zeros(own), np.log10(v["head_c"][own:]) - np.log10(mass)[of[own:head] - 1 - own], [0.0]])
        end_base = math.log10(v["ends"] + 0.5) - scale
        for b in batches:
            rows = []
            for doc_id, held, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                words = text.as_buffer().to_pybytes().lower().split()
                code = codes.of(words)
                unit = np.concatenate([[0], of[code], [0]])
                # a word beyond the head leaves the context as it is
                before = carried(np.concatenate([[0], np.where(code < head, of[code], -1)]))
                gain = table[before * n + unit[1:]].astype(np.float64)
                at = np.flatnonzero(code >= head)
                rare: dict[bytes, list] = {}
                for i in at.tolist():
                    found = rare.setdefault(words[i], [0, 0.0, 0.0])
                    found[0] += 1
                    found[1] += float(gain[i])
                    found[2] += float(unseen[before[i]])
                gain[at] = 0
                rows.append((
                    doc_id, held, len(words) + 1, len(words) - len(at) + (v["ends"] > 0), float(base[code].sum()) + end_base, float(gain.sum() + within[code].sum()),
                    list(rare), *([x[k] for x in rare.values()] for k in range(3)),
                ))
            types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 10, types, strict=True)], [x.split()[0] for x in SCORED.split(", ")])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", text_of().cast("binary").alias("text")).mapInArrow(run, SCORED)
    rows = written(rows.withColumn("__id", F.monotonically_increasing_id()), "scored")
    rare = rows.select("__id", F.explode(F.arrays_zip("words", "times", "known", "unseen")).alias("x")).select("__id", F.col("x.words").alias("word"), F.col("x.times").alias("n"), F.col("x.known").alias("if_known"), "x.unseen")
    joined = rare.join(counts, "word", "left")
    known = F.col("c").isNotNull()
    beyond = math.log10(float(m.class_c[-1] + m.class_once[-1]))
    more = joined.groupBy("__id").agg(
        F.sum(F.when(known, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * (F.log10(F.coalesce("c", F.lit(0)) + 0.5) - scale)).alias("more_base"),
        F.sum(F.when(known, F.col("if_known") + F.col("n") * (F.log10("c") - beyond)).otherwise(F.col("unseen"))).alias("more_score"),
    )
    zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    return rows.drop("words", "times", "known", "unseen").join(more, "__id", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + zero("more_known")).cast("long").alias("n_known"), F.lit(m.total).cast("long").alias("train_tokens"),
        (F.col("base") + zero("more_base")).alias("base_score"), (F.col("score") + zero("more_score")).alias("score"),
    )


def held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1, F.lit(True))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").withColumn("held_out", held_out())
    model, counts = learn(docs.where(~F.col("held_out")).select(text_of().cast("binary").alias("text")))
    return score(docs, model, counts)


QUERIES = {"op3_lm_scoring": op3_lm_scoring}
