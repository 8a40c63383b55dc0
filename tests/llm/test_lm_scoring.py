import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from concord.llm import lm_scoring as lm
from concord.llm.common import text_of


def scored(docs, **how):
    docs = docs.select("doc_id", "text").withColumn("held_out", lm.held_out())
    model, counts = lm.learn(docs.where("not held_out").select(text_of().cast("binary").alias("text")), **how)
    return lm.score(docs, model, counts), model, counts


def brute(rows):
    """(n_tokens, n_known, N, base) of each row by its place."""
    tokens = [[*(r.text or "").encode().lower().split(), None] for r in rows]
    c = collections.Counter(t for r, ts in zip(rows, tokens, strict=True) if not r.held_out for t in ts)
    n, v = sum(c.values()), len(c)
    return [(len(ts), sum(c[t] > 0 for t in ts), n, sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts)) for ts in tokens]


@pytest.mark.parametrize("head", [3, lm.HEAD])
def test_base_and_counts(odd, head):
    rows = odd.select("doc_id", "text").withColumn("held_out", lm.held_out()).collect()
    got = scored(odd, head=head, units=2)[0].collect()
    want = sorted((w[0], w[1], w[2], round(w[3], 6)) for w in brute(rows))
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)


@pytest.mark.parametrize(("units", "head"), [(4, 6), (3, 100), (100, 100)])
def test_probabilities_sum_to_one(spark, units, head):
    """After each context: all known words, one unseen word for the event of unseen ones, and the end."""
    texts = ["the cat sat on the mat", "the dog sat.", "a cat and a dog", "on on on"]
    train = spark.createDataFrame([(t,) for t in texts], "text string").select(F.col("text").cast("binary").alias("text"))
    model, counts = lm.learn(train, units=units, head=head)
    reach = [*sorted({w for t in texts for w in t.split()}), "neverseen", ""]
    asked = [(context, w) for context in ("", "cat", "the dog") for w in reach]
    frame = spark.createDataFrame([(k, f"{c} {w}") for k, (c, w) in enumerate(asked)], "doc_id long, text string").withColumn("held_out", F.lit(True))
    value = {asked[r.doc_id]: r.score for r in lm.score(frame, model, counts).collect()}
    table = lm.log10_table(*model.parameters)
    assert np.allclose((10.0 ** table).sum(1), 1, atol=1e-3)
    unit = lambda w: int(model.of[lm.Codes(model.head)[w.encode()]]) if w in reach[:-2] and w.encode() in model.head else None
    for context in ("", "cat", "the dog"):
        last = unit(context.split()[-1]) if context else 0
        last = 0 if last is None else last
        before = value[context, ""] - float(table[last, 0])  # the words of the context, without the end
        mass = 10 ** float(table[last, 0])
        for w in reach[:-1]:
            after = unit(w)
            mass += 10 ** (value[context, w] - before - float(table[last if after is None else after, 0]))
        assert abs(mass - 1) < 2e-3, (context, mass)


def test_beats_the_base_on_held_out_rows(spark):
    """On all tokens, on known ones, and on known words without a unit of their own: not the unseen ones alone."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").withColumn("held_out", lm.held_out())
    model, counts = lm.learn(docs.where("not held_out").select(text_of().cast("binary").alias("text")), units=300)
    got = lm.score(docs, model, counts).where("held_out").toPandas()
    assert (got.score.sum() - got.base_score.sum()) / got.n_tokens.sum() > 0.2
    assert (got.score > got.base_score).mean() > 0.9
    train = {r.text for r in docs.where("not held_out").collect()}
    table, codes = lm.log10_table(*model.parameters), lm.Codes(model.head)
    head, scale = len(model.head), math.log10(model.total + 0.5 * (model.distinct + 1))
    mass = np.log10(model.class_c + model.class_once)
    gains = {"frequent": [], "class": []}
    for r in docs.where("held_out").collect():
        if r.text in train:
            continue
        code = codes.of((r.text or "").encode().lower().split())
        before = lm.carried(np.concatenate([[0], np.where(code < head, model.of[code], -1)]))
        for c, u in zip(code, before):
            if c < head:
                value = float(table[u, model.of[c]])
                if c >= model.own:
                    value += math.log10(model.head_c[c]) - mass[model.of[c] - 1 - model.own]
                gains["frequent" if c < model.own else "class"].append(value - math.log10(model.head_c[c] + 0.5) + scale)
    print({k: (len(v), sum(v) / len(v)) for k, v in gains.items()})
    assert sum(gains["frequent"]) / len(gains["frequent"]) > 0.05 and sum(gains["class"]) / len(gains["class"]) > 0.05


def test_executors_need_not_have_the_package():
    """What tasks get is pickled without a name of the package in it."""
    from pyspark import cloudpickle

    m = lm.Model()
    m.head, m.of = [b"a"], np.zeros(2, np.int64)
    assert b"concord" not in cloudpickle.dumps(dict(vars(m)))


def test_empty(frame):
    assert scored(frame([]))[0].collect() == []
    assert all(abs(r.base_score) < 1e-9 or r.base_score < 0 for r in scored(frame([(None, "x y")]))[0].collect())
