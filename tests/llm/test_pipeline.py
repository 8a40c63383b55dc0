import random

import pytest

import corpus_pipeline as pipeline
from concord.llm.histogram_shards import write_shards

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def folder(spark, tmp_path):
    """Clean documents, and one of each kind that a stage takes out."""
    rng = random.Random(9)
    words = [f"{a}{b}{c}" for a in ("ka", "to", "mi", "ru") for b in ("le", "no", "sa") for c in ("n", "ri", "x", "do")]
    clean = [(i, " ".join(rng.choice(words) for _ in range(60)), "en") for i in range(1, 13)]
    item = " ".join(f"bench{i}" for i in range(20))
    near = clean[1][1].split()
    near[-1] = "other"
    rows = clean + [
        (100, None, "en"), (101, "", None), (102, "12 34 !!", "en"), (103, clean[0][1].replace(" ", "\n", 1), "en"), (104, " ".join(near), "en"), (105, f"lead {item} tail", "en"), (None, " ".join(rng.choice(words) for _ in range(40)), None),
    ]
    path = str(tmp_path)
    spark.createDataFrame([(*r, "s", len(r[1] or "")) for r in rows], COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, {r[0] for r in clean} | {None}


def test_stages(spark, folder):
    path, keep = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    gone = {}
    for name, stage in pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.collect()}
        out = stage(spark, docs, path)
        assert out.columns == docs.columns
        out.write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        gone[name] = before - {r.doc_id for r in docs.collect()}
    assert gone == {"language_id": {100, 101, 102}, "exact_dedup": {103}, "near_dedup": {104}, "decontamination": {105}}
    assert {r.doc_id for r in docs.collect()} == keep
    packed = pipeline.run(spark, path).collect()
    assert {r.doc_id for r in packed} == keep


def test_empty(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    docs.where("false").write.parquet(f"{path}/none/documents.parquet")
    spark.read.parquet(f"{path}/benchmark.parquet").where("false").write.parquet(f"{path}/none/benchmark.parquet")
    assert pipeline.run(spark, f"{path}/none").collect() == []


def test_stages_of_a_created_frame(spark, folder, tmp_path):
    path, _ = folder
    words = [f"word{i}" for i in range(80)]
    rows = [(1, " ".join(words)), (2, " ".join(words)), (3, " ".join([*words[:-1], "other"])), (4, "quite another text")]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], COLUMNS)
    ids = lambda df: sorted(r.doc_id for r in df.collect())
    assert ids(pipeline.exact(spark, docs, path)) == [1, 3, 4]
    assert ids(pipeline.near(spark, docs, path)) == [1, 4]
    write_shards(docs, f"{tmp_path}/shards", shards=2)
    assert ids(spark.read.parquet(f"{tmp_path}/shards")) == [1, 2, 3, 4]


def test_odd_rows(spark, folder, tmp_path):
    """Very long texts, ties, repeated rows, null ids, and extra columns with the operators' own names."""
    path, _ = folder
    rng = random.Random(4)
    vocabulary = [f"{a}{b}" for a in ("ka", "to", "mi", "ru", "bel") for b in ("len", "no", "sar", "x", "dom")]
    long = " ".join(rng.choice(vocabulary) for _ in range(30_000))
    rows = [(1, long, "en"), (2, long, "en"), (2, long, "en"), (None, long, None), (3, long + " one word more", "en"), (4, "ein anderer Text", None), (4, "ein anderer Text", None), (None, None, "en"), (5, "", "en"), (6, "the text of a language", "en")]
    extra = "__file string, __row long, kept string, key string, batch int, n long, set_id string"
    docs = spark.createDataFrame([(*r, "s", 1, "f", 7, "k", "x", 3, 9, "z") for r in rows], f"{COLUMNS}, {extra}")
    docs.write.parquet(f"{tmp_path}/docs")
    ids = {"language_id": [1, 2, 2, 3, 4, 4, 6, None], "exact_dedup": [1, 3, 4, 6], "near_dedup": [1, 4, 6], "decontamination": [1, 4, 6]}
    docs = spark.read.parquet(f"{tmp_path}/docs")
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        found = docs.collect()
        assert sorted((r.doc_id for r in found), key=lambda x: (x is None, x)) == ids[name]
        assert all((r["__file"], r["__row"], r.kept, r.key, r.batch, r.n, r.set_id) == ("f", 7, "k", "x", 3, 9, "z") for r in found)
        assert all(r.lang == "en" for r in found)  # filled where it was null: the one language known
    assert sum(r.length for r in pipeline.packing(spark, docs, path).collect()) > 30_000


def test_python_workers_get_small_batches(spark):
    """Texts go to Python workers by the bytes: before, by 10,000 rows of any length."""
    import pyarrow as pa

    from concord.llm.common import BATCH_BYTES, small_batches

    name = "spark.sql.execution.arrow.maxBytesPerBatch"

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    given = spark.conf.get(name)
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('ab cd ', 1000) as text", "'en' as lang").coalesce(1)
    try:
        pipeline.packing(spark, docs, "")
        found = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
        assert sum(found) > 4 * BATCH_BYTES and max(found) < 1.5 * BATCH_BYTES
        spark.conf.set(name, "1m")
        small_batches(spark)
        assert spark.conf.get(name) == "1m"  # a smaller limit stays
    finally:
        spark.conf.set(name, given)
