"""The catalogue's queries against their SQL on the smallest tables."""

import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from concord.operators import blocking
from concord.plans import catalog

SF = "/root/testdata/sf0.001"
CHECKED = ("clean_text", "geohash_cells", "coord_precision", "address_norm", "url_domains", "email_extract", "block_pair_counts", "block_rule_summary", "provider_pair_counts", "large_blocks", "token_contributions", "latest_decision", "jaro_winkler", "phone_extract", "blocking_rules", "subgroup_conflicts", "adopted_links", "brand_conflicts", "unit_shares")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return con


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) else round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in found), key=str)


@pytest.mark.parametrize("name", CHECKED)
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    want = duck.sql(catalog.ORACLE[name])
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


def test_every_sql_binds(duck):
    for name, sql in catalog.ORACLE.items():
        duck.sql(f"explain {sql}"), name


def test_chain_with_phones(spark, tmp_path):
    """Two numbers of two records each make pairs; one of six is reused and makes none."""
    texts = ["alpha beta 9876543210", "gamma delta 9876543210", "epsilon zeta 9123456780", "eta theta", "iota kappa 9123456780"]
    texts += [f"many{i} words{i} 9000000001" for i in range(6)]
    rows = [(i, t, "en", f"src{i}", 100 + 700 * i) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    found = catalog.QUERIES["candidate_pairs"](spark, str(tmp_path)).collect()
    want = {("src0::0::0", "src1::1::0"), ("src2::2::0", "src4::4::0")}
    assert {(r.record_id_l, r.record_id_r) for r in found if r.match_key == 3} == want
    levels = {(r.record_id_l, r.record_id_r): r.gamma_phone for r in catalog.QUERIES["gamma_levels"](spark, str(tmp_path)).collect()}
    assert {p for p, level in levels.items() if level == 1} == want
    # codes of other lengths than six are keys of scoring too, and those that only look like a default
    normal = catalog.normalized(spark, str(tmp_path)).records.withColumns({"postal_code_final": F.lit("1234"), "property_name_blocking_tokens": F.array(F.lit("same"))})
    assert blocking.same_city_postal_token(normal).count() == 11 and blocking.same_city_postal_token(normal, "^[1-9][0-9]{5}$").count() == 0


def test_names_are_not_stored_many_times(spark, tmp_path):
    """A query writes what it needs of the chain: before, every query wrote all features, 24 times the input."""
    import random
    from pathlib import Path

    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklmnop", k=8)) for _ in range(3000)]
    rows = [(i, " ".join(rng.choices(words, k=400)), "en", f"src{i % 5}", 2000 + i) for i in range(800)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    size = lambda p: sum(x.stat().st_size for x in Path(p).rglob("*.parquet"))
    shared, given = spark.conf.get("spark.checkpoint.dir"), size(tmp_path / "documents.parquet")
    start = size(shared)
    for name, most in (("name_tokens", 0.01), ("phone_extract", 0.5), ("domain_reuse", 0.5), ("rare_tokens", 2), ("match_tokens", 2.5), ("rare_token_tags", 2.5)):
        assert catalog.QUERIES[name](spark, str(tmp_path)).count() >= 0
        assert size(shared) - start <= most * given, name


def test_statistics_of_few_words(spark, duck, tmp_path):
    """Queries on few words make statistics of these alone: before, of all words by provider, city and cell."""
    from pathlib import Path

    texts = [(i, f"the chain common{i % 3} " + " ".join(f"word{i}x{k}" for k in range(40)), "en fr de".split()[i % 3], f"src{i % 5}", 900 + i) for i in range(300)]
    spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    own = duck.cursor()
    own.sql(f"create or replace temp view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    there = set(shared.iterdir())
    for name, most in (("rare_tokens", 0), ("brand_candidates", 9), ("low_value_tokens", 30)):
        got, want = catalog.QUERIES[name](spark, str(tmp_path)), own.sql(catalog.ORACLE[name])
        assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall()) and got.count() > 0, name
        made = [spark.read.parquet(str(p)).count() for p in shared.iterdir() if p not in there and p.name.startswith(("coverage", "stats"))]
        assert sum(made) <= most, name
