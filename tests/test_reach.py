"""Pairs that can score a floor, against all candidate pairs scored."""

import random

import pytest
from pyspark.sql import functions as F

from concord.operators import blocking, gate, reach, scoring, tokens

MODEL = scoring.Model(scoring.FIXED.m, scoring.FIXED.u, 1e-3)
TYPES = "record_id string, provider string, country_code_norm string, city_name_norm string, postal_code_final string, cell string, cell_wide string, names array<string>, lat_norm double, lng_norm double, phone_last10_non_reused_list array<string>, email_norm_list array<string>, website_domain_norm string, website_reused_flag boolean, hotel_chain_norm string, star_rating_norm double"


def records(spark):
    """Some places with names that have few to all words in common, contacts, and fields that are missing."""
    r = random.Random(5)
    stock, bases = [f"word{i}" for i in range(60)], []
    for _ in range(12):
        bases.append(r.sample(stock, r.randint(1, 20)))
    rows = []
    for i in range(400):
        names = [w if r.random() < r.choice((1, 0.9, 0.6)) else r.choice(stock) for w in r.choice(bases)]
        maybe = lambda x, p=0.8: x if r.random() < p else None
        at = maybe((r.randint(0, 3), r.randint(0, 3)))
        rows.append((f"r{i:03}", maybe(f"p{r.randint(0, 4)}", 0.98), maybe("XX", 0.95), maybe(f"c{r.randint(0, 2)}"), maybe(f"{r.randint(0, 9)}"), at and "k", at and "w", list(dict.fromkeys(names)) if r.random() < 0.95 else [], at and 10 + at[0] / 4000, at and 20 + at[1] / 4000,
                     maybe([f"t{r.randint(0, 99)}"] * r.randint(0, 1)), maybe([f"e{r.randint(0, 60)}"] * r.randint(0, 1), 0.9), maybe(f"d{r.randint(0, 90)}"), r.random() < 0.3, maybe(f"h{r.randint(0, 1)}"), maybe(float(r.randint(1, 5)))))
    signature = F.md5(F.array_join(F.array_sort("names"), " "))
    return spark.createDataFrame(rows, TYPES).select("*", F.col("names").alias("property_name_match_tokens"), F.slice("names", 1, 3).alias("property_name_blocking_tokens"), *(F.when(F.size("names") > 0, signature).otherwise("").alias(c) for c in ("property_name_signature", "property_name_match_signature")), F.lit(False).alias("website_weak_domain_flag"), F.lit(False).alias("lat_lng_low_precision"), F.lit("hotel").alias("property_type_norm")).drop("names")


@pytest.mark.parametrize("floor", [0.001, 0.01, 0.5, 0.95])
def test_no_pair_above_the_floor_is_lost(spark, floor):
    rows = records(spark).cache()
    tf = scoring.frequencies(rows)
    found = lambda pairs: {tuple(r) for r in scoring.scored(pairs, MODEL, tf).where(F.col("match_probability") >= floor).select("record_id_l", "record_id_r", "provider_l", "provider_r", "match_key", "equal_signature", "same_city", *scoring.LEVELS, F.round("match_weight", 9)).collect()}
    lists = rows.select("record_id", "property_name_match_tokens", "property_name_blocking_tokens")
    all_pairs = scoring.compared(blocking.candidates(rows), rows)
    expected = found(all_pairs)
    assert len(expected) > (50 if floor < 0.95 else 0)
    assert found(reach.compared(rows.drop(*lists.columns[1:]), lists, MODEL, floor)) == expected


def test_most_pairs_without_anything_in_common_are_not_made(spark):
    """Before, each pair of a place was made: their number grew with the square of its records."""
    rows = spark.range(600).select(
        F.concat(F.lit("r"), "id").alias("record_id"), F.concat(F.lit("p"), F.col("id") % 6).alias("provider"), F.lit("XX").alias("country_code_norm"), F.lit("c").alias("city_name_norm"), F.lit("1").alias("postal_code_final"), F.lit("k").alias("cell"), F.lit("w").alias("cell_wide"),
        F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.concat(F.lit("n"), (F.col("id") / 2).cast("int"), F.lit("x"), i)).alias("property_name_match_tokens"), F.lit(10.0).alias("lat_norm"), F.lit(20.0).alias("lng_norm"), F.array().cast("array<string>").alias("phone_last10_non_reused_list"), F.array().cast("array<string>").alias("email_norm_list"),
        F.concat(F.lit("d"), "id").alias("website_domain_norm"), F.lit(False).alias("website_reused_flag"), F.lit(False).alias("website_weak_domain_flag"), F.lit("h").alias("hotel_chain_norm"), F.lit("hotel").alias("property_type_norm"), F.lit(3.0).alias("star_rating_norm"), F.lit(False).alias("lat_lng_low_precision"),
    ).withColumns({c: F.md5(F.array_join("property_name_match_tokens", " ")) for c in ("property_name_signature", "property_name_match_signature")})
    lists = rows.select("record_id", "property_name_match_tokens", F.col("property_name_match_tokens").alias("property_name_blocking_tokens"))
    model = scoring.Model({k: v for k, v in MODEL.m.items() if k != "gamma_type"}, {k: v for k, v in MODEL.u.items() if k != "gamma_type"}, 1e-3)
    assert reach.pairs(reach.ready(rows), reach.hashed(lists), model, 0.01).count() == 300


def test_needed():
    everything = (1 << len(reach.NEEDS)) - 1
    # -9.96 of the prior, -4.04 of contacts that differ, 9.84 of place, chain, type and stars: -2 of a word in common passes -6.63, -5.32 of none doesn't
    assert reach.needed(MODEL, 0.01, everything, everything) == 1
    untyped = everything - (1 << list(reach.NEEDS).index("gamma_type"))
    assert reach.needed(MODEL, 0.01, untyped, everything) == 2
    assert reach.needed(MODEL, 0.01, everything, everything - 1) == 0  # a name without words tells nothing against a pair
    assert reach.needed(MODEL, 0.01, 1, 1) == 4  # 4.32 on -9.96, where 2.32 is too little
    assert reach.needed(MODEL, 0.999999, everything, everything) == 5


def test_overcommon_words_by_counts_alone(spark):
    """As by city_stats, which count the providers of every word."""
    rows = spark.range(300).select(F.col("id").cast("string").alias("record_id"), F.when(F.col("id") % 7 != 0, F.concat(F.lit("p"), F.col("id") % 5)).alias("provider"), F.when(F.col("id") % 3 != 0, F.concat(F.lit("c"), F.col("id") % 2)).alias("city_name_norm"), F.lit("k").alias("cell"),
                                   F.array(F.lit("all"), F.concat(F.lit("some"), F.col("id") % 4), F.concat(F.lit("one"), "id"), F.concat(F.lit("by"), F.col("id") % 5)).alias("property_name_tokens"), F.concat(F.lit("name"), "id").alias("property_name_sorted_tokens"))
    each = tokens.exploded(rows)
    found = lambda counts: sorted(map(tuple, tokens.city_overcommon(rows, each, counts).collect()))
    assert found(tokens.city_counts(each)) == found(tokens.city_stats(each)) != []


def test_large_places_in_chunks(spark, monkeypatch):
    """A place of more records than a task holds is searched by its chunks: no pair is lost or found twice."""
    rows = records(spark).cache()
    lists = rows.select("record_id", *reach.PLACED, "property_name_match_tokens", "property_name_blocking_tokens")
    found = lambda: sorted(tuple(r) for r in reach._by_words(reach.ready(rows).withColumn("__has", reach.fields_of()), reach.hashed(lists), "__k0", MODEL, 0.01, ["record_id", "provider"]).collect())
    whole = found()
    monkeypatch.setattr(reach, "CHUNK", 70)
    assert found() == whole and len(whole) > 50


def test_scored_pairs_carry_their_evidence(spark):
    """Before, audit and gate joined the lists of words of both records to each pair."""
    rows = records(spark).cache()
    lists = rows.select("record_id", "property_name_match_tokens", "property_name_blocking_tokens")
    scores = scoring.scored(reach.compared(rows, lists, MODEL, 0.01), MODEL, scoring.frequencies(rows)).cache()
    plain = scores.drop(*scoring.EVIDENCE)
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect())) != []
    assert same(scoring.audit(scores, None), scoring.audit(plain, rows))
    assert same(gate.features(scores, None), gate.features(plain, rows))
