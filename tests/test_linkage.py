import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from concord.operators import blocking, clusters, explore, graph, quality, review, scoring, tokens
from concord.plans.normalize import Settings, normalize, type_features
from concord.sources import config, feeds, files, sinks
from concord.streaming import decisions

FEED = "provider string, property_code string, property_name string, city_name string, state string, country_code string, area string, lat double, lng double, source_row_number long, record_id string"


@pytest.fixture(scope="session")
def named(spark):
    rows = [
        ("a", "Shahenshah Hotel Prayagraj", "Prayagraj", None), ("b", "hotel GK palace", "Bhopal", None), ("c", "hotel KC palace", "Bhopal", None), ("a", "by the lake apartments ohrid", "Ohrid", None), ("b", "by the lake apartments", "Ohrid", None),
        ("a", "hotel rio re", "acquaviva", None), ("b", "rio re", "dogana", None), ("a", "Red Lollipop Hostel Chennai", "Chennai", None), ("c", "Vila Bled", "Bled", None),
    ]
    raw = spark.createDataFrame([(p, str(i), n, city, None, "in", area, 10.0 + i / 1000, 20.123, i, f"{p}::{i}::{i}") for i, (p, n, city, area) in enumerate(rows)], FEED)
    found = normalize(raw, Settings(tokens=tokens.TokenConfig(match_ratio=2.0, blocking_ratio=2.0, low_value_ratio=2.0)))
    return {r.property_name: r for r in found.records.collect()}


def test_match_tokens(named):
    sig = lambda n: named[n].property_name_match_signature
    assert sig("Shahenshah Hotel Prayagraj") == "shahenshah" and sig("Red Lollipop Hostel Chennai") == "lollipop"
    assert sig("hotel GK palace") == "palace" == sig("hotel KC palace")  # four letters or more, where there are such
    assert sig("by the lake apartments ohrid") == sig("by the lake apartments") == "lake"
    assert sig("hotel rio re") == sig("rio re") == "re rio"
    assert sig("Vila Bled") == "vila"


def test_analytic_pair_counts(spark):
    rng = random.Random(1)
    rows = [(str(i), f"p{rng.randrange(4)}", f"k{rng.randrange(5)}") for i in range(80)]
    frame = spark.createDataFrame(rows, "record_id string, provider string, block_key string")
    got = {r.block_key: r.candidate_pairs for r in blocking.blocks(blocking.block_counts(frame)).collect()}
    for k in got:
        assert got[k] == sum(a[1] != b[1] for a, b in itertools.combinations([r for r in rows if r[2] == k], 2))
    assert blocking.pairs(frame).count() == sum(got.values())
    plan = blocking.pairs(frame)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_components(spark):
    for rows in ([], [("a", "b"), ("b", "c"), ("x", "y")], [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)], [("hub", f"s{i}") for i in range(20)]):
        root = {}
        def find(i):
            root.setdefault(i, i)
            while root[i] != i:
                i = root[i]
            return i
        for a, b in rows:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        got = {r.record_id: r.root for r in graph.components(spark.createDataFrame(rows, "record_id_l string, record_id_r string")).collect()}
        assert got == {i: find(i) for i in list(root)}


def diagnosed(spark, **values):
    base = {"cluster_size": 2, "max_geo_diameter_m": 10.0, "has_contact_evidence": False, "min_pairwise_name_match_jaccard": 1.0, "same_provider_dup": False, "benign_same_provider_dup": False, "brand_conflict": False, "apartment_style_share": 0.0, "villa_style_share": 0.0, "distinct_unit_numbers": 0, "top_match_token_member_share": 1.0, "dominant_name_signature_share": 1.0}
    return clusters.status(spark.createDataFrame([{**base, **values}])).first()


@pytest.mark.parametrize(("values", "reasons"), [
    ({}, []), ({"same_provider_dup": True}, ["same_provider_duplicate"]), ({"same_provider_dup": True, "benign_same_provider_dup": True}, []), ({"cluster_size": 21}, ["oversize"]), ({"max_geo_diameter_m": 600.0}, ["geo_diameter_gt_500_no_contact"]),
    ({"max_geo_diameter_m": 20015087.0, "has_contact_evidence": True}, ["geo_diameter_gt_10km"]), ({"min_pairwise_name_match_jaccard": 0.3}, ["name_match_jaccard_lt_0_45_no_contact"]), ({"has_contact_evidence": True, "cluster_size": 3, "min_pairwise_name_match_jaccard": 0.2}, ["contact_cluster_name_sanity"]),
    ({"brand_conflict": True}, ["brand_conflict"]), ({"villa_style_share": 0.5, "distinct_unit_numbers": 2}, ["villa_unit_conflict"]), ({"cluster_size": 40, "apartment_style_share": 0.8, "same_provider_dup": True}, []),
])
def test_review_reasons(spark, values, reasons):
    row = diagnosed(spark, **values)
    assert row.review_reasons == reasons and row.cluster_status == ("review" if reasons else "auto_accept")


def groups(spark, *rows):
    return spark.createDataFrame([("r", " ".join(t), t, n, pts, lat, lng, spread) for t, n, pts, lat, lng, spread in rows], "root string, sig string, tokens array<string>, n long, points long, lat double, lng double, spread double")


@pytest.mark.parametrize(("a", "b", "kind"), [
    ((["otty"], 2, 0, None, None, None), (["ooty"], 1, 0, None, None, None), None), ((["cupids"], 1, 0, None, None, None), (["cupid"], 1, 0, None, None, None), None), ((["seacoin"], 1, 0, None, None, None), (["coin"], 1, 0, None, None, None), None),
    ((["binsar"], 1, 0, None, None, None), (["danish", "house"], 1, 0, None, None, None), "rare_token_conflict"), ((["kyzen"], 2, 2, 10.0, 20.0, 5.0), (["hitech", "kyzen"], 2, 2, 10.0067, 20.0, 5.0), "geo_split"), ((["kyzen"], 2, 2, 10.0, 20.0, 5.0), (["hitech", "kyzen"], 1, 1, 10.0067, 20.0, 0.0), None),
    ((["1001b", "oyo"], 1, 1, 10.0, 20.0, 0.0), (["2165c", "oyo"], 1, 1, 10.01, 20.0, 0.0), "numeric_id_conflict"), ((["1001b", "oyo"], 1, 1, 10.0, 20.0, 0.0), (["2165c", "oyo"], 1, 1, 10.001, 20.0, 0.0), None),
])
def test_conflicts(spark, a, b, kind):
    stats = spark.createDataFrame([("kyzen", 4)], "token string, doc_freq long")
    assert [r.conflict_type for r in clusters.conflicts(groups(spark, a, b), stats).collect()] == ([kind] if kind else [])


RECORD = "record_id string, provider string, property_name_match_signature string, city_name_norm string, lat_norm double, lng_norm double, lat_lng_low_precision boolean"


def test_adoption(spark):
    rows = [("a1", "a", "rio", "x", 10.0, 20.0, False), ("b1", "b", "rio", "y", 10.0, 20.0001, False), ("c1", "c", "rio", None, 10.0, 20.0, False), ("d1", "d", "rio", "x", None, None, None), ("a2", "a", "rio", "x", 10.0, 20.0, False),
            ("e1", "e", "far", "x", 10.0, 20.0, False), ("f1", "f", "far", "y", 11.0, 20.0, False), ("g1", "g", "boot", "x", 1.0, 2.0, False), ("h1", "h", "boot", "x", 1.0, 2.0, False)]
    records = spark.createDataFrame(rows, RECORD)
    roots = spark.createDataFrame([("a1", "a1"), ("b1", "a1")], "record_id string, root string")
    got = {(r.record_id_l, r.record_id_r) for r in clusters.adopted(spark.createDataFrame([], "x int"), roots, records).collect()}
    assert got == {("a1", "d1"), ("g1", "h1")}


def test_fellegi_sunter_training(spark):
    rows = spark.createDataFrame([{**dict.fromkeys(scoring.LEVELS, -1), "gamma_phone": i % 4 != 0, "gamma_name": 5 if i % 4 else 0} for i in range(400)]).select(*(F.col(k).cast("int") for k in scoring.LEVELS))
    m = scoring.train_m(rows, scoring.FIXED.u, ("gamma_name", "gamma_phone"))
    assert m["gamma_name"][5] > 0.95 and m["gamma_phone"][1] > 0.95
    assert scoring.Model.from_json(scoring.FIXED.to_json()) == scoring.FIXED
    got = scoring.scored(rows.withColumn("equal_signature", F.lit(None).cast("string")), scoring.FIXED).agg(F.max("match_probability"), F.min("match_probability")).first()
    assert 0 < got[1] < got[0] < 1


def test_brands(spark):
    m = spark.createDataFrame([("r1", ["residence"]), ("r1", ["staybridge"]), ("r2", ["home2", "hilton"]), ("r2", ["hilton"]), ("r3", ["oyo"]), ("r3", ["capital"])], "root string, brand_tokens array<string>")
    got = {r.root: r.brand_conflict for r in clusters.brand_conflicts(m, clusters.ClusterPolicy(brand_groups={"oyo": ["oyo", "capital"]})).collect()}
    assert got == {"r1": True, "r2": False}


def test_feeds_and_sinks(spark, tmp_path):
    lines = [{"property_code": "7", "property_name": "x", "lat": "1.5", "junk": 1}, {"property_code": None, "star_rating": "many"}]
    (tmp_path / "a_property_info.ndjson").write_text("\n".join([json.dumps(x) for x in lines] + ["not json"]) + "\n")
    (tmp_path / "b_property_info.ndjson").write_text("")
    got = feeds.read_feeds(spark, str(tmp_path), ["a", "b", "c"]).orderBy("source_row_number").collect()
    assert [(r.record_id, r.lat, r.star_rating) for r in got] == [("a::7::0", 1.5, None), ("a::::1", None, None)]
    with pytest.raises(FileNotFoundError):
        feeds.read_feeds(spark, str(tmp_path), ["b"])
    (tmp_path / "2026-01-01_IN_004").mkdir()
    from datetime import date
    folders = [sinks.run_folder(spark, f"file://{tmp_path}", "IN", date(2026, 1, 1)) for _ in range(2)]
    assert [f.rsplit("/", 1)[1] for f in folders] == ["2026-01-01_IN_005", "2026-01-01_IN_006"]
    path = f"file://{tmp_path}/served"
    served = lambda: sorted(r.v for r in spark.read.schema("v string, country_code string").parquet(path).collect())
    for value in ("x", "y"):
        sinks.replace_country(spark.createDataFrame([(value, "IN")], "v string, country_code string"), path, "IN")
    sinks.replace_country(spark.createDataFrame([("z", "US")], "v string, country_code string"), path, "US")
    assert served() == ["y", "z"]
    sinks.replace_country(spark.createDataFrame([], "v string, country_code string"), path, "IN")
    assert served() == ["z"]  # a country without rows keeps none
    sinks.to_json(spark, {"a": 1}, f"{path}-x/doc.json")
    sinks.to_yaml(spark, {"b": ["ü"]}, f"{path}-x/doc.yaml")
    assert json.loads(files.read_text(spark, f"{path}-x/doc.json")) == {"a": 1} and files.read_text(spark, f"{path}-x/doc.yaml") == "b:\n- ü\n"
    made = config.ensure(str(tmp_path / "configs"), "fr")
    assert config.discover(str(tmp_path / "configs")) == {"FR": made} and Settings.of(config.load(str(made))).country == "FR"


def test_paged_feed(monkeypatch):
    reader = feeds.PagedReader({"url": "http://x", "providers": "agoda,tbo", "country": "IN"})
    pages = [{"rows": [{"property_code": "1", "lat": "2.5"}], "has_more": True, "next_after": "1"}, {"rows": [{"property_code": "2"}], "has_more": False}]
    asked = []
    monkeypatch.setattr(reader, "get", lambda url: (asked.append(url), pages[len(asked) - 1])[1])
    got = list(reader.read(feeds.ProviderPartition("agoda")))
    assert [g[0] for g in got] == ["1", "2"] and got[0][26] == 2.5 and got[0][-1] == "agoda"
    assert "country_code_iso2" in asked[0] and "after=1" in asked[1]
    assert [p.provider for p in (list(reader.pushFilters([feeds.EqualTo(("provider",), "tbo")])), reader.partitions())[1]] == ["tbo"]


def test_decision_log(spark, tmp_path):
    path = str(tmp_path / "log")
    decisions.append(spark, path, [{"review_id": "r1", "decision": "unclear", "seq": 1}, {"review_id": "r2", "decision": "same_hotel", "seq": 2}])
    decisions.append(spark, path, [{"review_id": "r1", "decision": "different_hotel", "seq": 3}])
    with pytest.raises(ValueError):
        decisions.append(spark, path, [{"review_id": "r1", "decision": "maybe"}])
    assert {r.review_id: r.decision for r in explore.latest_decisions(decisions.read(spark, path)).collect()} == {"r1": "different_hotel", "r2": "same_hotel"}
    q = decisions.latest_stream(spark, path).writeStream.outputMode("complete").format("memory").queryName("latest_decisions").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.review_id: r.decision for r in spark.sql("select * from latest_decisions").collect()} == {"r1": "different_hotel", "r2": "same_hotel"}
    assert review.decision_template(spark).columns[0] == "review_id"


def test_guardrails(spark):
    rates = spark.createDataFrame([(0.0, 0.5, None)], "country_missing_rate double, name_missing_rate double, core_empty_rate double")
    assert {r.guardrail: r.passed for r in quality.guardrails(rates).collect()} == {"country_missing_rate": True, "name_missing_rate": False, "core_empty_rate": False}
    with pytest.raises(quality.GuardrailError):
        quality.enforce(rates)


def test_blocking_guardrails(spark):
    rows = [(f"r{i}", f"p{i % 4}", "IN", "c", "g", "g", "town", "560001" if i < 8 else "5600", "sig", "msig", ["tok"], [str(i % 2)], True) for i in range(12)]
    records = spark.createDataFrame(rows, "record_id string, provider string, country_code_norm string, cell string, geohash6_norm string, cell_wide string, city_name_norm string, postal_code_final string, property_name_signature string, property_name_match_signature string, property_name_blocking_tokens array<string>, phone_last10_non_reused_list array<string>, lat_lng_valid boolean")
    found = blocking.diagnose(records, limits={"block_pairs_warn": 50, "rule_pairs_fail": 53, "token_dominance_warn": 0.9})
    pairs = {k: v["summary"]["total_pairs"] for k, v in found.items()}
    brute = lambda same: sum(same(a, b) for a, b in itertools.combinations(rows, 2) if a[1] != b[1])
    assert pairs["same_country_cell"] == brute(lambda a, b: True) == 54 and pairs["shared_non_reused_phone"] == brute(lambda a, b: a[11] == b[11])
    assert pairs["same_country_city_postal"] == brute(lambda a, b: a[7] == b[7] == "560001") == pairs["same_country_city_postal_nametoken"]
    assert found["same_country_cell"]["fail"] and found["same_country_cell"]["warn"] and found["same_country_city_postal_nametoken"]["warn"] == ["token_dominance is 1.000"]
    made = blocking.scoring_pairs(records)
    assert made[2] == brute(lambda a, b: a[7] == b[7])  # scoring takes codes of any length
    blocking.enforce(made)
    with pytest.raises(blocking.BlockingError):
        blocking.enforce(made, {"rule_pairs_fail": 53})


def test_review_front(spark, tmp_path):
    queue = spark.createDataFrame([(f"RQ{'CE'[i % 2]}_{i:x}", i % 3, f"b{i % 2}", f"c{i}", "x_y" if i == 4 else "xzy", "p", "t", "a", 0.5) for i in range(9)], "review_id string, priority int, review_bucket string, cluster_id string, representative_names string, providers string, cities string, suggested_action string, best_edge_probability double").withColumn("geo_diameter_m", F.lit(1.26))
    ids = lambda rows: [r.review_id for r in rows.collect()]
    assert ids(explore.queue_page(queue, page_size=4)) == ["RQC_2", "RQC_8", "RQE_5", "RQC_4"] and ids(explore.queue_page(queue, page_size=4, page=3)) == ["RQE_3"]
    assert ids(explore.queue_page(queue, search="X_Y")) == ["RQC_4"]  # an underscore is taken as it is
    assert explore.queue_rows(queue, bucket="b1").count() == 4 and explore.queue_rows(queue, action="none").count() == 0
    sinks.to_csv(queue, f"{tmp_path}/top")
    assert {(r.review_id, r.review_entity_type) for r in explore.queue_of_csv(spark, f"{tmp_path}/top").collect()} == {(f"RQ{'CE'[i % 2]}_{i:x}", ["cluster", "pair"][i % 2]) for i in range(9)}
    with pytest.raises(ValueError):
        explore.review_detail("x'; drop", queue, queue, queue, queue, queue, queue)


def test_sessions_are_averaged():
    a, b = {"gamma_phone": [0.5, 0.5], "gamma_star": [0.2, 0.8]}, {"gamma_phone": [0.1, 0.9], "gamma_name": [0.0, 0.1, 0.2, 0.2, 0.2, 0.3]}
    got = scoring.mean_of([a, b])
    assert got["gamma_phone"] == pytest.approx([0.3, 0.7]) and got["gamma_star"] == [0.2, 0.8] and got["gamma_name"] == b["gamma_name"]


@pytest.mark.parametrize("country", ["AB", "AR", "LC", "LU", "ME", "MK", "NP", "NZ", "SI", "SM", "US", "UZ", "IN", "QQ"])
def test_every_country_normalises(spark, tmp_path, country):
    """A generated configuration, one record in Cyrillic and one in Latin, with phones that say their country."""
    made = config.ensure(str(tmp_path), country)
    s = Settings.of(config.load(str(made)))
    line = {"property_code": "1", "property_name": "Гостиница Охрид", "country_code": country, "phone_numbers": "+998 71 120 33 44", "property_type": "Beach Resort", "city_name": "Охрид", "lat": 41.117, "lng": 20.801}
    (tmp_path / "a_property_info.ndjson").write_text(json.dumps(line) + "\n" + json.dumps({**line, "property_code": "2", "property_name": "北京 Inn"}) + "\n")
    rows = {r.property_code: r for r in normalize(feeds.read_feeds(spark, str(tmp_path), ["a"]), s).records.collect()}
    assert rows["1"].property_name_norm == "gostinitsa okhrid" and rows["1"].city_ascii == "okhrid" and rows["2"].property_name_norm == "u5317 u4eac inn"
    assert rows["1"].phone_e164_list == ["+998711203344"] and rows["1"].property_type_norm == "resort"


def test_keywords_of_the_configuration(spark):
    s = Settings.of({"country": "XX", "property_type_maps": {"keywords": {"boat": ["ship"], "hotel": ["hotel"]}}})
    raw = spark.createDataFrame([("1", "p", "ship hotel"), ("2", "p", "resort")], "record_id string, provider string, property_type_clean string")
    assert [r.property_type_norm for r in type_features(raw.withColumn("hotel_chain_clean", F.lit(None).cast("string")), s).orderBy("record_id").collect()] == ["boat", "unknown"]


def test_overcommon_counts_names_that_fall_together(spark):
    """Names are told apart by groups of hashes first; where these are too few, names are counted."""
    hashes = {"groups": range(10), "together": [64 * i for i in range(10)], "nine": range(9), "nine_together": [64 * i for i in range(9)], "one": [5]}
    rows = [(f"{t}{i}", f"p{i % 4}", "x", None, h, t) for t, hs in hashes.items() for i, h in enumerate(list(hs) * 20)]
    exploded = spark.createDataFrame(rows, "record_id string, provider string, city_name_norm string, cell string, name_hash long, token string")
    records = exploded.select("record_id", "city_name_norm")
    found = tokens.city_overcommon(records, exploded, tokens.city_stats(exploded), tokens.TokenConfig())
    assert {r.token for r in found.collect()} == {"groups", "together"}


def test_plain_letters_pass_as_they_are(spark):
    from concord.functions import text

    given = ["Café & Bar", "plain", "ﬁne Straße", "n/a", None, "  ", "ÆGIR ó"]
    rows = spark.createDataFrame([(x,) for x in given], "x string").select(text.name_norm(F.col("x")).alias("n"), text.clean_text(F.col("x")).alias("c")).collect()
    assert [r.n for r in rows] == ["cafe and bar", "plain", "ne strasse", "n a", None, None, "aegir o"]
    assert [r.c for r in rows] == ["café & bar", "plain", "ﬁne straße", None, None, None, "ægir ó"]


def test_common_words_that_are_rare_somewhere_are_tagged(spark):
    exploded = spark.createDataFrame([("a", "x", "often"), ("a", "x", "here"), ("b", "y", "often"), ("b", "y", "once"), ("c", None, "often")], "record_id string, city_name_norm string, token string")
    rare, city = spark.createDataFrame([("once",)], "token string"), spark.createDataFrame([("x", "often"), ("x", "here")], "city_name_norm string, token string")
    for common in ((), ("often",), ("often", "once", "here")):
        found = {r.record_id: (r.property_name_rare_tokens_global, r.property_name_rare_tokens_city) for r in tokens.rare_tags(exploded.select("record_id").distinct(), exploded, rare, city, common).collect()}
        assert found == {"a": ([], ["here", "often"]), "b": (["once"], []), "c": ([], [])}
