"""From gated pairs to entities: automatic links, splits, adoption, diagnostics, reasons for review, members.

The unit is a component of links. Where something is asked of all pairs in a component, equal members are
counted as one with their number, so a component of many equal listings costs few pairs.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.functions.geo import acos_distance, asin_distance
from concord.functions.text import signature
from concord.operators.graph import components
from concord.sources.checkpoints import written

#: Reasons of links.
CONTACT_REASONS = ("phone", "exact_email", "non_reused_domain")
AUTO_REASONS = ("signature", *CONTACT_REASONS)
#: Providers by preference for the representative record.
PROVIDER_RANK = ("expedia", "hotelbeds", "tbo", "agoda", "cleartrip", "ratehawk", "tripjack", "rezlive", "veturis", "grnc", "restel", "ioxl")


@dataclass(frozen=True)
class ClusterPolicy:
    """Thresholds, and the switches by which versions differ. The default is the newest."""

    country: str = "XX"
    match_tokens: bool = True
    benign_duplicates: bool = True
    buildings: bool = True
    split_and_adopt: bool = True
    auto_prob: float = 0.99
    exact_prob: float = 0.95
    exact_dist: float = 100
    contact_jaccard: float = 0.30
    max_size: int = 20
    diameter: float = 500
    drift: float = 1000
    hard_diameter: float = 10_000
    sig_share: float = 0.6
    benign_jaccard: float = 0.6
    benign_dist: float = 300
    apt_share: float = 0.5
    villa_share: float = 0.3
    building_diameter: float = 250
    building_size: int = 200
    top_token_share: float = 0.8
    split_sep: float = 350
    split_tight: float = 150
    split_rare: int = 300
    split_len: int = 4
    split_edits: int = 2
    adopt_radius: float = 250
    adopt_most: int = 10
    provider_rank: tuple[str, ...] = PROVIDER_RANK
    brand_groups: dict = field(default_factory=dict)


V2_4 = ClusterPolicy()
V2_3 = replace(V2_4, split_and_adopt=False)
V2_2 = replace(V2_3, buildings=False)
V2_1 = replace(V2_2, benign_duplicates=False)
V2 = replace(V2_1, match_tokens=False)
VERSIONS = {"v2": V2, "v2_1": V2_1, "v2_2": V2_2, "v2_3": V2_3, "v2_4": V2_4}

EDGE = ("record_id_l", "record_id_r", "provider_l", "provider_r", "match_probability", "gate_reason", "dist_m", "phone_ov", "name_match_jaccard", "sig_exact")


def auto_edges(gated: DataFrame, p: ClusterPolicy = V2_4) -> DataFrame:
    """Pairs that link without review."""
    if not p.match_tokens:
        gated = gated.withColumns({"name_match_jaccard": F.lit(None).cast("double"), "sig_exact": F.lit(False)})
    prob, exact = F.col("match_probability"), F.coalesce("sig_exact", F.lit(False))
    yes = F.col("gate_reason").isin(*AUTO_REASONS) & (prob >= p.auto_prob)
    if p.match_tokens:
        yes = yes | ((F.col("gate_reason") == "signature") & exact & (F.col("dist_m") <= p.exact_dist) & (prob >= p.exact_prob))
        yes = yes & ((F.col("gate_reason") == "signature") | exact | (F.coalesce("name_match_jaccard", F.lit(0.0)) >= p.contact_jaccard))
    return gated.where(yes).select(*EDGE).withColumn("sig_exact", exact)


def _place(c: str) -> Column:
    return F.when(~F.coalesce("lat_lng_low_precision", F.lit(False)), F.col(c)).alias(c)


def subgroups(roots: DataFrame, records: DataFrame) -> DataFrame:
    """root, sig: the records of a component with one core signature: tokens, number, located places, centre and spread."""
    attrs = roots.join(records.select("record_id", F.coalesce("property_name_core_tokens", F.array().cast("array<string>")).alias("tokens"), _place("lat_norm"), _place("lng_norm")), "record_id").withColumn("sig", signature(F.col("tokens")))
    attrs = attrs.where("sig <> ''")
    several = attrs.groupBy("root").agg(F.count_distinct("sig").alias("k")).where("k > 1").select("root")
    attrs = attrs.join(several, "root", "left_semi")
    located = F.col("lat_norm").isNotNull() & F.col("lng_norm").isNotNull()
    groups = attrs.groupBy("root", "sig").agg(F.array_distinct(F.first("tokens")).alias("tokens"), F.count("*").alias("n"), F.count_if(located).alias("points"), F.avg(F.when(located, F.col("lat_norm"))).alias("lat"), F.avg(F.when(located, F.col("lng_norm"))).alias("lng"))
    spread = attrs.where(located).join(groups.select("root", "sig", "lat", "lng"), ["root", "sig"]).groupBy("root", "sig").agg(F.max(asin_distance(F.col("lat_norm"), F.col("lng_norm"), F.col("lat"), F.col("lng"))).alias("spread"))
    return groups.join(spread, ["root", "sig"], "left")


def conflicts(groups: DataFrame, stats: DataFrame, p: ClusterPolicy = V2_4) -> DataFrame:
    """root, sig_a, sig_b, conflict_type, sep_m, members_a, members_b of subgroups that are different places."""
    freq = groups.select("root", "sig", F.explode("tokens").alias("token")).join(stats.select("token", "doc_freq"), "token", "left").groupBy("root", "sig").agg(F.collect_set(F.when(F.coalesce("doc_freq", F.lit(0)) <= p.split_rare, F.col("token"))).alias("rare"))
    rows = groups.join(freq, ["root", "sig"])
    side = lambda s: rows.select("root", *(F.col(c).alias(f"{c}_{s}") for c in ("sig", "tokens", "n", "points", "lat", "lng", "spread", "rare")))
    both = side("a").join(side("b"), "root").where("sig_a < sig_b")

    def twin(t, other):
        near = F.levenshtein(t, other, p.split_edits) >= 0
        inside = (F.length(t) >= 4) & (F.length(other) >= 4) & (F.contains(t, other) | F.contains(other, t))
        return near | inside

    def alone(other):
        return lambda t: (F.length(t) >= p.split_len) & ~F.exists(other, lambda o: twin(t, o))

    for a, b in ("ab", "ba"):
        only = F.array_except(f"tokens_{a}", f"tokens_{b}")
        live = F.filter(only, alone(f"tokens_{b}"))
        rare = F.array_intersect(live, f"rare_{a}")
        code = lambda t: t.rlike("^[0-9]+[a-z]{0,2}$")
        both = both.withColumns({f"only_{a}": F.size(only), f"live_{a}": F.size(live), f"alpha_{a}": F.size(F.filter(rare, lambda t: ~code(t))), f"code_{a}": F.size(F.filter(rare, code))})
    sep = asin_distance(F.col("lat_a"), F.col("lng_a"), F.col("lat_b"), F.col("lng_b"))
    zero = lambda s: F.coalesce(f"spread_{s}", F.lit(0.0))
    wide = F.greatest(zero("a"), zero("b"), F.lit(1.0))
    both = both.withColumns({"sep": sep, "wide": wide})
    spelling = F.expr("only_a > 0 and only_b > 0 and live_a = 0 and live_b = 0")
    kind = (
        F.when(F.expr("alpha_a > 0 and alpha_b > 0"), "rare_token_conflict")
        .when(F.expr(f"code_a > 0 and code_b > 0 and sep > {p.split_sep} and sep > 2 * wide"), "numeric_id_conflict")
        .when(F.expr(f"sep > {p.split_sep} and points_a >= 2 and points_b >= 2 and sep > 3 * wide") & (zero("a") < p.split_tight) & (zero("b") < p.split_tight), "geo_split")
    )
    return both.where(~spelling).withColumn("conflict_type", kind).where("conflict_type is not null").select("root", "sig_a", "sig_b", "conflict_type", F.round("sep").cast("long").alias("sep_m"), F.col("n_a").alias("members_a"), F.col("n_b").alias("members_b"))


def cut(edges: DataFrame, roots: DataFrame, records: DataFrame, found: DataFrame) -> DataFrame:
    """edges less those between conflicting subgroups of one component."""
    sig = records.select("record_id", signature(F.coalesce("property_name_core_tokens", F.array().cast("array<string>"))).alias("sig"))
    rows = edges.join(roots.withColumnRenamed("record_id", "record_id_l"), "record_id_l")
    for s in "lr":
        rows = rows.join(sig.withColumnsRenamed({"record_id": f"record_id_{s}", "sig": f"sig_{s}"}), f"record_id_{s}", "left")
    rows = rows.withColumns({"sig_a": F.least("sig_l", "sig_r"), "sig_b": F.greatest("sig_l", "sig_r")})
    return rows.join(found.select("root", "sig_a", "sig_b"), ["root", "sig_a", "sig_b"], "left_anti").select(*edges.columns)


def adopted(edges: DataFrame, roots: DataFrame, records: DataFrame, p: ClusterPolicy = V2_4) -> DataFrame:
    """Links that join what has one match signature at one place: parts of it, and records that stand alone.

    A signature is one group if all its places are within the radius of their centre, else a group for each
    city. A group needs a place, and all of them within the radius. Its anchor is the least linked record, or
    of a group without links the least record, if two providers are in it. Records that stand alone are
    adopted in order of id, at most ``adopt_most``, if their provider is not the anchor group's.
    """
    rows = records.where("coalesce(property_name_match_signature, '') <> '' and city_name_norm is not null").select("record_id", "provider", F.col("property_name_match_signature").alias("msig"), F.col("city_name_norm").alias("city"), _place("lat_norm"), _place("lng_norm"))
    rows = rows.join(roots, "record_id", "left")

    def tight(by):
        centre = rows.groupBy(*by).agg(F.avg("lat_norm").alias("lat"), F.avg("lng_norm").alias("lng"))
        far = rows.join(centre, by).groupBy(*by).agg(F.max(asin_distance(F.col("lat_norm"), F.col("lng_norm"), F.col("lat"), F.col("lng"))).alias("far"))
        return far.where(F.col("far") <= p.adopt_radius).select(*by)

    whole = tight(["msig"])
    groups = rows.join(whole, "msig", "left_semi").withColumn("grp", F.col("msig"))
    parts = rows.join(whole, "msig", "left_anti").join(tight(["msig", "city"]), ["msig", "city"], "left_semi").withColumn("grp", F.concat("msig", F.lit("\x01"), "city")).select(*groups.columns)
    groups = groups.unionByName(parts)
    linked = F.col("root").isNotNull()
    heads = groups.groupBy("grp").agg(F.min(F.struct((~linked).alias("alone"), "record_id", "provider", "root")).alias("anchor"), F.count("*").alias("n"), F.count_distinct("provider").alias("providers"), F.collect_set(F.when(linked, F.col("provider"))).alias("taken"))
    heads = heads.where("not anchor.alone or (n >= 2 and providers >= 2)")
    rows = groups.join(heads, "grp").where("record_id <> anchor.record_id")
    merged = rows.where(linked & (F.col("root") != F.col("anchor.root"))).withColumn("rn", F.expr("row_number() over (partition by grp, root order by record_id)")).where("rn = 1")
    taken = F.when(F.col("anchor.alone"), F.array("anchor.provider")).otherwise(F.col("taken"))
    alone = rows.where(~linked & ~F.array_contains(taken, F.col("provider"))).withColumn("rn", F.expr("row_number() over (partition by grp order by record_id)")).where(F.col("rn") <= p.adopt_most)
    found = merged.unionByName(alone)
    return found.select(
        F.col("anchor.record_id").alias("record_id_l"), F.col("record_id").alias("record_id_r"), F.col("anchor.provider").alias("provider_l"), F.col("provider").alias("provider_r"), F.lit(0.95).alias("match_probability"), F.lit("sig_city_adoption").alias("gate_reason"),
        F.lit(None).cast("double").alias("dist_m"), F.lit(False).alias("phone_ov"), F.lit(1.0).alias("name_match_jaccard"), F.lit(True).alias("sig_exact"),
    )


def members(roots: DataFrame, records: DataFrame, p: ClusterPolicy = V2_4) -> DataFrame:
    """The fields of linked records that diagnostics need."""
    sig, tokens = ("property_name_match_signature", "property_name_match_tokens") if p.match_tokens else ("property_name_signature", "property_name_core_tokens")
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, p.provider_rank)), F.col("provider")), F.lit(0)) - 1, F.lit(99))
    rows = records.select("record_id", "provider", F.col("property_name_signature").alias("sig"), F.col(sig).alias("match_sig"), F.coalesce(tokens, F.array().cast("array<string>")).alias("match_tokens"), F.col("property_name_norm").alias("name"), _place("lat_norm"), _place("lng_norm"),
                          F.col("property_type_norm").alias("property_type"), F.coalesce("property_name_brand_tokens", F.array().cast("array<string>")).alias("brand_tokens"), rank.cast("int").alias("prov_rank"))
    return roots.join(rows, "record_id")


def edge_diagnostics(edges: DataFrame, roots: DataFrame) -> DataFrame:
    rows = edges.join(roots.withColumnRenamed("record_id", "record_id_l"), "record_id_l")
    has = lambda r, name: F.bool_or(F.col("gate_reason") == r).alias(name)
    return rows.groupBy("root").agg(
        F.count("*").alias("edge_count"), F.min("match_probability").alias("min_edge_probability"), has("phone", "has_phone_edge"), has("exact_email", "has_email_edge"), has("non_reused_domain", "has_domain_edge"),
        F.min_by("gate_reason", F.struct("match_probability", "gate_reason")).alias("weakest_edge_reason"), F.round(F.median("dist_m")).alias("median_pair_distance_m"),
    )


def dominance(m: DataFrame, column: str, name: str) -> DataFrame:
    """How many signatures a component has, and the largest one's share of its records."""
    some = m.where(F.col(column).isNotNull() if column == "sig" else F.coalesce(F.col(column), F.lit("")) != "")
    return some.groupBy("root", column).agg(F.count("*").alias("n")).groupBy("root").agg(F.count("*").alias(f"{name}_count"), (F.max("n") / F.sum("n")).alias(f"dominant_{name}_share"))


def provider_duplicates(m: DataFrame) -> DataFrame:
    return m.groupBy("root", "provider").agg(F.count("*").alias("n")).groupBy("root").agg(F.max("n").alias("max_same_provider"), (F.sum("n") - F.count("*")).alias("same_provider_duplicate_count"))


def core(m: DataFrame, p: ClusterPolicy = V2_4) -> DataFrame:
    low, high = F.min, F.max
    return m.groupBy("root").agg(
        F.count("*").alias("cluster_size"), F.count_distinct("provider").alias("provider_count"), F.array_sort(F.collect_set("provider")).alias("providers_present"), low("lat_norm").alias("a"), high("lat_norm").alias("b"), low("lng_norm").alias("c"), high("lng_norm").alias("d"),
        F.min_by("record_id", F.struct("prov_rank", "record_id")).alias("representative_record_id"), F.concat(F.lit(p.country + "_"), F.substring(F.md5(F.array_join(F.array_sort(F.collect_list("record_id")), ",")), 1, 16)).alias("cluster_id"),
    ).withColumn("max_geo_diameter_m", acos_distance(F.col("a"), F.col("c"), F.col("b"), F.col("d"))).drop("a", "b", "c", "d")


def _jac(a: str, b: str) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def name_pairs(m: DataFrame) -> DataFrame:
    """Least and median name similarity of a component's pairs; equal token lists are one with their number."""
    sets = m.select("root", F.array_sort(F.array_distinct("match_tokens")).alias("t")).groupBy("root", "t").agg(F.count("*").alias("n"))
    side = lambda s: sets.select("root", F.col("t").alias(f"t_{s}"), F.col("n").alias(f"n_{s}"))
    across = side("a").join(side("b"), "root").where("t_a < t_b").select("root", _jac("t_a", "t_b").alias("j"), (F.col("n_a") * F.col("n_b")).alias("w"))
    inside = sets.where("n > 1").select("root", F.when(F.size("t") == 0, 0.0).otherwise(1.0).alias("j"), (F.col("n") * (F.col("n") - 1) / 2).cast("long").alias("w"))
    return across.unionByName(inside).groupBy("root").agg(F.min("j").alias("min_pairwise_name_match_jaccard"), F.percentile("j", 0.5, F.col("w")).alias("median_pairwise_name_match_jaccard"))


def same_provider_pairs(m: DataFrame, p: ClusterPolicy = V2_4) -> DataFrame:
    """Of pairs of one provider in a component: number, widest distance, least similarity, and whether all are double listings."""
    same = ["root", "provider", "match_sig", "t", "lat_norm", "lng_norm"]
    rows = m.withColumn("t", F.array_sort(F.array_distinct("match_tokens"))).groupBy(*same).agg(F.count("*").alias("n"), F.min("record_id").alias("id"))
    side = lambda s: rows.select("root", "provider", *(F.col(c).alias(f"{c}_{s}") for c in (*same[2:], "n", "id")))
    both = side("a").join(side("b"), ["root", "provider"]).where("id_a <= id_b")
    count = F.when(F.col("id_a") == F.col("id_b"), F.col("n_a") * (F.col("n_a") - 1) / 2).otherwise(F.col("n_a") * F.col("n_b")).cast("long")
    both = both.withColumns({"w": count, "j": _jac("t_a", "t_b"), "eq": F.coalesce((F.col("match_sig_a") == F.col("match_sig_b")) & (F.col("match_sig_a") != ""), F.lit(False)), "d": asin_distance(F.col("lat_norm_a"), F.col("lng_norm_a"), F.col("lat_norm_b"), F.col("lng_norm_b"))}).where("w > 0")
    benign = (F.col("eq") | (F.col("j") >= p.benign_jaccard)) & (F.coalesce("d", F.lit(1e9)) <= p.benign_dist)
    return both.groupBy("root").agg(F.sum("w").alias("same_provider_pair_count"), F.max("d").alias("max_same_provider_pair_dist_m"), F.min("j").alias("min_same_provider_pair_jaccard"), F.bool_and(benign).alias("same_provider_pairs_benign"))


#: Words of an apartment, and numbers of a unit.
APARTMENT = r"\b(apartment|apartments|apt|studio|bedroom|bedrooms|condos?|penthouse|loft|residences)\b"
UNIT = r"\b(?:apt|apartment|unit|room|suite|studio|flat|condo|villa|no)\s*#?\s*([0-9]{1,5})\b"


def units(m: DataFrame) -> DataFrame:
    name = F.coalesce("name", F.lit(""))
    apartment = name.rlike(APARTMENT) | F.coalesce("property_type", F.lit("")).isin("apartment", "aparthotel")
    number = F.nullif(F.regexp_extract(name, UNIT, 1), F.lit(""))
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    return m.groupBy("root").agg(share(apartment).alias("apartment_style_share"), share(name.rlike(r"\bvillas?\b")).alias("villa_style_share"), F.count_distinct(number).alias("distinct_unit_numbers"))


def top_token(m: DataFrame) -> DataFrame:
    rows = m.select("root", F.explode(F.array_distinct("match_tokens")).alias("token"))
    return rows.where("token <> ''").groupBy("root", "token").agg(F.count("*").alias("n")).groupBy("root").agg(F.max("n").alias("top_token_members"))


def brand_conflicts(m: DataFrame, p: ClusterPolicy = V2_4) -> DataFrame:
    """Whether two members have brand words and none in common, brands of a group being one."""
    group_of = {w: g for g, ws in p.brand_groups.items() for w in ws}

    def named(t):
        out = t
        for word, group in group_of.items():
            out = F.when(t == word, group).otherwise(out)
        return out

    sets = m.where(F.size("brand_tokens") > 0).select("root", F.array_sort(F.array_distinct(F.transform("brand_tokens", named))).alias("b")).distinct()
    side = lambda s: sets.select("root", F.col("b").alias(f"b_{s}"))
    return side("x").join(side("y"), "root").where("b_x < b_y").groupBy("root").agg(F.bool_or(~F.arrays_overlap("b_x", "b_y")).alias("brand_conflict"))


def diagnostics(edges: DataFrame, roots: DataFrame, records: DataFrame, p: ClusterPolicy = V2_4) -> DataFrame:
    """One row for each component, with all measures, reasons for review, entity level and status."""
    m = written(members(roots, records, p), "members")
    rows = core(m, p).join(edge_diagnostics(edges, roots), "root").join(provider_duplicates(m), "root")
    for part in (dominance(m, "sig", "name_signature"), dominance(m, "match_sig", "match_token_signature"), name_pairs(m), same_provider_pairs(m, p), units(m), top_token(m), brand_conflicts(m, p)):
        rows = rows.join(part, "root", "left")
    zero = F.lit(0.0)
    rows = rows.withColumns({c: F.coalesce(c, zero) for c in ("dominant_name_signature_share", "dominant_match_token_signature_share", "min_pairwise_name_match_jaccard", "median_pairwise_name_match_jaccard", "apartment_style_share", "villa_style_share")})
    rows = rows.withColumns({
        "same_provider_pair_count": F.coalesce("same_provider_pair_count", F.lit(0)), "distinct_unit_numbers": F.coalesce("distinct_unit_numbers", F.lit(0)), "brand_conflict": F.coalesce("brand_conflict", F.lit(False)), "same_provider_dup": F.col("max_same_provider") > 1,
        "benign_same_provider_dup": (F.col("max_same_provider") > 1) & F.coalesce("same_provider_pairs_benign", F.lit(False)), "has_contact_evidence": F.expr("has_phone_edge or has_email_edge or has_domain_edge"),
        "top_match_token_member_share": F.coalesce(F.col("top_token_members") / F.col("cluster_size"), zero),
    }).drop("top_token_members", "same_provider_pairs_benign", "match_token_signature_count")
    return status(rows, p)


def status(rows: DataFrame, p: ClusterPolicy = V2_4) -> DataFrame:
    """review_reasons, entity_level and cluster_status of diagnosed components."""
    d = F.col("max_geo_diameter_m")
    contact = F.col("has_contact_evidence")
    j = F.col("min_pairwise_name_match_jaccard")
    duplicate = F.col("same_provider_dup") & ~F.col("benign_same_provider_dup") if p.benign_duplicates else F.col("same_provider_dup")
    tests = [("same_provider_duplicate", duplicate), ("oversize", F.col("cluster_size") > p.max_size), ("geo_diameter_gt_500_no_contact", (d > p.diameter) & ~contact), ("transitive_drift_geo_gt_1km", (d > p.drift) & ~contact)]
    tests += [("geo_diameter_gt_10km", d > p.hard_diameter)] * p.benign_duplicates
    if p.match_tokens:
        tests += [("name_match_jaccard_lt_0_45_no_contact", ~contact & (j < 0.45)), ("contact_cluster_name_sanity", contact & (F.col("cluster_size") > 2) & (j < 0.30))]
    else:
        tests += [("name_conflict", (F.col("cluster_size") >= 4) & (F.col("dominant_name_signature_share") < p.sig_share) & ~contact)]
    reasons = F.array_compact(F.array(*(F.when(test, name) for name, test in tests)))
    rows = rows.withColumn("review_reasons", reasons)
    building, villa = F.lit(False), F.lit(False)
    if p.buildings:
        building = (F.col("apartment_style_share") >= p.apt_share) & (F.col("villa_style_share") < p.villa_share) & (d <= p.building_diameter) & (F.col("cluster_size") <= p.building_size) & (F.col("top_match_token_member_share") >= p.top_token_share) & ~F.col("brand_conflict")
        villa = (F.col("villa_style_share") >= p.villa_share) & (F.col("distinct_unit_numbers") >= 2)
    rows = rows.withColumns({"is_building_merge": F.coalesce(building, F.lit(False)), "is_villa_unit_conflict": villa})
    if p.buildings:
        waived = F.array(*map(F.lit, ("same_provider_duplicate", "oversize", "contact_cluster_name_sanity", "name_match_jaccard_lt_0_45_no_contact")))
        named = F.when(F.col("brand_conflict"), F.array_append("review_reasons", F.lit("brand_conflict"))).otherwise(F.col("review_reasons"))
        rows = rows.withColumn("review_reasons", F.when(F.col("is_villa_unit_conflict"), F.array_append(named, F.lit("villa_unit_conflict"))).when(F.col("is_building_merge"), F.filter(named, lambda x: ~F.array_contains(waived, x))).otherwise(named))
    return rows.withColumns({"entity_level": F.when(F.col("is_building_merge") & ~F.col("is_villa_unit_conflict"), "building").otherwise("property"), "cluster_status": F.when(F.size("review_reasons") == 0, "auto_accept").otherwise("review")})


def member_map(clusters: DataFrame, roots: DataFrame, records: DataFrame) -> DataFrame:
    """record_id, provider, cluster_id, status and is_representative of all records, linked or not."""
    rows = records.select("record_id", "provider").join(roots, "record_id", "left").join(clusters.select("root", "cluster_id", "cluster_status", "representative_record_id"), "root", "left")
    state = F.when(F.col("root").isNull(), "singleton_unmatched").when(F.col("cluster_status") == "auto_accept", "matched_cluster").otherwise("review_cluster")
    return rows.select("record_id", "provider", "cluster_id", state.alias("status"), F.coalesce(F.col("record_id") == F.col("representative_record_id"), F.lit(True)).alias("is_representative"))


@dataclass
class Clustering:
    edges: DataFrame
    roots: DataFrame
    clusters: DataFrame
    members: DataFrame
    conflicts: DataFrame | None


def cluster(gated: DataFrame, records: DataFrame, stats: DataFrame | None = None, p: ClusterPolicy = V2_4) -> Clustering:
    """All steps of a version, from gated pairs; stats (token, doc_freq) are needed where components are split."""
    edges, found = written(auto_edges(gated, p), "edges"), None
    if p.split_and_adopt:
        roots = components(edges)
        found = written(conflicts(written(subgroups(roots, records), "subgroups"), stats, p), "conflicts")
        edges = written(cut(edges, roots, records, found), "edges")
        edges = written(edges.unionByName(adopted(edges, components(edges), records, p)), "edges")
    roots = components(edges)
    clusters = written(diagnostics(edges, roots, records, p), "clusters")
    named = edges.join(roots.withColumnRenamed("record_id", "record_id_l"), "record_id_l").join(clusters.select("root", "cluster_id"), "root").select(*edges.columns, "cluster_id")
    return Clustering(named, roots, clusters, member_map(clusters, roots, records), found)


def summary(clusters: DataFrame) -> DataFrame:
    n = lambda e, name: F.count_if(F.expr(e)).alias(name)
    size = lambda s: F.coalesce(F.sum(F.when(F.col("cluster_status") == s, F.col("cluster_size"))), F.lit(0))
    return clusters.agg(
        F.count("*").alias("clusters_total"), n("cluster_status = 'auto_accept'", "auto_accepted"), n("cluster_status = 'review'", "review"), F.coalesce(F.max("cluster_size"), F.lit(0)).alias("largest_cluster_size"), size("auto_accept").alias("records_in_auto"), size("review").alias("records_in_review"),
        n("same_provider_dup", "same_provider_violation"), n("benign_same_provider_dup", "benign_same_provider_dup_clusters"), n("benign_same_provider_dup and cluster_status = 'auto_accept'", "benign_same_provider_dup_auto_accepted"), n("max_geo_diameter_m > 1000 and not has_contact_evidence", "geo_diam_violation"),
        n("max_geo_diameter_m > 10000", "geo_diam_gt_10km_clusters"), n("cluster_size > 20", "oversize_violation"), n("min_pairwise_name_match_jaccard < 0.45 and not has_contact_evidence", "name_conflict_violation"), n("is_building_merge and cluster_status = 'auto_accept'", "building_merged_auto"),
        n("is_villa_unit_conflict", "villa_unit_conflict_clusters"), n("brand_conflict", "brand_conflict_clusters"),
    )


def reason_counts(clusters: DataFrame) -> DataFrame:
    return clusters.select(F.explode("review_reasons").alias("reason"), "cluster_size").groupBy("reason").agg(F.count("*").alias("clusters"), F.sum("cluster_size").alias("records"))


def contact_only_auto(edges: DataFrame, clusters: DataFrame) -> DataFrame:
    """cluster_id of accepted clusters with contact links and none by signature."""
    rows = edges.join(clusters.where("cluster_status = 'auto_accept'").select("cluster_id"), "cluster_id")
    return rows.groupBy("cluster_id").agg(F.bool_or(F.col("gate_reason").isin(*CONTACT_REASONS)).alias("contact"), F.bool_or(F.col("gate_reason") == "signature").alias("name")).where("contact and not name").select("cluster_id")
