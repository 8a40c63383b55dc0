"""Queues for people: clusters and pairs that need a decision, with reasons, buckets and priorities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.operators.clusters import AUTO_REASONS, CONTACT_REASONS

QUEUE = ("review_id", "priority", "review_bucket", "cluster_id", "cluster_size", "providers", "representative_names", "cities", "postal_codes", "geo_diameter_m", "best_edge_probability", "best_edge_reason", "worst_edge_reason", "shared_phones", "shared_emails", "shared_domains", "suggested_action", "review_reason", "review_entity_type")
#: What a decision may be.
DECISIONS = ("same_hotel", "different_hotel", "same_property_group_not_same_hotel", "unclear")
DECISION_TEMPLATE = "review_id string, entity_a string, entity_b string, decision string, reviewer string, reviewed_at string, reason string, notes string"
MEMBER_FIELDS = ("property_name_norm", "city_name_norm", "postal_code_final", "phone_last10_non_reused_list", "email_norm_list", "website_domain_norm", "lat_norm", "lng_norm")


def base(clusters: DataFrame, members: DataFrame, records: DataFrame) -> DataFrame:
    """Members of clusters in review, with the fields shown."""
    rows = members.select("cluster_id", "record_id").join(clusters.where("cluster_status = 'review'").select("cluster_id"), "cluster_id")
    names = dict(zip(MEMBER_FIELDS, ("name", "city", "postal_code", "phones", "emails", "domain", "lat_norm", "lng_norm"), strict=True))
    return rows.join(records.select("record_id", "provider", *(F.col(a).alias(b) for a, b in names.items())), "record_id")


def _top(rows: DataFrame, column: str, separator: str, name: str, n: int = 5) -> DataFrame:
    """The most frequent values of each cluster, then by value."""
    counts = rows.where(F.col(column).isNotNull()).groupBy("cluster_id", column).agg(F.count("*").alias("n"))
    ranked = counts.withColumn("rn", F.expr(f"row_number() over (partition by cluster_id order by n desc, {column})")).where(F.col("rn") <= n)
    return ranked.groupBy("cluster_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", F.col(column).alias("v")))), lambda x: x["v"]), separator).alias(name))


def member_text(rows: DataFrame) -> DataFrame:
    out = rows.groupBy("cluster_id").agg(F.array_join(F.array_sort(F.collect_set("provider")), ", ").alias("providers"))
    for column, separator, name in (("name", " | ", "representative_names"), ("city", ", ", "cities"), ("postal_code", ", ", "postal_codes")):
        out = out.join(_top(rows, column, separator, name), "cluster_id", "left")
    return out


def shared(rows: DataFrame, column: str, name: str, is_list: bool = True) -> DataFrame:
    """Values that two or more records of a cluster have."""
    value = F.explode(column) if is_list else F.col(column)
    found = rows.select("cluster_id", "record_id", value.alias("value")).where("value is not null").groupBy("cluster_id", "value").agg(F.count_distinct("record_id").alias("n")).where("n >= 2")
    return found.groupBy("cluster_id").agg(F.array_join(F.array_sort(F.collect_list("value")), ", ").alias(name))


def edge_summary(edges: DataFrame) -> DataFrame:
    r, j, has = F.col("gate_reason"), F.col("name_match_jaccard"), F.bool_or
    return edges.groupBy("cluster_id").agg(
        F.max("match_probability").alias("best_edge_probability"), F.max_by("gate_reason", F.struct("match_probability", "gate_reason")).alias("best_edge_reason"), F.min_by("gate_reason", F.struct("match_probability", "gate_reason")).alias("worst_edge_reason"),
        has(r == "signature").alias("has_signature_edge"), has((r == "exact_email") & (j >= 0.6)).alias("has_email_strong_name"), has((r == "phone") & (j >= 0.6)).alias("has_phone_strong_name"), has((r == "signature") & (F.col("dist_m") > 500)).alias("has_signature_geo_issue"), F.bool_and(r.isin(*CONTACT_REASONS)).alias("contact_only_edges"),
    )


def _points(*terms: tuple[Column, int]) -> Column:
    out = F.lit(0)
    for test, points in terms:
        out = out + F.when(F.coalesce(test, F.lit(False)), points).otherwise(0)
    return out


def _id(prefix: str, *parts: str) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.md5(F.concat_ws("|", *parts)), 1, 16))


TRUE_LIKE = "contact_or_email_true_like_but_failed_coherence"


def review_clusters(clusters: DataFrame, members: DataFrame, edges: DataFrame, records: DataFrame) -> DataFrame:
    """One row for each cluster in review, risks first."""
    rows = base(clusters, members, records)
    out = clusters.where("cluster_status = 'review'").join(member_text(rows), "cluster_id").join(edge_summary(edges), "cluster_id", "left")
    for part in (shared(rows, "phones", "shared_phones"), shared(rows, "emails", "shared_emails"), shared(rows, "domain", "shared_domains", is_list=False)):
        out = out.join(part, "cluster_id", "left")
    has = lambda name: F.array_contains("review_reasons", name)
    size, d, j, contact = (F.col(c) for c in ("cluster_size", "max_geo_diameter_m", "min_pairwise_name_match_jaccard", "has_contact_evidence"))
    email, phone = F.col("has_email_strong_name"), F.col("has_phone_strong_name")
    near = (d <= 500) | contact
    reason = (
        F.when(has("villa_unit_conflict"), "villa_unit_conflict").when(has("brand_conflict"), "brand_conflict").when(has("transitive_drift_geo_gt_1km"), "transitive_drift")
        .when(contact & ((size > 20) | (d > 1000) | (j < 0.45)), "contact_overmerge_risk")
        .when(has("same_provider_duplicate") & (F.size("review_reasons") == 1) & (j >= 0.6) & near, "same_provider_duplicate_only_coherent")
        .when((email | phone) & has("contact_cluster_name_sanity") & (size <= 10), TRUE_LIKE)
        .when(email & (size <= 10) & near, "exact_email_strong_name").when(phone & (size <= 10) & near, "phone_strong_name").when(F.col("has_signature_geo_issue"), "signature_geo_diameter_issue")
        .when(has("same_provider_duplicate"), "same_provider_duplicates").otherwise("needs_more_info")
    )
    out = out.withColumn("review_reason", reason)
    r = F.col("review_reason")
    likely = r.isin(TRUE_LIKE, "exact_email_strong_name", "phone_strong_name", "signature_geo_diameter_issue", "same_provider_duplicate_only_coherent")
    bucket = F.when(likely, "high_confidence_likely_true").when(r == "transitive_drift", "transitive_drift").when(r == "same_provider_duplicates", "same_provider_duplicates").otherwise("contact_overmerge_risk")
    out = out.withColumn("review_bucket", bucket)
    b = F.col("review_bucket")
    score = F.least(size, F.lit(10)) + F.col("provider_count") * 2 + _points(
        (email, 40), (phone, 35), (F.col("has_signature_edge"), 30), (has("same_provider_duplicate"), 20), (has("geo_diameter_gt_500_no_contact"), 20), (has("oversize"), 25), (F.col("contact_only_edges"), 25), (has("transitive_drift_geo_gt_1km"), 30), (has("geo_diameter_gt_10km"), 30),
        (has("villa_unit_conflict"), 30), (has("brand_conflict"), 30), (r == TRUE_LIKE, 15),
    )
    action = F.when((b == "high_confidence_likely_true") & (r == "same_provider_duplicate_only_coherent"), "provider_duplicate").when(b == "high_confidence_likely_true", "accept_cluster").when(b.isin("contact_overmerge_risk", "transitive_drift"), "split_cluster").otherwise("provider_duplicate")
    return out.withColumns({"review_id": _id("RQC_", "cluster_id"), "priority": score.cast("int"), "suggested_action": action, "geo_diameter_m": F.round("max_geo_diameter_m"), "review_entity_type": F.lit("cluster")})


def review_pairs(gated: DataFrame, edges: DataFrame, records: DataFrame) -> DataFrame:
    """Gated pairs below the automatic threshold, and those by a medium name at one place."""
    p, r, d, j = (F.col(c) for c in ("match_probability", "gate_reason", "dist_m", "name_match_jaccard"))
    rows = gated.join(edges.select("record_id_l", "record_id_r").distinct(), ["record_id_l", "record_id_r"], "left_anti").where((r.isin(*AUTO_REASONS) & (p >= 0.90) & (p < 0.99)) | ((r == "medium_name_plus_geo") & (p >= 0.80)))
    for s in "lr":
        rows = rows.join(records.select(F.col("record_id").alias(f"record_id_{s}"), *(F.col(c).alias(f"{c}_{s}") for c in MEMBER_FIELDS[:6])), f"record_id_{s}")
    none = F.array().cast("array<string>")
    both = lambda c: F.array_join(F.array_sort(F.array_intersect(F.coalesce(f"{c}_l", none), F.coalesce(f"{c}_r", none))), ",")
    join = lambda c, same: F.when(same, F.col(f"{c}_l")).otherwise(F.concat(F.coalesce(f"{c}_l", F.lit("")), F.lit(", "), F.coalesce(f"{c}_r", F.lit(""))))
    reason = (
        F.when((r == "exact_email") & (d <= 500), TRUE_LIKE).when((r == "phone") & (j >= 0.6) & (d <= 500), TRUE_LIKE).when((r == "exact_email") & (j >= 0.6), "exact_email_strong_name").when((r == "phone") & (j >= 0.6), "phone_strong_name")
        .when(r == "signature", "signature_review_pair").when(r == "medium_name_plus_geo", "medium_name_plus_geo").otherwise("needs_more_info")
    )
    rows = rows.withColumn("review_reason", reason)
    rr = F.col("review_reason")
    score = F.lit(6) + _points(((r == "exact_email") & ((j >= 0.6) | (d <= 500)), 40), ((r == "phone") & (j >= 0.6), 35), (r == "signature", 30), (r == "medium_name_plus_geo", 10), (rr == TRUE_LIKE, 140))
    return rows.withColumns({
        "review_id": _id("RQE_", "record_id_l", "record_id_r", "gate_reason"), "cluster_id": _id("PAIR_", "record_id_l", "record_id_r"), "cluster_size": F.lit(2).cast("long"), "providers": F.concat_ws(", ", "provider_l", "provider_r"),
        "representative_names": F.concat(F.col("property_name_norm_l"), F.lit(" | "), F.col("property_name_norm_r")), "cities": join("city_name_norm", F.col("city_name_norm_l").eqNullSafe(F.col("city_name_norm_r"))),
        "postal_codes": join("postal_code_final", F.coalesce(F.col("postal_code_final_l") == F.col("postal_code_final_r"), F.lit(False))), "geo_diameter_m": d, "best_edge_probability": p, "best_edge_reason": r, "worst_edge_reason": r,
        "shared_phones": F.nullif(both("phone_last10_non_reused_list"), F.lit("")), "shared_emails": F.nullif(both("email_norm_list"), F.lit("")), "shared_domains": F.when(F.col("website_domain_norm_l") == F.col("website_domain_norm_r"), F.col("website_domain_norm_l")),
        "review_bucket": F.when(rr.isin(TRUE_LIKE, "exact_email_strong_name", "phone_strong_name", "signature_review_pair"), "high_confidence_likely_true").otherwise("medium_name_plus_geo"), "priority": score.cast("int"), "suggested_action": F.lit("accept_pair_only"), "review_entity_type": F.lit("pair"),
    })


def queue(clusters: DataFrame, pairs: DataFrame) -> DataFrame:
    return clusters.select(*QUEUE).unionByName(pairs.select(*QUEUE))


def bucket_samples(rows: DataFrame, per_bucket: int = 200) -> DataFrame:
    return rows.withColumn("bucket_rank", F.expr("row_number() over (partition by review_bucket order by priority desc, best_edge_probability desc, review_id)")).where(F.col("bucket_rank") <= per_bucket)


def top(rows: DataFrame, n: int = 5000) -> DataFrame:
    return rows.orderBy(F.desc("priority"), F.desc("best_edge_probability"), "review_id").limit(n)


def bucket_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("review_bucket", "review_entity_type").agg(F.count("*").alias("item_count"), F.round(F.avg("priority"), 1).alias("avg_priority"), F.max("priority").alias("max_priority"))


def decision_template(spark) -> DataFrame:
    return spark.createDataFrame([], DECISION_TEMPLATE)
