"""Queries of the exploring front: lists, histograms, searches, cities and neighbours."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.functions.geo import asin_distance


def size_histogram(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy("cluster_size").agg(F.count_if(F.col("cluster_status") == "auto_accept").alias("auto_accept"), F.count_if(F.col("cluster_status") == "review").alias("review"))


def city_stats(members: DataFrame, records: DataFrame) -> DataFrame:
    rows = members.select("record_id", "cluster_id", "status").join(records.select("record_id", "provider", "city_name_norm"), "record_id")
    n = lambda s, name: F.count_if(F.col("status") == s).alias(name)
    return rows.groupBy(F.coalesce("city_name_norm", F.lit("(no city)")).alias("city")).agg(
        F.count("*").alias("records"), n("matched_cluster", "matched_records"), n("review_cluster", "review_records"), n("singleton_unmatched", "unmapped_records"), F.count_distinct("cluster_id").alias("clusters"), F.count_distinct("provider").alias("providers"),
    )


def centroids(clusters: DataFrame, members: DataFrame, records: DataFrame) -> DataFrame:
    rows = members.where("cluster_id is not null").select("cluster_id", "record_id", "is_representative").join(records.select("record_id", "lat_norm", "lng_norm", "city_name_norm", "property_name_norm"), "record_id")
    city = rows.where("city_name_norm is not null").groupBy("cluster_id", "city_name_norm").agg(F.count("*").alias("n")).groupBy("cluster_id").agg(F.max_by("city_name_norm", F.struct("n", "city_name_norm")).alias("city"))
    mid = rows.groupBy("cluster_id").agg(F.avg("lat_norm").alias("lat"), F.avg("lng_norm").alias("lng"), F.min_by("property_name_norm", F.struct(~F.col("is_representative"), "record_id")).alias("rep_name"))
    return mid.join(city, "cluster_id", "left").join(clusters.select("cluster_id", "cluster_status", "cluster_size", "provider_count", "entity_level"), "cluster_id")


SORTS = {"cluster_size": "cluster_size", "provider_count": "provider_count", "geo": "max_geo_diameter_m", "prob": "min_edge_probability", "name_share": "dominant_name_signature_share"}


def search_clusters(clusters: DataFrame, members: DataFrame, records: DataFrame, search: str | None = None, status: str | None = None, provider: str | None = None, contact: bool | None = None, min_size: int = 2, sort: str = "cluster_size", descending: bool = True, page: int = 1, page_size: int = 50) -> DataFrame:
    """A page of clusters by filters; search is in the id or any member's name."""
    rows = clusters.where(F.col("cluster_size") >= max(2, min_size))
    for value, test in ((status, F.col("cluster_status") == status), (provider, F.array_contains("providers_present", provider or "")), (contact, F.col("has_contact_evidence") == F.lit(contact))):
        rows = rows.where(test) if value is not None else rows
    if search:
        like = pattern_of(search)
        named = members.join(records.where(F.col("property_name_norm").ilike(like)).select("record_id"), "record_id", "left_semi").select("cluster_id").distinct().withColumn("__named", F.lit(True))
        rows = rows.join(named, "cluster_id", "left").where(F.col("cluster_id").ilike(like) | F.col("__named")).drop("__named")
    order = F.col(SORTS.get(sort, "cluster_size"))
    return rows.orderBy(order.desc_nulls_last() if descending else order.asc_nulls_last(), "cluster_id").offset((page - 1) * page_size).limit(page_size)


def pattern_of(search: str) -> str:
    """A LIKE pattern that finds a text anywhere, taken literally."""
    return "%" + search.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%"


def page_of(rows: DataFrame, page: int, size: int, most: int) -> DataFrame:
    """A page of ordered rows, of one to ``most``."""
    size = min(most, max(1, size))
    return rows.offset((max(1, page) - 1) * size).limit(size)


def overview(**sections: DataFrame) -> DataFrame:
    """section, name, value: each frame of one row, or of (name, value), as a section of the first screen."""
    found = []
    for section, df in sections.items():
        if set(df.columns) != {"name", "value"}:
            df = df.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, df.columns)), F.array(*(F.col(c).cast("double") for c in df.columns)))).alias("name", "value"))
        found.append(df.select(F.lit(section).alias("section"), "name", F.col("value").cast("double").alias("value")))
    return reduce(DataFrame.unionByName, found)


QUEUE_SEARCH = ("review_id", "cluster_id", "representative_names", "providers", "cities")


def queue_rows(queue: DataFrame, bucket: str = "", action: str = "", search: str = "") -> DataFrame:
    """The items of the review queue that a front's filters leave; as many as the front's total."""
    rows = queue.where(F.col("review_bucket") == bucket) if bucket else queue
    rows = rows.where(F.col("suggested_action") == action) if action else rows
    if search:
        like = pattern_of(search)
        rows = rows.where(reduce(lambda a, b: a | b, (F.coalesce(F.col(c).ilike(like), F.lit(False)) for c in QUEUE_SEARCH)))
    return rows


def queue_page(queue: DataFrame, bucket: str = "", action: str = "", search: str = "", page: int = 1, page_size: int = 50) -> DataFrame:
    """A page of the review queue, most urgent first."""
    rows = queue_rows(queue, bucket, action, search).orderBy(F.desc("priority"), F.desc("best_edge_probability"), "review_id")
    return page_of(rows, page, page_size, 200).withColumns({"geo_diameter_m": F.round("geo_diameter_m", 1), "best_edge_probability": F.round("best_edge_probability", 4)})


def queue_of_csv(spark, path: str) -> DataFrame:
    """The queue's exported top as it was written, where the whole queue isn't at hand; the kind of an item is in its id."""
    rows = spark.read.csv(path, header=True, inferSchema=True)
    return rows.withColumn("review_entity_type", F.when(F.col("review_id").startswith("RQC_"), "cluster").otherwise("pair"))


REVIEW_ID = re.compile(r"^(RQC|RQE)_[A-Fa-f0-9]+$")


def review_members(item: DataFrame, members: DataFrame, records: DataFrame, most: int = 500) -> DataFrame:
    """The records of one item of the queue (one row): of its cluster, or the two of its pair."""
    item = F.broadcast(item.limit(1))
    of_cluster = members.join(item.select("cluster_id"), "cluster_id").select("record_id")
    if "record_id_l" in item.columns:
        of_cluster = item.select(F.explode(F.array("record_id_l", "record_id_r")).alias("record_id"))
    rows = of_cluster.join(records, "record_id").select("record_id", "provider", F.col("property_name_norm").alias("name"), F.col("city_name_norm").alias("city"), F.col("postal_code_final").alias("postal_code"), F.round("lat_norm", 6).alias("lat_norm"), F.round("lng_norm", 6).alias("lng_norm"))
    return rows.orderBy("provider", "record_id").limit(most)


def review_edges(item: DataFrame, edges: DataFrame, most: int = 500) -> DataFrame:
    """The links of one item of the queue (one row), best first."""
    on = ["record_id_l", "record_id_r"] if "record_id_l" in item.columns else ["cluster_id"]
    rows = edges.join(F.broadcast(item.select(*on).limit(1)), on, "left_semi")
    rows = rows.select("provider_l", "provider_r", F.round("match_probability", 4).alias("match_probability"), "gate_reason", F.round("name_match_jaccard", 3).alias("name_match_jaccard"), "sig_exact", F.round("dist_m", 1).alias("dist_m"), "phone_ov", "record_id_l", "record_id_r")
    return rows.orderBy(F.desc("match_probability"), "record_id_l", "record_id_r").limit(most)


def review_detail(review_id: str, clusters: DataFrame, pairs: DataFrame, members: DataFrame, cluster_edges: DataFrame, pair_edges: DataFrame, records: DataFrame, decisions: DataFrame | None = None) -> dict[str, DataFrame]:
    """meta, members, edges and decision of one item; clusters and pairs are the queue's items of each kind."""
    if not REVIEW_ID.match(review_id):
        raise ValueError("no review id")
    is_cluster = review_id.startswith("RQC_")
    item = (clusters if is_cluster else pairs).where(F.col("review_id") == review_id)
    out = {"meta": item, "members": review_members(item, members, records), "edges": review_edges(item, cluster_edges if is_cluster else pair_edges)}
    if decisions is not None:
        out["decision"] = latest_decisions(decisions.where(F.col("review_id") == review_id))
    return out


def cities(stats: DataFrame, search: str = "", page: int = 1, page_size: int = 30) -> DataFrame:
    """A page of the cities, largest first, with the share of records that are matched."""
    rows = stats.where(F.col("city").ilike(pattern_of(search))) if search else stats
    rows = rows.withColumn("matched_share", F.round(F.try_divide("matched_records", "records"), 4))
    return page_of(rows.orderBy(F.desc("records"), "city"), page, page_size, 100)


def city_clusters(middles: DataFrame, city: str, most: int = 200) -> DataFrame:
    """The largest clusters of a city, with their centres."""
    rows = middles.where(F.col("city") == city).select("cluster_id", "cluster_status", "cluster_size", "provider_count", "entity_level", "rep_name", F.round("lat", 5).alias("lat"), F.round("lng", 5).alias("lng"))
    return rows.orderBy(F.desc("cluster_size"), "cluster_id").limit(most)


def cluster_detail(cluster_id: str, members: DataFrame, records: DataFrame) -> DataFrame:
    """The members of a cluster with their distance to its centre."""
    rows = members.where(F.col("cluster_id") == cluster_id).join(records.drop("provider"), "record_id")
    centre = rows.agg(F.avg("lat_norm").alias("c_lat"), F.avg("lng_norm").alias("c_lng"))
    return rows.crossJoin(F.broadcast(centre)).withColumn("dist_to_centroid_m", asin_distance(F.col("lat_norm"), F.col("lng_norm"), F.col("c_lat"), F.col("c_lng"))).drop("c_lat", "c_lng")


def unmapped(members: DataFrame, records: DataFrame, city: str | None = None, provider: str | None = None) -> DataFrame:
    rows = members.where("status = 'singleton_unmatched'").select("record_id").join(records, "record_id")
    rows = rows.where(F.col("city_name_norm") == city) if city is not None else rows
    return rows.where(F.col("provider") == provider) if provider is not None else rows


def nearest_clusters(record: DataFrame, middles: DataFrame, k: int = 8) -> DataFrame:
    """The k clusters nearest to the one record; those of its city where it has no place. The record is one row."""
    r = F.broadcast(record.select(F.col("lat_norm").alias("r_lat"), F.col("lng_norm").alias("r_lng"), F.col("city_name_norm").alias("r_city")).limit(1))
    rows = middles.crossJoin(r).withColumns({"dist_m": F.round(asin_distance(F.col("r_lat"), F.col("r_lng"), F.col("lat"), F.col("lng"))), "same_city": F.col("city").eqNullSafe(F.col("r_city"))})
    placed = F.col("r_lat").isNotNull() & F.col("r_lng").isNotNull()
    rows = rows.where((placed & F.col("dist_m").isNotNull()) | (~placed & F.col("same_city")))
    return rows.orderBy(F.col("dist_m").asc_nulls_last(), F.desc("cluster_size"), "cluster_id").limit(k).drop("r_lat", "r_lng", "r_city")


def latest_decisions(log: DataFrame) -> DataFrame:
    """The last row of each review_id by seq."""
    last = F.max_by(F.struct(*log.columns), F.struct("seq")).alias("last")
    return log.groupBy("review_id").agg(last).select("last.*")
