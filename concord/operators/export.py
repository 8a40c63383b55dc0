"""Merged entities for serving: one record of each cluster, the mapping of members, and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Served column, and the normalised column it comes from.
INFO_COLUMNS = {
    "property_name": "property_name", "address_lines": "address_lines", "city_name": "city_name", "city_code": "city_code", "state": "state_norm", "country_code": "country_code_norm", "country_name": "country_name_clean", "postal_code": "postal_code_final",
    "lat": "lat_norm", "lng": "lng_norm", "geohash6": "geohash6_norm", "star_rating": "star_rating_norm", "reviewrating": "average_of_rating_norm", "totalreviewcount": "total_reviews", "number_of_rooms": "number_of_rooms_norm", "hotel_chain": "hotel_chain_norm",
    "property_type": "property_type_norm", "amenities": "amenities", "thumbnail": "thumbnail", "land_mark": "land_mark", "phone_numbers": "phone_numbers", "fax_numbers": "fax_numbers", "emails": "emails", "weburl": "weburl", "check_in_time": "check_in_time", "check_out_time": "check_out_time",
}


def with_entity_ids(members: DataFrame, records: DataFrame, country: str) -> DataFrame:
    """Members with an id for every entity: a record that stands alone gets one from its provider and code."""
    rows = members.join(records.select("record_id", "property_code"), "record_id", "left")
    own = F.concat(F.lit(country + "_GH6-"), F.upper(F.substring(F.md5(F.concat(F.col("provider"), F.lit("::"), F.coalesce("property_code", F.lit("")))), 1, 16)))
    return rows.withColumn("cluster_id", F.coalesce("cluster_id", own))


def entity_info(members: DataFrame, records: DataFrame, columns: dict[str, str] = INFO_COLUMNS) -> DataFrame:
    """Of each entity and column the first value that is given, the representative's before others in order of id."""
    rows = members.select("cluster_id", "record_id", "is_representative").join(records, "record_id")
    kinds = dict(rows.dtypes)
    given = lambda c: F.when(~F.trim(F.col(c)).isin("", "-"), F.col(c)) if kinds[c] == "string" else F.when(F.col(c).isNotNull() & ~(F.isnan(c) if kinds[c] == "double" else F.lit(False)), F.col(c))
    first = lambda c: F.min_by(given(c), F.when(given(c).isNotNull(), F.struct(~F.col("is_representative"), "record_id")))
    return rows.groupBy(F.col("cluster_id").alias("entity_id")).agg(*(first(c).alias(name) for name, c in columns.items() if c in kinds))


def entity_mappings(members: DataFrame, clusters: DataFrame) -> DataFrame:
    """Which provider record is which entity, how it was found, and how sure."""
    rows = members.join(clusters.select("cluster_id", "min_edge_probability"), "cluster_id", "left")
    code = F.coalesce("property_code", F.lit(""))
    return rows.select(
        F.col("cluster_id").alias("entity_id"), F.col("provider").alias("provider_name"), code.alias("provider_code"), F.concat_ws("###", "provider", code).alias("provider_key"), F.col("is_representative").cast("int").alias("is_representative"),
        F.when(F.col("status") == "review_cluster", "review").otherwise("auto").alias("mapping_type"), F.col("min_edge_probability").alias("confidence"),
    )


def entity_summaries(members: DataFrame, records: DataFrame) -> DataFrame:
    """Representative, size, suppliers and members of each entity; breakdown and members as JSON."""
    rows = members.drop("property_code").join(records.select("record_id", "property_code", "property_name", "country_code_norm", "city_name", "lat_norm", "lng_norm"), "record_id")
    by = rows.groupBy("cluster_id", "provider").agg(F.count("*").alias("n")).groupBy("cluster_id").agg(F.array_sort(F.collect_list(F.struct("provider", "n"))).alias("b"))
    listed = F.struct("record_id", F.col("provider").alias("provider_name"), F.col("property_code").alias("provider_code"), F.col("is_representative").cast("int").alias("is_representative"), F.col("property_name").alias("name"), F.col("city_name").alias("city"), F.col("lat_norm").alias("lat"), F.col("lng_norm").alias("lng"))
    rep = F.min(F.struct(~F.col("is_representative"), "record_id", "provider", "property_code", "property_name", "country_code_norm")).alias("rep")
    out = rows.groupBy("cluster_id").agg(F.count("*").alias("cluster_size"), F.count_distinct("provider").alias("supplier_count"), rep, F.array_sort(F.collect_list(listed)).alias("m"))
    return out.join(by, "cluster_id").select(
        F.col("cluster_id").alias("entity_id"), F.col("rep.provider").alias("representative_provider"), F.col("rep.property_code").alias("representative_code"), F.col("rep.property_name").alias("property_name"), F.col("rep.country_code_norm").alias("country_code"), "cluster_size", "supplier_count",
        F.to_json(F.map_from_entries("b")).alias("supplier_breakdown"), F.to_json(F.transform("m", lambda x: x.dropFields("record_id"))).alias("members"),
    )
