"""Reuse of contact values, rates of quality and guardrails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts(records: DataFrame, values: Column) -> DataFrame:
    """value, record_count, provider_count over records; a record counts once for a value."""
    rows = records.select("record_id", "provider", F.explode(F.array_distinct(values)).alias("value")).where("value is not null")
    return rows.groupBy("value").agg(F.count_distinct("record_id").alias("record_count"), F.count_distinct("provider").alias("provider_count"))


def reused(records: DataFrame, values: Column, reuse_min: int) -> DataFrame:
    return value_counts(records, values).where(F.col("record_count") >= reuse_min)


def mark_reuse(records: DataFrame, column: str, reuse_min: int, flag: str, rest: str | None = None) -> DataFrame:
    """records with whether any value is reused and, if asked for, the values that aren't (null where the list is)."""
    often = reused(records, F.col(column), reuse_min).select("value")
    hit = records.select("record_id", F.explode(column).alias("value")).join(often, "value").groupBy("record_id").agg(F.collect_set("value").alias("__often"))
    rows = records.join(hit, "record_id", "left").withColumn(flag, F.col("__often").isNotNull())
    if rest:
        rows = rows.withColumn(rest, F.when(F.col("__often").isNull(), F.array_distinct(column)).otherwise(F.array_except(column, F.coalesce("__often", F.array().cast("array<string>")))))
    return rows.drop("__often")


def top_reused(records: DataFrame, values: Column, top: int = 200) -> DataFrame:
    """The report's rows: most reused values first."""
    return value_counts(records, values).orderBy(F.desc("record_count"), "value").limit(top)


#: Rates of the quality report: name and condition; nulls of a condition don't count.
RATES = {
    "country_missing_rate": "country_code_norm is null", "name_missing_rate": "property_name_norm is null", "core_empty_rate": "property_name_core_empty", "city_missing_rate": "city_name_norm is null",
    "state_missing_rate": "state_norm is null", "coords_valid_rate": "lat_lng_valid", "low_precision_coord_rate": "lat_lng_low_precision", "postal_present_rate": "postal_code_final is not null",
    "phone_present_rate": "phone_valid_count > 0", "email_present_rate": "size(email_norm_list) > 0", "domain_present_rate": "website_domain_norm is not null", "star_missing_rate": "star_rating_norm is null",
    "type_unknown_rate": "property_type_norm = 'unknown'", "chain_present_rate": "hotel_chain_norm is not null",
}


def rates(names=RATES) -> list[Column]:
    return [F.avg(F.expr(RATES[n]).cast("double")).alias(n) for n in names]


def headline(records: DataFrame, names=RATES) -> DataFrame:
    return records.agg(F.count("*").alias("records"), *rates(names))


def provider_quality(records: DataFrame) -> DataFrame:
    return records.groupBy("provider").agg(F.count("*").alias("records"), *rates([n for n in RATES if n not in ("country_missing_rate", "state_missing_rate")]))


#: The most that a rate may be.
GUARDRAILS = {"country_missing_rate": 0.01, "name_missing_rate": 0.005, "core_empty_rate": 0.20}


def guardrails(rates_frame: DataFrame) -> DataFrame:
    """guardrail, value, most, passed; a null value fails."""
    rows = F.explode(F.array(*(F.struct(F.lit(n).alias("guardrail"), F.col(n).alias("value"), F.lit(most).alias("most")) for n, most in GUARDRAILS.items())))
    return rates_frame.select(rows.alias("g")).select("g.*").withColumn("passed", F.coalesce(F.col("value") <= F.col("most"), F.lit(False)))


class GuardrailError(RuntimeError):
    pass


def enforce(rates_frame: DataFrame) -> None:
    bad = [r.guardrail for r in guardrails(rates_frame).where("not passed").collect()]  # three rows at most
    if bad:
        raise GuardrailError(", ".join(bad))


def document_rows(records: DataFrame, stats: DataFrame, rare: DataFrame, rare_city: DataFrame, policy) -> DataFrame:
    """section, name, value of the diagnostics document: totals, records of each provider, rates, guardrails and sizes of the policy."""
    spark = records.sparkSession
    head = headline(records)
    long = lambda df, section: df.select(F.lit(section).alias("section"), F.explode(F.map_from_arrays(F.array(*map(F.lit, df.columns)), F.array(*(F.col(c).cast("double") for c in df.columns)))).alias("name", "value"))
    sizes = {"low_value_global": len(policy.low_value), "brand_tokens": len(policy.brand), "location_descriptors": len(policy.location)}
    counted = [(rare.agg(F.count("*")), "rare_global_tokens"), (rare_city.agg(F.count_distinct("city_name_norm")), "rare_city_tokens_cities")]
    rows = long(head, "rates").unionByName(records.groupBy("provider").agg(F.count("*").cast("double").alias("value")).select(F.lit("records_per_provider").alias("section"), F.col("provider").alias("name"), "value"))
    rows = rows.unionByName(guardrails(head).select(F.lit("guardrails").alias("section"), F.col("guardrail").alias("name"), F.col("passed").cast("double").alias("value")))
    rows = rows.unionByName(spark.createDataFrame([("token_policy_sizes", k, float(v)) for k, v in sizes.items()], rows.schema))
    for frame, name in counted:
        rows = rows.unionByName(frame.toDF("value").select(F.lit("token_policy_sizes").alias("section"), F.lit(name).alias("name"), F.col("value").cast("double")))
    return rows.unionByName(stats.agg(F.count("*").cast("double").alias("value")).select(F.lit("tokens").alias("section"), F.lit("distinct_global_tokens").alias("name"), "value"))


def document(rows: DataFrame, **about) -> dict:
    """The diagnostics document: about, and the rows by section; as many as there are providers and rates."""
    out = dict(about)
    for r in rows.collect():
        out.setdefault(r.section, {})[r.name] = r.value
    out["guardrails_passed"] = all(out["guardrails"].values())
    return out
