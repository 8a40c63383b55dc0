"""The identity gate: why a pair may match. Place alone is never a reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.functions.geo import acos_distance
from concord.functions.text import jaccard
from concord.operators.scoring import EVIDENCE, band, evidence, name_band, prepared, with_fields

#: Bands for setting thresholds.
BANDS = (("ge_0_995", 0.995, 1.01), ("b_099_0995", 0.99, 0.995), ("b_098_099", 0.98, 0.99), ("b_095_098", 0.95, 0.98), ("b_090_095", 0.90, 0.95), ("b_080_090", 0.80, 0.90))
FLOOR = 0.80


def features(scored: DataFrame, records: DataFrame, strict_null_geo: bool = False) -> DataFrame:
    """Evidence of pairs above the floor (records are read if the pairs do not carry it), with gate_reason, band and name_level."""
    rows = scored.where(F.col("match_probability") >= FLOOR)
    c, false = F.col, F.lit(False)
    if strict_null_geo or not set(EVIDENCE) <= set(rows.columns):
        t, place = "property_name_match_tokens", [f"{x}_{s}" for s in "lr" for x in ("lat_norm", "lng_norm")]
        rows = with_fields(rows.drop(*EVIDENCE), prepared(records))
        rows = rows.withColumns(evidence(jaccard(c(f"{t}_l"), c(f"{t}_r"))) | {"same_city": c("city_name_norm_l").eqNullSafe(c("city_name_norm_r"))})
        rows = rows.withColumn("dist_m", acos_distance(*map(c, place), strict_null_geo))
    rows = rows.withColumns({x: F.coalesce(x, false) for x in ("sig_exact", "phone_ov", "domain_ok")}).withColumnRenamed("name_jac", "name_match_jaccard")
    j = c("name_match_jaccard")
    reason = F.when(c("phone_ov"), "phone").when(c("email_ov"), "exact_email").when(c("domain_ok"), "non_reused_domain").when(c("sig_exact"), "signature").when(j >= 0.85, "strong_name").when((j >= 0.45) & (c("dist_m") <= 200), "medium_name_plus_geo").otherwise("none")
    rows = rows.withColumns({"gate_reason": reason, "band": band(c("match_probability"), BANDS), "name_level": name_band("name_match_jaccard")})
    return rows.select("record_id_l", "record_id_r", "provider_l", "provider_r", "match_probability", "gate_reason", "name_level", "name_match_jaccard", "dist_m", "sig_exact", "phone_ov", "email_ov", "domain_ok", "same_city", "same_postal", "band")


def gated(rows: DataFrame) -> DataFrame:
    return rows.where("gate_reason <> 'none'")


def band_profile(rows: DataFrame) -> DataFrame:
    rate = lambda e, name: F.round(F.avg(F.expr(e).cast("double")), 3).alias(name)
    return rows.groupBy("band").agg(
        F.count("*").alias("pairs"), F.count_distinct("record_id_l").alias("records_l"), F.count_distinct("record_id_r").alias("records_r"), rate("sig_exact", "sig_rate"), rate("phone_ov", "phone_rate"), rate("email_ov", "email_rate"),
        rate("domain_ok", "domain_rate"), rate("same_city", "city_rate"), rate("same_postal", "postal_rate"), rate("gate_reason <> 'none'", "gated_rate"), F.round(F.median("dist_m")).alias("median_dist_m"), F.round(F.percentile("dist_m", 0.95)).alias("p95_dist_m"),
    )


def crosstab(rows: DataFrame, by: str) -> DataFrame:
    """Gated pairs by band and gate_reason or name_level."""
    return gated(rows).groupBy("band", by).agg(F.count("*").alias("c"))


def headline(rows: DataFrame) -> DataFrame:
    """One row: pairs over the floor, gated ones, those of each policy, and those that fail the gate."""
    p, some = F.col("match_probability"), F.col("gate_reason") != "none"
    n = lambda c, name: F.count_if(c).alias(name)
    return rows.agg(F.count("*").alias("pairs_ge_080"), n(some, "gated_ge_080"), n(some & (p >= 0.99), "gated_ge_099"), n(some & (p >= 0.90) & (p < 0.99), "gated_review_090_099"), n(~some, "failed_gate_ge_080"))


def provider_pairs(rows: DataFrame, top: int = 100) -> DataFrame:
    return rows.where("match_probability >= 0.9").groupBy("provider_l", "provider_r").agg(F.count("*").alias("pairs")).orderBy(F.desc("pairs"), "provider_l", "provider_r").limit(top)


def policy(rows: DataFrame) -> DataFrame:
    """Pairs by what becomes of them: auto from 0.99, review from 0.90, rejected."""
    p = F.col("match_probability")
    return gated(rows).groupBy(F.when(p >= 0.99, "auto_match").when(p >= 0.90, "review").otherwise("rejected").alias("policy")).agg(F.count("*").alias("pairs"))


def delta(old: DataFrame, new: DataFrame) -> DataFrame:
    """metric, old, new, delta of two frames of one row: how a version changed."""
    long = lambda df, name: df.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, df.columns)), F.array(*(F.col(c).cast("double") for c in df.columns)))).alias("metric", name))
    return long(old, "old").join(long(new, "new"), "metric", "full").withColumn("delta", F.col("new") - F.col("old"))
