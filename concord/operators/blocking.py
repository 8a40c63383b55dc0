"""Blocking: keys of candidate pairs, their diagnostics without making pairs, and the pairs themselves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.sources.checkpoints import written

#: Postal codes that are no codes.
JUNK_POSTAL = ("111111", "123456", "100000", "999999", "654321", "121212")


def keyed(records: DataFrame, *parts: Column) -> DataFrame:
    """record_id, provider, block_key of the rows in which no part is null."""
    rows = records
    for p in parts:
        rows = rows.where(p.isNotNull())
    return rows.select("record_id", "provider", F.concat_ws("|", *parts).alias("block_key"))


def _text(c: str) -> Column:
    return F.nullif(F.col(c), F.lit(""))


def same_cell(records: DataFrame, cell: str = "cell") -> DataFrame:
    return keyed(records, F.col("country_code_norm"), F.col(cell))


def same_city_postal(records: DataFrame, pattern: str = "^[1-9][0-9]{5}$") -> DataFrame:
    ok = F.col("postal_code_final").rlike(pattern) & ~F.col("postal_code_final").isin(*JUNK_POSTAL)
    return keyed(records.where(ok), F.col("country_code_norm"), F.col("city_name_norm"), F.col("postal_code_final"))


def _digest(c: str) -> Column:
    """128 bits in place of a name of any length, which would be exchanged with every key."""
    return F.md5(_text(c))


def same_city_signature(records: DataFrame) -> DataFrame:
    return keyed(records, F.col("country_code_norm"), F.col("city_name_norm"), _digest("property_name_signature"))


def same_city_postal_token(records: DataFrame, pattern: str | None = None) -> DataFrame:
    """The token is the key's last part. Scoring takes all codes; diagnostics those of a pattern that are no junk."""
    if pattern is not None:
        records = records.where(F.col("postal_code_final").rlike(pattern) & ~F.col("postal_code_final").isin(*JUNK_POSTAL))
    rows = records.withColumn("__token", F.explode(F.array_distinct("property_name_blocking_tokens")))
    return keyed(rows, F.col("country_code_norm"), F.col("city_name_norm"), F.col("postal_code_final"), F.col("__token"))


def shared_phone(records: DataFrame) -> DataFrame:
    """Phones that are not reused, by the threshold that normalising was given."""
    rows = records.select("record_id", "provider", "country_code_norm", F.explode(F.array_distinct("phone_last10_non_reused_list")).alias("phone"))
    return keyed(rows, F.col("country_code_norm"), F.col("phone"))


def same_place_match_signature(records: DataFrame, cell: str = "cell_wide") -> DataFrame:
    return keyed(records, F.col("country_code_norm"), F.col(cell), _digest("property_name_match_signature"))


def rules(pattern: str = "^[1-9][0-9]{5}$") -> dict:
    """Rules by name, for diagnostics; pattern: what a country's postal codes look like."""
    return {
        "same_country_cell": same_cell, "same_country_geohash6": lambda r: same_cell(r, "geohash6_norm"),
        "same_country_city_postal": lambda r: same_city_postal(r, pattern), "same_country_city_name_signature": same_city_signature,
        "same_country_city_postal_nametoken": lambda r: same_city_postal_token(r, pattern), "shared_non_reused_phone": shared_phone,
    }


#: The rules that make candidates for scoring, in order: a pair has the first that finds it.
SCORING_RULES = (same_cell, same_city_signature, same_city_postal_token, shared_phone, same_place_match_signature)


def block_counts(eligible: DataFrame) -> DataFrame:
    """block_key, provider, cnt."""
    return eligible.groupBy("block_key", "provider").agg(F.count("*").alias("cnt"))


def blocks(counts: DataFrame) -> DataFrame:
    """block_key, n_records, n_providers, candidate_pairs across providers: (S^2 - sum c^2) / 2, no pair is made."""
    s, q = F.sum("cnt"), F.sum(F.col("cnt") * F.col("cnt"))
    return counts.groupBy("block_key").agg(s.alias("n_records"), F.count("*").alias("n_providers"), ((s * s - q) / 2).cast("long").alias("candidate_pairs"))


def rule_summary(eligible: DataFrame, rule: str) -> DataFrame:
    """One row of totals, largest block and percentiles over blocks with pairs; covered: memberships in such blocks."""
    return summary_of(block_counts(eligible), rule)


def summary_of(counts: DataFrame, rule: str) -> DataFrame:
    some = blocks(counts).where("candidate_pairs > 0")
    p = lambda c, q: F.percentile(c, q).alias(f"p{int(q * 100)}_{c}")
    return some.agg(
        F.lit(rule).alias("rule"), F.coalesce(F.sum("candidate_pairs"), F.lit(0)).alias("total_pairs"), F.count("*").alias("n_blocks"), F.max("n_records").alias("max_block_records"), F.max("candidate_pairs").alias("max_block_pairs"),
        *(p(c, q) for c in ("n_records", "candidate_pairs") for q in (0.5, 0.95, 0.99)), F.coalesce(F.sum("n_records"), F.lit(0)).alias("covered_records"),
    )


def invalid_place_share(eligible: DataFrame, records: DataFrame) -> DataFrame:
    return eligible.join(records.select("record_id", "lat_lng_valid"), "record_id").agg(F.avg(F.when(F.coalesce("lat_lng_valid", F.lit(False)), 0.0).otherwise(1.0)).alias("invalid_coord_share"))


def provider_pair_counts(counts: DataFrame) -> DataFrame:
    """provider_l, provider_r, pairs: the products of counts in a block, summed."""
    b = counts.select("block_key", F.col("provider").alias("provider_r"), F.col("cnt").alias("cnt_r"))
    a = counts.withColumnsRenamed({"provider": "provider_l", "cnt": "cnt_l"})
    return a.join(b, "block_key").where("provider_l < provider_r").groupBy("provider_l", "provider_r").agg(F.sum(F.col("cnt_l") * F.col("cnt_r")).alias("pairs"))


def large_blocks(eligible: DataFrame, top: int = 100, members: int = 8) -> DataFrame:
    """Members of the largest blocks, a few of each by hash."""
    largest = blocks(block_counts(eligible)).where("candidate_pairs > 0").orderBy(F.desc("candidate_pairs"), "block_key").limit(top)
    rows = eligible.join(largest, "block_key").withColumn("__h", F.md5(F.concat("block_key", "record_id")))
    return rows.withColumn("rn", F.expr("row_number() over (partition by block_key order by __h, record_id)")).where(F.col("rn") <= members).drop("__h")


def token_contributions(eligible: DataFrame) -> DataFrame:
    """Blocks and pairs of each name token, the last part of the key."""
    return tokens_of(block_counts(eligible))


def tokens_of(counts: DataFrame) -> DataFrame:
    return blocks(counts).withColumn("token", F.element_at(F.split("block_key", r"\|"), -1)).groupBy("token").agg(F.count("*").alias("n_blocks"), F.sum("candidate_pairs").alias("candidate_pairs"))


def pairs(eligible: DataFrame) -> DataFrame:
    """record_id_l, record_id_r, provider_l < provider_r that share a key, once each. An equi-join on the key, which adaptive execution can split."""
    side = lambda s: eligible.select("block_key", F.col("record_id").alias(f"record_id_{s}"), F.col("provider").alias(f"provider_{s}"))
    return side("l").join(side("r"), "block_key").where("provider_l < provider_r").select("record_id_l", "record_id_r", "provider_l", "provider_r").distinct()


def sample_pairs(eligible: DataFrame, records: DataFrame, limit: int = 500, largest: int = 2000) -> DataFrame:
    """Some pairs of blocks of bounded size, by hash, with the names: a sample for people."""
    small = blocks(block_counts(eligible)).where(F.col("candidate_pairs").between(1, largest)).select("block_key")
    found = pairs(eligible.join(small, "block_key", "left_semi")).orderBy(F.md5(F.concat("record_id_l", F.lit("|"), "record_id_r"))).limit(limit)
    name = lambda s: records.select(F.col("record_id").alias(f"record_id_{s}"), F.col("property_name_norm").alias(f"name_{s}"))
    return found.join(name("l"), "record_id_l").join(name("r"), "record_id_r")


def candidates(records: DataFrame, rules=SCORING_RULES) -> DataFrame:
    """Pairs of all rules, each once, with match_key, the number of the first rule that finds it."""
    found = [pairs(rule(records)).withColumn("match_key", F.lit(i)) for i, rule in enumerate(rules)]
    return reduce(DataFrame.unionByName, found).groupBy("record_id_l", "record_id_r", "provider_l", "provider_r").agg(F.min("match_key").alias("match_key"))


#: Limits of the guardrails.
LIMITS = {"block_pairs_warn": 1_000_000, "rule_pairs_fail": 100_000_000, "invalid_geo_share_warn": 0.05, "provider_pair_dominance_warn": 0.5, "token_dominance_warn": 0.25}


def guardrails(summary: dict, shares: dict, limits: dict = LIMITS) -> dict:
    """fail and warn messages from a rule's summary and its largest shares (invalid_geo_share, provider_pair_dominance, token_dominance)."""
    out = {"fail": [], "warn": []}
    if summary["total_pairs"] > limits["rule_pairs_fail"]:
        out["fail"].append(f"rule makes {summary['total_pairs']} pairs")
    if (summary["max_block_pairs"] or 0) > limits["block_pairs_warn"]:
        out["warn"].append(f"a block makes {summary['max_block_pairs']} pairs")
    out["warn"] += [f"{k} is {v:.3f}" for k, v in shares.items() if (v or 0) > limits[f"{k}_warn"]]
    return out


class BlockingError(RuntimeError):
    pass


def summaries(records: DataFrame, pattern: str = "^[1-9][0-9]{5}$") -> DataFrame:
    """rule_summary of each rule."""
    return reduce(DataFrame.unionByName, [rule_summary(rule(records), name) for name, rule in rules(pattern).items()])


def diagnose(records: DataFrame, pattern: str = "^[1-9][0-9]{5}$", limits: dict = LIMITS) -> dict:
    """Each rule's summary, largest shares and guardrails, by counts alone: no pair is made."""
    limits, out = LIMITS | limits, {}
    for name, rule in rules(pattern).items():
        counts = written(block_counts(rule(records)), "blocks")  # a row for each block and provider
        summary = summary_of(counts, name).first().asDict()
        largest = lambda rows, column: (rows.agg(F.max(column)).first()[0] or 0) / max(summary["total_pairs"], 1)
        shares = {"invalid_geo_share": invalid_place_share(rule(records), records).first()[0], "provider_pair_dominance": largest(provider_pair_counts(counts), "pairs")}
        if name.endswith("nametoken"):
            shares["token_dominance"] = largest(tokens_of(counts), "candidate_pairs")
        out[name] = {"summary": summary, "shares": shares, **guardrails(summary, shares, limits)}
    return out


def scoring_pairs(records: DataFrame, by=SCORING_RULES) -> list[int]:
    """How many pairs each rule of scoring makes, pairs of several rules counted in each; none is made."""
    return [int(blocks(block_counts(rule(records))).agg(F.coalesce(F.sum("candidate_pairs"), F.lit(0))).first()[0]) for rule in by]


def enforce(made: list[int], limits: dict = LIMITS) -> None:
    """Stop before a rule of scoring explodes."""
    bad = [f"scoring rule {i} makes {n} pairs" for i, n in enumerate(made) if n > (LIMITS | limits)["rule_pairs_fail"]]
    if bad:
        raise BlockingError(", ".join(bad))
