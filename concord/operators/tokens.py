"""Token statistics, token policy, and the tokens for blocking and matching."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.functions.fields import NO_CHAIN
from concord.functions.text import one_of, signature
from concord.sources.checkpoints import step, written

#: Words too weak to match names by.
MATCH_WEAK = (
    "hotel", "hotels", "inn", "resort", "resorts", "room", "rooms", "stay", "stays", "suite", "suites",
    "hostel", "hostels", "lodge", "lodges", "villa", "villas", "apartment", "apartments", "guest", "house",
)


@dataclass(frozen=True)
class TokenConfig:
    min_len: int = 2
    low_value_ratio: float = 0.005
    low_value_cities: int = 20
    low_value_providers: int = 4
    rare_max: int = 2
    rare_len: int = 4
    rare_city: tuple[int, int] = (2, 50)
    rare_city_cities: int = 50
    brand_chain_min: int = 30
    blocking_ratio: float = 0.001
    blocking_len: int = 4
    match_ratio: float = 0.01
    match_len: int = 4
    city_ratio: float = 0.02
    city_freq: int = 20
    city_providers: int = 4
    city_names: int = 10
    area_keep_max: int = 200


@dataclass(frozen=True)
class Policy:
    """Manual word lists; small, and constants in the plan."""

    brand: tuple[str, ...] = ()
    location: tuple[str, ...] = ()
    low_value: tuple[str, ...] = ()
    force_keep: tuple[str, ...] = ()

    def merged(self, low_value=()) -> Policy:
        """With generated low-value words; a word is in one list: brand, then location, then low value; kept words in none."""
        keep = set(self.force_keep)
        brand = set(self.brand) - keep
        location = set(self.location) - keep - brand
        low = (set(self.low_value) | set(low_value)) - keep - brand - location
        return Policy(tuple(sorted(brand)), tuple(sorted(location)), tuple(sorted(low)), tuple(sorted(keep)))


def words(records: DataFrame, min_len: int = 2) -> DataFrame:
    """The distinct tokens of each record, with a hash of the record's sorted name: no later step needs the names themselves. Record ids are unique."""
    name = F.xxhash64("property_name_sorted_tokens").alias("name_hash")
    return records.select("record_id", "provider", "city_name_norm", "cell", name, F.filter(F.array_distinct("property_name_tokens"), lambda t: F.length(t) >= min_len).alias("tokens"))


def each(rows: DataFrame) -> DataFrame:
    """words, a row for each token."""
    return rows.select("record_id", "provider", "city_name_norm", "cell", "name_hash", F.explode("tokens").alias("token"))


def exploded(records: DataFrame, min_len: int = 2) -> DataFrame:
    """Each token of each record once."""
    return each(words(records, min_len))


def chain_words(records: DataFrame) -> DataFrame:
    chains = records.where(F.col("hotel_chain_clean").isNotNull() & ~F.col("hotel_chain_clean").isin(*NO_CHAIN))
    return chains.select(F.explode(F.split("hotel_chain_clean", " ")).alias("token")).groupBy("token").agg(F.count("*").alias("chain_field_count"))


def global_stats(records: DataFrame, tokens: DataFrame) -> DataFrame:
    total = records.agg(F.count("*").alias("total"))

    def coverage(c: str, name: str) -> DataFrame:
        """Records and distinct values, null being one, of each token. One column at a time: all in one aggregate exchange every token three times at once."""
        return step(tokens.groupBy("token", c).agg(F.count("*").alias("n")).groupBy("token").agg(F.sum("n").alias("doc_freq"), F.count("*").alias(name)), "coverage")

    stats = coverage("provider", "provider_coverage")
    for c, name in (("city_name_norm", "city_coverage"), ("cell", "cell_coverage")):
        stats = stats.join(coverage(c, name).drop("doc_freq"), "token")
    return (
        stats.crossJoin(F.broadcast(total))  # one row
        .withColumn("doc_freq_ratio", F.col("doc_freq") / F.col("total")).drop("total")
        .withColumn("token_length", F.length("token")).withColumn("is_numeric", F.col("token").rlike("^[0-9]+$")).withColumn("is_alpha", F.col("token").rlike("^[a-z]+$"))
        .join(chain_words(records), "token", "left").withColumn("chain_field_count", F.coalesce("chain_field_count", F.lit(0)))
    )


def provider_stats(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy("provider", "token").agg(F.count("*").alias("doc_freq"))


def city_stats(tokens: DataFrame) -> DataFrame:
    return tokens.where("city_name_norm is not null").groupBy("city_name_norm", "token").agg(F.count("*").alias("city_doc_freq"), F.count_distinct("provider").alias("city_provider_coverage"))


def city_counts(tokens: DataFrame) -> DataFrame:
    """Records of each token in each city, null being one."""
    return tokens.groupBy("city_name_norm", "token").agg(F.count("*").alias("city_doc_freq"))


def doc_freqs(counts: DataFrame, records: DataFrame) -> DataFrame:
    """Those of global_stats' columns that take no coverage, from city_counts."""
    total = records.agg(F.count("*").alias("total"))
    rows = counts.groupBy("token").agg(F.sum("city_doc_freq").alias("doc_freq")).crossJoin(F.broadcast(total))  # one row
    return rows.withColumn("doc_freq_ratio", F.col("doc_freq") / F.col("total")).drop("total").withColumn("token_length", F.length("token")).withColumn("is_numeric", F.col("token").rlike("^[0-9]+$"))


def cell_stats(tokens: DataFrame) -> DataFrame:
    return tokens.where("cell is not null").groupBy("cell", "token").agg(F.count("*").alias("cell_doc_freq"))


def low_value(stats: DataFrame, c: TokenConfig = TokenConfig()) -> DataFrame:
    return stats.where((F.col("doc_freq_ratio") >= c.low_value_ratio) & (F.col("city_coverage") >= c.low_value_cities) & (F.col("provider_coverage") >= c.low_value_providers) & ~F.col("is_numeric"))


def brand_candidates(stats: DataFrame, c: TokenConfig = TokenConfig()) -> DataFrame:
    """Words that chains' names hold often; for people to look at, not applied."""
    some = stats.where((F.col("chain_field_count") >= c.brand_chain_min) & (F.col("provider_coverage") >= 3) & ~F.col("is_numeric") & (F.col("token_length") >= 3))
    return some.join(low_value(stats, c).select("token"), "token", "left_anti")


def rare_tokens(stats: DataFrame, c: TokenConfig = TokenConfig()) -> DataFrame:
    return stats.where((F.col("doc_freq") <= c.rare_max) & (F.col("token_length") >= c.rare_len) & ~F.col("is_numeric"))


def rare_city_tokens(cities: DataFrame, stats: DataFrame, c: TokenConfig = TokenConfig()) -> DataFrame:
    """Words rare in a city, for the cities with most such words."""
    low, high = c.rare_city
    rare = cities.where(F.col("city_doc_freq").between(low, high) & (F.length("token") >= c.rare_len)).join(low_value(stats, c).select("token"), "token", "left_anti")
    top = rare.groupBy("city_name_norm").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "city_name_norm").limit(c.rare_city_cities)
    return rare.join(top.select("city_name_norm"), "city_name_norm", "left_semi")


def split_tokens(records: DataFrame, p: Policy) -> DataFrame:
    """Core, brand, low-value and location words; core, its signature and whether it is empty."""
    t = F.col("property_name_tokens")
    weak = (*p.brand, *p.location, *p.low_value)
    core = F.filter(t, lambda x: ~one_of(x, weak))
    return records.withColumns({
        "property_name_core_tokens": core, "property_name_brand_tokens": F.filter(t, lambda x: one_of(x, p.brand)),
        "property_name_low_value_tokens": F.filter(t, lambda x: one_of(x, p.low_value)), "property_name_location_tokens": F.filter(t, lambda x: one_of(x, p.location)),
        "property_name_core": F.array_join(core, " "), "property_name_signature": signature(core), "property_name_core_empty": F.size(core) == 0,
    })


def context(*columns: str) -> Column:
    """The words of a record's own places."""
    return F.concat(*(F.split(F.coalesce(F.col(c), F.lit("")), " ") for c in columns))


def frequent(stats: DataFrame, ratio: float) -> tuple[str, ...]:
    """Tokens that a fixed share of records has. Their number is at most the tokens of a record over that share, whatever the number of records."""
    return tuple(r.token for r in stats.where(F.col("doc_freq_ratio") >= ratio).select("token").collect())


def blocking_tokens(records: DataFrame, stats: DataFrame, c: TokenConfig = TokenConfig()) -> DataFrame:
    stop = frequent(stats, c.blocking_ratio)
    base = F.filter("property_name_core_tokens", lambda t: (F.length(t) >= c.blocking_len) & ~one_of(t, stop))
    return records.withColumn("property_name_blocking_tokens", F.array_except(base, context("city_name_norm")))


def city_overcommon(records: DataFrame, tokens: DataFrame, stats_by_city: DataFrame, c: TokenConfig = TokenConfig()) -> DataFrame:
    """(city_name_norm, token) that too many names of a city share. Names are counted by their hashes, and only for pairs that pass all else.

    stats_by_city: city_stats, or city_counts; then providers are counted here, for pairs that are often enough.
    """
    key, providers = ["city_name_norm", "token"], "city_provider_coverage" in stats_by_city.columns
    size = records.where("city_name_norm is not null").groupBy("city_name_norm").agg(F.count("*").alias("records"))
    often = stats_by_city.where((F.col("city_doc_freq") >= c.city_freq) & (F.col("city_provider_coverage") >= c.city_providers if providers else F.lit(True))).join(size, "city_name_norm")
    often = step(often.where(F.col("city_doc_freq") / F.col("records") >= c.city_ratio).select(*key), "often")
    if not providers:
        often = step(tokens.join(often, key, "left_semi").groupBy(*key, "provider").agg(F.count("*").alias("n")).groupBy(*key).agg(F.count("provider").alias("n")).where(F.col("n") >= c.city_providers).select(*key), "often")
    found = tokens.join(often, key, "left_semi")
    # names fall into 64 groups, of which an aggregate needs a bit each: as many groups are as many names. The few pairs of fewer groups are counted
    seen = step(found.groupBy(*key).agg(F.bit_count(F.bit_or(F.expr("shiftleft(1L, int(pmod(name_hash, 64)))"))).alias("least")), "seen")
    unsure = written(seen.where(F.col("least") < c.city_names).select(*key), "unsure")
    counted = found.join(unsure, key, "left_semi").groupBy(*key).agg(F.count_distinct("name_hash").alias("names")).where(F.col("names") >= c.city_names)
    return seen.where(F.col("least") >= c.city_names).select(*key).unionByName(counted.select(*key))


def match_tokens(records: DataFrame, stats: DataFrame, overcommon: DataFrame, p: Policy, c: TokenConfig = TokenConfig()) -> DataFrame:
    """Identity words of a name, their signature; a name of weak words alone keeps what tells it apart.

    stats: global_stats or doc_freqs.
    """
    t = F.col("property_name_tokens")
    number = lambda x: x.rlike("^[0-9]+$")
    stop, none = frequent(stats, c.match_ratio), F.array().cast("array<string>")
    keep = stats.where((F.col("doc_freq") <= c.area_keep_max) & (F.col("token_length") >= 4) & ~F.col("is_numeric")).select("token")
    # what is joined to the records is written first: a small frame is then seen to be small, and the records with their names stay where they are
    # area words are context unless they identify: leave those out of the context
    area = records.where("area_clean is not null").select("record_id", F.explode(F.split("area_clean", " ")).alias("token")).join(keep, "token", "left_anti")
    area = step(area.groupBy("record_id").agg(F.collect_set("token").alias("__area")), "areas")
    weak = (*MATCH_WEAK, *p.brand, *p.location)
    strict = F.filter(F.array_distinct(t), lambda x: (F.length(x) >= c.match_len) & ~number(x) & ~one_of(x, weak) & ~one_of(x, stop))
    local = step(overcommon.where(~one_of(F.col("token"), (*weak, *stop))), "overcommon")
    # a city's list is bounded by the share of its records that a word must have, so records meet one row each and stay where they are if all lists are small
    hits = step(local.groupBy("city_name_norm").agg(F.collect_set("token").alias("__local")), "hits")
    rows = records.join(area, "record_id", "left").join(hits, "city_name_norm", "left")
    own = F.concat(context("city_name_norm", "state_norm", "country_name_clean"), F.coalesce("__area", none))
    rows = rows.withColumn("property_name_match_tokens", F.array_except(F.array_except(strict, own), F.coalesce("__local", none)))
    rest = F.array_except(F.filter(t, lambda x: (F.length(x) >= 2) & ~number(x)), own)
    strong = F.array_except(rest, F.array(*map(F.lit, MATCH_WEAK)))
    m = F.col("property_name_match_tokens")
    rows = rows.withColumn("property_name_match_tokens", F.when(F.size(m) > 0, m).when(F.size(strong) > 0, strong).otherwise(rest))
    return rows.withColumn("property_name_match_signature", signature(F.col("property_name_match_tokens"))).drop("__area", "__local")


def rare_tags(records: DataFrame, tokens: DataFrame, rare: DataFrame, rare_city: DataFrame, common: tuple[str, ...] = ()) -> DataFrame:
    """Each record's globally rare words and those rare in its city. Of the common words, those that are rare nowhere aren't exchanged."""

    def tagged(stop: DataFrame, keys: list[str], name: str) -> DataFrame:
        stop = step(stop.select(*keys).distinct(), "rare")
        still = {r.token for r in stop.where(one_of(F.col("token"), common)).select("token").distinct().collect()}
        some = tokens.where(~one_of(F.col("token"), [t for t in common if t not in still]))
        return step(some.join(stop, keys).groupBy("record_id").agg(F.array_sort(F.collect_set("token")).alias(name)), "tags")

    rows = records.join(tagged(rare, ["token"], "property_name_rare_tokens_global"), "record_id", "left").join(tagged(rare_city, ["city_name_norm", "token"], "property_name_rare_tokens_city"), "record_id", "left")
    none = F.array().cast("array<string>")
    return rows.withColumns({c: F.coalesce(c, none) for c in ("property_name_rare_tokens_global", "property_name_rare_tokens_city")})
