"""The catalogue: every operator as a query on the given tables, and the same result as SQL.

The tables hold no feeds, so ``documents`` stand in: a row is a record of provider ``source``, its whole text
is the name, and places, codes and addresses are made from its numbers. Everything else is the normal chain.
"""

from __future__ import annotations

from dataclasses import replace
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.functions import contacts, fields, geo, text
from concord.operators import blocking, clusters, explore, export, gate, graph, quality, reach, review, scoring, tokens
from concord.plans.normalize import Normalized, Settings, normalize
from concord.sources.checkpoints import step as step_
from concord.sources.checkpoints import written

PHONE = "([0-9][0-9 ()-]{7,}[0-9])"
EMAIL = "([a-zA-Z0-9._]+@[a-zA-Z0-9.]+)"
SETTINGS = Settings(postal_field="([0-9]{4,6})", tokens=tokens.TokenConfig(blocking_ratio=0.02), policy=tokens.Policy(brand=("the",), location=("of", "de"), low_value=("and",), force_keep=("und",)))
#: The versions, and one that sends more to review: small samples have few large clusters.
POLICIES = clusters.VERSIONS | {"strict": replace(clusters.V2_2, max_size=2, diameter=5, drift=20)}
MODEL = scoring.Model(scoring.FIXED.m, scoring.FIXED.u, 1e-3)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as a feed."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("source").alias("provider"), F.col("doc_id").cast("string").alias("property_code"), F.col("text").alias("property_name"), F.concat("lang", F.lit(" town")).alias("city_name"), F.col("lang").alias("country_code"),
        F.substring((100000 + (F.col("n_chars") * 7919) % 900000).cast("string"), 1, (4 + F.col("n_chars") % 3).cast("int")).alias("postal_code"), F.when(F.col("doc_id") % 5 == 0, "No chain").otherwise(F.concat(F.lit("the chain "), F.col("lang"))).alias("hotel_chain"),
        F.concat_ws(", ", F.regexp_extract_all("text", F.lit(PHONE), 1)).alias("phone_numbers"), F.concat_ws(",", F.regexp_extract_all("text", F.lit(EMAIL), 1)).alias("emails"), F.concat(F.lit("https://www.site"), F.col("n_chars"), F.lit(".com/p")).alias("weburl"),
        F.when(F.col("doc_id") % 17 != 0, 10 + (F.floor(F.col("n_chars") / 50) % 100) / 1000.0).alias("lat"), (20 + (F.floor(F.col("n_chars") / 50) % 7) / 1000.0).alias("lng"), ((F.col("doc_id") % 11) / 2.0).alias("star_rating"), F.lit(0).cast("long").alias("source_row_number"),
    ).withColumn("record_id", F.concat_ws("::", "provider", "property_code", F.lit("0")))


@lru_cache(maxsize=4)
def _normalized(app: str, spark: SparkSession, sf_dir: str) -> Normalized:
    return normalize(raw_records(spark, sf_dir), SETTINGS, stored=True)


def normalized(spark: SparkSession, sf_dir: str) -> Normalized:
    """The stage's artifact, made once for a session and input."""
    return _normalized(spark.sparkContext.applicationId, spark, sf_dir)


#: What links are made of. Names are in it as digests and words.
LINKED = (
    "provider", "country_code_norm", "city_name_norm", "postal_code_final", "cell", "cell_wide", "geohash6_norm", "property_name_signature", "property_name_match_signature", "property_name_match_tokens", "property_name_blocking_tokens", "lat_lng_valid", "lat_norm", "lng_norm",
    "lat_lng_low_precision", "phone_last10_non_reused_list", "email_norm_list", "website_domain_norm", "website_reused_flag", "website_weak_domain_flag", "hotel_chain_norm", "property_type_norm", "star_rating_norm",
)


#: Of these, lists of words: many times as long as the rest of a record.
LISTS = ("property_name_match_tokens", "property_name_blocking_tokens")


@lru_cache(maxsize=4)
def _linked(app: str, spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    # signatures are only held against each other, so their digests do
    digest = lambda c: F.when(F.col(c) != "", F.md5(c)).otherwise(F.col(c))
    n, reached = normalized(spark, sf_dir), ("phone_last10_non_reused_list", "email_norm_list", "website_domain_norm", "website_reused_flag", "website_weak_domain_flag")
    rows = step_(n.of(*(c for c in LINKED if c not in reached)).withColumns({c: digest(c) for c in ("property_name_signature", "property_name_match_signature")}), "named")
    return step_(rows.drop(*LISTS).join(n.of(*reached), "record_id"), "linked"), rows.select("record_id", *reach.PLACED, *LISTS)


def linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What links are made of; the lists of words, which aren't exchanged to be stored, are joined when they are asked for."""
    rows, lists = _linked(spark.sparkContext.applicationId, spark, sf_dir)
    return rows.join(lists.select("record_id", *LISTS), "record_id")


# SQL: named steps, each on those before it.
STEPS: list[tuple[str, str]] = []
QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def step(name: str, sql: str) -> None:
    STEPS.append((name, sql))


def query(name: str, build, sql: str | None = None) -> None:
    """Register a query, and its SQL on the steps so far."""
    QUERIES[name] = build
    if sql is not None:
        ORACLE[name] = (f"WITH RECURSIVE {', '.join(f'{n} AS ({s})' for n, s in STEPS)} {sql}" if STEPS else sql)


WHITE = r"\s+"
NULLS = ", ".join(f"'{x}'" for x in text.NULL_LIKE)


def _clean(c: str) -> str:
    return rf"CASE WHEN lower(trim(regexp_replace({c}, '\s+', ' ', 'g'))) NOT IN ({NULLS}) THEN lower(trim(regexp_replace({c}, '\s+', ' ', 'g'))) END"


def _r(spark, sf, need: str, *columns) -> DataFrame:
    """Columns made of those needed, of all records."""
    return normalized(spark, sf).of(*need.split()).select("record_id", *columns)


# Cleaning, names, fields.
query("clean_text", lambda s, d: table(s, d, "documents").select("doc_id", F.md5(text.clean_text(F.col("text"))).alias("clean")), f"SELECT doc_id, md5({_clean('text')}) AS clean FROM documents")
query("country_resolve", lambda s, d: table(s, d, "nation").select("n_nationkey", fields.country(F.substring("n_name", 1, 2), F.lower("n_name"), {"35": "IN"}, {"nation_1": "NZ"})[0].alias("country")), "SELECT n_nationkey, upper(substr(n_name, 1, 2)) AS country FROM nation WHERE regexp_matches(upper(substr(n_name, 1, 2)), '^[A-Z]{2}$') UNION ALL SELECT n_nationkey, CASE WHEN lower(n_name) = 'nation_1' THEN 'NZ' END FROM nation WHERE NOT regexp_matches(upper(substr(n_name, 1, 2)), '^[A-Z]{2}$')")
query("category_bucket", lambda s, d: table(s, d, "part").select("p_partkey", fields.property_type(F.lower("p_type"), keywords={"first": ["brushed", "polished"], "second": ["standard", "small"]}).alias("kind"), fields.property_type(F.lower("p_name")).alias("name_kind")),
      "SELECT p_partkey, CASE WHEN regexp_matches(lower(p_type), 'brushed|polished') THEN 'first' WHEN regexp_matches(lower(p_type), 'standard|small') THEN 'second' ELSE 'unknown' END AS kind, CASE " + " ".join(f"WHEN regexp_matches(lower(p_name), '{'|'.join(w)}') THEN '{k}'" for k, w in fields.TYPE_KEYWORDS.items()) + " ELSE 'unknown' END AS name_kind FROM part")
query("star_bucket", lambda s, d: table(s, d, "part").select("p_partkey", fields.star_rating(F.col("p_size") / 8.0).alias("star"), F.round(fields.star_rating(F.col("p_size") / 8.0)).cast("int").alias("bucket")), "SELECT p_partkey, CASE WHEN p_size > 0 AND p_size / 8.0 <= 5 THEN (p_size / 8.0)::DOUBLE END AS star, CASE WHEN p_size > 0 AND p_size / 8.0 <= 5 THEN round(p_size / 8.0)::INTEGER END AS bucket FROM part")

_PLACE = lambda s, d: table(s, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 17 != 0, (F.col("c_custkey") * 7919 % 200000) / 1000.0 - 100).alias("lat"), ((F.col("c_custkey") * 104729 % 400000) / 1000.0 - 200).alias("lng"))
_PLACE_SQL = "SELECT c_custkey, CASE WHEN c_custkey % 17 <> 0 THEN (c_custkey * 7919 % 200000)::DOUBLE / 1000.0::DOUBLE - 100 END AS lat, (c_custkey * 104729 % 400000)::DOUBLE / 1000.0::DOUBLE - 200 AS lng FROM customer"
_VALID = "coalesce(lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180 AND NOT (lat = 0 AND lng = 0), false)"
query("geo_flags", lambda s, d: _PLACE(s, d).select("c_custkey", geo.valid(F.col("lat"), F.col("lng")).alias("valid"), geo.out_of_range(F.col("lat"), F.col("lng"), (6.0, 37.5, 68.0, 97.5)).alias("outside")), f"SELECT c_custkey, {_VALID} AS valid, {_VALID} AND NOT (lat BETWEEN 6.0 AND 37.5 AND lng BETWEEN 68.0 AND 97.5) AS outside FROM ({_PLACE_SQL})")


def _dp(c: str) -> str:
    return "CASE " + " ".join(f"WHEN round({c}, {n}) = {c} THEN {n}" for n in range(7)) + " ELSE 7 END"


query("coord_precision", lambda s, d: _PLACE(s, d).select("c_custkey", geo.precision_bucket(F.col("lat"), F.col("lng")).alias("bucket"), geo.low_precision(geo.precision_bucket(F.col("lat"), F.col("lng"))).alias("low")),
      f"SELECT c_custkey, bucket, bucket IN ('suspicious_rounded', 'precision_2dp') AS low FROM (SELECT c_custkey, CASE WHEN {_VALID} THEN CASE WHEN least({_dp('lat')}, {_dp('lng')}) <= 1 THEN 'suspicious_rounded' ELSE 'precision_' || least({_dp('lat')}, {_dp('lng')}) || 'dp' END END AS bucket FROM ({_PLACE_SQL}))")
_BIT = lambda k: f"((CASE WHEN {k} % 2 = 0 THEN x >> (17 - {k} // 2) ELSE y >> (16 - {k} // 2) END) & 1)"
_HASH = " || ".join("substr('" + geo.BASE32 + "', (1 + " + " + ".join(f"{2 ** (4 - i)} * {_BIT(5 * k + i)}" for i in range(5)) + ")::INTEGER, 1)" for k in range(7))
query("geohash_cells", lambda s, d: _PLACE(s, d).select("c_custkey", geo.geohash(F.col("lat"), F.col("lng")).alias("geohash7")), f"SELECT c_custkey, CASE WHEN ok THEN {_HASH} END AS geohash7 FROM (SELECT c_custkey, {_VALID} AS ok, CASE WHEN {_VALID} THEN greatest(ceil((lng + 180) / 360 * 262144) - 1, 0)::BIGINT END AS x, CASE WHEN {_VALID} THEN greatest(ceil((lat + 90) / 180 * 131072) - 1, 0)::BIGINT END AS y FROM ({_PLACE_SQL}))")


def _address_sql(c: str) -> str:
    for short, full in fields.ABBREVIATIONS.items():
        c = rf"regexp_replace({c}, '\b{short}\b', '{full}', 'g')"
    return rf"nullif(trim(regexp_replace(regexp_replace({c}, '[^0-9a-z ]+', ' ', 'g'), '\s+', ' ', 'g')), '')"


_STOPS = ", ".join(f"'{w}'" for w in fields.ADDRESS_STOPWORDS)
query("address_norm", lambda s, d: table(s, d, "documents").withColumn("a", fields.address_norm(text.clean_text(text.ascii_fold(F.col("text"))))).select("doc_id", F.md5("a").alias("address"), F.size(fields.address_tokens(F.col("a"))).alias("n_tokens"), F.size(fields.address_tokens(F.col("a"), core=True)).alias("n_core")),
      f"SELECT doc_id, md5(a) AS address, len(list_filter(string_split(coalesce(a, ''), ' '), lambda t: length(t) >= 2)) AS n_tokens, len(list_filter(string_split(coalesce(a, ''), ' '), lambda t: length(t) >= 2 AND t NOT IN ({_STOPS}))) AS n_core FROM (SELECT doc_id, {_address_sql('c')} AS a FROM (SELECT doc_id, {_clean('text')} AS c FROM (SELECT doc_id, strip_accents(replace(text, 'ß', 'ss')) AS text FROM documents)))")
query("postal_extract", lambda s, d: table(s, d, "documents").select("doc_id", fields.postal(F.col("text"), fields.POSTAL_FIELD).alias("field"), fields.postal(F.col("text"), fields.POSTAL_ADDRESS).alias("address")), r"SELECT doc_id, nullif(regexp_extract(text, '([1-9][0-9]{5})', 1), '') AS field, nullif(regexp_extract(text, '\b([1-9][0-9]{5})\b', 1), '') AS address FROM documents")
query("url_domains", lambda s, d: table(s, d, "pages").select("page_id", contacts.url_host(F.col("url")).alias("host"), contacts.registered_domain(contacts.url_host(F.col("url"))).alias("domain")),
      "SELECT page_id, host, array_to_string(string_split(host, '.')[-2:], '.') AS domain FROM (SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)), '^www\\.', '') AS host FROM pages)".replace("\\\\", "\\"))
query("email_extract", lambda s, d: table(s, d, "documents").withColumn("e", contacts.emails(F.concat_ws(",", F.regexp_extract_all("text", F.lit(EMAIL), 1)))).select("doc_id", F.array_join("e", ",").alias("emails"), F.array_join(contacts.email_part(F.col("e"), 2), ",").alias("domains"), contacts.all_generic(contacts.email_part(F.col("e"), 1), Settings.generic_locals).alias("generic")),
      f"SELECT doc_id, array_to_string(e, ',') AS emails, array_to_string(list_transform(e, lambda x: split_part(x, '@', 2)), ',') AS domains, len(list_filter(e, lambda x: split_part(x, '@', 1) NOT IN ({', '.join(repr(x) for x in Settings.generic_locals)}))) = 0 AS generic FROM (SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '{EMAIL}', 1), lambda x: lower(x)), lambda x: regexp_matches(x, '^[^@]+@[^@]+\\.[^@]+$')) AS e FROM documents)")

# The chain. Steps mirror the stages.
step("r0", f"""SELECT doc_id, source AS provider, source || '::' || doc_id || '::0' AS record_id, CASE WHEN regexp_matches(upper(lang), '^[A-Z]{{2}}$') THEN upper(lang) END AS country, {_clean("lang || ' town'")} AS city, text,
  substr((100000 + (n_chars * 7919) % 900000)::VARCHAR, 1, (4 + n_chars % 3)::INTEGER) AS postal, CASE WHEN doc_id % 5 <> 0 THEN 'the chain ' || lang END AS chain, 'site' || n_chars || '.com' AS domain,
  CASE WHEN doc_id % 17 <> 0 THEN 10 + (floor(n_chars / 50)::BIGINT % 100) / 1000.0::DOUBLE END AS lat0, 20 + (floor(n_chars / 50)::BIGINT % 7) / 1000.0::DOUBLE AS lng0, (doc_id % 11) / 2.0::DOUBLE AS star0,
  trim(regexp_replace(replace(strip_accents(replace(lower(text), 'ß', 'ss')), '&', ' and '), '[^0-9a-z]+', ' ', 'g')) AS nm FROM documents""")
step("r1", f"""SELECT * EXCLUDE (nm, lat0, lng0, star0), CASE WHEN nm NOT IN ({NULLS}) THEN nm END AS name, CASE WHEN lat0 IS NOT NULL THEN lat0 END AS lat, CASE WHEN lat0 IS NOT NULL THEN lng0 END AS lng, CASE WHEN star0 > 0 AND star0 <= 5 THEN star0 END AS star,
  list_filter(string_split(coalesce(CASE WHEN nm NOT IN ({NULLS}) THEN nm END, ''), ' '), lambda t: length(t) >= 2 OR regexp_matches(t, '^[0-9]+$')) AS toks FROM r0""")
step("r2", f"SELECT *, CASE WHEN lat IS NOT NULL THEN {_HASH} END AS geohash7, CASE WHEN lat IS NOT NULL THEN CASE WHEN least({_dp('lat')}, {_dp('lng')}) <= 1 THEN 'suspicious_rounded' ELSE 'precision_' || least({_dp('lat')}, {_dp('lng')}) || 'dp' END END AS bucket FROM (SELECT *, greatest(ceil((lng + 180) / 360 * 262144) - 1, 0)::BIGINT AS x, greatest(ceil((lat + 90) / 180 * 131072) - 1, 0)::BIGINT AS y FROM r1)")
step("rec", "SELECT *, substr(geohash7, 1, 6) AS cell, substr(geohash7, 1, 5) AS wide, bucket IN ('suspicious_rounded', 'precision_2dp') AS low, array_to_string(list_sort(toks), ' ') AS sorted_toks FROM r2")
step("tok", "SELECT DISTINCT record_id, provider, city, cell, token FROM (SELECT record_id, provider, city, cell, unnest(toks) AS token FROM rec) WHERE length(token) >= 2")
step("chainw", "SELECT token, count(*) AS n FROM (SELECT unnest(string_split(lower(chain), ' ')) AS token FROM rec WHERE chain IS NOT NULL) GROUP BY token")
step("stats", "SELECT t.token, doc_freq, provider_coverage, city_coverage, cell_coverage, doc_freq / (SELECT count(*) FROM rec) AS doc_freq_ratio, length(t.token) AS token_length, regexp_matches(t.token, '^[0-9]+$') AS is_numeric, regexp_matches(t.token, '^[a-z]+$') AS is_alpha, coalesce(c.n, 0) AS chain_field_count FROM (SELECT token, count(*) AS doc_freq, count(DISTINCT provider) + max((provider IS NULL)::INT) AS provider_coverage, count(DISTINCT city) + max((city IS NULL)::INT) AS city_coverage, count(DISTINCT cell) + max((cell IS NULL)::INT) AS cell_coverage FROM tok GROUP BY token) t LEFT JOIN chainw c ON t.token = c.token")
step("cstats", "SELECT city, token, count(*) AS city_doc_freq, count(DISTINCT provider) AS city_provider_coverage FROM tok WHERE city IS NOT NULL GROUP BY city, token")
_T = SETTINGS.tokens
step("lowv", f"SELECT token FROM stats WHERE doc_freq_ratio >= {_T.low_value_ratio} AND city_coverage >= {_T.low_value_cities} AND provider_coverage >= {_T.low_value_providers} AND NOT is_numeric")

query("name_tokens", lambda s, d: _r(s, d, "property_name_norm property_name_token_count property_name_sorted_tokens", F.md5("property_name_norm").alias("name"), F.col("property_name_token_count").alias("n"), F.md5("property_name_sorted_tokens").alias("sorted_tokens")), "SELECT record_id, md5(name) AS name, len(toks) AS n, md5(sorted_toks) AS sorted_tokens FROM rec")
query("token_stats_global", lambda s, d: normalized(s, d).stats, "SELECT * FROM stats")
query("token_stats_provider", lambda s, d: normalized(s, d).provider_stats, "SELECT provider, token, count(*) AS doc_freq FROM tok GROUP BY ALL")
query("token_stats_city", lambda s, d: normalized(s, d).city_stats, "SELECT city AS city_name_norm, token, city_doc_freq, city_provider_coverage FROM cstats")
query("token_stats_cell", lambda s, d: normalized(s, d).cell_stats, "SELECT cell, token, count(*) AS cell_doc_freq FROM tok WHERE cell IS NOT NULL GROUP BY ALL")
_LOW = tokens.TokenConfig(low_value_cities=3)
query("low_value_tokens", lambda s, d: tokens.low_value(normalized(s, d).common, _LOW).select("token", "doc_freq"), f"SELECT token, doc_freq FROM stats WHERE doc_freq_ratio >= {_LOW.low_value_ratio} AND city_coverage >= 3 AND provider_coverage >= 4 AND NOT is_numeric")
query("rare_tokens", lambda s, d: tokens.rare_tokens(normalized(s, d).doc_freqs).select("token", "doc_freq"), "SELECT token, doc_freq FROM stats WHERE doc_freq <= 2 AND token_length >= 4 AND NOT is_numeric")
step("rarecity0", "SELECT * FROM cstats WHERE city_doc_freq BETWEEN 2 AND 50 AND length(token) >= 4 AND token NOT IN (SELECT token FROM lowv)")
step("rarecity", "SELECT * FROM rarecity0 WHERE city IN (SELECT city FROM rarecity0 GROUP BY city ORDER BY count(*) DESC, city LIMIT 50)")
query("rare_city_tokens", lambda s, d: tokens.rare_city_tokens(normalized(s, d).city_stats, normalized(s, d).stats), "SELECT city AS city_name_norm, token, city_doc_freq, city_provider_coverage FROM rarecity")
_BRAND = tokens.TokenConfig(brand_chain_min=1)
query("brand_candidates", lambda s, d: tokens.brand_candidates(normalized(s, d).chained, _BRAND).select("token", "chain_field_count"), "SELECT token, chain_field_count FROM stats WHERE chain_field_count >= 1 AND provider_coverage >= 3 AND NOT is_numeric AND token_length >= 3 AND token NOT IN (SELECT token FROM lowv)")
step("pol", "SELECT r.*, list_filter(toks, lambda t: t NOT IN ('the', 'of', 'de', 'and')) AS core FROM rec r")
query("token_policy_split", lambda s, d: _r(s, d, "property_name_core property_name_signature property_name_brand_tokens property_name_location_tokens property_name_low_value_tokens property_name_core_empty", F.md5("property_name_core").alias("core"), F.md5("property_name_signature").alias("signature"), F.size("property_name_brand_tokens").alias("n_brand"), F.size("property_name_location_tokens").alias("n_location"), F.size("property_name_low_value_tokens").alias("n_low"), "property_name_core_empty"),
      "SELECT record_id, md5(array_to_string(core, ' ')) AS core, md5(array_to_string(list_sort(core), ' ')) AS signature, len(list_filter(toks, lambda t: t = 'the')) AS n_brand, len(list_filter(toks, lambda t: t IN ('of', 'de'))) AS n_location, len(list_filter(toks, lambda t: t = 'and')) AS n_low, len(core) = 0 AS property_name_core_empty FROM pol")
step("blk", f"SELECT record_id, list_sort(list(DISTINCT token)) AS blocking FROM (SELECT record_id, city, unnest(core) AS token FROM pol) WHERE length(token) >= 4 AND NOT list_contains(string_split(coalesce(city, ''), ' '), token) AND token NOT IN (SELECT token FROM stats WHERE doc_freq_ratio >= {_T.blocking_ratio}) GROUP BY record_id")
query("blocking_tokens", lambda s, d: _r(s, d, "property_name_blocking_tokens", F.array_join(F.array_sort("property_name_blocking_tokens"), " ").alias("tokens")), "SELECT p.record_id, coalesce(array_to_string(blocking, ' '), '') AS tokens FROM pol p LEFT JOIN blk USING (record_id)")
step("over", f"SELECT c.city, c.token FROM cstats c JOIN (SELECT city, count(*) AS records FROM rec GROUP BY city) USING (city) JOIN (SELECT t.city, t.token, count(DISTINCT r.sorted_toks) AS names FROM tok t JOIN rec r USING (record_id) GROUP BY t.city, t.token) USING (city, token) WHERE city_doc_freq >= {_T.city_freq} AND city_provider_coverage >= {_T.city_providers} AND city_doc_freq / records >= {_T.city_ratio} AND names >= {_T.city_names}")
query("city_overcommon", lambda s, d: normalized(s, d).overcommon, "SELECT city AS city_name_norm, token FROM over")
_WEAK = ", ".join(f"'{w}'" for w in tokens.MATCH_WEAK)
step("mt0", f"""SELECT r.record_id, list_sort(list(DISTINCT token) FILTER (WHERE length(token) >= 4 AND token NOT IN ({_WEAK}, 'the', 'of', 'de') AND token NOT IN (SELECT token FROM stats WHERE doc_freq_ratio >= {_T.match_ratio}) AND o.token2 IS NULL)) AS strict,
  list_sort(list(DISTINCT token) FILTER (WHERE token NOT IN ({_WEAK}))) AS tier1, list_sort(list(DISTINCT token)) AS rest
  FROM (SELECT record_id, city, unnest(toks) AS token FROM rec) r LEFT JOIN (SELECT city, token AS token2 FROM over) o ON r.city = o.city AND r.token = o.token2
  WHERE length(token) >= 2 AND NOT regexp_matches(token, '^[0-9]+$') AND NOT list_contains(string_split(coalesce(r.city, ''), ' '), token) GROUP BY r.record_id""")
step("mt", "SELECT record_id, CASE WHEN len(strict) > 0 THEN strict WHEN len(tier1) > 0 THEN tier1 ELSE coalesce(rest, []) END AS mtoks FROM rec LEFT JOIN mt0 USING (record_id)")
query("match_tokens", lambda s, d: _r(s, d, "property_name_match_signature property_name_match_tokens", F.md5("property_name_match_signature").alias("signature"), F.size("property_name_match_tokens").alias("n")), "SELECT record_id, md5(array_to_string(list_sort(mtoks), ' ')) AS signature, len(mtoks) AS n FROM mt")
query("rare_token_tags", lambda s, d: _r(s, d, "property_name_rare_tokens_global property_name_rare_tokens_city", F.md5(F.array_join("property_name_rare_tokens_global", " ")).alias("global_tags"), F.md5(F.array_join("property_name_rare_tokens_city", " ")).alias("city_tags")),
      "SELECT r.record_id, md5(coalesce(g.tags, '')) AS global_tags, md5(coalesce(c.tags, '')) AS city_tags FROM rec r LEFT JOIN (SELECT record_id, string_agg(DISTINCT token, ' ' ORDER BY token) AS tags FROM tok WHERE token IN (SELECT token FROM stats WHERE doc_freq <= 2 AND token_length >= 4 AND NOT is_numeric) GROUP BY record_id) g USING (record_id) LEFT JOIN (SELECT record_id, string_agg(DISTINCT t.token, ' ' ORDER BY t.token) AS tags FROM tok t JOIN rarecity q ON t.city = q.city AND t.token = q.token GROUP BY record_id) c USING (record_id)")

# Contacts and quality.
step("em", f"SELECT record_id, provider, list_filter(list_transform(regexp_extract_all(text, '{EMAIL}', 1), lambda x: lower(x)), lambda x: regexp_matches(x, '^[^@]+@[^@]+\\.[^@]+$')) AS emails FROM rec")
step("domre", "SELECT domain FROM rec GROUP BY domain HAVING count(*) >= 20")
query("contact_reuse", lambda s, d: quality.value_counts(normalized(s, d).contacts, F.col("email_norm_list")), "SELECT value, count(DISTINCT record_id) AS record_count, count(DISTINCT provider) AS provider_count FROM (SELECT record_id, provider, unnest(emails) AS value FROM em) GROUP BY value")
query("domain_reuse", lambda s, d: quality.top_reused(normalized(s, d).contacts, F.array("website_domain_norm")), "SELECT domain AS value, count(*) AS record_count, count(DISTINCT provider) AS provider_count FROM rec GROUP BY domain ORDER BY record_count DESC, value LIMIT 200")
_DIGITS = "regexp_replace(p, '[^0-9]', '', 'g')"
_PLAIN = f"regexp_replace({_DIGITS}, '^00', '')"
_OWN = f"regexp_replace(CASE WHEN starts_with(p, '00') THEN CASE WHEN starts_with({_PLAIN}, '91') THEN substr({_PLAIN}, 3) END WHEN length({_DIGITS}) > 10 AND starts_with({_DIGITS}, '91') THEN substr({_DIGITS}, 3) ELSE {_DIGITS} END, '^0+', '')"
_ABROAD = f"CASE WHEN starts_with(p, '00') AND NOT starts_with({_PLAIN}, '91') AND length({_PLAIN}) BETWEEN 8 AND 15 THEN '+' || {_PLAIN} END"
step("ph0", rf"SELECT record_id, provider, list_filter(list_transform(regexp_split_to_array(array_to_string(regexp_extract_all(coalesce(text, ''), '{PHONE}', 1), ', '), '[,/;|&]+|-{{2,}}|\s{{2,}}'), lambda p: trim(p)), lambda p: p <> '' AND NOT regexp_matches(p, '^[0\s\-+().]*$')) AS parts FROM rec")
step("ph1", f"SELECT record_id, provider, list_transform(parts, lambda p: coalesce(CASE WHEN length({_OWN}) = 10 THEN '+91' || {_OWN} END, {_ABROAD})) AS nums FROM ph0")
step("ph", "SELECT record_id, provider, list_sort(list_distinct(list_filter(nums, lambda n: n IS NOT NULL))) AS e164, len(list_filter(nums, lambda n: n IS NULL)) AS invalid, list_distinct(list_transform(list_filter(nums, lambda n: n IS NOT NULL), lambda n: right(n, 10))) AS last10 FROM ph1")
step("phre", "SELECT n FROM (SELECT DISTINCT record_id, unnest(last10) AS n FROM ph) GROUP BY n HAVING count(*) >= 5")
step("phn", "SELECT record_id, list(n) AS phones FROM (SELECT record_id, unnest(last10) AS n FROM ph) WHERE n NOT IN (SELECT n FROM phre) GROUP BY record_id")
query("phone_extract", lambda s, d: _r(s, d, "phone_e164_list phone_valid_count phone_invalid_count phone_reused_flag", F.array_join(F.array_sort("phone_e164_list"), ",").alias("numbers"), "phone_valid_count", "phone_invalid_count", "phone_reused_flag"),
      "SELECT record_id, array_to_string(e164, ',') AS numbers, len(e164) AS phone_valid_count, invalid AS phone_invalid_count, record_id IN (SELECT record_id FROM (SELECT record_id, unnest(last10) AS n FROM ph) WHERE n IN (SELECT n FROM phre)) AS phone_reused_flag FROM ph")
query("phone_reuse", lambda s, d: quality.value_counts(normalized(s, d).contacts, F.col("phone_last10_list")), "SELECT n AS value, count(DISTINCT record_id) AS record_count, count(DISTINCT provider) AS provider_count FROM (SELECT record_id, provider, unnest(last10) AS n FROM ph) GROUP BY n")
_RATED = ("provider", "country_code_norm", "property_name_norm", "property_name_core_empty", "city_name_norm", "state_norm", "lat_lng_valid", "lat_lng_low_precision", "postal_code_final", "phone_valid_count", "email_norm_list", "website_domain_norm", "star_rating_norm", "property_type_norm", "hotel_chain_norm")
_rated = lambda s, d: normalized(s, d).of(*_RATED)
_HEAD = "count(*) AS records"
_RATES = {
    "country_missing_rate": "country IS NULL", "name_missing_rate": "name IS NULL", "core_empty_rate": "len(core) = 0", "city_missing_rate": "city IS NULL", "state_missing_rate": "true", "coords_valid_rate": "lat IS NOT NULL", "low_precision_coord_rate": "low", "postal_present_rate": "postal IS NOT NULL", "phone_present_rate": "len(e164) > 0",
    "email_present_rate": "len(emails) > 0", "domain_present_rate": "domain IS NOT NULL", "star_missing_rate": "star IS NULL", "type_unknown_rate": "true", "chain_present_rate": "chain IS NOT NULL",
}
_RATE_SQL = lambda names: ", ".join(f"avg(({_RATES[n]})::INT) AS {n}" for n in names)
_PQ = [n for n in _RATES if n not in ("country_missing_rate", "state_missing_rate")]
query("quality_rates", lambda s, d: quality.headline(_rated(s, d)), f"SELECT {_HEAD}, {_RATE_SQL(_RATES)} FROM pol JOIN em USING (record_id) JOIN ph USING (record_id)")
query("provider_quality", lambda s, d: quality.provider_quality(_rated(s, d)), f"SELECT p.provider, {_HEAD}, {_RATE_SQL(_PQ)} FROM pol p JOIN em USING (record_id) JOIN ph USING (record_id) GROUP BY p.provider")
query("guardrails", lambda s, d: quality.guardrails(quality.headline(normalized(s, d).of("country_code_norm", "property_name_norm", "property_name_core_empty"), quality.GUARDRAILS)), "SELECT guardrail, value, most, value <= most AS passed FROM (SELECT unnest(['country_missing_rate', 'name_missing_rate', 'core_empty_rate']) AS guardrail, unnest([avg((country IS NULL)::INT), avg((name IS NULL)::INT), avg((len(core) = 0)::INT)]) AS value, unnest([0.01, 0.005, 0.2]::DOUBLE[]) AS most FROM pol)")

_GUARDED = ("country_missing_rate", "name_missing_rate", "core_empty_rate")
_SIZES = [("low_value_global", "(SELECT count(*) FROM (SELECT token FROM lowv UNION SELECT 'and') WHERE token NOT IN ('the', 'of', 'de', 'und'))"), ("brand_tokens", "1"), ("location_descriptors", "2"), ("rare_global_tokens", "(SELECT count(*) FROM stats WHERE doc_freq <= 2 AND token_length >= 4 AND NOT is_numeric)"), ("rare_city_tokens_cities", "(SELECT count(DISTINCT city) FROM rarecity)")]
step("qdhead", f"SELECT {_HEAD}, {_RATE_SQL(_RATES)} FROM pol JOIN em USING (record_id) JOIN ph USING (record_id)")
step("qd", " UNION ALL ".join(
    [f"SELECT 'rates' AS section, '{n}' AS name, {n}::DOUBLE AS value FROM qdhead" for n in ("records", *_RATES)] + ["SELECT 'records_per_provider', provider, count(*)::DOUBLE FROM rec GROUP BY provider"]
    + [f"SELECT 'guardrails', '{n}', ({n} <= {quality.GUARDRAILS[n]})::INT::DOUBLE FROM qdhead" for n in _GUARDED] + [f"SELECT 'token_policy_sizes', '{n}', {sql}::DOUBLE" for n, sql in _SIZES] + ["SELECT 'tokens', 'distinct_global_tokens', count(*)::DOUBLE FROM stats"]))


def diagnostics_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = normalized(spark, sf_dir)
    return quality.document_rows(n.of(*_RATED), n.stats, tokens.rare_tokens(n.stats), tokens.rare_city_tokens(n.city_stats, n.stats), n.policy)


query("diagnostics_document", diagnostics_rows, "SELECT * FROM qd")

# Blocking on large blocks.
_ITEMS = lambda s, d: table(s, d, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("record_id"), F.col("l_suppkey").cast("string").alias("provider"), F.concat(F.lit("p|"), F.col("l_partkey")).alias("block_key"))
step("li", "SELECT l_orderkey || '-' || l_linenumber AS record_id, l_suppkey::VARCHAR AS provider, 'p|' || l_partkey AS block_key FROM lineitem")
step("lic", "SELECT block_key, provider, count(*) AS cnt FROM li GROUP BY ALL")
step("lib", "SELECT block_key, sum(cnt)::BIGINT AS n_records, count(*) AS n_providers, ((sum(cnt) * sum(cnt) - sum(cnt * cnt)) / 2)::BIGINT AS candidate_pairs FROM lic GROUP BY block_key")
query("block_pair_counts", lambda s, d: blocking.blocks(blocking.block_counts(_ITEMS(s, d))), "SELECT * FROM lib")
query("block_rule_summary", lambda s, d: blocking.rule_summary(_ITEMS(s, d), "part"), "SELECT 'part' AS rule, sum(candidate_pairs)::BIGINT AS total_pairs, count(*) AS n_blocks, max(n_records) AS max_block_records, max(candidate_pairs) AS max_block_pairs, " + ", ".join(f"quantile_cont({c}, {q}) AS p{int(q * 100)}_{c}" for c in ("n_records", "candidate_pairs") for q in (0.5, 0.95, 0.99)) + ", sum(n_records)::BIGINT AS covered_records FROM lib WHERE candidate_pairs > 0")
query("provider_pair_counts", lambda s, d: blocking.provider_pair_counts(blocking.block_counts(_ITEMS(s, d))), "SELECT a.provider AS provider_l, b.provider AS provider_r, sum(a.cnt * b.cnt)::BIGINT AS pairs FROM lic a JOIN lic b ON a.block_key = b.block_key AND a.provider < b.provider GROUP BY ALL")
query("large_blocks", lambda s, d: blocking.large_blocks(_ITEMS(s, d), 20, 3).select("block_key", "record_id", "candidate_pairs", "rn"), "SELECT block_key, record_id, candidate_pairs, rn FROM (SELECT *, row_number() OVER (PARTITION BY block_key ORDER BY md5(block_key || record_id), record_id)::INT AS rn FROM li JOIN (SELECT * FROM lib WHERE candidate_pairs > 0 ORDER BY candidate_pairs DESC, block_key LIMIT 20) USING (block_key)) WHERE rn <= 3")
query("token_contributions", lambda s, d: blocking.token_contributions(_ITEMS(s, d)), "SELECT string_split(block_key, '|')[-1] AS token, count(*) AS n_blocks, sum(candidate_pairs)::BIGINT AS candidate_pairs FROM lib GROUP BY ALL")

query("jaro_winkler", lambda s, d: table(s, d, "part").select("p_partkey", F.round(scoring.jaro_winkler(F.col("p_name"), F.col("p_type")), 9).alias("name_type"), F.round(scoring.jaro_winkler(F.col("p_name"), F.reverse("p_name")), 9).alias("turned")),
      "SELECT p_partkey, round(jaro_winkler_similarity(p_name, p_type), 9) AS name_type, round(jaro_winkler_similarity(p_name, reverse(p_name)), 9) AS turned FROM part")

# Candidates, scores and the gate.
step("ready", "SELECT p.record_id, p.provider, p.country, p.city, p.name, p.postal, p.chain, p.domain, p.lat, p.lng, p.star, p.cell, p.wide, CASE WHEN NOT coalesce(low, false) THEN lat END AS clat, CASE WHEN NOT coalesce(low, false) THEN lng END AS clng, array_to_string(list_sort(core), ' ') AS sig, array_to_string(list_sort(mtoks), ' ') AS msig, CASE WHEN len(mtoks) > 0 THEN mtoks END AS mtoks, e.emails, p.domain IN (SELECT domain FROM domre) AS reused, coalesce(b.blocking, []) AS blocking, coalesce(n.phones, []) AS phones FROM pol p JOIN mt USING (record_id) JOIN em e USING (record_id) LEFT JOIN blk b USING (record_id) LEFT JOIN phn n USING (record_id)")
_POSTAL = "^[1-9][0-9]{4,5}$"
_CODE = f"regexp_matches(postal, '{_POSTAL}') AND postal NOT IN ({', '.join(repr(x) for x in blocking.JUNK_POSTAL)})"
step("keys", """SELECT record_id, provider, 0 AS rule, country || '|' || cell AS k FROM ready WHERE country IS NOT NULL AND cell IS NOT NULL UNION ALL
 SELECT record_id, provider, 1, country || '|' || city || '|' || sig FROM ready WHERE sig <> '' AND city IS NOT NULL AND country IS NOT NULL UNION ALL
 SELECT record_id, provider, 2, country || '|' || city || '|' || postal || '|' || t FROM (SELECT *, unnest(blocking) AS t FROM ready) WHERE country IS NOT NULL AND city IS NOT NULL AND postal IS NOT NULL UNION ALL
 SELECT record_id, provider, 3, country || '|' || t FROM (SELECT *, unnest(phones) AS t FROM ready) WHERE country IS NOT NULL UNION ALL
 SELECT record_id, provider, 4, country || '|' || wide || '|' || msig FROM ready WHERE country IS NOT NULL AND wide IS NOT NULL AND msig <> ''""")
step("dkeys", f"""SELECT record_id, provider, 'same_country_cell' AS rule, country || '|' || cell AS k FROM ready WHERE country IS NOT NULL AND cell IS NOT NULL UNION ALL
 SELECT record_id, provider, 'same_country_geohash6', country || '|' || cell FROM ready WHERE country IS NOT NULL AND cell IS NOT NULL UNION ALL
 SELECT record_id, provider, 'same_country_city_postal', country || '|' || city || '|' || postal FROM ready WHERE country IS NOT NULL AND city IS NOT NULL AND {_CODE} UNION ALL
 SELECT record_id, provider, 'same_country_city_name_signature', country || '|' || city || '|' || sig FROM ready WHERE sig <> '' AND city IS NOT NULL AND country IS NOT NULL UNION ALL
 SELECT record_id, provider, 'same_country_city_postal_nametoken', country || '|' || city || '|' || postal || '|' || t FROM (SELECT *, unnest(blocking) AS t FROM ready WHERE {_CODE}) WHERE country IS NOT NULL AND city IS NOT NULL UNION ALL
 SELECT record_id, provider, 'shared_non_reused_phone', country || '|' || t FROM (SELECT *, unnest(phones) AS t FROM ready) WHERE country IS NOT NULL""")
step("dblocks", "SELECT rule, k, sum(n)::BIGINT AS n_records, ((sum(n) * sum(n) - sum(n * n)) / 2)::BIGINT AS candidate_pairs FROM (SELECT rule, k, provider, count(*) AS n FROM dkeys GROUP BY ALL) GROUP BY rule, k")
query("blocking_rules", lambda s, d: blocking.summaries(linked(s, d), _POSTAL).select("rule", "total_pairs", "n_blocks", "max_block_records", "max_block_pairs", "p95_candidate_pairs", "covered_records"),
      f"SELECT rule, coalesce(sum(candidate_pairs), 0)::BIGINT AS total_pairs, count(candidate_pairs) AS n_blocks, max(n_records) AS max_block_records, max(candidate_pairs) AS max_block_pairs, quantile_cont(candidate_pairs, 0.95) AS p95_candidate_pairs, coalesce(sum(n_records), 0)::BIGINT AS covered_records FROM (SELECT unnest([{', '.join(repr(r) for r in blocking.rules())}]) AS rule) LEFT JOIN (SELECT * FROM dblocks WHERE candidate_pairs > 0) USING (rule) GROUP BY rule")
_signed = lambda s, d: normalized(s, d).of("provider", "country_code_norm", "city_name_norm", "property_name_signature", "lat_lng_valid")
query("blocking_invalid_places", lambda s, d: blocking.invalid_place_share(blocking.same_city_signature(_signed(s, d)), _signed(s, d)), "SELECT avg((lat IS NULL)::INT) AS invalid_coord_share FROM ready WHERE sig <> '' AND city IS NOT NULL AND country IS NOT NULL")
step("cand", "SELECT a.record_id AS l, b.record_id AS r, min(a.rule) AS match_key FROM keys a JOIN keys b ON a.rule = b.rule AND a.k = b.k AND a.provider < b.provider GROUP BY ALL")


@lru_cache(maxsize=4)
def _compared(app: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    records = linked(spark, sf_dir)
    return written(scoring.compared(blocking.candidates(records), records), "compared")


def compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(spark.sparkContext.applicationId, spark, sf_dir)


query("candidate_pairs", lambda s, d: compared(s, d).select("record_id_l", "record_id_r", "match_key"), "SELECT l AS record_id_l, r AS record_id_r, match_key FROM cand")
_D = "2 * 6371000 * asin(sqrt(pow(sin(radians(b.clat - a.clat) / 2), 2) + cos(radians(a.clat)) * cos(radians(b.clat)) * pow(sin(radians(b.clng - a.clng) / 2), 2)))"
_J = "len(list_intersect(a.mtoks, b.mtoks))::DOUBLE / len(list_distinct(list_concat(a.mtoks, b.mtoks)))"
step("feat0", f"SELECT l, r, match_key, a.provider AS pl, b.provider AS pr, a.msig = b.msig AND a.msig <> '' AS sig_exact, a.msig AS msig, CASE WHEN a.mtoks IS NOT NULL AND b.mtoks IS NOT NULL THEN {_J} END AS j, len(list_intersect(a.emails, b.emails)) > 0 AS email_ov, len(list_intersect(a.phones, b.phones)) > 0 AS phone_ov, a.domain = b.domain AND NOT a.reused AND NOT b.reused AS domain_ok, {_D} AS d, a.chain AS ca, b.chain AS cb, a.star AS sa, b.star AS sb, a.clat, a.clng, b.clat AS blat, b.clng AS blng, a.city IS NOT DISTINCT FROM b.city AS same_city, coalesce(a.postal = b.postal, false) AS same_postal FROM cand JOIN ready a ON a.record_id = l JOIN ready b ON b.record_id = r")
step("feat", """SELECT *, CASE WHEN j IS NULL THEN -1 WHEN sig_exact THEN 5 WHEN j >= 0.85 THEN 4 WHEN j >= 0.65 THEN 3 WHEN j >= 0.45 THEN 2 WHEN j > 0 THEN 1 ELSE 0 END AS g_name, email_ov::INT AS g_email, phone_ov::INT AS g_phone, domain_ok::INT AS g_domain,
 CASE WHEN d IS NULL THEN -1 WHEN d <= 25 THEN 4 WHEN d <= 75 THEN 3 WHEN d <= 200 THEN 2 WHEN d <= 500 THEN 1 ELSE 0 END AS g_dist, CASE WHEN ca IS NULL OR cb IS NULL THEN -1 WHEN ca = cb THEN 1 ELSE 0 END AS g_chain, CASE WHEN sa IS NULL OR sb IS NULL THEN -1 WHEN abs(sa - sb) <= 0.5 THEN 1 ELSE 0 END AS g_star FROM feat0""")
query("gamma_levels", lambda s, d: compared(s, d).select("record_id_l", "record_id_r", "gamma_name", "gamma_phone", "gamma_email", "gamma_domain", "gamma_distance", "gamma_chain", "gamma_type", "gamma_star"), "SELECT l AS record_id_l, r AS record_id_r, g_name AS gamma_name, g_phone AS gamma_phone, g_email AS gamma_email, g_domain AS gamma_domain, g_dist AS gamma_distance, g_chain AS gamma_chain, -1 AS gamma_type, g_star AS gamma_star FROM feat")

query("gamma_levels_v2", lambda s, d: scoring.compared(compared(s, d).select("record_id_l", "record_id_r", "provider_l", "provider_r"), normalized(s, d).records, match_tokens=False).select("record_id_l", "record_id_r", "gamma_name"),
      "SELECT l AS record_id_l, r AS record_id_r, CASE WHEN len(ca) = 0 OR len(cb) = 0 THEN -1 WHEN list_sort(ca) = list_sort(cb) THEN 5 WHEN j >= 0.85 THEN 4 WHEN j >= 0.65 THEN 3 WHEN j >= 0.45 THEN 2 WHEN j > 0 THEN 1 ELSE 0 END AS gamma_name FROM (SELECT l, r, a.core AS ca, b.core AS cb, len(list_intersect(a.core, b.core))::DOUBLE / len(list_distinct(list_concat(a.core, b.core))) AS j FROM cand JOIN pol a ON a.record_id = l JOIN pol b ON b.record_id = r)")


def _weights(k: str, column: str) -> str:
    import math

    return f"CASE {column} " + " ".join(f"WHEN {i} THEN {math.log2(m / u)!r}" for i, (m, u) in enumerate(zip(MODEL.m[k], MODEL.u[k], strict=True))) + " ELSE 0 END"


_W = " + ".join(_weights(k, c) for k, c in (("gamma_name", "g_name"), ("gamma_phone", "g_phone"), ("gamma_email", "g_email"), ("gamma_domain", "g_domain"), ("gamma_distance", "g_dist"), ("gamma_chain", "g_chain"), ("gamma_star", "g_star")))
step("tf", "SELECT msig, count(*) / (SELECT count(*) FROM ready WHERE msig <> '') AS tf FROM ready WHERE msig <> '' GROUP BY msig")
step("score0", f"SELECT f.*, log2({MODEL.prior!r} / (1 - {MODEL.prior!r})) + {_W} AS w, CASE WHEN g_name = 5 THEN log2({MODEL.u['gamma_name'][5]!r} / tf) ELSE 0 END AS adj FROM feat f LEFT JOIN tf USING (msig)")
step("score", "SELECT *, 1 / (1 + pow(2.0, -(w + adj))) AS p FROM score0 WHERE 1 / (1 + pow(2.0, -(w + adj))) >= 0.01")


@lru_cache(maxsize=4)
def _scored(app: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, lists = _linked(spark.sparkContext.applicationId, spark, sf_dir)
    pairs, alike = reach.compared(rows, lists, MODEL, 0.01), F.col("equal_signature").isNotNull()
    # only an equal signature's frequency counts: other pairs aren't joined to the frequencies
    some = (scoring.scored(pairs.where(~alike), MODEL), scoring.scored(pairs.where(alike), MODEL, scoring.frequencies(rows)))
    return step_(some[0].unionByName(some[1]).where("match_probability >= 0.01"), "scored")


def scored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark.sparkContext.applicationId, spark, sf_dir)


@lru_cache(maxsize=4)
def _featured(app: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(gate.features(scored_pairs(spark, sf_dir), linked(spark, sf_dir)), "features")


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _featured(spark.sparkContext.applicationId, spark, sf_dir)


query("fs_score_fixed", lambda s, d: scoring.scored(compared(s, d), MODEL).select("record_id_l", "record_id_r", F.round("match_weight", 6).alias("weight")), "SELECT l AS record_id_l, r AS record_id_r, round(w, 6) AS weight FROM score0")
query("fs_score_tf", lambda s, d: scored_pairs(s, d).select("record_id_l", "record_id_r", F.round("match_probability", 6).alias("p")), "SELECT l AS record_id_l, r AS record_id_r, round(p, 6) AS p FROM score")
_CASE = lambda bands: "CASE " + " ".join(f"WHEN p >= {lo} AND p < {hi} THEN '{n}'" for n, lo, hi in bands) + " END"
query("score_bands", lambda s, d: scored_pairs(s, d).groupBy(scoring.band(F.col("match_probability")).alias("band")).agg(F.count("*").alias("pairs")), f"SELECT {_CASE(scoring.BANDS)} AS band, count(*) AS pairs FROM score GROUP BY ALL")
_NAME = "CASE WHEN sig_exact THEN 'signature' WHEN j >= 0.85 THEN 'jac85' WHEN j >= 0.65 THEN 'jac65' WHEN j >= 0.45 THEN 'jac45' WHEN j > 0 THEN 'shared' WHEN j = 0 THEN 'none' ELSE 'no_name' END"
_ACOS = "6371000 * acos(least(1, greatest(-1, sin(radians(clat)) * sin(radians(blat)) + cos(radians(clat)) * cos(radians(blat)) * cos(radians(clng - blng)))))"
step("aud", f"SELECT *, {_CASE(scoring.BANDS)} AS band, {_NAME} AS name_level, {_ACOS} AS dist_m, coalesce(sig_exact, false) OR coalesce(j >= 0.45, false) OR email_ov OR phone_ov OR domain_ok AS gate FROM score")
_audit = lambda s, d: scoring.audit(scored_pairs(s, d), linked(s, d))
query("audit_crosstab", lambda s, d: scoring.crosstab(_audit(s, d), "name_level"), "SELECT band, name_level, count(*) AS c FROM aud GROUP BY ALL")
query("audit_distance", lambda s, d: scoring.crosstab(_audit(s, d), "dist_bucket"), "SELECT band, CASE WHEN dist_m <= 25 THEN 'le25m' WHEN dist_m <= 75 THEN 'le75m' WHEN dist_m <= 200 THEN 'le200m' WHEN dist_m <= 500 THEN 'le500m' WHEN dist_m IS NULL THEN 'missing' ELSE 'gt500m' END AS dist_bucket, count(*) AS c FROM aud GROUP BY ALL")
query("safety_metrics", lambda s, d: scoring.safety(_audit(s, d)).select("ge_099", "ge_095", "ge_095_gated", F.round("loc_only_max_score", 6).alias("loc_only_max"), "loc_only_ge_050", "loc_only_ge_090", "sig_exact_pairs", F.round("sig_exact_p05_score", 6).alias("sig_p05"), F.round("pct_ge_095_with_identity", 6).alias("pct")),
      "SELECT count(*) FILTER (p >= 0.99) AS ge_099, count(*) FILTER (p >= 0.95) AS ge_095, count(*) FILTER (p >= 0.95 AND gate) AS ge_095_gated, round(coalesce(max(p) FILTER (NOT gate), 0), 6) AS loc_only_max, count(*) FILTER (NOT gate AND p >= 0.5) AS loc_only_ge_050, count(*) FILTER (NOT gate AND p >= 0.9) AS loc_only_ge_090, count(*) FILTER (sig_exact) AS sig_exact_pairs, round(coalesce(quantile_cont(p, 0.05) FILTER (sig_exact), 0), 6) AS sig_p05, round(count(*) FILTER (p >= 0.95 AND gate) / nullif(count(*) FILTER (p >= 0.95), 0), 6) AS pct FROM aud")
step("gated", f"SELECT l, r, pl, pr, p, j, coalesce(sig_exact, false) AS sig_exact, email_ov, phone_ov, domain_ok, same_city, same_postal, dist_m, name_level, {_CASE(gate.BANDS)} AS band, CASE WHEN phone_ov THEN 'phone' WHEN email_ov THEN 'exact_email' WHEN domain_ok THEN 'non_reused_domain' WHEN sig_exact THEN 'signature' WHEN j >= 0.85 THEN 'strong_name' WHEN j >= 0.45 AND dist_m <= 200 THEN 'medium_name_plus_geo' ELSE 'none' END AS reason FROM aud WHERE p >= 0.80")
query("gate_reasons", lambda s, d: featured(s, d).select("record_id_l", "record_id_r", "gate_reason", "name_level", "band", "same_city", "same_postal"), "SELECT l AS record_id_l, r AS record_id_r, reason AS gate_reason, name_level, band, same_city, same_postal FROM gated")
query("band_profile", lambda s, d: gate.band_profile(featured(s, d)).select("band", "pairs", "records_l", "records_r", "sig_rate", "phone_rate", "email_rate", "domain_rate", "city_rate", "gated_rate", "median_dist_m"), "SELECT band, count(*) AS pairs, count(DISTINCT l) AS records_l, count(DISTINCT r) AS records_r, round(avg(sig_exact::INT), 3) AS sig_rate, round(avg(phone_ov::INT), 3) AS phone_rate, round(avg(email_ov::INT), 3) AS email_rate, round(avg(domain_ok::INT), 3) AS domain_rate, round(avg(same_city::INT), 3) AS city_rate, round(avg((reason <> 'none')::INT), 3) AS gated_rate, round(median(dist_m)) AS median_dist_m FROM gated GROUP BY band")
query("band_by_reason", lambda s, d: gate.crosstab(featured(s, d), "gate_reason"), "SELECT band, reason AS gate_reason, count(*) AS c FROM gated WHERE reason <> 'none' GROUP BY ALL")
query("band_by_name_level", lambda s, d: gate.crosstab(featured(s, d), "name_level"), "SELECT band, name_level, count(*) AS c FROM gated WHERE reason <> 'none' GROUP BY ALL")
query("gate_headline", lambda s, d: gate.headline(featured(s, d)), "SELECT count(*) AS pairs_ge_080, count(*) FILTER (reason <> 'none') AS gated_ge_080, count(*) FILTER (reason <> 'none' AND p >= 0.99) AS gated_ge_099, count(*) FILTER (reason <> 'none' AND p >= 0.90 AND p < 0.99) AS gated_review_090_099, count(*) FILTER (reason = 'none') AS failed_gate_ge_080 FROM gated")
query("threshold_policy", lambda s, d: gate.policy(featured(s, d)), "SELECT CASE WHEN p >= 0.99 THEN 'auto_match' WHEN p >= 0.90 THEN 'review' ELSE 'rejected' END AS policy, count(*) AS pairs FROM gated WHERE reason <> 'none' GROUP BY ALL")
query("provider_pair_top", lambda s, d: gate.provider_pairs(featured(s, d)), "SELECT pl AS provider_l, pr AS provider_r, count(*) AS pairs FROM gated WHERE p >= 0.9 GROUP BY ALL ORDER BY pairs DESC, provider_l, provider_r LIMIT 100")

# Clusters.
step("edge", "SELECT * FROM gated WHERE ((reason IN ('signature', 'phone', 'exact_email', 'non_reused_domain') AND p >= 0.99) OR (reason = 'signature' AND sig_exact AND dist_m <= 100 AND p >= 0.95)) AND (reason = 'signature' OR sig_exact OR coalesce(j, 0) >= 0.30)")
step("adj", "SELECT l AS a, r AS b FROM edge UNION SELECT r, l FROM edge")
step("reach", "SELECT a, a AS b FROM adj UNION SELECT reach.a, adj.b FROM reach JOIN adj ON reach.b = adj.a")
step("root", "SELECT a AS record_id, min(b) AS root FROM reach GROUP BY a")


@lru_cache(maxsize=8)
def _cluster(app: str, spark: SparkSession, sf_dir: str, version: str) -> clusters.Clustering:
    n = normalized(spark, sf_dir)
    return clusters.cluster(gate.gated(featured(spark, sf_dir)), n.records, n.stats, POLICIES[version])


def cluster_of(spark: SparkSession, sf_dir: str, version: str = "v2_3") -> clusters.Clustering:
    return _cluster(spark.sparkContext.applicationId, spark, sf_dir, version)


query("auto_edges", lambda s, d: clusters.auto_edges(gate.gated(featured(s, d)), clusters.V2_3).select("record_id_l", "record_id_r", "gate_reason"), "SELECT l AS record_id_l, r AS record_id_r, reason AS gate_reason FROM edge")
query("connected_components", lambda s, d: graph.components(clusters.auto_edges(gate.gated(featured(s, d)), clusters.V2_3)), "SELECT record_id, root FROM root")
step("mem", "SELECT root, r.* FROM root JOIN (SELECT y.record_id, y.provider, y.sig, y.msig, coalesce(y.mtoks, []) AS mtoks, y.clat, y.clng, y.name FROM ready y) r USING (record_id)")
step("cc", "SELECT root, count(*) AS cluster_size, count(DISTINCT provider) AS provider_count, min(record_id) AS representative_record_id, 'XX_' || substr(md5(string_agg(record_id, ',' ORDER BY record_id)), 1, 16) AS cluster_id, 6371000 * acos(least(1, greatest(-1, sin(radians(min(clat))) * sin(radians(max(clat))) + cos(radians(min(clat))) * cos(radians(max(clat))) * cos(radians(min(clng) - max(clng)))))) AS diam FROM mem GROUP BY root")
step("ed", "SELECT root, count(*) AS edge_count, min(p) AS min_p, bool_or(reason IN ('phone', 'exact_email', 'non_reused_domain')) AS contact, median(dist_m) AS med FROM edge JOIN root ON record_id = l GROUP BY root")
step("np", "SELECT a.root, min(jj) AS min_j, median(jj) AS med_j FROM (SELECT a.root, CASE WHEN len(list_distinct(list_concat(a.mtoks, b.mtoks))) = 0 THEN 0.0 ELSE len(list_intersect(a.mtoks, b.mtoks))::DOUBLE / len(list_distinct(list_concat(a.mtoks, b.mtoks))) END AS jj FROM mem a JOIN mem b ON a.root = b.root AND a.record_id < b.record_id) a GROUP BY a.root")
step("pdup", "SELECT root, max(n) AS max_same, sum(n) - count(*) AS dups FROM (SELECT root, provider, count(*) AS n FROM mem GROUP BY ALL) GROUP BY root")
step("sdom", "SELECT root, count(*) AS name_sigs, max(n) / sum(n) AS dom FROM (SELECT root, sig, count(*) AS n FROM mem WHERE sig IS NOT NULL GROUP BY ALL) GROUP BY root")
step("spp", f"SELECT root, count(*) AS pairs, bool_and((eq OR jj >= 0.6) AND coalesce(dd, 1e9) <= 300) AS benign FROM (SELECT a.root, a.msig = b.msig AND a.msig <> '' AS eq, CASE WHEN len(list_distinct(list_concat(a.mtoks, b.mtoks))) = 0 THEN 0.0 ELSE {_J} END AS jj, {_D} AS dd FROM mem a JOIN mem b ON a.root = b.root AND a.provider = b.provider AND a.record_id < b.record_id) GROUP BY root")
query("cluster_core", lambda s, d: cluster_of(s, d).clusters.select("root", "cluster_id", "cluster_size", "provider_count", "representative_record_id", F.round("max_geo_diameter_m").alias("diameter")), "SELECT root, cluster_id, cluster_size, provider_count, representative_record_id, round(diam) AS diameter FROM cc")
query("edge_diagnostics", lambda s, d: cluster_of(s, d).clusters.select("root", "edge_count", F.round("min_edge_probability", 6).alias("min_p"), "has_contact_evidence", "median_pair_distance_m"), "SELECT root, edge_count, round(min_p, 6) AS min_p, contact AS has_contact_evidence, round(med) AS median_pair_distance_m FROM ed")
query("pairwise_jaccard", lambda s, d: cluster_of(s, d).clusters.select("root", F.round("min_pairwise_name_match_jaccard", 6).alias("min_j"), F.round("median_pairwise_name_match_jaccard", 6).alias("med_j")), "SELECT root, round(min_j, 6) AS min_j, round(med_j, 6) AS med_j FROM np")
query("provider_duplicates", lambda s, d: cluster_of(s, d).clusters.select("root", "max_same_provider", "same_provider_duplicate_count", "same_provider_pair_count", "benign_same_provider_dup"), "SELECT root, max_same AS max_same_provider, dups::BIGINT AS same_provider_duplicate_count, coalesce(pairs, 0) AS same_provider_pair_count, max_same > 1 AND coalesce(benign, false) AS benign_same_provider_dup FROM pdup LEFT JOIN spp USING (root)")
query("signature_dominance", lambda s, d: cluster_of(s, d).clusters.select("root", "name_signature_count", F.round("dominant_name_signature_share", 6).alias("share")), "SELECT root, name_sigs AS name_signature_count, round(dom, 6) AS share FROM sdom")


def _why(size: int, diameter: int, drift: int) -> str:
    return f"""SELECT root, list_filter([CASE WHEN max_same > 1 AND NOT coalesce(benign, false) THEN 'same_provider_duplicate' END, CASE WHEN cluster_size > {size} THEN 'oversize' END, CASE WHEN diam > {diameter} AND NOT contact THEN 'geo_diameter_gt_500_no_contact' END, CASE WHEN diam > {drift} AND NOT contact THEN 'transitive_drift_geo_gt_1km' END,
 CASE WHEN diam > 10000 THEN 'geo_diameter_gt_10km' END, CASE WHEN NOT contact AND min_j < 0.45 THEN 'name_match_jaccard_lt_0_45_no_contact' END, CASE WHEN contact AND cluster_size > 2 AND min_j < 0.30 THEN 'contact_cluster_name_sanity' END], lambda x: x IS NOT NULL) AS reasons FROM cc JOIN ed USING (root) JOIN np USING (root) JOIN pdup USING (root) LEFT JOIN spp USING (root)"""


step("why", _why(20, 500, 1000))
step("whys", _why(2, 5, 20))
_STATUS = "CASE WHEN len(reasons) = 0 THEN 'auto_accept' ELSE 'review' END"
query("cluster_status", lambda s, d: cluster_of(s, d, "v2_2").clusters.select("root", F.array_join("review_reasons", ",").alias("reasons"), "cluster_status"), f"SELECT root, array_to_string(reasons, ',') AS reasons, {_STATUS} AS cluster_status FROM why")
query("assembled_diagnostics", lambda s, d: cluster_of(s, d, "v2_2").clusters.select("root", "cluster_id", "cluster_size", "provider_count", "edge_count", F.round("min_edge_probability", 6).alias("min_p"), "max_same_provider", "same_provider_dup", "benign_same_provider_dup", "has_contact_evidence", "name_signature_count", F.round("min_pairwise_name_match_jaccard", 6).alias("min_j"), F.round("max_geo_diameter_m").alias("diameter"), "is_building_merge", "entity_level", F.size("review_reasons").alias("reasons")),
      "SELECT root, cluster_id, cluster_size, provider_count, edge_count, round(min_p, 6) AS min_p, max_same AS max_same_provider, max_same > 1 AS same_provider_dup, max_same > 1 AND coalesce(benign, false) AS benign_same_provider_dup, contact AS has_contact_evidence, name_sigs AS name_signature_count, round(min_j, 6) AS min_j, round(diam) AS diameter, false AS is_building_merge, 'property' AS entity_level, len(reasons) AS reasons FROM cc JOIN ed USING (root) JOIN pdup USING (root) JOIN np USING (root) JOIN why USING (root) LEFT JOIN spp USING (root) LEFT JOIN sdom USING (root)")
query("reason_histogram", lambda s, d: clusters.reason_counts(cluster_of(s, d, "v2_2").clusters), "SELECT reason, count(*) AS clusters, sum(cluster_size)::BIGINT AS records FROM (SELECT unnest(reasons) AS reason, cluster_size FROM why JOIN cc USING (root)) GROUP BY reason")
query("cluster_members", lambda s, d: cluster_of(s, d, "v2_2").members, f"SELECT y.record_id, y.provider, cluster_id, CASE WHEN root IS NULL THEN 'singleton_unmatched' WHEN {_STATUS} = 'auto_accept' THEN 'matched_cluster' ELSE 'review_cluster' END AS status, coalesce(y.record_id = representative_record_id, true) AS is_representative FROM ready y LEFT JOIN root USING (record_id) LEFT JOIN cc USING (root) LEFT JOIN why USING (root)")
query("size_histogram", lambda s, d: explore.size_histogram(cluster_of(s, d, "v2_2").clusters), f"SELECT cluster_size, count(*) FILTER ({_STATUS} = 'auto_accept') AS auto_accept, count(*) FILTER ({_STATUS} = 'review') AS review FROM cc JOIN why USING (root) GROUP BY cluster_size")
query("cluster_summary", lambda s, d: clusters.summary(cluster_of(s, d, "v2_2").clusters).select("clusters_total", "auto_accepted", "review", "largest_cluster_size", "records_in_auto", "records_in_review"), f"SELECT count(*) AS clusters_total, count(*) FILTER ({_STATUS} = 'auto_accept') AS auto_accepted, count(*) FILTER ({_STATUS} = 'review') AS review, coalesce(max(cluster_size), 0) AS largest_cluster_size, coalesce(sum(cluster_size) FILTER ({_STATUS} = 'auto_accept'), 0)::BIGINT AS records_in_auto, coalesce(sum(cluster_size) FILTER ({_STATUS} = 'review'), 0)::BIGINT AS records_in_review FROM cc JOIN why USING (root)")
query("city_stats", lambda s, d: explore.city_stats(cluster_of(s, d, "v2_2").members, normalized(s, d).records), f"SELECT coalesce(y.city, '(no city)') AS city, count(*) AS records, count(*) FILTER (root IS NOT NULL AND {_STATUS} = 'auto_accept') AS matched_records, count(*) FILTER (root IS NOT NULL AND {_STATUS} = 'review') AS review_records, count(*) FILTER (root IS NULL) AS unmapped_records, count(DISTINCT cluster_id) AS clusters, count(DISTINCT y.provider) AS providers FROM ready y LEFT JOIN root USING (record_id) LEFT JOIN cc USING (root) LEFT JOIN why USING (root) GROUP BY ALL")
query("cluster_search", lambda s, d: explore.search_clusters(cluster_of(s, d, "v2_2").clusters, cluster_of(s, d, "v2_2").members, normalized(s, d).records, search="and", page_size=20).select("cluster_id", "cluster_size"), "SELECT cluster_id, cluster_size FROM cc WHERE cluster_id LIKE '%and%' OR root IN (SELECT root FROM mem WHERE name LIKE '%and%') ORDER BY cluster_size DESC, cluster_id LIMIT 20")
query("unmapped", lambda s, d: explore.unmapped(cluster_of(s, d, "v2_2").members, normalized(s, d).records, city="fr town").select("record_id", "provider"), "SELECT record_id, provider FROM ready WHERE record_id NOT IN (SELECT record_id FROM root) AND city = 'fr town'")
query("entity_mappings", lambda s, d: export.entity_mappings(export.with_entity_ids(cluster_of(s, d, "v2_2").members, normalized(s, d).records, "XX"), cluster_of(s, d, "v2_2").clusters).withColumn("confidence", F.round("confidence", 6)),
      f"SELECT coalesce(cluster_id, 'XX_GH6-' || upper(substr(md5(y.provider || '::' || string_split(y.record_id, '::')[2]), 1, 16))) AS entity_id, y.provider AS provider_name, string_split(y.record_id, '::')[2] AS provider_code, y.provider || '###' || string_split(y.record_id, '::')[2] AS provider_key, coalesce(y.record_id = representative_record_id, true)::INT AS is_representative, CASE WHEN root IS NOT NULL AND {_STATUS} = 'review' THEN 'review' ELSE 'auto' END AS mapping_type, round(min_p, 6) AS confidence FROM ready y LEFT JOIN root USING (record_id) LEFT JOIN cc USING (root) LEFT JOIN ed USING (root) LEFT JOIN why USING (root)")
query("entity_info", lambda s, d: export.entity_info(export.with_entity_ids(cluster_of(s, d, "v2_2").members, normalized(s, d).records, "XX"), normalized(s, d).records, {"star_rating": "star_rating_norm", "city_name": "city_name", "lat": "lat_norm", "hotel_chain": "hotel_chain_norm"}),
      "SELECT entity_id, arg_min(star, (o, record_id)) FILTER (star IS NOT NULL) AS star_rating, arg_min(city, (o, record_id)) AS city_name, arg_min(lat, (o, record_id)) FILTER (lat IS NOT NULL) AS lat, arg_min(chain, (o, record_id)) FILTER (chain IS NOT NULL) AS hotel_chain FROM (SELECT y.*, coalesce(cluster_id, 'XX_GH6-' || upper(substr(md5(y.provider || '::' || string_split(y.record_id, '::')[2]), 1, 16))) AS entity_id, CASE WHEN coalesce(y.record_id = representative_record_id, true) THEN 0 ELSE 1 END AS o FROM ready y LEFT JOIN root USING (record_id) LEFT JOIN cc USING (root)) GROUP BY entity_id")
step("rp", "SELECT l, r, pl, pr, p, 'RQE_' || substr(md5(l || '|' || r || '|' || reason), 1, 16) AS review_id, why AS review_reason, CASE WHEN why IN ('contact_or_email_true_like_but_failed_coherence', 'exact_email_strong_name', 'phone_strong_name', 'signature_review_pair') THEN 'high_confidence_likely_true' ELSE 'medium_name_plus_geo' END AS review_bucket, (6 + CASE WHEN reason = 'exact_email' AND (coalesce(j, 0) >= 0.6 OR dist_m <= 500) THEN 40 ELSE 0 END + CASE WHEN reason = 'phone' AND j >= 0.6 THEN 35 ELSE 0 END + CASE WHEN reason = 'signature' THEN 30 WHEN reason = 'medium_name_plus_geo' THEN 10 ELSE 0 END + CASE WHEN why LIKE 'contact_or%' THEN 140 ELSE 0 END)::INT AS priority FROM (SELECT *, CASE WHEN reason = 'exact_email' AND dist_m <= 500 THEN 'contact_or_email_true_like_but_failed_coherence' WHEN reason = 'phone' AND j >= 0.6 AND dist_m <= 500 THEN 'contact_or_email_true_like_but_failed_coherence' WHEN reason = 'exact_email' AND j >= 0.6 THEN 'exact_email_strong_name' WHEN reason = 'phone' AND j >= 0.6 THEN 'phone_strong_name' WHEN reason = 'signature' THEN 'signature_review_pair' WHEN reason = 'medium_name_plus_geo' THEN reason ELSE 'needs_more_info' END AS why FROM gated WHERE (l, r) NOT IN (SELECT (l, r) FROM edge) AND ((reason IN ('signature', 'phone', 'exact_email', 'non_reused_domain') AND p >= 0.90 AND p < 0.99) OR reason = 'medium_name_plus_geo'))")
query("review_pairs", lambda s, d: _pairs_in_review(s, d).select("review_id", "review_reason", "review_bucket", "priority"), "SELECT review_id, review_reason, review_bucket, priority FROM rp")

# The queue for people: clusters in review under the strict policy, and pairs.
_TRUE = review.TRUE_LIKE
_HAS = lambda name: f"list_contains(reasons, '{name}')"
_NEAR = "(diam <= 500 OR contact)"
step("es", "SELECT root, max(p) AS best_p, arg_max(reason, (p, reason)) AS best_reason, arg_min(reason, (p, reason)) AS worst_reason, bool_or(reason = 'signature') AS sig_edge, bool_or(reason = 'exact_email' AND j >= 0.6) AS email_strong, bool_or(reason = 'phone' AND j >= 0.6) AS phone_strong, bool_or(reason = 'signature' AND dist_m > 500) AS sig_far, bool_and(reason IN ('phone', 'exact_email', 'non_reused_domain')) AS contact_only FROM edge JOIN root ON record_id = l GROUP BY root")
step("rv", "SELECT cc.root, cluster_id, y.* FROM cc JOIN whys USING (root) JOIN root USING (root) JOIN ready y USING (record_id) WHERE len(reasons) > 0")
_TOP5 = lambda c, sep: f"SELECT root, string_agg(v, '{sep}' ORDER BY rn) AS {c}s FROM (SELECT root, {c} AS v, row_number() OVER (PARTITION BY root ORDER BY count(*) DESC, {c}) AS rn FROM rv WHERE {c} IS NOT NULL GROUP BY root, {c}) WHERE rn <= 5 GROUP BY root"
_SHARED = lambda c, sql: f"SELECT root, string_agg(v, ', ' ORDER BY v) AS {c} FROM (SELECT root, v FROM ({sql}) WHERE v IS NOT NULL GROUP BY root, v HAVING count(DISTINCT record_id) >= 2) GROUP BY root"
step("rvt", f"SELECT root, string_agg(DISTINCT provider, ', ' ORDER BY provider) AS providers FROM rv GROUP BY root")
step("rvn", _TOP5("name", " | "))
step("rvc", _TOP5("city", ", "))
step("rvp", _TOP5("postal", ", "))
step("rvph", _SHARED("shared_phones", "SELECT root, record_id, unnest(phones) AS v FROM rv"))
step("rvem", _SHARED("shared_emails", "SELECT root, record_id, unnest(emails) AS v FROM rv"))
step("rvdo", _SHARED("shared_domains", "SELECT root, record_id, domain AS v FROM rv"))
step("rc0", f"""SELECT *, CASE WHEN {_HAS('transitive_drift_geo_gt_1km')} THEN 'transitive_drift' WHEN contact AND (cluster_size > 20 OR diam > 1000 OR min_j < 0.45) THEN 'contact_overmerge_risk'
  WHEN {_HAS('same_provider_duplicate')} AND len(reasons) = 1 AND min_j >= 0.6 AND {_NEAR} THEN 'same_provider_duplicate_only_coherent' WHEN (email_strong OR phone_strong) AND {_HAS('contact_cluster_name_sanity')} AND cluster_size <= 10 THEN '{_TRUE}'
  WHEN email_strong AND cluster_size <= 10 AND {_NEAR} THEN 'exact_email_strong_name' WHEN phone_strong AND cluster_size <= 10 AND {_NEAR} THEN 'phone_strong_name' WHEN sig_far THEN 'signature_geo_diameter_issue' WHEN {_HAS('same_provider_duplicate')} THEN 'same_provider_duplicates' ELSE 'needs_more_info' END AS review_reason
  FROM whys JOIN cc USING (root) JOIN ed USING (root) JOIN np USING (root) JOIN es USING (root) WHERE len(reasons) > 0""")
step("rc1", f"""SELECT *, CASE WHEN review_reason IN ('{_TRUE}', 'exact_email_strong_name', 'phone_strong_name', 'signature_geo_diameter_issue', 'same_provider_duplicate_only_coherent') THEN 'high_confidence_likely_true' WHEN review_reason IN ('transitive_drift', 'same_provider_duplicates') THEN review_reason ELSE 'contact_overmerge_risk' END AS review_bucket,
  (least(cluster_size, 10) + 2 * provider_count + CASE WHEN email_strong THEN 40 ELSE 0 END + CASE WHEN phone_strong THEN 35 ELSE 0 END + CASE WHEN sig_edge THEN 30 ELSE 0 END + CASE WHEN {_HAS('same_provider_duplicate')} THEN 20 ELSE 0 END + CASE WHEN {_HAS('geo_diameter_gt_500_no_contact')} THEN 20 ELSE 0 END + CASE WHEN {_HAS('oversize')} THEN 25 ELSE 0 END
   + CASE WHEN contact_only THEN 25 ELSE 0 END + CASE WHEN {_HAS('transitive_drift_geo_gt_1km')} THEN 30 ELSE 0 END + CASE WHEN {_HAS('geo_diameter_gt_10km')} THEN 30 ELSE 0 END + CASE WHEN review_reason = '{_TRUE}' THEN 15 ELSE 0 END)::INT AS priority FROM rc0""")
step("rc", """SELECT 'RQC_' || substr(md5(cluster_id), 1, 16) AS review_id, 'cluster' AS review_entity_type, rc1.*, providers, names, citys, postals, shared_phones, shared_emails, shared_domains, CASE WHEN review_bucket = 'high_confidence_likely_true' THEN CASE WHEN review_reason = 'same_provider_duplicate_only_coherent' THEN 'provider_duplicate' ELSE 'accept_cluster' END WHEN review_bucket IN ('contact_overmerge_risk', 'transitive_drift') THEN 'split_cluster' ELSE 'provider_duplicate' END AS suggested_action
  FROM rc1 JOIN rvt USING (root) LEFT JOIN rvn USING (root) LEFT JOIN rvc USING (root) LEFT JOIN rvp USING (root) LEFT JOIN rvph USING (root) LEFT JOIN rvem USING (root) LEFT JOIN rvdo USING (root)""")


def _clusters_in_review(s: SparkSession, d: str) -> DataFrame:
    c = cluster_of(s, d, "strict")
    return review.review_clusters(c.clusters, c.members, c.edges, normalized(s, d).records)


def _pairs_in_review(s: SparkSession, d: str) -> DataFrame:
    return review.review_pairs(gate.gated(featured(s, d)), cluster_of(s, d, "strict").edges, normalized(s, d).records)


def queue_of(s: SparkSession, d: str) -> DataFrame:
    return review.queue(_clusters_in_review(s, d), _pairs_in_review(s, d))


query("review_clusters", lambda s, d: _clusters_in_review(s, d).select("review_id", "review_reason", "review_bucket", "priority", "suggested_action", "providers", F.md5("representative_names").alias("names"), "cities", "postal_codes", "shared_phones", "shared_emails", "shared_domains", "best_edge_reason", "worst_edge_reason"),
      "SELECT review_id, review_reason, review_bucket, priority, suggested_action, providers, md5(names) AS names, citys AS cities, postals AS postal_codes, shared_phones, shared_emails, shared_domains, best_reason AS best_edge_reason, worst_reason AS worst_edge_reason FROM rc")
step("rq", """SELECT review_id, review_entity_type, review_bucket, priority, suggested_action, cluster_id, providers, names, citys AS cities, best_p FROM rc UNION ALL
  SELECT review_id, 'pair', review_bucket, priority, 'accept_pair_only', 'PAIR_' || substr(md5(l || '|' || r), 1, 16), pl || ', ' || pr, a.name || ' | ' || b.name, CASE WHEN a.city IS NOT DISTINCT FROM b.city THEN a.city ELSE coalesce(a.city, '') || ', ' || coalesce(b.city, '') END, p FROM rp JOIN ready a ON a.record_id = l JOIN ready b ON b.record_id = r""")
query("review_buckets", lambda s, d: review.bucket_counts(queue_of(s, d)), "SELECT review_bucket, review_entity_type, count(*) AS item_count, round(avg(priority), 1) AS avg_priority, max(priority) AS max_priority FROM rq GROUP BY ALL")
query("review_bucket_topn", lambda s, d: review.bucket_samples(queue_of(s, d), 20).select("review_id", "review_bucket", "bucket_rank"), "SELECT review_id, review_bucket, bucket_rank FROM (SELECT *, row_number() OVER (PARTITION BY review_bucket ORDER BY priority DESC, best_p DESC, review_id)::INT AS bucket_rank FROM rq) WHERE bucket_rank <= 20")
query("review_top", lambda s, d: review.top(queue_of(s, d), 500).select("review_id", "priority"), "SELECT review_id, priority FROM rq ORDER BY priority DESC, best_p DESC, review_id LIMIT 500")
query("review_page", lambda s, d: explore.queue_page(queue_of(s, d), bucket="medium_name_plus_geo", search="TOWN", page=2, page_size=3).select("review_id", "review_entity_type", "priority", "cluster_id", "providers", "cities", "suggested_action", "best_edge_probability"),
      "SELECT review_id, review_entity_type, priority, cluster_id, providers, cities, suggested_action, round(best_p, 4) AS best_edge_probability FROM rq WHERE review_bucket = 'medium_name_plus_geo' AND (review_id ILIKE '%town%' OR cluster_id ILIKE '%town%' OR names ILIKE '%town%' OR providers ILIKE '%town%' OR cities ILIKE '%town%') ORDER BY priority DESC, best_p DESC, review_id LIMIT 3 OFFSET 3")
query("review_total", lambda s, d: explore.queue_rows(queue_of(s, d), action="accept_pair_only", search="src2").agg(F.count("*").alias("total")), "SELECT count(*) AS total FROM rq WHERE suggested_action = 'accept_pair_only' AND (review_id ILIKE '%src2%' OR cluster_id ILIKE '%src2%' OR names ILIKE '%src2%' OR providers ILIKE '%src2%' OR cities ILIKE '%src2%')")


def _first(rows: DataFrame) -> str:
    """The id of the most urgent item; of an empty queue one that no item has."""
    found = rows.orderBy(F.desc("priority"), "review_id").select("review_id").first()
    return found[0] if found else "RQE_0"


def detail_of(s: SparkSession, d: str, pair: bool) -> dict[str, DataFrame]:
    """The most urgent pair or cluster, as the front shows it."""
    c, n, gated = cluster_of(s, d, "strict"), normalized(s, d), gate.gated(featured(s, d))
    items, pairs = _clusters_in_review(s, d), _pairs_in_review(s, d)
    return explore.review_detail(_first(pairs if pair else items), items, pairs, c.members, c.edges, gated, n.records)


_ONE_PAIR, _ONE_CLUSTER = "(SELECT * FROM rp ORDER BY priority DESC, review_id LIMIT 1)", "(SELECT * FROM rc ORDER BY priority DESC, review_id LIMIT 1)"
query("review_detail_members", lambda s, d: detail_of(s, d, True)["members"].select("record_id", "provider", "city", "postal_code", "lat_norm"), f"SELECT record_id, provider, city, postal AS postal_code, round(lat, 6) AS lat_norm FROM ready WHERE record_id IN (SELECT unnest([l, r]) FROM {_ONE_PAIR})")
query("review_detail_edges", lambda s, d: detail_of(s, d, False)["edges"].select("record_id_l", "record_id_r", "gate_reason", "match_probability"), f"SELECT l AS record_id_l, r AS record_id_r, reason AS gate_reason, round(p, 4) AS match_probability FROM edge JOIN root ON record_id = l WHERE root IN (SELECT root FROM {_ONE_CLUSTER}) ORDER BY p DESC, l, r LIMIT 500")
query("overview", lambda s, d: explore.overview(clustering=clusters.summary(cluster_of(s, d, "v2_2").clusters).select("clusters_total", "auto_accepted", "review", "records_in_auto"), review_queue=review.bucket_counts(queue_of(s, d)).groupBy(F.col("review_bucket").alias("name")).agg(F.sum("item_count").alias("value"))).unionByName(diagnostics_rows(s, d)),
      f"SELECT 'clustering' AS section, unnest(['clusters_total', 'auto_accepted', 'review', 'records_in_auto']) AS name, unnest([count(*), count(*) FILTER ({_STATUS} = 'auto_accept'), count(*) FILTER ({_STATUS} = 'review'), coalesce(sum(cluster_size) FILTER ({_STATUS} = 'auto_accept'), 0)::BIGINT])::DOUBLE AS value FROM cc JOIN why USING (root) UNION ALL SELECT 'review_queue', review_bucket, count(*)::DOUBLE FROM rq GROUP BY review_bucket UNION ALL SELECT * FROM qd")
query("cities", lambda s, d: explore.cities(explore.city_stats(cluster_of(s, d, "v2_2").members, normalized(s, d).records), search="TOWN", page=1, page_size=3).select("city", "records", "matched_share"),
      f"SELECT city, records, round(matched / records, 4) AS matched_share FROM (SELECT coalesce(y.city, '(no city)') AS city, count(*) AS records, count(*) FILTER (root IS NOT NULL AND {_STATUS} = 'auto_accept') AS matched FROM ready y LEFT JOIN root USING (record_id) LEFT JOIN cc USING (root) LEFT JOIN why USING (root) GROUP BY ALL) WHERE city ILIKE '%town%' ORDER BY records DESC, city LIMIT 3")
step("ctown", "SELECT root, arg_max(city, (n, city)) AS town FROM (SELECT root, city, count(*) AS n FROM root JOIN ready USING (record_id) WHERE city IS NOT NULL GROUP BY ALL) GROUP BY root")
query("city_clusters", lambda s, d: explore.city_clusters(explore.centroids(cluster_of(s, d, "v2_2").clusters, cluster_of(s, d, "v2_2").members, normalized(s, d).records), "en town").select("cluster_id", "cluster_status", "cluster_size", "provider_count"),
      f"SELECT cluster_id, {_STATUS} AS cluster_status, cluster_size, provider_count FROM cc JOIN why USING (root) JOIN ctown USING (root) WHERE town = 'en town' ORDER BY cluster_size DESC, cluster_id LIMIT 200")
query("cluster_detail", lambda s, d: explore.cluster_detail(cluster_of(s, d, "v2_2").clusters.orderBy(F.desc("cluster_size"), "cluster_id").first().cluster_id, cluster_of(s, d, "v2_2").members, normalized(s, d).records).select("record_id", "is_representative", F.round("dist_to_centroid_m").alias("dist_m")),
      f"SELECT record_id, record_id = representative_record_id AS is_representative, round(2 * 6371000 * asin(sqrt(pow(sin(radians(clat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(clat)) * pow(sin(radians(clng - lng) / 2), 2)))) AS dist_m FROM (SELECT *, avg(lat) OVER () AS clat, avg(lng) OVER () AS clng FROM root JOIN (SELECT root, representative_record_id FROM cc ORDER BY cluster_size DESC, cluster_id LIMIT 1) USING (root) JOIN (SELECT record_id, lat, lng FROM ready) USING (record_id))")
step("why21", """SELECT root, len(list_filter([max_same > 1, cluster_size > 20, diam > 500 AND NOT contact, diam > 1000 AND NOT contact, NOT contact AND min_j < 0.45, contact AND cluster_size > 2 AND min_j < 0.30], lambda x: x)) AS n FROM cc JOIN ed USING (root) JOIN np USING (root) JOIN pdup USING (root)""")
_SUM = lambda ok, frm: f"SELECT unnest(['clusters_total', 'auto_accepted', 'review', 'largest_cluster_size', 'records_in_auto', 'records_in_review']) AS metric, unnest([count(*), count(*) FILTER ({ok}), count(*) FILTER (NOT ({ok})), coalesce(max(cluster_size), 0), coalesce(sum(cluster_size) FILTER ({ok}), 0)::BIGINT, coalesce(sum(cluster_size) FILTER (NOT ({ok})), 0)::BIGINT])::DOUBLE AS v FROM {frm} JOIN cc USING (root)"
_SIX = ("clusters_total", "auto_accepted", "review", "largest_cluster_size", "records_in_auto", "records_in_review")
query("version_delta", lambda s, d: gate.delta(*(clusters.summary(cluster_of(s, d, v).clusters).select(*_SIX) for v in ("v2_1", "v2_2"))), f"SELECT metric, a.v AS old, b.v AS new, b.v - a.v AS delta FROM ({_SUM('n = 0', 'why21')}) a JOIN ({_SUM('len(reasons) = 0', 'why')}) b USING (metric)")
step("ents", "SELECT y.record_id, y.provider, y.country, string_split(y.record_id, '::')[2] AS code, coalesce(cluster_id, 'XX_GH6-' || upper(substr(md5(y.provider || '::' || string_split(y.record_id, '::')[2]), 1, 16))) AS entity_id, CASE WHEN coalesce(y.record_id = representative_record_id, true) THEN 0 ELSE 1 END AS o FROM ready y LEFT JOIN root USING (record_id) LEFT JOIN cc USING (root)")
query("entity_summaries", lambda s, d: export.entity_summaries(export.with_entity_ids(cluster_of(s, d, "v2_2").members, normalized(s, d).records, "XX"), normalized(s, d).records).drop("members", "property_name"),
      """SELECT entity_id, provider AS representative_provider, code AS representative_code, country AS country_code, cluster_size, supplier_count, supplier_breakdown FROM (
  SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY o, record_id) AS rn, count(*) OVER (PARTITION BY entity_id) AS cluster_size FROM ents) JOIN (
  SELECT entity_id, count(*) AS supplier_count, '{' || string_agg('"' || provider || '":' || n, ',' ORDER BY provider) || '}' AS supplier_breakdown FROM (SELECT entity_id, provider, count(*) AS n FROM ents GROUP BY ALL) GROUP BY entity_id) USING (entity_id) WHERE rn = 1""")
query("conflict_splits", lambda s, d: cluster_of(s, d, "v2_4").conflicts)
query("sig_city_adoption", lambda s, d: cluster_of(s, d, "v2_4").edges.where("gate_reason = 'sig_city_adoption'").select("record_id_l", "record_id_r", "cluster_id"))
query("cluster_diagnostics", lambda s, d: cluster_of(s, d, "v2_4").clusters.drop("providers_present"))
query("u_estimates", lambda s, d: s.createDataFrame([(k, i, x) for k, v in scoring.estimate_u(normalized(s, d).records).items() for i, x in enumerate(v)], "comparison string, level int, u double"))
query("em_trained_scores", lambda s, d: scoring.scored(compared(s, d), scoring.fit(normalized(s, d).records)).select("record_id_l", "record_id_r", "match_probability"))
query("band_samples", lambda s, d: scoring.band_samples(_audit(s, d), 50).select("record_id_l", "record_id_r", "band"), "SELECT record_id_l, record_id_r, band FROM (SELECT l AS record_id_l, r AS record_id_r, band, row_number() OVER (PARTITION BY band ORDER BY md5(l || '|' || r)) AS rn FROM aud) WHERE rn <= 50")
query("pair_samples", lambda s, d: blocking.sample_pairs(blocking.same_cell(normalized(s, d).rows), normalized(s, d).rows, 100).select("record_id_l", "record_id_r"), "SELECT a.record_id AS record_id_l, b.record_id AS record_id_r FROM keys a JOIN keys b ON a.rule = 0 AND b.rule = 0 AND a.k = b.k AND a.provider < b.provider WHERE a.k IN (SELECT k FROM (SELECT k, provider, count(*) AS n FROM keys WHERE rule = 0 GROUP BY ALL) GROUP BY k HAVING (sum(n) * sum(n) - sum(n * n)) / 2 BETWEEN 1 AND 2000) ORDER BY md5(a.record_id || '|' || b.record_id) LIMIT 100")
step("mid", "SELECT cluster_id, avg(lat) AS lat, avg(lng) AS lng, max(cluster_size) AS cluster_size FROM root JOIN cc USING (root) JOIN ready USING (record_id) GROUP BY cluster_id")
query("nearest_clusters", lambda s, d: explore.nearest_clusters(normalized(s, d).records.where("record_id = 'src1::1::0'"), explore.centroids(cluster_of(s, d, "v2_2").clusters, cluster_of(s, d, "v2_2").members, normalized(s, d).records)).select("cluster_id", "dist_m"),
      "SELECT cluster_id, round(2 * 6371000 * asin(sqrt(pow(sin(radians(m.lat - q.lat) / 2), 2) + cos(radians(q.lat)) * cos(radians(m.lat)) * pow(sin(radians(m.lng - q.lng) / 2), 2)))) AS dist_m FROM mid m, (SELECT lat, lng FROM ready WHERE record_id = 'src1::1::0') q WHERE m.lat IS NOT NULL ORDER BY dist_m, cluster_size DESC, cluster_id LIMIT 8")
STEPS.clear()
query("latest_decision", lambda s, d: explore.latest_decisions(table(s, d, "events").select(F.col("user_id").alias("review_id"), F.struct("ts", "event_id").alias("seq"), F.col("event_type").alias("decision"))).select("review_id", "decision"), "SELECT user_id AS review_id, arg_max(event_type, (ts, event_id)) AS decision FROM events GROUP BY user_id")

# Splits, adoption and what else names and places tell, on parts as listings: 40 components of names of two to four words.
STEPS.clear()


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as records: a name and sometimes a number, a place by size and family, five providers, three cities."""
    k, words, none = F.col("p_partkey"), F.split("p_name", " "), F.array().cast("array<string>")
    coded = F.when(k % 3 == 0, F.array((F.lit(1000) + F.col("p_size") % 4).cast("string"))).otherwise(none)
    spread = F.when(F.col("p_name").startswith("small"), (k % 3) * 0.1).otherwise(0.0)
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("p"), k).alias("record_id"), F.concat(F.lit("v"), k % 5).alias("provider"), F.concat(F.lit("r"), k % 40).alias("root"), F.concat(words, coded).alias("property_name_core_tokens"), words.alias("match_tokens"),
        F.col("p_name").alias("property_name_match_signature"), F.concat(F.lit("c"), k % 3).alias("city_name_norm"), (F.length("p_name") * 0.01 + (k % 4) * 0.0002 + spread).alias("lat_norm"), (20 + (F.col("p_size") % 4) * 0.0002).alias("lng_norm"),
        (k % 11 == 0).alias("lat_lng_low_precision"), F.concat(F.col("p_name"), F.lit(" apartment no "), F.col("p_size")).alias("name"), F.when(k % 2 == 0, "apartment").otherwise("hotel").alias("property_type"), F.when(k % 2 == 0, F.array(F.lower("p_type"))).otherwise(none).alias("brand_tokens"),
    )


def _roots(s: SparkSession, d: str) -> DataFrame:
    return listings(s, d).select("record_id", "root")


def _words(s: SparkSession, d: str) -> DataFrame:
    return listings(s, d).select(F.explode("property_name_core_tokens").alias("token")).groupBy("token").agg(F.count("*").alias("doc_freq"))


step("p", """SELECT 'p' || p_partkey AS record_id, 'v' || (p_partkey % 5) AS provider, 'r' || (p_partkey % 40) AS root, string_split(p_name, ' ') || CASE WHEN p_partkey % 3 = 0 THEN [(1000 + p_size % 4)::VARCHAR] ELSE [] END AS toks, string_split(p_name, ' ') AS mtoks, p_name AS msig, 'c' || (p_partkey % 3) AS city,
  CASE WHEN p_partkey % 11 <> 0 THEN length(p_name) * 0.01::DOUBLE + (p_partkey % 4) * 0.0002::DOUBLE + CASE WHEN p_name LIKE 'small%' THEN (p_partkey % 3) * 0.1::DOUBLE ELSE 0 END END AS lat, CASE WHEN p_partkey % 11 <> 0 THEN 20 + (p_size % 4) * 0.0002::DOUBLE END AS lng,
  p_name || ' apartment no ' || p_size AS name, p_size, p_partkey % 2 = 0 AS even, lower(p_type) AS brand FROM part""")
_FAR = lambda a, b: f"2 * 6371000 * asin(sqrt(pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lng - {a}.lng) / 2), 2)))"
step("pf", "SELECT token, count(*) AS doc_freq FROM (SELECT unnest(toks) AS token FROM p) GROUP BY token")
step("ps", "SELECT *, array_to_string(list_sort(toks), ' ') AS sig FROM p")
step("pg", "SELECT root, sig, list_sort(string_split(sig, ' ')) AS tokens, count(*) AS n, count(lat) AS points, avg(lat) AS lat, avg(lng) AS lng FROM ps GROUP BY root, sig")
step("pg2", f"SELECT g.*, m.spread, list_filter(tokens, lambda t: t IN ('')) AS none FROM pg g LEFT JOIN (SELECT x.root, x.sig, max({_FAR('x', 'g')}) AS spread FROM ps x JOIN pg g ON x.root = g.root AND x.sig = g.sig WHERE x.lat IS NOT NULL GROUP BY ALL) m ON g.root = m.root AND g.sig = m.sig")
step("pg3", "SELECT g.*, r.rare FROM pg2 g JOIN (SELECT root, sig, coalesce(list(token) FILTER (doc_freq <= 300), []) AS rare FROM (SELECT root, sig, unnest(tokens) AS token FROM pg2) JOIN pf USING (token) GROUP BY root, sig) r ON g.root = r.root AND g.sig = r.sig")
_LIVE = lambda a, b: f"list_filter({a}.tokens, lambda t: NOT list_contains({b}.tokens, t) AND length(t) >= 4 AND len(list_filter({b}.tokens, lambda o: levenshtein(t, o) <= 2 OR (length(t) >= 4 AND length(o) >= 4 AND (contains(t, o) OR contains(o, t))))) = 0)"
step("pc", f"SELECT a.root, a.sig AS sig_a, b.sig AS sig_b, a.n AS members_a, b.n AS members_b, a.points AS points_a, b.points AS points_b, coalesce(a.spread, 0) AS spread_a, coalesce(b.spread, 0) AS spread_b, a.rare AS rare_a, b.rare AS rare_b, len(list_filter(a.tokens, lambda t: NOT list_contains(b.tokens, t))) AS only_a, len(list_filter(b.tokens, lambda t: NOT list_contains(a.tokens, t))) AS only_b, {_LIVE('a', 'b')} AS live_a, {_LIVE('b', 'a')} AS live_b, {_FAR('a', 'b')} AS sep FROM pg3 a JOIN pg3 b ON a.root = b.root AND a.sig < b.sig")
_CODES = "'^[0-9]+[a-z]{0,2}$'"
step("pc2", "SELECT *, greatest(spread_a, spread_b, 1) AS wide, " + ", ".join(f"len(list_filter(list_intersect(live_{x}, rare_{x}), lambda t: {n} regexp_matches(t, {_CODES}))) AS {k}_{x}" for x in "ab" for k, n in (("alpha", "NOT"), ("code", ""))) + " FROM pc")
step("pc3", "SELECT *, CASE WHEN alpha_a > 0 AND alpha_b > 0 THEN 'rare_token_conflict' WHEN code_a > 0 AND code_b > 0 AND sep > 350 AND sep > 2 * wide THEN 'numeric_id_conflict' WHEN sep > 350 AND points_a >= 2 AND points_b >= 2 AND sep > 3 * wide AND spread_a < 150 AND spread_b < 150 THEN 'geo_split' END AS conflict_type FROM pc2 WHERE NOT (only_a > 0 AND only_b > 0 AND len(live_a) = 0 AND len(live_b) = 0)")
query("subgroups", lambda s, d: clusters.subgroups(_roots(s, d), listings(s, d)).select("root", "sig", "n", "points", F.round("spread").alias("spread")), "SELECT root, sig, n, points, round(spread) AS spread FROM pg2")
query("subgroup_conflicts", lambda s, d: clusters.conflicts(clusters.subgroups(_roots(s, d), listings(s, d)), _words(s, d)), "SELECT root, sig_a, sig_b, conflict_type, round(sep)::BIGINT AS sep_m, members_a, members_b FROM pc3 WHERE conflict_type IS NOT NULL")


def _chain_of(s: SparkSession, d: str) -> DataFrame:
    """Links of each listing to the next of its component."""
    k = F.col("k")
    rows = table(s, d, "part").select(F.col("p_partkey").alias("k")).where("k >= 40")
    return rows.select(F.concat(F.lit("p"), k - 40).alias("record_id_l"), F.concat(F.lit("p"), k).alias("record_id_r"))


step("pe", "SELECT 'p' || (p_partkey - 40) AS l, 'p' || p_partkey AS r FROM part WHERE p_partkey >= 40")
query("conflict_edges_cut", lambda s, d: clusters.cut(_chain_of(s, d), _roots(s, d), listings(s, d), clusters.conflicts(clusters.subgroups(_roots(s, d), listings(s, d)), _words(s, d))),
      "SELECT l AS record_id_l, r AS record_id_r FROM pe JOIN ps a ON a.record_id = l JOIN ps b ON b.record_id = r WHERE (a.root, least(a.sig, b.sig), greatest(a.sig, b.sig)) NOT IN (SELECT (root, sig_a, sig_b) FROM pc3 WHERE conflict_type IS NOT NULL)")

step("ar", "SELECT record_id, provider, msig, city, lat, lng, CASE WHEN substr(record_id, 2)::INT % 7 = 0 THEN 'g' || (substr(record_id, 2)::INT % 70) END AS root FROM p")
_TIGHT = lambda by: f"SELECT {', '.join('x.' + b for b in by)} FROM ar x JOIN (SELECT {', '.join(by)}, avg(lat) AS lat, avg(lng) AS lng FROM ar GROUP BY {', '.join(by)}) m ON {' AND '.join(f'x.{b} = m.{b}' for b in by)} GROUP BY {', '.join('x.' + b for b in by)} HAVING max({_FAR('x', 'm')}) <= 250"
step("aw", _TIGHT(["msig"]))
step("ap", _TIGHT(["msig", "city"]))
step("ag", "SELECT *, msig AS grp FROM ar WHERE msig IN (SELECT msig FROM aw) UNION ALL SELECT *, msig || chr(1) || city FROM ar WHERE msig NOT IN (SELECT msig FROM aw) AND (msig, city) IN (SELECT (msig, city) FROM ap)")
step("ah", "SELECT grp, arg_min(record_id, (root IS NULL, record_id)) AS anchor, bool_and(root IS NULL) AS alone, count(*) AS n, count(DISTINCT provider) AS providers, coalesce(list(DISTINCT provider) FILTER (root IS NOT NULL), []) AS taken FROM ag GROUP BY grp")
step("ax", "SELECT g.*, h.anchor, h.alone, a.provider AS anchor_provider, a.root AS anchor_root, CASE WHEN h.alone THEN [a.provider] ELSE h.taken END AS taken FROM ag g JOIN ah h USING (grp) JOIN ag a ON a.grp = g.grp AND a.record_id = h.anchor WHERE g.record_id <> h.anchor AND (NOT h.alone OR (h.n >= 2 AND h.providers >= 2))")
query("adopted_links", lambda s, d: clusters.adopted(_chain_of(s, d), listings(s, d).where(F.substring("record_id", 2, 9).cast("int") % 7 == 0).select("record_id", F.concat(F.lit("g"), F.substring("record_id", 2, 9).cast("int") % 70).alias("root")), listings(s, d).drop("root")).select("record_id_l", "record_id_r", "provider_l", "provider_r"),
      "SELECT anchor AS record_id_l, record_id AS record_id_r, anchor_provider AS provider_l, provider AS provider_r FROM (SELECT *, row_number() OVER (PARTITION BY grp, root ORDER BY record_id) AS rn FROM ax WHERE root IS NOT NULL AND root <> anchor_root) WHERE rn = 1 UNION ALL SELECT anchor, record_id, anchor_provider, provider FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY record_id) AS rn FROM ax WHERE root IS NULL AND NOT list_contains(taken, provider)) WHERE rn <= 10")
query("unit_shares", lambda s, d: clusters.units(listings(s, d)), "SELECT root, 1.0::DOUBLE AS apartment_style_share, 0.0::DOUBLE AS villa_style_share, count(DISTINCT p_size) AS distinct_unit_numbers FROM p GROUP BY root")
query("top_token", lambda s, d: clusters.top_token(listings(s, d)), "SELECT root, max(n) AS top_token_members FROM (SELECT root, token, count(*) AS n FROM (SELECT DISTINCT root, record_id, unnest(mtoks) AS token FROM p) GROUP BY ALL) GROUP BY root")
_GROUPS = clusters.ClusterPolicy(brand_groups={"plain": ["economy", "standard"]})
query("brand_conflicts", lambda s, d: clusters.brand_conflicts(listings(s, d).where("root < 'r2'"), _GROUPS), "SELECT a.root, bool_or(a.b <> b.b) AS brand_conflict FROM (SELECT DISTINCT root, CASE WHEN brand IN ('economy', 'standard') THEN 'plain' ELSE brand END AS b FROM p WHERE even AND root < 'r2') a JOIN (SELECT DISTINCT root, CASE WHEN brand IN ('economy', 'standard') THEN 'plain' ELSE brand END AS b FROM p WHERE even AND root < 'r2') b ON a.root = b.root AND a.b < b.b GROUP BY a.root")
