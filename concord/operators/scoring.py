"""Fellegi-Sunter scoring: comparison levels, u and m, match weights, and the audit of scores."""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from concord.functions.geo import acos_distance, asin_distance
from concord.functions.text import jaccard

PRIOR = 1e-4
#: Score bands, from to below.
BANDS = (("ge_0_99", 0.99, 1.01), ("b_095_099", 0.95, 0.99), ("b_090_095", 0.90, 0.95), ("b_080_090", 0.80, 0.90), ("b_050_080", 0.50, 0.80), ("b_001_050", 0.01, 0.50), ("lt_0_01", -0.01, 0.01))
PERSIST_FLOOR = 0.01


def prepared(records: DataFrame) -> DataFrame:
    """The fields that are compared: no empty strings, no empty token lists, no unknown type, no coarse places.

    Tokens are compared by hashes of 64 bits and signatures by digests of 128, so that pairs carry no names.
    """
    text = lambda c: F.nullif(F.col(c), F.lit(""))
    some = lambda c: F.when(F.size(c) > 0, F.transform(c, lambda t: F.xxhash64(t)))
    coarse = F.coalesce("lat_lng_low_precision", F.lit(False))
    out = {c: text(c) for c in ("property_name_core", "property_name_signature", "property_name_match_signature", "city_name_norm", "postal_code_final", "hotel_chain_norm", "website_domain_norm")}
    out |= {c: F.md5(text(c)) for c in ("property_name_signature", "property_name_match_signature")}
    out |= {c: some(c) for c in ("property_name_core_tokens", "property_name_match_tokens")}
    out |= {c: F.when(~coarse, F.col(c)) for c in ("lat_norm", "lng_norm")}
    out |= {"property_type_norm": F.nullif(text("property_type_norm"), F.lit("unknown")), "primary_phone": F.get("phone_last10_non_reused_list", F.lit(0))}
    out |= {c: F.coalesce(c, F.lit(False)) for c in ("website_reused_flag", "website_weak_domain_flag")}
    return records.withColumns({c: e for c, e in out.items() if c in records.columns or c == "primary_phone"})


COMPARED = ("property_name_norm", "property_name_core", "property_name_signature", "property_name_match_signature", "property_name_core_tokens", "property_name_match_tokens", "city_name_norm", "postal_code_final", "hotel_chain_norm", "website_domain_norm",
            "property_type_norm", "primary_phone", "website_reused_flag", "website_weak_domain_flag", "lat_norm", "lng_norm", "phone_last10_non_reused_list", "email_norm_list", "star_rating_norm")


def with_fields(pairs: DataFrame, ready: DataFrame, columns=COMPARED) -> DataFrame:
    """pairs with both records' fields, as name_l and name_r."""
    for s in "lr":
        pairs = pairs.join(ready.select(F.col("record_id").alias(f"record_id_{s}"), *(F.col(c).alias(f"{c}_{s}") for c in columns if c in ready.columns)), f"record_id_{s}")
    return pairs


def _l(c: str) -> Column:
    return F.col(f"{c}_l")


def _r(c: str) -> Column:
    return F.col(f"{c}_r")


def _levels(null: Column, *levels: Column) -> Column:
    """-1 for no evidence; else the highest number for the first level that holds, down to 0 for none."""
    out = F.when(null, -1)
    for i, level in enumerate(levels):
        out = out.when(F.coalesce(level, F.lit(False)), len(levels) - i)
    return out.otherwise(0)


def _missing(c: str) -> Column:
    return _l(c).isNull() | _r(c).isNull()


def name_overlap(tokens: str) -> tuple[Column, Column]:
    """name_jac, null where a name has no words, and name_shared, the number of words in common."""
    return jaccard(_l(tokens), _r(tokens)).alias("name_jac"), F.size(F.array_intersect(_l(tokens), _r(tokens))).alias("name_shared")


def name_level(tokens: str, sig: str, overlap: tuple[Column, Column] | None = None) -> Column:
    """overlap: name_overlap, if it is worked out."""
    j, shared = overlap or name_overlap(tokens)
    return _levels(j.isNull() if overlap else _missing(tokens), _l(sig) == _r(sig), j >= 0.85, j >= 0.65, j >= 0.45, shared >= 1)


def strong_domain() -> Column:
    c = "website_domain_norm"
    return (_l(c) == _r(c)) & ~(_l("website_reused_flag") | _r("website_reused_flag")) & ~(_l("website_weak_domain_flag") | _r("website_weak_domain_flag"))


def distance() -> Column:
    return asin_distance(_l("lat_norm"), _l("lng_norm"), _r("lat_norm"), _r("lng_norm"))


def gammas(match_tokens: bool = True, overlap: tuple[Column, Column] | None = None) -> dict[str, tuple[Column, int]]:
    """Comparisons: the level's expression and how many levels there are besides no evidence."""
    share = lambda c: F.size(F.array_intersect(_l(c), _r(c))) >= 1
    tokens, sig = ("property_name_match_tokens", "property_name_match_signature") if match_tokens else ("property_name_core_tokens", "property_name_signature")
    d = distance()
    place = _missing("lat_norm") | _missing("lng_norm")
    return {
        "gamma_name": (name_level(tokens, sig, overlap), 6),
        "gamma_phone": (_levels(_missing("phone_last10_non_reused_list"), share("phone_last10_non_reused_list")), 2),
        "gamma_email": (_levels(_missing("email_norm_list"), share("email_norm_list")), 2),
        "gamma_domain": (_levels(_missing("website_domain_norm"), strong_domain()), 2),
        "gamma_distance": (_levels(place, d <= 25, d <= 75, d <= 200, d <= 500), 5),
        "gamma_chain": (_levels(_missing("hotel_chain_norm"), _l("hotel_chain_norm") == _r("hotel_chain_norm")), 2),
        "gamma_type": (_levels(_missing("property_type_norm"), _l("property_type_norm") == _r("property_type_norm")), 2),
        "gamma_star": (_levels(_missing("star_rating_norm"), F.abs(_l("star_rating_norm") - _r("star_rating_norm")) <= 0.5), 2),
    }


def _jaro(a: str, b: str) -> float:
    if a == b:
        return 1.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken, common = [False] * len(b), []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == x:
                taken[j] = True
                common.append(x)
                break
    if not common:
        return 0.0
    n = len(common)
    turned = sum(x != y for x, y in zip(common, (y for y, t in zip(b, taken, strict=True) if t), strict=True)) / 2
    return (n / len(a) + n / len(b) + (n - turned) / n) / 3


@F.pandas_udf(DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity of two texts by letters in common and in order, more for a common begin. Arrow UDF: Spark has no such function; equal pairs are worked out once a batch."""
    known = {}

    def of(x, y):
        if x is None or y is None:
            return None
        if (x, y) not in known:
            j = _jaro(x, y)
            prefix = next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
            known[x, y] = j + min(prefix, 4) * 0.1 * (1 - j) if j > 0.7 else j
        return known[x, y]

    return pd.Series([of(x, y) for x, y in zip(a, b, strict=True)], dtype=float)


def gammas_v1() -> dict[str, tuple[Column, int]]:
    """The comparisons of the oldest version, in which name and place are told twice: the core name by letters, and everything else by equality."""
    core, place, d = "property_name_core", _missing("lat_norm") | _missing("lng_norm"), distance()
    same = lambda c: (_levels(_missing(c), _l(c) == _r(c)), 2)
    j = jaro_winkler(_l(core), _r(core))
    return {
        "gamma_core": (_levels(_missing(core), _l(core) == _r(core), j >= 0.92, j >= 0.85, j >= 0.75), 5), "gamma_signature": same("property_name_signature"),
        "gamma_phone": (_levels(_missing("phone_last10_non_reused_list"), F.size(F.array_intersect(_l("phone_last10_non_reused_list"), _r("phone_last10_non_reused_list"))) >= 1), 2),
        "gamma_distance": (_levels(place, d <= 25, d <= 75, d <= 200, d <= 500), 5), "gamma_city": same("city_name_norm"), "gamma_postal": same("postal_code_final"), "gamma_chain": same("hotel_chain_norm"), "gamma_type": same("property_type_norm"),
    }


LEVELS_V1 = {"gamma_core": 5, "gamma_signature": 2, "gamma_phone": 2, "gamma_distance": 5, "gamma_city": 2, "gamma_postal": 2, "gamma_chain": 2, "gamma_type": 2}
LEVELS = {k: n for k, n in (("gamma_name", 6), ("gamma_phone", 2), ("gamma_email", 2), ("gamma_domain", 2), ("gamma_distance", 5), ("gamma_chain", 2), ("gamma_type", 2), ("gamma_star", 2))}


def compared(pairs: DataFrame, records: DataFrame, match_tokens: bool = True, v1: bool = False) -> DataFrame:
    """Pairs with their gamma levels, and the signature if it is equal (for its frequency)."""
    return levels(with_fields(pairs, prepared(records)), match_tokens, v1)


def evidence(name_jac: Column) -> dict[str, Column]:
    """What audit and the gate ask of a pair with both records' fields, besides its score and same_city."""
    s = "property_name_match_signature"
    share = lambda c: F.size(F.array_intersect(F.coalesce(_l(c), F.array().cast("array<string>")), F.coalesce(_r(c), F.array().cast("array<string>")))) > 0
    return {
        "sig_exact": _l(s) == _r(s), "name_jac": name_jac, "phone_ov": F.when(~_missing("phone_last10_non_reused_list"), share("phone_last10_non_reused_list")), "email_ov": share("email_norm_list"), "domain_ok": strong_domain(),
        "dist_m": acos_distance(_l("lat_norm"), _l("lng_norm"), _r("lat_norm"), _r("lng_norm")), "same_postal": F.coalesce(_l("postal_code_final") == _r("postal_code_final"), F.lit(False)),
    }


_evidence = evidence
EVIDENCE = ("sig_exact", "name_jac", "phone_ov", "email_ov", "domain_ok", "dist_m", "same_postal", "same_city")


def levels(rows: DataFrame, match_tokens: bool = True, v1: bool = False, overlap: tuple[Column, Column] | None = None, evidence: bool = False) -> DataFrame:
    """compared, of pairs with both records' fields. evidence: with that too, of pairs with their overlap."""
    made = gammas_v1() if v1 else gammas(match_tokens, overlap)
    match_tokens = match_tokens and not v1
    sig = "property_name_match_signature" if match_tokens else "property_name_signature"
    keep = [c for c in ("record_id_l", "record_id_r", "provider_l", "provider_r", "match_key") if c in rows.columns]
    more = [e.alias(c) for c, e in _evidence(overlap[0]).items()] if evidence else []
    return rows.select(*keep, *(e.alias(k) for k, (e, _) in made.items()), F.when(_l(sig) == _r(sig), _l(sig)).alias("equal_signature"), _l("city_name_norm").eqNullSafe(_r("city_name_norm")).alias("same_city"), *more)


@dataclass
class Model:
    """m and u of each comparison's levels, and the prior that two records match."""

    m: dict[str, list[float]]
    u: dict[str, list[float]]
    prior: float = PRIOR

    def to_json(self) -> str:
        return json.dumps({"m": self.m, "u": self.u, "prior": self.prior}, indent=2, sort_keys=True)

    @staticmethod
    def from_json(text: str) -> Model:
        return Model(**json.loads(text))


#: Fixed parameters, for use without training.
FIXED = Model(
    m={"gamma_name": [0.02, 0.03, 0.05, 0.10, 0.20, 0.60], "gamma_phone": [0.30, 0.70], "gamma_email": [0.50, 0.50], "gamma_domain": [0.40, 0.60], "gamma_distance": [0.04, 0.06, 0.10, 0.20, 0.60], "gamma_chain": [0.10, 0.90], "gamma_type": [0.20, 0.80], "gamma_star": [0.15, 0.85]},
    u={"gamma_name": [0.80, 0.12, 0.04, 0.02, 0.01, 0.01], "gamma_phone": [0.999, 0.001], "gamma_email": [0.99, 0.01], "gamma_domain": [0.995, 0.005], "gamma_distance": [0.90, 0.05, 0.03, 0.01, 0.01], "gamma_chain": [0.80, 0.20], "gamma_type": [0.50, 0.50], "gamma_star": [0.60, 0.40]},
)


def patterns(rows: DataFrame) -> DataFrame:
    """How many pairs have each combination of levels; at most 7 * 3^6 * 6 rows."""
    return rows.groupBy(*LEVELS).agg(F.count("*").alias("n"))


def estimate_u(records: DataFrame, buckets: int | None = None, target_pairs: int = 2_000_000) -> dict[str, list[float]]:
    """Shares of levels among random pairs: records with equal hash buckets under a fixed hash, about target_pairs of them."""
    total = records.count()
    buckets = buckets or max(1, total * total // (2 * target_pairs))
    keyed = records.select("record_id", "provider", F.pmod(F.xxhash64("record_id", F.lit("u")), F.lit(buckets)).cast("string").alias("block_key"))
    from concord.operators.blocking import pairs

    found = patterns(compared(pairs(keyed), records)).toPandas()
    return {k: _shares(found, k, found["n"].to_numpy(float), n) for k, n in LEVELS.items()}


def _shares(table, name: str, weights: np.ndarray, levels: int, least: float = 1e-6) -> list[float]:
    at = table[name].to_numpy(int)
    got = np.bincount(at[at >= 0], weights[at >= 0], levels) + least
    return (got / got.sum()).tolist()


def train_m(rows: DataFrame, u: dict[str, list[float]], trained: tuple[str, ...], prior: float = 0.5, steps: int = 50) -> dict[str, list[float]]:
    """EM over the patterns of pairs that an identity rule blocks; only the named comparisons are trained."""
    table = patterns(rows).toPandas()
    n = table["n"].to_numpy(float)
    m = {k: FIXED.m[k] for k in trained}
    for _ in range(steps):
        odds = np.full(len(table), prior / (1 - prior))
        for k in trained:
            at = table[k].to_numpy(int)
            odds *= np.where(at >= 0, (np.array(m[k]) / np.array(u[k]))[at.clip(0)], 1)
        p = odds / (1 + odds)
        m = {k: _shares(table, k, n * p, LEVELS[k]) for k in trained}
        prior = float(np.clip((n * p).sum() / max(n.sum(), 1), 1e-6, 1 - 1e-6))
    return m


def fit(records: DataFrame) -> Model:
    """u from random pairs; m from two sessions, pairs of equal city and signature, which can't tell of names, and pairs of equal first phone.

    A level's m is the mean of the sessions that estimate its comparison.
    """
    from concord.operators.blocking import pairs, same_city_signature

    u = estimate_u(records)
    by_name = train_m(compared(pairs(same_city_signature(records)), records), u, tuple(k for k in LEVELS if k != "gamma_name"))
    phone = prepared(records).where("primary_phone is not null").select("record_id", "provider", F.col("primary_phone").alias("block_key"))
    return Model(mean_of([by_name, train_m(compared(pairs(phone), records), u, tuple(LEVELS))]), u)


def mean_of(sessions: list[dict[str, list[float]]]) -> dict[str, list[float]]:
    return {k: np.mean([s[k] for s in sessions if k in s], axis=0).tolist() for k in LEVELS if any(k in s for s in sessions)}


def frequencies(records: DataFrame, column: str = "property_name_match_signature") -> DataFrame:
    """equal_signature (a digest) and tf, its share of the records that have one."""
    some = records.where(F.coalesce(F.col(column), F.lit("")) != "")
    return some.groupBy(F.md5(column).alias("equal_signature")).agg(F.count("*").alias("n")).crossJoin(F.broadcast(some.agg(F.count("*").alias("total")))).select("equal_signature", (F.col("n") / F.col("total")).alias("tf"))


def scored(rows: DataFrame, model: Model = FIXED, tf: DataFrame | None = None, tf_on: str = "gamma_name") -> DataFrame:
    """Pairs with match_weight and match_probability; with tf, an equal signature, the top level of tf_on, counts by how rare it is."""
    weight = F.lit(float(np.log2(model.prior / (1 - model.prior))))
    for k in model.m:
        bayes = [float(x) for x in np.log2(np.array(model.m[k]) / np.array(model.u[k]))]
        weight = weight + F.when(F.col(k) < 0, 0.0).otherwise(F.element_at(F.array(*map(F.lit, bayes)), F.greatest(F.col(k), F.lit(0)) + 1))
    if tf is not None:
        rows = rows.join(tf, "equal_signature", "left")
        top = len(model.m[tf_on]) - 1
        weight = weight + F.when((F.col(tf_on) == top) & F.col("tf").isNotNull(), F.log2(F.lit(model.u[tf_on][top]) / F.col("tf"))).otherwise(0.0)
    rows = rows.withColumn("match_weight", weight).drop("tf")
    return rows.withColumn("match_probability", 1 / (1 + F.pow(F.lit(2.0), -F.col("match_weight"))))


def band(p: Column, bands=BANDS) -> Column:
    out = None
    for name, low, high in bands:
        hit = (p >= low) & (p < high)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def audit(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """Evidence of each scored pair (records are read if the pairs do not carry it): band, name level, overlaps, distance bucket and whether identity stands behind it."""
    rows = pairs.where(F.col("match_probability") >= PERSIST_FLOOR)
    if not set(EVIDENCE) <= set(rows.columns):
        rows, t = with_fields(rows, prepared(records)), "property_name_match_tokens"
        rows = rows.withColumns(evidence(jaccard(_l(t), _r(t))))
    rows = rows.withColumn("band", band(F.col("match_probability")))
    false = F.lit(False)
    meaningful = F.coalesce("sig_exact", false) | F.coalesce(F.col("name_jac") >= 0.45, false)
    rows = rows.withColumns({"name_level": name_band(), "dist_bucket": distance_bucket(F.col("dist_m")), "identity_gate": meaningful | F.coalesce("phone_ov", false) | F.coalesce("email_ov", false) | F.coalesce("domain_ok", false)})
    return rows.select("record_id_l", "record_id_r", "match_probability", "band", "sig_exact", "name_jac", "name_level", "phone_ov", "email_ov", "domain_ok", "dist_m", "dist_bucket", "identity_gate")


def name_band(j: str = "name_jac") -> Column:
    return F.when(F.col("sig_exact"), "signature").when(F.col(j) >= 0.85, "jac85").when(F.col(j) >= 0.65, "jac65").when(F.col(j) >= 0.45, "jac45").when(F.col(j) > 0, "shared").when(F.col(j) == 0, "none").otherwise("no_name")


def distance_bucket(d: Column) -> Column:
    return F.when(d <= 25, "le25m").when(d <= 75, "le75m").when(d <= 200, "le200m").when(d <= 500, "le500m").when(d.isNull(), "missing").otherwise("gt500m")


def crosstab(rows: DataFrame, by: str) -> DataFrame:
    return rows.groupBy("band", by).agg(F.count("*").alias("c"))


def safety(rows: DataFrame) -> DataFrame:
    """One row: how far location alone gets a pair, and how many high scores have identity behind them."""
    p, gate, sig = F.col("match_probability"), F.col("identity_gate"), F.coalesce("sig_exact", F.lit(False))
    n = lambda c, name: F.count_if(c).alias(name)
    out = rows.agg(
        n(p >= 0.99, "ge_099"), n(p >= 0.95, "ge_095"), n((p >= 0.95) & gate, "ge_095_gated"), F.coalesce(F.max(F.when(~gate, p)), F.lit(0.0)).alias("loc_only_max_score"), n(~gate & (p >= 0.5), "loc_only_ge_050"), n(~gate & (p >= 0.9), "loc_only_ge_090"),
        n(sig, "sig_exact_pairs"), F.coalesce(F.percentile(F.when(sig, p), 0.05), F.lit(0.0)).alias("sig_exact_p05_score"), F.coalesce(F.min(F.when(sig, p)), F.lit(0.0)).alias("sig_exact_min_score"),
    )
    return out.withColumn("pct_ge_095_with_identity", F.try_divide("ge_095_gated", "ge_095"))


def band_samples(rows: DataFrame, per_band: int = 200) -> DataFrame:
    """Some pairs of each band, by hash: a sample for people."""
    h = F.md5(F.concat("record_id_l", F.lit("|"), "record_id_r"))
    return rows.withColumn("__h", h).withColumn("rn", F.expr("row_number() over (partition by band order by __h)")).where(F.col("rn") <= per_band).drop("__h", "rn")
