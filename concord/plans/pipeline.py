"""The whole chain from feeds to review queue and export, for one country or several."""

from __future__ import annotations

import argparse
import traceback
from dataclasses import replace

import yaml
from pyspark.sql import DataFrame, SparkSession

from concord.operators import blocking, clusters, export, gate, quality, review, scoring, tokens
from concord.plans.normalize import Settings, normalize
from concord.sources import config as configs
from concord.sources import feeds, files, sinks

#: Fixed value: pairs to score from which a run says so.
PAIRS_WARN = 80_000_000


def link(records: DataFrame, model: scoring.Model = scoring.FIXED, tf: bool = True) -> tuple[DataFrame, DataFrame]:
    """Scored and gated pairs of normalised records."""
    rows = scoring.compared(blocking.candidates(records), records)
    scored = scoring.scored(rows, model, scoring.frequencies(records) if tf else None).where(f"match_probability >= {scoring.PERSIST_FLOOR}")
    return scored, gate.gated(gate.features(scored, records))


def run(spark: SparkSession, config_path: str, trained: bool = True, version: str = "v2_4") -> str:
    """Run a country's chain; artifacts go to a new run folder, in whatever store it is. Raises where a guardrail fails."""
    cfg = configs.load(config_path)
    s = Settings.of(cfg)
    out = sinks.run_folder(spark, str(cfg["paths"]["output_dir"]), s.country)
    name = out.rsplit("/", 1)[1]
    n = normalize(feeds.read_feeds(spark, cfg["paths"]["raw_dir"], cfg["providers"], name), s)
    tables = {
        "normalized": n.records, "name_token_stats_global": n.stats, "name_token_stats_provider": n.provider_stats, "name_token_stats_city": n.city_stats,
        "name_token_stats_cell": n.cell_stats, "provider_quality": quality.provider_quality(n.records),
    }
    for table, frame in tables.items():
        sinks.to_parquet(frame, f"{out}/{table}")
    policy_lists = {"brand_tokens": list(n.policy.brand), "location_descriptors": list(n.policy.location), "low_value_global": list(n.policy.low_value)}
    sinks.to_yaml(spark, policy_lists, f"{out}/token_policy_effective.yaml")
    rows = quality.document_rows(n.records, n.stats, tokens.rare_tokens(n.stats, s.tokens), tokens.rare_city_tokens(n.city_stats, n.stats, s.tokens), n.policy)
    sinks.to_json(spark, quality.document(rows, run_id=name, country=s.country, normalization_version="v1"), f"{out}/diagnostics.json")
    quality.enforce(quality.headline(n.records))
    sinks.to_json(spark, blocking.diagnose(n.records, s.postal_check, s.blocking), f"{out}/blocking_diagnostics.json")
    made = blocking.scoring_pairs(n.records)
    sinks.to_json(spark, {"pairs_by_rule": made, "pairs_warn": sum(made) > PAIRS_WARN}, f"{out}/scoring_pairs.json")
    blocking.enforce(made, s.blocking)
    model = scoring.fit(n.records) if trained else scoring.FIXED
    files.write_text(spark, f"{out}/model.json", model.to_json())
    scored, gated = link(n.records, model)
    sinks.to_parquet(scored, f"{out}/scored_pairs")
    sinks.to_parquet(gated, f"{out}/gated_pairs")
    gated = spark.read.parquet(f"{out}/gated_pairs")
    policy = replace(clusters.VERSIONS[version], country=s.country or "XX", brand_groups=cfg.get("brand_groups") or {})
    found = clusters.cluster(gated, n.records, n.stats, policy)
    for table, frame in (("cluster_diagnostics", found.clusters), ("cluster_members", found.members), ("cluster_edges", found.edges)):
        sinks.to_parquet(frame, f"{out}/{table}")
    items = review.queue(review.review_clusters(found.clusters, found.members, found.edges, n.records), review.review_pairs(gated, found.edges, n.records))
    sinks.to_parquet(items, f"{out}/review_queue")
    sinks.to_csv(review.top(items), f"{out}/review_queue_top")
    members = export.with_entity_ids(found.members, n.records, s.country or "XX")
    sinks.to_parquet(export.entity_info(members, n.records), f"{out}/entity_info")
    sinks.to_parquet(export.entity_mappings(members, found.clusters), f"{out}/entity_mappings")
    sinks.to_parquet(export.entity_summaries(members, n.records), f"{out}/entity_summaries")
    return out


def rematched(spark: SparkSession, out: str, config_path: str) -> DataFrame:
    """The records of a finished run with their match tokens made anew, from its tables and the settings as they are now."""
    s = Settings.of(configs.load(config_path))
    records, stats, cities = (spark.read.parquet(f"{out}/{t}") for t in ("normalized", "name_token_stats_global", "name_token_stats_city"))
    lists = yaml.safe_load(files.read_text(spark, f"{out}/token_policy_effective.yaml")) or {}
    policy = tokens.Policy(brand=tuple(lists.get("brand_tokens", ())), location=tuple(lists.get("location_descriptors", ())), low_value=tuple(lists.get("low_value_global", ())))
    return rematch(records, stats, cities, policy, s.tokens)


def rematch(records: DataFrame, stats: DataFrame, cities: DataFrame, policy: tokens.Policy, config: tokens.TokenConfig) -> DataFrame:
    """records with match tokens and signature made from token statistics and a policy."""
    made = ("property_name_match_tokens", "property_name_match_signature")
    base = records.drop(*made)
    need = base.select("record_id", "city_name_norm", "state_norm", "country_name_clean", "area_clean", "property_name_tokens")
    overcommon = tokens.city_overcommon(base, tokens.exploded(base, config.min_len), cities, config)
    return base.join(tokens.match_tokens(need, stats, overcommon, policy, config).select("record_id", *made), "record_id")


def main(argv: list[str] | None = None) -> int:
    """Countries one after the other; one that fails doesn't stop the others."""
    parser = argparse.ArgumentParser()
    parser.add_argument("--country", required=True, help="codes, by commas")
    parser.add_argument("--configs", default="configs")
    args = parser.parse_args(argv)
    spark, failed = SparkSession.builder.appName("concord").getOrCreate(), 0
    for country in args.country.split(","):
        try:
            print(run(spark, str(configs.ensure(args.configs, country.strip()))))
        except Exception:  # noqa: BLE001
            traceback.print_exc()
            failed = 1
    return failed


if __name__ == "__main__":
    raise SystemExit(main())
