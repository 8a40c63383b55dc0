"""Run configurations: one YAML file for each country, with lookup tables beside it."""

from __future__ import annotations

from pathlib import Path

import yaml

LOOKUPS = ("providers", "property_type_maps", "country_maps", "state_maps")


def load(path: str) -> dict:
    """A run's settings, with its country's lookups under their names."""
    folder, out = Path(path).parent, yaml.safe_load(Path(path).read_text()) or {}
    for name in LOOKUPS:
        file = folder / f"{name}.yaml"
        out[f"{name}_config" if name == "providers" else name] = (yaml.safe_load(file.read_text()) or {}) if file.exists() else {}
    return out


def discover(folder: str) -> dict[str, Path]:
    """Country to file, of the files that have a country and paths."""
    out = {}
    for p in sorted(Path(folder).glob("*.yaml")):
        try:
            data = yaml.safe_load(p.read_text()) or {}
        except yaml.YAMLError:
            continue
        if isinstance(data, dict) and data.get("country") and "paths" in data:
            out[str(data["country"]).upper()] = p
    return out


def generic(country: str) -> dict:
    """Settings that work untuned: no bounding box, no brands, a permissive postal code."""
    return {
        "country": country, "default_phone_region": country, "paths": {"raw_dir": f"data/raw/{country}", "output_dir": "data/artifacts/runs"}, "geo": {"min_decimal_places": 3}, "postal": {"field_pattern": "([0-9A-Za-z -]{3,10})", "address_pattern": "(?!)"},
        "tokens": {"low_value_min_city_coverage": 10, "brand_candidate_min_chain_count": 10}, "manual_tokens": {"force_low_value": ["hotel", "hotels", "room", "rooms", "stay", "stays", "the", "and"], "force_keep": [], "brand_tokens": [], "location_descriptors": ["airport", "station", "beach", "near"]},
        "reuse": {"phone_reuse_min": 5, "email_reuse_min": 5, "domain_reuse_min": 20, "top_n": 200},
    }


def ensure(folder: str, country: str) -> Path:
    """The country's file; a generic one is written where there is none."""
    known = discover(folder)
    if country.upper() in known:
        return known[country.upper()]
    path = Path(folder) / f"{country.lower()}.yaml"
    if path.exists():
        raise ValueError(f"{path} has no country or paths")
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("# Generic settings; look at geo, postal, brands and states before you trust results.\n" + yaml.safe_dump(generic(country.upper()), sort_keys=False))
    return path
