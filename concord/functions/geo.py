"""Coordinates: validity, cells, precision and distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RADIUS_M = 6371000
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"


def valid(lat: Column, lng: Column) -> Column:
    inside = lat.between(-90, 90) & lng.between(-180, 180) & ~((lat == 0) & (lng == 0))
    return F.coalesce(inside, F.lit(False))


def out_of_range(lat: Column, lng: Column, box: tuple[float, float, float, float]) -> Column:
    """Whether a valid place is outside (lat_min, lat_max, lng_min, lng_max)."""
    return valid(lat, lng) & ~(lat.between(box[0], box[1]) & lng.between(box[2], box[3]))


def geohash(lat: Column, lng: Column, precision: int = 7) -> Column:
    """Geohash; a place on a cell's border belongs to the lower cell. Bits are computed, no UDF."""
    bits = 5 * precision
    lng_bits, lat_bits = (bits + 1) // 2, bits // 2
    cell = lambda x, low, width, n: F.greatest(F.ceil((x - low) / width * (1 << n)) - 1, F.lit(0)).cast("long")
    # the bits of both, longest first: each letter takes five, of longitude and latitude by turns
    text = lambda x, n: F.lpad(F.bin(x), n, "0")
    pairs = F.arrays_zip(F.split(text(cell(lng, -180, 360, lng_bits), lng_bits), "").alias("x"), F.split(text(cell(lat, -90, 180, lat_bits), lat_bits), "").alias("y"))
    string = F.array_join(F.transform(pairs, lambda p: F.concat(F.coalesce(p["x"], F.lit("")), F.coalesce(p["y"], F.lit("")))), "")
    letters = F.transform(F.sequence(F.lit(0), F.lit(precision - 1)), lambda k: F.substring(F.lit(BASE32), F.conv(F.substring(string, k * 5 + 1, F.lit(5)), 2, 10).cast("int") + 1, F.lit(1)))
    return F.when(valid(lat, lng), F.array_join(letters, ""))


def decimals(x: Column) -> Column:
    """Decimal places of a number, at most 7."""
    out = F.when(F.round(x, 0) == x, 0)
    for n in range(1, 7):
        out = out.when(F.round(x, n) == x, n)
    return out.otherwise(7)


def precision_bucket(lat: Column, lng: Column) -> Column:
    n = F.least(decimals(lat), decimals(lng))
    return F.when(valid(lat, lng), F.when(n <= 1, "suspicious_rounded").otherwise(F.concat(F.lit("precision_"), n.cast("string"), F.lit("dp"))))


def low_precision(bucket: Column, min_places: int = 3) -> Column:
    return bucket.isin("suspicious_rounded", *(f"precision_{n}dp" for n in range(2, min_places)))


def acos_distance(a_lat: Column, a_lng: Column, b_lat: Column, b_lng: Column, strict_null: bool = False) -> Column:
    """Metres. A missing coordinate gives half the globe's girth, since LEAST and GREATEST skip nulls; null if strict_null."""
    r = F.radians
    inner = F.sin(r(a_lat)) * F.sin(r(b_lat)) + F.cos(r(a_lat)) * F.cos(r(b_lat)) * F.cos(r(a_lng - b_lng))
    d = RADIUS_M * F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), inner)))
    return F.when(inner.isNotNull(), d) if strict_null else d


def asin_distance(a_lat: Column, a_lng: Column, b_lat: Column, b_lng: Column) -> Column:
    """Metres; null where a coordinate is."""
    r = F.radians
    half = F.pow(F.sin(r(b_lat - a_lat) / 2), 2) + F.cos(r(a_lat)) * F.cos(r(b_lat)) * F.pow(F.sin(r(b_lng - a_lng) / 2), 2)
    return 2 * RADIUS_M * F.asin(F.sqrt(half))
