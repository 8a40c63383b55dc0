import math

import pytest
from pyspark.sql import functions as F

from concord.functions import contacts, fields, geo, text


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression.alias("r")).first().r


def test_null_likes(spark):
    rows = spark.createDataFrame([("NAS",), ("n/a",), ("-",), (None,), ("  Hotel   X ",)], "v string")
    assert [r.r for r in rows.select(text.clean_text(F.col("v")).alias("r")).collect()] == [None, None, None, None, "hotel x"]
    assert one(spark, "ﬁne x", text.clean_text(F.col("v"), unicode=True)) == "fine x"


def test_names(spark):
    assert one(spark, "Café & Straße Łódź, No. 7", text.name_norm(F.col("v"))) == "cafe and strasse lodz no 7"
    assert one(spark, "a 7 bb", text.name_tokens(F.col("v"))) == ["7", "bb"]
    assert one(spark, "tiger tadoba", text.signature(text.name_tokens(F.col("v")))) == one(spark, "tadoba tiger", text.signature(text.name_tokens(F.col("v"))))


def scalar_geohash(lat, lng, n=7):
    low, high, bits = [-180.0, -90.0], [180.0, 90.0], ""
    for i in range(5 * n):
        k, x = i % 2, (lng, lat)[i % 2]
        mid = (low[k] + high[k]) / 2
        bits += "1" if x > mid else "0"
        (low if x > mid else high)[k] = mid
    return "".join(geo.BASE32[int(bits[i:i + 5], 2)] for i in range(0, len(bits), 5))


def test_geohash(spark):
    points = [(lat / 7 - 89, (lat * 131 % 3600) / 10 - 180) for lat in range(1, 1200, 7)] + [(45.0, 90.0), (-45.0, -90.0), (0.0, 1.0), (90.0, 180.0)]
    rows = spark.createDataFrame(points, "lat double, lng double").select("lat", "lng", geo.geohash(F.col("lat"), F.col("lng")).alias("g")).collect()
    assert [r.g for r in rows] == [scalar_geohash(r.lat, r.lng) for r in rows]
    assert spark.createDataFrame([(0.0, 0.0), (None, 3.0), (91.0, 3.0)], "lat double, lng double").select(geo.geohash(F.col("lat"), F.col("lng")).alias("g")).where("g is not null").count() == 0


def test_precision_and_distance(spark):
    rows = spark.createDataFrame([(12.0, 77.0), (12.34, 77.5), (12.345, 77.123)], "lat double, lng double")
    got = [r.b for r in rows.select(geo.precision_bucket(F.col("lat"), F.col("lng")).alias("b")).collect()]
    assert got == ["suspicious_rounded", "suspicious_rounded", "precision_3dp"]
    pair = spark.createDataFrame([(10.0, 20.0, 10.0, 20.01), (None, None, 1.0, 1.0)], "a double, b double, c double, d double")
    args = [F.col(c) for c in "abcd"]
    near, missing = pair.select(geo.acos_distance(*args).alias("x"), geo.asin_distance(*args).alias("y"), geo.acos_distance(*args, strict_null=True).alias("z")).collect()
    assert abs(near.x - near.y) < 0.5 and missing.y is None and missing.z is None and abs(missing.x - math.pi * geo.RADIUS_M) < 1


@pytest.mark.parametrize(("raw", "want"), [("+919372868698, +919372868698", ["+919372868698"]), ("0", []), (None, []), ("0091 0 8028544444", ["+918028544444"]), ("093728 68698--junk12", ["+919372868698"])])
def test_phones(spark, raw, want):
    assert one(spark, raw, contacts.phone_numbers(F.col("v"), "IN")[0]) == want


def test_emails_and_urls(spark):
    assert one(spark, "A@X.com; b@y.org/bad", contacts.emails(F.col("v"))) == ["a@x.com", "b@y.org"]
    assert one(spark, None, contacts.all_generic(contacts.email_part(contacts.emails(F.col("v")), 1), ["info"])) is True
    host = contacts.url_host(F.col("v"))
    assert one(spark, "www.Some-Inn.co.uk/x?y", host) == "some-inn.co.uk"
    assert [one(spark, u, contacts.registered_domain(host)) for u in ("http://a.b.inn.co.uk", "https://m.site.com:80/p", "nodots", None)] == ["inn.co.uk", "site.com", None, None]


def test_fields(spark):
    assert one(spark, "12 main rd opp st church", fields.address_norm(F.col("v"))) == "12 main road opposite street church"
    assert one(spark, "12345-6789", fields.postal(F.col("v"), r"\b([0-9]{5})(?:-[0-9]{4})?\b")) == "12345"
    assert [one(spark, v, fields.property_type(F.col("v"))) for v in ("beach resort hotel", "b&b", "serviced flat", "boat", None)] == ["resort", "guesthouse", "apartment", "unknown", "unknown"]
    assert one(spark, "no chain", fields.hotel_chain(F.col("v"))) is None
    assert one(spark, "35", fields.country(F.col("v"), F.lit(None).cast("string"), {"35": "IN"}, {})[0]) == "IN"
