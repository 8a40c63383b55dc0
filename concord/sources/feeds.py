"""Feeds of records: files of JSON lines under one schema, and a paged service."""

from __future__ import annotations

import json
import time
import urllib.parse
import urllib.request
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, InputPartition

from concord.sources import files

#: The columns of a feed.
STRINGS = (
    "property_code", "property_name", "address_lines", "city_name", "city_code", "state", "country_code", "country_name", "postal_code", "property_type", "phone_numbers", "emails", "fax_numbers", "hotel_chain", "amenities", "check_in_time", "check_out_time", "thumbnail", "weburl",
    "land_mark", "area", "geohash6", "updated_at", "country_code_iso2", "hotel_id", "source_credential",
)
DOUBLES, LONGS = ("lat", "lng", "star_rating", "average_of_rating"), ("number_of_rooms", "total_reviews")
CANONICAL = ", ".join([f"{c} string" for c in STRINGS] + [f"{c} double" for c in DOUBLES] + [f"{c} long" for c in LONGS])


def canonical(df: DataFrame) -> DataFrame:
    """The feed's columns in order and type; values that don't fit and columns that aren't there are null, others go."""
    types = {**dict.fromkeys(STRINGS, "string"), **dict.fromkeys(DOUBLES, "double"), **dict.fromkeys(LONGS, "long")}
    return df.select(*((F.col(c).try_cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in types.items()))


def read_feed(spark: SparkSession, path: str, provider: str) -> DataFrame:
    """One provider's file of JSON lines; lines that are no JSON are skipped. Rows are numbered in the order of the file.

    The number is made from the rows of each partition and the sizes of the partitions before, so the file is read in
    parallel and twice, and no task sees more than its part.
    """
    schema = ", ".join(f"{c} string" for c in (*STRINGS, *DOUBLES, *LONGS)) + ", __bad string"
    line = F.from_json("value", schema, {"columnNameOfCorruptRecord": "__bad"}).alias("x")
    raw = spark.read.text(path).where("trim(value) <> ''").select(line).where("x is not null and x.__bad is null").select("x.*")
    rows = canonical(raw).withColumns({"__part": F.spark_partition_id(), "__id": F.monotonically_increasing_id()})
    sizes = rows.groupBy("__part").agg(F.count("*").alias("n"))  # one row for each partition
    starts = sizes.withColumn("start", F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.join(starts.select("__part", F.coalesce("start", F.lit(0)).alias("start")), "__part")
    number = (F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("start")).cast("long")
    return rows.withColumns({"provider": F.lit(provider), "source_row_number": number}).drop("__part", "__id", "start")


def read_feeds(spark: SparkSession, folder: str, providers: list[str], run_id: str = "run", version: str = "v1") -> DataFrame:
    """All providers' files in a folder; files that are missing or empty are left out."""
    found = []
    for p in providers:
        path = f"{folder}/{p}_property_info.ndjson"
        if files.exists(spark, path) and files.size(spark, path) > 0:
            found.append(read_feed(spark, path, p))
    if not found:
        raise FileNotFoundError(f"no feed of {', '.join(providers)} in {folder}")
    return with_provenance(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found), run_id, version)


def with_provenance(rows: DataFrame, run_id: str, version: str) -> DataFrame:
    key = F.concat_ws("::", F.col("provider"), F.coalesce("property_code", F.lit("")), F.col("source_row_number").cast("string"))
    return rows.withColumns({"record_id": key, "normalization_run_id": F.lit(run_id), "normalization_version": F.lit(version)})


class PagedFeed(DataSource):
    """``spark.read.format("paged_feed")``: a service that gives rows page by page after a cursor.

    Options: url, token, providers (by commas), country, iso2_providers, page (rows of a page). One partition for each
    provider; a filter on the provider prunes partitions; failed requests are tried again with growing pauses.
    """

    @classmethod
    def name(cls):
        return "paged_feed"

    def schema(self):
        return CANONICAL + ", provider string"

    def reader(self, schema):
        return PagedReader(self.options)


class ProviderPartition(InputPartition):
    def __init__(self, provider: str):
        self.provider = provider


class PagedReader(DataSourceReader):
    ATTEMPTS = 5

    def __init__(self, options):
        self.options = dict(options)
        self.providers = [p.strip() for p in options.get("providers", "").split(",") if p.strip()]

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("provider",):
                self.providers = [p for p in self.providers if p == f.value]
            else:
                yield f

    def partitions(self):
        return [ProviderPartition(p) for p in self.providers]

    def url(self, provider: str, after: str | None) -> str:
        field = "country_code_iso2" if provider in self.options.get("iso2_providers", "agoda,grnc").split(",") else "country_code"
        query = {"limit": self.options.get("page", "10000"), "order_by": "property_code", "where": f"{field}='{self.options.get('country', '')}'"}
        return f"{self.options['url']}/{provider}_property_info/rows?" + urllib.parse.urlencode({**query, **({"after": after} if after else {})})

    def get(self, url: str) -> dict:
        for attempt in range(self.ATTEMPTS):
            try:
                request = urllib.request.Request(url, headers={"X-API-Key": self.options.get("token", "")})
                with urllib.request.urlopen(request, timeout=120) as response:
                    return json.load(response)
            except OSError:
                if attempt == self.ATTEMPTS - 1:
                    raise
                time.sleep(float(self.options.get("pause", "1")) * 2**attempt)

    def read(self, partition):
        after = None
        casts = {**dict.fromkeys(STRINGS, str), **dict.fromkeys(DOUBLES, float), **dict.fromkeys(LONGS, int)}
        while True:
            page = self.get(self.url(partition.provider, after))
            for row in page["rows"]:
                yield (*(_cast(row.get(c), kind) for c, kind in casts.items()), partition.provider)
            after = page.get("next_after")
            if not page.get("has_more"):
                return


def _cast(value, kind):
    try:
        return None if value is None else kind(value)
    except (TypeError, ValueError):
        return None


def download(spark: SparkSession, folder: str, provider: str, **options) -> int:
    """A provider's rows as a folder of JSON lines; -1 where there is a whole one already. What an earlier call left unfinished is written anew."""
    path = f"{folder}/{provider}_property_info.ndjson"
    if files.exists(spark, f"{path}/_SUCCESS"):
        return -1
    spark.dataSource.register(PagedFeed)
    rows = spark.read.format("paged_feed").options(providers=provider, **options).load().drop("provider")
    rows.write.mode("overwrite").json(path)
    return spark.read.text(path).count()
