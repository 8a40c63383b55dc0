"""Where results go: files by kind, run folders, and a service that takes rows by the batch."""

from __future__ import annotations

import json
import re
import time
import urllib.parse
import urllib.request
import uuid
from collections.abc import Callable
from datetime import date

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.sources import files

BATCH = 500


def to_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def to_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def to_yaml(spark: SparkSession, data, path: str) -> None:
    files.write_text(spark, path, yaml.safe_dump(data, sort_keys=False, allow_unicode=True))


def to_json(spark: SparkSession, data, path: str) -> None:
    files.write_text(spark, path, json.dumps(data, indent=2, default=str))


def run_folder(spark: SparkSession, root: str, country: str, day: date | None = None) -> str:
    """A new folder for a run, <day>_<country>_<number>; the next number, or the one after where another run takes that first."""
    prefix = f"{(day or date.today()).isoformat()}_{country}"
    taken = [int(m[1]) for name in files.names(spark, root) if (m := re.fullmatch(rf"{re.escape(prefix)}_(\d+)", name))]
    number = max(taken, default=0) + 1
    while not files.create_folder(spark, f"{root.rstrip('/')}/{prefix}_{number:03d}"):
        number += 1
    return f"{root.rstrip('/')}/{prefix}_{number:03d}"


def replace_country(df: DataFrame, path: str, country: str, country_column: str = "country_code") -> None:
    """A country's rows in place of those that were there, which go even where there are no new ones; other countries' stay."""
    at, old = f"{path.rstrip('/')}/{country_column}={country}", f"{path.rstrip('/')}/_old-{uuid.uuid4().hex}"
    spark = df.sparkSession
    new = f"{path.rstrip('/')}/_new-{uuid.uuid4().hex}"
    df.where(F.col(country_column) == country).drop(country_column).write.parquet(new)  # may read what it replaces
    files.rename(spark, at, old)
    files.rename(spark, new, at)
    files.delete(spark, old)


def post(url: str, token: str) -> Callable[[list[dict]], None]:
    """Sends a batch of rows to a service."""
    def send(rows: list[dict]) -> None:
        body = json.dumps({"rows": rows}, ensure_ascii=False).encode()
        _send(urllib.request.Request(url, body, {"X-Write-API-Key": token, "Content-Type": "application/json"}, method="POST"))

    return send


def delete_country(url: str, token: str, country: str) -> None:
    query = urllib.parse.urlencode({"where": f"entity_id LIKE '{country}\\_%'"})
    _send(urllib.request.Request(f"{url}?{query}", headers={"X-Write-API-Key": token}, method="DELETE"))


def _send(request: urllib.request.Request, attempts: int = 5) -> None:
    for attempt in range(attempts):
        try:
            urllib.request.urlopen(request, timeout=120).close()
            return
        except OSError:
            if attempt == attempts - 1:
                raise
            time.sleep(2**attempt)


def insert_rows(df: DataFrame, send: Callable[[list[dict]], None], batch: int = BATCH) -> None:
    """Rows to a service, from each partition by the batch."""
    def run(rows):
        held = []
        for r in rows:
            held.append(r.asDict(recursive=True))
            if len(held) == batch:
                send(held)
                held = []
        if held:
            send(held)
    df.foreachPartition(run)


def dry_run(df: DataFrame) -> dict:
    """What would be sent: a row, and how many."""
    first = df.limit(1).collect()
    return {"rows": df.count(), "sample": first[0].asDict(recursive=True) if first else None}
