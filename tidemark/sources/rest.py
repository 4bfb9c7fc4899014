"""A data source of JSON endpoints that answer {"results": [...]}, and the addresses of market-data requests.

spark.dataSource.register(RestSource)
spark.read.format("rest_results").schema("t long, o double, c double").option("urls", json.dumps([...])).load()
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from urllib.parse import urlencode

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Attempts after the first, each one second later than the one before.
RETRIES = 3


def daily_url(base: str, ticker: str, since: str, until: str, key: str = "") -> str:
    """Daily bars of a ticker; base is the service's address with its version."""
    return f"{base}/aggs/ticker/{ticker}/range/1/day/{since}/{until}?" + urlencode({"adjusted": "true", "sort": "asc", "limit": 50000, "apiKey": key})


def minute_url(base: str, ticker: str, day: str, key: str = "") -> str:
    return f"{base}/aggs/ticker/{ticker}/range/1/minute/{day}/{day}?" + urlencode({"adjusted": "true", "sort": "asc", "limit": 50000, "apiKey": key})


def contracts_url(base: str, underlying: str, kind: str, day: str, expires: str | None = None, key: str = "") -> str:
    asked = {"underlying_ticker": underlying, "contract_type": kind, "as_of": day} | ({"expiration_date": expires} if expires else {})
    return f"{base}/reference/options/contracts?" + urlencode({"limit": 1000, "apiKey": key} | asked)


def quotes_url(base: str, ticker: str, since_ns: int, until_ns: int, key: str = "", limit: int = 10) -> str:
    return f"{base}/quotes/{ticker}?" + urlencode({"timestamp.gte": since_ns, "timestamp.lt": until_ns, "order": "asc", "limit": limit, "sort": "timestamp", "apiKey": key})


def results(url: str, retries: int = RETRIES, pause: float = 1.0) -> list[dict]:
    """The results of one request; none if the answer has no such field. A connection that still fails after the retries is an error."""
    for attempt in range(retries + 1):
        try:
            with urllib.request.urlopen(url, timeout=60) as answer:
                return json.load(answer).get("results") or []
        except (urllib.error.URLError, ConnectionError):
            if attempt == retries:
                raise
            time.sleep(attempt * pause)
    return []


def flat(record: dict, before: str = "") -> dict:
    """Nested objects as dotted names."""
    out = {}
    for k, v in record.items():
        out |= flat(v, f"{before}{k}.") if isinstance(v, dict) else {before + k: v}
    return out


class _Url(InputPartition):
    def __init__(self, url: str):
        super().__init__(url)


class _Reader(DataSourceReader):
    def __init__(self, schema, options: dict):
        self.fields, self.options = schema.fields, options

    def partitions(self):
        return [_Url(u) for u in json.loads(self.options["urls"])]

    def read(self, partition):
        for record in results(partition.value, int(self.options.get("retries", RETRIES)), float(self.options.get("pause", 1.0))):
            row = flat(record)
            yield tuple(float(row[f.name]) if f.dataType.typeName() == "double" and row.get(f.name) is not None else row.get(f.name) for f in self.fields)


class RestSource(DataSource):
    """One task for each address. The schema names the fields to keep; a missing one is null."""

    @classmethod
    def name(cls):
        return "rest_results"

    def schema(self):
        raise ValueError("give the schema of the results")

    def reader(self, schema):
        return _Reader(schema, dict(self.options))


def with_market_time(rows: DataFrame, millis: str = "t", zone: str = "America/New_York") -> DataFrame:
    """rows with `timestamp`, the market's local time of a millisecond epoch."""
    return rows.withColumn("timestamp", F.from_utc_timestamp(F.timestamp_millis(F.col(millis)), zone).cast("timestamp_ntz"))
